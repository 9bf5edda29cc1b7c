"""Every registered query against its check SQL in DuckDB, on the small tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, connect
from stockledger.cases import all_cases


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_query_has_check_sql():
    assert set(all_cases()) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(all_cases()))
def test_query(spark, con, sf, name):
    verdict, _ = compare(spark, con, sf, name)
    assert verdict.startswith("ok"), verdict


def test_entry(spark):
    df = entry(spark)
    assert df.columns[:2] == ["PartNumber", "LocationName"] and df.count() > 0

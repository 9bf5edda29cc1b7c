"""Registered queries against their check SQL, and the pipeline against its stages in plain Python."""

import duckdb
import pytest

import corpus_pipeline
from stockledger.llm.queries import ORACLES, QUERIES, documents

TABLES = ("documents", "embeddings", "benchmark")


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_check_sql(spark, sf, name):
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"create view {table} as select * from '{sf}/{table}.parquet'")
    got = QUERIES[name](spark, sf)
    cursor = con.execute(ORACLES[name])
    columns = [x[0] for x in cursor.description]
    assert sorted(columns) == sorted(got.columns)
    assert canonical(got.columns, got.collect()) == canonical(columns, cursor.fetchall())


def test_pipeline_stages_take_effect(spark):
    sf = "/root/testdata/sf0.01"
    docs = documents(spark, sf)
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, sf)
        assert after.columns == docs.columns, name
        before, now = ({r.doc_id for r in x.collect()} for x in (kept, after))
        assert now <= before and (name == "secrets" or len(now) < len(before))
        kept = after
    packed = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in kept.collect()}
    assert sum(r.length for r in packed) == sum({r.doc_id: r.doc_tokens for r in packed}.values())

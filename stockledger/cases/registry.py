"""Queries with their check SQL.

A case has a Spark function ``(spark, sf_dir) -> DataFrame`` and the SQL DuckDB runs on the same
tables. ``columns`` lists the output as ``kind:name`` pairs; both sides are rendered by it, so the
comparison does not depend on how an engine prints a type: ``i`` whole number, ``n`` number,
``s`` text, ``d`` date, ``t`` timestamp.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockledger.sources.demo import check_sql


@dataclass(frozen=True)
class Case:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CASES: dict[str, Case] = {}

_SPARK = {
    "i": lambda c: c.cast("bigint"),
    "n": lambda c: c.cast("double"),
    "s": lambda c: c.cast("string"),
    "d": lambda c: F.date_format(c, "yyyy-MM-dd"),
    "t": lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
}
_DUCK = {
    "i": "cast({0} as bigint)",
    "n": "cast({0} as double)",
    "s": "cast({0} as varchar)",
    "d": "strftime({0}, '%Y-%m-%d')",
    "t": "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')",
}


def case(columns: str, sql: str | None = None, name: str | None = None):
    """Registers a query under its function name."""
    spec = [c.split(":", 1) for c in columns.split()]

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            return df.select(*[_SPARK[kind](F.col(column)).alias(column) for kind, column in spec])

        key = name or fn.__name__
        body = None
        if sql is not None:
            rendered = ", ".join(f'{_DUCK[kind].format(column)} as {column}' for kind, column in spec)
            body = f"select {rendered} from (\n{check_sql(sql)}\n) as checked"
        CASES[key] = Case(key, run, body)
        return fn

    return register

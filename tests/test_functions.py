"""Column expressions on edge values."""

from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from stockledger.functions import dates, labels, numbers, text
from stockledger.operators import aggs, spine


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "raw, want",
    [
        ('{"Comment":"ok","Other":"x"}', "ok"),
        ('{"Comment":""}', ""),
        ('note: {"Comment":"ok"}', "ok"),
        ('{"Comment":"ok"', "ok"),
        ('{"Comment": "spaced"}', None),
        ('{"Other":"x"}', None),
        ("plain", None),
        ("", None),
        (None, None),
        ('{"Comment":"a \\"b\\" c","Other":"x"}', 'a "b" c'),
        ('{"Comment":"first","Comment":"second"}', "first"),
        ('{"Other":{"Comment":"inner"}}', "inner"),
    ],
)
def test_json_field(spark, raw, want):
    df = spark.createDataFrame([(raw,)], "raw string")
    assert df.select(text.json_field(F.col("raw"), "Comment").alias("x")).first()["x"] == want
    assert text.with_json_fields(df, "raw", {"x": "Comment", "y": "Other"}).first()["x"] == want


def test_json_fields_parse_once(spark):
    df = spark.range(3).select(F.concat(F.lit('{"A":"'), "id", F.lit('","B":"x","C":"y"}')).alias("raw"))
    got = text.with_json_fields(df, "raw", {"a": "A", "b": "B", "c": "C"})
    assert [tuple(r)[1:] for r in got.orderBy("raw").collect()] == [(str(i), "x", "y") for i in range(3)]
    assert got._jdf.queryExecution().optimizedPlan().toString().lower().count("parsejson") == 1


@pytest.mark.parametrize(
    "pattern, want",
    [
        ("YYYY", "2024"),
        ("YYYY-MM", "2024-03"),
        ("yyyy-mm-dd", "2024-03-05"),
        ("YYYY-MM-DD HH:MM:SS", "2024-03-05 14:07:09"),
        ("YYYY-MM-DD hh:mm:ss", "2024-03-05 14:07:09"),
        ("hh:mm:ss", "14:07:09"),
        ("MMM", "Mar"),
    ],
)
def test_date_patterns(spark, pattern, want):
    df = spark.createDataFrame([(datetime(2024, 3, 5, 14, 7, 9),)], "at timestamp")
    assert df.select(dates.date_fmt(F.col("at"), pattern).alias("x")).first()["x"] == want


def test_days_are_half_open(spark):
    times = [datetime(2024, 1, 1), datetime(2024, 1, 2, 23, 59, 59, 999999), datetime(2024, 1, 3), datetime(2023, 12, 31, 23)]
    df = spark.createDataFrame([(t,) for t in times], "at timestamp")
    got = df.select(dates.in_days(F.col("at"), "2024-01-01", "2024-01-02").alias("x")).collect()
    assert [r["x"] for r in got] == [True, True, False, False]


def test_in_year(spark):
    times = [datetime(2023, 12, 31, 23, 59), datetime(2024, 1, 1), datetime(2024, 12, 31, 23, 59, 59), datetime(2025, 1, 1)]
    df = spark.createDataFrame([(t,) for t in times], "at timestamp")
    assert [r[0] for r in df.select(dates.in_year(F.col("at"), 2024)).collect()] == [False, True, True, False]


def test_text_joins_treat_null_differently(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    got = df.select(text.concat_text(F.col("x"), "-", F.col("y")).alias("c"), text.plus_text(F.col("x"), "-", F.col("y")).alias("p"))
    assert tuple(got.first()) == ("a-", None)


def test_first_nonempty_rejects_null_and_empty(spark):
    df = spark.createDataFrame([(None, "", "c"), ("a", "b", "c"), ("", None, "")], "x string, y string, z string")
    got = df.select(text.first_nonempty(F.col("x"), F.col("y"), F.col("z")).alias("v")).collect()
    assert [r["v"] for r in got] == ["c", "a", None]


def test_code_label(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "code int")
    known = {1: "one"}
    got = df.select(labels.code_label(F.col("code"), known).alias("a"), labels.code_label(F.col("code"), known, "?").alias("b"))
    assert [tuple(r) for r in got.collect()] == [("one", "one"), (None, "?"), (None, "?")]


def test_numbers(spark):
    df = spark.createDataFrame([(5, 2.0), (5, None), (None, 2.0)], "v int, f double")
    got = df.select(
        numbers.to_unit(F.col("v"), F.col("f")).alias("stock"),
        numbers.to_unit(F.col("v"), F.col("f"), "multiply").alias("price"),
        numbers.not_below_zero(F.col("v") - 9).alias("clamped"),
        numbers.differs(F.col("v"), F.lit(4)).alias("differs"),
    ).collect()
    assert [tuple(r) for r in got] == [(2.5, 10.0, 0, 1), (5.0, 5.0, 0, 1), (None, None, 0, 0)]
    with pytest.raises(ValueError):
        numbers.to_unit(F.col("v"), F.col("f"), "other")


def test_whole_rounds_half_up(spark):
    df = spark.createDataFrame([("2.5",), ("-2.5",), ("0.49",), (None,)], "v string")
    got = df.select(numbers.whole(F.col("v").cast("decimal(18,4)")).cast("int")).collect()
    assert [r[0] for r in got] == [3, -3, 0, 0]


def test_list_distinct(spark):
    df = spark.createDataFrame([("k", "b"), ("k", "a"), ("k", "b"), ("k", None), ("n", None)], "key string, v string")
    got = df.groupBy("key").agg(
        aggs.list_distinct(F.col("v")).alias("plain"), aggs.list_distinct(F.col("v"), quote="'").alias("quoted")
    )
    assert rows(got, "key", "plain", "quoted") == [("k", "a, b", "'a', 'b'"), ("n", None, None)]


def test_contra_accounts(spark):
    data = [("v", "10", 5, 0), ("v", "30", 0, 5), ("v", "20", 0, 1), ("v", None, 0, 1), ("w", "10", 5, 0)]
    df = spark.createDataFrame(data, "voucher string, account string, debit int, credit int")
    got = aggs.contra_accounts(df, "voucher", "account", "debit", "credit")
    assert rows(got, "voucher", "account", "credit_accounts", "debit_accounts") == [
        ("v", "10", "20, 30", "10"),
        ("v", "20", "20, 30", "10"),
        ("v", "30", "20, 30", "10"),
        ("v", None, "20, 30", "10"),
        ("w", "10", None, "10"),
    ]


def test_pivot_measures_fill_and_total(spark):
    df = spark.createDataFrame([("p", "Jan", 2), ("p", "Jan", 3), ("q", "Feb", 4), ("q", "Odd", 9)], "part string, month string, v int")
    got = aggs.pivot_measures(df, ["part"], "month", ["Jan", "Feb"], {"n": F.lit(1), "v": F.col("v")})
    assert got.columns == ["part", "Jan_n", "Jan_v", "Feb_n", "Feb_v"]
    assert rows(got) == [("p", 2, 5, 0, 0), ("q", 0, 0, 1, 4)]
    single = aggs.pivot_measures(df, ["part"], "month", ["Jan", "Feb"], {"v": F.col("v")}, fill=None)
    assert rows(single, "part", "Jan_v", "Feb_v") == [("p", 5, None), ("q", None, 4)]


def test_spines(spark):
    assert spine.date_spine(spark, "2024-02-27", "2024-03-01").count() == 4
    assert spine.date_spine(spark, "2024-01-01", "2024-12-31").count() == 366
    assert [r["month"] for r in spine.month_spine(spark, 2024).collect()] == [f"2024-{m:02d}" for m in range(1, 13)]
    df = spark.createDataFrame([("a", date(2024, 1, 1))], "k string, d date")
    assert spine.with_days(df, F.col("d"), "2024-01-03").count() == 3

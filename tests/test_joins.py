"""Joins against their naive SQL forms, and the rules for NULL."""

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from stockledger.operators import joins
from stockledger.sources.demo import role


def test_or_join_equals_naive(spark, sf, no_broadcast):
    calls = role(spark, sf, "v_schedule_call")
    customers = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", "c_name")
    got = joins.or_join(calls, customers, [("buyer_code", "c_name"), ("buyer_id", "c_custkey")])
    want = calls.join(customers, (F.col("buyer_code") == F.col("c_name")) | (F.col("buyer_id") == F.col("c_custkey")))
    columns = ["schedule_id", "position", "part_id", "delivery_date", "c_custkey"]
    assert rows(got, *columns) == rows(want, *columns)
    assert "NestedLoop" not in plan_of(got) and "Cartesian" not in plan_of(got)


def test_or_join_pairs_once_with_nulls_and_common_keys(spark):
    left = spark.createDataFrame([(1, "a", 7, 0), (2, None, 7, 0), (3, "a", None, 0), (4, "a", 7, 1)], "id long, x string, y int, z int")
    right = spark.createDataFrame([("a", 7, 0), ("b", 7, 0)], "u string, v int, w int")
    got = joins.or_join(left, right, [("x", "u"), ("y", "v")], also=[("z", "w")])
    assert rows(got, "id", "u") == [(1, "a"), (1, "b"), (2, "a"), (2, "b"), (3, "a")]


def test_prefix_join_tries_every_separator(spark, no_broadcast):
    left = spark.createDataFrame([("A",), ("A/1",), ("B",), (None,)], "key string")
    right = spark.createDataFrame([(1, "A/1/2"), (2, "A"), (3, "AB/1"), (4, None), (5, "B/")], "id long, entity string")
    got = joins.prefix_join(left, right, "key", "entity")
    assert rows(got, "key", "id") == [("A", 1), ("A/1", 1), ("B", 5)]
    outer = joins.prefix_join(left, right, "key", "entity", how="left")
    assert rows(outer, "key", "id") == [("A", 1), ("A/1", 1), ("B", 5), (None, None)]
    assert "NestedLoop" not in plan_of(got) and "Cartesian" not in plan_of(got)


@pytest.mark.parametrize(
    "listed",
    [
        [("s", 1), ("s", 2)],
        [("s", 1), ("s", None)],
        [("t", 1)],
        [],
    ],
)
def test_not_in_scope_equals_sql(spark, listed):
    data = [(1, "s", 1), (2, "s", 3), (3, "s", None), (4, "t", 1), (5, None, 1), (6, "u", None)]
    df = spark.createDataFrame(data, "id long, scope string, value int")
    allowed = spark.createDataFrame(listed, "a_scope string, a_value int")
    df.createOrReplaceTempView("nis_rows")
    allowed.createOrReplaceTempView("nis_allowed")
    want = spark.sql(
        "select id from nis_rows r where value not in (select a_value from nis_allowed a where a.a_scope = r.scope)"
    )
    got = joins.not_in_scope(df, allowed, ("scope", "a_scope"), ("value", "a_value"))
    assert rows(got, "id") == rows(want)


def test_not_in_scope_has_no_nested_loop(spark, sf, no_broadcast):
    got = joins.not_in_scope(
        role(spark, sf, "v_reported"), role(spark, sf, "v_bom"), ("part_id", "part_id"), ("material_id", "material_id")
    )
    assert "NestedLoop" not in plan_of(got) and "Cartesian" not in plan_of(got)


def test_lookup_in_gives_one_row_per_hit(spark):
    df = spark.createDataFrame([(1, 10, 20), (2, 10, None), (3, None, None), (4, 99, 20), (5, 10, 10)], "id long, a long, b long")
    notes = spark.createDataFrame([(10, "ten"), (20, "twenty")], "note_id long, note string")
    got = joins.lookup_in(df, notes, ["a", "b"], "note_id")
    assert rows(got, "id", "note") == [(1, "ten"), (1, "twenty"), (2, "ten"), (3, None), (4, "twenty"), (5, "ten")]


def test_typed_lookup_only_looks_where_the_type_says(spark):
    df = spark.createDataFrame([(1, "N1", 3), (2, "N1", 1), (3, "N2", 3), (4, None, 3)], "id long, number string, code int")
    sales = spark.createDataFrame([("N1", "sale")], "s_number string, sale string")
    buys = spark.createDataFrame([("N1", "buy")], "b_number string, buy string")
    got = joins.typed_lookup(df, "number", "code", [(sales, "s_number", [3, 9]), (buys, "b_number", [1])])
    assert rows(got, "id", "sale", "buy") == [(1, "sale", None), (2, None, "buy"), (3, None, None), (4, None, None)]


def test_attribute_lookup_skips_null_values(spark):
    parts = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    fields = spark.createDataFrame([(1, 7, "x"), (1, 8, "y"), (2, 7, None), (3, 9, "z")], "parent long, template long, text string")
    got = joins.attribute_lookup(parts, fields, "id", "parent", "template", "text", {"seven": 7, "eight": 8})
    assert rows(got, "id", "seven", "eight") == [(1, "x", "y"), (2, None, None), (3, None, None)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_join_and_splits_a_hot_key(spark, how, no_broadcast):
    big = spark.range(1000).select(F.col("id"), F.when(F.col("id") < 900, "hot").otherwise(F.col("id").cast("string")).alias("key"))
    small = spark.createDataFrame([("hot", 1), ("950", 2)], "key string, rank int")
    got = joins.salted_join(big, small, ["key"], "id", how, salts=4)
    assert rows(got, "id", "rank") == rows(big.join(small, "key", how), "id", "rank")
    # Tiny partitions would be merged again at run time, which is not the point here.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = got.filter("key = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert parts > 1


def test_pair_legs_keeps_a_leg_without_partner(spark):
    legs = spark.createDataFrame([(1, "A", -5), (1, "B", 5), (2, "A", -3), (3, "C", 4)], "tx long, place string, amount int")
    got = joins.pair_legs(legs, ["tx"], "amount", ["place"], {"place": "to_place", "amount": "moved"})
    assert rows(got, "tx", "place", "to_place", "moved") == [(1, "A", "B", 5), (2, "A", None, None)]


def test_outer_apply_group_gives_a_null_row(spark):
    left = spark.createDataFrame([(1,), (2,)], "v long")
    right = spark.createDataFrame([(1, "a", 3), (1, "a", 4), (1, "b", 5)], "v long, account string, amount int")
    got = joins.outer_apply_group(left, right, ["v"], ["account"], {"total": F.col("amount")})
    assert rows(got, "v", "account", "total") == [(1, "a", 7), (1, "b", 5), (2, None, None)]


def test_siblings_are_ordered_pairs(spark):
    members = spark.createDataFrame([(1, "h"), (2, "h"), (3, "k"), (4, None)], "part long, holder string")
    assert rows(joins.siblings(members, "holder", "part", "other"), "part", "other") == [(1, 2), (2, 1)]


def test_or_join_reads_each_side_once_and_keeps_types(spark, no_broadcast, tmp_path):
    """Three alternatives of different types, NULL keys, a pair that all of them give, and repeated rows."""
    left = [(1, "a", 5, 2.0), (2, None, 5, None), (3, "b", None, 2.5), (4, None, None, None), (5, "a", 5, 2.0), (5, "a", 5, 2.0)]
    right = [(10, "a", 5, 2), (11, "x", 5, 9), (12, "b", None, 2), (13, None, None, None), (14, "a", 6, 7)]
    spark.createDataFrame(left, "id long, l1 string, l2 int, l3 double").write.parquet(str(tmp_path / "l"))
    spark.createDataFrame(right, "rid long, r1 string, r2 long, r3 int").write.parquet(str(tmp_path / "r"))
    a, b = spark.read.parquet(str(tmp_path / "l")), spark.read.parquet(str(tmp_path / "r"))
    got = joins.or_join(a, b, [("l1", "r1"), ("l2", "r2"), ("l3", "r3")])
    want = [(i, r) for i, l1, l2, l3 in left for r, r1, r2, r3 in right if (l1 and l1 == r1) or (l2 and l2 == r2) or (l3 and l3 == r3)]
    assert sorted(map(tuple, got.select("id", "rid").collect())) == sorted(want)
    assert got.columns == [*a.columns, *b.columns]
    plan = plan_of(got)
    assert plan.count("FileScan") == 2 and plan.count("SortMergeJoin") == 1 and "NestedLoop" not in plan
    also = joins.or_join(a, b, [("l1", "r1"), ("l3", "r3")], also=[("l2", "r2")])
    assert sorted(map(tuple, also.select("id", "rid").collect())) == [(1, 10), (5, 10), (5, 10)]


def test_typed_lookup_is_one_join(spark, no_broadcast):
    df = spark.createDataFrame([(i, f"N{i % 5}", i % 4) for i in range(40)], "id long, number string, code int")
    sales = spark.createDataFrame([(f"N{i}", f"sale {i}") for i in range(3)], "s_number string, sale string")
    buys = spark.createDataFrame([(f"N{i}", f"buy {i}") for i in (2, 3, 3)], "b_number string, buy string")
    targets = [(sales, "s_number", [0, 9]), (buys, "b_number", [1])]
    got = joins.typed_lookup(df, "number", "code", targets)
    assert plan_of(got).count("SortMergeJoin") == 1 and got.columns == [*df.columns, "sale", "buy"]
    want = []
    for i in range(40):
        n, code = i % 5, i % 4
        sale, buy = f"sale {n}" if code == 0 and n < 3 else None, f"buy {n}" if code == 1 and n in (2, 3) else None
        want += [(i, sale, buy)] * (2 if buy and n == 3 else 1)
    assert sorted(map(tuple, got.select("id", "sale", "buy").collect()), key=str) == sorted(want, key=str)
    # A type that points to two targets is looked up in both.
    both = joins.typed_lookup(df, "number", "code", [(sales, "s_number", [0]), (buys, "b_number", [0])])
    assert both.filter("id = 12").select("sale", "buy").collect() == [("sale 2", "buy 2")]


def test_lists_as_arrays(spark):
    from stockledger.operators.aggs import list_distinct

    df = spark.createDataFrame([(1, 10), (1, 9), (1, 10), (2, None)], "k long, n int")
    got = df.groupBy("k").agg(list_distinct(F.col("n")).alias("text"), list_distinct(F.col("n"), array=True).alias("values"))
    assert {r.k: (r.text, r["values"]) for r in got.collect()} == {1: ("10, 9", [9, 10]), 2: (None, None)}

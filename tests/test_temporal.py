"""As-of lookups and range sums against their naive SQL forms."""

import random
from datetime import date, datetime, timedelta

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from stockledger.operators import scan, temporal
from stockledger.sources.demo import role


def day(n):
    return date(2024, 1, 1) + timedelta(days=n)


@pytest.fixture(scope="module")
def prices(spark):
    data = [("a", day(2), 10, 1), ("a", day(5), 20, 2), ("a", day(5), 15, 3), ("b", day(4), 7, 4), (None, day(1), 99, 5)]
    return spark.createDataFrame(data, "part string, price_day date, price int, price_id long")


@pytest.mark.parametrize("dedupe", [True, False])
@pytest.mark.parametrize("cells", [None, lambda t: scan.time_cells(t, "day")])
def test_asof_edges(spark, prices, dedupe, cells):
    data = [(1, "a", day(1)), (2, "a", day(2)), (3, "a", day(4)), (4, "a", day(5)), (5, "a", day(5)), (6, "c", day(9)), (7, "b", day(9))]
    left = spark.createDataFrame(data, "id long, part string, at date")
    got = temporal.asof_join(left, prices, ["part"], "at", "price_day", ["price"], tie=["price_id"], cells=cells, dedupe=dedupe)
    # Equal time counts, the higher tie wins, rows of equal key and time both get it.
    assert rows(got, "id", "price") == [(1, None), (2, 10), (3, 10), (4, 15), (5, 15), (6, None), (7, 7)]


def test_asof_null_key_and_time_find_nothing(spark, prices):
    left = spark.createDataFrame([(1, None, day(3)), (2, "a", None)], "id long, part string, at date")
    got = temporal.asof_join(left, prices, ["part"], "at", "price_day", ["price"])
    assert rows(got, "id", "price") == [(1, None), (2, None)]


def test_asof_refuses_a_taken_column_name(spark, prices):
    with pytest.raises(ValueError):
        temporal.asof_join(prices, prices, ["part"], "price_day", "price_day", ["price"])


def test_asof_equals_naive_on_test_data(spark, sf):
    counts, price = role(spark, sf, "v_count"), role(spark, sf, "v_price")
    got = temporal.asof_join(
        counts, price, ["part_id"], "delivery_date", "price_ts", ["new_price"], cells=lambda t: scan.time_cells(t, "month")
    )
    counts.createOrReplaceTempView("naive_counts")
    price.createOrReplaceTempView("naive_prices")
    want = spark.sql(
        """select c.part_id, c.location_name, c.delivery_date, max_by(p.new_price, p.price_ts) as new_price
        from naive_counts c left join naive_prices p on p.part_id = c.part_id and p.price_ts <= c.delivery_date
        group by c.part_id, c.location_name, c.delivery_date"""
    )
    columns = ["part_id", "location_name", "delivery_date", "new_price"]
    assert rows(got, *columns) == rows(want, *columns)


def test_asof_max_by_takes_the_latest_recorded(spark):
    counts = spark.createDataFrame(
        [("a", day(1), 5, 1), ("a", day(3), 4, 2), ("a", day(6), 9, 3)], "part string, effective date, recorded int, balance int"
    )
    left = spark.createDataFrame([("a", day(n)) for n in (0, 2, 4, 6)], "part string, day date")
    got = temporal.asof_max_by(left, counts, ["part"], "day", "effective", ["recorded"], ["balance"])
    # The count of day 3 was recorded before that of day 1, so it never shows.
    assert rows(got, "day", "balance") == [(day(0), None), (day(2), 1), (day(4), 1), (day(6), 3)]


@pytest.mark.parametrize("side", ["from", "until"])
@pytest.mark.parametrize("cells", [None, lambda t: scan.time_cells(t, "day")])
def test_sum_in_range_equals_brute_force(spark, side, cells):
    dice = random.Random(3)
    facts = [(dice.choice("ab"), day(dice.randrange(9)), dice.randrange(-5, 6)) for _ in range(200)]
    points = [(i, dice.choice(["a", "b", "c", None]), dice.choice([None, *map(day, range(9))])) for i in range(60)]
    got = temporal.sum_in_range(
        spark.createDataFrame(points, "id long, part string, at date"),
        spark.createDataFrame(facts, "part string, at_fact date, amount long"),
        ["part"],
        "at",
        "at_fact",
        {"total": F.col("amount")},
        side,
        cells,
    )

    def brute(part, at):
        if part is None or at is None:
            return 0
        return sum(a for p, t, a in facts if p == part and (t >= at if side == "from" else t <= at))

    assert sorted(rows(got, "id", "total")) == [(i, brute(p, t)) for i, p, t in points]


def test_sum_since_mark_equals_brute_force(spark):
    dice = random.Random(11)
    base = datetime(2024, 1, 1)
    facts, points = [], []
    for i in range(300):
        recorded = base + timedelta(hours=dice.randrange(24 * 12))
        effective = datetime(recorded.year, recorded.month, recorded.day) - timedelta(days=dice.randrange(3))
        facts.append((i, dice.choice("ab"), recorded, effective, dice.randrange(-4, 5)))
    for part in "abc":
        mark = None
        for n in range(12):
            if part != "c" and dice.random() < 0.4 and n > 2:
                fresh = base + timedelta(hours=dice.randrange(24 * (n + 1)))
                mark = fresh if mark is None else max(mark, fresh)
            points.append((part, day(n), mark))
    got = temporal.sum_since_mark(
        spark.createDataFrame(points, "part string, day date, since timestamp"),
        spark.createDataFrame(facts, "id long, part string, recorded timestamp, effective timestamp, amount long"),
        ["part"], "day", "since", "id", "recorded", "effective", "amount", "total",
    )
    want = []
    for part, d, mark in points:
        total = sum(
            a for _, p, rec, eff, a in facts
            if p == part and ((rec >= mark and eff.date() <= d) if mark else eff.date() == d)
        )
        want.append((part, d, total))
    assert sorted(rows(got, "part", "day", "total")) == sorted(want)


def test_latest_version_keeps_ties_and_drops_null_keys(spark):
    data = [(1, "a", 1), (2, "a", 2), (3, "a", 2), (4, None, 5), (5, "b", None)]
    df = spark.createDataFrame(data, "id long, key string, version int")
    assert rows(temporal.latest_version(df, ["key"], "version"), "id") == [(2,), (3,)]


def test_first_match_needs_an_order(spark, prices):
    with pytest.raises(ValueError):
        temporal.first_match(prices, ["part"], [])


def test_latest_per_group_prunes_before_the_shuffle(spark, sf):
    counts = role(spark, sf, "v_movement")
    plan = plan_of(temporal.latest_per_group(counts, ["part_id"], [F.col("logging_ts").desc()]))
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    assert "Partial" in plan[plan.rindex("WindowGroupLimit"):]


def test_no_nested_loops(spark, sf, no_broadcast):
    movement = role(spark, sf, "v_movement")
    points = movement.filter("type_code = 4")
    by_day = lambda t: scan.time_cells(t, "day")
    plans = [
        temporal.asof_join(points, role(spark, sf, "v_price"), ["part_id"], "logging_ts", "price_ts", ["new_price"], cells=by_day),
        temporal.asof_max_by(
            points.select("part_id", "delivery_date"), movement, ["part_id"], "delivery_date", "delivery_date",
            ["logging_ts"], ["balance_change"], cells=by_day,
        ),
        temporal.sum_in_range(
            points, movement, ["part_id"], "logging_ts", "logging_ts", {"s": F.col("balance_change")}, cells=by_day
        ),
    ]
    for df in plans:
        text = plan_of(df)
        assert "NestedLoop" not in text and "Cartesian" not in text and "SinglePartition" not in text

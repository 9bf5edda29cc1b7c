"""Running values: cell-wise scans must equal plain windows."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from stockledger.operators import scan


@pytest.fixture(scope="module")
def ledger(spark):
    """600 rows over four keys (one NULL), one key holding most rows, many equal days."""
    dice = random.Random(7)
    start = datetime(2024, 1, 1)
    data = []
    for i in range(600):
        key = dice.choice(["hot"] * 6 + ["a", "b", None])
        at = start + timedelta(days=dice.randrange(6), minutes=dice.randrange(3))
        amount = dice.choice([None, *range(-5, 6)])
        data.append((i, key, at, amount))
    return spark.createDataFrame(data, "id long, key string, at timestamp, amount long").cache()


CELLS = {
    "none": None,
    "day": lambda: scan.time_cells("at", "day"),
    "day and minute": lambda: scan.time_cells("at", "day", "minute"),
    "time and id": lambda: scan.order_cells(["at", "far"]),
    "day, time and id": lambda: scan.order_cells(["at", "far"], "day"),
    "even": lambda: scan.EvenCells(20),
    "even, few": lambda: scan.EvenCells(20, 3),
    "even, of small keys": lambda: scan.EvenCells(10_000),
}


def _cells(name, order):
    build = CELLS[name]
    return build() if build else None


@pytest.mark.parametrize("cells", CELLS)
@pytest.mark.parametrize("reverse", [False, True])
@pytest.mark.parametrize("keys", [["key"], []])
def test_scan_equals_window(ledger, cells, reverse, keys):
    order = ["at", "far"]
    # Ids that fall as the day goes on, sparse over 62 bits.
    df = ledger.withColumn("far", F.pmod(F.xxhash64("id"), F.lit(1 << 62)))
    values = {
        "total": scan.running_sum(F.col("amount")),
        "highest": scan.running_max(F.col("amount")),
        "newest": scan.running_last(F.col("amount")),
    }
    got = scan.scan(df, keys, order, values, _cells(cells, order), reverse)
    by = [F.col(c).desc() if reverse else F.col(c) for c in order]
    window = Window.partitionBy(*keys).orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumns(
        {
            "total": F.sum("amount").over(window),
            "highest": F.max("amount").over(window),
            "newest": F.last("amount", ignorenulls=True).over(window),
        }
    )
    assert rows(got, "id", *values) == rows(want, "id", *values)


def test_peers_share_a_value(ledger):
    got = scan.scan(
        ledger, ["key"], ["at"], {"total": scan.running_sum(F.col("amount"))}, scan.time_cells("at", "day"), peers=True
    )
    window = Window.partitionBy("key").orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    assert rows(got, "id", "total") == rows(ledger.withColumn("total", F.sum("amount").over(window)), "id", "total")


def test_basis_may_be_narrow(ledger):
    wide = ledger.withColumn("note", F.lit("x"))
    got = scan.scan(
        wide, ["key"], ["at", "id"], {"total": scan.running_sum(F.col("amount"))}, scan.time_cells("at", "day"), basis=ledger
    )
    want = scan.running_total(ledger, ["key"], ["at", "id"], "amount", "total")
    assert rows(got, "id", "total") == rows(want, "id", "total")
    assert got.columns == [*wide.columns, "total"]


def test_rows_of_a_hot_key_are_spread(ledger):
    """With cells, no task sees more rows than a (key, cell) group has."""
    spread = ledger.withColumns(scan.time_cells("at", "day"))
    largest = spread.groupBy("key", "__cell_day").count().agg(F.max("count")).first()[0]
    hot = ledger.filter("key = 'hot'").count()
    assert hot > 300 and largest < hot / 3


def _groups(df, keys, order, even):
    """Rows of each (key, cell) group that a window would get."""
    cuts = even.cuts(df, keys, order)
    if cuts is None:
        return [r[0] for r in df.groupBy(*keys).count().select("count").collect()]
    frame, keys = (df, keys) if keys else (scan._one_key(df, order), [scan._ALL])
    return [r[0] for r in cuts.placed(frame, keys, order).groupBy(*keys, "__cell").count().select("count").collect()]


def test_even_cells_cut_a_key_where_its_rows_are(spark):
    """A third of all rows in one second of one key; the rest over a year and many keys."""
    second = F.timestamp_seconds(F.lit(1_700_000_000) + F.rand(3))
    year = F.timestamp_seconds(F.lit(1_690_000_000) + F.rand(4) * 31_000_000)
    df = spark.range(90_000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 500).alias("key"), F.when(F.col("id") % 3 == 0, second).otherwise(year).alias("at")
    )
    found = _groups(df, ["key"], ["at", "id"], scan.EvenCells(1_000))
    assert sum(found) == 90_000 and max(found) < 2_500 and len(found) < 500 + 60
    # One sequence over all rows, and one whose ids alone tell the rows apart.
    assert max(_groups(df, [], ["at", "id"], scan.EvenCells(2_000))) < 0.05 * 90_000
    assert max(_groups(df.withColumn("at", F.lit(0)), [], ["at", "id"], scan.EvenCells(2_000))) < 0.05 * 90_000
    # No more cells than asked for: they hold more rows instead.
    assert len(_groups(df, [], ["at", "id"], scan.EvenCells(100, 20))) <= 21 + 5
    # Keys of few rows stay whole.
    assert len(_groups(df, ["key"], ["at", "id"], scan.EvenCells())) == 501


def test_even_cells_take_null_orders_and_keys(spark):
    data = [(i, None if i % 4 == 0 else i % 7, None if i % 5 == 0 else i % 11, i % 3) for i in range(400)]
    df = spark.createDataFrame(data, "id long, key long, at long, amount long")
    for reverse in (False, True):
        got = scan.scan(df, ["key"], ["at", "id"], {"total": scan.running_sum(F.col("amount"))}, scan.EvenCells(10), reverse)
        by = [F.col(c).desc() if reverse else F.col(c) for c in ("at", "id")]
        window = Window.partitionBy("key").orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
        assert rows(got, "id", "total") == rows(df.withColumn("total", F.sum("amount").over(window)), "id", "total")


def test_exclusive_scan_leaves_out_the_row_itself(spark):
    df = spark.createDataFrame([(i, i * i) for i in range(60)], "id long, n long")
    for cells in (None, scan.EvenCells(5)):
        got = scan.scan(df, [], ["id"], {"before": scan.running_sum(F.col("n"))}, cells, inclusive=False)
        assert sorted(map(tuple, got.select("id", "before").collect())) == [(i, sum(k * k for k in range(i)) if i else None) for i in range(60)]


def test_fill_gaps_over_crowded_points(spark):
    """Islands and steps by points of time, numbers by the whole order; few points of many rows each."""
    dice = random.Random(4)
    data = [(i, i % 9, str(i) if dice.random() < 0.3 else None) for i in range(300)]
    df = spark.createDataFrame(data, "id long, at long, number string")
    plain = Window.orderBy("at", "id").rowsBetween(Window.unboundedPreceding, 0)
    named, missing = F.when(F.col("number").isNull(), 0).otherwise(1), F.when(F.col("number").isNull(), 1).otherwise(0)
    ranged = Window.orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    want = df.withColumns({"island": F.sum(named).over(ranged), "previous_number": F.last("number", True).over(plain)})
    want = want.withColumn("next_number", F.last("number", True).over(Window.orderBy(F.desc("at"), F.desc("id")).rowsBetween(Window.unboundedPreceding, 0)))
    inside = Window.partitionBy("island")
    want = want.withColumns(
        {
            "steps_after": F.when(F.col("number").isNull(), F.sum(missing).over(inside.orderBy("at").rangeBetween(Window.unboundedPreceding, 0))),
            "steps_before": F.when(F.col("number").isNull(), F.sum(missing).over(inside.orderBy(F.desc("at")).rangeBetween(Window.unboundedPreceding, 0))),
        }
    )
    columns = ["id", "island", "previous_number", "next_number", "steps_after", "steps_before"]
    for cells in (None, scan.EvenCells(30)):
        assert rows(scan.fill_gaps(df, [], ["at", "id"], "number", cells, peers=["at"]), *columns) == rows(want, *columns)


def test_fill_forward_and_backward(spark):
    data = [(1, None), (2, "a"), (3, None), (4, None), (5, "b"), (6, None)]
    df = spark.createDataFrame(data, "id long, number string").withColumn("cell", F.floor(F.col("id") / 2))
    cells = {"c": F.col("cell")}
    forward = scan.fill_forward(df, [], ["id"], "number", "filled", cells)
    assert rows(forward, "id", "filled") == [(1, None), (2, "a"), (3, "a"), (4, "a"), (5, "b"), (6, "b")]
    backward = scan.fill_backward(df, [], ["id"], "number", "filled", cells)
    assert rows(backward, "id", "filled") == [(1, "a"), (2, "a"), (3, "b"), (4, "b"), (5, "b"), (6, None)]


@pytest.mark.parametrize("cells", [None, {"c": F.floor}])
def test_fill_gaps_at_start_middle_and_end(spark, cells):
    numbers = [None, None, "10", None, None, "13", "14", None]
    df = spark.createDataFrame(list(enumerate(numbers)), "id long, number string")
    split = {"c": F.floor(F.col("id") / 2)} if cells else None
    got = scan.fill_gaps(df, [], ["id"], "number", split)
    assert rows(got, "id", "island", "previous_number", "next_number", "steps_after", "steps_before") == [
        (0, 0, None, "10", 1, 2),
        (1, 0, None, "10", 2, 1),
        (2, 1, "10", "10", None, None),
        (3, 1, "10", "13", 1, 2),
        (4, 1, "10", "13", 2, 1),
        (5, 2, "13", "13", None, None),
        (6, 3, "14", "14", None, None),
        (7, 3, "14", None, 1, 1),
    ]


def test_fill_gaps_per_key_with_null_key_and_without_numbers(spark):
    data = [(1, "a", None), (2, "a", "5"), (3, None, "7"), (4, None, None), (5, "b", None)]
    df = spark.createDataFrame(data, "id long, key string, number string")
    got = scan.fill_gaps(df, ["key"], ["id"], "number")
    assert rows(got, "id", "previous_number", "next_number", "steps_after", "steps_before") == [
        (1, None, "5", 1, 1),
        (2, "5", "5", None, None),
        (3, "7", "7", None, None),
        (4, "7", None, 1, 1),
        (5, None, None, 1, 1),
    ]

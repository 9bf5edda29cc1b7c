"""Lookups in time: latest row, as-of row, sums over a range that differs per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockledger.functions.dates import day_of, day_start
from stockledger.operators.joins import salted_join
from stockledger.operators.scan import EvenCells, running_last, running_max, running_sum, scan

_T, _SIDE, _VALUE = "__t", "__side", "__value"


def latest_per_group(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row of every group in ``order`` (pass descending columns for the latest one).

    The row-number filter lets Spark keep one row per key and task before the shuffle.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1").drop("__rank")


def first_match(df: DataFrame, keys: list[str], order_by: list[Column]) -> DataFrame:
    """"Any one row" per key made repeatable: the order is required."""
    if not order_by:
        raise ValueError("first_match needs an order")
    return latest_per_group(df, keys, order_by)


def outer_apply_top1(left: DataFrame, right: DataFrame, on: list[str], order_by: list[Column]) -> DataFrame:
    """Each left row with the first right row of its key, or with NULLs."""
    return left.join(first_match(right, on, order_by), on, "left")


def first_match_join(
    left: DataFrame, links: DataFrame, on: str, target: str, order_by: list[Column], right: DataFrame, right_key: str
) -> DataFrame:
    """Left rows joined to ``right`` through one id picked per key from ``links``."""
    picked = first_match(links.select(on, target), [on], order_by)
    return left.join(picked, on, "left").join(right, F.col(target) == F.col(right_key), "left")


def latest_version(df: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Rows whose ``version`` is the highest of their key; ties are all kept, NULL keys and versions drop out.

    The input is read once, and the rank lets Spark drop lower versions of a task before the shuffle.
    """
    window = Window.partitionBy(*keys).orderBy(F.col(version).desc())
    known = df.filter(_not_null([*keys, version]))
    return known.withColumn("__rank", F.rank().over(window)).filter("__rank = 1").drop("__rank")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    left_time: str,
    right_time: str,
    values: list[str],
    tie: list[str] | None = None,
    cells=None,
    dedupe: bool = True,
) -> DataFrame:
    """Left rows with the ``values`` of the last right row at or before ``left_time``.

    Among right rows of the same time the one with the greatest ``tie`` (then values) wins. Both
    sides shrink first: the right side to one row per key and time, the left side to its distinct
    points, which are joined back at the end. With ``dedupe=False`` the left rows themselves are
    scanned, which saves that join; use it where a key has few left rows, and no NULL in key or
    time.

    After that a key has at most one row per point in time and side. For times that are whole days
    this bounds the group by the days of the data, however many rows the key has. For finer times
    pass ``cells`` (``EvenCells``, or a function of the time column name) to split hot keys.
    """
    best = F.max(F.struct(*(tie or []), *values))
    steps = right.groupBy(*on, F.col(right_time).alias(_T)).agg(best.alias(_VALUE))
    return _lookup(left, steps, on, left_time, values, running_last, cells, dedupe)


def asof_max_by(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    left_time: str,
    right_time: str,
    by: list[str],
    values: list[str],
    cells=None,
    dedupe: bool = True,
) -> DataFrame:
    """Among right rows with ``right_time <= left_time``, the values of the one greatest in ``by``."""
    best = F.max(F.struct(*by, *values))
    steps = right.groupBy(*on, F.col(right_time).alias(_T)).agg(best.alias(_VALUE))
    return _lookup(left, steps, on, left_time, values, running_max, cells, dedupe)


def _lookup(left, steps, on, left_time, values, running, cells, dedupe):
    taken = [c for c in values if c in left.columns]
    if taken:
        raise ValueError(f"columns already on the left side: {taken}")
    if dedupe:
        points = left.select(*on, F.col(left_time).alias(_T)).filter(_not_null([*on, _T])).distinct()
    else:
        points = left.withColumn(_T, F.col(left_time))
    steps = steps.filter(_not_null([*on, _T])).withColumn(_SIDE, F.lit(0))
    both = points.withColumn(_SIDE, F.lit(1)).unionByName(steps, allowMissingColumns=True)
    where = points.select(*on, _T).withColumn(_SIDE, F.lit(1)).unionByName(steps, allowMissingColumns=True)
    found = (
        scan(both, on, [_T, _SIDE], {"__found": running(F.col(_VALUE))}, _cells(cells), basis=where)
        .filter(F.col(_SIDE) == 1)
        .withColumns({v: F.col("__found")[v] for v in values})
        .drop(_SIDE, _VALUE, "__found")
    )
    if not dedupe:
        return found.drop(_T)
    return left.join(found.withColumnRenamed(_T, left_time), [*on, left_time], "left")


def sum_in_range(
    points: DataFrame,
    facts: DataFrame,
    on: list[str],
    point_time: str,
    fact_time: str,
    sums: dict[str, Column],
    side: str = "from",
    cells=EvenCells(),
    combine: bool = False,
) -> DataFrame:
    """Sums of the facts at or after (``side="from"``) or up to (``"until"``) each point's time.

    A range condition in a join compares every point of a key with every fact of it. Here both
    are put on one time axis and a running sum is read off at the points, so the work grows with
    the rows and not with their product, and every row is shuffled once. Constant bounds belong in a
    filter on ``facts``. Points without any fact get 0; points with no time or key get 0 as well, as an
    empty range does, and are spread over the tasks.

    ``cells`` cut hot keys, but never rows of one time. Where many facts share a time, as whole days
    do, set ``combine``: they are summed per key and time first.
    """
    if side not in ("from", "until"):
        raise ValueError("side is 'from' or 'until'")
    backwards = side == "from"
    axis = facts.select(*on, F.col(fact_time).alias(_T), *[c.alias(f"__sum_{n}") for n, c in sums.items()])
    steps = axis.filter(_not_null([*on, _T]))
    if combine:
        steps = steps.groupBy(*on, _T).agg(*[F.sum(f"__sum_{n}").alias(f"__sum_{n}") for n in sums])
    lost = F.pmod(F.xxhash64(*[c for c, kind in points.dtypes if "map<" not in kind]), F.lit(4096)) + 1
    asked = points.withColumns(
        {
            _T: F.col(point_time),
            _SIDE: F.lit(0 if backwards else 1),
            "__lost": F.when(_not_null([*on, point_time]), F.lit(0)).otherwise(lost).cast("long"),
        }
    )
    known = steps.withColumns({_SIDE: F.lit(1 if backwards else 0), "__lost": F.lit(0).cast("long")})
    totals = scan(
        asked.unionByName(known, allowMissingColumns=True),
        [*on, "__lost"],
        [_T, _SIDE],
        {n: running_sum(F.col(f"__sum_{n}")) for n in sums},
        _cells(cells),
        reverse=backwards,
    ).filter(F.col(_SIDE) == (0 if backwards else 1))
    total = {n: F.when(F.col("__lost") == 0, F.coalesce(F.col(n), F.lit(0))).otherwise(F.lit(0)) for n in sums}
    return totals.select(*points.columns, *[c.alias(n) for n, c in total.items()])


def _cells(cells):
    return cells if cells is None or isinstance(cells, EvenCells) else cells(_T)


def _not_null(columns: list[str]) -> Column:
    condition = F.lit(True)
    for c in columns:
        condition = condition & F.col(c).isNotNull()
    return condition


def sum_since_mark(
    points: DataFrame,
    facts: DataFrame,
    on: list[str],
    day: str,
    since: str,
    fact_id: str,
    recorded: str,
    effective: str,
    amount: str,
    out: str,
    zone: str | None = None,
) -> DataFrame:
    """Per key and day: the sum of the facts recorded at or after the day's mark and in effect by
    the end of the day (of ``zone``, else the session's). Days without a mark sum the facts in effect on that day only.

    ``points`` is unique per key and day and its mark ``since`` never goes back as the days go on,
    which an as-of lookup guarantees. A fact then counts on one run of days: from the day it takes
    effect to the day before the first later mark. So it adds its amount at the front of the run
    and takes it off behind the end, and a running sum over the days gives the result. That is at
    most two small rows per fact instead of one per fact and day. The first later mark of a fact is a
    lookup on one axis of recording times.

    Only the facts that can count are shuffled: those recorded at or after the least mark of their key,
    and those in effect on a day that has no mark. The first need both of their times, the others the
    time of effect alone.
    """
    marked = points.filter(F.col(since).isNotNull())
    # As many entries per key as it has marks, which is at most its number of days.
    marks = marked.groupBy(*on, since).agg(F.min(day).alias("first_day"))
    runs = marks.groupBy(*on).agg(F.min("first_day").alias("__first"), F.min(since).alias("__least"))
    effect = day_of(F.col(effective), zone)
    # The least mark of all keys reaches the scan of the facts, that of a key their join.
    since_least = F.col(recorded) >= runs.select(F.min("__least")).scalar()
    recent = facts.filter(_not_null([recorded, effective]) & since_least)
    recent = salted_join(recent, runs, on, fact_id).filter(F.col(recorded) >= F.col("__least"))
    # Facts of one time of recording and one day of effect are alike: one row for all of them.
    alike = recent.groupBy(*on, F.col(recorded).alias(_T), effect.alias("__effect"), "__first").agg(F.sum(amount).alias("__amount"))
    axis = alike.withColumn(_SIDE, F.lit(1)).unionByName(
        marks.select(*on, F.col(since).alias(_T), "first_day").withColumn(_SIDE, F.lit(0)), allowMissingColumns=True
    )
    located = (
        scan(axis, on, [_T, _SIDE], {"__until": running_last(F.col("first_day"))}, EvenCells(), reverse=True)
        .filter(F.col(_SIDE) == 1)
        .withColumn("__from", F.greatest("__effect", "__first"))
        .filter(F.col("__until").isNull() | (F.col("__from") < F.col("__until")))
    )
    steps = (
        located.select(
            *on,
            F.explode(
                F.array(
                    F.struct(F.col("__from").alias("day"), F.col("__amount").alias("amount")),
                    F.struct(F.col("__until").alias("day"), (-F.col("__amount")).alias("amount")),
                )
            ).alias("step"),
        )
        .filter("step.day is not null")
        .groupBy(*on, F.col("step.day").alias(_T))
        .agg(F.sum("step.amount").alias(_VALUE))
    )
    both = (
        marked.select(*on, F.col(day).alias(_T))
        .withColumn(_SIDE, F.lit(1))
        .unionByName(steps.withColumn(_SIDE, F.lit(0)), allowMissingColumns=True)
    )
    since_mark = (
        scan(both, on, [_T, _SIDE], {"__run": running_sum(F.col(_VALUE))})
        .filter(F.col(_SIDE) == 1)
        .select(*on, F.col(_T).alias(day), "__run")
    )
    # Days without a mark: the facts of these days alone.
    bare = points.filter(F.col(since).isNull()).select(*on, F.col(day).cast("date").alias(day))
    ends = bare.agg(day_start(F.min(day), zone).alias("__low"), day_start(F.date_add(F.max(day), 1), zone).alias("__high"))
    within = (F.col(effective) >= ends.select("__low").scalar()) & (F.col(effective) < ends.select("__high").scalar())
    on_day = facts.filter(within).groupBy(*on, effect.alias(day)).agg(F.sum(amount).alias("__day"))
    total = F.when(F.col(since).isNull(), F.col("__day")).otherwise(F.col("__run"))
    return (
        points.join(since_mark, [*on, day], "left")
        .join(on_day, [*on, day], "left")
        .withColumn(out, F.coalesce(total, F.lit(0)))
        .drop("__run", "__day")
    )

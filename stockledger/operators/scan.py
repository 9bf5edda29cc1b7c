"""Running values over an ordered group of any size.

A plain ``Window.partitionBy(key)`` puts every row of a key into one task, so one hot key stops
the job. Here the order axis is cut into *cells* (for example the day, or the day and a slice of
row ids): each (key, cell) is its own window partition, and what earlier cells contribute enters a
cell as one extra leading row. The cell totals come from a normal aggregate, which Spark combines
before the shuffle. Nothing is joined back: rows and carry rows meet in the one exchange the
window needs anyway.

With several cell columns the carry is itself scanned cell by cell, coarse to fine. ``EvenCells``
cut the order where the rows are: keys of few rows stay whole and cost one count, and a large one gets
as many cells as its rows need, whatever its calendar looks like.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_IS_ROW = "__is_row"
_CELL, _BLOCK, _ORDER, _ALL = "__cell", "__block", "__order", "__all"

#: Rows of a key beyond which it is cut, and about the rows of a cell.
CELL_ROWS = 1 << 18
#: Most cells of all keys together. Their cuts go to all tasks: one row of the order columns each.
MOST_CELLS = 1 << 14
_SAMPLES = 16
_FAN = 1 << 7


@dataclass(frozen=True)
class Running:
    """A running value: ``sum``, ``max`` or ``last`` (last non-null) of ``column``."""

    kind: str
    column: Column

    def over(self, column: Column, window) -> Column:
        if self.kind == "sum":
            return F.sum(column).over(window)
        if self.kind == "max":
            return F.max(column).over(window)
        return F.last(column, ignorenulls=True).over(window)

    def total(self, column: Column, order: list[str], reverse: bool) -> Column:
        if self.kind == "sum":
            return F.sum(column)
        if self.kind == "max":
            return F.max(column)
        pick = F.min_by if reverse else F.max_by
        return pick(column, F.when(column.isNotNull(), F.struct(*order)))


def running_sum(column: Column) -> Running:
    return Running("sum", column)


def running_max(column: Column) -> Running:
    return Running("max", column)


def running_last(column: Column) -> Running:
    return Running("last", column)


@dataclass(frozen=True)
class EvenCells:
    """Cells of about ``rows`` rows for every key that has more.

    One job counts the rows per key. Without a larger key that is all, and the scan is a plain window.
    Otherwise a second job takes a sample of the orders of these keys, picked by hash and about 16 to a
    cell, and every 16th of them in order is a cut. Only where to cut comes from the sample; all rows
    are scanned. Should the keys need more than ``most`` cells, cells hold more rows instead, which
    bounds the cuts the driver and the tasks hold. Rows of equal order are never parted.
    """

    rows: int = CELL_ROWS
    most: int = MOST_CELLS

    def cuts(self, df: DataFrame, keys: list[str], order: list[str]) -> Cuts | None:
        """The cuts for ``df``, to be used by several scans of these keys and this order; None where no key is large."""
        counts = df.groupBy(*keys).agg(F.count("*").alias("__n"))
        most, total = counts.agg(F.max("__n"), F.sum("__n")).first()
        size = max(float(self.rows), (total or 0) / self.most)
        if (most or 0) <= size:
            return None
        if not keys:
            df, keys = _one_key(df, order), [_ALL]
            counts = df.groupBy(*keys).agg(F.count("*").alias("__n"))
        # At most one key for each cell.
        large = F.broadcast(counts.filter(F.col("__n") > size).select(*[F.col(k).alias(f"__l_{k}") for k in keys]))
        picked = F.pmod(F.xxhash64(*keys, *order), F.lit(1 << 30)) < F.lit(float(_SAMPLES << 30) / size)
        sampled = df.select(*keys, F.struct(*order).alias("__o")).filter(picked).join(large, _same(keys), "left_semi")
        every = F.filter(F.sort_array(F.collect_list("__o")), lambda x, i: i % _SAMPLES == _SAMPLES - 1)
        cut = sampled.groupBy(*[F.col(k).alias(f"__l_{k}") for k in keys]).agg(every.alias("__c"))
        ends = F.transform(F.sequence(F.lit(0), F.size("__c")), lambda i: F.struct(F.get("__c", i - 1).alias("lo"), F.get("__c", i).alias("hi")))
        table = cut.select(*[f"__l_{k}" for k in keys], F.posexplode(ends).alias(_CELL, "__e")).select("*", "__e.lo", "__e.hi").drop("__e")
        return Cuts(df.sparkSession.createDataFrame(table.collect(), table.schema))


@dataclass(frozen=True)
class Cuts:
    """(keys, cell, lo, hi) of the large keys; a cell holds the orders from ``lo`` to before ``hi``."""

    table: DataFrame

    def placed(self, df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
        """``df`` with the cell of each row, NULL where the key has none: looked up by blocks of cells, then within the block."""
        named = [f"__l_{k}" for k in keys]
        cuts = self.table.withColumn(_BLOCK, F.floor(F.col(_CELL) / _FAN))
        blocks = cuts.groupBy(*named, _BLOCK).agg(F.min_by("lo", _CELL).alias("lo"), F.max_by("hi", _CELL).alias("hi"))
        inside = (F.col("lo").isNull() | (F.col("lo") <= F.col(_ORDER))) & (F.col("hi").isNull() | (F.col(_ORDER) < F.col("hi")))
        found = df.withColumn(_ORDER, F.struct(*order)).join(F.broadcast(blocks), [*_same(keys), inside], "left").drop(*named, "lo", "hi")
        own = cuts.withColumnRenamed(_BLOCK, "__b")
        return found.join(F.broadcast(own), [*_same(keys), F.col(_BLOCK) == F.col("__b"), inside], "left").drop(*named, "lo", "hi", "__b", _BLOCK, _ORDER)


def _one_key(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` as one key of all rows; not a literal, which no join takes as its key."""
    return df.withColumn(_ALL, F.pmod(F.xxhash64(order[0]), F.lit(1)))


def _same(keys: list[str]) -> list[Column]:
    return [F.col(k).eqNullSafe(F.col(f"__l_{k}")) for k in keys]


def scan(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    values: dict[str, Running],
    cells: dict[str, Column] | EvenCells | Cuts | None = None,
    reverse: bool = False,
    peers: bool = False,
    basis: DataFrame | None = None,
    inclusive: bool = True,
) -> DataFrame:
    """Adds one column per entry of ``values``: its running value per ``keys`` in ``order``.

    ``order`` should be total; rows it leaves tied are taken in any order, or together when ``peers``
    is set. ``reverse`` runs from the last row to the first. ``cells`` are ``EvenCells``, or names of
    expressions that never decrease along ``order``, coarse to fine (``time_cells``, ``order_cells``;
    then ``order`` must not contain NULLs); a group is split over as many tasks as it has cells.
    Without cells this is a plain window.

    Without ``inclusive`` a row's value is that of the rows before it.

    The cell totals read the input a second time. If ``df`` is expensive because of columns the
    totals do not need, give as ``basis`` the same rows without them.
    """
    inputs = {f"__in_{name}": value for name, value in values.items()}

    def tag(rows):
        tagged = rows.withColumns({c: v.column for c, v in inputs.items()})
        return tagged.withColumns(cells) if cells and not even else tagged

    columns = df.columns
    if isinstance(cells, EvenCells):
        cells = cells.cuts(df if basis is None else basis, keys, order)
    even = isinstance(cells, Cuts)
    if even and not keys:
        keys = [_ALL]
        df, basis = (None if x is None else _one_key(x, order) for x in (df, basis))
    rows, about = tag(df), None if basis is None else tag(basis)
    if even:
        rows, about = (None if x is None else cells.placed(x, keys, order) for x in (rows, about))
    names = [_CELL] if even else list(cells or {})
    result = _scan(rows, keys, order, inputs, names, reverse, peers, inclusive, about, even)
    kept = [F.col(c) for c in columns]
    return result.select(*kept, *[F.col(f"__out_{c}").alias(c[len("__in_"):]) for c in inputs])


def _scan(df, keys, order, inputs, cells, reverse, peers, inclusive, basis=None, even=False):
    def ordered(names):
        return [F.col(c).desc() if reverse else F.col(c).asc() for c in names]

    def frame(window):
        if peers and inclusive:
            return window.rangeBetween(Window.unboundedPreceding, Window.currentRow)
        return window.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)

    if not cells:
        window = frame(Window.partitionBy(*keys).orderBy(*ordered(order)))
        return df.withColumns({f"__out_{c}": v.over(F.col(c), window) for c, v in inputs.items()})

    source = df if basis is None else basis
    if even:  # the other keys have nothing to carry
        source = source.filter(F.col(_CELL).isNotNull())
    totals = source.groupBy(*keys, *cells).agg(*[v.total(F.col(c), order, reverse).alias(c) for c, v in inputs.items()])
    carry = _scan(totals, keys, cells, inputs, cells[:-1], reverse, False, False).select(
        *keys,
        *cells,
        *[F.col(f"__out_{c}").alias(c) for c in inputs],
        F.lit(0).alias(_IS_ROW),
    )
    rows = df.withColumn(_IS_ROW, F.lit(1)).unionByName(carry, allowMissingColumns=True)
    window = frame(Window.partitionBy(*keys, *cells).orderBy(_IS_ROW, *ordered(order)))
    return (
        rows.withColumns({f"__out_{c}": v.over(F.col(c), window) for c, v in inputs.items()})
        .filter(F.col(_IS_ROW) == 1)
        .drop(_IS_ROW)
    )


def time_cells(time: str, *grains: str, prefix: str = "__cell") -> dict[str, Column]:
    """Cells by calendar grain, coarse to fine, e.g. ``time_cells("ts", "day", "minute")``."""
    return {f"{prefix}_{g}": F.date_trunc(g, F.col(time)) for g in grains}


def order_cells(order: list[str], *grains: str) -> dict[str, Column]:
    """Cells for rows ordered by a time and then a long id, derived from the order itself.

    First the calendar grains of the time, then the exact time with the upper third of the id's bits,
    then the middle third. Ids are cut only below the exact time, so no cell decreases along the
    order. However sparse or dense the ids are, a cell and the cells within another are at most
    2**21 for one point in time.
    """
    time, row_id = order
    cells = time_cells(time, *grains)
    cells["__cell_time"] = F.struct(F.col(time).alias("time"), F.shiftright(F.col(row_id).cast("long"), 42).alias("high"))
    cells["__cell_slice"] = F.shiftright(F.col(row_id).cast("long"), 21)
    return cells


def running_total(df, keys, order, value: str, out: str, cells=None, reverse=False, basis=None) -> DataFrame:
    """Sum of ``value`` from the first row of the group to this one."""
    return scan(df, keys, order, {out: running_sum(F.col(value))}, cells, reverse, basis=basis)


def fill_forward(df, keys, order, value: str, out: str, cells=None) -> DataFrame:
    """Last non-null ``value`` at or before each row."""
    return scan(df, keys, order, {out: running_last(F.col(value))}, cells)


def fill_backward(df, keys, order, value: str, out: str, cells=None) -> DataFrame:
    """First non-null ``value`` at or after each row."""
    return scan(df, keys, order, {out: running_last(F.col(value))}, cells, reverse=True)


def fill_gaps(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    number: str,
    cells: dict[str, Column] | EvenCells | None = None,
    peers: list[str] | None = None,
) -> DataFrame:
    """Surroundings of every missing ``number`` in document order.

    With ``peers``, the leading columns of ``order``, rows that agree in them share their island and
    their steps, as in a window whose frame is a range; ``cells`` must not need the other columns.
    The numbers around a row still follow the whole order. A row with a number opens an island; the rows without one that follow belong to it (island 0
    is what comes before the first number). Adds ``island``, ``previous_number``, ``next_number``
    and, for rows without a number, ``steps_after`` and ``steps_before``: the position in the
    island counted from its front and from its back.

    Islands and steps are scanned over rows or, with peers, over one row per point, which is joined
    back; the numbers around a row are two fills. So no row waits for the others of its point.
    """
    missing = F.col(number).isNull()
    if isinstance(cells, EvenCells):  # cut once for the scans of the rows, and once for those of the points
        even, cells = cells, cells.cuts(df, keys, order)
    else:
        even = None
    named, gaps = F.when(missing, 0).otherwise(1).cast("long"), F.when(missing, 1).otherwise(0).cast("long")
    found = scan(df, keys, order, {"previous_number": running_last(F.col(number))}, cells)
    found = scan(found, keys, order, {"next_number": running_last(F.col(number))}, cells, reverse=True)
    if peers is None:
        found = _islands(found.withColumns({"__named": named, "__gaps": gaps}), keys, order, cells)
    else:
        points = df.groupBy(*keys, *peers).agg(F.sum(named).alias("__named"), F.sum(gaps).alias("__gaps"))
        found = _join_safe(found, _islands(points, keys, peers, even.cuts(points, keys, peers) if even else cells), [*keys, *peers], "left")
    steps = {"steps_after": F.col("__run") - F.col("__before"), "steps_before": F.col("__until") - F.col("__run") + F.col("__gaps")}
    found = found.withColumns({"island": F.col("__group"), **{c: F.when(missing, v) for c, v in steps.items()}})
    return found.select(*df.columns, "island", "previous_number", "next_number", "steps_after", "steps_before")


def _islands(df: DataFrame, keys: list[str], order: list[str], cells) -> DataFrame:
    """Of rows with ``__named`` numbers and ``__gaps``: the running counts ``__group`` and ``__run``, and the gaps
    counted before the row's island and until its end."""
    run = scan(df, keys, order, {"__group": running_sum(F.col("__named")), "__run": running_sum(F.col("__gaps"))}, cells)
    # An island starts with the gaps counted so far and ends with those counted when the next one starts.
    opens = F.when(F.col("__named") > 0, F.col("__run") - F.col("__gaps"))
    started = scan(run, keys, order, {"__before": running_last(opens)}, cells)
    # From the back, what the rows behind this one know: where the next island starts, or how many gaps there are.
    behind = {"__next": running_last(opens), "__most": running_max(F.col("__run"))}
    ahead = scan(started, keys, order, behind, cells, reverse=True, inclusive=False)
    return ahead.withColumns({"__before": F.coalesce("__before", F.lit(0)), "__until": F.coalesce("__next", "__most", "__run")})


def _join_safe(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    """Equi-join in which NULL keys match each other, as they do in ``groupBy``."""
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") if c in on else F.col(c) for c in right.columns])
    condition = [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in on]
    return left.join(renamed, condition, how).drop(*[f"__r_{c}" for c in on])

"""Aggregates: text lists, sums by sign or code, contra lists, pivots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def list_distinct(column: Column, separator: str = ", ", quote: str = "", array: bool = False) -> Column:
    """Distinct values as sorted text, e.g. ``'a', 'b'``, or with ``array`` as a sorted array of the values
    themselves. NULL if there is none.

    Duplicates are removed in every task before the shuffle, so what reaches the final row is
    only what the text shows.
    """
    if array:
        values = F.array_sort(F.collect_set(column))
        return F.when(F.size(values) > 0, values)
    text = column.cast("string")
    if quote:
        text = F.when(text.isNotNull(), F.concat(F.lit(quote), text, F.lit(quote)))
    values = F.array_sort(F.collect_set(text))
    return F.when(F.size(values) > 0, F.array_join(values, separator))


def signed_sums(column: Column, received: str, issued: str) -> list[Column]:
    """Two sums, of the positive and of the negative amounts."""
    zero = F.lit(0).cast("decimal(18,4)")
    return [
        F.sum(F.when(column > 0, column).otherwise(zero)).alias(received),
        F.sum(F.when(column < 0, column).otherwise(zero)).alias(issued),
    ]


def sum_by_group(column: Column, code: Column, groups: dict[str, list[int]]) -> list[Column]:
    """One sum per named group of codes."""
    zero = F.lit(0).cast("decimal(18,4)")
    return [
        F.sum(F.when(code.isin(codes) & column.isNotNull(), column).otherwise(zero)).alias(n) for n, codes in groups.items()
    ]


def contra_accounts(entries: DataFrame, voucher: str, account: str, debit: str, credit: str) -> DataFrame:
    """Adds ``credit_accounts`` and ``debit_accounts`` of the voucher to its entries, as sorted text.

    ``entries`` has one row per voucher and account, so a voucher has at most as many as the chart
    of accounts. They are packed per voucher, listed and unpacked again, which takes one shuffle
    and no join.
    """
    packed = entries.groupBy(voucher).agg(
        F.collect_list(F.struct(*[c for c in entries.columns if c != voucher])).alias("__entries")
    )

    def names(side):
        hits = F.filter("__entries", lambda e: (e[side] > 0) & e[account].isNotNull())
        found = F.array_sort(F.array_distinct(F.transform(hits, lambda e: e[account].cast("string"))))
        return F.when(F.size(found) > 0, F.array_join(found, ", "))

    listed = packed.select(
        voucher, names(credit).alias("credit_accounts"), names(debit).alias("debit_accounts"), "__entries"
    )
    return listed.select(voucher, "credit_accounts", "debit_accounts", F.inline("__entries"))


def pivot_measures(
    df: DataFrame, keys: list[str], column: str, values: list[str], measures: dict[str, Column], fill=0
) -> DataFrame:
    """Sums of several measures, one output column per value and measure: ``<value>_<measure>``.

    The values are given, so Spark needs no extra job to find them.
    """
    wide = df.groupBy(*keys).pivot(column, values).agg(*[F.sum(c).alias(n) for n, c in measures.items()])
    if len(measures) == 1:
        name = next(iter(measures))
        wide = wide.withColumnsRenamed({v: f"{v}_{name}" for v in values})
    names = [f"{v}_{m}" for v in values for m in measures]
    return wide.select(*keys, *[F.coalesce(F.col(n), F.lit(fill)).alias(n) if fill is not None else F.col(n) for n in names])

"""Joins that need more than one call: on either of two keys, on a prefix, by type code ..."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def or_join(
    left: DataFrame,
    right: DataFrame,
    either: list[tuple[str, str]],
    also: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """Inner join on ``l1 = r1 OR l2 = r2 ...`` (column names must differ between the sides).

    Spark runs an OR condition as a nested loop. Here every row stands once for each alternative whose key
    it has, and one join on (alternative, key) finds the pairs, so both sides are read once. A pair that an
    earlier alternative gives is left out of the later ones. ``also`` are equalities that hold in every
    alternative. A hot key is split by adaptive execution, as nothing is grouped behind the join.
    """

    def keyed(df: DataFrame, keys: list[str], side: str) -> DataFrame:
        present = F.array_compact(F.array(*[F.when(F.col(k).isNotNull(), F.lit(i)) for i, k in enumerate(keys)]))
        named = df.withColumn(f"__{side}", F.explode(present))
        return named.withColumns({f"__{side}{i}": F.when(F.col(f"__{side}") == i, F.col(k)) for i, k in enumerate(keys)})

    a, b = keyed(left, [x for x, _ in either], "a"), keyed(right, [y for _, y in either], "b")
    same = [F.col("__a") == F.col("__b"), *[F.col(f"__a{i}").eqNullSafe(F.col(f"__b{i}")) for i in range(len(either))]]
    same += [F.col(x) == F.col(y) for x, y in also or []]
    for i, (x, y) in enumerate(either[:-1]):
        same.append((F.col("__a") <= i) | ~F.coalesce(F.col(x) == F.col(y), F.lit(False)))
    return a.join(b, same, "inner").select(*left.columns, *right.columns)


def prefix_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_text: str,
    separator: str = "/",
    also: list[tuple[str, str]] | None = None,
    how: str = "inner",
) -> DataFrame:
    """Rows where ``right_text`` starts with ``left_key`` followed by the separator.

    The text is cut at its separators, which turns the LIKE into an equality. A text with several
    separators is tried at each of them.
    """
    pieces = F.split(F.col(right_text), f"[{separator}]", -1)
    cuts = F.transform(
        F.sequence(F.lit(1), F.size(pieces) - 1), lambda n: F.concat_ws(separator, F.slice(pieces, 1, n))
    )
    keyed = right.filter(F.col(right_text).contains(separator)).withColumn("__prefix", F.explode(cuts))
    condition = [F.col(left_key) == F.col("__prefix"), *[F.col(a) == F.col(b) for a, b in also or []]]
    return left.join(keyed, condition, how).drop("__prefix")


def typed_lookup(
    df: DataFrame,
    key: str,
    type_code: str,
    targets: list[tuple[DataFrame, str, list[int]]],
) -> DataFrame:
    """One text key that points into a different table depending on a type code.

    Each target is (table, its key column, type codes); the table's other columns are added. The
    key counts as NULL for other types, so no match is tried for them, and these rows are spread over
    the tasks of the join by a hash of all their columns.

    The targets are one relation keyed by (target, key), so ``df`` is shuffled once. Types that point to
    several targets, or targets that share a column name, take a join for each target.
    """
    codes = [c for _, _, own in targets for c in own]
    added = [c for table, table_key, _ in targets for c in table.columns if c != table_key]
    if len(targets) < 2 or len(set(codes)) < len(codes) or len(set(added)) < len(added):
        for table, table_key, own in targets:
            df = spread_left_join(df, table, F.when(F.col(type_code).isin(own), F.col(key)), table_key).drop(table_key)
        return df
    tagged = None
    for i, (table, table_key, _) in enumerate(targets):
        own = table.select(F.lit(i).alias("__target"), F.col(table_key).alias("__found"), *[c for c in table.columns if c != table_key])
        tagged = own if tagged is None else tagged.unionByName(own, allowMissingColumns=True)
    which = F.coalesce(*[F.when(F.col(type_code).isin(own), F.lit(i)) for i, (_, _, own) in enumerate(targets)])
    hit = F.when(which.isNotNull(), F.col(key))
    spread = F.pmod(F.xxhash64(*df.columns), F.lit(4096)).cast("int") + len(targets)
    asked = df.withColumns({"__hit": hit, "__tag": F.when(hit.isNotNull(), which).otherwise(spread)})
    return asked.join(tagged, (F.col("__hit") == F.col("__found")) & (F.col("__tag") == F.col("__target")), "left").select(*df.columns, *added)


def spread_left_join(df: DataFrame, table: DataFrame, hit: Column, table_key: str, parts: int = 4096) -> DataFrame:
    """Left join on ``hit == table_key`` in which rows without a key don't meet in one task.

    A second key is 0 where there is a key, and one of ``parts`` values otherwise.
    """
    df = df.withColumn("__hit", hit)
    spread = F.when(F.col("__hit").isNull(), F.pmod(F.xxhash64(*df.columns), F.lit(parts)) + 1).otherwise(F.lit(0))
    # Always 0, but not a literal, which would leave the second key out of the shuffle.
    keyed = table.withColumn("__zero", F.pmod(F.xxhash64(table_key), F.lit(1)))
    joined = df.withColumn("__spread", spread.cast("long"))
    return joined.join(keyed, (F.col("__hit") == F.col(table_key)) & (F.col("__spread") == F.col("__zero")), "left").drop("__hit", "__spread", "__zero")


def lookup_in(df: DataFrame, table: DataFrame, keys: list[str], table_key: str) -> DataFrame:
    """Left join on ``table_key IN (keys)``, for a table whose key is unique.

    One equi-join per key; a row gets one output row per table row found, or one with NULLs. A
    value that two keys share is looked up once.
    """
    columns = [c for c in table.columns if c != table_key]
    found = []
    for i, key in enumerate(keys):
        hit = F.col(key)
        for earlier in keys[:i]:
            hit = F.when(~F.col(key).eqNullSafe(F.col(earlier)), hit)
        side = table.select(F.col(table_key).alias("__key"), F.struct(*columns).alias(f"__found_{i}"))
        df = spread_left_join(df, side, hit, "__key").drop("__key")
        found.append(f"__found_{i}")
    hits = F.filter(F.array(*found), lambda x: x.isNotNull())
    df = df.withColumn("__hit", F.explode_outer(hits)).drop(*found)
    return df.withColumns({c: F.col("__hit")[c] for c in columns}).drop("__hit")


def attribute_lookup(
    df: DataFrame,
    attributes: DataFrame,
    key: str,
    parent: str,
    template: str,
    value: str,
    wanted: dict[str, int],
) -> DataFrame:
    """Custom fields stored one per row, added as columns: one aggregate and one join for all.

    A field with several values gives a row for each, as a join per field would. The lists are as
    long as the fields of one holder.
    """
    picked = attributes.filter(F.col(template).isin(list(wanted.values())) & F.col(value).isNotNull())
    wide = picked.groupBy(F.col(parent).alias("__parent")).agg(
        *[F.collect_list(F.when(F.col(template) == t, F.col(value))).alias(n) for n, t in wanted.items()]
    )
    for n in wanted:
        wide = wide.select(*[F.explode_outer(n).alias(n) if c == n else F.col(c) for c in wide.columns])
    return df.join(wide, F.col(key) == F.col("__parent"), "left").drop("__parent")


def not_in_scope(
    df: DataFrame,
    allowed: DataFrame,
    scope: tuple[str, str],
    value: tuple[str, str],
) -> DataFrame:
    """``value NOT IN (allowed values of the row's scope)`` with the SQL rules for NULL.

    An empty list keeps the row; a NULL in the list, or a NULL value against a non-empty list,
    drops it. ``scope`` and ``value`` are (column of df, column of allowed).
    """
    allowed = allowed.select(F.col(scope[1]).alias("__scope"), F.col(value[1]).alias("__value"))
    lists = allowed.groupBy("__scope").agg(F.max(F.col("__value").isNull()).alias("__has_null"))
    return (
        df.join(allowed, (F.col(scope[0]) == F.col("__scope")) & (F.col(value[0]) == F.col("__value")), "left_anti")
        .join(lists, F.col(scope[0]) == F.col("__scope"), "left")
        .filter(F.col("__scope").isNull() | (F.col(value[0]).isNotNull() & ~F.col("__has_null")))
        .drop("__scope", "__has_null")
    )


def salted_join(
    big: DataFrame, small: DataFrame, on: list[str], row_id: str, how: str = "inner", salts: int = 16
) -> DataFrame:
    """Join of many rows to one row per key, for a result that is then aggregated by the same key.

    Without the salt the aggregate would reuse the partitioning of the join, and Spark then cannot
    split a hot key. The salt spreads the rows of a key over ``salts`` tasks, each of which
    aggregates its share; the small side is repeated once per salt.
    """
    spread = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = big.withColumn("__salt", F.pmod(F.xxhash64(row_id), F.lit(salts)).cast("int"))
    return salted.join(spread, [*on, "__salt"], how).drop("__salt")


def pair_legs(df: DataFrame, keys: list[str], amount: str, out: list[str], incoming: dict[str, str]) -> DataFrame:
    """Outgoing legs (negative amount) with their incoming legs on equal keys, if any.

    ``out`` are the columns to keep of the outgoing leg, ``incoming`` maps columns of the incoming
    leg to their output names.
    """
    negative = df.filter(F.col(amount) < 0).select(*keys, *[c for c in out if c not in keys])
    positive = df.filter(F.col(amount) > 0).select(*keys, *[F.col(c).alias(n) for c, n in incoming.items()])
    return negative.join(positive, keys, "left")


def outer_apply_group(left: DataFrame, right: DataFrame, on: list[str], by: list[str], sums: dict[str, Column]) -> DataFrame:
    """Left rows with the right rows of their key summed ``by`` more columns; none gives NULLs."""
    grouped = right.groupBy(*on, *by).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    return left.join(grouped, on, "left")


def siblings(members: DataFrame, holder: str, member: str, out: str) -> DataFrame:
    """Ordered pairs of different members of one holder."""
    other = members.select(F.col(holder), F.col(member).alias(out))
    return members.join(other, holder).filter(F.col(member) != F.col(out))

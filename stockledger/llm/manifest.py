"""A Merkle tree over the rows of a dataset, kept as a store of digests and their children.

Rows are the leaves of a tree for each group (the language); the roots of these trees are the leaves of
one more tree. A record of the store is named by the digest of a node and holds what lies ``STEP`` levels
below it, up to 64 digests, from which the levels between follow. So trees are built and searched with one
shuffle per six levels, and records of like subtrees are one.

A proof is found from above: requests are ranks, grouped by their leading digits, and descend from the
root. A step joins the nodes that any request passes with the store by their digest, takes for each digit the
child, and collects the children it leaves beside it. Those are the path from the top; reversed they are the
siblings a leaf is folded with. Nodes near the root are one row each, whatever the number of requests below.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockledger.llm.store import staged

#: Levels a record spans. A task holds an Arrow batch of records at a time, 64 digests and a path each.
STEP = 6
_SLICE = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_TOP = ""  # the tree of the groups' roots; names of the others begin with 0 (null) or 1


def _h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(values: list[Column]) -> Column:
    """sha256 of each value as its count of bytes, a colon and itself, null as ``-``, one after the other."""
    parts = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.sha2(F.concat(*parts), 256)


def levels_of(n: int) -> int:
    """Levels above ``n`` leaves until one node is left."""
    return (n - 1).bit_length()


def lifted(digests: list[str], levels: int) -> list[list[str]]:
    """The digests and those of so many levels above: two in a row make one, a last one alone as well."""
    found = [digests]
    for _ in range(levels):
        below = found[-1]
        found.append([_h("".join(below[i : i + 2])) for i in range(0, len(below), 2)])
    return found


def beside(levels: list[list[str]], digit: int) -> list[str]:
    """From below, the sibling at each level but the last: side (L or R) and digest, or empty where there is none."""
    found = []
    for h, row in enumerate(levels[:-1]):
        at = (digit >> h) ^ 1
        found.append(("L" if at < digit >> h else "R") + row[at] if at < len(row) else "")
    return found


def folded(leaf: str, siblings: list[str]) -> str:
    """The root that a leaf and its siblings from below give."""
    for x in siblings:
        leaf = _h(x[1:] + leaf if x[:1] == "L" else leaf + x[1:])
    return leaf


@dataclass(frozen=True)
class Manifest:
    """``leaves`` (tree, rank, id, leaf, claim), ``trees`` (tree, group, n, subroot, rank), the ``store`` by step, and the root, None without rows."""

    leaves: DataFrame
    trees: DataFrame
    store: list[DataFrame]
    root: str | None


def _ranked(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` (tree, ...) with ``rank`` within their tree in ``order``, and ``n``, the tree's size.

    Rows are dealt by range and numbered within their partition; the rows of a tree in earlier
    partitions come from a table of a row per tree and partition. ``order`` is total, so no key is too large.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, "tree", *order).sortWithinPartitions("tree", *order).withColumn("place", F.monotonically_increasing_id())
    dealt = staged(dealt, name).withColumn("part", F.shiftright("place", 33))
    spots = dealt.groupBy("tree", "part").agg(F.min("place").alias("first"), F.count("*").alias("size"))
    # A tree has a row for each partition here, at most.
    tree = Window.partitionBy("tree")
    earlier = F.sum("size").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    spots = spots.select("tree", "part", "first", F.sum("size").over(tree).alias("n"), F.coalesce(earlier, F.lit(0)).alias("before"))
    return dealt.join(spots, ["tree", "part"]).withColumn("rank", F.col("place") - F.col("first") + F.col("before")).drop("place", "part", "first", "before")


_RECORD = "tree string, n long, at long, digest string, height int, children array<string>"


def _records(groups: DataFrame, step: int) -> DataFrame:
    """Records of rows (tree, n, at, children): the children lie ``step`` * ``STEP`` levels above the leaves."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            children = batch.column(3).to_pylist()
            heights = [min(STEP, levels_of(n) - STEP * step) for n in batch.column(1).to_pylist()]
            digests = [lifted(x, h)[-1][0] for x, h in zip(children, heights)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(digests), pa.array(heights, pa.int32()), batch.column(3)], ["tree", "n", "at", "digest", "height", "children"])

    return groups.select("tree", "n", "at", F.transform("children", lambda x: x["digest"]).alias("children")).mapInArrow(work, _RECORD)


def _up(nodes: DataFrame) -> DataFrame:
    """Rows (tree, n, at, digest) by the record they fall into, at most 64 each."""
    grouped = nodes.groupBy("tree", F.shiftright("at", STEP).alias("at")).agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("at", "digest"))).alias("children"))
    return grouped.select("tree", "n", "at", "children")


def _built(leaves: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The records of each step and (tree, n, digest) of the roots, for leaves (tree, n, rank, leaf)."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    nodes = leaves.select("tree", "n", F.col("rank").alias("at"), F.col("leaf").alias("digest"))
    roots = nodes.filter("n = 1").select("tree", "n", "digest")
    nodes, store = nodes.filter("n > 1"), []
    for step in range(-(-levels_of(most) // STEP) if most else 0):
        made = staged(_records(_up(nodes), step), f"{name}-{step}")
        store.append(made)
        whole = F.col("n") <= 1 << (STEP * (step + 1))  # the step ends at the root
        roots = roots.unionByName(made.filter(whole).select("tree", "n", "digest"))
        nodes = made.filter(~whole).select("tree", "n", "at", "digest")
    return store, roots


def build(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", fields: tuple[str, ...] = FIELDS, claim: Column | None = None) -> Manifest:
    """The manifest of ``docs``. ``claim`` is a further digest to carry with each row, null for the leaf itself.

    Leaves ascend by id (null first), then by digest, within their group; groups by their UTF-8 bytes,
    null first. Repeated rows are leaves of their own with equal digests. Other columns are not read.
    """
    tree = F.when(F.col(group_col).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col(group_col).cast("string")))
    rows = docs.select(tree.alias("tree"), F.col(id_col).alias("id"), leaf_digest([F.col(c) for c in fields]).alias("leaf"), (F.lit(None).cast("string") if claim is None else claim).alias("claim"))
    rows = staged(rows.withColumn("tie", F.monotonically_increasing_id()), "leaves")
    leaves = staged(_ranked(rows, ["id", "leaf", "tie"], "leaves-dealt").drop("tie"), "leaves-ranked")
    store, roots = _built(leaves, "records")
    tops = roots.select(F.lit(_TOP).alias("tree"), F.col("tree").alias("name"), F.col("n").alias("leaves"), F.col("digest").alias("leaf"))
    tops = staged(_ranked(tops, ["name"], "groups-dealt"), "groups")
    upper, root = _built(tops, "upper-records")
    root = root.first()
    known = tops.select(F.col("name").alias("tree"), F.when(F.col("name") != "0", F.substr("name", F.lit(2))).alias("group"), F.col("leaves").alias("n"), F.col("leaf").alias("subroot"), "rank")
    n = max(len(store), len(upper))
    by_step = [x[0] if len(x) == 1 else x[0].unionByName(x[1]) for x in ([s[k] for s in (store, upper) if k < len(s)] for k in range(n))]
    return Manifest(leaves, known, by_step, root["digest"] if root else None)


_FRONT = "tree string, at long, digest string, path array<string>, group string, subroot string"


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, _SLICE):
            yield batch.slice(first, _SLICE)


def _descended(store: list[DataFrame], starts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(tree, at, digest, path, group, subroot) of the records of step 0 that ``wanted`` (tree, at) names, with their paths from the top.

    ``starts`` (tree, n, digest, path, group, subroot) are the roots. A tree joins the search at the step its root stands at.
    """

    def children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            tree, group, subroot, at, path, digits, below, height = (c.to_pylist() for c in batch.columns)
            found: list[tuple] = []
            for i, chosen in enumerate(digits):
                levels = lifted(below[i], height[i])
                found += [(tree[i], (at[i] << STEP) + d, below[i][d], path[i] + beside(levels, d)[::-1], group[i], subroot[i]) for d in chosen]
            kinds = (pa.string(), pa.int64(), pa.string(), pa.list_(pa.string()), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], t) for k, t in enumerate(kinds)], ["tree", "at", "digest", "path", "group", "subroot"])

    # The digits that requests take at each record above step 0.
    passed, digits = wanted.select("tree", "at"), []
    for _ in store[1:]:
        digit = F.col("at").bitwiseAND(F.lit((1 << STEP) - 1))
        passed = passed.groupBy("tree", F.shiftright("at", STEP).alias("up")).agg(F.collect_set(digit).alias("digits")).withColumnRenamed("up", "at")
        digits.append(passed)
    front = None
    for step in range(max(len(store) - 1, 0), -1, -1):
        low, high = 1 << (STEP * step), 1 << (STEP * (step + 1))
        stands = (F.col("n") <= high) & (F.col("n") > low) if step else F.col("n") <= high
        # A lone leaf is in no record; its digest may still be that of one, the root of a tree below.
        record = F.when(F.col("n") > 1, F.col("digest")).alias("digest")
        here = starts.filter(stands).select("tree", F.lit(0).cast("long").alias("at"), record, "path", "group", "subroot")
        front = here if front is None else front.unionByName(here)
        if step:
            both = front.join(digits[step - 1], ["tree", "at"]).join(_by_digest(store[step]), "digest")
            both = both.select("tree", "group", "subroot", "at", "path", "digits", "children", "height")
            front = staged(both.mapInArrow(children, _FRONT), f"front-{step}")
    return front


def _by_digest(records: DataFrame) -> DataFrame:
    return records.groupBy("digest").agg(F.first("children").alias("children"), F.first("height").alias("height"))


def prove(manifest: Manifest, ids: DataFrame | None = None) -> DataFrame:
    """(id, group, leaf, claim, subroot, rank, siblings) of every row, or of those whose id is in the column ``id`` of ``ids``.

    ``siblings`` go from the leaf to the root: L or R for the side, then the digest, or an empty text
    where a node stands alone. ``folded`` takes a leaf and these. No rows, no proofs.
    """
    leaves = manifest.leaves
    kind = leaves.schema["id"].dataType.simpleString()
    schema = f"id {kind}, group string, leaf string, claim string, subroot string, rank long, siblings array<string>"
    if manifest.root is None:
        return leaves.sparkSession.createDataFrame([], schema)
    if ids is not None:
        leaves = leaves.join(ids.select(F.col("id").alias("_id")).distinct(), F.col("id").eqNullSafe(F.col("_id")), "left_semi")

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            group, subroot, path, below, height, asked = batch.columns
            owner, flat = asked.value_parent_indices(), asked.flatten()
            path, below, height = path.to_pylist(), below.to_pylist(), height.to_pylist()
            found, levels, last = [], [], -1
            for rank, o in zip(flat.field("rank").to_pylist(), owner.to_pylist()):
                if o != last:
                    levels, last = lifted(below[o] or [""], height[o] or 0), o
                found.append(beside(levels, rank & ((1 << STEP) - 1)) + path[o][::-1])
            yield pa.RecordBatch.from_arrays(
                [flat.field("id"), group.take(owner), flat.field("leaf"), flat.field("claim"), subroot.take(owner), flat.field("rank"), pa.array(found, pa.list_(pa.string()))],
                ["id", "group", "leaf", "claim", "subroot", "rank", "siblings"],
            )

    def answered(requests: DataFrame, starts: DataFrame) -> DataFrame:
        rows = requests.join(_descended(manifest.store, starts, requests), ["tree", "at"])
        if manifest.store:
            rows = rows.join(_by_digest(manifest.store[0]), "digest", "left")
        else:
            rows = rows.withColumns({"children": F.lit(None).cast("array<string>"), "height": F.lit(None).cast("int")})
        return rows.select("group", "subroot", "path", "children", "height", "asked").mapInArrow(paths, schema)

    def grouped(rows: DataFrame) -> DataFrame:
        return rows.groupBy("tree", F.shiftright("rank", STEP).alias("at")).agg(F.collect_list(F.struct("rank", "id", "leaf", "claim")).alias("asked"))

    requests, none = staged(grouped(leaves), "requests"), F.lit(None).cast("string")
    # First the groups asked for, in the tree of their roots; then the rows below these.
    trees = manifest.trees
    asked = trees.join(requests.select("tree").distinct(), "tree", "left_semi").select(F.lit(_TOP).alias("tree"), "rank", F.lit(None).cast(kind).alias("id"), F.col("tree").alias("leaf"), none.alias("claim"))
    top = trees.sparkSession.range(1).select(F.lit(_TOP).alias("tree"), F.lit(trees.count()).alias("n"), F.lit(manifest.root).alias("digest"), F.lit([]).cast("array<string>").alias("path"), none.alias("group"), none.alias("subroot"))
    above = staged(answered(grouped(asked), top).select(F.col("leaf").alias("tree"), F.reverse("siblings").alias("path")), "upper-paths")
    return answered(requests, trees.join(above, "tree").select("tree", "n", F.col("subroot").alias("digest"), "path", "group", "subroot"))


def checked(proofs: DataFrame, root: str | None) -> DataFrame:
    """``proofs`` with ``proof_sha256`` of the siblings' digests, ``folded_root`` of the claim (else the leaf), and ``verified``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index
            leaf, claim, siblings = (batch.column(at(c)).to_pylist() for c in ("leaf", "claim", "siblings"))
            proof = [_h("".join([x[1:] for x in s])) for s in siblings]
            ends = [folded(c if c is not None else x, s) for x, c, s in zip(leaf, claim, siblings)]
            more = [pa.array(proof, pa.string()), pa.array(ends, pa.string()), pa.array([x == root for x in ends], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "proof_sha256", "folded_root", "verified"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in proofs.schema.fields)
    return proofs.mapInArrow(work, f"{kinds}, proof_sha256 string, folded_root string, verified boolean")

"""Near-duplicates of embeddings by cross-polytope hashing.

A vector is rotated by three rounds of random signs and a fast Hadamard transform; its hash is the
largest coordinate with its sign. A table joins ``HASHES`` such hashes. A vector enters, besides its
own bucket, those reached by the next-best coordinates (multiprobe), so pairs that just miss each
other still meet. Pairs that share a bucket and a label are verified by their cosine.

Buckets of one vector go before vectors are shuffled. A bucket of many vectors is cut into blocks,
and every pair of blocks is a group of its own, so no group is large. Groups return counts and
spanning links, never their pairs. A pair that shares several buckets counts in the least one only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockledger.llm.components import components
from stockledger.llm.store import staged
from stockledger.llm.words import mixed, signed

COSINE = 0.93
TABLES, HASHES, PROBES = 8, 3, 5
BLOCK = 768

_SMALL = 24


def _hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows; their length is a power of two."""
    n, half = x.shape[1], 1
    while half < n:
        y = x.reshape(len(x), n // (2 * half), 2, half)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), n)
        half *= 2
    return x


def _ranked(x: np.ndarray, table: int, place: int, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes and sizes of the ``top`` largest coordinates of the rotated rows."""
    rng = np.random.default_rng(7_919 * table + place)
    for _ in range(3):
        x = _hadamard(x * rng.choice([-1.0, 1.0], x.shape[1])) / np.sqrt(x.shape[1])
    size = np.abs(x)
    at = np.argpartition(-size, min(top, x.shape[1]) - 1, axis=1)[:, :top]
    at = np.take_along_axis(at, np.argsort(-np.take_along_axis(size, at, 1), axis=1, kind="stable"), 1)
    return at * 2 + (np.take_along_axis(x, at, 1) < 0), np.take_along_axis(size, at, 1)


def bucket_keys(x: np.ndarray, labels: np.ndarray, tables: int, hashes: int, probes: int) -> np.ndarray:
    """The keys of each row's buckets, ``tables * probes`` of them; the rows are unit vectors."""
    width = 1 << max(1, (x.shape[1] - 1).bit_length())
    padded = np.zeros((len(x), width))
    padded[:, : x.shape[1]] = x
    top = min(3, width)
    # Probes change at most two of a table's hashes to their next best, those that lose least.
    moves = [()] + [((k, r),) for k in range(hashes) for r in range(1, top)] + [((a, 1), (b, 1)) for a in range(hashes) for b in range(a)]
    keys = []
    base = mixed(labels.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(x.shape[1]))
    for t in range(tables):
        ranked = [_ranked(padded, t, k, top) for k in range(hashes)]
        loss = np.stack([sum((ranked[k][1][:, 0] - ranked[k][1][:, r] for k, r in move), np.zeros(len(x))) for move in moves], axis=1)
        codes = []
        for move in moves:
            change = dict(move)
            key = base + np.uint64(t + 1)
            for k in range(hashes):
                key = mixed(key * np.uint64(0xC2B2AE3D27D4EB4F) + ranked[k][0][:, change.get(k, 0)].astype(np.uint64))
            codes.append(key)
        chosen = np.argsort(loss, axis=1, kind="stable")[:, :probes]
        keys.append(np.take_along_axis(np.stack(codes, axis=1), chosen, 1))
    return np.concatenate(keys, axis=1)


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of very large or small components would overflow
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _coded(vectors: DataFrame, tables: int, hashes: int, probes: int) -> DataFrame:
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(3).value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(sizes):
                part = batch.filter(pa.array(sizes == dim))
                keys = bucket_keys(_matrix(part.column(3), int(dim)), part.column(2).to_numpy(), tables, hashes, probes)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * keys.shape[1], pa.int32()), pa.array(signed(keys.reshape(-1))))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], ["id", "copies", "label", "v", "keys"])

    return vectors.mapInArrow(code, f"id long, copies long, label long, v {vectors.schema['v'].dataType.simpleString()}, keys array<long>")


def _first_shared(a: np.ndarray, b: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether ``key`` is the least key that rows of a and b share, pair by pair; rows of keys are sorted."""
    first, open_ = np.ones(len(a), bool), np.arange(len(a))
    for k in range(a.shape[1]):  # pairs that share a lesser key, or have no lesser one left, are done
        open_ = open_[a[open_, k] < key[open_]]
        if not len(open_):
            break
        shared = (b[open_] == a[open_, k][:, None]).any(axis=1)
        first[open_[shared]] = False
        open_ = open_[~shared]
    return first


class _Groups:
    """Links within groups of rows of one bucket, or between two blocks of one."""

    def __init__(self, rows: pa.RecordBatch, cosine: float) -> None:
        self.id, self.copies, self.label = (rows.column(k).to_numpy() for k in (3, 4, 5))
        self.key, self.side, self.cosine = rows.column(0).to_numpy(), rows.column(2).to_numpy(), cosine
        self.block = rows.column(1).to_numpy()
        sizes = rows.column(6).value_lengths().to_numpy(zero_copy_only=False)
        self.size, self.x = sizes, np.zeros((len(sizes), sizes.max()))
        for dim in np.unique(sizes):
            self.x[sizes == dim, :dim] = _matrix(rows.column(6).filter(pa.array(sizes == dim)), int(dim))
        self.keys = np.sort(rows.column(7).flatten().to_numpy().reshape(len(sizes), -1), axis=1)

    def linked(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of pairs of rows of one group, those that link and count here."""
        found = []
        for first in range(0, len(i), 1 << 16):
            a, b = i[first : first + (1 << 16)], j[first : first + (1 << 16)]
            fits = (self.label[a] == self.label[b]) & (self.size[a] == self.size[b])
            a, b = a[fits], b[fits]
            fits = np.einsum("ij,ij->i", self.x[a], self.x[b]) >= self.cosine
            a, b = a[fits], b[fits]
            fits = _first_shared(self.keys[a], self.keys[b], self.key[a])
            found.append((a[fits], b[fits]))
        return tuple(np.concatenate([x[k] for x in found]) if found else np.zeros(0, np.int64) for k in (0, 1))

    def results(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(id, linked vectors, an id it hangs on): sums and a spanning forest."""
        edges = np.flatnonzero(np.r_[True, (self.key[1:] != self.key[:-1]) | (self.block[1:] != self.block[:-1]), True])
        counts = np.diff(edges)
        small = np.flatnonzero(counts <= _SMALL)
        pairs = [self._pairs(edges[small[counts[small] == n]], int(n)) for n in np.unique(counts[small]) if n > 1]
        if pairs:
            i, j = self.linked(*(np.concatenate([p[k] for p in pairs]) for k in (0, 1)))
            yield self._summed(i, j)
        for g in np.flatnonzero(counts > _SMALL):
            yield from self._large(int(edges[g]), int(edges[g + 1]))

    def _pairs(self, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = np.triu_indices(n, 1)
        i, j = (first[:, None] + a).ravel(), (first[:, None] + b).ravel()
        wanted = (self.side[i] != self.side[j]) | (self.side[i] < 0)
        return i[wanted], j[wanted]

    def _summed(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids, at = np.unique(np.concatenate([self.id[i], self.id[j]]), return_inverse=True)
        counts = np.zeros(len(ids), np.int64)
        np.add.at(counts, at, np.concatenate([self.copies[j], self.copies[i]]))
        root = np.arange(len(ids))
        a, b = at[: len(i)], at[len(i) :]
        while True:  # the least id of each component of the links at hand
            low = np.minimum(root[a], root[b])
            new = root.copy()
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            new = new[new]
            if (new == root).all():
                return ids, counts, ids[root]
            root = new

    def _large(self, first: int, last: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        rows = np.arange(first, last)
        inside = self.side[first] < 0
        left, right = (rows, rows) if inside else (rows[self.side[rows] == 0], rows[self.side[rows] == 1])
        if not len(left) or not len(right):
            return
        near = self.x[left] @ self.x[right].T >= self.cosine - 1e-9
        if inside:
            near = np.triu(near, 1)
        i, j = np.nonzero(near)
        i, j = self.linked(left[i], right[j])
        if len(i):
            yield self._summed(i, j)


def _compare(groups: DataFrame, cosine: float) -> DataFrame:
    """Runs over rows sorted by bucket and block; a group cut by the end of a batch waits for the next."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if rest is not None and rest.num_rows:
                batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            if not batch.num_rows:
                continue
            key, block = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            whole = int(np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (block[1:] != block[:-1])])[-1])
            rest = batch.slice(whole)
            if whole:
                yield from results(batch.slice(0, whole))
        if rest is not None and rest.num_rows:
            yield from results(rest)

    def results(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for ids, counts, roots in _Groups(rows, cosine).results():
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(counts), pa.array(roots)], ["id", "n", "root"])

    return groups.mapInArrow(compare, "id long, n long, root long")


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    cosine: float = COSINE, tables: int = TABLES, hashes: int = HASHES, probes: int = PROBES, block: int = BLOCK,
) -> DataFrame:
    """(id, n_links, component_id, kept) per row.

    Rows of the same label with a cosine of at least ``cosine`` link; ``component_id`` is the least id
    reachable, ``kept`` marks it. Null labels, and vectors that are null, empty, zero or hold null, NaN
    or infinite components, link with nothing. Vectors of different lengths don't link. Equal vectors
    are one in the search and count as many. Rows with the same id count as one vector each, in
    one component; null ids get none. Other columns are not read; an empty table gives no rows.
    """
    v = F.col("v")
    # Single-precision vectors are shuffled as they are; all sums are in double precision.
    kind = "array<float>" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast(kind).alias("v"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("label").isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    groups = rows.filter(usable & F.col("id").isNotNull()).groupBy("label", "v").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    coded = staged(_coded(groups.select("id", "copies", "label", "v"), tables, hashes, probes), "coded-vectors")
    members = coded.select("id", F.explode(F.array_distinct("keys")).alias("key"))
    buckets = members.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    shared = members.join(buckets, "key").withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    placed = shared.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(F.col("own") == F.col("other"), -1).when(F.col("own") < F.col("other"), 0).otherwise(1)
    # Key of the group, and which block of the two a row is from; one block with itself: -1.
    sent = placed.select("id", "key", (low.cast("long") * F.col("blocks") + high).alias("pair"), side.alias("side"))
    filled = sent.join(coded, "id").select("key", "pair", "side", "id", "copies", "label", "v", "keys")
    results = staged(_compare(filled.repartition("key", "pair").sortWithinPartitions("key", "pair"), cosine), "vector-links")
    counts = results.groupBy("id").agg(F.sum("n").alias("n"))
    found = components(results.select(F.col("id").alias("a"), F.col("root").alias("b")))
    # What each distinct vector knows, for all its copies.
    known = groups.join(counts, "id", "left").join(found.withColumnRenamed("node", "id"), "id", "left").select(
        F.col("label").alias("_label"), F.col("v").alias("_v"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id")
    )
    joined = rows.join(known, (F.col("label") == F.col("_label")) & (v == F.col("_v")), "left")
    linked = usable & F.col("id").isNotNull()
    result = joined.select(F.col("id").alias(id_col), F.when(linked, F.col("n_links")).otherwise(0).cast("long").alias("n_links"), F.when(linked, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
    return result.withColumn("kept", F.col(id_col) == F.col("component_id"))

"""Vectors as four one-byte codes, with codebooks from ball k-means.

Each quarter of a vector is coded by the nearest entry of its codebook. An entry and the parts assigned
to it form a ball. Between rounds a part needs to look only at entries that can beat its own one: with
q the squared distance to its entry, and D that between two entries, an entry with D > 4q is farther
away by the triangle inequality. So a ball with radius r has as neighbours the entries with D <= 4r,
parts closer than half the way to the nearest neighbour (the stable core) do nothing, and the rest lie
in rings, one for each neighbour more that 4q reaches. Everything is in whole numbers, so that ties are
exact and sums do not depend on the order of rows.

Vectors stay spread over the tasks. The driver and all tasks hold the codebooks only: 4 x 256 entries.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockledger.llm.store import staged

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024

#: Below this, four times a squared distance fits 64 bits: (2 * 2**26) squared, times 32 components.
LARGEST = 1 << 26
_ROWS = 1 << 15


def scaled(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int = SCALE) -> DataFrame:
    """(id, label, v) of the rows whose vector is whole: components as floor(scale * x), held within ``LARGEST``."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = lambda x: F.least(F.greatest(F.floor(x * float(scale)), F.lit(-LARGEST)), F.lit(LARGEST)).cast("int")
    return vectors.filter(v.isNotNull() & ~bad).select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.transform(v, whole).alias("v"))


def _check(rows: DataFrame) -> bool:
    """Whether there are rows; lengths and sizes the codes can't hold are an error."""
    n, low, high, least, most = rows.agg(F.count("*"), F.min(F.size("v")), F.max(F.size("v")), F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    if n and (low != high or low % PARTS or low // PARTS > 32):
        raise ValueError(f"vectors need one length, {PARTS} equal parts of at most 32 components; lengths are {low} to {high}")
    if n and low and max(most, -least) >= LARGEST:
        raise ValueError(f"components of {LARGEST} or more after scaling; squared distances are exact below that")
    return n > 0


def first_books(rows: DataFrame, entries: int = ENTRIES) -> np.ndarray:
    """(part, entry, place): the parts of the least ids, null ids last, ties by the vector."""
    least = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    whole = np.array([x["v"] for x in least], np.int64)
    return np.ascontiguousarray(whole.reshape(len(whole), PARTS, -1).transpose(1, 0, 2))


class Balls:
    """A part's entries with, for each of them, the others from near to far."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        apart = np.array([((entries - e) ** 2).sum(axis=1) for e in entries], np.int64)
        self.order = np.argsort(apart, axis=1, kind="stable")
        self.apart = np.take_along_axis(apart, self.order, 1)

    def nearest(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each row, ties to the lower index, and its squared distance; ``own`` are entries to start from."""
        q = ((x - self.entries[own]) ** 2).sum(axis=1)
        # How many entries 4q reaches. Balls that reach only their own entry, and cores, end here.
        reach = np.zeros(len(x), np.int64)
        by_entry = np.argsort(own, kind="stable")
        cuts = np.searchsorted(own[by_entry], np.arange(len(self.entries) + 1))
        for e in np.unique(own):
            rows = by_entry[cuts[e] : cuts[e + 1]]
            radius = q[rows].max()
            near = np.searchsorted(self.apart[e], 4 * radius, "right")
            if near > 1:
                reach[rows] = np.searchsorted(self.apart[e, :near], 4 * q[rows], "right")
        best, found = q.copy(), own.copy()
        ring = np.argsort(-reach, kind="stable")
        falling = -reach[ring]
        for k in range(int(reach.max(initial=0))):
            rows = ring[: np.searchsorted(falling, -k, "left")]
            entry = self.order[own[rows], k]
            d = ((x[rows] - self.entries[entry]) ** 2).sum(axis=1)
            better = (d < best[rows]) | ((d == best[rows]) & (entry < found[rows]))
            best[rows[better]], found[rows[better]] = d[better], entry[better]
        return found, best


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about ``_ROWS`` rows, so that balls have members."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= _ROWS:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
    if sum(x.num_rows for x in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def assign(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """``rows`` (id, label, v, code, error) with ``code`` and ``error`` by the entries of ``books``, from the codes they have."""
    parts, entries, width = books.shape
    shared = rows.sparkSession.sparkContext.broadcast(books)  # 4 x 256 entries at most

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        balls = [Balls(x) for x in shared.value]
        for batch in _packed(batches):
            x = _matrix(batch.column(2), parts * width).reshape(batch.num_rows, parts, width)
            before = _matrix(batch.column(3), parts)
            both = [b.nearest(x[:, p], before[:, p]) for p, b in enumerate(balls)]
            codes = np.stack([found for found, _ in both], axis=1).astype(np.int16)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(codes) + 1) * parts, pa.int32()), pa.array(codes.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], lists, pa.array(sum(d for _, d in both))], ["id", "label", "v", "code", "error"])

    return rows.mapInArrow(work, rows.schema)


def _totals(rows: DataFrame, shape: tuple[int, int, int]) -> DataFrame:
    """(part, entry, n, sums): a row for each task and used entry, added up by the caller."""
    parts, entries, width = shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            x, codes = _matrix(batch.column(0), parts * width).reshape(batch.num_rows, parts, width), _matrix(batch.column(1), parts)
            for p in range(parts):
                n[p] += np.bincount(codes[:, p], minlength=entries)
                for k in range(width):  # doubles hold a batch's sums of whole numbers below 2**26 exactly
                    sums[p, :, k] += np.bincount(codes[:, p], x[:, p, k], entries).astype(np.int64)
        part, entry = np.nonzero(n)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * width, pa.int32()), pa.array(sums[part, entry].reshape(-1)))
        yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(n[part, entry]), lists], ["part", "entry", "n", "sums"])

    return rows.select("v", "code").mapInArrow(work, "part int, entry int, n long, sums array<long>")


def moved(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry as the floor of the mean of its parts; entries without any stay."""
    width = books.shape[2]
    total = lambda c: F.sum(c.cast("decimal(38,0)"))
    found = _totals(rows, books.shape).groupBy("part", "entry").agg(total(F.col("n")).alias("n"), *[total(F.col("sums")[k]).alias(f"s{k}") for k in range(width)]).collect()
    books = books.copy()
    for x in found:
        books[x["part"], x["entry"]] = [int(x[f"s{k}"]) // int(x["n"]) for k in range(width)]
    return books


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def encode(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", rounds: int = ROUNDS, entries: int = ENTRIES) -> tuple[DataFrame, np.ndarray]:
    """((id, label, code array, error) of each whole vector, the codebooks as an array (part, entry, place)).

    Vectors that are null or hold null or non-finite components are left out. Ids may be null (they come
    last) or repeated; repeated vectors are coded alike. Fewer than ``entries`` vectors make as many
    entries. Vectors of no components get code 0 at distance 0. An empty table gives no rows and no
    entries. Unequal lengths, lengths that don't divide by four and components so large that squared
    distances would leave 64 bits raise a ``ValueError``. Other columns are not read.
    """
    rows = scaled(vectors, id_col, vector_col, label_col).withColumns({"code": F.array_repeat(F.lit(0).cast("short"), PARTS), "error": F.lit(0).cast("long")})
    rows = staged(rows, "vectors")
    books = np.zeros((PARTS, 0, 0), np.int64)
    if _check(rows):
        books = first_books(rows, entries)
        for _ in range(rounds):
            rows = staged(assign(rows, books), "vectors", over=rows)
            books = moved(rows, books)
        rows = staged(assign(rows, books), "vectors", over=rows)
    return rows.select(F.col("id").alias(id_col), F.col("label").alias(label_col), "code", "error"), books


def code_text(code: Column) -> Column:
    return F.concat_ws("", F.transform(code, lambda x: F.lower(F.lpad(F.hex(x), 2, "0"))))

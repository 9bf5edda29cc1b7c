"""Near-duplicates by 64-bit SimHash, found through popcounts of segments.

A fingerprint is cut into 32 segments of two bits and embedded as the vector of their bit counts. The
Manhattan distance of two such vectors is at most the Hamming distance of the fingerprints, so all
links lie within a Manhattan ball of radius 3. The ball is searched on a grid of unit cells in each
half of the vector (16 segments): of two vectors within 3, one half is within 1. Halves within 1 are
equal or one step apart, and then one of their sums is even: only even sums look at the cells one
step away. The join condition compares the whole fingerprints, so candidates are never written.

Equal fingerprints are one row of the join, however many documents have them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockledger.llm.components import components
from stockledger.llm.store import staged

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 3

_BLOCK = 1 << 16


def fingerprint(text: str | None, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Bit is 1 if set in over half of the XXH64 of the shingles, repeats included; no words: 0."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    if len(parts) < words:
        shingles = [b" ".join(parts)]
    else:
        joined, ends, at = b" ".join(parts), [], -1
        for part in parts:
            at += len(part) + 1
            ends.append(at)
        starts = [0] + [end + 1 for end in ends[:-1]]
        shingles = [joined[s:e] for s, e in zip(starts, ends[words - 1 :])]
    counts, digest = np.zeros(64, np.int64), xxhash.xxh64_digest
    for first in range(0, len(shingles), _BLOCK):
        block = shingles[first : first + _BLOCK]
        raw = np.frombuffer(b"".join([digest(x, seed) for x in block]), np.uint8)
        counts += np.unpackbits(raw.reshape(len(block), 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(shingles)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """(id, fp): the fingerprint of each text as a signed long. Null text is empty; rows with null id stay."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(x.as_py(), words, seed) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(np.array(values, np.uint64).view(np.int64))], ["id", "fp"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(score, "id long, fp long")


_LOW_BITS = 0x55555555


def _cells(fps: DataFrame, half: int) -> DataFrame:
    """(fp, part): the 16 counts of a half, packed in two bits each."""
    bits = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)) if half == 0 else F.shiftrightunsigned("fp", 32)
    return fps.select("fp", (bits - F.shiftrightunsigned(bits, 1).bitwiseAND(F.lit(_LOW_BITS))).alias("part"))


def _odd(part: Column) -> Column:
    """Parity of the sum of the counts: the low bits of the segments decide."""
    return F.bit_count(part.bitwiseAND(F.lit(_LOW_BITS))).bitwiseAND(F.lit(1)) == 1


def _one_step(part: Column) -> list[Column]:
    """The cells one step away; null where a count would leave 0 to 2."""
    steps = []
    for i in range(0, 32, 2):
        count = F.shiftrightunsigned(part, i).bitwiseAND(F.lit(3))
        steps += [F.when(count < 2, part + F.lit(1 << i)), F.when(count > 0, part - F.lit(1 << i))]
    return steps


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(x, y), x < y: all pairs of distinct fingerprints of column ``fp`` that differ in 1 to ``max_bits`` bits.

    ``max_bits`` is at most 3, for which one half of the vector is within one step.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits is 0 to 3")
    found = None
    for half in (0, 1):
        cells = _cells(fps, half)
        own = cells.select(F.lit(half).alias("half"), F.col("part").alias("cell"), F.col("fp").alias("x"))
        near = cells.filter(~_odd(F.col("part"))).select(F.lit(half).alias("half"), F.explode(F.array_compact(F.array(*_one_step(F.col("part"))))).alias("cell"), F.col("fp").alias("y"))
        same = own.select("half", "cell", F.col("x").alias("y"))
        # One step apart: the even one looked here, in either order. The same cell: once.
        close = F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= max_bits
        stepped = own.join(near, ["half", "cell"]).filter(close)
        equal = own.join(same, ["half", "cell"]).filter(close & (F.col("x") < F.col("y")))
        both = stepped.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).unionByName(equal.select("x", "y"))
        found = both if found is None else found.unionByName(both)
    return found.distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS, words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """(id, fingerprint, component_id) for each row of ``docs``.

    fingerprint: 16 lowercase hex digits. component_id: the least id reachable over links of at most
    ``max_bits`` differing bits, itself included. Null and empty texts have fingerprint zero and link
    like any other. Rows with the same id stay as many rows; null ids get their group's component.
    Other columns of ``docs`` are not read, whatever their names. An empty table gives no rows.
    """
    prints = staged(fingerprints(docs, id_col, text_col, words, seed), "fingerprints")
    groups = staged(prints.groupBy("fp").agg(F.min("id").alias("rep")), "fingerprint-groups")
    pairs = links(groups.select("fp"), max_bits)
    by_rep = pairs.join(groups.select(F.col("fp").alias("x"), F.col("rep").alias("a")), "x").join(groups.select(F.col("fp").alias("y"), F.col("rep").alias("b")), "y")
    found = components(by_rep.select("a", "b"))
    named = groups.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return prints.join(named, "fp").select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each group of near-duplicates, that of the least id, with all columns of ``docs``.

    Rows of the same id merge only with equal text. Rows with a null id can't be named and all stay.
    """
    # Rows get a name of their own from id and text, as an id may stand on several texts.
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("h"), F.col(text_col).alias("text"))
    rows = texts.select(F.xxhash64("id", "h").alias("row"), "id", "h", "text")
    groups = near_duplicates(rows, "row", "text", max_bits).select("row", F.col("component_id").alias("component")).distinct()
    return keep_one(docs, rows.select("row", "id", "h").join(groups, "row").select("id", "h", "component"), id_col, text_col)


def keep_one(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each group (id, h, component) the row of the least id, then least ``h``, with all columns of ``docs``.

    Rows with a null id can't be named and all stay. Rows of the same id merge only with equal text.
    """
    text = F.xxhash64(F.col(text_col).cast("string"))
    kept = groups.filter("id is not null").groupBy("component").agg(F.min(F.struct("id", "h")).alias("_llm_row")).select(F.col("_llm_row.id").alias("_llm_id"), F.col("_llm_row.h").alias("_llm_h"))
    # Documents are the large side; the ids are hashed in memory, as many as documents at most.
    named = docs.join(kept.hint("shuffle_hash"), (docs[id_col] == F.col("_llm_id")) & (text == F.col("_llm_h")), "left_semi")
    named = named.withColumn("_llm_h", text).dropDuplicates([id_col, "_llm_h"]).drop("_llm_h")
    return named.unionByName(docs.filter(F.col(id_col).isNull()))

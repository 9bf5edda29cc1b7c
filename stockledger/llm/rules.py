"""Quality rules with thresholds that each language and source sets for itself.

Four statistics of a text are whole numbers: code points a word, symbols, repeated lines and repeated
words, each a thousand words or lines. A group's values are kept as a quantile sketch: exact up to 64,
beyond that the leading six bits of a value name its bucket, so a bucket is at most a 32nd of its value
wide. A sketch is a count for each bucket. Counts add up, so sketches merge in any order to the same
result: tasks count before the shuffle, sources merge to their language, languages to all.

A group's limits are fences about its quartiles. A text outside of a fence is rejected. Groups of less
than ``LEAST_ROWS`` rows take the limits of their language, small languages those of all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockledger.llm import words as W
from stockledger.llm.store import staged

LEAST_WORDS, MOST_REPEATED = 50, 50
#: Fences lie ``REACH`` interquartile ranges outside of the quartiles; a range counts as ``SPREAD`` at least.
REACH = 3
SPREAD = {"word_length": 500, "symbols": 50, "dup_lines": 120, "repeat_words": 100}
#: Only texts of long words and of short ones are odd at both ends.
TWO_SIDED = ("word_length",)
LEAST_ROWS = 200
EXACT_BITS = 6

_BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
# The symbols of the rules.
_SYMBOLS = b"#*$%&|<>"
_SLICE_BYTES = 4 << 20


def _counts_in(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    run = np.zeros(len(marks) + 1, np.int64)
    np.cumsum(marks, out=run[1:])
    return run[offsets[1:]] - run[offsets[:-1]]


def _codes(values: pa.Array) -> np.ndarray:
    return values.dictionary_encode().indices.to_numpy().astype(np.int64)


def _pieces(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """data[start:end] of each range as binary values; ranges are in order and apart."""
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    kept = data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(kept))])


def _repeated_words(codes: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
    """Words of each row in three-word windows that the row holds twice or more. Words are compared whole, by their codes."""
    if len(codes) < 3:
        return np.zeros(rows, np.int64)
    whole = np.flatnonzero(owner[:-2] == owner[2:])
    many = int(codes.max()) + 1
    _, pair = np.unique(codes[whole] * many + codes[whole + 1], return_inverse=True)
    _, triple = np.unique(pair.reshape(-1) * many + codes[whole + 2], return_inverse=True)
    _, window, n = np.unique(owner[whole] * (int(triple.max(initial=0)) + 1) + triple.reshape(-1), return_inverse=True, return_counts=True)
    again = whole[n[window.reshape(-1)] > 1]
    covered = np.zeros(len(codes), bool)
    for step in range(3):
        covered[again + step] = True
    return np.bincount(owner[covered], minlength=rows)


def _dup_lines(data: np.ndarray, offsets: np.ndarray, words_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word of each row, and those of them equal to an earlier one."""
    rows = len(offsets) - 1
    cuts = np.flatnonzero(data == 0x0A)
    edges = np.unique(np.concatenate([offsets[:-1], cuts + 1, offsets[-1:]]))
    starts, ends = edges[:-1], edges[1:].copy()
    ends[data[ends - 1] == 0x0A] -= 1
    # A line break that ends a row belongs to it; the empty line behind it has no word.
    worded = np.searchsorted(words_at, ends) > np.searchsorted(words_at, starts)
    starts, ends = starts[worded], ends[worded]
    owner = np.searchsorted(offsets, starts, "right") - 1
    lines = np.bincount(owner, minlength=rows)
    if not len(starts):
        return lines, lines
    codes = _codes(_pieces(data, starts, ends))
    distinct = np.unique(owner * (int(codes.max()) + 1) + codes) // (int(codes.max()) + 1)
    return lines, lines - np.bincount(distinct, minlength=rows)


def count_batch(texts: pa.Array) -> list[np.ndarray]:
    """The columns of ``_BASE`` for a column of texts; null counts as empty."""
    found = [np.zeros(len(texts), np.int64) for _ in _BASE]
    is_symbol, is_white = np.zeros(256, bool), np.zeros(256, bool)
    is_symbol[list(_SYMBOLS)], is_white[list(W.WHITE)] = True, True
    for first, data, offsets in W.column_slices(texts, _SLICE_BYTES):
        rows = len(offsets) - 1
        starts, ends, owner = W.word_bounds(data, offsets)
        lines, dup = _dup_lines(data, offsets, starts)
        parts = [
            np.bincount(owner, minlength=rows),
            _counts_in(((data & 0xC0) != 0x80) & ~is_white[data], offsets),
            _counts_in(is_symbol[data], offsets),
            dup,
            _repeated_words(_codes(_pieces(data, starts, ends)), owner, rows),
            lines,
        ]
        for column, part in zip(found, parts, strict=True):
            column[first : first + rows] = part
    return found


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(id, lang, source, counts of each whole text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *map(pa.array, count_batch(batch.column(3)))], ["id", "lang", "source", *_BASE])

    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string"), F.col(source_col).cast("string"), F.col(text_col).cast("string"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(count, f"id {kind}, lang string, source string, " + ", ".join(f"{c} long" for c in _BASE))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def statistics() -> dict[str, Column]:
    """The whole numbers the rules compare, per thousand; 0 for texts without words."""

    def share(part: str, of: str) -> Column:
        return F.when(F.col(of) > 0, F.expr(f"(1000 * {part}) div {of}")).otherwise(F.lit(0)).cast("long")

    return {"word_length": share("word_chars", "n_words"), "symbols": share("n_symbols", "n_words"), "dup_lines": share("n_dup_lines", "n_lines"), "repeat_words": share("n_repeat_words", "n_words")}


def bucket(value: Column) -> Column:
    """The least value of the bucket of a whole number of 0 or more."""
    drop = F.greatest(F.length(F.bin(value)) - EXACT_BITS, F.lit(0)).cast("int")
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def sketches(rows: DataFrame) -> DataFrame:
    """(lang, source, statistic, bucket, n) of the rows that pass the base rules."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("statistic"), bucket(v).alias("bucket")) for k, v in statistics().items()]))
    return rows.filter(~base_failed()).select("lang", "source", each.alias("x")).groupBy("lang", "source", F.col("x.statistic").alias("statistic"), F.col("x.bucket").alias("bucket")).agg(F.count("*").alias("n"))


def _limits(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, rows, limits): fences of each group of ``keys``, from the merged sketch. Sketches are small: a row a bucket."""
    merged = sketch.groupBy(*keys, "statistic", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "statistic")
    placed = merged.withColumns({"up_to": F.sum("n").over(group.orderBy("bucket")), "rows": F.sum("n").over(group)})
    quartile = {q: F.min(F.when(4 * F.col("up_to") >= q * F.col("rows"), F.col("bucket"))) for q in (1, 3)}
    found = placed.groupBy(*keys, "statistic").agg(F.max("rows").alias("rows"), quartile[1].alias("q1"), quartile[3].alias("q3"))
    spread = F.create_map(*[F.lit(x) for pair in SPREAD.items() for x in pair])
    reach = REACH * F.greatest(F.col("q3") - F.col("q1"), spread[F.col("statistic")])
    found = found.withColumns({"high": F.col("q3") + reach, "low": F.when(F.col("statistic").isin(*TWO_SIDED), F.col("q1") - reach)})
    return found.groupBy(*keys).agg(F.max("rows").alias("rows"), F.map_from_entries(F.collect_list(F.struct("statistic", F.struct("low", "high")))).alias("limits"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """(lang, source, limits): a row for each pair of the sketch, those of small groups taken from the wider ones."""
    own, wide = (_limits(sketch, keys) for keys in (["lang", "source"], ["lang"]))
    wide = wide.select(F.col("lang").alias("_lang"), F.col("rows").alias("_wide"), F.col("limits").alias("_w"))
    # One row: the limits of all rows together.
    widest = _limits(sketch, []).first()["limits"]
    ends = F.create_map(*[x for k, v in widest.items() for x in (F.lit(k), F.struct(F.lit(v["low"]).cast("long").alias("low"), F.lit(v["high"]).cast("long").alias("high")))]) if widest else F.lit(None)
    limits = F.when(F.col("rows") >= LEAST_ROWS, F.col("limits")).when(F.col("_wide") >= LEAST_ROWS, F.col("_w")).otherwise(ends)
    return own.join(wide, F.col("lang").eqNullSafe(F.col("_lang")), "left").select("lang", "source", limits.alias("limits"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, limits) for each row of ``docs``.

    Null texts are empty: no words, so they fail the base rules. Null languages and sources are groups
    of their own. Ids may be null or repeated; repeated rows count as often as they stand. Other
    columns are not read, whatever their names. Texts that fail the base rules are in no sketch; their
    ``limits`` are null where the whole group fails. An empty table gives no rows.
    """
    rows = staged(counted(docs, id_col, text_col, lang_col, source_col), "text-counts")
    limits = staged(thresholds(staged(sketches(rows), "quality-sketches")), "quality-limits").toDF("_lang", "_source", "limits")
    both = rows.join(limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    within = F.lit(True)
    for name, value in statistics().items():
        limit = F.col("limits")[name]
        within = within & (value <= limit["high"])
        if name in TWO_SIDED:
            within = within & (value >= limit["low"])
    kept = ~base_failed() & F.coalesce(within, F.lit(True))
    return both.select(F.col("id").alias(id_col), *_BASE[:5], base_failed().alias("base_failed"), kept.alias("kept"), "limits")

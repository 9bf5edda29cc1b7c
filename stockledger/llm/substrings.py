"""Removal of word sequences that repeat across a corpus, on a compacted de Bruijn graph.

An edge of the graph is a window of ``window`` words; windows that follow each other share all words
but one. Each window is known by its minimizer, the least hash among its token k-mers (the leftmost
of equal ones), so equal windows have equal minimizers. Consecutive windows with the same minimizer
occurrence form a path, and one path stands for all its windows:

* A minimizer that occurs once has a path that repeats nowhere.
* If all paths of a minimizer hold the same words, none branches: the path is one edge, repeated.
* Otherwise the path branches. A path with an exact twin repeats whole. Each different path is taken
  apart once, at the source coordinates of one occurrence, and its windows are counted one by one.

Only paths are shuffled (about 7 per 100 words) and windows of branching paths. Windows are compared
by the minimizer's and the words' own independent hashes, 128 bits together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockledger.llm import words as W
from stockledger.llm.store import staged

WINDOW = 35
KMER = 8


def _leftmost_least(values: np.ndarray, size: int) -> np.ndarray:
    """Place of the leftmost least value in every ``size`` values in a row."""
    at, have = np.arange(len(values)), 1
    while have < size:
        step = min(have, size - have)
        near, far = at[:-step], at[step:]
        at = np.where(values[far] < values[near], far, near)
        have += step
    return at


def paths(data: np.ndarray, offsets: np.ndarray, window: int, kmer: int) -> tuple[np.ndarray, ...]:
    """(row, start word, windows, minimizer, content hash) of the paths of a run of texts."""
    starts, ends, owner = W.word_bounds(data, offsets)
    if len(starts) < window:
        return tuple(np.zeros(0, x) for x in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    hashes = W.word_hashes(data, starts, ends)
    grams = W.gram_hashes(hashes, kmer)
    place = _leftmost_least(grams, window - kmer + 1)
    valid = owner[: len(place)] == owner[window - 1 :]
    new = np.r_[True, (place[1:] != place[:-1]) | (owner[1 : len(place)] != owner[: len(place) - 1])]
    first = np.flatnonzero(valid & (new | ~np.r_[False, valid[:-1]]))
    # A path ends where the next begins or where windows would leave the text.
    stop = np.flatnonzero(np.r_[(valid[:-1] & (new[1:] | ~valid[1:])), valid[-1]]) + 1
    other = W.word_hashes(data, starts, ends, 1)
    content = W.range_hashes(other, first, stop + window - 1, 1)
    word_first = np.searchsorted(owner, np.arange(len(offsets) - 1))
    rows = owner[first]
    return rows, first - word_first[rows], stop - first, grams[place[first]], content


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, h, text): rows of the same id and text are told apart by nothing and share their results."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))


def _path_table(docs: DataFrame, window: int, kmer: int) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in W.column_slices(batch.column(2)):
                rows, starts, counts, least, content = paths(data, offsets, window, kmer)
                at = pa.array(rows + first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(starts.astype(np.int32)), pa.array(counts.astype(np.int32)), pa.array(W.signed(least)), pa.array(W.signed(content))],
                    ["id", "h", "start", "n", "m", "c"],
                )

    return docs.mapInArrow(find, "id long, h long, start int, n int, m long, c long")


def _compressed(docs: DataFrame) -> DataFrame:
    """(id, h, z): texts in the form in which they are shuffled."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(3).compress
        for batch in batches:
            z = pa.array([squeeze(x.as_buffer()) for x in batch.column(2).cast(pa.binary())], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), z], ["id", "h", "z"])

    return docs.mapInArrow(pack, "id long, h long, z binary")


def _with_lists(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    texts = _compressed(docs)
    lists = lists.withColumnsRenamed({"id": "_id", "h": "_h"})
    return texts.join(lists, texts.id.eqNullSafe(lists._id) & (texts.h == lists._h), how).drop("_id", "_h")


def _single_windows(docs: DataFrame, picked: DataFrame, window: int) -> DataFrame:
    """(m, w, id, h, at, alone): the windows of picked paths (id, h, start, n, m, alone)."""
    # A document's own paths, so the list is no longer than the document.
    lists = picked.groupBy("id", "h").agg(F.collect_list(F.struct("start", "n", "m", "alone")).alias("todo"))

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for row in range(batch.num_rows):
                data = np.frombuffer(unpack(batch.column(2)[row].as_buffer()), np.uint8)
                starts, ends, _ = W.word_bounds(data, np.array([0, len(data)]))
                grams = W.gram_hashes(W.word_hashes(data, starts, ends, 1), window, 1)
                todo = batch.column(3).slice(row, 1).flatten()
                first, n = todo.field("start").to_numpy(), todo.field("n").to_numpy()
                owner = np.repeat(np.arange(len(n)), n)
                at = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + first[owner]
                yield pa.RecordBatch.from_arrays(
                    [todo.field("m").take(pa.array(owner)), pa.array(W.signed(grams[at])), batch.column(0).take(pa.array(np.full(len(at), row))), batch.column(1).take(pa.array(np.full(len(at), row))), pa.array(at.astype(np.int32)), todo.field("alone").take(pa.array(owner))],
                    ["m", "w", "id", "h", "at", "alone"],
                )

    return _with_lists(docs, lists, "inner").mapInArrow(expand, "m long, w long, id long, h long, at int, alone boolean")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, kmer: int = KMER) -> DataFrame:
    """(id, h, start, stop): word ranges that windows occurring elsewhere cover; ranges may overlap.

    ``h`` is the hash of the text. A document with fewer words than ``window`` has none.
    """
    if not 0 < kmer <= window:
        raise ValueError("kmer is 1 to window")
    keyed = _keyed(docs, id_col, text_col)
    found = staged(_path_table(keyed, window, kmer), "paths")
    # Written first: joined straight to their own aggregate, the paths of a hot minimizer would stay in
    # the task that counted them. So both sides have an exchange, and a hot one is split.
    counted = found.groupBy("m").agg(F.count("*").alias("k"), F.min("c").alias("low"), F.max("c").alias("high"))
    shared = staged(counted.filter("k > 1").select("m", (F.col("low") != F.col("high")).alias("branches")), "shared-minimizers")
    repeated = staged(found.join(shared, "m"), "repeated-paths")
    whole = repeated.filter(~F.col("branches")).select("id", "h", "start", "n")
    branching = repeated.filter("branches").drop("branches")
    kinds = staged(branching.groupBy("m", "c").agg(F.count("*").alias("k"), F.min(F.struct("id", "h", "start", "n")).alias("one")), "branching-paths")
    twins = branching.join(kinds.filter("k > 1").select("m", "c"), ["m", "c"]).select("id", "h", "start", "n")
    windows = staged(_single_windows(keyed, kinds.select("one.*", "m", (F.col("k") == 1).alias("alone")), window), "windows")
    again = staged(windows.groupBy("m", "w").agg(F.count("*").alias("k")).filter("k > 1").select("m", "w"), "repeated-windows")
    single = windows.filter("alone").join(again, ["m", "w"]).select("id", "h", F.col("at").alias("start"), F.lit(1).alias("n"))
    ranges = whole.unionByName(twins).unionByName(single)
    return ranges.select("id", "h", "start", (F.col("start") + F.col("n") + window - 1).alias("stop"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, kmer: int = KMER, with_text: bool = True) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256, and text): each document without its repeated words.

    Words are runs of characters other than space and 09 to 0D, kept words are joined by one space.
    A word goes if a window of ``window`` words that covers it starts anywhere else too, in the same
    document or another; windows are judged on the input. Null and empty texts have no words. Rows
    stay as many as they are: repeated rows repeat each other, ids may repeat or be null, other
    columns are not read, and an empty table gives no rows.
    """
    keyed = _keyed(docs, id_col, text_col)
    # Ranges within one document, no more than it has words.
    lists = repeated_spans(docs, id_col, text_col, window, kmer).distinct().groupBy("id", "h").agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [])
            for row in range(batch.num_rows):
                parts = unpack(batch.column(2)[row].as_buffer()).split()
                ranges = batch.column(3)[row]
                total = len(parts)
                if ranges.is_valid:
                    spans = batch.column(3).slice(row, 1).flatten()
                    depth = np.zeros(total + 1, np.int64)
                    np.add.at(depth, spans.field("start").to_numpy(), 1)
                    np.subtract.at(depth, spans.field("stop").to_numpy(), 1)
                    parts = [parts[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]
                kept = b" ".join(parts)
                for column, value in zip(out, (total, total - len(parts), hashlib.sha256(kept).hexdigest(), kept.decode() if with_text else None), strict=True):
                    column.append(value)
            arrays = [batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())]
            yield pa.RecordBatch.from_arrays([*arrays, *([pa.array(out[3], pa.string())] if with_text else [])], ["id", "n_words", "n_removed", "kept_sha256", *(["text"] if with_text else [])])

    schema = "id long, n_words long, n_removed long, kept_sha256 string" + (", text string" if with_text else "")
    return _with_lists(keyed, lists, "left").mapInArrow(strip, schema).withColumnRenamed("id", id_col)

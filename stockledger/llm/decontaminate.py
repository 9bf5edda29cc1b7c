"""Benchmark decontamination: short test items inside long documents, by containment.

An item is found in a document that holds at least ``threshold`` of its distinct shingles. Items are
partitioned by size (powers of two of their shingle count). For a partition of size q, documents are
cut into blocks of q shingles, and two neighbouring blocks are one record: a passage as long as an
item of the partition lies within one record, whose size is thus at most four times the item's. That
bounds the Jaccard similarity of a contained item from below (0.2), and a MinHash signature of 64
values then misses it with a probability under 1e-6. Every match is verified by its exact shingles.

Words are runs of characters other than ASCII white space and punctuation, of the lower-cased text.
Shingles are five words. Items of one to four words are partitions of their own: each is one shingle of as
many words, and documents are searched for these words in a row.

The benchmark is the query set: its signatures go to all tasks in blocks of bounded size, one pass
over the documents each. Documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockledger.llm import words as W

SHINGLE_WORDS = 5
THRESHOLD = 0.8
HASHES = 64
ITEMS_PER_PASS = 20_000
ITEM_BYTES_PER_PASS = 64 << 20

# White space and ASCII punctuation.
SEPARATORS = W.WHITE + b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _multipliers() -> np.ndarray:
    return np.random.default_rng(10).integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _lowered(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(texts.cast(pa.large_string()).fill_null(""))


class _Shingles:
    """Shingle hashes of a run of texts; ``first`` has the place of each row's first one."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.data, rows = data, len(offsets) - 1
        self.starts, self.ends, owner = W.word_bounds(data, offsets, SEPARATORS)
        self.owner, self.words = owner, W.word_hashes(data, self.starts, self.ends)
        hashes = self.words
        self.word_first = np.searchsorted(owner, np.arange(rows + 1))
        grams = W.gram_hashes(hashes, SHINGLE_WORDS)
        whole = owner[: len(grams)] == owner[SHINGLE_WORDS - 1 :] if len(grams) else np.zeros(0, bool)
        counts = np.diff(self.word_first)
        short = np.flatnonzero((counts > 0) & (counts < SHINGLE_WORDS))
        owners = np.concatenate([owner[: len(grams)][whole], short])
        values = np.concatenate([grams[whole], W.range_hashes(hashes, self.word_first[short], self.word_first[short + 1])])
        order = np.argsort(owners, kind="stable") if len(short) else slice(None)
        self.values = values[order]
        self.first = np.searchsorted(owners[order], np.arange(rows + 1))

    def of(self, row: int) -> np.ndarray:
        return self.values[self.first[row] : self.first[row + 1]]

    def phrase(self, first: int, n: int) -> bytes:
        """The n words from a word on."""
        return b" ".join(self.data[self.starts[i] : self.ends[i]].tobytes() for i in range(first, first + n))

    def exact(self, row: int) -> set[bytes]:
        """The row's shingles themselves."""
        at = range(self.word_first[row], self.word_first[row + 1])
        parts = [self.data[self.starts[i] : self.ends[i]].tobytes() for i in at]
        if len(parts) < SHINGLE_WORDS:
            return {b" ".join(parts)} if parts else set()
        return {b" ".join(parts[i : i + SHINGLE_WORDS]) for i in range(len(parts) - SHINGLE_WORDS + 1)}


class Items:
    """A block of the benchmark: shingles and, by size, the values of the signatures."""

    def __init__(self, ids: list, texts: list[str | None]) -> None:
        self.ids, self.exact, hashes = [], [], []
        by_size: dict[int, list[int]] = {}
        brief: dict[int, list[tuple[int, int]]] = {}
        for first, data, offsets in W.column_slices(_lowered(pa.array(texts, pa.string()))):
            found = _Shingles(data, offsets)
            for row in range(len(offsets) - 1):
                n_words = int(found.word_first[row + 1] - found.word_first[row])
                if 0 < n_words < SHINGLE_WORDS:
                    brief.setdefault(n_words, []).append((W.gram_hashes(found.words[found.word_first[row] : found.word_first[row + 1]], n_words)[0], len(self.ids)))
                elif n_words:
                    by_size.setdefault(1 << int(len(found.of(row)) - 1).bit_length(), []).append(len(self.ids))
                if n_words:
                    self.ids.append(ids[first + row])
                    self.exact.append(found.exact(row))
                    hashes.append(np.unique(found.of(row)))
        self.hashes = hashes
        #: Of items of n words, below the length of a shingle: their sorted hashes and places.
        self.brief = {n: (np.array([h for h, _ in x], np.uint64), np.array([i for _, i in x])) for n, x in ((n, sorted(x)) for n, x in brief.items())}
        # size: for each hash function, sorted values and the item of each.
        self.signatures: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for size, members in sorted(by_size.items()):
            table = np.array([[(hashes[m] * a).min() for a in _multipliers()] for m in members], np.uint64)
            orders = np.argsort(table, axis=0, kind="stable")
            self.signatures[size] = [(table[orders[:, j], j], np.array(members)[orders[:, j]]) for j in range(HASHES)]

    def candidates(self, shingles: _Shingles) -> set[tuple[int, int]]:
        """Pairs (row, item) of which a record and the item share a signature value."""
        found: set[tuple[int, int]] = set()
        if not len(shingles.values) or not self.signatures:
            return found
        least = min(self.signatures)
        columns, owners = _columns(shingles.first, least)
        blocks, plans = shingles.values[columns], _halvings(owners, least, max(self.signatures))
        for j, a in enumerate(_multipliers()):
            values = (blocks * a).min(axis=0)
            for size, starts, owners in plans:
                if size > least:
                    values = np.minimum.reduceat(values, starts)
                if size not in self.signatures:
                    continue
                records = values.copy()
                same = owners[1:] == owners[:-1]
                np.minimum(values[:-1], values[1:], out=records[:-1], where=same)
                sought, items = self.signatures[size][j]
                at = np.searchsorted(sought, records)
                for hit in np.flatnonzero(sought[np.minimum(at, len(sought) - 1)] == records):
                    last = np.searchsorted(sought, records[hit], "right")
                    found.update((int(owners[hit]), int(x)) for x in items[at[hit] : last])
        return found

    def phrases(self, shingles: _Shingles) -> set[tuple[int, int]]:
        """Pairs (row, item) of items of fewer words than a shingle that stand in a row of words."""
        found: set[tuple[int, int]] = set()
        for n, (sought, items) in self.brief.items():
            grams = W.gram_hashes(shingles.words, n)
            at = np.searchsorted(sought, grams)
            hits = np.flatnonzero((sought[np.minimum(at, len(sought) - 1)] == grams) & (shingles.owner[: len(grams)] == shingles.owner[n - 1 :][: len(grams)]))
            # Of a hash that a row has many times, one occurrence is read.
            _, once = np.unique(np.stack([shingles.owner[hits], at[hits]]), axis=1, return_index=True)
            for hit in hits[once]:
                phrase = shingles.phrase(hit, n)
                last = np.searchsorted(sought, grams[hit], "right")
                found.update((int(shingles.owner[hit]), int(i)) for i in items[at[hit] : last] if phrase in self.exact[i])
        return found

    def matches(self, texts: pa.Array, threshold: float) -> Iterator[tuple[int, int, int]]:
        """(row, item, shared shingles) of all matches in a column of texts."""
        for first, data, offsets in W.column_slices(_lowered(texts)):
            shingles = _Shingles(data, offsets)
            for row, item in sorted(self.phrases(shingles)) if self.brief else ():
                yield first + row, item, 1
            kept: tuple[int, set[bytes]] = (-1, set())
            for row, item in sorted(self.candidates(shingles)):
                need = threshold * len(self.exact[item]) - 1e-9
                if np.isin(self.hashes[item], shingles.of(row)).sum() < need:
                    continue
                if kept[0] != row:
                    kept = (row, shingles.exact(row))
                shared = len(self.exact[item] & kept[1])
                if shared >= need:
                    yield first + row, item, shared


def _columns(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of each block's values, a column per block, and the blocks' rows. The last value of a row fills up."""
    counts = -(-np.diff(first) // size)
    owners = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(len(owners)) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.minimum(first[owners] + within * size + np.arange(size)[:, None], first[owners + 1] - 1), owners


def _halvings(owners: np.ndarray, least: int, most: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For sizes least, twice that, ...: where the blocks start among those of half the size, and their rows."""
    plans, size = [(least, np.arange(len(owners)), owners)], least
    while size < most:
        size *= 2
        first = np.flatnonzero(np.r_[True, owners[1:] != owners[:-1]])
        within = np.arange(len(owners)) - np.repeat(first, np.diff(np.r_[first, len(owners)]))
        starts = np.flatnonzero(within % 2 == 0)
        owners = owners[starts]
        plans.append((size, starts, owners))
    return plans


def item_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text", most: int = ITEMS_PER_PASS, most_bytes: int = ITEM_BYTES_PER_PASS) -> Iterator[Items]:
    """The benchmark in blocks of about ``most`` items and ``most_bytes``, each small enough for every task; the driver holds one at a time."""
    rows = items.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    n, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // most), -(-size // most_bytes))
    for block in range(blocks):
        part = rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).collect()
        yield Items([x["id"] for x in part], [x["text"] for x in part])


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, item, n_shingles, n_shared, containment): a row per document and item found in it.

    Texts that are null, empty or only punctuation hold nothing and are found nowhere. Repeated
    documents and repeated items give a row each; ids may be null; other columns are not read. Empty
    tables give no rows.
    """
    kind = items.schema[item_id].dataType.simpleString()
    spark, found = docs.sparkSession, None
    for block in item_blocks(items, item_id, item_text):
        shared_block = spark.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], sent=shared_block) -> Iterator[pa.RecordBatch]:
            own = sent.value
            for batch in batches:
                hits = list(own.matches(batch.column(1), threshold))
                rows = pa.array([x[0] for x in hits], pa.int64())
                sizes = [len(own.exact[x[1]]) for x in hits]
                ids = batch.column(0).take(rows)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([str(own.ids[x[1]]) if own.ids[x[1]] is not None else None for x in hits], pa.string()), pa.array(sizes, pa.int64()), pa.array([x[2] for x in hits], pa.int64())],
                    ["id", "item", "n_shingles", "n_shared"],
                )

        part = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(search, "id long, item string, n_shingles long, n_shared long")
        found = part if found is None else found.unionByName(part)
    return found.select(F.col("id").alias(id_col), F.col("item").cast(kind).alias(item_id), "n_shingles", "n_shared", (F.col("n_shared") / F.col("n_shingles")).alias("containment"))


def drop_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item. Rows as in ``find_leaks``."""
    spark = docs.sparkSession
    at = docs.columns.index(text_col)
    for block in item_blocks(items, item_id, item_text):
        shared_block = spark.sparkContext.broadcast(block)

        def keep(batches: Iterator[pa.RecordBatch], sent=shared_block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                clean[[x[0] for x in sent.value.matches(batch.column(at), threshold)]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs

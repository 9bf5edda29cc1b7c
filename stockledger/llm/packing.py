"""Concatenate and cut: all documents become one stream of token ids, cut into windows of fixed size.

Pass one tokenizes and writes each document's ids with the running total of its partition; the totals
of the partitions, prefix-summed, give every document its place in the stream. Pass two cuts at the
window boundaries. Only the partition totals (one row each) ever meet.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockledger.llm.store import staged

WINDOW = 1024
END_ID = 0
TOKENIZER = "byte_bpe_50k.json"

# Words split from a text at single spaces tokenize alone as they do in the text. Texts with other
# white space next to each other are split only at spaces between two other characters.
_IRREGULAR = re.compile(r"\s\s|[^\S \n]|\A\s|\s\Z")
_SAFE_SPLIT = re.compile(r"(?<=\S)(?= \S)")
_KEPT_WORDS = 1_000_000


class _ByteLetters(dict):
    """Characters as the vocabulary writes their bytes."""

    def __init__(self) -> None:
        from tokenizers import pre_tokenizers

        self.level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def __missing__(self, code: int) -> str:
        self[code] = self.level.pre_tokenize_str(chr(code))[0][0]
        return self[code]


class WordTokenizer(dict):
    """Ids of whole texts, by the tokenizer's own ids of each distinct word.

    The vocabulary splits a text before each single space before it merges bytes, so the ids of a text
    are those of its words in a row. The same holds before a comma or full stop after a letter. Words
    are encoded once per worker and kept, the first ``_KEPT_WORDS`` of them; the rest are encoded
    each time. Ids are bytes, little-endian, four each.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge, self.letters = self.tokenizer.model.tokenize, _ByteLetters()
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]

    def __missing__(self, piece: str) -> bytes:
        last = piece[-1:]
        if (last == "," or last == ".") and piece[-2:-1].isalpha():
            code = self[piece[:-1]] + self[last]
        elif piece.isalpha() or piece[:1] == " " and piece[1:].isalpha():  # one run of letters: nothing to split
            ids = [x.id for x in self.merge(piece.translate(self.letters))]
            code = struct.pack(f"<{len(ids)}I", *ids)
        else:
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
            code = struct.pack(f"<{len(ids)}I", *ids)
        if len(self) < _KEPT_WORDS:
            self[piece] = code
        return code

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if any(x in text for x in self.special):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        if "\0" in text or _IRREGULAR.search(text):
            pieces = _SAFE_SPLIT.split(text)
        else:  # each space or line end stands alone between two words; a space belongs to the word after it
            pieces = text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
        return b"".join(map(self.__getitem__, pieces))


_tokenizers: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """One per worker process, for all its tasks."""
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_stream(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int | None = END_ID) -> DataFrame:
    """(id, part, before, n, ids) per document: ``before`` counts the tokens ahead of it in its partition.

    ``ids`` are bytes, little-endian, two each if the vocabulary has at most 65,536 ids, else four.
    ``tokenizer`` is the vocabulary file on the machines; the default is looked up there.
    """

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokenizer(tokenizer or tokenizer_path())
        width = _width(words.tokenizer.get_vocab_size(), end_id)
        end = b"" if end_id is None else np.array([end_id], width).tobytes()
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, starts, sizes = [], [], []
            for text in batch.column(1):
                code = np.frombuffer(words.encode(text.as_py() or ""), "<u4").astype(width).tobytes() + end
                starts.append(before)
                sizes.append(len(code) // int(width[-1]))
                before += sizes[-1]
                ids.append(code)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array([part] * len(ids), pa.int32()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array([int(width[-1])] * len(ids), pa.int32())],
                ["id", "part", "before", "n", "ids", "width"],
            )

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(tokenize, "id long, part int, before long, n long, ids binary, width int")


def _width(vocabulary: int, end_id: int | None) -> str:
    return "<u2" if max(vocabulary, (end_id or 0) + 1) <= 1 << 16 else "<u4"


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, tokenizer: str | None = None, end_id: int | None = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece of a document in a sequence; its boundaries are start and offset.

    Columns: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ``ids`` (array) on
    request. Every id is in exactly one piece. All sequences but the last are full, so at most one
    is padded. Null and empty texts are the end id alone, or nothing if that is None. Repeated ids and
    null ids are documents of their own; other columns are not read; an empty table gives no rows.
    """
    stream = staged(token_stream(docs, id_col, text_col, tokenizer, end_id), "token-stream")
    totals = stream.groupBy("part").agg(F.sum("n").alias("total"))
    # One row of two numbers per partition of the scan, so its size is bounded by the number of tasks:
    # 100 TB in splits of 128 MB are 800,000 rows, 13 MB. The window over them runs in one task.
    places = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("first"))
    placed = stream.join(F.broadcast(places), "part").select("id", (F.col("first") + F.col("before")).alias("at"), "n", "ids", "width")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, sizes = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            places, codes, widths = batch.column(1).to_pylist(), batch.column(3), batch.column(4).to_pylist()
            rows: list[tuple] = []
            for name, n, at, code, width in zip(names, sizes, places, codes, widths, strict=True):
                ids = np.frombuffer(code.as_buffer(), f"<u{width}").astype("<u4")
                start = 0
                while start < n:
                    sequence, offset = divmod(at + start, window)
                    length = min(window - offset, n - start)
                    piece = ids[start : start + length]
                    rows.append((name, start, length, zlib.crc32(piece.tobytes()), n, sequence, offset, piece if with_ids else None))
                    start += length
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 8
            arrays = [pa.array(x, pa.int64()) for x in columns[:7]]
            yield pa.RecordBatch.from_arrays([*arrays, *([pa.array(columns[7], pa.list_(pa.int64()))] if with_ids else [])], [*_PIECE, *(["ids"] if with_ids else [])])

    schema = ", ".join(f"{x} long" for x in _PIECE) + (", ids array<long>" if with_ids else "")
    pieces = placed.mapInArrow(cut, schema)
    return pieces.withColumnRenamed("id", id_col)


_PIECE = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

"""Words and word n-grams of whole Arrow columns in numpy.

A word is a maximal run of bytes other than the separators. All functions take the UTF-8 bytes of
many texts at once; UTF-8 keeps the separators (ASCII) apart from the bytes of other characters.
Hashes are 64 bits: random values of the bytes, weighted by powers of an odd number and mixed. Two
``seed`` values give independent hashes, together 128 bits. Such sums are weak for long sequences (from
about a thousand values on, two that follow the Thue-Morse pattern agree for every odd number), so
words of more than ``LONG_WORD`` bytes are hashed by XXH64, and n-grams are meant for short n.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash

# ASCII white space, space and 09 to 0D.
WHITE = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])

SLICE_BYTES = 1 << 20
LONG_WORD = 64


def column_slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Cuts a string column into runs of rows of about ``most`` bytes, so that work arrays stay small.

    Yields the first row, the bytes and the offsets (one more than rows). Null counts as empty. A row
    longer than ``most`` comes alone and whole.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if len(texts) == 0:
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        last = min(last, len(texts))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


@lru_cache(8)
def _separators(separators: bytes) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(separators)] = True
    return found


def word_bounds(data: np.ndarray, offsets: np.ndarray, separators: bytes = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the row it belongs to."""
    inside = ~_separators(separators)[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    starts[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@lru_cache(8)
def _byte_values(seed: int) -> np.ndarray:
    return np.random.default_rng(1000 + seed).integers(1, 1 << 63, 256, dtype=np.uint64)


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base`` to the power 0 to n - 1, modulo 2 to the 64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if n <= 1 << 23:
            _powers[base] = have
    return have[:n]


def _weighted_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Sum of values[start + i] * base**i for each range."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=sums[1:])
    inverse = pow(base, -1, 1 << 64)
    return (sums[ends] - sums[starts]) * powers(inverse, len(values) + 1)[starts]


# Odd bases of the hashes of two seeds, of bytes and of words.
_BYTE_BASES = (0x8B72A2F1C0D45E6D, 0xB5297A4D3F84D5B5)
_WORD_BASES = (0xC2B2AE3D27D4EB4F, 0x94D049BB133111EB)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    found = mixed(_weighted_sums(_byte_values(seed)[data], starts, ends, _BYTE_BASES[seed]))
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        found[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes(), seed)
    return found


def gram_hashes(words: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hashes of every n words in a row, also across rows: the caller drops those."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    starts = np.arange(len(words) - n + 1)
    return mixed(_weighted_sums(words, starts, starts + n, _WORD_BASES[seed]))


def range_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hashes of words[start:end] for each range."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    return mixed(_weighted_sums(words, starts, ends, _WORD_BASES[seed]))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)

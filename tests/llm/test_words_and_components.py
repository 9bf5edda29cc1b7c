"""Word hashes against plain Python, and components against a search."""

import random

import numpy as np
import pyarrow as pa
from conftest import rows

from stockledger.llm import words as W
from stockledger.llm.components import components


def test_words_are_runs_of_other_bytes(edge_texts):
    for first, data, offsets in W.column_slices(pa.array(edge_texts, pa.string()), 4_000):
        starts, ends, owner = W.word_bounds(data, offsets)
        got = [(int(o) + first, data[s:e].tobytes()) for s, e, o in zip(starts, ends, owner)]
        want = [(i, w) for i in range(first, first + len(offsets) - 1) for w in (edge_texts[i] or "").encode().split()]
        assert got == want


def test_equal_words_and_grams_hash_alike_and_others_apart(edge_texts):
    seen, grams = {}, {}
    for _, data, offsets in W.column_slices(pa.array(edge_texts, pa.string()), 3_000):
        starts, ends, _ = W.word_bounds(data, offsets)
        hashes = W.word_hashes(data, starts, ends)
        words = [data[s:e].tobytes() for s, e in zip(starts, ends)]
        for w, h in zip(words, hashes):
            assert seen.setdefault(w, h) == h
        for i, h in enumerate(W.gram_hashes(hashes, 3)):
            assert grams.setdefault(tuple(words[i : i + 3]), h) == h
    assert len(set(seen.values())) == len(seen) and len(set(grams.values())) == len(grams)


def test_components_equal_a_search(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(140)] + [(i, i + 1) for i in range(1000, 1060)] + [(7, 7), (5000, 5000), (None, 3)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = components(spark.createDataFrame(links, "a long, b long"))
    assert rows(got, "node", "component") == rows(spark.createDataFrame([(x, find(x)) for x in root], "node long, component long"))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_leftmost_least_equals_argmin():
    from stockledger.llm.substrings import _leftmost_least

    values = np.random.default_rng(0).integers(0, 5, 200).astype(np.uint64)
    for size in (1, 2, 3, 28):
        assert _leftmost_least(values, size).tolist() == [i + int(values[i : i + size].argmin()) for i in range(len(values) - size + 1)]

"""Substrings, SimHash and embeddings against brute force."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
import xxhash
from conftest import rows

import corpus_pipeline

from stockledger.llm import embeddings, simhash, substrings

from .conftest import frame


def joined(pairs, items):
    root = {x: x for x in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in items}


@pytest.mark.parametrize("window,kmer", [(35, 8), (5, 5), (4, 1)])
def test_remove_repeats_equals_brute_force(spark, edge_texts, window, kmer):
    texts = [x for x in edge_texts if len(x or "") < 20_000]
    docs = [(x or "").encode().split() for x in texts]
    seen = Counter(tuple(d[i : i + window]) for d in docs for i in range(len(d) - window + 1))
    want = []
    for n, d in enumerate(docs):
        gone = {j for i in range(len(d) - window + 1) if seen[tuple(d[i : i + window])] > 1 for j in range(i, i + window)}
        kept = b" ".join(w for j, w in enumerate(d) if j not in gone)
        want.append((n, len(d), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    got = substrings.remove_repeats(frame(spark, texts), window=window, kmer=kmer)
    assert sorted(map(tuple, got.collect())) == want


def test_words_of_like_sums_are_told_apart(spark):
    """Two documents that differ in one long word, a run of a and b in Thue-Morse order, share no window."""
    runs = ["".join("ab"[(i.bit_count() + flip) % 2] for i in range(2_048)) for flip in (0, 1)]
    texts = [" ".join([f"w{i}" for i in range(25)] + [run] + [f"w{i}" for i in range(25, 49)]) for run in runs]
    got = substrings.remove_repeats(frame(spark, texts), with_text=False)
    assert [(r.n_words, r.n_removed) for r in got.collect()] == [(50, 0), (50, 0)]


def test_remove_repeats_with_repeated_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(40))
    got = substrings.remove_repeats(frame(spark, [text, text, "other words", None], [5, 5, None, None]), with_text=False)
    assert Counter(r[0:3] for r in map(tuple, got.collect())) == Counter({(5, 40, 40): 2, (None, 2, 0): 1, (None, 0, 0): 1})
    assert substrings.remove_repeats(frame(spark, [])).count() == 0


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def test_simhash_equals_brute_force(spark, edge_texts):
    got = simhash.near_duplicates(frame(spark, edge_texts))
    prints = {i: plain_fingerprint(x) for i, x in enumerate(edge_texts)}
    pairs = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    groups = joined(pairs, prints)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got.collect()} == {i: (f"{p:016x}", groups[i]) for i, p in prints.items()}
    kept = simhash.drop_near_duplicates(frame(spark, edge_texts))
    assert kept.columns == frame(spark, []).columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(groups.values()))


def test_simhash_links_lose_none(spark):
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 64, 60, dtype=np.uint64)
    fps = list(base)
    for x in base:
        for bits in (1, 2, 3, 4, 5):
            flip = rng.choice(64, bits, replace=False)
            fps.append(x ^ np.bitwise_or.reduce(np.uint64(1) << flip.astype(np.uint64)))
    fps = sorted(set(np.array(fps, np.uint64).view(np.int64).tolist()))
    got = simhash.links(spark.createDataFrame([(x,) for x in fps], "fp long"))
    want = [(a, b) for a in fps for b in fps if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_simhash_repeated_and_null_ids(spark):
    docs = frame(spark, ["a b c d e f", "a b c d e f", "z", "z", None], [4, 4, 2, None, None])
    assert rows(simhash.drop_near_duplicates(docs), "doc_id", "text") == sorted([(4, "a b c d e f"), (2, "z"), (None, "z"), (None, None)], key=lambda r: [(v is None, str(v)) for v in r])
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


@pytest.mark.parametrize("block", [768, 20])
def test_embeddings_equal_brute_force(spark, block):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=16)
    hot = [(centre + rng.normal(size=16) * 0.08).astype("f4").tolist() for _ in range(70)]
    rest = [rng.normal(size=16).astype("f4").tolist() for _ in range(40)]
    near = [[c * 3 + float(e) for c, e in zip(x, rng.normal(size=16) * 0.05)] for x in rest[:20]]
    odd = [None, [], [0.0] * 16, [math.nan] * 16, [math.inf] * 16, [None] * 16, [1.0, 2.0], [2.0, 4.0], [1e300] * 16]
    vectors = [*hot, *rest, *near, hot[0], hot[0], *odd]
    labels = [1] * len(vectors)
    labels[71], labels[115], labels[3] = 2, None, None
    data = [(i, v, l, "x") for i, (v, l) in enumerate(zip(vectors, labels))]
    got = embeddings.near_duplicates(spark.createDataFrame(data, "vec_id long, embedding array<double>, label int, id string"), block=block)

    def cosine(a, b):
        a, b = (np.array(x) / max(map(abs, x)) for x in (a, b))
        return a @ b / np.linalg.norm(a) / np.linalg.norm(b)

    good = [i for i, v in enumerate(vectors) if labels[i] and v and None not in v and all(map(math.isfinite, v)) and any(v)]
    pairs = [(a, b) for a in good for b in good if a < b and labels[a] == labels[b] and len(vectors[a]) == len(vectors[b]) and cosine(vectors[a], vectors[b]) >= 0.93]
    groups, counts = joined(pairs, range(len(vectors))), Counter(x for p in pairs for x in p)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got.collect()} == {i: (counts[i], groups[i], groups[i] == i) for i in range(len(vectors))}


def test_embeddings_empty(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_pipeline_stage_keeps_one_of_each_simhash_group(spark, edge_texts):
    words = [f"w{i}" for i in range(400)]
    texts = [*edge_texts, " ".join(words), " ".join([*words[:200], "edit", *words[201:]]), "quite another text of a few words"]
    prints = {i: plain_fingerprint(x) for i, x in enumerate(texts)}
    groups = joined([(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3], prints)
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    kept = stage(spark, frame(spark, texts), "/root/testdata/sf0.01")
    assert kept.columns == frame(spark, []).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(groups.values()))


def test_simhash_keeps_unlike_texts_of_one_id(spark):
    one, other = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    docs = frame(spark, [one, other, other, one, one], [4, 4, 4, 7, 4])
    assert rows(simhash.drop_near_duplicates(docs), "doc_id", "text") == [(4, one), (4, other)]

"""Adaptive quality rules and vector codes against plain Python."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from stockledger.llm import codes, rules
from stockledger.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words int, kept string, bucket int, statistic string, limits string, id int"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, source, 0, 1, "x", 2, "y", "z", 3) for i, t, lang, source in rows], SCHEMA)


def counts(text):
    words = (text or "").encode().split()
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return len(words), sum(len(w.decode()) for w in words), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), len(lines)


def plain_rules(rows):
    """(id, counts, base_failed, kept) with quartiles of the bucketed values themselves."""
    found, values = [], defaultdict(lambda: defaultdict(list))
    low_of = lambda v: v if v < 64 else v >> v.bit_length() - 6 << v.bit_length() - 6
    for i, text, lang, source in rows:
        n, chars, symbols, dup, again, lines = c = counts(text)
        failed = n < 50 or 100 * again > 50 * n
        stats = {"word_length": 1000 * chars // n if n else 0, "symbols": 1000 * symbols // n if n else 0, "dup_lines": 1000 * dup // lines if lines else 0, "repeat_words": 1000 * again // n if n else 0}
        found.append((i, c[:5], failed, stats, lang, source))
        if not failed:
            for key in ((lang, source), (lang,), ()):
                for k, v in stats.items():
                    values[key][k].append(low_of(v))

    def inside(stats, lang, source):
        key = next((k for k in ((lang, source), (lang,)) if len(values[k]["symbols"]) >= rules.LEAST_ROWS), ())
        for k, v in stats.items():
            order = sorted(values[key][k])
            q1, q3 = order[math.ceil(len(order) / 4) - 1], order[math.ceil(3 * len(order) / 4) - 1]
            reach = 3 * max(q3 - q1, rules.SPREAD[k])
            if v > q3 + reach or (k == "word_length" and v < q1 - reach):
                return False
        return True

    return [(i, *c, failed, not failed and inside(stats, lang, source)) for i, c, failed, stats, lang, source in found]


def many(rng, n, lang, source, length=5, symbol=0.0):
    words = lambda: " ".join("".join(rng.choice(list("abcdeé"), max(1, int(rng.normal(length, 1))))) + ("#" if rng.random() < symbol else "") for _ in range(60))
    return [(int(rng.integers(0, 10**6)), words() + "\n" + words(), lang, source) for _ in range(n)]


def test_rules_equal_brute_force(spark, edge_texts):
    rng = np.random.default_rng(12)
    rows = [(i, x, "en", "a") for i, x in enumerate(edge_texts)]
    rows += many(rng, 210, "en", "a") + many(rng, 210, "en", "b", symbol=0.5) + many(rng, 20, "en", "c") + many(rng, 30, "de", "a", 12) + many(rng, 210, None, None, 9)
    # Symbols are common in source b and odd elsewhere; long words are common without a language.
    rows += many(rng, 3, "en", "a", symbol=0.5) + many(rng, 3, "en", "b", symbol=0.5) + many(rng, 3, "en", "a", 14) + many(rng, 3, None, None, 11)
    rows += [(None, rows[-1][1], "en", None), (None, None, None, "a"), (5, "same line here\n" * 2 + rows[40][1], "en", "a"), (5, rows[40][1], "en", "a"), (5, rows[40][1], "en", "a")]
    rows += [(8, "a\rb\n\n \na\rb\nc\x1fd e f\n", "fr", "x")]
    got = rules.judge(documents(spark, rows).repartition(5)).drop("limits").collect()
    want = plain_rules(rows)
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    kept = Counter(x[-1] for x in want if not x[-2])
    assert kept[True] > 500 and kept[False] > 5


def test_rules_of_one_text_and_of_none(spark):
    assert rules.judge(documents(spark, [])).count() == 0
    assert [tuple(r)[1:8] for r in rules.judge(documents(spark, [(1, None, None, None)])).collect()] == [(0, 0, 0, 0, 0, True, False)]


def test_rules_sketches_merge(spark):
    """The sketch of all rows is the sum of those of any parts."""
    rows = documents(spark, many(np.random.default_rng(1), 300, "en", "a"))
    counted = rules.counted(rows)
    first, rest = counted.filter("id % 3 = 0"), counted.filter("id % 3 <> 0")
    keys = ["lang", "source", "statistic", "bucket"]
    whole = {tuple(r[k] for k in keys): r["n"] for r in rules.sketches(counted).collect()}
    parts = Counter()
    for part in (first, rest):
        parts.update({tuple(r[k] for k in keys): r["n"] for r in rules.sketches(part).collect()})
    assert whole == parts


def test_rules_leave_clean_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [r for r in QUERIES["op12_quality_rules"](spark, sf).collect() if not r.base_failed and labels.get(r.doc_id) is not None]
    share = lambda q: np.mean([r.kept for r in got if labels[r.doc_id] == q])
    assert share(1) >= 0.97 and share(0) <= 0.3


def plain_codes(rows, entries=256):
    good = [(i, [math.floor(1024 * float(x)) for x in v], l) for i, v, l in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    good.sort(key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    width = len(good[0][1]) // 4
    part = lambda v, p: v[p * width : (p + 1) * width]
    books = [[part(v, p) for _, v, _ in good[:entries]] for p in range(4)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))
    for _ in range(4):
        for p in range(4):
            groups = defaultdict(list)
            for _, v, _ in good:
                groups[near(part(v, p), books[p])[1]].append(part(v, p))
            for e, members in groups.items():
                books[p][e] = [sum(c) // len(members) for c in zip(*members)]
    found, by_label = [], Counter()
    for i, v, l in good:
        best = [near(part(v, p), books[p]) for p in range(4)]
        found.append((i, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), l))
        by_label[l] += found[-1][2]
    digest = hashlib.sha256(",".join(str(x) for book in books for c in book for x in c).encode()).hexdigest()
    return [(i, code, e, by_label[l], digest) for i, code, e, l in found]


def vectors(spark, rows, folder):
    spark.createDataFrame([(i, v, l, 0, [1], 5) for i, v, l in rows], "vec_id long, embedding array<float>, label int, id int, v array<int>, error int").repartition(3).write.parquet(f"{folder}/embeddings.parquet")
    return sorted(map(tuple, QUERIES["op13_vector_codes"](spark, str(folder)).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=str)


@pytest.mark.parametrize("n", [6, 300])
def test_codes_equal_brute_force(spark, tmp_path, n):
    rng = np.random.default_rng(n)
    centres = rng.normal(size=(5, 8))
    x = (centres[rng.integers(0, 5, n)] + rng.normal(size=(n, 8)) * 0.02).astype("f4")
    rows = [(int(rng.integers(0, 10 * n)), v.tolist(), int(l) or None) for v, l in zip(x, rng.integers(0, 3, n))]
    # Repeated vectors and ids, one value many times (ties of distance), null ids, and rows that drop out.
    rows += [rows[0], rows[1], (None, rows[2][1], 1), (None, rows[3][1], None), (17, None, 1), (18, [math.nan] * 8, 1), (19, [math.inf] + [0.0] * 7, 1), (20, [None] * 8, 1), (0, [0.0] * 8, 1), (1, [-0.5 / 1024] * 8, 1), (2, [0.0] * 8, 2), (3, [1 / 1024] * 8, 2)]
    assert vectors(spark, rows, tmp_path) == sorted(plain_codes(rows), key=str)


def test_balls_skip_nothing_that_matters():
    """Whatever entry a part comes from, the ring search finds what a look at all entries finds, ties included."""
    rng = np.random.default_rng(3)
    entries = rng.integers(-3, 4, (40, 3))
    x = rng.integers(-4, 5, (2_000, 3))
    found, best = codes.Balls(entries).nearest(x, rng.integers(0, 40, 2_000))
    apart = ((x[:, None] - entries) ** 2).sum(axis=2)
    assert (found == apart.argmin(axis=1)).all() and (best == apart.min(axis=1)).all()


def test_codes_of_odd_tables(spark, tmp_path):
    frame = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    none, books = codes.encode(frame([(1, None, 2), (2, [math.nan] * 4, 1)]))
    assert none.count() == 0 and books.shape == (4, 0, 0)
    blank, _ = codes.encode(frame([(1, [], 2), (2, [], 1)]))
    assert [tuple(r) for r in blank.orderBy("vec_id").collect()] == [(1, 2, [0] * 4, 0), (2, 1, [0] * 4, 0)]
    for bad in ([(1, [1.0] * 4, 1), (2, [1.0] * 8, 1)], [(1, [1.0] * 6, 1)], [(1, [1e300] * 4, 1)]):
        with pytest.raises(ValueError):
            codes.encode(frame(bad))

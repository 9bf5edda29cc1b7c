"""Gradients, rule columns and held-out accuracy of the classifiers."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stockledger.llm import quality, toxicity
from stockledger.llm import words as W

from .conftest import frame

SF = "/root/testdata/sf0.01"


def auc(score, y):
    rank = np.argsort(np.argsort(score)) + 1
    return (rank[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() + 1) / 2) / ((y == 1).sum() * (y == 0).sum())


def test_network_gradients_are_those_of_differences():
    rng = np.random.default_rng(0)
    texts = toxicity.Texts(*next(iter(W.column_slices(pa.array(["a b c d", "e f", "g " * 70]))))[1:])
    net = toxicity.Network(np.unique(texts.hashes[:-1]), 3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    places, inside = texts.batch(np.arange(len(texts.row)))
    y, weight, x = np.array([1.0, 0, 1, 0][: len(texts.row)]), rng.random(len(texts.row)), net.inputs(texts).astype(np.float64)

    def loss():
        p = toxicity._sigmoid(net.forward(net.gates(x), places, inside))
        return float((weight * -(y * np.log(p) + (1 - y) * np.log(1 - p))).mean())

    g, d_x = net.gradients(x, places, inside, y, weight)
    for name in ("x", "b", "u", "att", "att_b", "att_v", "out", "out_b"):
        at = tuple(int(rng.integers(0, n)) for n in net.p[name].shape)
        net.p[name][at] += 1e-2
        up = loss()
        net.p[name][at] -= 2e-2
        down = loss()
        net.p[name][at] += 1e-2
        assert abs((up - down) / 2e-2 - g[name][at]) < 2e-3, name
    assert d_x.shape == x.shape


def test_windows_overlap_and_cover_all_words():
    n = [0, 1, 63, 64, 65, 96, 97, 500]
    texts = toxicity.Texts(*next(iter(W.column_slices(pa.array(["w " * k for k in n]))))[1:])
    for row, k in enumerate(n):
        own = texts.row == row
        first, length = texts.first[own] - (texts.first[own].min()), texts.length[own]
        assert first[-1] + length[-1] == max(1, k) and (np.diff(first) == toxicity.STRIDE).all() and (length[:-1] == toxicity.WINDOW).all()


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_quality_ranks_held_out_documents(spark, labelled):
    docs, labels = labelled
    model = quality.fit(docs, labels)
    rows = quality.score(docs, model).join(labels, "doc_id").filter(quality.held_out(F.col("doc_id"))).select("doc_id", "score", "quality").toPandas()
    assert all(zlib.crc32(str(i).encode()) % 5 == 0 for i in rows.doc_id)
    assert auc(rows.score.to_numpy(), rows.quality.to_numpy()) > 0.97 and len(model.rules) < 200


def test_rule_column_equals_the_model(spark):
    rng = np.random.default_rng(1)
    x = rng.random((400, len(quality.STATISTICS)))
    y = ((x[:, 0] > 0.5) & (x[:, 3] < 0.6)).astype(float)
    model = quality.fit_rules(x, y)
    df = spark.createDataFrame([tuple(map(float, r)) for r in x[:60]], ", ".join(f"{k} double" for k in quality.STATISTICS))
    got = np.array([r[0] for r in df.select(model.column(F.struct(*quality.STATISTICS))).collect()])
    assert np.allclose(got, model.score(x[:60])) and auc(model.score(x), y) > 0.99


def test_classifiers_on_edge_rows(spark, edge_texts):
    docs = frame(spark, edge_texts)
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(len(edge_texts))] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)
    scored = quality.score(docs, model).collect()
    assert len(scored) == len(edge_texts) and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in scored)
    assert quality.keep_good(docs, model).columns == docs.columns
    net = toxicity.fit(docs, labels)
    scored = toxicity.score(docs, net).collect()
    assert len(scored) == len(edge_texts) and all(0 <= r.score <= 1 for r in scored)
    none = labels.limit(0)
    assert quality.score(docs.limit(0), quality.fit(docs, none)).count() == 0
    assert all(r.score < 0.01 for r in toxicity.score(docs, toxicity.fit(docs, none)).collect())


def test_toxic_words_are_learned(spark):
    rng = np.random.default_rng(6)
    words = [f"{a}{b}" for a in ("ba", "do", "ki", "lu", "me") for b in ("ra", "so", "ti", "nu", "pe")]
    texts = [" ".join(rng.choice(words, int(rng.integers(5, 150)))) for _ in range(400)]
    toxic = np.arange(400) % 4 == 0
    texts = [t + " vile " + t if bad else t for t, bad in zip(texts, toxic)]
    net = toxicity.train(texts[:300], toxic[:300].astype(int))
    scores = np.concatenate([net.scores(d, o) for _, d, o in W.column_slices(pa.array(texts[300:]))])
    assert auc(scores, toxic[300:]) > 0.99


def test_all_windows_of_a_sampled_text_compete(monkeypatch):
    """Long texts too: nothing is cut, and windows without a turn in one epoch have one in the next."""
    texts = ["a b c " * 50_000 + "the end", "", "d e", "é " * 3_000]
    asked, plain = [], toxicity.Network.logits
    monkeypatch.setattr(toxicity.Network, "logits", lambda net, seen, use: asked.append((len(seen.starts), use.tolist())) or plain(net, seen, use))
    monkeypatch.setattr(toxicity, "EPOCHS", 2)
    toxicity.train(texts, np.array([1, 0, 1, 0]))
    n = [len(x.split()) for x in texts]
    windows = sum(max(1, -(-(k - toxicity.WINDOW) // toxicity.STRIDE) + 1) for k in n)
    assert asked == [(sum(n), list(range(windows)))]


def test_scores_equal_one_window_at_a_time():
    """The batch score against the worst of its windows, each scored alone as a text."""
    rng = np.random.default_rng(9)
    words = [f"{a}{b}" for a in "bdkl" for b in ("ra", "so", "ti")]
    texts = [" ".join(rng.choice(words, int(n))) for n in (0, 1, 40, 64, 65, 96, 97, 300, 700)]
    net = toxicity.train(texts * 6, np.arange(len(texts) * 6) % 2)

    def alone(text):
        w = text.split()
        starts = range(0, max(1, len(w) - toxicity.WINDOW + toxicity.STRIDE), toxicity.STRIDE)
        # Windows hold whole words with a space at either end, as in the text.
        return max(score_of(" ".join(w[i : i + toxicity.WINDOW])) for i in starts)

    def score_of(text):
        data = np.frombuffer(text.encode(), np.uint8)
        return net.scores(data, np.array([0, len(data)]))[0]

    for text in texts:
        assert abs(score_of(text) - alone(text)) < 1e-4


def test_repeated_ids_teach_once(spark):
    docs = spark.createDataFrame([(i % 40, f"{'vile ' if i % 2 else ''}word{i % 40}") for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] * 2, "doc_id long, toxic int")
    once = toxicity.fit(docs.dropDuplicates(["doc_id"]), labels.dropDuplicates(["doc_id"]))
    again = toxicity.fit(docs, labels)
    assert all(np.array_equal(once.p[k], again.p[k]) for k in once.p)

"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A text is a sequence of words; a word enters as its own vector, if the training sample knows it, and
the mean of the vectors of its characters, each read with the bytes next to it. Two gated recurrent chains read each window of words, one from
either end; attention pools their states and a logistic unit scores the pool. All windows of a text
are scored, each overlapping the next by half, and the text's score is that of its worst window.

Training is plain numpy on a bounded sample of rows, whose texts are read whole. A text teaches through the
worst of all its windows: if the label is 1, that one should score high; if 0, even that one low.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockledger.llm import words as W

#: Most labelled rows of each class that a fit takes, those of the least hash. Their texts are taken
#: whole; 3,000 of average length are 10 MB.
SAMPLE_PER_CLASS = 1_500

WINDOW, STRIDE = 64, 32
THRESHOLD = 0.5
WORD_DIM, BYTE_DIM, HIDDEN, ATTENTION = 8, 8, 8, 8
READ_BYTES, BYTE_ROWS = 4, 1 << 13
LEAST_TEXTS = 5
EPOCHS, BATCH, STEP, DECAY = 14, 64, 0.01, 2e-4

_SEPARATORS = W.WHITE + b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_CHUNK = 1024

_separators = np.zeros(256, bool)
_separators[list(_SEPARATORS)] = True


def _reads(data: np.ndarray) -> np.ndarray:
    """A row of the byte vectors for each place, from ``READ_BYTES`` bytes on."""
    padded = np.concatenate([data, np.full(READ_BYTES + 1, 32, np.uint8)]).astype(np.uint32)
    code = sum(padded[k : len(data) + 1 + k] << np.uint32(8 * k) for k in range(READ_BYTES))
    return (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - (BYTE_ROWS.bit_length() - 1))


class Texts:
    """Words of a run of texts and the windows over them. A text without words has one empty word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        # A space between texts, so that no word reads on into the next.
        data = np.insert(_LOWER[data], offsets, 32)
        offsets = offsets + np.arange(len(offsets))
        data = np.where(_separators[data], np.uint8(32), data)
        starts, ends, owner = W.word_bounds(data, offsets, _SEPARATORS)
        self.data = data
        self.reads = _reads(data)
        self.hashes = np.append(W.word_hashes(self.data, starts, ends), np.uint64(0))
        # The reads of a word: from the space before it to the one that takes in the space after it.
        self.starts, self.ends = starts - 1, np.maximum(starts, ends + 2 - READ_BYTES)
        rows = len(offsets) - 1
        first = np.searchsorted(owner, np.arange(rows + 1))
        n = np.diff(first)
        windows = np.maximum(1, -(-(n - WINDOW) // STRIDE) + 1)
        self.row = np.repeat(np.arange(rows), windows)
        at = (np.arange(len(self.row)) - np.repeat(np.cumsum(windows) - windows, windows)) * STRIDE
        empty = n[self.row] == 0
        self.first = np.where(empty, len(starts), first[self.row] + at)
        self.length = np.where(empty, 1, np.minimum(WINDOW, n[self.row] - at))

    def byte_means(self, vectors: np.ndarray) -> np.ndarray:
        """Mean of the vectors of each word's reads; the empty word is zero."""
        out = np.zeros((len(self.starts) + 1, vectors.shape[1]), np.float32)
        if len(self.starts):
            edges = np.stack([self.starts, self.ends], axis=1).ravel()
            for k in range(vectors.shape[1]):
                out[:-1, k] = np.add.reduceat(vectors[self.reads, k], edges)[::2]
            out[:-1] /= (self.ends - self.starts)[:, None]
        return out

    def batch(self, picked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word places (time, window) of some windows, and which are within the text."""
        t = np.arange(WINDOW)[:, None]
        inside = t < self.length[picked]
        return self.first[picked] + np.minimum(t, self.length[picked] - 1), inside.astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Weights of the two chains are stacked: index 0 reads forward, 1 backward."""

    def __init__(self, vocabulary: np.ndarray, seed: int = 1) -> None:
        rng, h, e = np.random.default_rng(seed), HIDDEN, WORD_DIM + BYTE_DIM
        self.vocabulary = vocabulary  # sorted hashes of known words
        draw = lambda *shape, scale=0.3: (rng.normal(size=shape) * scale).astype(np.float32)
        self.p = {
            "words": draw(len(vocabulary) + 1, WORD_DIM), "bytes": draw(BYTE_ROWS, BYTE_DIM), "x": draw(2, e, 3 * h), "b": np.zeros((2, 3 * h), np.float32),
            "u": draw(2, h, 3 * h), "att": draw(2 * h, ATTENTION), "att_b": np.zeros(ATTENTION, np.float32), "att_v": draw(ATTENTION), "out": draw(2 * h), "out_b": np.zeros(1, np.float32),
        }
        self.p["words"][-1] = 0

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Rows of word vectors; unknown words have the last."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, len(self.vocabulary))

    def inputs(self, texts: Texts) -> np.ndarray:
        return np.concatenate([self.p["words"][self.ids(texts.hashes)], texts.byte_means(self.p["bytes"])], axis=1)

    def forward(self, gates: np.ndarray, places: np.ndarray, inside: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logits of windows. ``gates``: per word, what the input gives to the gates of both chains."""
        p, h, (steps, n) = self.p, HIDDEN, places.shape
        state = np.zeros((2, n, h), np.float32)
        states = np.empty((steps, 2, n, h), np.float32)
        kept = []
        both = np.stack([places, places[::-1]]), np.stack([inside, inside[::-1]])
        for t in range(steps):
            g = np.stack([gates[both[0][d, t], d] for d in (0, 1)])
            m = both[1][:, t, :, None]
            r_u = state @ p["u"]
            rz = 1 / (1 + np.exp(-(g[:, :, : 2 * h] + r_u[:, :, : 2 * h])))
            r, z = rz[:, :, :h], rz[:, :, h:]
            c = np.tanh(g[:, :, 2 * h :] + r * r_u[:, :, 2 * h :])
            new = state + m * z * (c - state)
            if keep is not None:
                kept.append((state, r, z, c, r_u[:, :, 2 * h :], m))
            state = new
            states[t] = state
        hidden = np.concatenate([states[:, 0], states[::-1, 1]], axis=2)
        a = np.tanh(hidden @ p["att"] + p["att_b"])
        e = a @ p["att_v"] + (inside - 1) * 1e4
        w = np.exp(e - e.max(axis=0))
        w /= w.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", w, hidden)
        if keep is not None:
            keep.update(kept=kept, hidden=hidden, a=a, w=w, pooled=pooled)
        return pooled @ p["out"] + p["out_b"][0]

    def gates(self, x: np.ndarray) -> np.ndarray:
        return np.stack([x @ self.p["x"][d] + self.p["b"][d] for d in (0, 1)], axis=1)

    def logits(self, texts: Texts, picked: np.ndarray) -> np.ndarray:
        """Logits of some windows."""
        x, found = self.inputs(texts), []
        for i in range(0, len(picked), _CHUNK):
            places, inside = texts.batch(picked[i : i + _CHUNK])
            low, high = places.min(), places.max() + 1  # windows in a row lie in words in a row
            found.append(self.forward(self.gates(x[low:high]), places - low, inside))
        return np.concatenate(found)

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Score of each text, that of its worst window."""
        texts = Texts(data, offsets)
        worst = np.full(len(offsets) - 1, -np.inf, np.float32)
        np.maximum.at(worst, texts.row, self.logits(texts, np.arange(len(texts.row))))
        return _sigmoid(worst.astype(np.float64))

    def gradients(self, x: np.ndarray, places: np.ndarray, inside: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Of the mean log loss; and with respect to the word inputs ``x``."""
        p, h, keep = self.p, HIDDEN, {}
        gates = self.gates(x)
        logit = self.forward(gates, places, inside, keep)
        d_logit = ((_sigmoid(logit) - y) * weight / len(y)).astype(np.float32)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["out"], g["out_b"] = keep["pooled"].T @ d_logit, np.array([d_logit.sum()], np.float32)
        d_pooled = d_logit[:, None] * p["out"]
        d_w = np.einsum("nh,tnh->tn", d_pooled, keep["hidden"])
        d_hidden = keep["w"][:, :, None] * d_pooled
        d_e = keep["w"] * (d_w - (keep["w"] * d_w).sum(axis=0))
        g["att_v"] = np.einsum("tn,tna->a", d_e, keep["a"])
        d_a = d_e[:, :, None] * p["att_v"] * (1 - keep["a"] ** 2)
        g["att"], g["att_b"] = np.einsum("tnh,tna->ha", keep["hidden"], d_a), d_a.sum(axis=(0, 1))
        d_hidden = d_hidden + d_a @ p["att"].T
        d_states = np.stack([d_hidden[:, :, :h], d_hidden[::-1, :, h:]], axis=1)
        d_gates = np.zeros_like(gates)
        d_state = np.zeros_like(d_states[0])
        order = np.stack([places, places[::-1]])
        for t in range(len(places) - 1, -1, -1):
            state, r, z, c, u_c, m = keep["kept"][t]
            d = d_state + d_states[t]
            d_z = d * m * (c - state) * z * (1 - z)
            d_c = d * m * z * (1 - c**2)
            d_r = d_c * u_c * r * (1 - r)
            into = np.concatenate([d_r, d_z, d_c], axis=2)
            recurrent = np.concatenate([d_r, d_z, d_c * r], axis=2)
            g["u"] += np.swapaxes(state, 1, 2) @ recurrent
            d_state = d * (1 - m * z) + recurrent @ np.swapaxes(p["u"], 1, 2)
            for k in (0, 1):
                np.add.at(d_gates, (order[k, t], k), into[k])
        g["x"] = np.stack([x.T @ d_gates[:, k] for k in (0, 1)])
        g["b"] = d_gates.sum(axis=0)
        return g, sum(d_gates[:, k] @ p["x"][k].T for k in (0, 1))


def train(texts: list[str], labels: np.ndarray, seed: int = 1) -> Network:
    """Fits a network. Without texts, or with one class, it scores all texts 0."""
    encoded = [x.encode() for x in texts]
    seen = Texts(np.frombuffer(b"".join(encoded), np.uint8), np.cumsum([0, *map(len, encoded)]))
    n_words = len(seen.starts)
    owner = np.zeros(n_words, np.int64)
    for row, first, length in zip(seen.row, seen.first, seen.length):
        owner[first : first + length] = row
    pairs = np.unique(np.stack([seen.hashes[:-1], owner.astype(np.uint64)]), axis=1)
    known, counts = np.unique(pairs[0], return_counts=True)
    net = Network(known[counts >= LEAST_TEXTS], seed)
    if len(set(labels.tolist())) < 2:
        net.p["out"][:], net.p["out_b"][:] = 0, -30
        return net
    rng, n = np.random.default_rng(seed), len(texts)
    weight = np.ones(n, np.float32)
    use = np.arange(len(seen.row))
    ids = net.ids(seen.hashes)
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0
    for epoch in range(EPOCHS):
        if epoch == 0:
            value = rng.random(len(use))
        else:
            value = net.logits(seen, use)
            if epoch < 4:  # early on, other windows too
                value = value + rng.gumbel(size=len(use))
        by_row = use[np.lexsort((value, seen.row[use]))]
        worst = by_row[np.flatnonzero(np.r_[seen.row[by_row][1:] != seen.row[by_row][:-1], True])]
        order = rng.permutation(len(worst))
        for i in range(0, n, BATCH):
            picked = worst[order[i : i + BATCH]]
            places, inside = seen.batch(picked)
            local, inverse = np.unique(places, return_inverse=True)
            inverse = inverse.reshape(places.shape)
            # Known words are at times unknown, so that their bytes learn too.
            row_ids = np.where(rng.random(len(local)) < 0.1, len(net.vocabulary), ids[local])
            starts, ends = np.append(seen.starts, 0)[local], np.append(seen.ends, 0)[local]
            sizes = np.maximum(ends - starts, 1)
            at = np.repeat(starts, ends - starts) + np.arange((ends - starts).sum()) - np.repeat(np.cumsum(ends - starts) - (ends - starts), ends - starts)
            owners, letters = np.repeat(np.arange(len(local)), ends - starts), seen.reads[at]
            means = np.zeros((len(local), BYTE_DIM), np.float32)
            np.add.at(means, owners, net.p["bytes"][letters])
            means /= sizes[:, None]
            x = np.concatenate([net.p["words"][row_ids], means], axis=1)
            row = seen.row[picked]
            g, d_x = net.gradients(x, inverse, inside, labels[row].astype(np.float32), weight[row])
            np.add.at(g["words"], row_ids, d_x[:, :WORD_DIM])
            np.add.at(g["bytes"], letters, (d_x[:, WORD_DIM:] / sizes[:, None])[owners])
            g["words"][-1] = 0
            step += 1
            norm = np.sqrt(sum(float((v**2).sum()) for v in g.values()))
            rate = STEP * min(1.0, 2 * (1 - epoch / EPOCHS) + 0.05)
            for k, v in net.p.items():
                d = g[k] / max(1.0, norm)
                m, s = moment[k]
                m += 0.1 * (d - m)
                s += 0.001 * (d * d - s)
                v -= rate * (m / (1 - 0.9**step) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8) + DECAY * v)
    return net


def held_out(id_col: Column) -> Column:
    return F.pmod(F.crc32(id_col.cast("string")), F.lit(5)) == 0


def fit(docs: DataFrame, labels: DataFrame, target: str = "toxic", id_col: str = "doc_id", text_col: str = "text", per_class: int = SAMPLE_PER_CLASS) -> Network:
    """Trains on at most ``per_class`` labelled rows of either class that are not held out.

    Of an id that repeats with unlike texts the least text counts, and an id with both labels teaches both.
    """
    ids = labels.filter(F.col(target).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col))).select(F.col(id_col).alias("id"), F.col(target).cast("int").alias("y"))
    sample = ids.filter("y = 1").orderBy(F.xxhash64("id"), "id").limit(per_class).unionByName(ids.filter("y = 0").orderBy(F.xxhash64("id"), "id").limit(per_class)).distinct()
    # The sample's bound is the broadcast's: 16 bytes for each of its rows.
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    n0, n1 = ids.agg(F.count_if(F.col("y") == 0), F.count_if(F.col("y") == 1)).first()
    chosen = texts.join(F.broadcast(sample), "id").groupBy("id", "y").agg(F.min("text").alias("text"))
    rows = sorted((x["id"], x["y"], x["text"]) for x in chosen.collect())
    y = np.array([x[1] for x in rows], np.int64)
    net = train([x[2] for x in rows], y)
    if n0 and n1:  # from the classes' shares in the sample to those among all labels
        net.p["out_b"] += np.float32(np.log(n1 / n0) - np.log(max(y.sum(), 1) / max((1 - y).sum(), 1)))
    return net


def score(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) per row. Null and empty texts score like one unknown word; ids and rows may repeat."""
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in W.column_slices(batch.column(1), 1 << 20):
                values = sent.value.scores(data, offsets)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(values)), pa.array(values)], ["id", "score"])

    chosen = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return chosen.mapInArrow(run, "id long, score double").withColumnRenamed("id", id_col)

"""Quality classifier: a sparse ensemble of rules over statistics of a text.

Small gradient-boosted trees are grown on the statistics of a bounded sample of labelled rows. Every
path from a root is a rule, a conjunction of comparisons. A lasso logistic regression weighs the
rules, most of them with zero, and the rest become one Spark column expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most labelled rows a fit takes, those of the least hash. 20,000 rows of statistics are 3 MB.
SAMPLE_ROWS = 20_000
THRESHOLD = 0.3
TREES, DEPTH, BINS, RATE, LEAST_LEAF, LASSO = 60, 3, 48, 0.3, 20, 0.002

STATISTICS = ["words", "chars_per_word", "distinct_words", "distinct_lines", "words_per_line", "upper", "digits", "symbols", "marks", "bars", "exclaims", "stops"]


def with_statistics(docs: DataFrame, text_col: str = "text", name: str = "stats") -> DataFrame:
    """``docs`` with a struct of statistics of each whole text; all are 0 for null and empty texts."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda x: x != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x != "")
    count = lambda pattern: F.regexp_count(text, F.lit(pattern))
    raw = F.struct(
        F.length(text).cast("double").alias("chars"), F.size(words).cast("double").alias("words"), F.size(F.array_distinct(words)).alias("distinct_words"),
        F.size(lines).cast("double").alias("lines"), F.size(F.array_distinct(lines)).alias("distinct_lines"),
        count("\\p{Lu}").alias("upper"), count("[0-9]").alias("digits"), count("[#$%&*+=<>{}\\[\\]\\\\~^_@/]").alias("symbols"),
        count("[,;:.]").alias("marks"), count("[|]").alias("bars"), count("!").alias("exclaims"), count("[.] ").alias("stops"),
    )

    def shares(x: Column) -> Column:
        chars, words, lines = (F.greatest(x[k], F.lit(1.0)) for k in ("chars", "words", "lines"))
        return F.struct(
            F.log1p(x["words"]).alias("words"), (x["chars"] / words).alias("chars_per_word"), (x["distinct_words"] / words).alias("distinct_words"),
            (x["distinct_lines"] / lines).alias("distinct_lines"), (x["words"] / lines).alias("words_per_line"),
            *[(x[k] / chars).alias(k) for k in ("upper", "digits", "symbols")],
            *[(x[k] / words).alias(k) for k in ("marks", "bars", "exclaims", "stops")],
        )

    # Through an array of one, so that each count is computed once however often it is used.
    return docs.withColumn(name, F.transform(F.array(raw), shares)[0])


Rule = tuple[tuple[int, bool, float], ...]


def _splits(x: np.ndarray) -> list[np.ndarray]:
    return [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for k in range(x.shape[1])]


def _grow(x: np.ndarray, gradient: np.ndarray, weight: np.ndarray, splits: list[np.ndarray], columns: np.ndarray) -> tuple[list[Rule], np.ndarray]:
    """A tree of Newton steps: the rules of all its nodes but the root, and its value for each row."""
    rules: list[Rule] = []
    value = np.zeros(len(x))

    def node(rows: np.ndarray, rule: Rule) -> None:
        if rule:
            rules.append(rule)
        g, h = gradient[rows].sum(), weight[rows].sum()
        best = (1e-3, -1, 0.0)
        if len(rule) < DEPTH and len(rows) >= 2 * LEAST_LEAF:
            for k in columns:
                cuts = splits[k]
                if not len(cuts):
                    continue
                bins = np.searchsorted(cuts, x[rows, k], "left")
                n, gs, hs = (np.cumsum(np.bincount(bins, w, len(cuts) + 1))[:-1] for w in (np.ones(len(rows)), gradient[rows], weight[rows]))
                gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
                gain[(n < LEAST_LEAF) | (len(rows) - n < LEAST_LEAF)] = 0
                at = int(gain.argmax())
                if gain[at] > best[0]:
                    best = (gain[at], k, cuts[at])
        gain, k, cut = best
        if k < 0:
            value[rows] = g / (h + 1)
            return
        low = x[rows, k] <= cut
        node(rows[low], (*rule, (int(k), True, float(cut))))
        node(rows[~low], (*rule, (int(k), False, float(cut))))

    node(np.arange(len(x)), ())
    return rules, value


def _holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    found = np.ones(len(x), bool)
    for k, low, cut in rule:
        found &= (x[:, k] <= cut) == low
    return found


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass(frozen=True)
class RuleModel:
    bias: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for rule, w in self.rules:
            z += w * _holds(rule, x)
        return _sigmoid(z)

    def column(self, stats: Column) -> Column:
        """The score as a column expression."""
        z = F.lit(self.bias)
        for rule, w in self.rules:
            holds = F.lit(True)
            for k, low, cut in rule:
                value = stats[STATISTICS[k]]
                holds = holds & ((value <= cut) if low else (value > cut))
            z = z + F.when(holds, F.lit(w)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))


def fit_rules(x: np.ndarray, y: np.ndarray, seed: int = 2) -> RuleModel:
    """Rules from boosted trees on random halves of rows and columns, weighed by a lasso logistic fit.

    Without rows the model scores 0.5; with one class only, near that class.
    """
    if not len(x):
        return RuleModel(0.0, ())
    rate = (y.sum() + 0.5) / (len(y) + 1)
    bias = float(np.log(rate / (1 - rate)))
    rng, splits, z = np.random.default_rng(seed), _splits(x), np.full(len(x), bias)
    found: dict[Rule, np.ndarray] = {}
    for _ in range(TREES):
        p = _sigmoid(z)
        rows = rng.random(len(x)) < 0.5
        columns = rng.permutation(x.shape[1])[: max(2, x.shape[1] * 2 // 3)]
        if rows.sum() < 2 * LEAST_LEAF:
            break
        rules, _ = _grow(x[rows], (y - p)[rows], (p * (1 - p))[rows], splits, columns)
        for rule in rules:
            found.setdefault(rule, _holds(rule, x))
        leaves = [r for r in rules if not any(o[: len(r)] == r and o != r for o in rules)]
        for rule in leaves:
            on = _holds(rule, x)
            g, h = (y - p)[on & rows].sum(), (p * (1 - p))[on & rows].sum()
            z += RATE * g / (h + 1) * on
    # Rules that hold for the same rows are one.
    kinds = {held.tobytes(): rule for rule, held in reversed(found.items()) if 0 < held.sum() < len(x)}
    rules = list(kinds.values())
    if not rules:
        return RuleModel(bias, ())
    table = np.stack([found[r] for r in rules], axis=1).astype(np.float32)
    scale = np.maximum(table.std(axis=0), 0.02)
    table = (table - table.mean(axis=0)) / scale
    # Accelerated proximal gradient steps; the intercept is not shrunk.
    lipschitz = 0.25 * np.linalg.norm(table.T @ table / len(y), 2) + 0.25
    w = v = np.zeros(len(rules) + 1)
    t = 1.0
    for _ in range(400):
        r = (_sigmoid(table @ v[1:].astype(np.float32) + v[0]) - y) / len(y)
        u = v - np.concatenate([[r.sum()], table.T @ r.astype(np.float32)]) / lipschitz
        u[1:] = np.sign(u[1:]) * np.maximum(np.abs(u[1:]) - LASSO / lipschitz, 0)
        t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        w, v = u, u + (last - 1) / t * (u - w)
    weights = w[1:] / scale
    means = np.stack([found[r] for r in rules], axis=1).mean(axis=0)
    kept = [(r, float(x)) for r, x in zip(rules, weights) if x]
    return RuleModel(float(w[0] - (weights * means).sum()), tuple(kept))


def held_out(id_col: Column) -> Column:
    return F.pmod(F.crc32(id_col.cast("string")), F.lit(5)) == 0


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", id_col: str = "doc_id", text_col: str = "text", most: int = SAMPLE_ROWS) -> RuleModel:
    """Fits on at most ``most`` labelled rows that are not held out. Null labels and ids are ignored."""
    ids = labels.filter(F.col(target).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col))).select(F.col(id_col).alias("id"), F.col(target).cast("double").alias("y"))
    sample = ids.orderBy(F.xxhash64("id"), "id", "y").limit(most)
    # The sample's bound is the broadcast's: 16 bytes for each of ``most`` rows.
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "id")
    rows = with_statistics(texts, "text").select("id", "y", *[F.col(f"stats.{k}").cast("double").alias(k) for k in STATISTICS]).limit(2 * most).toPandas()
    rows = rows.sort_values(list(rows.columns))
    return fit_rules(rows[STATISTICS].to_numpy(float), rows["y"].to_numpy(float))


def score(docs: DataFrame, model: RuleModel, text_col: str = "text") -> DataFrame:
    """``docs`` with columns score and predicted in place of any of these names."""
    scored = with_statistics(docs, text_col, "_stats")
    scored = scored.withColumn("score", F.transform(F.array("_stats"), model.column)[0]).drop("_stats")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, model: RuleModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with the same columns, that the model doesn't reject."""
    stats = with_statistics(docs, text_col, "_llm_stats")
    return stats.filter(F.transform(F.array("_llm_stats"), model.column)[0] >= THRESHOLD).drop("_llm_stats")

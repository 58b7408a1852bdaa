"""Quality: a sparse ensemble of rules over document statistics, run as one Spark expression.

Statistics are built-in column functions. Boosted trees of depth ``DEPTH`` are grown on a bounded
sample of labelled rows; every path from a root is a rule, a conjunction of comparisons; logistic
weights with a lasso penalty are fitted to the rules, and those left become CASE expressions.

Nulls, ties, extremes: a null, empty or blank text has quality 0 and is not kept; ratios whose
divisor is 0 are 0; whole texts are counted; equal texts get equal results; a null doc_id is
passed on. Labels that are null or of no document are left out; of several labels for a document
the least counts. Without labels of both kinds every solid text has quality 1. An empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

#: Bound on the labelled rows fitted on (those of least hashed doc_id).
TRAIN_ROWS = 20_000
TREES, DEPTH, SHRINK, PENALTY = 20, 3, 0.3, 0.002

Rule = tuple[tuple[str, bool, float], ...]


def statistics(text: Column) -> dict[str, Column]:
    """Name and column of each statistic of a text that is not null."""
    count = lambda p: F.regexp_count(text, F.lit(p)).cast("double")
    n, words, lines = F.length(text).cast("double"), count(r"\S+"), count("\n") + 1
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    split = F.split(text, "\n")
    return {
        "words": words,
        "word_length": ratio(n, words),
        "upper": ratio(count(r"\p{Lu}"), n),
        "digits": ratio(count("[0-9]"), n),
        "symbols": ratio(count(r"[#$%&*|<>{}\[\]^~=+@_\\/]"), n),
        "bangs": ratio(count("[!?]"), words),
        "stops": ratio(count("[.,;:]"), words),
        "lines": lines,
        "line_words": ratio(words, lines),
        "distinct_lines": ratio(F.size(F.array_distinct(split)).cast("double"), lines),
    }


STATS = ["words", "word_length", "upper", "digits", "symbols", "bangs", "stops", "lines", "line_words", "distinct_lines"]


def _tree(x: np.ndarray, g: np.ndarray, h: np.ndarray, rows: np.ndarray, path: Rule, rules: list[Rule], out: np.ndarray) -> None:
    """Grow on gradients; adds each node's path to ``rules`` and the leaves' steps to ``out``."""
    if path:
        rules.append(path)
    best = (1e-6, None)
    if len(path) < DEPTH and len(rows) >= 10:
        base = g[rows].sum() ** 2 / (h[rows].sum() + 1)
        for k, name in enumerate(STATS):
            order = rows[np.argsort(x[rows, k], kind="stable")]
            v = x[order, k]
            cg, ch = np.cumsum(g[order])[:-1], np.cumsum(h[order])[:-1]
            gain = cg**2 / (ch + 1) + (g[rows].sum() - cg) ** 2 / (h[rows].sum() - ch + 1) - base
            gain[v[1:] == v[:-1]] = -1
            i = int(gain.argmax())
            if gain[i] > best[0]:
                best = (gain[i], (k, name, float((v[i] + v[i + 1]) / 2)))
    if best[1] is None:
        out[rows] = -g[rows].sum() / (h[rows].sum() + 1)
        return
    k, name, at = best[1]
    low = x[rows, k] <= at
    _tree(x, g, h, rows[low], (*path, (name, True, at)), rules, out)
    _tree(x, g, h, rows[~low], (*path, (name, False, at)), rules, out)


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for name, low, at in rule:
        v = x[:, STATS.index(name)]
        out &= (v <= at) if low else (v > at)
    return out


class Model:
    def __init__(self, rules: list[Rule], weights: list[float], bias: float):
        self.rules, self.weights, self.bias = rules, weights, bias

    def predict(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for r, w in zip(self.rules, self.weights):
            z += w * holds(r, x)
        return 1 / (1 + np.exp(-z))

    def column(self, of: dict[str, Column]) -> Column:
        z = F.lit(self.bias)
        for r, w in zip(self.rules, self.weights):
            cond = F.lit(True)
            for name, low, at in r:
                cond = cond & ((of[name] <= F.lit(at)) if low else (of[name] > F.lit(at)))
            z = z + F.when(cond, F.lit(w)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def train(x: np.ndarray, y: np.ndarray) -> Model:
    y = y.astype(float)
    z = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    rules: list[Rule] = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-z))
        step = np.zeros(len(y))
        _tree(x, p - y, p * (1 - p), np.arange(len(y)), (), rules, step)
        z += SHRINK * step
    rules = list(dict.fromkeys(rules))
    m = np.stack([holds(r, x) for r in rules], 1).astype(np.float64) if rules else np.zeros((len(y), 0))
    _, first = np.unique(m, axis=1, return_index=True)
    rules, m = [rules[i] for i in sorted(first)], m[:, sorted(first)]
    sd = np.maximum(m.std(0), 1e-6)
    mean = m.mean(0)
    s = (m - mean) / sd
    rate = 4 / max(np.linalg.norm(s.T @ s / len(y), 2), 1e-9) if len(rules) else 1.0
    w, pw, b = np.zeros(len(rules)), np.zeros(len(rules)), float(np.log(y.mean() / (1 - y.mean())))
    for t in range(500):
        u = w + t / (t + 3) * (w - pw)
        g = 1 / (1 + np.exp(-(s @ u + b))) - y
        pw = w
        w = u - rate * (s.T @ g) / len(y)
        w = np.sign(w) * np.maximum(np.abs(w) - rate * PENALTY, 0)
        b -= 4 * g.mean() / 4
    keep = np.flatnonzero(np.abs(w) > 1e-9)
    weights = w[keep] / sd[keep]
    return Model([rules[i] for i in keep], [float(v) for v in weights], float(b - (weights * mean[keep]).sum()))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    known = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("__i")).agg(F.min(F.col("quality").cast("int")).alias("__q"))
    picked = known.join(docs.select(F.col("doc_id").alias("__i")).distinct(), "__i", "left_semi").orderBy(F.xxhash64("__i"), "__i").limit(rows)
    some = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("__i"))
    got = some.select("doc_id", F.col("__q"), *(c.alias(n) for n, c in statistics(F.col("text")).items())).toPandas().sort_values(["doc_id", *STATS], kind="stable")
    y = got["__q"].to_numpy(int) if len(got) else np.zeros(0, int)
    if not 0 < y.sum() < len(y):
        return Model([], [], 30.0)
    return train(got[STATS].to_numpy(float), y)


def quality(docs: DataFrame, labels: DataFrame, model: Model | None = None, threshold: float = 0.5) -> DataFrame:
    """One row per input row: doc_id, quality (0 to 1), keep."""
    model = model or fit(docs, labels)
    stats = statistics(F.col("__text"))
    of = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("__text"))
    of = of.select("doc_id", F.col("__text").rlike(r"\S").alias("__solid"), *(c.alias(n) for n, c in stats.items()))
    score = F.when(F.col("__solid"), model.column({n: F.col(n) for n in stats})).otherwise(F.lit(0.0))
    return of.select("doc_id", score.alias("quality")).select("doc_id", "quality", (F.col("quality") >= threshold).alias("keep"))

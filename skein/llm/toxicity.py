"""Toxicity: a linear classifier over character 3- to 5-grams scaled by naive Bayes log-count ratios.

A feature is the presence of an n-gram (case folded, separators as spaces) anywhere in the text,
times r = log of the ratio of its smoothed shares of toxic and clean training documents. Features
are the ``FEATURES`` n-grams most associated with the label (chi-square); weights are L2-penalised
logistic regression. The threshold maximises F1 on a fifth of the sample held out by hashed
doc_id, with classes weighted to their shares among all labels, for a model fitted without it; the
model in use is then fitted on the whole sample.

N-grams are counted on the executors: a plain aggregate gives each one's numbers of toxic and
clean documents, and the driver gets the chosen features and, for the sample's documents, the
numbers of the features that they hold, but no text.

Nulls, ties, extremes: a null or empty text has no n-grams, so its score is the intercept's; all
n-grams of a long text count; equal texts get equal scores; a null doc_id is passed on. Labels
that are null or of no document are left out; a document with several labels is toxic if one says
so. Without labels of both kinds every score is 0; if a part of the sample, the held or the other, lacks one kind, the threshold is set on the whole of it. An empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .language_id import sample
from .spans import Packed, Table, U, mix, slices, small
from .store import Scratch, text_batches

GRAMS = (3, 4, 5)
#: Bound on the labelled rows fitted on, in equal shares of both labels.
TRAIN_ROWS = 6000
FEATURES = 4096
#: An n-gram of fewer training documents is no feature.
MIN_DF = 3
#: N-grams that a task adds up before it passes them on.
TALLY = 1 << 20
_BITS = 22


def _grams(p: Packed):
    cp = p.points()
    doc = np.searchsorted(p.at, cp[:-1], "right") - 1
    doc = np.where(cp[:-1] == p.at[np.minimum(doc + 1, p.n)] - 1, -1, doc)  # the newline between texts is of none
    for n in GRAMS:
        s, e = cp[: -n or None], cp[n:]
        d = doc[: len(s)]
        same = (d >= 0) & (doc[n - 1 : n - 1 + len(s)] == d)
        yield p.hash(s[same], e[same]) ^ U(n), d[same]


def _present(texts: list, keep=None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, n-gram hash) pairs; with ``keep``, only hashes that it lets through."""
    docs, hashes = [], []
    for x, y in slices(texts):
        for h, d in _grams(Packed(texts[x:y])):
            if keep is not None:
                ok = keep(h)
                h, d = h[ok], d[ok]
            order = np.lexsort((h, d))
            h, d = h[order], d[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
            docs.append(d[new] + x)
            hashes.append(h[new])
    return np.concatenate(docs) if docs else np.zeros(0, np.int64), np.concatenate(hashes) if hashes else np.zeros(0, U)


class Model:
    def __init__(self, keys: np.ndarray, weights: np.ndarray, bias: float, threshold: float):
        self.table, self.weights, self.bias, self.threshold = Table(keys), weights, bias, threshold
        self.some = np.zeros(1 << _BITS, bool)
        self.some[(keys & U((1 << _BITS) - 1)).astype(np.int64)] = True

    def present(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """(text, feature) pairs."""
        d, h = _present(texts, lambda q: self.some[(q & U((1 << _BITS) - 1)).astype(np.int64)])
        at = self.table.find(h)
        return d[at >= 0], at[at >= 0]

    def scores(self, texts: list) -> np.ndarray:
        if not len(self.weights):
            return np.zeros(len(texts))
        return self.of(*self.present(texts), len(texts))

    def of(self, d: np.ndarray, f: np.ndarray, n: int) -> np.ndarray:
        return 1 / (1 + np.exp(-(np.bincount(d, weights=self.weights[f], minlength=n) + self.bias)))


def _fit_lr(d, f, n, k, y, scale, steps=400, l2=1.0):
    """Nesterov descent on the penalised logistic loss; (row, column) pairs have the value scale[column]."""
    by_f = np.argsort(f, kind="stable")
    rows, of = d[by_f].astype(np.int32), np.flatnonzero(np.diff(f[by_f], prepend=-1))
    cols = f[by_f][of]
    d, f = d[(by_d := np.argsort(d, kind="stable"))], f[by_d].astype(np.int32)
    own = np.flatnonzero(np.diff(d, prepend=-1))
    own_d = d[own]
    w, b, pw, pb = np.zeros(k), 0.0, np.zeros(k), 0.0
    norm = np.zeros(n)
    if len(own):
        norm[own_d] = np.add.reduceat((scale * scale)[f], own)
    rate = 1 / (0.25 * (norm.max(initial=1) + 1) + l2 / n)
    for t in range(steps):
        m = t / (t + 3)
        uw, ub = w + m * (w - pw), b + m * (b - pb)
        z = np.full(n, ub)
        gw = l2 * uw / n
        if len(own):
            z[own_d] += np.add.reduceat((scale * uw)[f], own)
        g = 1 / (1 + np.exp(-z)) - y
        if len(own):
            gw[cols] += scale[cols] * np.add.reduceat(g[rows], of) / n
        pw, pb = w, b
        w, b = uw - rate * gw, ub - rate * g.mean()
    return w, b


COUNTS = ("pos", "neg", "held_pos", "held_neg")


def _counted(batches):
    """Rows (text, y, held): each n-gram's numbers of toxic and clean documents, in all and among those held out."""

    def passed():
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), *(pa.array(c) for c in counts)], ["h", *COUNTS])

    keys, counts = np.zeros(0, U), [np.zeros(0, np.int64)] * 4
    for b in small(batches):
        texts, y, held = b.column(0).to_pylist(), b.column(1).to_numpy().astype(np.int64), np.asarray(b.column(2).to_pylist(), np.int64)
        for x, z in slices(texts):
            d, h = _present(texts[x:z])
            every, at = np.unique(np.concatenate([keys, h]), return_inverse=True)
            t, u = y[x:z][d], held[x:z][d]
            counts = [np.bincount(at, weights=np.concatenate([old, new]), minlength=len(every)).astype(np.int64) for old, new in zip(counts, (t, 1 - t, t * u, (1 - t) * u))]
            keys = every
            if len(keys) > TALLY:
                yield passed()
                keys, counts = np.zeros(0, U), [np.zeros(0, np.int64)] * 4
    yield passed()


def _features(grams: DataFrame, pos, neg, n1: int, n0: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the ``FEATURES`` n-grams of greatest chi-square, and their log-count ratios."""
    df = pos + neg
    det = pos * (n0 - neg) - neg * (n1 - pos)
    chi = det * det / F.greatest(df * (n1 + n0 - df), F.lit(1.0))
    top = grams.where(df >= MIN_DF).select("h", pos.alias("p"), neg.alias("n"), chi.alias("chi")).where("chi > 0").orderBy(F.desc("chi"), "h").limit(FEATURES).toArrow()
    p, n = top.column("p").to_numpy(), top.column("n").to_numpy()
    return top.column("h").to_numpy().astype(np.int64).view(U), np.log(((p + 1) / (n1 + 2)) / ((n + 1) / (n0 + 2)))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """A model without the held-out fifth sets the threshold on it; the model returned is fitted on the whole sample."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").alias("__i")).agg(F.max(F.col("toxic").cast("int")).alias("__toxic"))
    share = known.agg(F.avg("__toxic").alias("m")).first()["m"]
    both = docs.select("doc_id", "text").join(known, F.col("doc_id") == F.col("__i")).select("doc_id", "text", "__toxic")
    picked, kinds = sample(both, "__toxic", rows)
    if len(kinds) < 2:
        return Model(np.zeros(0, U), np.zeros(0), 0.0, 0.5)
    scratch = Scratch(docs.sparkSession)
    # the sample is spread over tasks again: its rows may lie anywhere in the table
    some = scratch.keep(picked.select("doc_id", "text", F.col("__toxic").alias("y"), (F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0).alias("held")).repartition("doc_id"), "sample").select("text", "y", "held")
    parts = {(r["held"], r["y"]): r["n"] for r in some.groupBy("held", "y").agg(F.count("*").alias("n")).collect()}
    n = {k: (parts.get((True, k), 0), parts.get((False, k), 0)) for k in (1, 0)}
    grams = some.mapInArrow(_counted, "h long, " + ", ".join(f"{c} long" for c in COUNTS)).groupBy("h").agg(*(F.sum(c).cast("double").alias(c) for c in COUNTS))
    grams = scratch.keep(grams.where(F.col("pos") + F.col("neg") >= MIN_DF), "grams")
    split = len(parts) == 4
    ways = {"whole": _features(grams, F.col("pos"), F.col("neg"), sum(n[1]), sum(n[0]))}
    if split:
        ways["part"] = _features(grams, F.col("pos") - F.col("held_pos"), F.col("neg") - F.col("held_neg"), n[1][1], n[0][1])
    finder = Model(np.unique(np.concatenate([k for k, _ in ways.values()])), np.ones(1), 0.0, 0.5)

    def features(batches):
        for b in small(batches):
            d, f = finder.present(b.column(0).to_pylist())
            order = np.lexsort((f, d))
            f, cut = f[order].astype(np.int32), np.searchsorted(d[order], np.arange(b.num_rows + 1))
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array([f[x:y].tobytes() for x, y in zip(cut, cut[1:])], pa.binary())], ["y", "held", "f"])

    got = some.mapInArrow(features, "y int, held boolean, f binary").toArrow().sort_by([("y", "ascending"), ("f", "ascending")]).combine_chunks()
    scratch.drop()
    lists = [np.frombuffer(x, np.int32) for x in got.column("f").to_pylist()]
    every = np.repeat(np.arange(len(lists), dtype=np.int32), [len(x) for x in lists]), np.concatenate(lists)
    y, held = (np.asarray(got.column(c).to_pylist(), bool) for c in ("y", "held"))

    def fitted(keys: np.ndarray, ratio: np.ndarray, use: np.ndarray) -> tuple[Model, np.ndarray]:
        """The model on the rows to use, and its scores of all."""
        model = Model(keys, np.zeros(len(keys)), 0.0, 0.5)
        to = model.table.find(finder.table.keys)[every[1]]
        d, f = every[0][to >= 0], to[to >= 0]
        w, b = _fit_lr((np.cumsum(use) - 1)[d[use[d]]], f[use[d]], int(use.sum()), len(keys), y[use].astype(float), ratio)
        model.weights, model.bias = w * ratio, b
        return model, model.of(d, f, len(y))

    model, scores = fitted(*ways["whole"], np.ones(len(y), bool))
    if split:
        _, scores = fitted(*ways["part"], ~held)
    judged = held if split else np.ones(len(y), bool)
    model.threshold = threshold(scores[judged], y[judged], float(share))
    return model


def threshold(p: np.ndarray, t: np.ndarray, share: float) -> float:
    """The score that maximises F1 where ``share`` of the documents are toxic; t tells which of those at hand are."""
    weight = np.where(t, share / max(t.mean(), 1e-9), (1 - share) / max(1 - t.mean(), 1e-9))
    order = np.argsort(-p, kind="stable")
    tp, fp = np.cumsum((weight * t)[order]), np.cumsum((weight * ~t)[order])
    f1 = 2 * tp / (tp + fp + (weight * t).sum())
    f1[:-1][p[order][1:] == p[order][:-1]] = -1
    k = int(f1.argmax())
    after = p[order][k + 1] if k + 1 < len(p) else 0.0
    return float((p[order][k] + after) / 2)


def toxicity(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per input row: doc_id, score (0 to 1), toxic (score at or over the model's threshold)."""
    model = model or fit(docs, labels)

    def run(batches):
        for b in small(batches):
            p = model.scores(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p), pa.array((p >= model.threshold) & bool(len(model.weights)))], ["doc_id", "score", "toxic"])

    return text_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, toxic boolean")

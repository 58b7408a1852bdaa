"""Language identification, word first: known words score by their log frequency in each language;
a word that no language's sample has falls back to its character 5-grams, then 4-, 3-, 2- and 1-grams.

A document's score in a language is the sum over its words, divided by their number; the margin
is the best language's lead over the second. A document without words, without any known piece,
or with a margin under ``min_margin`` gets ``und`` and is rejected.

Nulls, ties, extremes: a null or empty text is ``und`` with margin 0; ties between languages are a
margin of 0, hence ``und``; a null doc_id is passed on; every word of a long text counts; each of
several equal rows gets the same answer; an empty table gives an empty result. Training leaves out
rows with null text or null language; with no usable row, or one language only, everything is
``und``. Every word and n-gram of the sample is known, however rare. Other columns, whatever their names, are never read and stages pass them on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .spans import Packed, Table, U, ragged, slices, small
from .store import text_batches

GRAMS = (5, 4, 3, 2, 1)
MIN_MARGIN = 0.05
#: Bound on the labelled rows that a model is fitted on (those of least hashed doc_id in each language).
TRAIN_ROWS = 4000
UNKNOWN = "und"


def _salt(n: int) -> np.uint64:
    return U((n * 0xA24BAED4963EE407) & (2**64 - 1))


def _ngrams(p: Packed, s: np.ndarray, e: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words' n-grams, a space on each side included, and the word that each is of."""
    cp = p.points()
    a, b = np.searchsorted(cp, s) - 1, np.searchsorted(cp, e) + 1
    word, i = ragged(np.maximum(b - a - n + 1, 0))
    i += a[word]
    return p.hash(cp[i], cp[i + n]) ^ _salt(n), word


class Model:
    """Languages in order, tables of words and of each n, and log frequencies by key."""

    def __init__(self, langs: list[str], words: tuple[Table, np.ndarray], grams: dict[int, tuple[Table, np.ndarray]]):
        self.langs, self.words, self.grams = langs, words, grams

    def scores(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Sums of log frequency by text and language; numbers of words."""
        p = Packed(texts)
        s, e, doc = p.words()
        total = np.zeros((len(texts), len(self.langs)))
        n = np.bincount(doc, minlength=len(texts))

        def add(d, values):
            for k in range(len(self.langs)):
                total[:, k] += np.bincount(d, weights=values[:, k], minlength=len(texts))

        at = self.words[0].find(p.hash(s, e))
        add(doc[at >= 0], self.words[1][at[at >= 0]])
        todo = np.flatnonzero(at < 0)
        for g in GRAMS:
            if not len(todo):
                break
            h, word = _ngrams(p, s[todo], e[todo], g)
            table, logs = self.grams[g]
            at = table.find(h)
            word, at = word[at >= 0], at[at >= 0]
            hits = np.bincount(word, minlength=len(todo))
            add(doc[todo[word]], logs[at] / hits[word][:, None])
            todo = todo[hits == 0]
        return total, n

    def predict(self, texts: list, min_margin: float = MIN_MARGIN) -> tuple[list[str], np.ndarray]:
        lang, margin = [], np.zeros(len(texts))
        if len(self.langs) < 2:
            return [UNKNOWN] * len(texts), margin
        for x, y in slices(texts):
            total, n = self.scores(texts[x:y])
            best = np.argsort(-total, axis=1, kind="stable")[:, :2]
            rows = np.arange(y - x)
            m = (total[rows, best[:, 0]] - total[rows, best[:, 1]]) / np.maximum(n, 1)
            margin[x:y] = m
            lang += [self.langs[k] if v >= min_margin and w else UNKNOWN for k, v, w in zip(best[:, 0], m, n)]
        return lang, margin


class _Tally:
    """Counts of (key, language); what slices add is summed up as it comes, so that no key is held once per occurrence."""

    def __init__(self):
        self.keys, self.counts = np.zeros(0, U), np.zeros(0, np.int64)
        self.lang = np.zeros(0, np.int32)

    def add(self, keys: np.ndarray, lang: np.ndarray) -> None:
        keys, lang = np.concatenate([self.keys, keys]), np.concatenate([self.lang, lang.astype(np.int32)])
        counts = np.concatenate([self.counts, np.ones(len(keys) - len(self.counts), np.int64)])
        order = np.lexsort((lang, keys))
        keys, lang, counts = keys[order], lang[order], counts[order]
        new = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (lang[1:] != lang[:-1]))[: len(keys)])
        self.keys, self.lang, self.counts = keys[new], lang[new], np.add.reduceat(counts, new) if len(new) else counts


def _tally(texts: list, of: np.ndarray, into: dict[int, _Tally]) -> None:
    """Add the words (under 0) and n-grams (under n) of the texts, whose language numbers are ``of``."""
    for x, y in slices(texts):
        p = Packed(texts[x:y])
        s, e, doc = p.words()
        into[0].add(p.hash(s, e), of[x:y][doc])
        for n in GRAMS:
            h, word = _ngrams(p, s, e, n)
            into[n].add(h, of[x:y][doc[word]])


def _model(names: list[str], n: np.ndarray, keys: np.ndarray, lang: np.ndarray, counts: np.ndarray) -> Model:
    """From all keys of the sample, each once per n and language."""

    def logs(of: int) -> tuple[Table, np.ndarray]:
        at = n == of
        own, row = np.unique(keys[at], return_inverse=True)
        c = np.zeros((len(own), len(names)))
        c[row, lang[at]] = counts[at]
        return Table(own), np.log((c + 0.5) / (c.sum(0) + 0.5 * max(len(own), 1))).astype(np.float32)

    return Model(names, logs(0), {g: logs(g) for g in GRAMS})


def train(texts: list, langs: list) -> Model:
    """The model of ``fit`` for texts at hand."""
    names = sorted(set(langs))
    into = {n: _Tally() for n in (0, *GRAMS)}
    _tally(list(texts), np.array([names.index(x) for x in langs], np.int64), into)
    of = np.concatenate([np.full(len(t.keys), n) for n, t in into.items()])
    return _model(names, of, *(np.concatenate([getattr(t, c) for t in into.values()]) for c in ("keys", "lang", "counts")))


def sample(docs: DataFrame, label: str, rows: int) -> tuple[DataFrame, list]:
    """``rows`` labelled rows of least hashed doc_id, in equal shares by label (doc_id, text, label), and the labels. The texts stay on the executors."""
    known = docs.where(F.col(label).isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "text", label)
    ids = known.select(F.col("doc_id").alias("i"), F.col(label).alias("l")).distinct()
    labels = sorted(r["l"] for r in ids.select("l").distinct().collect())
    picked = None
    for v in labels:
        part = ids.where(F.col("l") == F.lit(v)).orderBy(F.xxhash64("i"), "i").limit(max(1, rows // len(labels))).select("i")
        picked = part if picked is None else picked.union(part)
    if picked is None:
        return known.limit(0), []
    return known.join(F.broadcast(picked.distinct()), F.col("doc_id") == F.col("i"), "left_semi"), labels  # at most ``rows`` ids


def fit(docs: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Counted on the executors; the driver gets each key of the sample once per language."""
    some, names = sample(docs, "lang", rows)
    number = {v: k for k, v in enumerate(names)}

    def count(batches):
        into = {n: _Tally() for n in (0, *GRAMS)}
        for b in small(batches):
            _tally(b.column(0).to_pylist(), np.array([number[v] for v in b.column(1).to_pylist()], np.int64), into)
        for n, t in into.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(t.keys), n, np.int32)), pa.array(t.keys.view(np.int64)), pa.array(t.lang), pa.array(t.counts)], ["n", "h", "l", "c"])

    got = some.select("text", "lang").mapInArrow(count, "n int, h long, l int, c long").groupBy("n", "h", "l").agg(F.sum("c").alias("c")).toArrow()
    n, h, lang, c = (got.column(k).to_numpy() for k in ("n", "h", "l", "c"))
    return _model(names, n, h.astype(np.int64).view(U), lang, c)


def identify(docs: DataFrame, model: Model | None = None, min_margin: float = MIN_MARGIN) -> DataFrame:
    """One row per input row: doc_id, language (``und`` where rejected), margin, keep."""
    model = model or fit(docs)

    def run(batches):
        for b in small(batches):
            lang, margin = model.predict(b.column(1).to_pylist(), min_margin)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(margin), pa.array([x != UNKNOWN for x in lang], pa.bool_())], ["doc_id", "language", "margin", "keep"])

    return text_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, language string, margin double, keep boolean")


def language_stage(docs: DataFrame, model: Model | None = None, min_margin: float = MIN_MARGIN) -> DataFrame:
    """The rows of ``docs`` whose language is known."""
    model, at = model or fit(docs), docs.columns.index("text")

    def run(batches):
        for b in small(batches):
            lang, _ = model.predict(b.column(at).to_pylist(), min_margin)
            yield b.filter(pa.array([x != UNKNOWN for x in lang], pa.bool_()))

    return text_batches(docs).mapInArrow(run, docs.schema)

"""Benchmark decontamination by exact word retrieval, with latent semantic cosines.

The vocabulary is the benchmark's words. Every document is reduced to the places of those words;
overlapping passages of ``WINDOW`` words, a new one every ``STEP``, are TF-IDF rows over the
words that are not common in the benchmark. Every passage is compared with every item that it can
hold ``MIN_LCS`` of: an item is looked up by its rarest words, as many as leave less than that
share, so a passage without one of them cannot be a leak. Each such pair is verified: the longest
common subsequence of words must hold ``MIN_LCS`` of the item, and at least half of the informative
words of the item's last sentence, its answer, must be in the passage.

The ``cosine`` of a leak is reported and decides nothing. It is taken in the right singular
subspace of ``RANK`` dimensions, from two passes of distributed randomised subspace iteration
(Gaussian start, one power step) over all passages, with the benchmark's own rows added at equal
energy.

Items of more than ``STEP`` words are matched by pieces of at most that many, so that a piece
always lies within one passage; one matched piece is a leak.

Nulls, ties, extremes: null or empty texts leak nothing and items of null text are left out; a
piece whose words are all common in the benchmark leaks only where all of it stands word by word, as such words turn up in order anywhere; rows with a null
doc_id are not reported and stay in the stage; rows of one doc_id are reported once per item with
the greatest figures; of repeated items each item_id is reported; all words of a long document are read. Empty tables give an
empty result. Other columns are not read.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .spans import Packed, Table, slices, small
from .store import Scratch, text_batches

WINDOW, STEP = 128, 64
RANK = 64
MIN_LCS, MIN_ANSWER = 0.6, 0.5
#: Items handled in one run over the documents; more are done in further runs.
ITEMS = 20_000
BLOCK = 512
#: Cells of the search's dense tables; sets how many passages are compared at a time.
CELLS = 1 << 21
#: Documents handled at a time: their passages' sketches are held, one of RANK numbers for each word.
DOCS = 128


class Bench:
    """Vocabulary, pieces and answers of a benchmark."""

    def __init__(self, ids: list, texts: list):
        self.ids = list(ids)
        p = Packed(list(texts))
        s, e, item = p.words()
        h = p.hash(s, e)
        self.table = Table(np.unique(h))
        term = self.table.find(h)
        v = len(self.table.keys)
        both = np.unique(item * max(v, 1) + term)
        df = np.bincount(both % max(v, 1), minlength=v)
        #: A word is common when over 3 items, and over a tenth of all, hold it.
        self.common = df > max(3, 0.1 * len(texts))
        self.seqs, self.item, self.answer = [], [], []
        for i, t in enumerate(texts):
            seq = term[item == i] if len(texts) < 50 else term[np.searchsorted(item, i) : np.searchsorted(item, i + 1)]
            parts = [x for x in re.split(r"(?<=[.!?])\s+|\n", t.strip()) if re.search(r"\w", x)]
            q = Packed(parts[-1:])
            a, b, _ = q.words()
            last = self.table.find(q.hash(a, b))
            last = last[last >= 0]
            n = -(-len(seq) // STEP)
            for k in range(n):
                piece = seq[k * len(seq) // n : (k + 1) * len(seq) // n]
                own = np.unique(last[np.isin(last, piece) & ~self.common[last]])
                self.seqs.append(piece)
                self.item.append(i)
                self.answer.append(own)
        self.wide = np.uint32 if v > 65535 else np.uint16

    def matrix(self, idf: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.seqs), len(idf)), np.float32)
        for k, s in enumerate(self.seqs):
            np.add.at(out[k], s, 1)
        return out * idf


def _occurrences(bench: Bench):
    """Per document: gaps between places of vocabulary words, and the words."""

    def run(batches):
        for b in small(batches):
            texts = b.column(1).to_pylist()
            gaps, terms = [b""] * len(texts), [b""] * len(texts)
            for x, y in slices(texts):
                p = Packed(texts[x:y])
                s, e, doc = p.words()
                t = bench.table.find(p.hash(s, e))
                have = np.flatnonzero(t >= 0)
                t, d = t[have].astype(bench.wide), doc[have]
                first = np.searchsorted(doc, np.arange(y - x))
                place = have - first[d]
                gap = place.copy()
                gap[1:] -= np.where(d[1:] == d[:-1], place[:-1], 0)
                gap = gap.astype(np.uint32)
                cut = np.searchsorted(d, np.arange(y - x + 1))
                for k in range(y - x):
                    gaps[x + k], terms[x + k] = gap[cut[k] : cut[k + 1]].tobytes(), t[cut[k] : cut[k + 1]].tobytes()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(gaps, pa.binary()), pa.array(terms, pa.binary())], ["d", "gaps", "terms"]).filter(pa.array([bool(t) for t in terms], pa.bool_()))

    return run


def _passages(b: pa.RecordBatch, wide, overlap: bool):
    """Passage number within the batch, word, document and place of each occurrence (once or twice); passages are in order."""
    terms = np.frombuffer(b"".join(b.column("terms").to_pylist()), wide).astype(np.int64)
    sizes = np.array([len(x) // wide().itemsize for x in b.column("terms").to_pylist()], np.int64)
    gap = np.frombuffer(b"".join(b.column("gaps").to_pylist()), np.uint32).astype(np.int64)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    run = np.cumsum(gap)
    start = np.cumsum(sizes) - sizes
    place = run - (run[start] - gap[start])[doc] if len(run) else run
    unit = STEP if overlap else WINDOW
    span = np.zeros(len(sizes), np.int64)
    last = np.cumsum(sizes) - 1
    span[sizes > 0] = place[last[sizes > 0]] // unit + 1
    base = np.cumsum(span) - span
    number = base[doc] + place // unit
    return terms, doc, place, number, base


def _rows(terms, number, informative):
    """Sparse rows: distinct (passage, word) in order, and counts."""
    ok = informative[terms]
    v = len(informative)
    key, n = np.unique(number[ok] * v + terms[ok], return_counts=True)
    return key // v, key % v, n.astype(np.float32)


def _blocks(total: np.ndarray):
    for k in range(0, len(total), BLOCK):
        yield pa.RecordBatch.from_arrays([pa.array([k // BLOCK], pa.int32()), pa.array([total[k : k + BLOCK].tobytes()], pa.binary())], ["block", "x"])


def _sum(df: DataFrame, n: int, width: int, dtype) -> np.ndarray:
    """Sum of the partitions' arrays, added up by block on the executors; the driver gets one array of the vocabulary's size."""

    def add(key, batches):
        total = None
        for b in batches:
            for x in b.column("x").to_pylist():
                a = np.frombuffer(x, dtype)
                total = a.copy() if total is None else total + a
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["block", "x"])

    def whole(key, table):
        return pa.Table.from_batches(list(add(key, table.to_batches())))

    got = df.groupBy("block").applyInArrow(whole, "block int, x binary").collect()
    out = np.zeros((n, width), dtype)
    for r in got:
        a = np.frombuffer(r["x"], dtype).reshape(-1, width)
        out[r["block"] * BLOCK : r["block"] * BLOCK + len(a)] = a
    return out


def _df(bench: Bench):
    v, wide, informative = len(bench.table.keys), bench.wide, ~bench.common

    def run(batches):
        total = np.zeros((v, 1))
        for b in small(batches, DOCS):
            terms, _, _, number, _ = _passages(b, wide, False)
            _, t, _ = _rows(terms, number, informative)
            total[:, 0] += np.bincount(t, minlength=v)
        yield from _blocks(total)

    return run


def _gram_times(bench: Bench, idf: np.ndarray, q: np.ndarray):
    """Each partition's part of A'(A q)."""
    v, wide, informative, q = len(idf), bench.wide, ~bench.common, q.astype(np.float32)

    def run(batches):
        total = np.zeros((v, q.shape[1]))
        for b in small(batches, DOCS):
            terms, _, _, number, _ = _passages(b, wide, False)
            row, t, n = _rows(terms, number, informative)
            if not len(row):
                continue
            w = n * idf[t]
            new = np.flatnonzero(np.diff(row, prepend=-1))
            z = np.add.reduceat(q[t] * w[:, None], new, axis=0)
            z = z[np.cumsum(np.diff(row, prepend=row[0]) > 0)]
            order = np.argsort(t, kind="stable")
            ts = t[order]
            cut = np.flatnonzero(np.diff(ts, prepend=-1))
            total[ts[cut]] += np.add.reduceat(z[order] * w[order, None], cut, axis=0)
        yield from _blocks(total)

    return run


def lcs(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, 64 and more places at a time in the bits of one integer."""
    masks: dict[int, int] = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for y in b:
        u = v & masks.get(y, 0)
        if u:
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def _padded(lists: list[np.ndarray], fill: int) -> np.ndarray:
    out = np.full((len(lists), max([1, *map(len, lists)])), fill, np.int64)
    for k, x in enumerate(lists):
        out[k, : len(x)] = x
    return out


def _prefixes(bench: Bench, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per word, where its pieces start, and the pieces: each piece is under its rarest words, as many
    as leave less than ``MIN_LCS`` of it, so no passage without one of them can hold that much."""
    word, piece = [], []
    for k, s in enumerate(bench.seqs):
        t, n = np.unique(s, return_counts=True)
        order = np.lexsort((t, -idf[t], bench.common[t]))
        before = np.cumsum(n[order]) - n[order]
        t = t[order][:1] if bench.common[t].all() else t[order][len(s) - before >= MIN_LCS * len(s)]
        word.append(t)
        piece.append(np.full(len(t), k))
    word, piece = np.concatenate(word), np.concatenate(piece)
    order = np.argsort(word, kind="stable")
    return np.searchsorted(word[order], np.arange(len(idf) + 1)), piece[order]


def _verbatim(piece: np.ndarray, words: np.ndarray, place: np.ndarray) -> bool:
    """Whether the piece stands in the words, one right after the other."""
    n = len(piece)
    at = np.flatnonzero(words[: len(words) - n + 1] == piece[0]) if n <= len(words) else np.zeros(0, int)
    return any(place[i + n - 1] - place[i] == n - 1 and np.array_equal(words[i : i + n], piece) for i in at)


def _search(bench: Bench, idf: np.ndarray, q: np.ndarray):
    wide, informative, q = bench.wide, ~bench.common, q.astype(np.float32)
    items = bench.matrix(idf) @ q
    size = np.linalg.norm(items, axis=1, keepdims=True)
    items = np.where(size > 1e-9, items / np.maximum(size, 1e-9), 0).astype(np.float32)
    seqs = [s.tolist() for s in bench.seqs]
    v = len(idf)
    # a word number of v is of no passage
    words, answers = _padded(bench.seqs, v), _padded(bench.answer, v)
    lengths, n_answers = np.array([len(s) for s in bench.seqs]), np.array([len(a) for a in bench.answer])
    plain = np.array([bench.common[s].all() for s in bench.seqs])
    least = np.where(plain, 1.0, MIN_LCS)
    start, under = _prefixes(bench, idf)
    chunk = int(min(4096, max(16, CELLS // max(v, len(items)))))
    # pairs whose words are looked up at a time
    most = max(1, CELLS // words.shape[1])

    def run(batches):
        for b in small(batches, DOCS):
            found: list[tuple] = []
            terms, doc, place, number, base = _passages(b, wide, True)
            # each occurrence is of the passage that starts at or before it, and of the one before that
            t2 = np.concatenate([terms, terms[place >= STEP]])
            n2 = np.concatenate([number, number[place >= STEP] - 1])
            every, term, times = _rows(t2, n2, np.ones(v, bool))
            some = informative[term]
            row, t, n = every[some], term[some], times[some]
            if len(every):
                w = n * idf[t]
                rows = every[np.flatnonzero(np.diff(every, prepend=-1))]
                for at in range(0, len(rows), chunk):
                    part = rows[at : at + chunk]
                    x, y = np.searchsorted(every, [part[0], part[-1] + 1])
                    has = np.zeros((len(part), v + 1), bool)
                    r = np.searchsorted(part, every[x:y])
                    own = part[np.minimum(r, len(part) - 1)] == every[x:y]
                    has[r[own], term[x:y][own]] = True
                    # every piece under a word that the passage has
                    r, of = r[own], term[x:y][own]
                    n_under = start[of + 1] - start[of]
                    cut = np.concatenate([[0], np.cumsum(n_under)])
                    lo, pairs = 0, []
                    while lo < len(of):
                        hi = max(lo + 1, int(np.searchsorted(cut, cut[lo] + most, "right")) - 1)
                        m = n_under[lo:hi]
                        k = under[np.repeat(start[of[lo:hi]] - (cut[lo:hi] - cut[lo]), m) + np.arange(m.sum())]
                        i = np.repeat(r[lo:hi], m)
                        i, k = np.divmod(np.unique(i * len(items) + k), len(items))
                        # no subsequence is longer than the number of the piece's words that the passage has
                        ok = has[i[:, None], words[k]].sum(1) >= least[k] * lengths[k]
                        i, k = i[ok], k[ok]
                        ok = has[i[:, None], answers[k]].sum(1) >= MIN_ANSWER * n_answers[k]
                        pairs.append(i[ok] * len(items) + k[ok])
                        lo = hi
                    for i, k in zip(*np.divmod(np.unique(np.concatenate(pairs)), len(items))):
                        r = part[i]
                        lo, hi = np.searchsorted(number, [r, r + 2])
                        d = doc[lo]
                        inside = (doc[lo:hi] == d) & (place[lo:hi] < (r - base[d] + 2) * STEP)
                        window = terms[lo:hi][inside]
                        share = lcs(seqs[k], window.tolist()) / len(seqs[k])
                        if share >= least[k] and (not plain[k] or _verbatim(bench.seqs[k], window, place[lo:hi][inside])):
                            x, y = np.searchsorted(row, [r, r + 1])
                            z = w[x:y] @ q[t[x:y]]
                            c = z @ items[k] / max(np.linalg.norm(z), 1e-9)
                            found.append((int(d), bench.ids[bench.item[k]], int((r - base[d]) * STEP), float(c), share))
            ids = b.column("d").to_pylist()
            cols = list(zip(*found)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array([ids[x] for x in cols[0]], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.float64()), pa.array(cols[4], pa.float64())], ["doc_id", "item_id", "place", "cosine", "lcs"])

    return run


FOUND = "doc_id long, item_id long, place long, cosine double, lcs double"


def subspace(table: DataFrame, bench: Bench, rank: int = RANK) -> tuple[np.ndarray, np.ndarray]:
    """Inverse document frequencies, and an orthonormal basis of the passages' leading right singular subspace."""
    v = len(bench.table.keys)
    df = _sum(table.mapInArrow(_df(bench), "block int, x binary"), v, 1, np.float64)[:, 0]
    idf = np.where(bench.common, 0, np.log1p((df.max(initial=1) + 1) / (df + 1))).astype(np.float32)
    own = bench.matrix(idf).astype(np.float64)
    q = np.random.default_rng(3).standard_normal((v, min(rank, v)))
    for _ in range(2):
        y = _sum(table.mapInArrow(_gram_times(bench, idf, q), "block int, x binary"), v, q.shape[1], np.float64)
        z = own.T @ (own @ q)
        scale = np.linalg.norm(y) / max(np.linalg.norm(z), 1e-12)
        q, _ = np.linalg.qr(y + (scale or 1.0) * z)
    return idf, q


def leaks(docs: DataFrame, benchmark: DataFrame, rank: int = RANK) -> DataFrame:
    """One row per leaked (doc_id, item_id): the first place (in words) and the greatest cosine and share of the item found."""
    spark = docs.sparkSession
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct().orderBy("item_id", "text").toLocalIterator()
    out = None
    while got := [(r["item_id"], r["text"]) for r in itertools.islice(items, ITEMS)]:
        bench = Bench([i for i, _ in got], [t for _, t in got])
        if not bench.seqs:
            continue
        scratch = Scratch(spark)
        of = text_batches(docs).where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        table = scratch.keep(of.mapInArrow(_occurrences(bench), "d long, gaps binary, terms binary"), "words")
        idf, q = subspace(table, bench, rank)
        hits = table.mapInArrow(_search(bench, idf, q), FOUND).groupBy("doc_id", "item_id").agg(F.min("place").alias("place"), F.max("cosine").alias("cosine"), F.max("lcs").alias("lcs")).checkpoint()
        scratch.drop()
        out = hits if out is None else out.union(hits)
    return out if out is not None else spark.createDataFrame([], FOUND)


def decontaminate_stage(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    return docs.join(leaks(docs, benchmark).select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)

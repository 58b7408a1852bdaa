"""Near-duplicate groups from SetSketch registers.

Each document's set of word ``SHINGLE``-grams gives ``M`` registers: register i is
floor(1 - log_B(h)) for the least exponential variate h that the i-th hash gives any shingle,
cut off to 0..LIMIT. Documents that share the registers of a band are candidates; the joint
likelihood of the numbers of greater, smaller and equal registers estimates their Jaccard
similarity; those near the threshold or above it are verified on their whole shingle sets (as
32-bit hashes). Groups are the connected components of the verified pairs.

Candidates are not capped. Texts with equal word sequences are one node. Each member of a bucket
is first compared with the bucket's least id. Then, in the buckets whose members are still in several
components, members outside the least id's component are compared with all members of other
components, in blocks: a block pair is one row group whatever the bucket's size, and holds the
low bits of the registers, so that each pair which shares a bucket is either compared or already
in one group. Between the steps only ids are shuffled; sketches and sets are fetched by id for the distinct pairs.

Two texts of similarity 0.5 share a band with probability 0.95, of 0.6 with 0.9996; beyond that only the estimate's
error, four standard errors at ``SLACK`` and ``LOW_SLACK``, can lose a pair.

Nulls, ties, extremes: texts that are null or hold no words are no one's copies. Rows with a null
doc_id are left out of the result and stay in the stage. Rows that share a doc_id are one document: what is a copy of
any of its texts is a copy of it, and they stay or go together. A text of fewer words than a shingle is one
shingle. The document of least id is the one that stays. An empty table gives an empty result.
Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .spans import Packed, U, mix, ragged, shingles, slices, small
from .store import Scratch, text_batches

SHINGLE, BANDS, ROWS = 3, 96, 5
M = 360
#: The registers of each band: 72 bands share none, and 24 more take one from each of five of those.
_BAND = np.concatenate([np.arange(M).reshape(-1, ROWS), np.arange(24 * ROWS).reshape(ROWS, 24).T])
THRESHOLD = 0.5
#: Candidates estimated under THRESHOLD - SLACK are not verified: about 4 standard errors of the estimate.
SLACK = 0.1
#: Registers whose low bits go to the blocks, enough to leave out most pairs: 4 standard errors below the threshold.
LOW, LOW_SLACK = 128, 0.18
#: Members of a bucket in a block; ids that are broadcast at most (8 bytes each); pairs that a task lists at a time.
BLOCK, FEW_IDS, PAIRS = 512, 1 << 20, 1 << 17
BASE, RATE, LIMIT = 1.001, 20.0, 2**16 - 2
_MUL = (np.random.default_rng(7).integers(0, 1 << 31, M, dtype=np.int64) * 2 + 1).astype(np.uint32)
_XOR = np.random.default_rng(8).integers(0, 1 << 32, M, dtype=np.int64).astype(np.uint32)


def registers(h: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """(n, M) registers; shingles come ordered by document. Documents without any have zeros."""
    out = np.zeros((n, M), np.uint16)
    if not len(h):
        return out
    count = np.bincount(doc, minlength=n)
    have = np.flatnonzero(count)
    start = np.concatenate([[0], np.cumsum(count[have])[:-1]])
    x = (h >> U(32)).astype(np.uint32)
    low = np.empty((len(have), M), np.uint32)
    y = np.empty_like(x)
    for i in range(M):
        np.bitwise_xor(x, _XOR[i], out=y)
        np.multiply(y, _MUL[i], out=y)
        low[:, i] = np.minimum.reduceat(y, start)
    value = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0**32) / RATE
    out[have] = np.clip(np.floor(1 - np.log(value) / np.log(BASE)), 0, LIMIT).astype(np.uint16)
    return out


def _p(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs of sketches with sets of known sizes."""
    up, down = (a > b).sum(1)[:, None], (a < b).sum(1)[:, None]
    same = M - up - down
    u = (na / (na + nb))[:, None]
    v = 1 - u
    top = np.minimum(u / v, v / u)
    lo, hi = np.zeros_like(top), top
    for _ in range(3):
        j = lo + (hi - lo) * np.linspace(0, 1, 21)
        pu, pd_ = _p(u - v * j), _p(v - u * j)
        like = up * np.log(np.maximum(pu, 1e-12)) + down * np.log(np.maximum(pd_, 1e-12)) + same * np.log(np.maximum(1 - pu - pd_, 1e-12))
        best = np.take_along_axis(j, like.argmax(1)[:, None], 1)
        step = (hi - lo) / 20
        lo, hi = np.maximum(best - step, 0), np.minimum(best + step, top)
    return best[:, 0]


def _hashed(texts: list):
    p = Packed(texts)
    s, e, doc = p.words()
    h = p.hash(s, e)
    g, gdoc = shingles(h, doc, len(texts), SHINGLE)
    return h, doc, g, gdoc


def _binary(x: np.ndarray) -> pa.Array:
    """Each row's bytes."""
    n, width = len(x), x.itemsize * x.shape[1]
    at = pa.py_buffer(np.arange(0, (n + 1) * width, max(width, 1), dtype=np.int32)[: n + 1])
    return pa.Array.from_buffers(pa.binary(), n, [None, at, pa.py_buffer(np.ascontiguousarray(x))])


def _features(batches):
    for b in small(batches):
        ids, texts = b.column(0), b.column(1).to_pylist()
        for x, y in slices(texts):
            n = y - x
            h, doc, g, gdoc = _hashed(texts[x:y])
            order = np.lexsort((g, gdoc))
            so, sd = g[order], gdoc[order]
            new = np.ones(len(so), bool)
            new[1:] = (so[1:] != so[:-1]) | (sd[1:] != sd[:-1])
            size = np.bincount(sd[new], minlength=n)
            reg = registers(so[new], sd[new], n)
            # the word sequence as two sums of place-dependent hashes
            count = np.bincount(doc, minlength=n)
            place = (np.arange(len(h)) - np.repeat(np.cumsum(count) - count, count)).astype(U)
            k1, k2 = np.zeros(n, U), np.zeros(n, U)
            have = np.flatnonzero(count)
            if len(have):
                at = (np.cumsum(count) - count)[have]
                k1[have] = np.add.reduceat(mix(h + place * U(0x9E3779B97F4A7C15)), at)
                k2[have] = np.add.reduceat(mix(h ^ mix(place + U(12345))), at)
            yield pa.RecordBatch.from_arrays(
                [ids[x:y], pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), pa.array(size.astype(np.int32)), _binary(reg)],
                ["d", "k1", "k2", "size", "reg"],
            ).filter(pa.array(size > 0))


def _bands(batches):
    for b in small(batches, 2048):
        reg = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint16).reshape(-1, M)
        key = np.full((len(reg), BANDS), U(17))
        for r in range(ROWS):
            key = mix(key * U(0x100000001B3) + reg[:, _BAND[:, r]].astype(U))
        key = mix(key + np.arange(BANDS, dtype=U))
        yield pa.RecordBatch.from_arrays([pa.array(key.reshape(-1).view(np.int64)), pa.array(np.repeat(b.column(0).to_numpy(), BANDS))], ["bucket", "d"])


def _estimates(batches):
    for b in small(batches, 1024):
        a, c = (np.frombuffer(b"".join(b.column(k).to_pylist()), np.uint16).reshape(-1, M) for k in ("rega", "regb"))
        j = estimate(a, c, b.column("na").to_numpy().astype(float), b.column("nb").to_numpy().astype(float))
        yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(j)], ["a", "b", "j"])


def _low(batches):
    """The low four bits of the first ``LOW`` registers, two registers in a byte."""
    for b in small(batches, 2048):
        reg = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint16).reshape(-1, M)[:, :LOW] & 15
        yield pa.RecordBatch.from_arrays([b.column(0), _binary((reg[:, ::2] << 4 | reg[:, 1::2]).astype(np.uint8))], ["d", "low"])


def _cross(threshold: float):
    """Rows ordered by (bucket, i, j): pairs of members in different components whose share of equal low
    bits leaves room for the threshold. In the block pair (i, j) the outer members of block i ask, all of block j answer."""
    # registers that differ may share their low bits too, so this errs to the safe side
    least = LOW * (threshold - LOW_SLACK)

    def solve(t: pa.Table, start: np.ndarray):
        col = lambda c: t.column(c).to_numpy()
        d, g, outer = col("d"), col("g"), col("outer")
        answers = col("jb") == col("j")
        raw = np.frombuffer(b"".join(t.column("low").to_pylist()), np.uint8).reshape(-1, LOW // 2)
        low = np.concatenate([raw >> 4, raw & 15], 1)
        size = np.diff(np.append(start, len(d)))
        group = np.repeat(np.arange(len(start)), size)
        ask = np.flatnonzero(outer & (col("ib") == col("i")))
        many = np.cumsum(size[group[ask]])
        at = 0
        while at < len(ask):
            end = max(at + 1, int(np.searchsorted(many, (many[at - 1] if at else 0) + PAIRS, "right")))
            x, k = ragged(size[group[ask[at:end]]])
            x = ask[at:end][x]
            y = start[group[x]] + k
            # of two outer members the lesser one asks
            ok = answers[y] & (g[x] != g[y]) & ~(outer[y] & (d[y] < d[x]))
            x, y = x[ok], y[ok]
            _, one = np.unique(np.stack([np.minimum(d[x], d[y]), np.maximum(d[x], d[y])], 1), axis=0, return_index=True)
            for c in range(0, len(one), PAIRS // 8):
                p, q = x[one[c : c + PAIRS // 8]], y[one[c : c + PAIRS // 8]]
                ok = (low[p] == low[q]).sum(1) >= least
                if ok.any():
                    p, q = d[p[ok]], d[q[ok]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(p, q)), pa.array(np.maximum(p, q))], ["a", "b"])
            at = end

    def run(batches):
        rest = None
        for b in itertools.chain(small(batches, 4096), [None]):
            t = pa.Table.from_batches([x for x in (rest, b) if x is not None]) if rest is not None or b is not None else None
            if t is None:
                continue
            k = [t.column(c).to_numpy() for c in ("bucket", "i", "j")]
            start = np.flatnonzero(np.append(True, np.any([x[1:] != x[:-1] for x in k], axis=0)))
            last = t.num_rows if b is None else int(start[-1])
            rest = t.slice(last).combine_chunks().to_batches()[0] if last < t.num_rows else None
            if last:
                yield from solve(t.slice(0, last), start[start < last])

    return run


def _sets(batches):
    """Each text's shingles: sorted 32-bit hashes without repeats."""
    for b in small(batches):
        texts, out = b.column(1).to_pylist(), []
        for x, y in slices(texts):
            _, _, g, gdoc = _hashed(texts[x:y])
            cut = np.searchsorted(gdoc, np.arange(y - x + 1))
            g = (g >> U(32)).astype(np.uint32)
            out += [np.unique(g[cut[k] : cut[k + 1]]).tobytes() for k in range(y - x)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["d", "s"])


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted arrays without repeats."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)


def _verifier(threshold: float):
    def verify(batches):
        for b in small(batches, 1024):
            sa, sb = ([np.frombuffer(s, np.uint32) for s in b.column(k).to_pylist()] for k in ("sa", "sb"))
            keep = [jaccard(x, y) >= threshold for x, y in zip(sa, sb)]
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return verify


class _Run:
    def __init__(self, docs: DataFrame, threshold: float):
        self.docs = text_batches(docs).where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("d"), "text")
        self.spark, self.scratch, self.threshold = docs.sparkSession, Scratch(docs.sparkSession), threshold

    def few(self, df: DataFrame) -> DataFrame:
        """A table of ids, marked for broadcast if it holds few."""
        return F.broadcast(df) if df.count() <= FEW_IDS else df

    def of(self, rows: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
        """The rows whose id ``d`` is in a pair; few ids are broadcast, so that the other rows are not shuffled."""
        ids = self.scratch.keep(pairs.select(F.explode(F.array("a", "b")).alias("d")).distinct(), name)
        return rows.join(self.few(ids), "d", "left_semi")

    def close(self, pairs: DataFrame, name: str) -> DataFrame:
        """Of distinct pairs (a, b), those whose estimate comes near the threshold and whose whole shingle sets reach it."""
        keep, drop = self.scratch.keep, self.scratch.drop
        pairs = keep(pairs, f"asked_{name}")
        side = lambda t, s, old, new: t.select(F.col("d").alias(s), *(F.col(o).alias(n) for o, n in zip(old, new)))
        nodes = keep(self.of(self.nodes, pairs, f"ids_{name}"), f"sketches_{name}")
        both = pairs.join(side(nodes, "b", ("reg", "size"), ("regb", "nb")), "b").join(side(nodes, "a", ("reg", "size"), ("rega", "na")), "a")
        near = both.select("a", "b", "rega", "regb", "na", "nb").mapInArrow(_estimates, "a long, b long, j double").where(F.col("j") >= self.threshold - SLACK).select("a", "b").distinct()
        near = keep(near, f"near_{name}")
        drop(f"sketches_{name}")
        sets = keep(self.of(self.docs, near, f"near_ids_{name}").mapInArrow(_sets, "d long, s binary").where(F.octet_length("s") > 0), f"sets_{name}")
        both = near.join(side(sets, "b", ("s",), ("sb",)), "b").join(side(sets, "a", ("s",), ("sa",)), "a").select("a", "b", "sa", "sb")
        out = keep(both.mapInArrow(_verifier(self.threshold), "a long, b long").distinct(), f"pairs_{name}")
        for t in ("asked", "ids", "near_ids", "near", "sets"):
            drop(f"{t}_{name}")
        return out

    def components(self, pairs: DataFrame, name: str) -> DataFrame:
        """(d, g) for every node that has a pair: g is the least id of its component. Alternates hooking to the least neighbour and halving of paths."""
        edges = self.scratch.keep(pairs.union(pairs.select("b", "a")).distinct(), f"edges_{name}")
        label = self.scratch.keep(edges.groupBy(F.col("a").alias("d")).agg(F.least(F.min("b"), F.first("a")).alias("g")), f"label_{name}_0")
        step = 0
        while True:
            step += 1
            near = edges.join(label.toDF("b", "gb"), "b").groupBy(F.col("a").alias("d")).agg(F.min("gb").alias("m"))
            hooked = label.join(near, "d").select("d", "g", F.least("g", "m").alias("m"))
            jump = hooked.join(label.toDF("m", "mm"), "m", "left").select("d", "g", F.least("m", F.coalesce("mm", "m")).alias("new"))
            new = self.scratch.keep(jump.select("d", F.col("new").alias("g"), (F.col("new") != F.col("g")).alias("moved")), f"label_{name}_{step}")
            if not new.where("moved").limit(1).count():
                self.scratch.drop(f"edges_{name}")
                return new.select("d", "g")
            label = new.select("d", "g")
            self.scratch.drop(f"label_{name}_{step - 1}")

    def groups(self) -> DataFrame:
        keep, drop = self.scratch.keep, self.scratch.drop
        rows = keep(self.docs.mapInArrow(_features, "d long, k1 long, k2 long, size int, reg binary"), "rows")
        same = rows.groupBy("k1", "k2").agg(F.min("d").alias("g"), F.count("*").alias("n")).where("n > 1").drop("n")
        copies = keep(rows.select("d", "k1", "k2").join(same, ["k1", "k2"]), "copies")
        # an id stays in the comparison with those of its texts that no lesser id has
        gone = self.few(copies.where("d != g").select("d", "k1", "k2"))
        self.nodes = keep(rows.join(gone, ["d", "k1", "k2"], "left_anti").select("d", "reg", "size"), "nodes")
        drop("rows")

        members = self.nodes.select("d", "reg").mapInArrow(_bands, "bucket long, d long")
        # counted before they are gathered: a bucket that holds much of the table is one row here
        shared = members.groupBy("bucket").agg(F.min("d").alias("a"), F.max("d").alias("z")).where("a < z").select("bucket", "a")
        shared = keep(members.join(shared, "bucket").select("bucket", "a", "d"), "shared")
        star = keep(shared.where("d != a").select("a", F.col("d").alias("b")).distinct(), "star")
        pairs = self.close(star, "star")
        label = self.components(pairs, "star")

        left = shared.join(self.few(label), "d", "left").select("bucket", "a", "d", F.coalesce("g", "d").alias("g"))
        left = keep(left, "left")
        drop("shared")
        hashes = [F.bit_xor(F.xxhash64("d", F.lit(k))).alias(f"x{k}") for k in (0, 1)]
        per = left.groupBy("bucket", "g").agg(F.min("d").alias("d"), F.count("*").alias("n"), *hashes)
        mixed = per.groupBy("bucket").agg(F.count("*").alias("many"), F.min_by("g", "d").alias("hub"), F.min_by("n", "d").alias("in_hub"), F.sum("n").alias("n"), *[F.bit_xor(f"x{k}").alias(f"x{k}") for k in (0, 1)]).where("many > 1")
        # buckets of the same members are compared once
        mixed = mixed.groupBy("n", "x0", "x1").agg(F.min_by(F.struct("bucket", "hub", "in_hub"), "bucket").alias("m")).select("m.bucket", "m.hub", F.expr(f"cast((n - m.in_hub + {BLOCK - 1}) div {BLOCK} as int)").alias("ni"), F.expr(f"cast((n + {BLOCK - 1}) div {BLOCK} as int)").alias("nj"))
        place = lambda k, n: F.pmod(F.xxhash64("d", F.lit(k)), F.col(n)).cast("int")
        inside = left.join(mixed, "bucket").select("bucket", "d", "g", (F.col("g") != F.col("hub")).alias("outer"), place(2, "ni").alias("ib"), place(3, "nj").alias("jb"), "ni", "nj")
        inside = keep(inside, "inside")
        drop("left")
        # every member answers in each block pair of its own j; outer members also ask in each of their own i
        answer = F.transform(F.expr("sequence(0, ni - 1)"), lambda i: F.struct(i.alias("i"), F.col("jb").alias("j")))
        ask = F.transform(F.expr("sequence(0, nj - 1)"), lambda j: F.struct(F.col("ib").alias("i"), j.alias("j")))
        to = F.when(F.col("outer"), F.array_distinct(F.concat(answer, ask))).otherwise(answer)
        low = self.of(self.nodes, inside.select(F.col("d").alias("a"), F.col("d").alias("b")), "mixed_ids").select("d", "reg").mapInArrow(_low, "d long, low binary")
        sent = inside.select("bucket", "d", "g", "outer", "ib", "jb", F.explode(to).alias("p")).join(low, "d").select("bucket", "p.i", "p.j", "ib", "jb", "outer", "d", "g", "low")
        cross = sent.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "d").mapInArrow(_cross(self.threshold), "a long, b long").distinct()
        rest = self.close(cross.join(star, ["a", "b"], "left_anti"), "cross")
        every = self.components(pairs.union(rest).union(copies.where("d != g").select(F.col("g").alias("a"), F.col("d").alias("b"))), "all")
        out = every.checkpoint()
        self.scratch.drop()
        return out


def duplicate_groups(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(d, g): every document that has near copies, and the least doc_id of its group."""
    return _Run(docs, threshold).groups()


def near_dedup(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per doc_id: doc_id, group_id (its group's least doc_id, its own if it has no copies), keep (whether it is that one)."""
    g = duplicate_groups(docs, threshold).toDF("doc_id", "__g")
    every = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct().join(g, "doc_id", "left")
    return every.select("doc_id", F.coalesce("__g", "doc_id").alias("group_id"), F.coalesce(F.col("__g") == F.col("doc_id"), F.lit(True)).alias("keep"))


def near_dedup_stage(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are the first of their group."""
    gone = duplicate_groups(docs, threshold).where("d != g").select(F.col("d").alias("doc_id"))
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)

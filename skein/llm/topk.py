"""Exact k nearest neighbours of a set of query vectors among all vectors, by pivot-table elimination.

Pivots are chosen far apart (greedy maximin over a bounded sample); each vector's distances to all
pivots are computed once. For a query q and a candidate x, max over pivots |d(q,p) - d(x,p)| is a
lower bound of d(q,x). Vectors are laid out in blocks by nearest pivot and by distance to it. A query
first searches the block that it lies in, which bounds the distance of its k-th neighbour. A block of queries
is then joined, through the pivots' cells, with the blocks whose distance ranges allow a nearer vector to any of
its queries; each such pair of blocks is searched on its own, and the results are merged by query.
Within a block the candidates are evaluated in order of lower bound, until the next bound is
greater than every query's k-th distance. Bounds carry a margin for rounding, so results are exact.

The queries are given by a condition on the id; by default every id divisible by 20 asks, all rows answer.

Nulls, ties, extremes: rows with a null id, or a vector that is null, empty, or holds a null or a
value that isn't finite, neither ask nor answer; vectors of another length than most are left out
too. Equal rows count once; rows of one id with different vectors each ask and answer, the nearest counting, and a row never
answers its own id. Distances are rounded to 9 places and ties go to the lesser id. Fewer than k
others give fewer rows. An empty table, or one without queries, gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .store import Scratch

K, PIVOTS, BLOCK, EVERY = 10, 32, 2048, 20
#: Bound on the vectors that pivots are chosen among.
PIVOT_SAMPLE = 4096
MARGIN = 1e-4
ROWS, COLUMNS = 128, 512  # queries and candidates handled at a time
RESULT = "query_id long, neighbor_id long, distance double, rank int"
_FAR = np.iinfo(np.int64).max


def choose_pivots(x: np.ndarray, n: int) -> np.ndarray:
    got = [int(np.argmax(((x - x.mean(0)) ** 2).sum(1)))] if len(x) else []
    far = np.full(len(x), np.inf)
    while got and len(got) < min(n, len(x)):
        far = np.minimum(far, ((x - x[got[-1]]) ** 2).sum(1))
        if far.max() <= 0:
            break
        got.append(int(far.argmax()))
    return x[got]


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d = (x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * (x @ y.T)
    return np.sqrt(np.maximum(d, 0))


class Best:
    """The k best so far of each query of a block."""

    def __init__(self, ids: np.ndarray, k: int, bound: np.ndarray | None = None):
        self.ids, self.k = ids, k
        self.d, self.i = np.full((len(ids), k), np.inf), np.full((len(ids), k), _FAR)
        #: No neighbour beyond it is wanted.
        self.bound = np.full(len(ids), np.inf) if bound is None else bound.copy()

    def offer(self, q: int, d: np.ndarray, i: np.ndarray) -> None:
        d, i = np.concatenate([self.d[q], d]), np.concatenate([self.i[q], i])
        order = np.lexsort((i, d))
        # one id may answer with several vectors: the nearest counts
        _, first = np.unique(i[order], return_index=True)
        order = order[np.sort(first)]
        order = order[i[order] != _FAR][: self.k]
        self.d[q], self.i[q] = np.inf, _FAR
        self.d[q, : len(order)], self.i[q, : len(order)] = d[order], i[order]
        self.bound[q] = min(self.bound[q], self.d[q, -1])

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        have = self.i.reshape(-1) != _FAR
        return np.repeat(self.ids, self.k)[have], self.i.reshape(-1)[have], self.d.reshape(-1)[have]


def visit(best: Best, q: np.ndarray, tq: np.ndarray, ids: np.ndarray, x: np.ndarray, tx: np.ndarray) -> int:
    """Offer a block's vectors to each query; returns how many distances were needed."""
    done = 0
    lo, hi, xx = tx.min(0), tx.max(0), (x * x).sum(1)
    # queries that the block's ranges do not rule out
    low_q = np.maximum(np.maximum(lo - tq, tq - hi).max(1), 0) - MARGIN
    some = np.flatnonzero(low_q <= best.bound)
    for at in range(0, len(some), ROWS):
        r = some[at : at + ROWS]
        low, gap = np.zeros((len(r), len(x)), np.float32), np.empty((len(r), len(x)), np.float32)
        for p in range(tq.shape[1]):
            np.subtract(tq[r, p, None], tx[None, :, p], out=gap)
            np.abs(gap, out=gap)
            np.maximum(low, gap, out=low)
        low -= np.float32(MARGIN)
        least = low.min(0)
        order = np.argsort(least, kind="stable")
        qq = (q[r] * q[r]).sum(1)
        for c in range(0, len(order), COLUMNS):
            cols = order[c : c + COLUMNS]
            bound = best.bound[r]
            if least[cols[0]] > bound.max():
                break
            ok = low[:, cols] <= bound[:, None]
            done += int(ok.sum())
            # within rounding of the bound or nearer; then exactly
            ok &= qq[:, None] + xx[cols][None] - 2 * (q[r] @ x[cols].T) <= (bound[:, None] + 1e-6) ** 2 + 1e-9 * (1 + qq[:, None])
            a, b = np.nonzero(ok)
            d = np.round(np.sqrt(((x[cols[b]] - q[r[a]]) ** 2).sum(1)), 9)
            use = (d <= bound[a]) & (ids[cols[b]] != best.ids[r[a]])
            a, b, d = a[use], b[use], d[use]
            cut = np.flatnonzero(np.diff(a, prepend=-1))
            for s, e in zip(cut, np.append(cut[1:], len(a))):
                best.offer(int(r[a[s]]), d[s:e], ids[cols[b[s:e]]])
    return done


def _unpack(row: dict, side: str, dim: int, n_pivots: int):
    ids = np.frombuffer(row[f"{side}ids"], np.int64)
    x = np.frombuffer(row[f"{side}x"], np.float64).reshape(-1, dim)
    return ids, x, np.frombuffer(row[f"{side}t"], np.float32).reshape(-1, n_pivots)


def _one_by_one(batches):
    for b in batches:
        for at in range(b.num_rows):
            yield b.slice(at, 1).to_pylist()[0]


def nearest(vectors: DataFrame, k: int = K, pivots: int = PIVOTS, block: int = BLOCK, every: int = EVERY, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """Up to k rows per query id, those divisible by ``every``: query_id, neighbor_id, distance (Euclidean, 9 places), rank (from 1)."""
    spark = vectors.sparkSession
    v = F.col(vector_column).cast("array<double>")
    solid = vectors.select(F.col(id_column).cast("long").alias("i"), v.alias("x")).where(
        F.col("i").isNotNull() & (F.size("x") > 0) & ~F.exists("x", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    )
    dims = solid.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    if not dims:
        return spark.createDataFrame([], RESULT)
    dim = dims[0]["n"]
    scratch = Scratch(spark)
    rows = scratch.keep(solid.where(F.size("x") == dim).distinct(), "rows")
    some = rows.orderBy(F.xxhash64("i"), "i", "x").limit(PIVOT_SAMPLE).select("x").toPandas()["x"]
    piv = choose_pivots(np.stack([np.asarray(a, float) for a in some]), pivots)

    def near(batches):
        for b in batches:
            x = b.column("x").flatten().to_numpy().reshape(-1, dim)
            d = distances(x, piv)
            yield pa.RecordBatch.from_arrays([b.column("i"), b.column("x"), pa.array(d.argmin(1).astype(np.int32)), pa.array(d.min(1))], ["i", "x", "cell", "far"])

    # range-sorted by cell and distance to its pivot: no cell, however full, is one task's; ranges are then cut into blocks
    laid = rows.mapInArrow(near, "i long, x array<double>, cell int, far double").repartitionByRange("cell", "far", "i").sortWithinPartitions("cell", "far", "i")

    def bundle(batches):
        def made(cell, ids, x):
            d = distances(x, piv).astype(np.float32)
            return [cell, len(ids), ids.tobytes(), np.ascontiguousarray(x).tobytes(), np.ascontiguousarray(d).tobytes(), d.min(0).tolist(), d.max(0).tolist()]

        types = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.float32()), pa.list_(pa.float32())]
        cell, ids, xs = None, [], []

        def flush():
            i, x = np.concatenate(ids), np.concatenate(xs)
            row = made(cell, i, x)
            ids.clear()
            xs.clear()
            return pa.RecordBatch.from_arrays([pa.array([f], t) for f, t in zip(row, types)], ["cell", "n", "ids", "x", "t", "lo", "hi"])

        for b in batches:
            i, c = b.column("i").to_numpy(), b.column("cell").to_numpy()
            x = b.column("x").flatten().to_numpy().reshape(-1, dim)
            at = 0
            while at < len(i):
                if ids and (c[at] != cell or sum(map(len, ids)) >= block):
                    yield flush()
                cell = int(c[at])
                end = min(len(i), at + block - sum(map(len, ids)), at + int(np.searchsorted(c[at:], cell, "right")))
                ids.append(i[at:end])
                xs.append(x[at:end])
                at = end
        if ids:
            yield flush()

    schema = "cell int, n int, ids binary, x binary, t binary, lo array<float>, hi array<float>"
    blocks = scratch.keep(laid.mapInArrow(bundle, schema).withColumn("b", F.monotonically_increasing_id()), "blocks")
    scratch.drop("rows")

    def own(batches):
        """Each block's queries, searched among its own vectors, with what bounds their further search."""
        for r in _one_by_one(batches):
            ids, x, t = _unpack(r, "", dim, len(piv))
            ask = ids % every == 0
            if not ask.any():
                continue
            best = Best(ids[ask], k)
            visit(best, x[ask], t[ask], ids, x, t)
            q, i, d = best.rows()
            tq = t[ask]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["b"]], pa.int64()), pa.array([float(best.bound.max())])]
                + [pa.array([np.ascontiguousarray(a).tobytes()], pa.binary()) for a in (best.ids, x[ask], tq, best.bound, q, i, d)]
                + [pa.array([a.tolist()], pa.list_(pa.float32())) for a in (tq.min(0), tq.max(0))],
                ["b", "tau", "qids", "qx", "qt", "bound", "fq", "fi", "fd", "qlo", "qhi"],
            )

    first = scratch.keep(blocks.select("b", "ids", "x", "t").mapInArrow(own, "b long, tau double, qids binary, qx binary, qt binary, bound binary, fq binary, fi binary, fd binary, qlo array<float>, qhi array<float>"), "first")
    gap = lambda lo, hi: F.aggregate(F.zip_with(F.arrays_zip("qlo", "qhi"), F.arrays_zip(lo, hi), lambda q, c: F.greatest(q["qlo"] - c[hi], c[lo] - q["qhi"], F.lit(0.0).cast("float"))), F.lit(0.0).cast("double"), lambda a, e: F.greatest(a, e.cast("double"))) - MARGIN
    # as many cells as pivots: query blocks go to the cells that may hold a nearer vector, then to those cells' blocks
    n = len(piv)
    edge = lambda f, c: F.array(*[f(F.col(c)[p]) for p in range(n)])
    cells = blocks.groupBy("cell").agg(edge(F.min, "lo").alias("clo"), edge(F.max, "hi").alias("chi"))
    asked = first.select("b", "tau", "qlo", "qhi")
    toward = asked.join(F.broadcast(cells), gap("clo", "chi") <= F.col("tau")).select("b", "tau", "qlo", "qhi", "cell")
    pairs = toward.join(blocks.select("cell", F.col("b").alias("c"), "lo", "hi"), "cell").where((F.col("b") != F.col("c")) & (gap("lo", "hi") <= F.col("tau"))).select("b", "c")
    work = pairs.join(first.select("b", "qids", "qx", "qt", "bound"), "b").join(blocks.select(F.col("b").alias("c"), "ids", "x", "t"), "c").drop("b", "c")

    def search(batches):
        for r in _one_by_one(batches):
            ids, x, t = _unpack(r, "", dim, n)
            qids, q, tq = _unpack(r, "q", dim, n)
            best = Best(qids, k, np.frombuffer(r["bound"], float))
            visit(best, q, tq, ids, x, t)
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in best.rows()], ["query_id", "neighbor_id", "distance"])

    def unpacked(batches):
        for r in _one_by_one(batches):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(r[c], t)) for c, t in (("fq", np.int64), ("fi", np.int64), ("fd", np.float64))], ["query_id", "neighbor_id", "distance"])

    triple = "query_id long, neighbor_id long, distance double"
    found = first.select("fq", "fi", "fd").mapInArrow(unpacked, triple).union(work.mapInArrow(search, triple))
    one = found.groupBy("query_id", "neighbor_id").agg(F.min("distance").alias("distance"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "neighbor_id"))
    out = one.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "neighbor_id", "distance", "rank").checkpoint()
    scratch.drop()
    return out

"""Line dedup: documents probe sharded minimal perfect hashes of all distinct lines.

A line counts when it has at least ``min_bytes`` bytes without the white space around it. A line
that other rows hold too stays in the document of least doc_id, at its first place there, and
goes from everywhere else; a line that one document repeats stays at its first place. Shorter
lines are left alone.

Nulls, ties, extremes: a null text stays null with no lines; an empty text is one short line. Rows
with a null doc_id keep repeated lines only if no other document holds them: they lose lines that
any document with an id holds, and among themselves the first place within each row counts. Rows
of one doc_id are one document to the counts; each keeps the lines it owns. An empty table gives
an empty result. Other columns, whatever their names, are passed on by the stage and never read.

Distinct lines are 64-bit hashes; every line of a document with an id is in the index, so its slot is
its own. The arrays keep 32 bits of another mix of the hash as fingerprint, which tells lines that are not in
the index: those of rows without an id alone, taken for an indexed one with chance 2**-32.

A task gathers the probes of many documents and goes through them shard by shard, so it loads a shard
once for them; shards loaded last are kept up to a bound and let go when the task ends.
"""

from __future__ import annotations

import io
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .spans import Packed, U, mix, slices, small
from .store import Scratch, text_batches

MIN_BYTES = 16
SHARD_KEYS = 1 << 18
#: Documents whose lines are probed together.
TOGETHER = 4096
_CACHE: OrderedDict[tuple[str, int], dict] = OrderedDict()
_CACHE_BYTES = 128 << 20


def _lines(texts: list, min_bytes: int):
    """Text index, hash and whether it counts, of every line."""
    p = Packed(texts, lower=False, words=False)
    s, e, doc = p.lines()
    solid = np.flatnonzero(~np.isin(p.buf, np.frombuffer(b" \t\r\x0b\x0c\n", np.uint8)))
    if len(solid):
        i, j = np.searchsorted(solid, s), np.searchsorted(solid, e) - 1
        blank = j < i
        ts = np.where(blank, s, solid[np.minimum(i, len(solid) - 1)])
        te = np.where(blank, s, solid[np.maximum(j, 0)] + 1)
    else:
        ts = te = s
    return doc, p.hash(ts, te), te - ts >= min_bytes


# minimal perfect hash


def build_mph(keys: np.ndarray) -> list[np.ndarray]:
    """Levels of bit arrays in which each key has one bit of its own; the bit's rank is the key's index."""
    levels, left, level = [], keys, 0
    while len(left):
        size = -(-len(left) * 2 // 64) * 64
        pos = (mix(left ^ U(level * 0x9E3779B9 + 1)) % U(size)).astype(np.int64)
        bits = np.bincount(pos, minlength=size) == 1
        levels.append(np.packbits(bits, bitorder="little"))
        left, level = left[~bits[pos]], level + 1
    return levels


class Mph:
    def __init__(self, levels: list[np.ndarray]):
        self.words = [x.view("<u8") for x in levels]
        self.rank, base = [], 0
        for w in self.words:
            upto = base + np.cumsum(np.bitwise_count(w), dtype=np.int64)
            self.rank.append(np.concatenate([[base], upto]))
            base = int(self.rank[-1][-1])

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The index of a key of the set, any index or -1 for other keys."""
        out, todo = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (w, rank) in enumerate(zip(self.words, self.rank)):
            if not len(todo):
                break
            pos = mix(keys[todo] ^ U(level * 0x9E3779B9 + 1)) % U(len(w) * 64)
            at, bit = (pos >> U(6)).astype(np.int64), U(1) << (pos & U(63))
            hit = (w[at] & bit) != 0
            at, bit = at[hit], bit[hit]
            out[todo[hit]] = rank[at] + np.bitwise_count(w[at] & (bit - U(1)))
            todo = todo[~hit]
        return out


def _fingerprint(h: np.ndarray) -> np.ndarray:
    return (mix(h ^ U(0xD6E8FEB86659FD93)) >> U(32)).astype(np.uint32)


def _shard_blob(h: np.ndarray, count: np.ndarray, owner: np.ndarray) -> bytes:
    levels = build_mph(h)
    at = Mph(levels).index(h)
    fp, cnt, own = np.empty(len(h), np.uint32), np.empty(len(h), np.uint32), np.empty(len(h), np.int64)
    fp[at], cnt[at], own[at] = _fingerprint(h), np.minimum(count, 2**32 - 1), owner
    out = io.BytesIO()
    np.savez(out, fp=fp, count=cnt, owner=own, **{f"level{i}": x for i, x in enumerate(levels)})
    return out.getvalue()


def _load(path: str, shard: int) -> dict | None:
    """A shard's arrays; the worker keeps those used last, up to a bound."""
    if (path, shard) in _CACHE:
        _CACHE.move_to_end((path, shard))
        return _CACHE[path, shard]
    import pyarrow.fs
    import pyarrow.parquet as pq

    fs, root = pyarrow.fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    folder = f"{root}/shard={shard}"
    found = [x.path for x in fs.get_file_info(pyarrow.fs.FileSelector(folder, allow_not_found=True)) if x.path.endswith(".parquet")]
    got: dict | None = None
    for f in found:
        for blob in pq.ParquetFile(fs.open_input_file(f)).read(["blob"]).column("blob").to_pylist():
            z = np.load(io.BytesIO(blob))
            got = {k: z[k] for k in ("fp", "count", "owner")} | {"mph": Mph([z[f"level{i}"] for i in range(len(z.files) - 3)]), "bytes": 2 * len(blob)}
    _CACHE[path, shard] = got or {"bytes": 0}
    while sum(x["bytes"] for x in _CACHE.values()) > _CACHE_BYTES and len(_CACHE) > 1:
        _CACHE.popitem(last=False)
    return got


def build_arrays(docs: DataFrame, min_bytes: int = MIN_BYTES, shard_keys: int = SHARD_KEYS) -> tuple[str, int]:
    """Count every distinct line's documents over the whole table and write the arrays; their path, and the bits of a hash that name its shard."""

    def emit(batches):
        for b in small(batches, 1024):
            ids, texts = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_pylist()
            for x, y in slices(texts):
                doc, h, ok = _lines(texts[x:y], min_bytes)
                doc, h = doc[ok], h[ok]
                order = np.lexsort((doc, h))
                doc, h = doc[order], h[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(h[new].view(np.int64)), pa.array(ids[x:y][doc[new]].astype(np.int64))], ["h", "d"])

    spark = docs.sparkSession
    scratch = Scratch(spark)
    of = text_batches(docs).where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = of.mapInArrow(emit, "h long, d long").groupBy("h").agg(F.count("*").alias("n"), F.min("d").alias("owner"))
    counts = scratch.keep(counts, "counts")
    n = counts.count()
    bits = max(0, (max(n, 1) - 1).bit_length() - (shard_keys.bit_length() - 1))

    def shard(key, t):
        h, c, o = (t.column(k).to_numpy() for k in ("h", "n", "owner"))
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "blob": pa.array([_shard_blob(h.view(U), c, o)], pa.binary())})

    of_shard = F.lit(0) if bits == 0 else F.expr(f"shiftrightunsigned(h, {64 - bits})")
    counts.withColumn("shard", of_shard.cast("int")).groupBy("shard").applyInArrow(shard, "shard int, blob binary").write.partitionBy("shard").parquet(scratch.path("arrays"))
    scratch.drop("counts")
    return scratch.path("arrays"), bits


def _prober(path: str, bits: int, min_bytes: int):
    def probe(ids: np.ndarray, null_id: np.ndarray, texts: list):
        """Which lines stay; also each line's text index."""
        parts = []
        for x, y in slices(texts):
            doc, h, ok = _lines(texts[x:y], min_bytes)
            parts.append((doc + x, h, ok))
        doc, h, ok = (np.concatenate([p[k] for p in parts]) for k in range(3))
        gone = np.zeros(len(h), bool)
        at = np.flatnonzero(ok)
        shard = (h[at] >> U(64 - bits)).astype(np.int64) if bits else np.zeros(len(at), np.int64)
        order = np.argsort(shard, kind="stable")
        at, shard = at[order], shard[order]
        cut = np.flatnonzero(np.diff(shard, prepend=-1))
        for x, y in zip(cut, np.append(cut[1:], len(at))):
            arrays = _load(path, int(shard[x]))
            if not arrays or "mph" not in arrays:
                continue
            here = at[x:y]
            i = arrays["mph"].index(h[here])
            hit = i >= 0
            hit[hit] = arrays["fp"][i[hit]] == _fingerprint(h[here][hit])
            here, i = here[hit], i[hit]
            d = doc[here]
            gone[here] = ((arrays["count"][i] >= 2) & (arrays["owner"][i] != ids[d])) | null_id[d]
        order = at[np.lexsort((at, h[at], doc[at]))]
        again = order[1:][(h[order[1:]] == h[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])]
        gone[again] = True
        return doc, gone

    return probe


def _cleaned(probe, ids, null_id, texts):
    """New texts, numbers of lines, numbers of dropped lines; rows come as they are."""
    out, n = list(texts), len(texts)
    doc, gone = probe(ids, null_id, texts)
    lines, dropped = np.bincount(doc, minlength=n), np.bincount(doc[gone], minlength=n)
    first = np.searchsorted(doc, np.arange(n))
    for k in np.flatnonzero(dropped):
        ls = texts[k].split("\n")
        g = gone[first[k] : first[k] + len(ls)]
        out[k] = "\n".join(t for t, dead in zip(ls, g) if not dead)
    for k, t in enumerate(texts):
        if t is None:
            lines[k] = dropped[k] = 0
    return out, lines, dropped


def _ids(column) -> tuple[np.ndarray, np.ndarray]:
    null = np.asarray(column.is_null())
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), null


def dedup_lines(docs: DataFrame, min_bytes: int = MIN_BYTES, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """One row per input row: doc_id, text (repeated lines removed), n_lines, n_dropped."""
    path, bits = build_arrays(docs, min_bytes, shard_keys)
    probe = _prober(path, bits, min_bytes)

    def clean(batches):
        for b in small(batches, TOGETHER):
            ids, null = _ids(b.column(0))
            text, lines, dropped = _cleaned(probe, ids, null, b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(text, pa.string()), pa.array(lines), pa.array(dropped)], ["doc_id", "text", "n_lines", "n_dropped"])
        _CACHE.clear()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(clean, "doc_id long, text string, n_lines long, n_dropped long")


def line_dedup_stage(docs: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``docs`` with repeated lines removed and n_chars, if there, set again; documents that lose their last solid line go."""
    path, bits = build_arrays(docs, min_bytes)
    probe, names = _prober(path, bits, min_bytes), docs.columns

    def clean(batches):
        for b in small(batches, TOGETHER):
            ids, null = _ids(b.column(names.index("doc_id")))
            before = b.column(names.index("text")).to_pylist()
            text, _, dropped = _cleaned(probe, ids, null, before)
            arrays = list(b.columns)
            arrays[names.index("text")] = pa.array(text, b.schema.field("text").type)
            if "n_chars" in names and pa.types.is_integer(b.schema.field("n_chars").type):
                size = [None if t is None else len(t) for t in text]
                old = arrays[names.index("n_chars")].to_pylist()
                arrays[names.index("n_chars")] = pa.array([s if d else o for s, d, o in zip(size, dropped, old)], b.schema.field("n_chars").type)
            keep = [not d or bool(t.strip()) for t, d in zip(text, dropped)]
            yield pa.RecordBatch.from_arrays(arrays, schema=b.schema).filter(pa.array(keep))
        _CACHE.clear()

    return docs.mapInArrow(clean, docs.schema)

"""Hashes of words, lines and character n-grams over packed UTF-8 buffers, without a Python loop per token.

A buffer's prefix sums of ``T[byte] * M**i`` (mod 2**64) give the hash of any span by one
subtraction and one multiplication with the inverse power, whatever the number of spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_M = 0x9E3779B97F4A7C15
_INV = pow(_M, -1, 1 << 64)
_T = np.random.default_rng(20240101).integers(1, 1 << 63, 256, dtype=np.int64).astype(U) * U(2) + U(1)
_WORD = np.zeros(256, bool)
_WORD[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")] = True
_WORD[128:] = True
_POW: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]

CHUNK = 1 << 19
#: Rows of an Arrow batch that are turned into Python objects at a time.
ROWS = 256


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW[0]) < n:
        for k, base in enumerate((_M, _INV)):
            p = np.full(max(n, CHUNK * 2), U(base), U)
            p[0] = 1
            _POW[k] = np.cumprod(p, dtype=U)
    return _POW[0][:n], _POW[1][:n]


def slices(texts: list, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` characters; a longer text is a range of its own."""
    a = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if size and size + n > limit:
            yield a, i
            a, size = i, 0
        size += n + 1
    if a < len(texts):
        yield a, len(texts)


def small(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in slices of few rows, which share their buffers; empty ones are left out."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


class Packed:
    """Texts in one buffer, each after a newline byte; a null text is as empty. ``words`` turns separators into spaces."""

    def __init__(self, texts: list, lower: bool = True, words: bool = True):
        parts = [(t.lower() if lower else t).encode("utf-8", "replace") if t else b"" for t in texts]
        lens = np.fromiter(map(len, parts), np.int64, len(parts))
        self.at = np.concatenate([[1], 1 + np.cumsum(lens + 1)])
        self.buf = np.frombuffer(b"\n" + b"\n".join(parts) + b"\n", np.uint8)
        self.n = len(texts)
        self._sum: np.ndarray | None = None
        if words:
            self.is_word = _WORD[self.buf]
            self.buf = np.where(self.is_word, self.buf, np.uint8(32))

    def doc_of(self, pos: np.ndarray) -> np.ndarray:
        """Index of the text that a position lies in."""
        return np.repeat(np.arange(self.n), np.diff(np.searchsorted(pos, self.at)))

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and text index of the words: runs of ASCII letters, digits and all non-ASCII bytes."""
        edge = np.flatnonzero(self.is_word[1:] != self.is_word[:-1]) + 1
        s, e = edge[::2], edge[1::2]
        return s, e, self.doc_of(s)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and text index of the newline-separated lines; an empty text has one empty line."""
        cut = np.flatnonzero(self.buf == 10)
        s, e = cut[:-1] + 1, cut[1:]
        return s, e, self.doc_of(s)

    def hash(self, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        if self._sum is None:
            p, _ = _powers(len(self.buf) + 1)
            self._sum = np.zeros(len(self.buf) + 1, U)
            np.cumsum(_T[self.buf] * p[:-1], out=self._sum[1:])
        _, inv = _powers(len(self.buf) + 1)
        return mix((self._sum[e] - self._sum[s]) * inv[s] + (e - s).astype(U))

    def points(self) -> np.ndarray:
        """Positions at which characters start, and the end of the buffer."""
        return np.append(np.flatnonzero((self.buf & 0xC0) != 0x80), len(self.buf))


def shingles(h: np.ndarray, doc: np.ndarray, n_docs: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` successive words within a text; a text of fewer words has one shingle of them all."""
    count = np.bincount(doc, minlength=n_docs)
    if len(h) == 0:
        return h, doc
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    left = (first + count)[doc] - np.arange(len(h))
    g = h.copy()
    for k in range(1, width):
        more = left > k
        nxt = np.zeros_like(h)
        nxt[: len(h) - k] = h[k:]
        g = np.where(more, mix(g * U(0x100000001B3) + nxt), g)
    keep = (left >= width) | ((count[doc] < width) & (np.arange(len(h)) == first[doc]))
    return g[keep], doc[keep]


class Table:
    """Open-addressing table from distinct 64-bit keys to their positions; ``find`` gives -1 for others."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys.astype(U)
        self.bits = max(4, int(len(keys) * 4).bit_length())
        self.slot = np.full(1 << self.bits, -1, np.int32)
        todo, r, mask = np.arange(len(keys)), 0, (1 << self.bits) - 1
        while len(todo):
            pos = (self.keys[todo].astype(np.int64) + r) & mask
            free = self.slot[pos] < 0
            first = np.zeros(len(todo), bool)
            _, i = np.unique(np.where(free, pos, -1 - np.arange(len(todo))), return_index=True)
            first[i] = True
            won = free & first
            self.slot[pos[won]] = todo[won]
            todo, r = todo[~won], r + 1
        self.probes = r

    def find(self, q: np.ndarray) -> np.ndarray:
        out = np.full(len(q), -1, np.int64)
        if not len(self.keys) or not len(q):
            return out
        mask = (1 << self.bits) - 1
        base, todo = q.astype(np.int64), np.arange(len(q))
        for r in range(self.probes):
            slot = self.slot[(base[todo] + r) & mask]
            used = slot >= 0
            todo, slot = todo[used], slot[used]
            hit = self.keys[slot] == q[todo]
            out[todo[hit]] = slot[hit]
            todo = todo[~hit]
            if not len(todo):
                break
        return out


def ragged(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of the given sizes: each element's group, and its place within it."""
    group = np.repeat(np.arange(len(counts)), counts)
    return group, np.arange(len(group)) - np.repeat(np.cumsum(counts) - counts, counts)

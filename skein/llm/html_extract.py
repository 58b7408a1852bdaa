"""HTML extraction: a bidirectional LSTM in numpy labels every block of a page as content or not.

A page is cut at block-level tags into leaf blocks of text; scripts, styles, comments and the head
are left out. A block is read as the sum of fixed random vectors of the tags (and classes) on its
path, the mean of vectors of its hashed words, and a few numbers; the LSTM reads the page's blocks
in both directions and a logistic layer labels each.

Training is on a bounded sample of the pages themselves: blocks below ``article`` or ``main`` are
content, others not; on pages with neither there is nothing to learn. In every other training
page the names of such containers are hidden, so that context has to decide there too.

Nulls, ties, extremes: null or empty html, or html without text, has no blocks and empty text; a
null page_id is passed on; unclosed and stray tags are allowed; pages of any length are read
whole; equal pages get equal results; without a page to train on all blocks are content. An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import html as _html
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .spans import small
from .store import text_batches

#: Bound on the pages fitted on (those of least hashed page_id).
TRAIN_PAGES = 400
#: Blocks, padding included, that are labelled or trained on at a time; a longer page is a group of its own.
CELLS = 1 << 15
TAG_DIM, WORD_DIM, HIDDEN, EPOCHS, BATCH = 16, 16, 16, 8, 32
DIM = TAG_DIM + WORD_DIM + 5

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<(script|style|head|noscript|template|svg)\b[^>]*>.*?(?:</\1\s*>|$)|<(/?)([a-zA-Z][a-zA-Z0-9]*)([^>]*)>|<[!?][^>]*>", re.S | re.I)
_INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i img input ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SELF_CLOSING = {"p": "p", "li": "li", "td": "td", "tr": "tr", "dt": "dd", "dd": "dt", "option": "option"}
_ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
_CLASS = re.compile(r"""\b(?:class|id)\s*=\s*["']?([^"'>]*)""", re.I)
_CONTENT = ("article", "main")


def blocks(page: str | None) -> list[tuple[tuple[str, ...], bool, str]]:
    """(tag path, whether all its text is linked, text) of each leaf block in order."""
    out: list = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    text: list[str] = []
    linked, path = 0, ()

    def flush():
        nonlocal linked
        if text:
            joined = " ".join(_html.unescape("".join(text)).split())
            if joined:
                out.append((path, linked > 0, joined))
            text.clear()
        linked = 0

    at = in_link = 0
    for m in _TOKEN.finditer(page or ""):
        if m.start() > at:
            if not text:
                path = tuple(x for _, names in stack for x in names)
            piece = page[at : m.start()]
            text.append(piece)
            if piece.strip():
                linked = linked + 1 if in_link and linked >= 0 else -1
        at = m.end()
        tag = (m.group(3) or "").lower()
        if not tag:
            continue
        if tag == "a":
            in_link = 0 if m.group(2) else 1
        if tag in _INLINE:
            continue
        flush()
        if m.group(2):
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
        elif tag not in _VOID and not m.group(4).endswith("/"):
            if stack and (_SELF_CLOSING.get(stack[-1][0]) == tag or (stack[-1][0] == tag and tag in _SELF_CLOSING) or (stack[-1][0] == "p" and tag in _ENDS_P)):
                stack.pop()
            found = _CLASS.findall(m.group(4)) if m.group(4) else []
            stack.append((tag, (tag, *(f".{c.lower()}" for f in found for c in f.split()))))
    if page and at < len(page):
        if not text:
            path = tuple(x for _, names in stack for x in names)
        text.append(page[at:])
    flush()
    return out


_VEC: dict[str, np.ndarray] = {}
_WORDS = np.random.default_rng(11).standard_normal((4096, WORD_DIM)).astype(np.float32)


def _tag(name: str) -> np.ndarray:
    if name not in _VEC:
        if len(_VEC) > 50_000:
            _VEC.clear()
        _VEC[name] = np.random.default_rng(zlib.crc32(name.encode("utf-8", "replace"))).standard_normal(TAG_DIM).astype(np.float32)
    return _VEC[name]


def vectors(found: list, hide: bool = False) -> np.ndarray:
    out = np.zeros((len(found), DIM), np.float32)
    for k, (path, linked, text) in enumerate(found):
        for name in path:
            if not (hide and name in _CONTENT):
                out[k, :TAG_DIM] += _tag(name)
        words = text.split()
        at = np.fromiter((zlib.crc32(w.encode("utf-8", "replace")) & 4095 for w in words), np.int64, len(words))
        out[k, TAG_DIM : TAG_DIM + WORD_DIM] = _WORDS[at].mean(0) if len(at) else 0
        out[k, -5:] = (np.log1p(len(words)) / 4, np.log1p(len(text)) / 6, linked, len(path) / 8, sum(text.count(c) for c in ".!?,") / (len(words) + 1))
    return out


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


class Lstm:
    """One direction; columns of the weights are input, forget, cell and output gates."""

    def __init__(self, rng: np.random.Generator):
        self.w = (rng.standard_normal((DIM + HIDDEN, 4 * HIDDEN)) / np.sqrt(DIM + HIDDEN)).astype(np.float32)
        self.b = np.zeros(4 * HIDDEN, np.float32)
        self.b[HIDDEN : 2 * HIDDEN] = 1

    def forward(self, x: np.ndarray, mask: np.ndarray, tape: list | None = None) -> np.ndarray:
        n, t, _ = x.shape
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out = np.zeros((n, t, HIDDEN), np.float32)
        xw = x @ self.w[:DIM] + self.b
        for k in range(t):
            z = xw[:, k] + h @ self.w[DIM:]
            s = _sigmoid(z)
            i, f, o = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 3 * HIDDEN :]
            g = np.tanh(z[:, 2 * HIDDEN : 3 * HIDDEN])
            m = mask[:, k, None]
            c2 = f * c + i * g
            tc = np.tanh(c2)
            if tape is not None:
                tape.append((h, c, i, f, g, o, tc, m))
            c, h = np.where(m, c2, c), np.where(m, o * tc, h)
            out[:, k] = h
        return out

    def backward(self, x: np.ndarray, tape: list, d_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        dw, db = np.zeros_like(self.w), np.zeros_like(self.b)
        dh, dc = np.zeros_like(d_out[:, 0]), np.zeros_like(d_out[:, 0])
        for k in range(len(tape) - 1, -1, -1):
            h, c, i, f, g, o, tc, m = tape[k]
            dh = dh + d_out[:, k]
            dhm, dcm = np.where(m, dh, 0), np.where(m, dc, 0)
            d = dcm + dhm * o * (1 - tc * tc)
            dz = np.concatenate([d * g * i * (1 - i), d * c * f * (1 - f), d * i * (1 - g * g), dhm * tc * o * (1 - o)], 1)
            dw[:DIM] += x[:, k].T @ dz
            dw[DIM:] += h.T @ dz
            db += dz.sum(0)
            dh = np.where(m, dz @ self.w[DIM:].T, dh)
            dc = np.where(m, d * f, dc)
        return dw, db


class Model:
    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.a, self.b = Lstm(rng), Lstm(rng)
        self.out = np.zeros((2 * HIDDEN, 1), np.float32)
        self.bias = np.zeros(1, np.float32)
        self.trained = False

    @staticmethod
    def pad(seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        t = max(map(len, seqs))
        x, mask = np.zeros((len(seqs), t, DIM), np.float32), np.zeros((len(seqs), t), bool)
        for k, s in enumerate(seqs):
            x[k, : len(s)], mask[k, : len(s)] = s, True
        return x, mask

    def probabilities(self, x: np.ndarray, mask: np.ndarray, tape: tuple[list, list] | None = None):
        ta, tb = tape or (None, None)
        ha = self.a.forward(x, mask, ta)
        hb = self.b.forward(x[:, ::-1], mask[:, ::-1], tb)[:, ::-1]
        h = np.concatenate([ha, hb], 2)
        return _sigmoid((h @ self.out)[:, :, 0] + self.bias), h

    def train(self, seqs: list[np.ndarray], labels: list[np.ndarray], epochs: int = EPOCHS) -> None:
        rng = np.random.default_rng(9)
        params = [self.a.w, self.a.b, self.b.w, self.b.b, self.out, self.bias]
        m1, m2, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        size = np.array([len(s) for s in seqs])
        for _ in range(epochs):
            order = np.argsort(size + rng.random(len(size)) * 8, kind="stable")
            groups = list(grouped(order, size, BATCH))
            for k in rng.permutation(len(groups)):
                x, mask = self.pad([seqs[i] for i in groups[k]])
                y = np.zeros(mask.shape, np.float32)
                for r, i in enumerate(groups[k]):
                    y[r, : size[i]] = labels[i]
                tape: tuple[list, list] = ([], [])
                p, h = self.probabilities(x, mask, tape)
                d = np.where(mask, p - y, 0).astype(np.float32) / mask.sum()
                dh = d[:, :, None] * self.out[:, 0]
                ga = self.a.backward(x, tape[0], dh[:, :, :HIDDEN])
                gb = self.b.backward(x[:, ::-1], tape[1], dh[:, ::-1, HIDDEN:])
                grads = [*ga, *gb, np.einsum("nth,nt->h", h, d)[:, None], np.array([d.sum()], np.float32)]
                norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
                step += 1
                for q, g, a, b in zip(params, grads, m1, m2):
                    g = g / max(norm, 1.0)
                    a += 0.1 * (g - a)
                    b += 0.01 * (g * g - b)
                    q -= 0.02 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
        self.trained = True

    def label(self, seqs: list[np.ndarray]) -> list[np.ndarray]:
        if not self.trained:
            return [np.ones(len(s), bool) for s in seqs]
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(seqs)
        size = np.array([len(s) for s in seqs], np.int64)
        for group in grouped([i for i in np.argsort(size, kind="stable") if size[i]], size, 64):
            p, _ = self.probabilities(*self.pad([seqs[i] for i in group]))
            for r, i in enumerate(group):
                out[i] = p[r, : len(seqs[i])] >= 0.5
        return out


def grouped(order, size: np.ndarray, most: int):
    """Groups of up to ``most`` successive pages, ordered by size, of ``CELLS`` blocks at most as padded."""
    group: list[int] = []
    longest = 0
    for i in order:
        longest = max(longest, int(size[i]))
        if group and (len(group) == most or longest * (len(group) + 1) > CELLS):
            yield group
            group, longest = [], int(size[i])
        group.append(int(i))
    if group:
        yield group


def train(pages: list[str]) -> Model:
    seqs, labels = [], []
    for page in pages:
        found = blocks(page)
        y = np.array([any(c in path for c in _CONTENT) for path, _, _ in found], np.float32)
        if len(found) and y.any():
            seqs.append(vectors(found, hide=len(seqs) % 2 == 1))
            labels.append(y)
    model = Model()
    if seqs:
        model.train(seqs, labels)
    return model


def fit(pages: DataFrame, rows: int = TRAIN_PAGES) -> Model:
    ids = pages.where("html is not null and page_id is not null").select(F.col("page_id").alias("__i")).distinct().orderBy(F.xxhash64("__i"), "__i").limit(rows)
    got = pages.where("html is not null").select("page_id", "html").join(F.broadcast(ids), F.col("page_id") == F.col("__i"), "left_semi").toPandas()
    return train(got.sort_values(["page_id", "html"], kind="stable")["html"].tolist())


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per page: page_id, text (content blocks by line), n_blocks, n_content."""
    model = model or fit(pages)

    def run(batches):
        for b in batches:
            for part in small([b]):
                found = [blocks(h) for h in part.column(1).to_pylist()]
                kept = model.label([vectors(f) for f in found])
                text = ["\n".join(t for (_, _, t), k in zip(f, ks) if k) for f, ks in zip(found, kept)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(text, pa.string()), pa.array([len(f) for f in found], pa.int32()), pa.array([int(k.sum()) for k in kept], pa.int32())],
                    ["page_id", "text", "n_blocks", "n_content"],
                )

    return text_batches(pages).select(F.col("page_id").cast("long").alias("page_id"), "html").mapInArrow(run, "page_id long, text string, n_blocks int, n_content int")

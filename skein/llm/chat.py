"""Chat formatting through a black-box template, with each turn's span.

A template is any function from a list of (role, text) turns to a string. It is rendered for
every prefix of a conversation; where the output for k turns starts with the output for k - 1,
turn k's span is what was added. A template that changes what it said before rewrites history: the
first turn at which that happens is reported, and spans are set again from the whole rendering:
for each turn, what its prefix's output still has in common with the next one's, and a turn whose
part has gone has none.

Nulls, ties, extremes: turns are ordered by turn, then role, then text, nulls first; repeated rows
are kept as turns of their own; a null role or text is rendered as empty; a row with a null conv_id
is a conversation of one turn; a template that cannot render a conversation of no turns gives nothing for it, so that
what it puts in front belongs to the first turn; an empty table gives an empty result. Other columns are not read. Positions
count characters (code points) from 0, ends excluded.
"""

from __future__ import annotations

import os
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .spans import small
from .store import text_batches

Template = Callable[[list[tuple[str, str]]], str]


def chatml(turns: list[tuple[str, str]]) -> str:
    return "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in turns)


def _opening(template: Template) -> str:
    """What the template says before any turn."""
    try:
        return template([])
    except Exception:  # noqa: BLE001  a black box may refuse an empty conversation in any way
        return ""


def render(turns: list[tuple[str, str]], template: Template) -> tuple[str, list[tuple[int, int] | None], int | None]:
    """The whole rendering, each turn's span in it, and the first turn that rewrote history."""
    spans: list[tuple[int, int] | None] = []
    before, rewrote = _opening(template), None
    for k in range(len(turns)):
        now = template(turns[: k + 1])
        if now.startswith(before):
            spans.append((len(before), len(now)))
        else:
            rewrote = k if rewrote is None else rewrote
            same = len(os.path.commonprefix([before, now]))
            tail = len(os.path.commonprefix([before[same:][::-1], now[same:][::-1]]))
            moved = len(now) - len(before)
            kept: list[tuple[int, int] | None] = []
            for s in spans:
                if s is None or s[1] <= same:
                    kept.append(s)
                elif s[0] >= len(before) - tail and tail:
                    kept.append((s[0] + moved, s[1] + moved))
                else:
                    kept.append((s[0], same) if s[0] < same else None)
            spans = kept
            start = max([same, *(s[1] for s in spans if s)])
            spans.append((start, len(now)))
        before = now
    return before, spans, rewrote


SCHEMA = "conv_id long, n_turns int, text string, spans array<struct<turn: long, role: string, start: int, stop: int>>, rewrites_at int"
_SPANS = pa.list_(pa.struct([("turn", pa.int64()), ("role", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))


def format_chats(conversations: DataFrame, template: Template = chatml) -> DataFrame:
    """One row per conversation: conv_id, n_turns, text, spans (in turn order; start and stop null where the
    turn's part is gone), rewrites_at (place of the first turn that rewrote history, else null)."""
    turns = text_batches(conversations).select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").cast("long").alias("turn"), "role", "text").alias("t"))
    lists = turns.where("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    lists = lists.union(turns.where("conv_id is null").select("conv_id", F.array("t").alias("ts")))

    def run(batches):
        for b in small(batches):
            texts, spans, rewrites, sizes = [], [], [], []
            for ts in b.column(1).to_pylist():
                text, at, rewrote = render([(t["role"] or "", t["text"] or "") for t in ts], template)
                texts.append(text)
                spans.append([{"turn": t["turn"], "role": t["role"], "start": s[0] if s else None, "stop": s[1] if s else None} for t, s in zip(ts, at)])
                rewrites.append(rewrote)
                sizes.append(len(ts))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int32()), pa.array(texts, pa.string()), pa.array(spans, _SPANS), pa.array(rewrites, pa.int32())], ["conv_id", "n_turns", "text", "spans", "rewrites_at"])

    return lists.mapInArrow(run, SCHEMA)


def flat(chats: DataFrame) -> DataFrame:
    """One row per turn of ``format_chats``."""
    return chats.select("conv_id", "n_turns", "text", "rewrites_at", F.explode("spans").alias("s")).select("conv_id", "n_turns", "text", "s.turn", "s.role", "s.start", "s.stop", "rewrites_at")

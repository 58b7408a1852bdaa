"""Dictionary matching: bounded, longest first, case aside, not overlapping, false positives suppressed.

``hits`` finds the terms of many groups in one pass over a text; ``matches`` is native, for a few terms;
``term_spans`` gives offsets.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, functions as F

from ..schema import SIGNAL
from .text import escape

BARRIER = "\u0001"


def ordered(terms) -> list[str]:
    return sorted({" ".join(t.lower().split()) for t in terms if t and t.strip()}, key=lambda t: (-len(t), t))


def alternation(terms) -> str:
    return "|".join(map(escape, ordered(terms)))


def suppressed(c: Column, false_positives) -> Column:
    """The text with its false-positive phrases taken out, so that no term can overlap one."""
    return F.regexp_replace(c, f"(?iU)(?<!\\w)(?:{alternation(false_positives)})(?!\\w)", BARRIER) if list(false_positives) else c


def matches(c: Column, terms, false_positives=()) -> Column:
    """Terms found, in lower case and in order of place, repeats included; empty for null."""
    terms = list(terms)
    if not terms:
        return F.array().cast("array<string>")
    text = suppressed(F.coalesce(c, F.lit("")), false_positives)
    found = F.regexp_extract_all(text, F.lit(f"(?iU)(?<!\\w)(?:{alternation(terms)})(?!\\w)"), F.lit(0))
    return F.transform(found, lambda x: F.lower(x))


def distinct_matches(c: Column, terms, false_positives=()) -> Column:
    return F.array_distinct(matches(c, terms, false_positives))


def starts_with_term(c: Column, terms) -> Column:
    return F.coalesce(c.rlike(f"(?iU)^\\s*(?:{alternation(terms)})(?!\\w)"), F.lit(False)) if list(terms) else F.lit(False)


def lookup(found: Column, weights: dict[str, float]) -> Column:
    """The terms' weights."""
    table = F.create_map(*[F.lit(x) for k, v in weights.items() for x in (k.lower(), float(v))])
    return F.transform(found, lambda x: F.coalesce(table[x], F.lit(0.0)))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def is_word(c: str) -> bool:
    return c.isalnum() or c == "_"


class Group(NamedTuple):
    """Terms that are looked for together. One alternation, longest first and not overlapping; or, where
    ``apart``, each term by itself wherever it stands, with ``stems`` also under a common ending."""

    name: str
    terms: tuple[str, ...]
    apart: bool = False
    stems: bool = False
    #: Name of the phrases that suppress what overlaps them.
    under: str = ""


ENDINGS = ("", "s", "es", "ed", "ing", "d")


class Matcher:
    """All groups' terms in one automaton, so a text is read once however many terms there are."""

    def __init__(self, groups: Iterable[Group], false_positives: dict[str, Iterable[str]] | None = None):
        self.groups = [g._replace(terms=tuple(ordered(g.terms))) for g in groups]
        self.bad = {k: tuple(ordered(v)) for k, v in (false_positives or {}).items()}
        self._automaton = None

    def __reduce__(self):
        return Matcher, (self.groups, self.bad)

    def _build(self):
        import ahocorasick

        of: dict[str, list] = {}
        for k, g in enumerate(self.groups):
            for t in g.terms:
                of.setdefault(t, []).append(k)
        for name, phrases in self.bad.items():
            for t in phrases:
                of.setdefault(t, []).append(name)
        self._automaton = ahocorasick.Automaton()
        for t, owners in of.items():
            self._automaton.add_word(t, (len(t), owners))
        if of:
            self._automaton.make_automaton()
        self._any = bool(of)

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(group, start, end) in the lower-case text; within a group by place."""
        if self._automaton is None:
            self._build()
        if not self._any or not text:
            return []
        n = len(text)
        found: list[list[tuple[int, int]]] = [[] for _ in self.groups]
        bad: dict[str, list[tuple[int, int]]] = {}
        for last, (size, owners) in self._automaton.iter(text):
            start, end = last - size + 1, last + 1
            if start and is_word(text[start - 1]):
                continue
            whole = end == n or not is_word(text[end])
            for o in owners:
                if isinstance(o, str):
                    if whole:
                        bad.setdefault(o, []).append((start, end))
                elif whole or (self.groups[o].stems and _ending(text, end)):
                    found[o].append((start, end))
        out = []
        for k, (g, hits) in enumerate(zip(self.groups, found)):
            if not hits:
                continue
            stop = bad.get(g.under, ()) if g.under else ()
            if not g.apart:
                hits.sort(key=lambda x: (x[0], -x[1]))
            at = 0
            for s, e in hits:
                if not g.apart:
                    if s < at:
                        continue
                    at = e
                if not any(s < y and x < e for x, y in stop):
                    out.append((k, s, e))
        return out

    def terms(self, text: str | None, location: str) -> dict[str, list[str]]:
        """``group/location``: the distinct terms in order of place; ``group^location`` if the text starts with one."""
        low = (text or "").lower()
        first = len(low) - len(low.lstrip())
        out: dict[str, list[str]] = {}
        for k, s, e in self.spans(low):
            name = self.groups[k].name
            term = low[s:e]
            have = out.setdefault(f"{name}/{location}", [])
            if term not in have:
                have.append(term)
            if s == first:
                out.setdefault(f"{name}^{location}", [term])
        return out


def _ending(text: str, at: int) -> bool:
    """Whether the word goes on from there with one of the endings and no more."""
    stop = at
    while stop < len(text) and stop - at <= 3 and is_word(text[stop]):
        stop += 1
    return text[at:stop] in ENDINGS


HITS = "map<string, array<string>>"


def hits(matcher: Matcher, *columns: str) -> Column:
    """One Arrow pass over the columns: every group's terms in each of them. Not computed twice, whatever reads it."""

    @F.pandas_udf(HITS)
    def run(*texts: pd.Series) -> pd.Series:
        return pd.Series([{k: v for c, t in zip(columns, row) for k, v in matcher.terms(t, c).items()} for row in zip(*texts)])

    return run.asNondeterministic()(*columns)


def of_group(column: str, name: str, location: str) -> Column:
    """The terms of a group in a location, from ``hits``."""
    return F.coalesce(F.try_element_at(column, F.lit(f"{name}/{location}")), F.array().cast("array<string>"))


def find_spans(text: str, groups: dict[str, list[str]], false_positives=(), location: str = "title") -> list[dict]:
    """Every hit with its place; what ``term_spans`` runs."""
    m = Matcher([Group(k, tuple(v), under="bad") for k, v in groups.items()], {"bad": false_positives})
    low = text.lower()
    return [{"grp": m.groups[k].name, "term": low[s:e], "location": location, "start": s, "stop": e} for k, s, e in m.spans(low)]


def term_spans(groups: dict[str, list[str]], false_positives=()):
    """Arrow UDF of (title, summary): every hit with its place."""
    false_positives = list(false_positives)

    @F.pandas_udf(SIGNAL)
    def spans(title: pd.Series, summary: pd.Series) -> pd.Series:
        return pd.Series([find_spans(t or "", groups, false_positives, "title") + find_spans(s or "", groups, false_positives, "summary") for t, s in zip(title, summary)])

    return spans

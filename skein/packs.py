"""Rule packs: term lists and weights, loaded from JSON or given as dictionaries, and validated whole."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

STRONG = ("core", "institution", "figure", "company", "significance", "specific_intl")


@dataclass
class Category:
    id: str
    terms: list[str]
    importance: float = 1.0
    urgent: bool = False
    label: str = ""


@dataclass
class Gate:
    id: str
    terms: list[str]
    weight: float
    override: str = "any"
    title_only: bool = False


@dataclass
class Pack:
    """Everything that the row stages look up. Every list may be empty."""

    relevance: dict[str, list[str]] = field(default_factory=dict)
    relevance_weights: dict[str, float] = field(default_factory=dict)
    false_positives: list[str] = field(default_factory=list)
    geo_false_positives: list[str] = field(default_factory=list)
    union_territories: list[str] = field(default_factory=list)
    categories: list[Category] = field(default_factory=list)
    generic_words: list[str] = field(default_factory=list)
    states: dict[str, list[str]] = field(default_factory=dict)
    cities: dict[str, str] = field(default_factory=dict)
    national_terms: list[str] = field(default_factory=list)
    significance_events: list[str] = field(default_factory=list)
    gates: list[Gate] = field(default_factory=list)
    weak_terms: dict[str, float] = field(default_factory=dict)
    major_markers: list[str] = field(default_factory=list)
    event_weights: dict[str, float] = field(default_factory=dict)
    entities: dict[str, str] = field(default_factory=dict)
    stopwords: list[str] = field(default_factory=list)
    actions: dict[str, str] = field(default_factory=dict)
    wires: dict[str, list[str]] = field(default_factory=dict)
    units: list[str] = field(default_factory=list)

    def problems(self) -> list[str]:
        """All that is wrong with the pack, in order of path."""
        out = []
        if len({c.id for c in self.categories}) < len(self.categories):
            out.append("categories: repeated id")
        for c in self.categories:
            if not 0 < c.importance <= 5:
                out.append(f"categories.{c.id}.importance: {c.importance} is not in (0, 5]")
            if not c.terms:
                out.append(f"categories.{c.id}.terms: empty")
        for g in self.gates:
            if g.override not in ("any", "strong", "none"):
                out.append(f"gates.{g.id}.override: {g.override!r}")
            if g.weight < 0:
                out.append(f"gates.{g.id}.weight: negative")
        out += [f"cities.{c}: no state {s!r}" for c, s in self.cities.items() if s not in self.states]
        out += [f"relevance_weights.{k}: no such group" for k in self.relevance_weights if k not in self.relevance]
        return sorted(out)


def relevance_groups(core=(), institutions=(), figures=(), companies=(), places=(), context=(), markers=(), home=(), not_core=(), weak=("national",)) -> dict[str, list[str]]:
    """Groups of relevance terms that share none where it matters. Context terms that name the home country, or hold one of its
    names, are specific; the others are general. Markers are significant only if no other group has them, weak ones never."""
    terms = lambda *lists: {" ".join(t.lower().split()) for ts in lists for t in ts if t and t.strip()}
    names = terms(home)
    own = (terms(core) - terms(not_core)) | names
    around = terms(context)
    specific = {t for t in around if any(n in t for n in names)}
    inst, fig = terms(institutions), terms(figures)
    out = {"core": own, "institution": inst, "figure": fig, "company": terms(companies), "geo": terms(places), "significance": terms(markers) - inst - fig - around - terms(weak), "specific_intl": specific, "intl": around - specific}
    return {k: sorted(v) for k, v in out.items() if v}


def deep_merge(base: dict, over: dict) -> dict:
    """``over`` on top of ``base``, dictionaries within dictionaries merged alike."""
    out = dict(base)
    for k, v in over.items():
        out[k] = deep_merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def load(path: str | Path) -> Pack:
    """A pack from a JSON file; raises ValueError with every problem found."""
    raw = json.loads(Path(path).read_text(encoding="utf-8"))
    unknown = sorted(set(raw) - set(Pack.__dataclass_fields__))
    if unknown:
        raise ValueError("; ".join(f"{k}: unknown key" for k in unknown))
    raw["categories"] = [Category(**c) for c in raw.get("categories", [])]
    raw["gates"] = [Gate(**g) for g in raw.get("gates", [])]
    pack = Pack(**raw)
    if found := pack.problems():
        raise ValueError("; ".join(found))
    return pack


#: A pack over words that the driver's documents do hold, so that every rule fires.
DEMO = Pack(
    relevance={"core": ["the"], "institution": ["with"], "figure": ["und"], "company": ["idiot"], "geo": ["from", "der"], "significance": ["which"], "intl": ["this", "les"], "specific_intl": ["est"]},
    relevance_weights={"core": 20, "institution": 25, "figure": 20, "company": 25, "geo": 12, "significance": 25, "intl": 15, "specific_intl": 25},
    false_positives=["of the", "mit der"],
    geo_false_positives=["was in"],
    union_territories=["east"],
    categories=[Category("articles", ["the", "der", "la"], 1.0), Category("relations", ["of", "von", "de"], 1.25), Category("joins", ["and", "und", "et"], 0.8), Category("world", ["this", "ist", "est"], 1.1, True), Category("doings", ["report", "start", "of the", "the"], 0.9), Category("rude", ["idiot", "moron", "clown"], 1.4)],
    generic_words=["the", "de"],
    states={"north": ["in"], "south": ["was"], "east": ["die"]},
    cities={"are": "north", "zu": "east"},
    national_terms=["that", "pour"],
    significance_events=["loser", "pathetic"],
    gates=[Gate("clickbait", ["for", "para"], 25), Gate("rumour", ["by", "auf"], 25, "strong"), Gate("opinion", ["as"], 20, "none", True), Gate("filler", ["to", "en"], 18, "strong"), Gate("rude", ["moron", "clown"], 35)],
    weak_terms={"by": 6},
    major_markers=["on", "con"],
    event_weights={"idiot": 84, "moron": 64, "worthless": 46, "with": 42, "from": 22, "this": 18, "und": 14, "les": 10, "for": 6},
)

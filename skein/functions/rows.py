"""Rules for the sentence rows of a story: what they report, whether they belong to its headline, which are worth a place.

Plain functions of strings; ``operators.stories`` runs them over whole columns of row arrays.
"""

from __future__ import annotations

import re
from functools import lru_cache

from . import headlines as H
from . import sentences as S


def _any(words: str, space: str = " ") -> str:
    """An alternation of the words, underscores standing for white space."""
    return "|".join(sorted((w.replace("_", space) for w in words.split()), key=lambda w: (-len(w), w)))


REPORTING = _any("add added adds announced announces claimed claims confirmed confirms declared declares explained explains noted notes report reported reports revealed reveals said says stated states stressed suggested suggests told warn warned warns")
COUNTED = _any("dead deaths displaced evacuated evacuees families fatalities homes hostages injured killed missing officers people residents soldiers troops")
QUANTIFIERS = _any("about almost around at_least more_than nearly over roughly up_to")
#: Words that say what happened to those counted.
CONSEQUENCES = "affected arrested damaged destroyed detained died displaced evacuated homeless injured killed missing rescued stranded trapped wounded".split()
_AREA = _any("area bay capital central city coast county district east eastern island metropolitan national north northern park prefecture province region river south southern state town valley village west western")
_NAME = r"[A-Z][A-Za-z’'-]*"
IMPACT = re.compile(rf"(?:(?:{QUANTIFIERS})\s+)?\d(?:[\d,.]*\d)?\s*\b(?:{COUNTED})\b", re.I)
QUANTIFIER = re.compile(rf"^(?:{QUANTIFIERS})\s+", re.I)
PLACE = re.compile(rf"\b(?:{_any('across around at from in near toward towards')})\s+({_NAME}(?:\s+(?:{_NAME}|(?:{_AREA})\b)){{0,2}})")
_WORD, _D = r"[A-Za-z][\w’'-]*", "[0-9]"
_SPEAKER = rf"{_WORD}(?:\s+{_WORD}){{0,3}}"
ENDING_SPEAKER = re.compile(rf",\s*(?:according to\s+{_SPEAKER}|{_SPEAKER}\s+(?:{REPORTING}))\s*[.!?]?\s*$", re.I)
LEADING_SPEAKER = re.compile(rf"^{_SPEAKER}\s+(?:(?:{_any('am are had has have is was were')})\s+)?(?:{REPORTING})\b", re.I)
CLOSED_QUOTE = re.compile(r"""(?<=[.!?]['"‘’“”])\s+""")
SHIFT = re.compile(rf"^\W*(?:{_any('additionally also as_for away_from besides by_the_way elsewhere furthermore however in_contrast in_other_developments in_other_news in_the_meantime in_unrelated_news meanwhile moreover on_a_different_note on_another_note on_the_other_hand separately shifting_focus turning_to')})\b", re.I)
#: A clock, degrees or a date with slashes.
ANCHOR = re.compile(rf"\b{_D}{{1,2}}(?::{_D}{{2}}){{1,2}}\b|{_D}\s*[°º]|\b(?:{_D}{{1,2}}/){{2}}{_D}{{2,4}}\b")
_S = r"\s+"
GENERAL_OPENING = re.compile(rf"^(?:{_any('for_context_purposes for_general_purposes for_reference_purposes for_scientific_purposes generally in_general in_many_cases typically usually', _S)})\b", re.I)
GENERAL_CLAIM = re.compile(
    rf"\b(?:{_any('can could may might')})\s+(?:{_any('cause lead_to occur produce range reach result_in rise strike trigger vary', _S)})\b"
    rf"|\b(?:{_any('broadly_classified classified_as depend_on depended_on depending_on depends_on generally_speaking in_general known_as referred_to_as tend_to_be tended_to_be tending_to_be tends_to_be', _S)})\b"
    rf"|\b(?:{_any('are is was were')})\s+(?:{_any('generally often typically usually')})\s+(?:less|more)\s+\w+\s+than\b",
    re.I,
)


@lru_cache(4096)
def numbers(text: str) -> set[str]:
    """Numbers without separators; number words below thirteen count too."""
    words = {w: str(n) for n, w in enumerate("one two three four five six seven eight nine ten eleven twelve".split(), 1)}
    low = text.lower()
    return {x.replace(",", "").rstrip(".") for x in S.NUMBER.findall(low)} | {words[w] for w in re.findall(r"[a-z]+", low) if w in words and w != "one"}


@lru_cache(4096)
def unit_values(text: str) -> set[str]:
    return set(H.units(text))


@lru_cache(4096)
def facts(text: str | None) -> dict:
    """numbers, entities, locations, temporal, impact as sets or lists of what stands in the text; attribution trailing, leading or None."""
    t = text or ""
    side = "trailing" if ENDING_SPEAKER.search(t) else "leading" if LEADING_SPEAKER.match(t) else None
    return {
        "numbers": numbers(t),
        "entities": H.names(t),
        "locations": {m.lower() for m in PLACE.findall(t) if len(m.split()) <= 4},
        "temporal": {x.lower() for x in S.TIME.findall(t)},
        "attribution": side,
        "impact": [m.group(0) for m in IMPACT.finditer(t)],
    }


def has_fact(f: dict) -> bool:
    return any(f.values())


def score(f: dict) -> float:
    """Weights by kind, two of a kind at most."""
    two = lambda k: min(2, len(f[k]))
    return 3.0 * two("impact") + 1.5 * two("numbers") + two("locations") + 0.75 * two("entities") + 0.5 * bool(f["temporal"]) + 0.5 * bool(f["attribution"])


@lru_cache(4096)
def specificity(text: str) -> float:
    """What ties a sentence to one happening: time, place, consequence, speaker, clock or coordinates."""
    f = facts(text)
    out = 2.0 * bool(f["temporal"]) + 1.5 * min(2, len(f["locations"])) + 2.0 * bool(f["impact"]) + 1.0 * bool(f["attribution"])
    return out + 1.5 * bool(ANCHOR.search(text)) + 2.0 * bool(re.search(rf"\b(?:{_any(' '.join(CONSEQUENCES))})\b", text, re.I))


@lru_cache(4096)
def generic(text: str) -> bool:
    """A general explanation: a general claim without anything that ties it to the event."""
    f = facts(text)
    if f["temporal"] or f["locations"] or f["impact"] or f["attribution"] or ANCHOR.search(text):
        return False
    return bool(GENERAL_OPENING.match(text) or GENERAL_CLAIM.search(text))


@lru_cache(4096)
def impact_signature(text: str) -> set[tuple[str, str | None]]:
    """Each counted consequence, without its quantifier, and the consequence word within the next 60 characters."""
    out = set()
    for m in IMPACT.finditer(text or ""):
        after = text[m.end() : m.end() + 60]
        out.add((QUANTIFIER.sub("", m.group(0)).strip(), next((w for w in CONSEQUENCES if re.search(rf"\b{w}\b", after)), None)))
    return out


def covers_signature(chosen: list[str], text: str) -> bool:
    """Whether a chosen sentence shares both a number and a counted consequence."""
    n, i = numbers(text), impact_signature(text)
    return bool(n and i) and any(n & numbers(c) and i & impact_signature(c) for c in chosen)


def covers_units(chosen: list[str], text: str) -> bool:
    """Whether the chosen sentences hold every number with a unit that the sentence has."""
    own = unit_values(text)
    return bool(own) and own <= set().union(*map(unit_values, chosen))


def adds_fact(text: str, chosen: list[str]) -> bool:
    """A consequence, number, place or time that the chosen sentences do not have."""
    f = facts(text)
    if f["impact"] and not covers_signature(chosen, text):
        return True
    have = [facts(c) for c in chosen]
    return any(f[k] - set().union(*(h[k] for h in have)) for k in ("numbers", "locations", "temporal"))


def split_quotes(rows: list[dict], headline: str | None) -> list[dict]:
    """Rows cut behind a closing quote that ends a sentence; parts that only repeat the headline go, all else is kept with the row's other fields."""
    out = []
    for r in rows:
        parts = [p for p in CLOSED_QUOTE.split(r["text"] or "") if p.strip()]
        if len(parts) < 2:
            out.append(r)
        else:
            out += [r | {"text": p} for p in parts if not (headline and S.paraphrases(p, headline))]
    return out


def runs(text: str) -> list[str]:
    """Two and more capitalized words in a row, in lower case."""
    out: list[str] = []
    now: list[str] = []
    for w in [*H.WORD.findall(text or ""), ""]:
        if w[:1].isupper():
            now.append(w)
        else:
            if len(now) > 1:
                out.append(" ".join(now).lower())
            now = []
    return out


@lru_cache(4096)
def off_topic_name(text: str, headline: str) -> bool:
    """A name of several words that is no place and has nothing of the headline."""
    known = H.KNOWN | set(H.ALIASES)
    own = H.names(headline or "")
    low = (headline or "").lower()
    return any(r not in low and r not in known and not any(w in H.PLACES or w in own for w in r.split()) for r in runs(text))


@lru_cache(4096)
def acronyms(text: str) -> set[str]:
    """Words in capitals, and the initials of capitalized runs."""
    spelled = {w.lower() for w in H.WORD.findall(text or "") if len(w) > 1 and w.isalpha() and w.isupper()}
    words = ([w for w in r.split() if w not in H.STOPWORDS] for r in runs(text))
    return spelled | {"".join(w[0] for w in ws) for ws in words if len(ws) > 1}


@lru_cache(4096)
def links(text: str, headline: str) -> bool:
    """Whether a row shares an acronym, a name or place, an action, or the stem of a word with the headline, or counts a consequence."""
    if not text or not headline:
        return False
    if acronyms(text) & acronyms(headline) or H.names(text) & H.names(headline) or H.actions(text) & H.actions(headline) or IMPACT.search(text):
        return True
    a, b = S.content(text), S.content(headline)
    return bool(a & b) or any(len(x) >= 4 and len(y) >= 4 and (x in y or y in x) for x in a for y in b)


def related(rows: list[dict], headline: str) -> list[dict]:
    """Rows without those that turn to another story (a marker of it or an unrelated name) and have no link to the headline."""
    return [r for r in rows if (r["text"] or "").strip() and (links(r["text"], headline) or not (SHIFT.match(r["text"]) or off_topic_name(r["text"], headline)))]


def _pool(rows: list[dict], cap: int, already: int, preferred: int, least: int) -> list[dict]:
    unique = {S.key(r["text"]): r for r in reversed(rows)}
    order = [r for r in rows if unique[S.key(r["text"])] is r and not S.is_filler(r["text"])]
    plain = [r for r in order if generic(r["text"])]
    rest = [(r, facts(r["text"])) for r in order if not generic(r["text"])]
    telling = sorted(((r, f) for r, f in rest if has_fact(f)), key=lambda x: -(score(x[1]) + specificity(x[0]["text"])))
    chosen: list[dict] = []
    texts = lambda: [c["text"] for c in chosen]

    def take(candidates, upto: int) -> None:
        for r in candidates:
            if len(chosen) >= upto:
                return
            if not covers_signature(texts(), r["text"]) and not covers_units(texts(), r["text"]):
                chosen.append(r)

    target = min(max(0, preferred - already), cap)
    take([r for r, _ in telling], target)
    take([r for r, f in rest if not has_fact(f)], target)
    take(plain, min(max(0, least - already), cap))
    for r, _ in telling:
        if len(chosen) < cap and not any(r is c for c in chosen) and adds_fact(r["text"], texts()):
            chosen.append(r)
    return chosen


def select(rows: list[dict], least: int = 2, most: int = 4, preferred: int = 2) -> list[dict]:
    """The sentences of a summary: of the article's own rows first, then of the others, ``preferred`` in all by facts and what
    ties them to the event, explanations only up to ``least``; beyond that only what adds a fact, up to ``most``."""
    own = [r for r in rows if (r.get("item_id") or "").endswith(":article")]
    other = [r for r in rows if not (r.get("item_id") or "").endswith(":article")]
    first = _pool(own, most, 0, preferred, least)
    texts = [r["text"] for r in first]
    other = [r for r in other if not covers_signature(texts, r["text"]) and S.key(r["text"]) not in {S.key(t) for t in texts}]
    return first + _pool(other, most - len(first), len(first), preferred, least)


JUNK_LINES = ("- published", "advertisement", "get in touch", "list of", "more top stories", "newsletter", "read more", "recommended stories", "related topics", "sign up", "video:", "watch:", "you may also like")


def explanatory(texts, headline: str, most: int = 4) -> list[str]:
    """Cleaned sentences in order, without filler, paraphrases of the headline, repeats and near repeats."""
    kept: list[str] = []
    for t in texts or ():
        s = "" if S.is_filler(t) else S.clean_sentence(t)
        if s and re.search("[a-z0-9]", s, re.I) and not S.is_filler(s) and not S.paraphrases(s, headline or "") and not any(S.key(s) == S.key(k) or S.near(s, k) for k in kept):
            kept.append(s)
        if len(kept) == most:
            break
    return kept


def article_sentences(text: str | None, headline: str, most: int = 12) -> list[str]:
    """Sentences of an extracted article, one paragraph to a line: lines of navigation and lines that end without an end mark go."""
    out: dict[str, str] = {}
    for line in map(str.strip, (text or "").split("\n")):
        if not re.search(r"""[.!?…]["'’”)\]]*$""", line) or any(j in line.lower() for j in JUNK_LINES):
            continue
        for s in map(S.clean_sentence, S.split(line)):
            if s and not S.is_filler(s) and not S.paraphrases(s, headline or ""):
                out.setdefault(S.key(s), s)
                if len(out) == most:
                    return list(out.values())
    return list(out.values())[:most]


def glyph_width(c: str) -> int:
    """Columns that a character takes: two for wide scripts and emoji."""
    n = ord(c)
    return 2 if any(a <= n <= b for a, b in ((0x1100, 0x115F), (0x2E80, 0xA4CF), (0xAC00, 0xD7A3), (0xF900, 0xFAFF), (0xFE30, 0xFE4F), (0xFF00, 0xFF60), (0x1F300, 0x1FAFF), (0x2600, 0x27BF))) else 1


def visible(text: str) -> int:
    return sum(map(glyph_width, re.sub(r"&[a-zA-Z#0-9]+;", "x", text)))


def truncated(text: str, most: int) -> str:
    """As many whole characters as fit with an ellipsis, by visible width."""
    if visible(text) <= most:
        return text
    if most < 8:
        return text[:most]
    room, end = most - 1, 0
    for c in text:
        room -= glyph_width(c)
        if room < 0:
            break
        end += 1
    return text[:end].rstrip() + "…"


def summarize(headline: str, rows: list[dict], least: int = 2, most: int = 4) -> dict:
    """Split, drop unrelated rows, clean, select by facts, put attributions in front, verify against the source, check the wording.
    With fewer than ``least`` sentences at any step: insufficient_information, verification or quality."""
    none = lambda status, why=(): {"sentences": [], "status": status, "problems": list(why), "candidates": len(rows)}
    usable: list[dict] = []
    kept = S.Kept()
    for r in related(split_quotes(rows, headline), headline):
        s = S.clean_sentence(r["text"] or "")
        if s and not S.is_filler(s) and not S.paraphrases(s, headline) and not kept.has(s):
            usable.append(r | {"text": s})
            kept.add(s)
    chosen = select(usable, least, most) if len(usable) >= least else []
    if len(chosen) < least:
        return none("insufficient_information")
    composed = [(r, S.front_attribution(r["text"])) for r in chosen]
    wrong = [[f"verification:{w}" for w in S.verified(t, r["text"])] for r, t in composed]
    good = [x for x, w in zip(composed, wrong) if not w]
    faults = [w for ws in wrong for w in ws]
    if len(good) < least:
        return none("verification", faults)
    bad = [[f"quality:{q}" for q in S.problems(t, headline)] for _, t in good]
    out = [{"text": t, "source": r["source"], "item_id": r["item_id"], "composed": t != r["text"]} for (r, t), b in zip(good, bad) if not b]
    faults += [q for qs in bad for q in qs]
    return none("quality", faults) if len(out) < least else {"sentences": out, "status": "ok", "problems": faults, "candidates": len(rows)}

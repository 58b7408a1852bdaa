"""Signals of a headline by which stories are matched: names, places, actions, numbers."""

from __future__ import annotations

import re
from functools import lru_cache

from .sentences import split

_LETTERS = "[0-9A-Za-z]+"
WORD = re.compile(f"{_LETTERS}(?:[-'’]{_LETTERS})*")
POSSESSIVE = re.compile(r"'\w*$")
NUMBER = re.compile(r"\d[\d,.]*")
UNIT = re.compile(r"(\d[\d,.]*)\s*(million|billion|thousand|percent|%|people|residents|homes|families|troops|soldiers|killed|injured|dead|displaced|evacuated|evacuees|jobs|sq miles|sq km|sq m|miles|km|hectares|acres|fires|officers|hostages)", re.I)
STOPWORDS = frozenset("a about across after aftermath against amid among an and are around as at be been before between but by could down during first for from had has have her his how in including into is it its latest live may might more most near new no not of officials on or over people photo report reports said says that the their them these they this those to today under up update updates via video was watch were what when where while who why will with world would yes yesterday".split())
KNOWN = frozenset("bbc biden c16 c83 cia congress eln eu facebook fbi house hunter meta nato petro senate tps uk un us yagi zelensky".split())
ALIASES = {k: v for v, ks in {"meta": "facebook", "saudi": "riyadh jeddah", "iran": "tehran iranian", "russia": "moscow kremlin russian", "ukraine": "kyiv kiev ukrainian", "thailand": "bangkok", "cuba": "havana", "serbia": "belgrade", "colombia": "bogota", "greece": "athens", "australia": "sydney", "spain": "madrid spanish", "us": "washington american", "uk": "london british", "china": "beijing chinese", "canada": "ottawa canadian", "japan": "tokyo japanese", "france": "paris", "germany": "berlin", "syria": "syrian", "israel": "israeli", "palestine": "palestinian"}.items() for k in ks.split()}
PLACES = frozenset("afghanistan africa america argentina asia australia belgium brazil britain canada ceuta chile china colombia columbia cuba denmark egypt england europe france gaza germany greece gulf hormuz hungary india indonesia iran israel italy japan kenya malaysia mexico netherlands nigeria norway pakistan palestine peru philippines poland portugal romania russia saudi serbia spain spokane sweden syria taiwan thailand turkey uk ukraine us usa venezuela vietnam".split())
ACTIONS = frozenset("agreement approv arrest arriv attack blackout blast bomb breach ceasefire ceremony collapse convict cross dead deal death deploy die drone drown earthquake elect evacuat exercise explod extend fine fire flee flood guilty gunfire gunman hack hit hurricane inaugurat indict ink jobs kill killed landfall landslide lawsuit missile outage pact pass payroll penalty protest quake refinery sanction seal seize seizure shoot shooting sign storm strike strikes summit surge swear tanker terminat tornado treaty typhoon verdict visit vote wildfire".split())
SYNONYMS = {k: frozenset(v.split()) for k, v in {"strike": "batters hit landfall pummel slams strike", "shoot": "gunfire gunman shoot shooting", "sign": "ink ratify seal sign", "pact": "accord agreement deal pact treaty", "visit": "arriv arrive visit", "outage": "blackout collapse outage shutdown", "convict": "convict guilty liable verdict", "fine": "fine penalty", "kill": "dead death fatal kill", "evacuat": "evacuat evacuation flee"}.items()}


@lru_cache(4096)
def names(text: str) -> set[str]:
    """Words of capitalized runs, without a lone first word of a sentence unless it is a known name; aliases beside their names."""
    out = set()
    for sentence in split(text):
        found, i = WORD.findall(sentence), 0
        while i < len(found):
            j = i
            while j < len(found) and found[j][:1].isupper():
                j += 1
            run = [POSSESSIVE.sub("", w).lower() for w in found[i:j]]
            if len(run) >= 2 or run and (i > 0 or run[0] in KNOWN or run[0] in PLACES or run[0] in ALIASES):
                for w in run:
                    if not w[:1].isdigit() and w not in STOPWORDS:
                        out |= {w, ALIASES.get(w, w)}
            i = max(j, i + 1)
    return out


@lru_cache(4096)
def actions(text: str) -> set[str]:
    """Event words and their stems, and the name of each group of synonyms that has one."""
    stems = set()
    for w in WORD.findall(text.lower()):
        stems |= {w} | {w[: -len(x)] for x in "s es ed d ing".split() if len(w) > len(x) + 2 and w.endswith(x)}
    return {k for k, v in SYNONYMS.items() if v & stems} | stems & ACTIONS


def units(text: str) -> list[str]:
    """Numbers with their units, as ``unit=number``, in order."""
    return [f"{u.lower()}={re.sub('[.,]', '', n)}" for n, u in UNIT.findall(text)]


def large_numbers(text: str) -> set[str]:
    return {n for n in (x.replace(",", "") for x in NUMBER.findall(text)) if len(n) >= 4}


def topic(text: str) -> set[str]:
    return {w for w in WORD.findall(text.lower()) if len(w) >= 4 and w not in STOPWORDS}

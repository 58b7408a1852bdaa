"""Story operators on made rows."""

import datetime as dt
import random

from skein.functions import sentences as S
from skein.operators import stories as ST

STORY = "story_id string, event_id string, at timestamp, text string, headline string, priority_score double, primary_source boolean, tier int, queue_rank long"


def _groups(spark, *texts, events=None):
    at = dt.datetime(2024, 1, 15)
    rows = [(str(k), events[k] if events else None, at, t, t, 90.0 - k, False, 2, k) for k, t in enumerate(texts)]
    return {r["story_id"]: r["group_id"] for r in ST.group_stories(spark.createDataFrame(rows, STORY)).collect()}


def test_stories_of_one_event_with_other_first_words(spark):
    got = _groups(
        spark,
        "Typhoon Yagi floods villages across northern Vietnam valleys after landfall",
        "Villages across northern Vietnam valleys see floods after Typhoon Yagi landfall",
        "Senate Budget Panel delays vote",
    )
    assert got == {"0": "0", "1": "0", "2": "2"}


def test_stories_of_one_event_id(spark):
    assert _groups(spark, "Rain in the hills", "Something else", "A third", events=["e", "f", "e"]) == {"0": "0", "1": "1", "2": "0"}


def _same(a, b):
    story = lambda t: {"event_id": None, "at": dt.datetime(2024, 1, 15)} | ST.story_facts(t)
    return ST.same_story(story(a), story(b))


def test_signals_of_one_story():
    # names and an action, little else; then one name and a second action
    assert _same("Zelensky visits Serbia for talks on energy", "Ukraine's leader Zelensky arrives in Belgrade")
    assert _same("Typhoon Yagi death toll hits 200", "Flights resume once deadly storm Yagi kills dozens after strike on coast")
    # the same large number, other words
    assert _same("Analysts see Federal Reserve payrolls jump 272,000", "US economy adds 272,000 posts, Federal Reserve told")
    # other places; other numbers of one unit; numbers of other units do not matter
    assert not _same("Huge Wildfire in Canada forces evacuation of Red Lake", "Huge Wildfire in Spokane forces evacuation near Red Lake")
    assert not _same("Storm Yagi floods leave 20,000 evacuated in Hanoi", "Storm Yagi floods leave 12,000 evacuated in Hanoi")
    assert _same("Storm Yagi floods leave 20,000 evacuated in Hanoi", "Storm Yagi floods leave 45 dead in Hanoi")
    assert not _same("Protest in Ukraine", "Minister from Ukraine resigns")


def test_groups_as_by_one_first_fit_over_all(spark):
    rng = random.Random(5)
    names = "Yagi Zelensky Hanoi Kyiv Petro Meta Biden Senate".split()
    rest = "storm visits strike summit kills deal quake vote 20,000 evacuated 45 dead budget river plan".split()
    rows = []
    for k in range(150):
        title = " ".join(["Storm", *rng.sample(names, rng.randrange(1, 4)), *rng.sample(rest, 4)])
        at = None if rng.random() < 0.05 else dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randrange(600))
        rows.append((str(k), rng.choice([*[None] * 9, f"e{k % 50}"]), at, title, title, float(rng.randrange(5)), rng.random() < 0.3, rng.randrange(1, 4), k))
    got = {r["story_id"]: r["group_id"] for r in ST.group_stories(spark.createDataFrame(rows, STORY)).collect()}
    groups, want = [], {}
    for r in rows:
        s = dict(zip(("story_id", "event_id", "at", "text", "headline", "score", "primary", "tier"), r)) | ST.story_facts(r[4])
        g = next((g for g in groups if ST.same_story(max(g, key=lambda x: (x["score"], x["primary"], -x["tier"])), s)), None)
        if g is None:
            groups.append(g := [])
        g.append(s)
        want[s["story_id"]] = g[0]["story_id"]
    assert got == want and 5 < len(groups) < 140 and any(len(g) > 5 for g in groups)


def test_kept_sentences_are_met_by_their_words_not_one_by_one(monkeypatch):
    rng = random.Random(2)
    words = [f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300)]
    texts = [" ".join(rng.sample(words, 12)) + rng.choice(["", " 12", " 45"]) for _ in range(300)]
    texts += [" ".join([*t.split()[1:], rng.choice(words)]) for t in texts[:150]] + texts[:20]
    kept, plain, same, calls = S.Kept(), [], S.near, []
    monkeypatch.setattr(S, "near", lambda a, b: calls.append(1) or same(a, b))
    for t in texts:
        there = any(S.key(t) == S.key(k) or same(t, k) for k in plain)
        assert kept.has(t) == there
        if not there:
            kept.add(t)
            plain.append(t)
    assert 300 <= len(plain) < 400 and len(calls) < 10_000

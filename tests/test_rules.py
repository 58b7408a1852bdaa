"""Rules over made rows: fetching, feeds, sentence rows, the publish loop, term matching, packs."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from skein import packs
from skein.functions import fetching as FE
from skein.functions import html_pages as H
from skein.functions import matching as M
from skein.functions import rows as R
from skein.functions import sentences as S
from skein.functions import text as T
from skein.operators import publishing as P
from skein.operators import scoring as SC
from skein.operators import stories as ST
from skein.packs import DEMO
from skein.sources import feeds, sinks
from skein.streaming import publisher as PUB

NOW = dt.datetime(2024, 1, 15, tzinfo=dt.timezone.utc)
PAGE = b"<html><body>" + b"<p>Officials said the river rose by two metres over the night.</p>" * 6 + b"</body></html>"


# fetching


def _get(pages):
    def get(url):
        if url.endswith("/robots.txt"):
            return pages.get(url, FE.Answer(404))
        a = pages[url]
        if isinstance(a, Exception):
            raise a
        return a

    return get


def _fetch(url, pages, rules=None, addresses=("93.184.216.34",), **more):
    return FE.fetch_article(url, _get(pages), rules or FE.Rules(domains=frozenset(("x.org",))), lambda host: list(addresses), **more)[0]


HTML = {"Content-Type": "text/html; charset=utf-8"}


@pytest.mark.parametrize(
    "want, url, answer, more",
    [
        ("ok", "https://x.org/a", FE.Answer(200, HTML, PAGE), {}),
        ("ok", "https://www.x.org/a", FE.Answer(200, {}, [PAGE[:50], PAGE[50:]]), {}),
        ("http_error", "https://x.org/a", FE.Answer(404, HTML, PAGE), {}),
        ("http_error", "https://x.org/a", FE.Answer(302, {}), {}),
        ("http_error", "https://x.org/a", FE.Answer(302, {"Location": "/a"}), {}),
        ("blocked", "https://x.org/a", FE.Answer(302, {"Location": "https://y.org/a"}), {}),
        ("blocked", "https://y.org/a", FE.Answer(200, HTML, PAGE), {}),
        ("blocked", "ftp://x.org/a", FE.Answer(200, HTML, PAGE), {}),
        ("blocked", "https://x.org/a", FE.Answer(200, HTML, PAGE), {"addresses": ("10.0.0.1", "100.64.1.1", "::1", "no")}),
        ("blocked", "https://x.org/a", FE.Answer(200, HTML, PAGE), {"pace": lambda host: False}),
        ("non_article", "https://x.org/news/video/1", FE.Answer(200, HTML, PAGE), {"rules": FE.Rules(segments=frozenset(("Video",)))}),
        ("non_article", None, FE.Answer(200, HTML, PAGE), {}),
        ("paywall", "https://x.org/a", FE.Answer(200, HTML, b"<html><p>" + b"Only a short text stands here. " * 2 + b"</p></html>"), {}),
        ("paywall", "https://x.org/a", FE.Answer(200, HTML, PAGE.replace(b"</body>", b"<p>Subscription required to go on with this.</p></body>")), {}),
        ("no_text", "https://x.org/a", FE.Answer(200, HTML, b"<html><body><div></div></body></html>"), {}),
        ("not_html", "https://x.org/a", FE.Answer(200, {"content-type": "application/pdf"}, PAGE), {}),
        ("not_html", "https://x.org/a", FE.Answer(200, {}, b'{"a": "<p>"}'), {}),
        ("too_large", "https://x.org/a", FE.Answer(200, HTML | {"Content-Length": "9999999"}, b""), {}),
        ("too_large", "https://x.org/a", FE.Answer(200, HTML, iter([PAGE] * 10_000)), {}),
        ("timeout", "https://x.org/a", TimeoutError(), {}),
        ("network_error", "https://x.org/a", OSError("reset"), {}),
    ],
)
def test_every_status_of_a_fetch(want, url, answer, more):
    assert _fetch(url, {url: answer}, **more) == want and want in FE.STATUSES


def test_robots():
    url = "https://x.org/private/a"
    for robots, want in ((FE.Answer(200, {}, b"User-agent: *\nDisallow: /private"), "blocked"), (FE.Answer(200, {}, b"User-agent: *\nDisallow: /other"), "ok"), (FE.Answer(403), "blocked"), (FE.Answer(404), "ok"), (FE.Answer(500), "blocked")):
        assert _fetch(url, {url: FE.Answer(200, HTML, PAGE), "https://x.org/robots.txt": robots}) == want
    clock = iter(range(0, 10_000, 20))
    assert _fetch(url, {url: FE.Answer(301, {"Location": url})}, clock=lambda: next(clock)) == "timeout"


def test_source_bytes():
    assert FE.fetch_source("u", lambda u: FE.Answer(200, {}, b"x")) == b"x"
    with pytest.raises(OSError):
        FE.fetch_source("u", lambda u: FE.Answer(500))
    with pytest.raises(FE.TooLarge):
        FE.fetch_source("u", lambda u: FE.Answer(200, {}, b"x" * 11), 10)


def test_enrichment(spark):
    stories = [("a", "https://x.org/a", "g", 1, "HIGH", "NEWS", 10.0, 0), ("b", "https://x.org/b", "g", 0, "HIGH", "NEWS", 10.0, 0), ("c", "https://x.org/c", "h", 2, "NORMAL", "NEWS", 10.0, 0)]
    df = spark.createDataFrame(stories, "story_id string, url string, group_id string, queue_rank int, priority string, label string, priority_score double, n_sentences int")
    cache = spark.createDataFrame([], "story_id string, status string, fetched_at timestamp, ttl_hours int")
    plan = P.enrichment_plan(df, cache, F.lit(NOW).cast("timestamp"), 5)
    pages = {"https://x.org/a": FE.Answer(404), "https://x.org/b": FE.Answer(200, HTML, PAGE)}
    fetched = P.enriched(plan, _get(pages), FE.Rules(), lambda host: ["93.184.216.34"])
    assert {r["story_id"]: r["fetch_status"] for r in fetched.collect()} == {"a": "http_error", "b": "ok"}
    got = {r["story_id"]: (r["text_from"], bool(r["article_text"])) for r in P.with_partners(plan, fetched).collect()}
    assert got == {"a": ("b", True), "b": ("b", True), "c": (None, False)}
    assert {tuple(r) for r in P.extraction_counts(fetched).collect()} == {("http_error", 1), ("ok", 1)}


# feeds

ITEM = "<item><title>{}</title><link>https://x.org/{}?utm_source=a</link><dc:creator>By A</dc:creator><category term='t'/></item>"


def test_a_broken_feed_keeps_its_whole_entries():
    feed = "<rss xmlns:dc='d'><channel>" + ITEM.format("One &amp; two", 1) + ITEM.format("Three", 2)
    for text in (feed + "</channel></rss>", feed + "<item><title>cut", feed + "<item><title>a & b</title></item>"):
        got = H.parse_rss(text.encode())
        assert [(i["title"], i["url"], i["author"], i["category_hints"]) for i in got] == [("One & two", "https://x.org/1", "By A", ["t"]), ("Three", "https://x.org/2", "By A", ["t"])]
    for text in (b"<rss><channel><item>", b"nothing"):
        with pytest.raises(H.ParseError):
            H.parse_rss(text)
    assert H.parse_rss(b"<rss/>") == []


def test_links_of_a_listing():
    page = "<a href='/a'>One</a><a href='https://x.org/a?utm_source=q'>Again</a><a href='#top'>Top</a><a href='https://y.org/b'>Off</a><a>none</a><a href='/c'>No end <b>tag</b><a href='mailto:x'>M</a>"
    assert [(i["url"], i["title"]) for i in H.links(page, "https://x.org/", ["x.org"])] == [("https://x.org/a", "One"), ("https://x.org/c", "No end tag")]


def test_json_items_and_failures(spark):
    body = json.dumps({"status": "ok", "data": [{"title": "A", "url": "https://x.org/a", "author": None, "tags": ["p"]}, {"title": "B"}]})
    rows = [("good", "api", body), ("bad", "api", "{"), ("none", "what", ""), ("page", "page", "<a href='/q'>Q</a>")]
    reg = feeds.registry(spark, [{"id": i, "name": i, "type": "official", "tier": 1, "method": m, "url": "https://x.org/", "settings": {"body": b}, "enabled": True, "primary": True, "discovery": False, "language": None} for i, m, b in rows])
    got = feeds.collect(reg, lambda url, settings: settings["body"].encode())
    assert sorted((r["source_id"], r["status"], r["item"] and r["item"]["title"]) for r in got.collect()) == [("bad", "malformed", None), ("good", "ok", "A"), ("none", "malformed", None), ("page", "ok", "Q")]
    made = {r["source_id"]: r for r in feeds.build_articles(got, reg, F.lit(NOW).cast("timestamp")).collect()}
    assert set(made) == {"good", "page"} and made["good"]["source_role"] == "official-primary" and made["good"]["language"] == "en" and made["good"]["category_hints"] == ["p"]
    before = spark.createDataFrame([("bad", "error", 2, 5)], "source_id string, status string, consecutive_failures int, total_errors int")
    before = before.selectExpr("*", "cast(null as timestamp) last_success", "cast(null as timestamp) last_fetch", "0 timeouts", "1 malformed", "3 items_found", "cast(null as string) last_error")
    health = {r["source_id"]: r for r in feeds.health(before, got, F.lit(NOW).cast("timestamp")).collect()}
    assert (health["bad"]["consecutive_failures"], health["bad"]["total_errors"], health["bad"]["malformed"]) == (3, 6, 2) and health["good"]["status"] == "ok" and health["good"]["items_found"] == 1
    assert [tuple(r) for r in feeds.json_items(spark.createDataFrame([(1, body)], "id int, body string")).select("id", "title", "url").collect()] == [(1, "A", "https://x.org/a")]


def test_files_queue_and_state(spark, tmp_path):
    (tmp_path / "f.html").write_text("<a href='/x'>X</a>")
    fetch = feeds.files(str(tmp_path))
    assert b"X" in fetch("https://x.org/f.html", {})
    with pytest.raises(ValueError):
        fetch("https://x.org/../../etc/passwd", {})
    (tmp_path / "feed.xml").write_text("<rss><channel><item><title>T</title><link>l</link></item></channel></rss>")
    assert [r["title"] for r in feeds.xml_feed(spark, str(tmp_path / "feed.xml")).collect()] == ["T"]
    df = spark.createDataFrame([("b", 1), ("a", 0)], "story_id string, queue_rank int")
    document = sinks.queue_document(df, F.lit(NOW).cast("timestamp")).first()["document"]
    assert json.loads(document) == {"generated_at": "2024-01-15T00:00:00Z", "count": 2, "stories": [{"story_id": "a"}, {"story_id": "b"}]}
    (tmp_path / "q.json").write_text(document)
    assert [r["story_id"] for r in feeds.queue_file(spark, str(tmp_path / "q.json")).collect()] == ["a", "b"]
    sinks.write_queue(df, str(tmp_path / "queue"))
    assert spark.read.json(str(tmp_path / "queue")).count() == 2
    state = str(tmp_path / "state.json")
    assert feeds.state_file(state, {"posted": []}) == {"posted": []}
    sinks.save_state(state, {"posted": ["é"]})
    assert feeds.state_file(state, {}) == {"posted": ["é"]}
    (tmp_path / "state.json").write_text("[1]")
    assert feeds.state_file(state, {"posted": []}) == {"posted": []}
    cache = spark.createDataFrame([("a", NOW - dt.timedelta(hours=2), 1), ("b", NOW - dt.timedelta(hours=2), 3)], "story_id string, fetched_at timestamp, ttl_hours int")
    assert [r["story_id"] for r in sinks.alive(cache, F.lit(NOW).cast("timestamp")).collect()] == ["b"]
    assert sinks.publish(df.orderBy("queue_rank"), lambda r: r["story_id"] * 2, ["story_id"], dry_run=False) == [("a", "aa"), ("b", "bb")]


def test_links_table_function(spark):
    spark.udtf.register("extract_links", feeds.ExtractLinks)
    got = spark.sql("SELECT * FROM extract_links('<a href=\"/a\">A</a>', 'https://x.org/')").collect()
    assert [tuple(r) for r in got] == [("https://x.org/a", "A", 0)]


@pytest.mark.parametrize(
    "data, size",
    [
        (b"\x89PNG\r\n\x1a\n\x00\x00\x00\rIHDR" + (640).to_bytes(4, "big") + (480).to_bytes(4, "big"), (640, 480)),
        (b"GIF89a" + (3).to_bytes(2, "little") + (4).to_bytes(2, "little"), (3, 4)),
        (b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x0b\x08" + (20).to_bytes(2, "big") + (30).to_bytes(2, "big"), (30, 20)),
        (b"RIFF0000WEBPVP8X" + b"\x00" * 8 + (99).to_bytes(3, "little") + (49).to_bytes(3, "little"), (100, 50)),
        (b"nothing", None),
        (None, None),
        (b"\x89PNG\r\n\x1a\n", None),
    ],
)
def test_image_sizes(data, size):
    assert H.image_size(data) == size


# sentence rows

HEAD = "Wildfire in Spokane forces evacuation of 20,000 residents"


def _row(text, item="i", source="s"):
    return {"text": text, "source": source, "item_id": item}


def test_quotes_that_end_a_sentence_are_cut():
    rows = [_row('He called it "a poor plan." The International Monetary Fund said growth fell by 2 percent.'), _row("No quote here.")]
    got = R.split_quotes(rows, HEAD)
    assert [r["text"] for r in got] == ['He called it "a poor plan."', "The International Monetary Fund said growth fell by 2 percent.", "No quote here."]
    assert got[1]["source"] == "s"


def test_rows_of_another_story_go():
    rows = [_row("Meanwhile, the International Monetary Fund cut its outlook."), _row("Meanwhile, flames crossed the road near Spokane."), _row("It was a calm night."), _row("The Bald Range wildfire grew."), _row(" ")]
    assert [r["text"] for r in R.related(rows, HEAD)] == [rows[i]["text"] for i in (1, 2, 3)]
    assert R.links("The EC said so.", "Election Commission rules on poll") and not R.off_topic_name("The US and Canada agreed.", HEAD)
    assert R.runs("In New Delhi the Supreme Court of India sat") == ["in new delhi", "supreme court"] and R.acronyms("Election Commission") == {"ec"}


def test_facts_signatures_and_cover():
    f = R.facts("At least 20 people were killed near Kyoto on Monday, police said.")
    assert f["numbers"] == {"20"} and f["locations"] == {"kyoto"} and f["temporal"] == {"monday"} and f["attribution"] == "trailing" and f["impact"] == ["At least 20 people"]
    assert R.has_fact(f) and not R.has_fact(R.facts("it was quiet")) and R.score(f) > R.score(R.facts("Rain fell."))
    assert R.impact_signature("More than 20 people were killed") == {("20 people", "killed")}
    assert R.covers_signature(["20 people were killed in the fire."], "Officials say 20 people killed") and not R.covers_signature(["20 people were killed."], "30 people were killed.")
    assert R.covers_units(["At a depth of 10 km."], "It was 10 km deep.") and not R.covers_units(["At 10 km."], "12 km away.") and not R.covers_units(["x"], "no number")
    assert R.adds_fact("It spread to Canada, near Calgary.", ["It began."]) and not R.adds_fact("It began slowly.", ["It began."])
    assert R.generic("Fires can occur in dry grass.") and not R.generic("Fires can occur near Spokane.") and R.specificity("At 10:30 near Kyoto, police said, 3 people were injured.") > R.specificity("It was big.")


def test_selection_takes_facts_first_and_explanations_last():
    rows = [_row("Fires can occur in dry grass."), _row("The wind was strong that day."), _row("20,000 residents were evacuated near Spokane on Monday."), _row("Crews saved 12 homes in Cheney on Tuesday.")]
    texts = [r["text"] for r in R.select(rows)]
    assert set(texts[:2]) == {rows[2]["text"], rows[3]["text"]} and rows[0]["text"] not in texts
    assert [r["text"] for r in R.select(rows[:2])] == [rows[1]["text"], rows[0]["text"]]
    own = R.select([_row("Smoke covered the valley near Spokane.", "x:article"), *rows[2:]])
    assert own[0]["item_id"] == "x:article"


def test_summaries_and_their_outcomes():
    rows = [_row("Flames crossed the highway near Cheney on Monday, police said."), _row("More than 300 homes were destroyed in the county by Tuesday.")]
    got = R.summarize(HEAD, rows)
    assert got["status"] == "ok" and len(got["sentences"]) == 2 and got["candidates"] == 2
    assert R.summarize(HEAD, rows[:1])["status"] == "insufficient_information" and R.summarize(HEAD, [])["candidates"] == 0


def test_explanatory_and_article_sentences():
    got = R.explanatory(["Stay tuned", HEAD, "Crews saved 12 homes in Cheney on Tuesday.", "Crews saved 12 homes in Cheney on Tuesday!", "Winds were strong."], HEAD, 4)
    assert got == ["Crews saved 12 homes in Cheney on Tuesday.", "Winds were strong."]
    text = "Related topics\nNo end mark\nThe first line ends here. So does the second one.\nAdvertisement.\nThe first line ends here."
    assert R.article_sentences(text, "") == ["The first line ends here.", "So does the second one."]
    assert R.article_sentences(None, "") == []


def test_truncation():
    assert R.truncated("abc", 10) == "abc" and R.truncated("abcdefghijkl", 10) == "abcdefghi…" and R.truncated("漢字漢字漢字", 9) == "漢字漢字…" and R.visible("&amp;漢") == 3
    assert S.safe_truncate("One two. Three four.", 12) == "One two." and S.safe_truncate("Onetwothree four", 13) == "Onetwothree…"


def test_messages(spark):
    items = spark.createDataFrame([("a", "Live: fire in the valley - Reuters", "Crews saved 12 homes in Cheney. Winds were strong & <cold>.", "S&P", "https://x.org/?a=1&b=2", "NEWS"), ("b", "Head", "One only sentence here.", "s", "u", None)], "story_id string, headline string, summary string, source string, url string, label string")
    got = {r["story_id"]: r["message"] for r in ST.fallback_messages(items).collect()}
    assert got["b"] is None
    assert got["a"] == 'NEWS\n\n<b>Fire in the valley</b>\n\nCrews saved 12 homes in Cheney. Winds were strong &amp; &lt;cold&gt;.\n\n\U0001f4f0 Source: S&amp;P\n\n\U0001f517 <a href="https://x.org/?a=1&amp;b=2">Read the full report</a>'
    short = ST.message(F.col("h"), F.lit("NEWS"), F.col("s"), F.lit("s"), F.lit("u"), 120)
    df = spark.createDataFrame([("H", ["One two three four five six.", "Seven eight nine ten.", "Eleven twelve thirteen.", "Fourteen."]), ("H", ["A" * 300 + ".", "B" * 300 + "."])], "h string, s array<string>")
    one, two = (r[0] for r in df.select(short).collect())
    assert "Seven eight nine ten." in one and "Fourteen" not in one and "…" in two


# the publish loop


def _tables(spark, scheduled, queue, posted=()):
    return (
        spark.createDataFrame(scheduled, "story_id string, scheduled_at timestamp, attempts int"),
        spark.createDataFrame(queue, "story_id string, effective_at timestamp, message string"),
        spark.createDataFrame([(t,) for t in posted], "posted_at timestamp"),
    )


def _ago(**k):
    return NOW - dt.timedelta(**k)


def test_publish_loop(spark):
    calls = []

    def send(story, message):
        calls.append(story)
        if story == "e":
            raise OSError("no")
        return f"m-{story}"

    scheduled = [("a", _ago(minutes=5), 0), ("b", _ago(minutes=4), 0), ("c", _ago(hours=13), 0), ("d", _ago(minutes=3), 0), ("e", _ago(minutes=2), 0), ("f", NOW + dt.timedelta(minutes=1), 0), ("g", None, 0), ("h", _ago(minutes=1), 0), ("m", _ago(minutes=1), 0)]
    queue = [("a", _ago(hours=1), "A"), ("b", _ago(hours=7), "B"), ("d", _ago(hours=1), None), ("e", _ago(hours=1), "E"), ("f", NOW, "F"), ("g", None, "G"), ("h", _ago(hours=1), "H")]
    t = _tables(spark, scheduled, queue)
    report = PUB.publish_due(*t, NOW, send)
    got = {r["story_id"]: (r["fate"], r["attempts"], r["detail"]) for r in report.collect()}
    assert got == {"a": ("posted", 0, "m-a"), "b": ("expired", 0, "no longer fresh"), "c": ("expired", 0, "missing for long"), "d": ("expired", 0, "no usable content"), "e": ("retry", 1, "no"), "g": ("posted", 0, "m-g"), "h": ("posted", 0, "m-h"), "m": ("missing", 0, "")}
    assert calls == ["g", "a", "e", "h"]
    left = {r["story_id"]: r["attempts"] for r in PUB.next_schedule(t[0], report).collect()}
    assert left == {"e": 1, "f": 0, "m": 0}


def test_caps_gaps_and_rate_limits(spark):
    scheduled = [(s, _ago(minutes=5), 1) for s in "abc"]
    queue = [(s, _ago(hours=1), s) for s in "abc"]
    t = _tables(spark, scheduled, queue, [_ago(minutes=30), _ago(hours=5)])
    fates = lambda report: [r["fate"] for r in report.collect()]
    assert fates(PUB.publish_due(*t, NOW, lambda s, m: "x", per_hour=2)) == ["posted", "cap", "cap"]
    assert fates(PUB.publish_due(*t, NOW, lambda s, m: "x", per_day=3)) == ["posted", "cap", "cap"]
    assert fates(PUB.publish_due(*t, NOW, lambda s, m: "x", gap_seconds=3600)) == ["gap"] * 3
    assert fates(PUB.publish_due(*t, NOW, lambda s, m: "x", gap_seconds=60)) == ["posted", "gap", "gap"]
    limits = {"n": 0}

    def limited(s, m, after=60.0):
        limits["n"] += 1
        if limits["n"] % 2:
            raise PUB.RateLimited(after)
        return "x"

    assert fates(PUB.publish_due(*t, NOW, limited)) == ["rate_limited"]
    limits["n"], slept = 0, []
    assert fates(PUB.publish_due(*t, NOW, limited, wait=slept.append)) == ["posted"] * 3 and slept == [60.0] * 3
    limits["n"] = 0
    assert fates(PUB.publish_due(*t, NOW, lambda s, m: limited(s, m, 91.0), wait=slept.append)) == ["rate_limited"]
    assert fates(PUB.publish_due(*t, NOW, lambda s, m: 1 / 0)) == ["failed"] * 3
    assert fates(PUB.publish_due(*t, NOW, lambda s, m: 1 / 0, dry_run=True)) == ["dry_run"] * 3
    assert fates(PUB.simulate(t[1], t[2], NOW, per_hour=1)) == ["cap"] * 3


def test_a_dry_run_sends_no_row_to_the_driver(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame as Classic

    old, new = NOW - dt.timedelta(hours=9), NOW - dt.timedelta(hours=1)
    queue = spark.createDataFrame([("a", new, "x"), ("b", old, "x"), ("c", new, ""), ("d", new, None), ("e", None, "x"), (None, new, "x")], "story_id string, effective_at timestamp, message string")
    posted = spark.createDataFrame([(NOW - dt.timedelta(seconds=40),)], "posted_at timestamp")
    monkeypatch.setattr(Classic, "toLocalIterator", lambda *_: pytest.fail("rows on the driver"))
    got = lambda **rules: [(r["story_id"], r["fate"], r["detail"]) for r in PUB.simulate(queue, posted, NOW, **rules).collect()]
    late = ("b", "expired", "no longer fresh")
    assert got() == [(None, "missing", ""), ("a", "dry_run", ""), late, ("c", "expired", "no usable content"), ("d", "expired", "no usable content"), ("e", "dry_run", "")]
    assert got(gap_seconds=60) == [(None, "missing", ""), ("a", "gap", "20"), late, ("c", "gap", "20"), ("d", "gap", "20"), ("e", "gap", "20")]


def test_rate_limits_by_brute_force(spark):
    import random

    rng = random.Random(5)
    rows = [(k, rng.choice("ab"), NOW + dt.timedelta(seconds=rng.randrange(100_000))) for k in range(400)]
    df = spark.createDataFrame(rows, "id long, key string, at timestamp")
    got = {r["id"]: r["verdict"] for r in P.rate_limited(df, "key", "at", "id", 5, 40, 30.0).collect()}
    for key in "ab":
        sent = []
        for i, _, t in sorted((r for r in rows if r[1] == key), key=lambda r: (r[2], r[0])):
            day = [x for x in sent if (t - x).total_seconds() < 86400]
            hour = [x for x in day if (t - x).total_seconds() < 3600]
            want = "gap" if day and (t - day[-1]).total_seconds() < 30 else "hour" if len(hour) >= 5 else "day" if len(day) >= 40 else "sent"
            assert got[i] == want
            if want == "sent":
                sent.append(t)


def test_schedules_repeat_and_keep_their_bounds(spark):
    rows = [(f"s{k}", ("IMMEDIATE", "HIGH", "NORMAL")[k % 3], float(k)) for k in range(90)]
    df = spark.createDataFrame(rows, "story_id string, priority string, age_minutes double")
    one, two = ({r["story_id"]: r["delay_seconds"] for r in P.schedule(df, F.lit(NOW).cast("timestamp"), seed).collect()} for seed in (1, 1))
    other = {r["story_id"]: r["delay_seconds"] for r in P.schedule(df, F.lit(NOW).cast("timestamp"), 2).collect()}
    assert one == two != other
    for s, level, age in rows:
        assert one[s] == 0 if level == "IMMEDIATE" else (60 <= one[s] <= 240 if age <= 15 else 120 <= one[s] <= 420)


def test_streams(spark, tmp_path):
    at = lambda s: NOW + dt.timedelta(seconds=s)
    rows = [(k, "a", at(k * 60), f"u{k % 3}") for k in range(6)]
    schema = "id long, key string, at timestamp, url string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    got = []

    def sink(batch, _):
        got.extend(batch.collect())

    PUB.run_once(PUB.rate_limiter(stream(), "key", "at", "id", 4, 100), sink, str(tmp_path / "c1")).awaitTermination()
    assert sorted((r["id"], r["verdict"]) for r in got) == [(k, "sent" if k < 4 else "hour") for k in range(6)]
    got.clear()
    PUB.run_once(PUB.distinct_urls(stream(), "at", "url"), sink, str(tmp_path / "c2")).awaitTermination()
    assert sorted(r["url"] for r in got) == ["u0", "u1", "u2"]
    got.clear()
    PUB.run_once(PUB.windowed_counts(stream(), "at", ["key"]), sink, str(tmp_path / "c3"), "complete").awaitTermination()
    assert [(r["key"], r["n"]) for r in got] == [("a", 6)]


# terms and packs


def test_terms_apart_and_by_stem():
    m = M.Matcher([M.Group("t", ("attack", "supreme court", "supreme court of india", "court of india"), apart=True, stems=True), M.Group("g", ("supreme court", "supreme court of india", "india"))])
    got = m.terms("Attacks at the Supreme Court of India; counterattack, attackers, attacked.", "title")
    assert got["t/title"] == ["attack", "supreme court", "supreme court of india", "court of india"] and got["g/title"] == ["supreme court of india"]
    assert "t^title" in got and "g^title" not in got


def test_false_positives_suppress_what_overlaps_them():
    m = M.Matcher([M.Group("c", ("surat", "india"), under="fp"), M.Group("d", ("surat",))], {"fp": ["Surat Thani", "Indianapolis"]})
    got = m.terms("Surat Thani and Surat, Indianapolis", "title")
    assert got["c/title"] == ["surat"] and got["d/title"] == ["surat"]
    assert m.terms("In Surat Thani", "title") == {"d/title": ["surat"]}
    assert M.find_spans("Surat Thani or surat", {"c": ["surat"]}, ["surat thani"]) == [{"grp": "c", "term": "surat", "location": "title", "start": 15, "stop": 20}]


def test_matcher_agrees_with_regular_expressions(spark, sf):
    import re

    texts = [r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    groups = {f"r {k}": tuple(v) for k, v in DEMO.relevance.items()}
    m = M.Matcher([M.Group(k, v) for k, v in groups.items()])
    for t in texts:
        low, want = t.lower(), {}
        for k, v in groups.items():
            hits = [x.group() for x in re.finditer(rf"(?<!\w)(?:{'|'.join(map(re.escape, M.ordered(v)))})(?!\w)", low)]
            if hits:
                want[f"{k}/x"] = list(dict.fromkeys(hits))
        assert {k: v for k, v in m.terms(t, "x").items() if "/" in k} == want


def test_signal_rows_and_term_counts(spark):
    df = spark.createDataFrame([(1, "Reports started", "the report of the day"), (2, None, None)], "ord long, title string, summary string")
    got = {tuple(r) for r in SC.signal_rows(df, DEMO).where("category = 'doings'").collect()}
    assert got == {(1, "doings", "title", "report"), (1, "doings", "title", "start"), (1, "doings", "summary", "the"), (1, "doings", "summary", "report"), (1, "doings", "summary", "of the")}
    assert {tuple(r) for r in SC.term_counts(df, ["report", "day"]).collect()} == {("report", 1), ("day", 1)}


def test_relevance_groups():
    got = packs.relevance_groups(core=["homeland", "indigenous"], institutions=["Parliament"], figures=["president"], places=["north"], context=["trade talks", "homeland border"], markers=["parliament", "budget", "national", "trade talks"], home=["homeland"], not_core=["indigenous"])
    assert got == {"core": ["homeland"], "institution": ["parliament"], "figure": ["president"], "geo": ["north"], "significance": ["budget"], "specific_intl": ["homeland border"], "intl": ["trade talks"]}


def test_packs_load_and_say_what_is_wrong(tmp_path):
    p = tmp_path / "pack.json"
    p.write_text(json.dumps({"relevance": {"core": ["a"]}, "categories": [{"id": "c", "terms": ["x"], "importance": 9}], "cities": {"z": "nowhere"}}))
    with pytest.raises(ValueError, match=r"categories\.c\.importance.*cities\.z"):
        packs.load(p)
    p.write_text(json.dumps({"what": 1}))
    with pytest.raises(ValueError, match="unknown key"):
        packs.load(p)
    p.write_text(json.dumps({"relevance": {"core": ["a"]}}))
    assert packs.load(p).relevance == {"core": ["a"]} and packs.deep_merge({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}}) == {"a": {"b": 3, "c": 2}}


def test_headlines_and_urls(spark):
    df = spark.createDataFrame([("Watch: the river rises | BBC World",), ("Update - of the times - The Times of India",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(T.clean_headline(F.col("t"))).collect()] == ["The river rises", "Of the times", None, ""]
    urls = spark.createDataFrame([("https://x.org/news/world",), ("https://x.org/news/Video/1",), (None,), ("https://go.org/a",)], "u string")
    assert [r[0] for r in urls.select(T.non_article_url(F.col("u"), ("video",), ("go.org",))).collect()] == [False, True, True, True]


def test_mass_casualties():
    assert S.has_mass_casualty("Two people were killed in the crash.") and S.has_mass_casualty("At least 12 injured") and not S.has_mass_casualty("No one was hurt. One person died.")


def test_texts_go_to_python_in_small_batches(spark, sf):
    from skein import queries as Q

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        for query in (Q.editorial_decision, Q.relevance_score, Q.article_sentences, Q.sentence_split):
            spark.conf.set(key, "10000")
            query(spark, sf)
            assert spark.conf.get(key) == "1024"
        spark.conf.set(key, "77")
        Q.sentence_split(spark, sf)
        assert spark.conf.get(key) == "77"
    finally:
        spark.conf.set(key, before)


def test_only_the_sentences_needed_are_cut(monkeypatch):
    text = "Dr. A. B. Smith of St. Mary said that harbour work begins. " + " ".join(f"Report {k} covers district number {k} and its {w} river." for k, w in enumerate("old new wide long deep cold warm calm".split() * 9))
    assert S.split(text)[0].startswith("Dr. A. B. Smith") and len(S.split(text)) == 73
    cuts, plain = [], S.each
    monkeypatch.setattr(S, "each", lambda t: (cuts.append(1) or s for s in plain(t)))
    assert R.explanatory(S.each(text), "x") == R.explanatory(S.split(text), "x")
    cuts.clear()
    R.explanatory(S.each(text), "x")
    assert len(cuts) < 20

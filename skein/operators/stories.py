"""Stories: second grouping, briefings, summaries and messages."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import headlines as H
from ..functions import rows as R
from ..functions import sentences as S
from ..functions import text as T
from .events import components

GROUP_HOURS = 72.0
SUMMARY = "struct<sentences: array<struct<text: string, source: string, item_id: string, composed: boolean>>, status: string, problems: array<string>, candidates: int>"


def story_facts(headline: str) -> dict[str, list[str]]:
    """What two stories are matched by."""
    f = {"names": H.names, "actions": H.actions, "units": H.units, "large": H.large_numbers, "topic": H.topic}
    return {k: list(v(headline)) for k, v in f.items()}


def same_story(a: dict, b: dict, hours: float = GROUP_HOURS) -> bool:
    """One event_id; else within the window, with no other number of one unit and no other places, two shared
    names with a shared action, corroborating numbers or a topic similarity of 0.3, or one shared name and
    action with a second action, corroborating numbers or a topic similarity of 0.15."""
    if a["event_id"] and a["event_id"] == b["event_id"]:
        return True
    if pd.notna(a["at"]) and pd.notna(b["at"]) and abs((a["at"] - b["at"]).total_seconds()) > hours * 3600:
        return False
    # the last number of a unit counts
    x, y = (dict(u.split("=") for u in r["units"]) for r in (a, b))
    if any(x[u] != y[u] for u in x.keys() & y.keys()):
        return False
    places = [set(r["names"]) & H.PLACES for r in (a, b)]
    if all(places) and not places[0] & places[1]:
        return False
    shared = {k: set(a[k]) & set(b[k]) for k in ("names", "actions", "units", "large", "topic")}
    both = set(a["topic"]) | set(b["topic"])
    corroborated = bool(shared["units"] or shared["large"])
    topic = len(shared["topic"]) / len(both) if both else 0.0
    if len(shared["names"]) >= 2 and (shared["actions"] or corroborated or topic >= 0.3):
        return True
    return bool(shared["names"] and shared["actions"]) and (len(shared["actions"]) >= 2 or corroborated or topic >= 0.15)


def group_stories(items: DataFrame, hours: float = GROUP_HOURS) -> DataFrame:
    """(story_id, group_id): first fit in queue order; a story joins the first group whose primary
    (highest score, then primary source, then tier) matches it by ``same_story``.

    Stories match only if they share a name within the window or an event_id, so pairs are made by these keys, names with
    the window's length of time or the next, and tested; the first fit is run within each connected component of the
    matching pairs, and looks groups up by the same keys."""
    sets = ("names", "actions", "units", "large", "topic")
    cols = ["story_id", "event_id", "at", "headline", "priority_score", "primary_source", "tier", "queue_rank"]
    found = F.pandas_udf(lambda headlines: pd.DataFrame([story_facts(t or "") for t in headlines], columns=list(sets)), ", ".join(f"{k} array<string>" for k in sets))
    f = items.select(*cols).withColumn("f", found("headline")).select(*[c for c in cols if c != "headline"], "f.*")
    f = f.withColumn("ord", F.monotonically_increasing_id()).checkpoint()
    keys = F.transform("names", lambda x: F.concat(F.lit("n"), x))
    keys = F.when(F.col("event_id") != "", F.array_append(keys, F.concat(F.lit("e"), "event_id"))).otherwise(keys)
    step = hours * 3600 or 1.0
    span = F.when(F.col("key").startswith("e"), F.lit(0)).otherwise(F.floor(F.col("at").cast("double") / step)).cast("long")
    index = f.select("ord", "at", F.explode(keys).alias("key")).select("ord", "key", span.alias("span"))
    after = index.select(F.col("ord").alias("o"), "key", F.explode(F.array(F.col("span"), F.col("span") - 1)).alias("span"))
    both = index.join(after, ["key", "span"]).select("ord", "o")
    # those without a time meet all of their names
    both = both.union(index.where("span is null").select("ord", "key").join(index.select(F.col("ord").alias("o"), "key"), "key").select("ord", "o"))
    pairs = both.where("ord != o").select(F.least("ord", "o").alias("a"), F.greatest("ord", "o").alias("b")).distinct()
    side = lambda k: f.select(F.col("ord").alias(k), F.struct("event_id", "at", *sets).alias(f"{k}_f"))

    @F.pandas_udf("boolean")
    def matches(a: pd.DataFrame, b: pd.DataFrame) -> pd.Series:
        return pd.Series([same_story(x, y, hours) for x, y in zip(records(a), records(b))], dtype=bool)

    def records(pdf: pd.DataFrame) -> list[dict]:
        return pdf.to_dict("records")

    pairs = pairs.join(side("a"), "a").join(side("b"), "b").where(matches("a_f", "b_f")).select("a", "b")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["queue_rank", "story_id"], kind="stable")
        # each group's first and primary story, and groups by key of a primary; what an earlier primary left there is tested and not met
        first, top, by, out = [], [], defaultdict(set), []
        worth = lambda x: (x["priority_score"], bool(x["primary_source"]), -x["tier"])

        def spot(r: dict) -> int | None:
            return None if pd.isna(r["at"]) else int(r["at"].timestamp() // step)

        def leads(r: dict, g: int) -> None:
            for x in r["names"]:
                by["n", x].add(g)
                by["n", x, spot(r)].add(g)
            by["e", r["event_id"]].add(g)

        for r in records(pdf):
            at = spot(r)
            met = set().union(*(by.get(("n", x, *p), ()) for x in r["names"] for p in ([()] if at is None else [(None,), (at - 1,), (at,), (at + 1,)])))
            met |= by.get(("e", r["event_id"]), set()) if r["event_id"] else set()
            g = next((g for g in sorted(met) if same_story(top[g], r, hours)), None)
            if g is None:
                g = len(first)
                first.append(r)
                top.append(r)
                leads(r, g)
            elif worth(r) > worth(top[g]):
                top[g] = r
                leads(r, g)
            out.append((r["story_id"], first[g]["story_id"]))
        return pd.DataFrame(out, columns=["story_id", "group_id"])

    # a story that no other matches is a group of its own and needs no pass
    pairs = pairs.checkpoint()
    paired = pairs.select(F.explode(F.array("a", "b")).alias("ord")).distinct()
    linked = f.join(paired, "ord", "left_semi").checkpoint()
    grouped = linked.join(components(linked, pairs), "ord").groupBy("root").applyInPandas(run, "story_id string, group_id string")
    return grouped.union(f.join(paired, "ord", "left_anti").select("story_id", F.col("story_id").alias("group_id")))


def group_primary(items: DataFrame) -> DataFrame:
    """Each group's primary story."""
    order = [F.desc("priority_score"), F.desc("primary_source"), F.asc("tier"), F.asc("queue_rank"), F.asc("story_id")]
    return items.withColumn("__rn", F.row_number().over(Window.partitionBy("group_id").orderBy(*order))).where("__rn = 1").drop("__rn")


def aggregate_sentences(items: DataFrame) -> DataFrame:
    """One row per group: its sentence rows, primary's first, cleaned, without paraphrases of the headline, repeats and near repeats.

    Groups come one after another in a task's rows, so that small ones cost no call each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group = None
        made = lambda rows: pd.DataFrame(rows, columns=["group_id", "headline", "rows"])
        for pdf in batches:
            done = []
            for g, story, headline, source, text in zip(*(pdf[c] for c in ("group_id", "story_id", "headline", "source", "text"))):
                if group is None or g != group[0]:
                    done += [] if group is None else [group]
                    group, known = (g, headline or "", []), S.Kept()
                for s in map(S.clean_sentence, S.split(S.repair(text))):
                    if s and not S.is_filler(s) and not S.paraphrases(s, group[1]) and not known.has(s):
                        group[2].append({"text": s, "source": source, "item_id": story})
                        known.add(s)
            yield made(done)
        if group is not None:
            yield made([group])

    order = [F.desc("priority_score"), F.desc("primary_source"), F.asc("tier"), F.asc("queue_rank"), F.asc("story_id")]
    placed = items.withColumn("place", F.row_number().over(Window.partitionBy("group_id").orderBy(*order)))
    rows = placed.select("group_id", "story_id", "headline", "source", "text", "place")
    # a number of its own: rows are few and their work is much, so partitions are not to be merged by size
    rows = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "group_id").sortWithinPartitions("group_id", "place")
    return rows.mapInPandas(run, "group_id string, headline string, rows array<struct<text: string, source: string, item_id: string>>")


def summarize(groups: DataFrame, least: int = 2, most: int = 4) -> DataFrame:
    """Adds ``summary``: sentences, status (ok, insufficient_information, verification, quality), problems."""

    @F.pandas_udf(SUMMARY)
    def run(headlines: pd.Series, rows: pd.Series) -> pd.DataFrame:
        got = [R.summarize(h or "", [dict(r) for r in (rs if rs is not None else [])], least, most) for h, rs in zip(headlines, rows)]
        return pd.DataFrame(got, columns=["sentences", "status", "problems", "candidates"])

    return groups.withColumn("summary", run("headline", "rows"))


def public_label(score: Column, status: Column, urgent: Column, confidence: Column, primary: Column, corroborated: Column, category: Column, age: Column) -> Column:
    """UPDATE, BREAKING, JUST IN or NEWS, the first that holds."""
    sure = confidence != "low"
    label = F.when(status.isNotNull() & (score >= 60), "UPDATE").when(urgent & sure & (score >= 80) & (primary | corroborated) & category.isNotNull(), "BREAKING")
    return label.when((age >= 0) & (age <= 15) & sure & (score >= 60), "JUST IN").otherwise("NEWS")


def briefing(summaries: DataFrame) -> DataFrame:
    """opening (first two sentences), body (the rest), corroborating (other sources, in order)."""
    texts = F.transform("summary.sentences", lambda s: s["text"])
    sources = F.array_distinct(F.transform("rows", lambda r: r["source"]))
    out = summaries.withColumn("opening", F.slice(texts, 1, 2)).withColumn("body", F.when(F.size(texts) > 2, F.slice(texts, 3, 1 << 20)).otherwise(F.array().cast("array<string>")))
    return out.withColumn("corroborating", F.when(F.size(sources) > 1, F.slice(sources, 2, 1 << 20)).otherwise(F.array().cast("array<string>")))


def message(headline: Column, label: Column, sentences: Column, source: Column, url: Column, most: int = 3000) -> Column:
    """HTML message: label, headline, one paragraph, source and link; null with fewer than two sentences. Over the
    limit, sentences go from the end down to two, and then the paragraph is cut at a sentence or a character."""
    lines = lambda paragraph: F.array_join(
        F.array_compact(
            F.array(
                F.nullif(T.escape_html(label), F.lit("")), F.concat(F.lit("<b>"), T.escape_html(headline), F.lit("</b>")), paragraph,
                F.concat(F.lit("\U0001f4f0 Source: "), T.escape_html(F.coalesce(source, F.lit("Unknown")))), F.concat(F.lit('\U0001f517 <a href="'), T.escape_html_attr(url), F.lit('">Read the full report</a>')),
            )
        ),
        "\n\n",
    )
    with_n = lambda n: lines(T.escape_html(F.array_join(F.slice(sentences, 1, n), " ")))

    @F.pandas_udf("string")
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: S.safe_truncate(t, most) if t and R.visible(t) > most else t)

    fit = F.when(T.visible_length(with_n(4)) <= most, with_n(4)).when(T.visible_length(with_n(3)) <= most, with_n(3)).when(T.visible_length(with_n(2)) <= most, with_n(2))
    return F.when(F.size(sentences) >= 2, fit.otherwise(lines(cut(T.escape_html(F.array_join(F.slice(sentences, 1, 2), " "))))))


def fallback_messages(items: DataFrame, most: int = 3000) -> DataFrame:
    """(story_id, message) for stories without a briefing: the useful sentences of their summary in the same form; null with fewer than two."""

    @F.pandas_udf("array<string>")
    def useful(summaries: pd.Series, headlines: pd.Series) -> pd.Series:
        return pd.Series([R.explanatory(S.each(s), h) for s, h in zip(summaries, headlines)])

    found = items.withColumn("__h", T.clean_headline(F.col("headline"))).withColumn("__s", useful("summary", "__h"))
    return found.select("story_id", message(F.col("__h"), F.col("label"), F.col("__s"), F.col("source"), F.col("url"), most).alias("message"))


def summary_counts(summaries: DataFrame) -> DataFrame:
    """How many groups each outcome had, with the candidate rows and the faults found."""
    return summaries.groupBy(F.col("summary.status").alias("status")).agg(F.count("*").alias("groups"), F.sum("summary.candidates").alias("candidates"), F.sum(F.size("summary.sentences")).cast("long").alias("sentences"), F.sum(F.size("summary.problems")).cast("long").alias("faults"))


def fault_counts(summaries: DataFrame) -> DataFrame:
    return summaries.select(F.explode("summary.problems").alias("fault")).groupBy("fault").agg(F.count("*").alias("n"))


def bullets(rows: Column) -> Column:
    """Location, status, impact and next steps: the first sentence for each."""
    find = lambda p: F.get(F.filter(rows, lambda r: r["text"].rlike(p)), F.lit(0))["text"]
    made = [(label, find(p)) for label, p in (("Location", r"\b(?:in|at|near)\s+\p{Lu}"), ("Status", r"(?i)\b(?:confirmed|ongoing|suspended|approved|rescue|under way|underway)\b"), ("Impact", r"(?i)\b(?:killed|injured|damaged|evacuated|displaced|affected)\b"), ("Next", r"(?i)\b(?:will|expected to|scheduled|next week|tomorrow)\b"))]
    return F.array_compact(F.array(*[F.when(v.isNotNull(), F.struct(F.lit(k).alias("label"), v.alias("text"))) for k, v in made]))

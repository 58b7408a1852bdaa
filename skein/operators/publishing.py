"""From candidates to posts: freshness, caps with protected rows, schedules, rate limits, retries and state."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.fetching import Robots, Rules, fetch_article

FRESH_HOURS, RETENTION_HOURS, MARGIN_HOURS = 6.0, 48.0, 6.0
PER_HOUR, PER_DAY, MISSING_HOURS = 40, 150, 12.0


def freshness(df: DataFrame, now: Column, at: str = "effective_at", hours: float = FRESH_HOURS, excluded: DataFrame | None = None, source: str = "source_id") -> DataFrame:
    """Adds ``fate``: non_news, no_effective_at, stale or fresh."""
    out = df
    if excluded is not None:
        gone = excluded.select(F.col(source).alias("__x")).distinct().withColumn("__non_news", F.lit(True))
        out = out.join(gone, F.col(source) == F.col("__x"), "left").drop("__x")
    else:
        out = out.withColumn("__non_news", F.lit(None).cast("boolean"))
    age = (now.cast("double") - F.col(at).cast("double")) / 3600
    fate = F.when(F.col("__non_news"), "non_news").when(F.col(at).isNull(), "no_effective_at").when((age < 0) | (age > hours), "stale").otherwise("fresh")
    return out.withColumn("fate", fate).drop("__non_news")


def fate_counts(df: DataFrame) -> DataFrame:
    c = lambda v: F.count_if(F.col("fate") == v).alias(v)
    return df.agg(F.count("*").alias("candidates"), c("non_news"), c("no_effective_at"), c("stale"), c("fresh"))


def top_with_protected(df: DataFrame, protected: DataFrame, key: str, order: list[Column], most: int) -> DataFrame:
    """The first ``most`` rows by order, and every protected row beyond them."""
    top = df.orderBy(*order).limit(most)
    rest = df.join(protected.select(key).distinct(), key, "left_semi").join(top.select(key), key, "left_anti")
    return top.withColumn("why", F.lit("top")).unionByName(rest.withColumn("why", F.lit("protected")))


def unseen(df: DataFrame, *seen: DataFrame, key: str = "story_id") -> DataFrame:
    """Rows whose key no history has."""
    for s in seen:
        df = df.join(s.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")
    return df


def pruned(posted: DataFrame, now: Column, at: str = "posted_at", hours: float = RETENTION_HOURS + MARGIN_HOURS) -> DataFrame:
    return posted.where((now.cast("double") - F.col(at).cast("double")) <= hours * 3600)


def important(df: DataFrame) -> Column:
    """HIGH and IMMEDIATE, exclusives and just-in stories; URGENT too, which the documents promise."""
    return F.col("priority").isin("IMMEDIATE", "URGENT", "HIGH") | F.col("label").isin("EXCLUSIVE", "JUST IN")


def schedule(df: DataFrame, now: Column, seed: int = 0, immediate: bool = True, key: str = "story_id", normal=(120, 420), urgent=(60, 240), young_minutes: float = 15.0) -> DataFrame:
    """Adds delay_seconds and scheduled_at; the spread comes from a hash of the key and the seed, so it repeats."""
    spread = lambda lo, hi: F.lit(lo) + F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(hi - lo + 1))
    now_level = F.col("priority") == "IMMEDIATE"
    delay = F.when(now_level & F.lit(immediate), F.lit(0)).when(now_level | (F.col("age_minutes") <= young_minutes), spread(*urgent)).otherwise(spread(*normal))
    return df.withColumn("delay_seconds", delay.cast("int")).withColumn("scheduled_at", F.timestamp_seconds(now.cast("double") + F.col("delay_seconds")))


def rolling_counts(posts: DataFrame, key: str, at: str, ids: str) -> DataFrame:
    """Posts of the same key in the last hour and day before each post, itself excluded."""
    seconds = F.unix_micros(F.col(at).cast("timestamp"))
    w = Window.partitionBy(key).orderBy("__us")
    before = lambda s: F.count("*").over(w.rangeBetween(-s * 1_000_000, -1))
    return posts.withColumn("__us", seconds).withColumn("last_hour", before(3600)).withColumn("last_day", before(86400)).select(ids, key, at, "last_hour", "last_day")


def rate_limited(posts: DataFrame, key: str, at: str, ids: str, per_hour: int = PER_HOUR, per_day: int = PER_DAY, gap_seconds: float = 0.0) -> DataFrame:
    """Greedy admission per key in order of time: an admitted post counts against those after it. Adds ``verdict``: sent, gap, hour or day.

    Streams each key's sorted rows through one worker; the state is the admitted times of one day."""

    def run(batches):
        name, sent = None, []
        for pdf in batches:
            out = []
            for k, t in zip(pdf[key], pdf["__s"]):
                if k != name:
                    name, sent = k, []
                sent = [x for x in sent if t - x < 86400]
                if sent and t - sent[-1] < gap_seconds:
                    out.append("gap")
                elif sum(t - x < 3600 for x in sent) >= per_hour:
                    out.append("hour")
                elif len(sent) >= per_day:
                    out.append("day")
                else:
                    sent.append(t)
                    out.append("sent")
            yield pd.DataFrame({ids: pdf[ids], key: pdf[key], "verdict": out})

    rows = posts.select(ids, key, (F.unix_micros(F.col(at).cast("timestamp")) / 1e6).alias("__s")).repartition(F.col(key)).sortWithinPartitions(key, "__s", ids)
    types = dict(posts.dtypes)
    return rows.mapInPandas(run, f"{ids} {types[ids]}, {key} {types[key]}, verdict string")


def publish_step(due: DataFrame, queue: DataFrame, now: Column, max_attempts: int = 2, outcome: str = "outcome") -> DataFrame:
    """What becomes of scheduled rows (story_id, scheduled_at, attempts, outcome of sending):
    posted, retry, failed, expired, missing or waiting. ``queue`` has story_id and effective_at."""
    q = queue.select("story_id", "effective_at").withColumn("__there", F.lit(True))
    both = due.join(q, "story_id", "left")
    late = (now.cast("double") - F.col("scheduled_at").cast("double")) / 3600
    age = (now.cast("double") - F.col("effective_at").cast("double")) / 3600
    fate = (
        F.when(F.col("scheduled_at") > now, "waiting")
        .when(F.col("__there").isNull(), F.when(late > MISSING_HOURS, "expired").otherwise("missing"))
        .when(age > FRESH_HOURS, "expired")
        .when(F.col(outcome) == "ok", "posted")
        .when(F.col(outcome) == "rate_limited", "waiting")
        .when(F.col("attempts") + 1 >= max_attempts, "failed")
        .otherwise("retry")
    )
    return both.withColumn("fate", fate).withColumn("attempts", F.when(F.col("fate").isin("failed", "retry"), F.col("attempts") + 1).otherwise(F.col("attempts"))).drop("__there")


def scheduler_order(df: DataFrame, most: int | None = None) -> DataFrame:
    """Candidates for the schedule: important ones first, then by priority score and youth; with ``most``, the first that many."""
    out = df.orderBy(~F.coalesce(important(df), F.lit(False)), F.desc(F.coalesce("priority_score", F.lit(0.0))), F.coalesce("age_minutes", F.lit(0.0)), "story_id")
    return out if most is None else out.limit(most)


def due_order(df: DataFrame, now: Column) -> DataFrame:
    return df.where(F.col("scheduled_at") <= now).orderBy("scheduled_at", "story_id")


def retry_delay(attempt: Column) -> Column:
    return F.least(F.lit(120.0), 5.0 * F.pow(F.lit(2.0), attempt))


def failure_runs(df: DataFrame, key: str, at: str, failed: Column, ids: str) -> DataFrame:
    """Running totals and failures in a row, which a success starts again."""
    w = Window.partitionBy(key).orderBy(at, ids).rowsBetween(Window.unboundedPreceding, 0)
    out = df.withColumn("__f", failed.cast("int")).withColumn("total_errors", F.sum("__f").over(w)).withColumn("__run", F.sum(1 - F.col("__f")).over(w))
    run = Window.partitionBy(key, "__run").orderBy(at, ids).rowsBetween(Window.unboundedPreceding, 0)
    return out.withColumn("consecutive_failures", F.sum("__f").over(run)).drop("__f", "__run")


def minimum_gap(df: DataFrame, key: str, at: str, ids: str) -> DataFrame:
    """Seconds since the row before of the same key."""
    w = Window.partitionBy(key).orderBy(at, ids)
    us = F.unix_micros(F.col(at).cast("timestamp"))
    return df.withColumn("gap_seconds", (us - F.lag(us).over(w)) / 1_000_000)


def enrichment_plan(stories: DataFrame, cache: DataFrame, now: Column, budget: int) -> DataFrame:
    """Adds ``plan`` to eligible stories: cached, fetch (the first ``budget`` misses by rank) or skipped."""
    live = cache.where((now.cast("double") - F.col("fetched_at").cast("double")) <= F.col("ttl_hours") * 3600).select("story_id", F.col("status").alias("cache_status"))
    need = (F.col("priority").isin("IMMEDIATE", "URGENT", "HIGH") | F.col("label").isin("JUST IN", "UPDATE") | (F.col("priority_score") >= 65)) & (F.col("n_sentences") < 2)
    both = stories.join(live, "story_id", "left").withColumn("__need", need)
    misses = both.where("__need and cache_status is null").orderBy("queue_rank", "story_id").limit(budget).select("story_id", F.lit(True).alias("__go"))
    plan = F.when(~F.col("__need"), "not_needed").when(F.col("cache_status").isNotNull(), "cached").when(F.col("__go"), "fetch").otherwise("skipped")
    return both.join(misses, "story_id", "left").withColumn("plan", plan).drop("__need", "__go")


def enriched(plan: DataFrame, get, rules: Rules, resolve) -> DataFrame:
    """Run the planned fetches on the executors: story_id, fetch_status, article_text. ``get(url)`` gives an ``Answer`` or raises, ``resolve(host)`` its addresses."""

    def run(batches):
        robots = Robots(get)
        for pdf in batches:
            got = [fetch_article(u, get, rules, resolve, robots)[:2] for u in pdf["url"]]
            yield pd.DataFrame({"story_id": pdf["story_id"], "fetch_status": [s for s, _ in got], "article_text": [t for _, t in got]})

    return plan.where("plan = 'fetch'").select("story_id", "url").mapInPandas(run, "story_id string, fetch_status string, article_text string")


def with_partners(plan: DataFrame, fetched: DataFrame) -> DataFrame:
    """Adds article_text and text_from to stories: their own page, else that of the best other member of their group, else none."""
    ok = fetched.where("fetch_status = 'ok'").select("story_id", "article_text")
    members = plan.select("story_id", "group_id", "queue_rank").join(ok, "story_id")
    best = members.groupBy("group_id").agg(F.min_by(F.struct(F.col("story_id").alias("other"), F.col("article_text").alias("text")), F.struct("queue_rank", "story_id")).alias("b"))
    both = plan.join(ok, "story_id", "left").join(best, "group_id", "left")
    return both.withColumn("text_from", F.when(F.col("article_text").isNotNull(), F.col("story_id")).otherwise(F.col("b.other"))).withColumn("article_text", F.coalesce("article_text", F.col("b.text"))).drop("b")


def extraction_counts(fetched: DataFrame) -> DataFrame:
    """How many pages came to each status."""
    return fetched.groupBy("fetch_status").agg(F.count("*").alias("n"))

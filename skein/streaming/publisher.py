"""Publishing: the loop over due posts, and the batch stages on a stream: late rows cut, repeats dropped, hourly counts, a stateful rate limiter."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


MISSING_SECONDS, WAIT_SECONDS, WAIT_IN_ALL = 12 * 3600, 90.0, 180.0
REPORT = "story_id string, fate string, attempts int, detail string"


class RateLimited(Exception):
    """The channel asks to wait."""

    def __init__(self, retry_after: float):
        super().__init__(f"retry after {retry_after:g} s")
        self.retry_after = retry_after


def due_posts(scheduled: DataFrame, queue: DataFrame, now: dt.datetime) -> DataFrame:
    """What is due, in order, with its story: queue has story_id, effective_at and message. Entries without a time are due."""
    at = F.lit(now).cast("timestamp")
    due = scheduled.where(F.col("scheduled_at").isNull() | (F.col("scheduled_at") <= at)).select("story_id", "scheduled_at", F.coalesce("attempts", F.lit(0)).alias("attempts"))
    q = queue.select("story_id", "effective_at", "message").withColumn("there", F.lit(True))
    seconds = lambda c: at.cast("double") - F.col(c).cast("double")
    joined = due.join(q, "story_id", "left").withColumn("late", seconds("scheduled_at")).withColumn("age", seconds("effective_at"))
    return joined.orderBy(F.coalesce(F.col("scheduled_at").cast("string"), F.lit("")), "story_id")


def publish_due(
    scheduled: DataFrame, queue: DataFrame, posted: DataFrame, now: dt.datetime, send: Callable[[str, str], str], per_hour: int = 40, per_day: int = 150, gap_seconds: float = 0.0, fresh_hours: float = 6.0, max_attempts: int = 2, dry_run: bool = False, wait: Callable[[float], None] | None = None
) -> DataFrame:
    """Hand due posts to ``send(story_id, message)`` in order; one row each: story_id, fate, attempts, detail.

    Fates: posted, dry_run, expired (too old, missing for long, or nothing to say), missing, gap, cap, retry,
    failed, rate_limited. Posting is bounded by the caps, so the loop is the driver's and reads due rows as
    they come; a dry run, which no row of it changes, is judged where the rows are. A rate limit ends the batch, unless ``wait`` is given: then it is waited for, up to
    ``WAIT_SECONDS`` at a time and ``WAIT_IN_ALL`` in a run. With ``dry_run`` nothing is sent, and what would be
    posted counts against no cap."""
    at = F.lit(now).cast("timestamp").cast("double") - F.col("posted_at").cast("double")
    # posts of the future and of the last hour and day count; the newest sets the gap
    have = posted.agg(F.count_if(at <= 3600).alias("hour"), F.count_if(at <= 86400).alias("day"), F.min(at).alias("since")).first()
    hour, day, since, waited, out = have["hour"], have["day"], have["since"], 0.0, []
    if dry_run:
        wait_more = since is not None and since < gap_seconds
        held = ("gap", f"{int(gap_seconds - since)}") if wait_more else ("cap", "hour" if hour >= per_hour else "day") if hour >= per_hour or day >= per_day else None
        return _dry_report(due_posts(scheduled, queue, now), held, fresh_hours)
    for r in due_posts(scheduled, queue, now).toLocalIterator():
        story, tries = r["story_id"], r["attempts"]
        say = lambda fate, detail="", n=tries, story=story: out.append((story, fate, n, detail))
        if r["there"] is None:
            say(*(("expired", "missing for long") if (r["late"] or 0) > MISSING_SECONDS else ("missing",)))
        elif r["age"] is not None and r["age"] > fresh_hours * 3600:
            say("expired", "no longer fresh")
        elif since is not None and since < gap_seconds:
            say("gap", f"{int(gap_seconds - since)}")
        elif hour >= per_hour or day >= per_day:
            say("cap", "hour" if hour >= per_hour else "day")
        elif not r["message"]:
            say("expired", "no usable content")
        else:
            while True:
                try:
                    say("posted", send(story, r["message"]))
                    hour, day, since = hour + 1, day + 1, 0.0
                except RateLimited as e:
                    if wait and e.retry_after <= WAIT_SECONDS and waited + e.retry_after <= WAIT_IN_ALL:
                        waited += e.retry_after
                        wait(e.retry_after)
                        continue
                    say("rate_limited", f"{e.retry_after:g}")
                    return _report(scheduled, out)
                except Exception as e:  # noqa: BLE001  a channel may fail in any way
                    say("failed" if tries + 1 >= max_attempts else "retry", str(e), tries + 1)
                break
    return _report(scheduled, out)


def _dry_report(due: DataFrame, held: tuple[str, str] | None, fresh_hours: float) -> DataFrame:
    """What becomes of each due row while nothing is sent; ``held`` is what keeps back all that could be."""
    say = lambda fate, detail="": F.struct(F.lit(fate).alias("fate"), F.lit(detail).alias("detail"))
    said = F.when(F.col("there").isNull(), F.when(F.col("late") > MISSING_SECONDS, say("expired", "missing for long")).otherwise(say("missing")))
    said = said.when(F.col("age") > fresh_hours * 3600, say("expired", "no longer fresh"))
    said = said.otherwise(say(*held)) if held else said.when(F.coalesce("message", F.lit("")) == "", say("expired", "no usable content")).otherwise(say("dry_run"))
    return due.select("story_id", said.alias("said"), "attempts").select("story_id", "said.fate", "attempts", "said.detail")


def _report(scheduled: DataFrame, rows: list[tuple]) -> DataFrame:
    return scheduled.sparkSession.createDataFrame(rows, REPORT)


def next_schedule(scheduled: DataFrame, report: DataFrame) -> DataFrame:
    """The schedule after a run: posted, failed and expired entries go, tries are carried on."""
    r = report.select("story_id", "fate", F.col("attempts").alias("__n"))
    kept = scheduled.join(r, "story_id", "left").where(~F.coalesce(F.col("fate").isin("posted", "failed", "expired"), F.lit(False)))
    return kept.withColumn("attempts", F.coalesce("__n", "attempts")).drop("fate", "__n")


def simulate(queue: DataFrame, posted: DataFrame, now: dt.datetime, **rules) -> DataFrame:
    """What a run would do if all of the queue were due now; nothing is sent and no state changes."""
    every = queue.select("story_id", F.lit(now).cast("timestamp").alias("scheduled_at"), F.lit(0).alias("attempts"))
    return publish_due(every, queue, posted, now, lambda *_: "", dry_run=True, **rules)


def distinct_urls(stream: DataFrame, at: str = "published", url: str = "canonical_url", delay: str = "48 hours") -> DataFrame:
    """The first row of each URL; state is kept no longer than the delay."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark([url])


def windowed_counts(stream: DataFrame, at: str, keys: list[str], size: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    return stream.withWatermark(at, delay).groupBy(F.window(at, size), *keys).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *keys, "n")


def rate_limiter(stream: DataFrame, key: str, at: str, ids: str, per_hour: int, per_day: int, delay: str = "1 hour") -> DataFrame:
    """Greedy admission by key as rows arrive; the state is the admitted times of the last day, and a key is forgotten
    once the watermark is a day beyond its last row. Rows: ids, key, verdict."""
    types = dict(stream.dtypes)

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        sent = list(state.get[0]) if state.exists else []
        pdf = pd.concat(list(batches))
        pdf = pdf.sort_values(["__s", ids], kind="stable")
        out = []
        for t in pdf["__s"]:
            sent = [x for x in sent if t - x < 86400]
            if sum(t - x < 3600 for x in sent) >= per_hour:
                out.append("hour")
            elif len(sent) >= per_day:
                out.append("day")
            else:
                sent.append(t)
                out.append("sent")
        state.update((sent,))
        state.setTimeoutTimestamp(max(int(max(pdf["__s"]) * 1000) + 86_400_000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({ids: pdf[ids], key: k[0], "verdict": out})

    rows = stream.withWatermark(at, delay).select(ids, key, at, (F.unix_micros(F.col(at).cast("timestamp")) / 1e6).alias("__s"))
    return rows.groupBy(key).applyInPandasWithState(step, f"{ids} {types[ids]}, {key} {types[key]}, verdict string", "sent array<double>", "append", GroupStateTimeout.EventTimeTimeout)


def run_once(stream: DataFrame, sink, checkpoint: str, mode: str = "append"):
    """Process what is there and stop; ``sink(batch, id)`` gets each micro-batch."""
    return stream.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(sink).start()

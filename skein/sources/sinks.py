"""Sinks: queue files, atomic state, upserted caches, an injected publisher, and decision lines."""

from __future__ import annotations

import json
import os
import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import safe_field


def write_queue(df: DataFrame, path: str) -> None:
    """Stories as JSON lines, one file per partition, replacing what was there."""
    df.write.mode("overwrite").json(path)


def queue_document(df: DataFrame, generated_at: Column, order: str = "queue_rank") -> DataFrame:
    """One row with the whole queue as a JSON document; for queues of publishable size."""
    stories = F.array_sort(F.collect_list(F.struct(F.col(order).alias("__o"), F.to_json(F.struct(*[c for c in df.columns if c != order])).alias("j"))))
    body = F.array_join(F.transform(stories, lambda s: s["j"]), ",")
    return df.agg(F.concat(F.lit('{"generated_at":"'), F.date_format(generated_at, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit('","count":'), F.count("*").cast("string"), F.lit(',"stories":['), body, F.lit("]}")).alias("document"))


def save_state(path: str, state: dict) -> None:
    """Write a small JSON state beside its place and move it there in one step."""
    folder = os.path.dirname(os.path.abspath(path))
    fd, tmp = tempfile.mkstemp(dir=folder)
    with os.fdopen(fd, "w", encoding="utf-8") as f:
        json.dump(state, f, ensure_ascii=False, indent=2)
    os.replace(tmp, path)


def upsert(old: DataFrame, new: DataFrame, key: str, at: str, ties: list[str] = []) -> DataFrame:
    """Latest row of each key, new rows before old ones of the same time."""
    both = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    w = Window.partitionBy(key).orderBy(F.desc(at), F.desc("__new"), *[F.desc(t) for t in ties])
    return both.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn", "__new")


def alive(cache: DataFrame, now: Column, ttl_hours: str = "ttl_hours", at: str = "fetched_at") -> DataFrame:
    """Cache rows within their time to live."""
    return cache.where((now.cast("double") - F.col(at).cast("double")) <= F.col(ttl_hours) * 3600)


def publish(df: DataFrame, send: Callable[[dict], str], columns: list[str], dry_run: bool = True) -> list[tuple[str, str]]:
    """Hand a bounded batch of due rows to a publisher on the driver, in order; with dry_run nothing is sent."""
    out = []
    for r in df.select(*columns).toLocalIterator():
        out.append((r[columns[0]], "dry-run" if dry_run else send(r.asDict(recursive=True))))
    return out


def decision_line() -> Column:
    """One line for each candidate."""
    part = lambda name, c: F.concat(F.lit(f"{name}="), F.coalesce(c.cast("string"), F.lit("-")))
    return F.concat_ws(
        " ", part("status", F.col("status")), part("event", F.col("event_id")), part("priority", F.concat_ws(":", "priority", F.col("priority_score").cast("string"))), part("category", F.col("category")),
        part("geo", F.concat_ws(":", "geo_scope", "state")), part("editorial", F.col("editorial")), F.concat(F.lit('headline="'), safe_field(F.col("title")), F.lit('"')),
    )


def reject_bucket() -> Column:
    """Why a candidate was rejected, by precedence."""
    return F.when(F.col("status") != "rejected", F.lit(None)).when(F.col("category").isNull(), "no_category").when(F.col("editorial") == "reject", "editorial").when(F.col("rule") == "geo", "geo").when(F.col("blocked"), "blocked").otherwise("other")

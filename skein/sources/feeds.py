"""Sources: feeds, APIs and pages, fetched and parsed on the executors behind an injected fetcher.

A fetcher is a function from (url, settings) to bytes; the default reads nothing from a network.
A source that fails gives an error row and stops no other.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as t

from ..functions import html_pages as H
from ..functions import rows as R
from ..functions import text as T
from ..schema import REGISTRY
from ..session import text_batches

Fetcher = Callable[[str, dict], bytes]
ITEM = t.StructType([t.StructField(k, t.StringType()) for k in ("title", "url", "summary", "published", "updated", "author")] + [t.StructField("category_hints", t.ArrayType(t.StringType())), t.StructField("raw", t.StringType())])
COLLECTED = "source_id string, status string, error string, position int, item struct<title: string, url: string, summary: string, published: string, updated: string, author: string, category_hints: array<string>, raw: string>"


class FetchTimeout(Exception):
    pass


def files(root: str) -> Fetcher:
    """A fetcher that reads file URLs below ``root``."""

    def fetch(url: str, settings: dict) -> bytes:
        import os
        from urllib.parse import urlsplit

        path = os.path.normpath(os.path.join(root, urlsplit(url).path.lstrip("/")))
        if not path.startswith(os.path.normpath(root)):
            raise ValueError("outside the root")
        with open(path, "rb") as f:
            return f.read()

    return fetch


def registry(spark, rows: list[dict]) -> DataFrame:
    """A source registry from dictionaries; missing fields are null."""
    schema = spark.createDataFrame([], REGISTRY).schema
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def collect(sources: DataFrame, fetcher: Fetcher) -> DataFrame:
    """One row per item (or per failed source): source_id, status, error, position, item. Repeats of a URL within a source go."""

    def run(batches):
        for pdf in batches:
            out = []
            for r in pdf.to_dict("records"):
                try:
                    settings = dict(r["settings"] or {})
                    domains = list(r["allow_domains"]) if r["allow_domains"] is not None else []
                    found = H.parse(r["method"], fetcher(r["url"], settings), r["url"], settings, domains)
                    first = {i["url"]: i for i in reversed(found)}
                    out += [(r["id"], "ok", None, k, i) for k, i in enumerate(x for x in found if first[x["url"]] is x)] or [(r["id"], "ok", None, None, None)]
                except (FetchTimeout, TimeoutError) as e:
                    out.append((r["id"], "timeout", str(e), None, None))
                except H.ParseError as e:
                    out.append((r["id"], "malformed", str(e), None, None))
                except Exception as e:
                    out.append((r["id"], "error", f"{type(e).__name__}: {e}", None, None))
            yield pd.DataFrame(out, columns=["source_id", "status", "error", "position", "item"])

    return sources.where("enabled").select("id", "method", "url", "settings", "allow_domains").mapInPandas(run, COLLECTED)


def role(type_col="type") -> F.Column:
    official = (F.col(type_col) == "official") & F.col("primary")
    return F.when(F.col("discovery"), "discovery").when(official, "official-primary").when(F.col(type_col).isin("official", "journalism", "specialist", "international"), F.col(type_col)).otherwise("journalism")


def build_articles(collected: DataFrame, sources: DataFrame, fetched_at: F.Column) -> DataFrame:
    """Articles of the collected items; those without title or canonical URL go."""
    dim = sources.select(F.col("id").alias("source_id"), F.col("name").alias("source_name"), "tier", role().alias("source_role"), F.col("language").alias("__lang"))
    items = collected.where("item is not null").select("source_id", "position", "item.*").join(dim, "source_id")
    out = items.select(
        "source_id", "source_name", "tier", "source_role", "url", "title", T.canonicalize_url(F.col("url")).alias("canonical_url"), "summary",
        T.parse_time(F.col("published")).alias("published"), T.parse_time(F.col("updated")).alias("updated"), "author", "category_hints", F.coalesce("__lang", F.lit("en")).alias("language"), "raw", fetched_at.alias("fetched_at"),
    )
    return out.where("canonical_url is not null and length(trim(title)) > 0")


def health(previous: DataFrame, collected: DataFrame, at: F.Column) -> DataFrame:
    """Counters per source carried on by one run: failures in a row start again on success."""
    now = collected.groupBy("source_id").agg(F.max("status").alias("status_now"), F.max("error").alias("error_now"), F.count("item").cast("int").alias("n"))
    both = previous.join(now, "source_id", "full_outer")
    ran, ok = F.col("status_now").isNotNull(), F.col("status_now") == "ok"
    bump = lambda c, cond: (F.coalesce(F.col(c), F.lit(0)) + F.when(cond, 1).otherwise(0)).cast("int")
    return both.select(
        "source_id", F.when(ran, F.when(ok, "ok").otherwise("error")).otherwise(F.coalesce("status", F.lit("unknown"))).alias("status"),
        F.when(ran & ok, at).otherwise(F.col("last_success")).alias("last_success"), F.when(ran, at).otherwise(F.col("last_fetch")).alias("last_fetch"),
        F.when(ran & ok, 0).otherwise(bump("consecutive_failures", ran)).cast("int").alias("consecutive_failures"), bump("total_errors", ran & ~ok).alias("total_errors"),
        bump("timeouts", F.col("status_now") == "timeout").alias("timeouts"), bump("malformed", F.col("status_now") == "malformed").alias("malformed"),
        (F.coalesce("items_found", F.lit(0)) + F.coalesce("n", F.lit(0))).cast("int").alias("items_found"), F.when(ran & ~ok, F.col("error_now")).otherwise(F.col("last_error")).alias("last_error"),
    )


def xml_feed(spark, path: str, row_tag: str = "item") -> DataFrame:
    """Feed files through Spark's own XML reader, one row per entry."""
    return spark.read.format("xml").option("rowTag", row_tag).option("mode", "PERMISSIVE").load(path)


@F.udtf(returnType="url: string, title: string, position: int")
class ExtractLinks:
    """Table function: links of (html, base)."""

    def eval(self, page: str, base: str):
        for k, i in enumerate(H.links(page, base)):
            yield i["url"], i["title"], k


def page_links(pages: DataFrame) -> DataFrame:
    """Links of each page (page_id, url, html): page_id, position, link, title; Arrow batches, no row-at-a-time UDF."""

    def run(batches):
        for pdf in batches:
            rows = [(p, k, i["url"], i["title"]) for p, u, h in zip(pdf["page_id"], pdf["url"], pdf["html"]) for k, i in enumerate(H.links(h, u))]
            yield pd.DataFrame(rows, columns=["page_id", "position", "link", "title"])

    return text_batches(pages).select("page_id", "url", "html").mapInPandas(run, "page_id long, position int, link string, title string")


def page_media(pages: DataFrame) -> DataFrame:
    """The one image or video chosen for each page, null where none is suitable."""
    kind = "struct<kind: string, origin: string, url: string, width: int, height: int, container: string>"

    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"page_id": pdf["page_id"], "media": [H.select_media(H.media(h, u)) for u, h in zip(pdf["url"], pdf["html"])]})

    return text_batches(pages).select("page_id", "url", "html").mapInPandas(run, f"page_id long, media {kind}")


def page_articles(pages: DataFrame) -> DataFrame:
    """page_id, status (ok, paywall, no_text, not_html) and paragraph text."""

    def run(batches):
        for pdf in batches:
            got = [H.article_text(h) for h in pdf["html"]]
            yield pd.DataFrame({"page_id": pdf["page_id"], "status": [s for s, _ in got], "text": [x for _, x in got]})

    return text_batches(pages).select("page_id", "html").mapInPandas(run, "page_id long, status string, text string")


def article_sentences(found: DataFrame) -> DataFrame:
    """page_id, place and text of the sentences of extracted articles."""

    def run(batches):
        for pdf in batches:
            rows = [(p, k, x) for p, t in zip(pdf["page_id"], pdf["text"]) for k, x in enumerate(R.article_sentences(t, ""))]
            yield pd.DataFrame(rows, columns=["page_id", "place", "sentence"])

    return text_batches(found).select("page_id", "text").mapInPandas(run, "page_id long, place int, sentence string")


def json_items(df: DataFrame, column: str = "body") -> DataFrame:
    """Items of JSON answers, natively: the list may be the whole or below one of the usual keys."""
    kind = "array<struct<title: string, url: string, summary: string, published_at: string, author: string, tags: array<string>>>"
    paths = [F.from_json(F.get_json_object(column, p), kind) for p in ("$", "$.articles", "$.data", "$.results", "$.items", "$.rows", "$.entries", "$.data.articles", "$.data.results", "$.data.items")]
    filled = [F.when(F.size(F.filter(p, lambda x: x["title"].isNotNull())) > 0, p) for p in paths]
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, F.posexplode(F.coalesce(*filled)).alias("position", "item")).select(*rest, "position", "item.*").where("title is not null and url is not null")


def keep_first(df: DataFrame) -> DataFrame:
    w = Window.partitionBy("source_id", "url").orderBy("position")
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def queue_file(spark, path: str) -> DataFrame:
    """Stories of a queue file {generated_at, count, stories}."""
    return spark.read.option("multiLine", True).json(path).select("generated_at", F.explode("stories").alias("s")).select("generated_at", "s.*")


def state_file(path: str, default: dict) -> dict:
    """A JSON object from a local state file; the default where it is missing, broken or no object."""
    try:
        with open(path, encoding="utf-8") as f:
            got = json.load(f)
        return got if isinstance(got, dict) else dict(default)
    except (OSError, ValueError):
        return dict(default)

"""Articles: from documents or raw items, normalized and validated, with every reason kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import text as T

ROLES = ("official-primary", "official", "journalism", "specialist", "international", "discovery")
FUTURE = "INTERVAL 24 HOURS"


def from_documents(docs: DataFrame) -> DataFrame:
    """The driver's documents read as articles: the title is the text up to the first sentence end or line end."""
    title = F.regexp_extract("text", r"^[^.\n!?]*", 0)
    return docs.select(
        F.col("source").alias("source_id"),
        F.col("source").alias("source_name"),
        (F.col("doc_id") % 4 + 1).cast("int").alias("tier"),
        F.when(F.col("doc_id") % 7 == 0, "official-primary").otherwise("journalism").alias("source_role"),
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/"), F.col("doc_id").cast("string")).alias("url"),
        title.alias("title"),
        F.expr(f"substring(text, length({_sql_title()}) + 2)").alias("summary"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 60).alias("published"),
        F.lit(None).cast("timestamp").alias("updated"),
        F.lit(None).cast("string").alias("author"),
        F.array(F.col("lang")).alias("category_hints"),
        F.col("lang").alias("language"),
        F.col("doc_id").alias("ord"),
    )


def _sql_title() -> str:
    return r"regexp_extract(text, '^[^.\\n!?]*', 0)"


def _reasons(*pairs: tuple[Column, str]) -> Column:
    return F.array_compact(F.array(*[F.when(c, F.lit(name)) for c, name in pairs]))


def normalized(raw: DataFrame, now: Column, english_only: bool = False, sites: tuple[str, ...] = ()) -> DataFrame:
    """Cleaned columns with ``reasons`` (why the row is rejected, all of them) and ``warnings``."""
    bad = lambda c: F.coalesce(~c, F.lit(True))
    df = raw.withColumns(
        {
            "title": T.clean_title(F.col("title"), sites),
            "summary": F.nullif(T.strip_tags(F.col("summary")), F.lit("")),
            "author": T.clean_author(F.col("author")),
            "language": T.normalize_language(F.col("language")),
            "category_hints": T.hints(F.col("category_hints")),
            "canonical_url": F.coalesce(T.canonicalize_url(F.col("canonical_url")) if "canonical_url" in raw.columns else F.lit(None).cast("string"), T.canonicalize_url(F.col("url"))),
        }
    )
    future = F.coalesce(F.col("published") > now + F.expr(FUTURE), F.lit(False))
    stale_update = F.coalesce(F.col("updated") < F.col("published"), F.lit(False))
    reasons = _reasons(
        (bad(F.col("source_id").rlike("^[a-z0-9-]+$")), "source_id"),
        (bad(F.length(T.collapse(F.col("source_name"))) > 0), "source_name"),
        (bad(F.col("source_role").isin(*ROLES)), "source_role"),
        (bad(F.col("tier") >= 1), "tier"),
        (bad(T.is_valid_url(F.col("url"))), "url"),
        (bad(F.length(F.col("title")) > 0), "title"),
        (F.lit(english_only) & (F.col("language") != "en"), "language"),
    )
    warnings = _reasons((future, "published in the future"), (stale_update, "updated before published"))
    out = df.withColumn("reasons", reasons).withColumn("warnings", warnings)
    return out.withColumn("updated", F.when(~stale_update, F.col("updated"))).withColumn("published", F.when(~future, F.col("published")))


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, dropped): the dropped carry stage and reasons."""
    return df.where(F.size("reasons") == 0), df.where(F.size("reasons") > 0).withColumn("stage", F.lit("normalize"))


def keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key, by the given order."""
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__rn = 1").drop("__rn")


def effective_at() -> Column:
    """The later of published and updated."""
    return F.greatest("published", "updated")


def age_minutes(at: Column, now: Column, tolerance: float = 10.0) -> Column:
    """Minutes since ``at``; a little in the future is 0, more is null."""
    m = (now.cast("double") - at.cast("double")) / 60
    return F.when(m >= 0, m).when(m >= -tolerance, F.lit(0.0))

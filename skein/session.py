"""Session settings that the operators assume."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


ARROW_ROWS = 1024


def text_batches(df: DataFrame) -> DataFrame:
    """``df``, after telling the session to send texts to Python in batches of ``ARROW_ROWS`` rows, not Spark's 10,000:
    whole texts may be long, and both sides hold a batch at a time. A session with a setting of its own keeps it."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(conf.get(key)) == 10_000:
        conf.set(key, str(ARROW_ROWS))
    return df


def session(name: str = "skein", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | extra).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

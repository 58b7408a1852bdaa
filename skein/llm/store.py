"""Shared-folder tables: lineage is cut by writing where every executor can read again."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one only in local mode where the setting is absent."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        if not sc._jsc.sc().getCheckpointDir().isDefined():
            sc.setCheckpointDir(found)
        return found.rstrip("/")
    have = sc._jsc.sc().getCheckpointDir()
    if have.isDefined():
        return have.get().rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="skein-"))
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


ARROW_ROWS = 1024


def text_batches(df: DataFrame) -> DataFrame:
    """``df``, after telling the session to send texts to Python in batches of ``ARROW_ROWS`` rows, not Spark's 10,000:
    whole texts may be long, and both sides hold a batch at a time. A session with a setting of its own keeps it."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(conf.get(key)) == 10_000:
        conf.set(key, str(ARROW_ROWS))
    return df


class Scratch:
    """Tables of one operator run, below the shared folder. What a result still reads when the operator returns goes when the driver ends."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, f"{shared_dir(spark)}/skein-{uuid.uuid4().hex}"
        atexit.register(self._end)

    def _end(self) -> None:
        with contextlib.suppress(Exception):  # the JVM may be gone by then
            self.drop()

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it again."""
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str = "") -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name) if name else self.root)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
        if not name:
            atexit.unregister(self._end)

"""A corpus pipeline of five stages; each takes and returns documents, but for the last, which packs them.

Nulls, ties, extremes: documents without words are of no language and go with the first stage; of repeated rows, lines
and texts the document of least doc_id keeps what they share; rows with a null doc_id pass the stages, but lose lines that a
document with an id holds; whole texts are read, however long. Columns beyond those of documents, whatever their
names, come through to the last stage unread. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skein.llm.decontaminate import decontaminate_stage
from skein.llm.language_id import language_stage
from skein.llm.line_dedup import line_dedup_stage
from skein.llm.near_dedup import near_dedup_stage
from skein.llm.packing import pack
from skein.llm.store import Scratch


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_stage(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup_stage(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup_stage(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate_stage(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("decontamination", decontaminate),
    ("packing", pack_documents),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, each to its predecessor's rows as written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.keep(docs, name)
    return docs


ORACLE_SQL = None

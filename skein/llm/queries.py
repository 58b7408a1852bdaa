"""The ten operators as queries over the driver's tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, decontaminate, html_extract, language_id, line_dedup, near_dedup, packing, quality, topk, toxicity

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _over(name: str, f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: f(table(spark, sf_dir, name))


def _with(a: str, b: str, f: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: f(table(spark, sf_dir, a), table(spark, sf_dir, b))


def queries() -> dict[str, Query]:
    return {
        "op1_minhash_dedup": _over("documents", near_dedup.near_dedup),
        "op2_best_fit_packing": _over("documents", packing.pack),
        "op3_language_id": _over("documents", language_id.identify),
        "op4_exact_topk": _over("embeddings", topk.nearest),
        "op5_toxicity": _with("documents", "labels", toxicity.toxicity),
        "op6_html_extraction": _over("pages", html_extract.extract),
        "op7_line_dedup": _over("documents", line_dedup.dedup_lines),
        "op8_decontamination": _with("documents", "benchmark", decontaminate.leaks),
        "op9_quality": _with("documents", "labels", quality.quality),
        "op10_chat_format": _over("conversations", lambda c: chat.flat(chat.format_chats(c))),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_exact_topk": f"""
            WITH p AS (
                SELECT a.vec_id AS query_id, b.vec_id AS neighbor_id,
                       round(list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 9) AS distance
                FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id AND a.vec_id % {topk.EVERY} = 0),
            r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS INTEGER) AS rank FROM p)
            SELECT query_id, neighbor_id, distance, rank FROM r WHERE rank <= {topk.K}""",
        "op7_line_dedup": f"""
            WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
            l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS pos FROM s),
            t AS (SELECT doc_id, line, pos, trim(line, chr(32) || chr(9) || chr(13) || chr(11) || chr(12)) AS bare FROM l),
            r AS (SELECT doc_id, line, pos, CASE WHEN strlen(bare) >= {line_dedup.MIN_BYTES}
                         THEN row_number() OVER (PARTITION BY bare ORDER BY doc_id, pos) ELSE 1 END AS rn FROM t)
            SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE rn = 1), '') AS text,
                   count(*) AS n_lines, count(*) FILTER (WHERE rn > 1) AS n_dropped
            FROM r GROUP BY doc_id""",
        "op10_chat_format": """
            WITH t AS (SELECT conv_id, turn, role, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS part FROM conversations),
            s AS (SELECT conv_id, turn, role, part,
                         sum(length(part)) OVER (PARTITION BY conv_id ORDER BY turn) AS stop,
                         count(*) OVER (PARTITION BY conv_id) AS n_turns FROM t),
            w AS (SELECT conv_id, string_agg(part, '' ORDER BY turn) AS text FROM t GROUP BY conv_id)
            SELECT s.conv_id, CAST(s.n_turns AS INTEGER) AS n_turns, w.text, s.turn, s.role,
                   CAST(s.stop - length(s.part) AS INTEGER) AS start, CAST(s.stop AS INTEGER) AS stop, CAST(NULL AS INTEGER) AS rewrites_at
            FROM s JOIN w ON s.conv_id = w.conv_id""",
    }

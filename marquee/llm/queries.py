"""Registered queries of the operators: each takes (spark, folder) and reads its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.conversations import damaged, repair_conversations
from marquee.llm.decontaminate import find_contamination
from marquee.llm.inner_products import top_inner_products
from marquee.llm.licence_scan import scan_licences
from marquee.llm.line_runs import dedup_lines
from marquee.llm.near_duplicates import find_near_duplicates
from marquee.llm.nearest import nearest_neighbours
from marquee.llm.packing import pack_documents
from marquee.llm.quality_model import score_quality
from marquee.llm.token_counts import count_tokens
from marquee.llm.toxicity import score_toxicity
from marquee.llm.warc import archive_pages
from marquee.llm.whitening import whiten


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return score_toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    return archive_pages(_table(spark, folder, "pages")).drop("archive")


def op3_licences(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licences(_table(spark, folder, "documents")).drop("spans")


def op4_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest_neighbours(_table(spark, folder, "embeddings"))


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(_table(spark, folder, "documents"))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return find_contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_lines(_table(spark, folder, "documents").select("doc_id", "text"))


def op8_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return find_near_duplicates(_table(spark, folder, "documents"))


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(_table(spark, folder, "documents"))


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    return score_quality(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op11_top_products(spark: SparkSession, folder: str) -> DataFrame:
    return top_inner_products(_table(spark, folder, "embeddings"))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(_table(spark, folder, "embeddings")).drop("deviation_exact")


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair_conversations(damaged(_table(spark, folder, "conversations")), present=F.col("present"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_warc, op3_licences, op4_neighbours, op5_token_counts, op6_decontamination,
        op7_line_dedup, op8_near_duplicates, op9_packing, op10_quality, op11_top_products, op12_whitening,
        op13_conversation_repair,
    )
}

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

ORACLES = {
    "op2_warc": f"""
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages
        ), d AS (
            SELECT page_id, body, hex, min(page_id) OVER (PARTITION BY hex) AS first_page FROM p
        )
        SELECT page_id,
            octet_length(encode(body)) AS payload_bytes,
            list_aggregate(list_transform(range(0, 32), lambda i: substr('{_BASE32}', 1 + CAST(
                (CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)),
                'string_agg', '') AS payload_digest,
            CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id = first_page THEN NULL ELSE first_page END AS refers_to
        FROM d
    """,
    "op11_top_products": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
                AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, v.vec_id,
                CAST(list_sum(list_transform(list_zip(q.x, v.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v AS q JOIN v ON q.vec_id <> v.vec_id
            WHERE q.vec_id % 50 = 0
        ), r AS (
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score
            FROM s
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
    """,
}

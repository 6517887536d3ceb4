"""The registered queries of the corpus operators, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from terrakern.llm.bpe_codec import round_trip_digests
from terrakern.llm.common import table
from terrakern.llm.html_extract import extract_pages
from terrakern.llm.near_dedup import classes
from terrakern.llm.permutation_index import nearest
from terrakern.llm.quality_rules import verdicts
from terrakern.llm.source_mix import mix
from terrakern.llm.suffix_dedup import dedup
from terrakern.llm.token_counts import count_tokens
from terrakern.llm.toxicity import score, train
from terrakern.llm.warc import archive_round_trip

VOCABULARY = "byte_bpe_50k.json"


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"), ["doc_id"])


def op2_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), ["doc_id"])


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"), ["doc_id"])


def op5_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(table(spark, sf_dir, "documents"), ["doc_id"])


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(spark, table(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_permutation_index": op2_permutation_index,
    "op3_source_mix": op3_source_mix,
    "op4_near_dedup": op4_near_dedup,
    "op5_bpe_codec": op5_bpe_codec,
    "op6_html_extract": op6_html_extract,
    "op7_quality_rules": op7_quality_rules,
    "op8_warc": op8_warc,
    "op9_toxicity": op9_toxicity,
    "op10_token_counts": op10_token_counts,
}
ORACLE_SQL: dict[str, str] = {
    "op8_warc": """
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
        ), f AS (
            SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first < page_id THEN first END AS refers_to
        FROM p LEFT JOIN f USING (payload_digest)
    """,
}

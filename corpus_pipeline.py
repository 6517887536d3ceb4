"""Corpus pipeline: five stages over ``documents``, each written as Parquet and reread.

1. ``quality`` drops documents that the quality rules reject.
2. ``near_dedup`` keeps one document of each near-duplicate class.
3. ``suffix_dedup`` cuts repeated 50-byte strings out of the texts; documents of
   which nothing is left go.
4. ``mix`` repeats documents, or leaves them out, so that the sources meet their
   target weights.
5. ``encode`` turns each text into token ids, and keeps the ids with the digest of
   what they decode to.

A null or empty text fails the base rules of the first stage, so none reaches the
later ones; null languages and sources are groups of their own, rows with null ids are judged by
their texts.  Texts of any length are taken whole, extra columns of ``documents`` are
left out whatever their names, and an empty table gives an empty result.

No stage has SQL: ``run`` is tested against a plain version in ``tests/llm``, and the
stages against brute-force versions of their operators.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrakern.llm.bpe_codec import encode_documents
from terrakern.llm.common import stage, table
from terrakern.llm.near_dedup import first_of_class
from terrakern.llm.quality_rules import kept_documents
from terrakern.llm.source_mix import mixed_documents
from terrakern.llm.suffix_dedup import trimmed_documents

VOCABULARY = "byte_bpe_50k.json"
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the base rules and the outlier test; repeated rows are judged alike."""
    return kept_documents(docs.select(*COLUMNS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate class the row of the smallest id; repeated rows and equal texts are one class."""
    return first_of_class(docs.select(*COLUMNS))


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that a smaller doc_id has too, n_chars counted again; a text of which nothing is left goes."""
    trimmed = trimmed_documents(docs.select(*COLUMNS))
    return trimmed.withColumn("n_chars", F.length("text").cast("long"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole rows, each 0 to 3 times, so that the words of a source meet its target; null sources are one source."""
    return mixed_documents(docs.select(*COLUMNS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids, ids_sha256, decoded_sha256 of every row."""
    return encode_documents(docs, ["doc_id", "lang", "source"], public_tokenizers.path(VOCABULARY))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("suffix_dedup", suffix_dedup), ("mix", mix), ("encode", encode)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

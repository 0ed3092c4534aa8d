"""The registered queries of this subpackage, each over its whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, chat, codes, jaccard, language, licenses, mixing, nearest, packing, quality, search, substrings, wrappers

#: The folder of public tokenizers' files; a path of the machines, not of the data.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), f"{TOKENIZERS}/word_bpe_49k.json")


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.near(_read(spark, sf_dir, "embeddings"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language(_read(spark, sf_dir, "documents"))


def op5_exact_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document whose doc_id is divisible by 50, its whole text as the query, against all documents."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return search.search(docs.where(F.col("doc_id") % 50 == 0).select(F.col("doc_id").alias("q"), "text"), docs)


def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_read(spark, sf_dir, "documents")).drop("detections")


def op7_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "shards")


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(_read(spark, sf_dir, "documents"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(_read(spark, sf_dir, "conversations"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(_read(spark, sf_dir, "documents"))


def op11_vector_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.digest(_read(spark, sf_dir, "embeddings"))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(_read(spark, sf_dir, "pages"))


def op13_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [op1_best_fit_packing, op2_embedding_near_dedup, op3_quality_classifier, op4_language_id, op5_exact_top_k_search, op6_license_scans, op7_mixing_sources, op8_ngram_jaccard_join, op9_chat_formatting, op10_substring_dedup, op11_vector_code_compression, op12_html_extraction, op13_filter_interaction_audit]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    """SQL that DuckDB finishes on whole tables; the others are tested against brute force."""
    return {"op9_chat_formatting": chat.ORACLE, "op11_vector_code_compression": codes.ORACLE, "op12_html_extraction": wrappers.ORACLE, "op13_filter_interaction_audit": audit.ORACLE}

"""A training corpus from raw documents: language, near copies, repeated passages, mixture, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from usagelens.llm import jaccard, language, mixing, packing, substrings
from usagelens.llm.common import small_batches, staged
from usagelens.llm.queries import TOKENIZERS


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is recognised: those without text or letters go.

    Null and empty texts have no letter; very long ones are read whole; ties go to the first language by name; each repeated row
    gets the same answer; a null lang teaches nothing; an empty table, or one without any lang, keeps none; other columns stay.
    """
    small_batches(spark)
    return language.known_language(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: of the smallest doc_id, null being the largest.

    Null and empty texts are like nothing and all stay; very long ones are read whole; of repeated rows one stays, and of rows alike
    in doc_id and text alone the first by its JSON; an empty table gives none; other columns stay with their row.
    """
    small_batches(spark)
    return jaccard.one_of_each(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more stay in the document of the smallest doc_id that holds them.

    Null, empty and short texts stay; a text that loses all its words goes; very long ones are read whole; rows with one doc_id
    don't remove each other's words; a doc_id that is null or no whole number is compared with nothing; an empty table gives none.
    """
    small_batches(spark)
    return substrings.cleaned(docs)


def mixed_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources' words brought to their target weights; a document may come twice, or in part.

    Null and blank texts have no words and go; a null source is one, last in order; very long texts are cut anywhere between words;
    repeated rows count each; equal sources split by order; an empty table gives none; n_chars follows the text, other columns stay.
    """
    small_batches(spark)
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed in sequences of 2048.

    A null or empty text is one piece of the separator; very long ones are cut into pieces; repeated rows are packed each; which of
    equal lengths goes where follows from tasks and is no promise; an empty table gives none; other columns are left out.
    """
    small_batches(spark)
    return packing.pack(docs, f"{TOKENIZERS}/word_bpe_49k.json")


STAGES = [
    ("language id", known_language),
    ("n-gram jaccard join", one_of_each_group),
    ("substring dedup", without_repeated_passages),
    ("mixing sources", mixed_to_weights),
    ("best-fit packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


#: No SQL for trained models and tokenizers: stages are tested against brute force.
ORACLE_SQL = None

"""From documents to packed training sequences: quality rules, near duplicates, repeated passages, personal data, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows of ``docs``, the Parquet that its predecessor left; all
but the last return the columns of ``docs``. Null texts count as empty: the quality rules reject them.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonaria.llm import packing, passages, pii, quality, simhash
from zonaria.llm.common import stored


def _with_length(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text where the table has it."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and fit the fertility bands of their script."""
    return quality.accepted(docs, "doc_id", "text")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id."""
    return simhash.without_near_duplicates(docs, "doc_id", "text")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of thirteen words or more that one with a smaller id holds."""
    return _with_length(passages.cut_passages(docs, "doc_id", "text"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind, and without the terms that give it away."""
    return _with_length(pii.sanitised(docs, "doc_id", "text"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens with their places in sequences of 2 048."""
    return packing.pack_texts(docs, "doc_id", "text").withColumnRenamed("gid", "doc_id")


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("pii", personal_data),
    ("best_fit_packing", best_fit_packing),
]

#: SQL cannot express fingerprints, tokens and packing; ``tests/llm`` holds the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each result written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stored(docs)
    return docs

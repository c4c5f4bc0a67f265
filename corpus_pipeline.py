"""Corpus pipeline: documents through quality rules, exact and near dedup, mixing and packing.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of ``docs``. A packing stage's SQL would need
a tokenizer, so the pipeline is tested against a brute-force version instead of an oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from triplake.llm import best_fit_packing, exact_dedup, host_quality, minhash_dedup, source_mixing, store


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents that the base rules or their host's verdict reject go."""
    return host_quality.kept_documents(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of equal texts the row with the smallest doc_id stays."""
    return exact_dedup.first_of_each(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: of each group of near copies the document with the smallest doc_id stays."""
    return minhash_dedup.one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents are repeated or left out so that expected tokens by domain meet the target weights."""
    return source_mixing.mixed_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: pieces of at most 1024 ids packed into as few sequences as best fit finds."""
    return best_fit_packing.best_fit_packing(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("near dedup", near_copies),
    ("mixing", mixing),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store.written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

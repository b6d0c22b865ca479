"""Training-corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Rows without doc_id pass through; a null text counts as empty in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from demandspark.llm import op1_simhash, op2_pii, op7_packing, op9_decontamination, op10_quality
from demandspark.sources import scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from those of ``docs`` that are labelled."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return op10_quality.accepted(docs, *op10_quality.fit(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints (three-word shingles, 64 bits) link at two differing bits or fewer."""
    return op1_simhash.deduplicated(docs, size=3, radius=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return op9_decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return op2_pii.redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    return op7_packing.pack(docs, op7_packing.tokenizer_path())


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: Hashing, training and tokenising can't be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, from ``documents``. Once a stage's result is written, all that was written for it is deleted."""
    docs, earlier = spark.read.parquet(f"{sf_dir}/documents.parquet"), scratch.written()
    for name, stage in STAGES:
        docs, path = scratch.stored(stage(spark, docs, sf_dir), name)
        scratch.delete(spark, *(scratch.written() - earlier - {path}))
    return docs

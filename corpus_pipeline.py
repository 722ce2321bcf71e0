"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes `(spark, docs, sf_dir)` and works on all that the stage before it kept.
Its result is written as Parquet and read again as the next one's documents. Without
documents every stage hands back no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairmill.llm import decontaminate, host_rules, line_dedup, ngram_join, packing
from pairmill.session import durable


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and whose host passes."""
    return host_rules.keep(docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without lines that stand earlier, or nearly so; those left without a word go."""
    kept = line_dedup.keep_lines(docs)
    if "n_chars" in kept.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast("bigint"))
    return kept


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 0.8 of its five-word n-grams or more."""
    return ngram_join.keep_first(docs, k=5, num=8, den=10)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's place in the packed sequences."""
    return packing.pack(docs, packing.text_length(F.col("text")))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_deduplication),
    ("ngram_jaccard_join", near_copies),
    ("decontamination", decontamination),
    ("best_fit_packing", sequences),
]

# The join, the line edits and packing have no SQL form; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir), name)
    return docs

"""Scored pairs in Hadoop sequence files: (long, `w1 w2<TAB>pmi`)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = "org.apache.hadoop.io.LongWritable"
VALUE = "org.apache.hadoop.io.Text"


def read_checked(spark: SparkSession, path: str, decade: int) -> tuple[DataFrame, DataFrame]:
    """`decade, w1, w2, pmi`, and rejects `value`. Spark SQL has no reader for these files,
    so the records come in as an RDD and become columns at once."""
    records = spark.sparkContext.sequenceFile(path, KEY, VALUE)
    lines = spark.createDataFrame(records, "id bigint, value string", verifySchema=False)
    sides = F.split("value", "\t")
    words = F.split(F.get(sides, F.lit(0)), " ")
    parsed = lines.select(
        "value",
        F.lit(decade).alias("decade"),
        F.get(words, F.lit(0)).alias("w1"),
        F.get(words, F.lit(1)).alias("w2"),
        F.get(sides, F.lit(1)).try_cast("double").alias("pmi"),
    )
    good = F.col("w2").isNotNull() & F.col("pmi").isNotNull()
    return parsed.where(good).drop("value"), parsed.where(~good).select("value")


def read_pairs(spark: SparkSession, path: str, decade: int) -> DataFrame:
    """The good records of `read_checked`; a bad one fails no job."""
    return read_checked(spark, path, decade)[0]

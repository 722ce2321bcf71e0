"""Summary files of finished jobs, as sinks.report writes them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairmill.sinks.report import parse_summary


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """`local_id, operation, url, result, status, is_error` of all jobs below `path`."""
    # With its type given, the folder's name stays the text it is: job 007 is not 7.
    lines = spark.read.schema("value string, local_id string").text(path).where("value <> ''")
    return parse_summary(lines.select("local_id", F.col("value").alias("line")))

"""Documents to convert: `url, html`, one row per url."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Files as documents: the path is the url, the UTF-8 content the html."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.col("path").alias("url"), F.decode("content", "UTF-8").alias("html"))

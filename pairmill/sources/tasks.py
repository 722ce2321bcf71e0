"""Conversion task lists: one `operation<TAB>url` per line, one file per job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairmill.operators.skew import number_rows


def parse_tasks(lines: DataFrame) -> DataFrame:
    """`operation, url` of each line beside its other columns; `bad` holds a line
    without a tab. Fields after the second are ignored."""
    parts = F.split("value", "\t")
    kept = [c for c in lines.columns if c != "value"]
    return lines.select(
        *kept,
        F.get(parts, F.lit(0)).alias("operation"),
        F.get(parts, F.lit(1)).alias("url"),
        F.when(F.size(parts) < 2, F.col("value")).alias("bad"),
    )


def read_task_lists(
    spark: SparkSession, path: str, job: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Tasks `local_id, task_no, num_tasks, operation, url` of the list files at `path`,
    and rejects `local_id, value`: lines without a tab.

    The job is the file's whole path, so equal names in two folders are two jobs; `job`
    takes it from `path` (the file's path) instead. Task numbers follow the lines, also
    of a file so long that it is read in several splits.
    """
    job = F.col("path") if job is None else job
    at = F.col("_metadata")
    lines = spark.read.text(path).select(
        "value",
        at["file_path"].alias("path"),
        at["file_block_start"].alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )
    parsed = parse_tasks(lines.withColumn("local_id", job).where("value <> ''"))
    good = parsed.where("bad IS NULL").drop("bad")
    numbered = number_rows(good, ["local_id"], ["path", "_block", "_line"], "task_no", "num_tasks")
    rejects = parsed.where("bad IS NOT NULL").select("local_id", F.col("bad").alias("value"))
    return numbered.select("local_id", "task_no", "num_tasks", "operation", "url"), rejects

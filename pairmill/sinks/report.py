"""Summary lines and HTML reports of finished jobs.

A report is rows in line order, never one string per job: a job may be a large share
of all tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmill.functions import html
from pairmill.functions.messages import ERROR

# Parts of a summary line and of a report.
SUCCESS = " --- "
PAGE_START = "<html><body>"
PAGE_END = "</body></html>"


def summary_lines(replies: DataFrame) -> DataFrame:
    """`local_id, task_no, line`: four tab fields (operation, url, result, status)."""
    failed = F.col("is_error")
    result = F.when(failed, F.concat(F.lit("< "), "result", F.lit(" >"))).otherwise(F.col("result"))
    status = F.when(failed, ERROR).otherwise(SUCCESS)
    operation = F.concat(F.lit("< "), "operation", F.lit(" >: "))
    line = F.concat_ws("\t", operation, "url", result, status)
    return replies.select("local_id", "task_no", line.alias("line"))


def round_lines(replies: DataFrame) -> DataFrame:
    """`local_id, round, place, line`: a summary for each full round of a job."""
    keys = ["local_id", "round", "place"]
    lines = summary_lines(replies.withColumn("task_no", F.struct(*keys)).drop("round", "place"))
    return lines.select(*[F.col(f"task_no.{k}").alias(k) for k in keys], "line")


def parse_summary(lines: DataFrame) -> DataFrame:
    """The four fields of summary lines, and whether the status is the error mark."""
    parts = F.split("line", "\t")
    kept = [c for c in lines.columns if c != "line"]
    fields = ["operation", "url", "result", "status"]
    return lines.select(
        *kept, *[F.get(parts, F.lit(i)).alias(name) for i, name in enumerate(fields)]
    ).withColumn("is_error", F.col("status") == ERROR)


def outcome_counts(summary: DataFrame) -> DataFrame:
    """Tasks per operation and status; `summary` as parse_summary gives it."""
    operation = F.regexp_extract("operation", "^< (.*) >: $", 1)
    status = F.when(F.col("is_error"), "error").otherwise("success")
    return summary.groupBy(operation.alias("operation"), status.alias("status")).agg(
        F.count(F.lit(1)).alias("tasks")
    )


def html_report(
    summary: DataFrame,
    finished: DataFrame,
    escape: bool = False,
    report: tuple[str, ...] = ("local_id",),
    line: str = "task_no",
) -> DataFrame:
    """`local_id, line_no, html`: opening (line 0), one row per task, closing.

    `finished` (`local_id, replies`) gives the jobs, so one without tasks has a report
    too. Text is put in as it is unless `escape` is set. `report` names the columns that
    tell reports apart, such as the job and its round, and `line` the one that orders them.
    """
    clean = html.escape if escape else lambda column: column

    def anchor(target, text):
        return F.concat(F.lit("<a href="), target, F.lit(f">{text}</a>"))

    result = clean(F.col("result"))
    outcome = F.when(F.col("is_error"), result).otherwise(anchor(result, "outputFileLink"))
    body = F.concat(
        clean(F.col("operation")),
        anchor(clean(F.col("url")), "inputFileLink"),
        F.lit(" "),
        outcome,
        F.lit("<br>"),
    )
    tasks = summary.select(*report, F.col(line).alias("line_no"), body.alias("html"))
    opening = finished.select(*report, F.lit(0).cast("bigint").alias("line_no"), F.lit(PAGE_START).alias("html"))
    # After every task, whatever their numbers.
    closing = finished.select(
        *report, F.lit((1 << 63) - 1).alias("line_no"), F.lit(PAGE_END).alias("html")
    )
    return opening.unionByName(tasks).unionByName(closing)


def write_by_job(rows: DataFrame, order: str, text: str, path: str) -> None:
    """Text files under one folder per job; in name order they are the job's report."""
    ranged = rows.repartitionByRange("local_id", order).sortWithinPartitions("local_id", order)
    ranged.select("local_id", F.col(text).alias("value")).write.partitionBy("local_id").text(path)


def write_results(contents: DataFrame, path: str) -> None:
    """Results by operation: one named row per converted task."""
    contents.write.partitionBy("operation").parquet(path)

"""Jobs: their tasks in batches, their replies, and when they are complete."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairmill.operators.skew import lookup_join, number_rows
from pairmill.session import durable


def task_batches(tasks: DataFrame, size: int) -> DataFrame:
    """Tasks per batch of at most `size`, in task order, and batches per job."""
    batch = F.ceil(F.col("task_no") / F.lit(size)).cast("bigint")
    batches = F.ceil(F.col("num_tasks") / F.lit(size)).cast("bigint")
    return tasks.groupBy("local_id", batch.alias("batch")).agg(
        F.count(F.lit(1)).alias("tasks"), F.max(batches).alias("batches")
    )


def in_batches(tasks: DataFrame, size: int) -> DataFrame:
    """Tasks with their batch, the rows of a batch in one partition."""
    batch = F.ceil(F.col("task_no") / F.lit(size)).cast("bigint")
    return tasks.withColumn("batch", batch).repartition("local_id", "batch")


def first_replies(replies: DataFrame, arrival: Sequence[str]) -> DataFrame:
    """The first reply to each task; a repeated one is dropped.

    An aggregate, so the copies of a reply are merged before the shuffle.
    """
    rest = [c for c in replies.columns if c not in ("local_id", "task_no")]
    earliest = F.min_by(F.struct(*rest), F.struct(*arrival))
    return (
        replies.groupBy("local_id", "task_no")
        .agg(earliest.alias("_first"))
        .select("local_id", "task_no", *[F.col("_first")[c].alias(c) for c in rest])
        .select(*replies.columns)
    )


def pending_tasks(tasks: DataFrame, replies: DataFrame) -> DataFrame:
    """Tasks without a reply, however often others were answered; a null job is a job."""
    answered = replies.select(F.col("local_id").alias("_job"), F.col("task_no").alias("_task")).distinct()
    same = F.col("local_id").eqNullSafe(F.col("_job")) & F.col("task_no").eqNullSafe(F.col("_task"))
    return tasks.join(answered, same, "left_anti")


def job_progress(replies: DataFrame) -> DataFrame:
    """Per job: replies, tasks per round, full rounds, and replies of the open round."""
    counted = replies.groupBy("local_id").agg(
        F.count(F.lit(1)).alias("replies"), F.max("num_tasks").alias("num_tasks")
    )
    return counted.select(
        "*",
        F.expr("replies div num_tasks").alias("complete"),
        F.expr("replies % num_tasks").alias("open"),
    )


def in_rounds(replies: DataFrame, arrival: Sequence[Column | str]) -> DataFrame:
    """Replies with their `round` and their `_place` in their job."""
    numbered = number_rows(replies, ["local_id"], arrival, "_place", "_replies")
    return numbered.withColumn("round", F.expr("(_place - 1) div num_tasks"))


def full_round_replies(replies: DataFrame, arrival: Sequence[Column | str]) -> DataFrame:
    """The replies of full rounds with `round` and `place` in it; repeats must be gone."""
    full = in_rounds(replies, arrival).where("(round + 1) * num_tasks <= _replies")
    placed = full.withColumn("place", F.col("_place") - F.col("round") * F.col("num_tasks"))
    return placed.drop("_place", "_replies")


def job_completion(replies: DataFrame, arrival: Sequence[Column | str]) -> DataFrame:
    """The replies of each job in rounds of `num_tasks`, in order of arrival.

    A round is complete when it is full; the next reply then starts a new one. Only
    the last round of a job can be open.
    """
    return in_rounds(replies, arrival).groupBy("local_id", "round").agg(
        F.count(F.lit(1)).alias("replies"),
        F.max("num_tasks").alias("num_tasks"),
        F.count_if("is_error").alias("errors"),
        F.min_by("task_no", "_place").alias("first_task"),
        F.max_by("task_no", "_place").alias("last_task"),
        (F.count(F.lit(1)) == F.max("num_tasks")).alias("is_complete"),
    )


def finished_jobs(replies: DataFrame, requests: DataFrame | None = None) -> DataFrame:
    """Stored `local_id, replies` of the jobs whose tasks all have a reply.

    Repeated replies are no progress. `requests` (`local_id, num_tasks`) adds the jobs
    that have no task at all, which are finished at once.
    """
    answered = replies.groupBy("local_id", "task_no").agg(F.max("num_tasks").alias("num_tasks"))
    done = job_progress(answered).where("replies >= num_tasks").select("local_id", "replies")
    if requests is not None:
        none = requests.where("num_tasks = 0").select(
            "local_id", F.lit(0).cast("bigint").alias("replies")
        )
        done = done.unionByName(none)
    return durable(done, "finished")


def of_finished(replies: DataFrame, finished: DataFrame) -> DataFrame:
    """The replies of finished jobs only, a job of any size spread over many tasks."""
    named = finished.select(_never_null("local_id").alias("_job"), "replies")
    return lookup_join(
        replies.withColumn("_job", _never_null("local_id")),
        named,
        "replies",
        {"_job": "_job"},
        {"replies": "_n"},
        ["task_no"],
    ).drop("_n", "_job")


def _never_null(name: str) -> Column:
    """As a text of its own, a null meets a null in a join."""
    return F.when(F.col(name).isNull(), "-").otherwise(F.concat(F.lit("+"), F.col(name).cast("string")))

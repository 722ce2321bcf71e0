"""Task streams: converted batch by batch, each document once.

Three tables lie below the checkpoint. `documents` holds one document per url, in parts by
the url's hash: a micro-batch reads only the parts that its urls fall into. `ledger` holds
the outcome of every (operation, url) converted so far, by micro-batch and part; a later
batch takes the outcomes it needs from there and adds those that are new. A micro-batch
overwrites its own folders and reads only those of earlier ones, so a repeated batch
neither loses nor doubles anything.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairmill.operators import conversion
from pairmill.session import durable, exists, fresh_path, planned_bytes
from pairmill.streaming.intake import await_end, read_folder

# Documents of one part, about, and the least number of parts.
PART_BYTES = 256 * 1024 * 1024
LEAST_PARTS = 32

DOCUMENT = "url string, html string, part int"
LEDGER = "operation string, url string, error string, content string, batch int, part int"
REPLY = "local_id string, task_no bigint, num_tasks bigint, operation string, url string, result string, is_error boolean, batch int"


@dataclass(frozen=True)
class Store:
    """Where a stream keeps its documents and outcomes, and in how many parts."""

    home: str
    parts: int

    def part_of(self, url: Column) -> Column:
        return F.pmod(F.xxhash64(F.coalesce(url, F.lit(""))), F.lit(self.parts)).cast("int").alias("part")

    def documents(self, spark: SparkSession, parts: list[int]) -> DataFrame:
        stored = spark.read.schema(DOCUMENT).parquet(f"{self.home}/documents")
        return stored.where(F.col("part").isin(parts))

    def ledger(self, spark: SparkSession, parts: list[int] | None = None) -> DataFrame:
        stored = spark.read.schema(LEDGER).parquet(f"{self.home}/ledger")
        return stored if parts is None else stored.where(F.col("part").isin(parts))


def open_store(documents: DataFrame, home: str, parts: int | None = None) -> Store:
    """The store at `home`; if it is new, the documents are written there, one per url.

    Of a url that is listed more than once the least text counts. A stream that is started
    again goes on with the documents that it was started with.
    """
    spark = documents.sparkSession
    if not exists(spark, f"{home}/documents"):
        parts = parts or max(LEAST_PARTS, -(-planned_bytes(documents) // PART_BYTES))
        store = Store(home, parts)
        one = documents.groupBy("url").agg(F.min("html").alias("html"))
        laid = one.select("url", "html", store.part_of(F.col("url"))).repartition(parts, "part")
        for table, schema in (("ledger", LEDGER), ("documents", DOCUMENT)):
            rows = spark.createDataFrame([], schema) if table == "ledger" else laid
            rows.write.mode("overwrite").partitionBy("part").parquet(f"{home}/{table}")
        spark.range(parts, parts + 1).write.mode("overwrite").parquet(f"{home}/parts")
    return Store(home, spark.read.schema("id bigint").parquet(f"{home}/parts").first().id)


def _same(a: DataFrame, b: DataFrame) -> Column:
    """A null operation and a null url are values like others."""
    return (
        (a["part"] == b["part"]) & a["operation"].eqNullSafe(b["operation"]) & a["url"].eqNullSafe(b["url"])
    )


def convert_batch(batch: DataFrame, number: int, store: Store, bucket: str) -> DataFrame:
    """The replies to the tasks of a micro-batch; its new outcomes go into the ledger."""
    spark = batch.sparkSession
    work = conversion.work_items(batch).withColumn("part", store.part_of(F.col("url")))
    work = durable(work, "batch-work")
    # As many numbers as there are parts, at most.
    parts = sorted(r.part for r in work.select("part").distinct().collect())
    known = store.ledger(spark, parts).where(F.col("batch") < number).select("operation", "url", "part")
    fresh = durable(work.join(known, _same(work, known), "left_anti"), "batch-fresh")
    needed = sorted(r.part for r in fresh.select("part").distinct().collect())
    fetched = conversion.fetch(fresh, store.documents(spark, needed).select("url", "html"))
    made = conversion.converted(fetched).select("operation", "url", "error", "content", "part")
    made.write.mode("overwrite").partitionBy("part").parquet(f"{store.home}/ledger/batch={number}")
    done = store.ledger(spark, parts).where(F.col("batch") <= number).drop("content", "batch")
    outcomes = work.join(done, _same(work, done)).select(work["operation"], work["url"], "error", "requests")
    return conversion.replies(batch, durable(outcomes, "batch-outcomes"), bucket)


def drain(
    tasks: DataFrame, documents: DataFrame, bucket: str, path: str, checkpoint: str, timeout: int | None = None
) -> Store:
    """Convert the tasks that are there, write their replies below `path`, and stop.

    Every micro-batch has a folder of its own that a repeated batch overwrites, so a
    restart neither loses nor doubles a reply.
    """
    store = open_store(documents, f"{checkpoint}-store")

    def convert(batch: DataFrame, number: int) -> None:
        replies = convert_batch(batch, number, store, bucket)
        replies.write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = (
        tasks.writeStream.foreachBatch(convert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    await_end(query, timeout)
    return store


def drained(tasks: DataFrame, documents: DataFrame, bucket: str) -> DataFrame:
    """The replies to the tasks that are there, as a table of the shared folder."""
    spark = tasks.sparkSession
    home = fresh_path(spark, "stream-replies")
    drain(tasks, documents, bucket, f"{home}/table", f"{home}/checkpoint")
    if not exists(spark, f"{home}/table"):  # no file, so no micro-batch
        return spark.createDataFrame([], REPLY).drop("batch")
    return spark.read.parquet(f"{home}/table").drop("batch")


def reply_stream(spark: SparkSession, path: str) -> DataFrame:
    """The replies that a converting stream writes below `path`, as a stream.

    A micro-batch that was repeated may show its replies twice: drop repeats.
    """
    return read_folder(spark, f"{path}/*", REPLY.removesuffix(", batch int"))

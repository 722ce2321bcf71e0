"""Stop on a marker: open jobs are finished, later ones refused, then the stream ends.

A control row in the task stream has the operation `_terminate` and an order number `at`
like any task. A job whose first task comes before it is open and gets all its tasks
converted, also those that arrive after the marker; tasks of other jobs are refused and
stored apart. Once every open job has all its tasks, the stream is stopped, between two
micro-batches.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from pairmill.session import durable

# Fixed value: the control word.
TERMINATE = "_terminate"

OPENED = "local_id string, num_tasks bigint, first bigint, batch int"
TAKEN = "local_id string, task_no bigint, batch int"
STOPS = "at bigint, batch int"


class Gate:
    """What has been taken in so far, in tables below `home`, and whether all of it is done."""

    def __init__(self, home: str):
        self.home = home
        self.full = threading.Event()

    def _table(self, like: DataFrame, name: str, schema: str, number: int) -> DataFrame:
        """Rows of the batches up to `number`."""
        spark = like.sparkSession
        spark.createDataFrame([], schema).write.mode("append").parquet(f"{self.home}/{name}")
        return spark.read.schema(schema).parquet(f"{self.home}/{name}").where(F.col("batch") <= number)

    def _add(self, rows: DataFrame, name: str, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.home}/{name}/batch={number}")

    def take(self, batch: DataFrame, number: int) -> DataFrame:
        """The tasks of the micro-batch that are to be converted."""
        rows = durable(batch, "batch-tasks")
        marker = F.coalesce(F.col("operation") == TERMINATE, F.lit(False))
        self._add(rows.where(marker).select("at"), "stops", number)
        stop = self._table(rows, "stops", STOPS, number).agg(F.min("at").alias("at")).first().at
        tasks = rows.where(~marker)
        before = self._table(rows, "opened", OPENED, number - 1)
        firsts = tasks.groupBy("local_id").agg(F.max("num_tasks").alias("num_tasks"), F.min("at").alias("first"))
        fresh = firsts.join(before, _same_job(firsts, before), "left_anti")
        if stop is not None:
            fresh = fresh.where(F.col("first") < stop)
        self._add(fresh, "opened", number)
        opened = self._table(rows, "opened", OPENED, number)
        taken = durable(tasks.join(opened, _same_job(tasks, opened), "left_semi"), "batch-taken")
        refused = tasks.join(opened, _same_job(tasks, opened), "left_anti")
        self._add(refused, "refused", number)
        self._add(taken.select("local_id", "task_no"), "taken", number)
        return taken

    def check(self, batch: DataFrame, number: int) -> None:
        """After a micro-batch: if the marker has come, are all open jobs full?"""
        if self._table(batch, "stops", STOPS, number).limit(1).count():
            taken = self._table(batch, "taken", TAKEN, number).select("local_id", "task_no").distinct()
            got = taken.groupBy("local_id").agg(F.count(F.lit(1)).alias("got"))
            opened = self._table(batch, "opened", OPENED, number)
            waiting = opened.join(got, _same_job(opened, got), "left").where("coalesce(got, 0) < num_tasks")
            if not waiting.limit(1).count():
                self.full.set()


def _same_job(a: DataFrame, b: DataFrame) -> Column:
    return a["local_id"].eqNullSafe(b["local_id"])


class AfterBatch(StreamingQueryListener):
    """Tells when a micro-batch has been committed and the gate is full."""

    def __init__(self, gate: Gate):
        self.gate = gate
        self.id = None
        self.over = threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if self.gate.full.is_set() and str(event.progress.id) == self.id:
            self.over.set()

    def onQueryIdle(self, event) -> None:
        if self.gate.full.is_set() and str(event.id) == self.id:
            self.over.set()

    def onQueryTerminated(self, event) -> None:
        pass


def run_until_marker(
    tasks: DataFrame,
    convert: Callable[[DataFrame, int], None],
    home: str,
    checkpoint: str,
    feed: Callable[[StreamingQuery], None] | None = None,
    timeout: int | None = None,
) -> None:
    """Run the stream until its marker has come and all open jobs are full.

    `tasks` has `local_id, task_no, num_tasks, operation, url, at`; `convert(taken, number)`
    handles those of a micro-batch. `feed` runs beside the stream, as tests and queries
    need it. The gate's tables are below `home`: `opened`, `taken`, `refused` and `stops`.
    """
    gate = Gate(home)
    listener = AfterBatch(gate)
    streams = tasks.sparkSession.streams

    def step(batch: DataFrame, number: int) -> None:
        convert(gate.take(batch, number), number)
        gate.check(batch, number)

    streams.addListener(listener)
    try:
        query = tasks.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).start()
        listener.id = str(query.id)
        try:
            if feed:
                feed(query)
            end = time.monotonic() + timeout if timeout else None
            while not listener.over.wait(0.1):
                if not query.isActive:
                    query.awaitTermination()
                    raise RuntimeError("the stream ended before its marker")
                if end and time.monotonic() > end:
                    raise TimeoutError(f"no end in {timeout} s")
        finally:
            query.stop()
    finally:
        streams.removeListener(listener)

"""Reply streams: repeated replies dropped, full rounds of a job reported once.

Ids reach Python as Arrow columns or as rows, never as pandas columns, where a bigint
beside a null becomes a double. A null job is a job.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from itertools import chain, islice

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from pairmill.session import state_on_disk

JOB = "local_id"
TASK = ["local_id", "task_no"]


def first_replies(stream: DataFrame) -> DataFrame:
    """The reply stream without repeats: each reply counts once, however late they come.

    The state is the key of every reply seen, spread over all partitions; it grows with
    the tasks ever answered, which is the price of never counting one twice
    (`within_horizon` bounds it). Copies inside an Arrow batch go first, so a reply sent
    very often is not one hot key.
    """

    def batch_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = pa.array(range(batch.num_rows), pa.int64())
            keys = pa.table([batch["local_id"], batch["task_no"], at], names=["local_id", "task_no", "at"])
            first = keys.group_by(["local_id", "task_no"]).aggregate([("at", "min")])
            yield batch.take(first["at_min"].combine_chunks().sort())

    state_on_disk(stream.sparkSession)
    once = stream.mapInArrow(batch_first, stream.schema)
    return once.dropDuplicates(TASK)


# Parts of the state of `within_horizon`: the replies of one part are judged together.
HORIZON_PARTS = 4096


def within_horizon(stream: DataFrame, seconds: int, time: str = "ts", parts: int = HORIZON_PARTS) -> DataFrame:
    """First replies with state of bounded size: the columns of `stream` and `kept`.

    `time` is when a reply was made; its copies have the same. A reply more than `seconds`
    behind the latest one cannot be told from a copy of one that is forgotten: it comes
    out with `kept` false, to be stored as a reject, whether or not it is a copy. Copies
    of a kept reply that come in time are dropped, as in `first_replies`. So no reply is
    counted twice, and each is kept or rejected.

    A reply without a time can never be forgotten; it is judged by its key for ever.

    The state is one table of keys and times for each of `parts` parts of the keys, read
    and written once per micro-batch: a call of the state store for each reply took most
    of the time. A part holds the replies of the horizon over `parts`; a stream goes on
    with the number it was started with.
    """
    state_on_disk(stream.sparkSession)

    class Once(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.seen = handle.getValueState("seen", "keys binary")

        def held(self) -> dict:
            return pickle.loads(bytes(self.seen.get()[0])) if self.seen.exists() else {}

        def keep(self, made_of: dict) -> None:
            """Store the keys, and ask to be called when the first of them can go."""
            self.seen.update((pickle.dumps(made_of),))
            times = [made for made in made_of.values() if made is not None]
            if times:
                self.handle.registerTimer(min(times) + 1)

        def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
            horizon = timerValues.getCurrentWatermarkInMs()
            made_of = self.held()
            known = len(made_of)
            for row in rows:
                values = row.asDict()
                made = values.pop("_made")
                values.pop("_part")
                late = made is not None and made <= horizon
                reply = tuple(values[c] for c in keys)
                if late or reply not in made_of:
                    yield Row(**values, kept=not late)
                if not late and reply not in made_of:
                    made_of[reply] = made
            if len(made_of) > known:
                self.keep(made_of)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
            horizon = timerValues.getCurrentWatermarkInMs()
            before = self.held()
            made_of = {reply: made for reply, made in before.items() if made is None or made >= horizon}
            if not made_of:
                self.seen.clear()
            elif len(made_of) < len(before):
                self.keep(made_of)
            return iter(())

        def close(self) -> None:
            pass

    keys = list(TASK)
    schema = T.StructType([*stream.schema.fields, T.StructField("kept", T.BooleanType())])
    clock = F.col(time).cast("timestamp")
    part = F.pmod(F.xxhash64(*TASK), F.lit(parts)).cast("int")
    # The clock column itself goes on no further: Spark would drop rows that are late by it.
    timed = stream.withColumns({"_clock": clock, "_made": F.unix_millis(clock), "_part": part})
    timed = timed.withWatermark("_clock", f"{seconds} seconds").drop("_clock")
    return timed.groupBy("_part").transformWithState(Once(), schema, "append", "eventTime")


def countable(replies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Replies that say how many tasks their job has, and those that do not."""
    good = F.coalesce(F.col("num_tasks") > 0, F.lit(False))
    return replies.where(good), replies.where(~good)


def full_rounds(replies: DataFrame) -> DataFrame:
    """`local_id, round, replies`: each round of `num_tasks` replies, once it is full.

    Replies without a positive `num_tasks` belong to no round (see `countable`).

    The state of a job is two numbers. Its replies are counted per Arrow batch before
    the shuffle, so a job that sends a third of all replies still sends its one state
    a few rows.
    """

    # Inner functions travel to the workers by value: the package need not be there.
    def batch_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            jobs = pa.Table.from_batches([batch]).group_by("local_id")
            counted = jobs.aggregate([("num_tasks", "max"), ("num_tasks", "count")])
            names = ["local_id", "num_tasks_max", "num_tasks_count"]
            yield from counted.select(names).rename_columns(["local_id", "num_tasks", "replies"]).to_batches()

    class Count(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.count = handle.getValueState("count", "seen bigint, num_tasks bigint")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
            before, size = tuple(self.count.get()) if self.count.exists() else (0, 0)
            seen = before
            for row in rows:
                seen += row.replies
                size = size or row.num_tasks
            self.count.update((seen, size))
            for done in range(before // size, seen // size):
                yield Row(local_id=key[0], round=done, replies=size)

        def close(self) -> None:
            pass

    state_on_disk(replies.sparkSession)
    job = f"local_id {replies.schema['local_id'].dataType.simpleString()}"
    slim = replies.select("local_id", F.col("num_tasks").cast("bigint").alias("num_tasks"))
    counts = countable(slim)[0].mapInArrow(batch_counts, f"{job}, num_tasks bigint, replies bigint")
    schema = T.StructType.fromDDL(f"{job}, round bigint, replies bigint")
    return counts.groupBy(JOB).transformWithState(Count(), schema, "append", "none")


def round_replies(replies: DataFrame, arrival: Sequence[str] = ("ts", "task_no")) -> DataFrame:
    """The replies of each full round with `round` and `place`, handed out when it fills.

    Repeats must be gone. Replies count in the order of the micro-batches and, in one, by
    `arrival` (nulls last). The size of a job's rounds is that of its first reply. Replies
    without a positive `num_tasks` belong to no round (see `countable`).

    The state of a job is its count, its round size and the list of the replies of its
    open round, all on disk; a full round goes out row by row. A task holds the replies
    that one micro-batch has of one job, to sort them: bound a micro-batch by the files it
    may read.
    """

    def place_of(row: Row) -> tuple:
        return tuple((row[c] is None, row[c]) if row[c] is not None else (True, 0) for c in arrival)

    class Rounds(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.count = handle.getValueState("count", "seen bigint, num_tasks bigint")
            self.open = handle.getListState("open", state_schema)

        def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
            before, size = tuple(self.count.get()) if self.count.exists() else (0, 0)
            fresh = sorted(rows, key=place_of)
            size = size or fresh[0].num_tasks
            self.count.update((before + len(fresh), size))
            held = before % size
            full = (held + len(fresh)) // size * size
            if not full:
                self.open.appendList([tuple(r) for r in fresh])
                return
            ready = chain(self.open.get() if held else (), fresh)
            start = before // size
            for i, row in enumerate(islice(ready, full)):
                yield Row(**dict(zip(names, row, strict=True)), round=start + i // size, place=i % size + 1)
            rest = [tuple(r) for r in ready]
            if rest:
                self.open.put(rest)
            else:
                self.open.clear()

        def close(self) -> None:
            pass

    state_on_disk(replies.sparkSession)
    state_schema = replies.schema
    names = replies.columns
    wider = [T.StructField("round", T.LongType()), T.StructField("place", T.LongType())]
    schema = T.StructType([*replies.schema.fields, *wider])
    return countable(replies)[0].groupBy(JOB).transformWithState(Rounds(), schema, "append", "none")

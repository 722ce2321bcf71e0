"""Questions that blocks of documents ask of the whole corpus, and their answers.

A shard is a block of whole documents of bounded size, cut from one input partition in
row order. It sends the sorted names (64-bit) it asks about, each once, with a number or
two, to buckets of the name space; a bucket sees a name at most once per shard, so a
frequent name is no hot key. The answer to a shard is a list in the order it asked, so
names travel one way only and texts do not travel at all: a shard and its answers meet by
partition number.

Only buckets that a shard asks something of get a list from it, so there are no more lists
than names however many buckets there are, and what a shard costs does not grow with the
corpus.

Rows of the documents must come in the same partitions and order each time they are read;
tables read from files do. `stable` stores any other.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.serializers import BatchedSerializer, CPickleSerializer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairmill.session import durable

# Text of one shard, about; a longer text is a shard of its own.
SHARD_BYTES = 2 << 20
# Text whose names make up one bucket of the name space, about: the least, and the most,
# which holds once there would be more than MANY_BUCKETS.
BUCKET_BYTES = 5 << 20
MOST_BUCKET_BYTES = 32 << 20
MANY_BUCKETS = 2048
# Lists below this length are not worth compressing.
FEW = 64

# One row for each partition and bucket it asks; lists hold an entry for each of `shards`.
# A row with a bucket below 0 says how many shards the partition has.
ASKED = "part int, bucket int, shards array<int>, names array<binary>, numbers array<binary>"
ANSWER = "part int, bucket int, topic string, shards array<int>, answers array<binary>"


def stable(docs: DataFrame) -> DataFrame:
    """The rows, stored first unless they come straight from files."""
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    straight = all(
        line.lstrip(" +-:").startswith(("Relation", "Project", "Filter")) for line in plan.splitlines() if line
    )
    return docs if straight else durable(docs, "stable")


def give_back() -> None:
    """Hand freed memory back to the machine: idle workers would keep it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def bucket_count(docs: DataFrame) -> int:
    """Buckets of the name space: a bucket's names fit in a task at any input size."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, min(-(-size // BUCKET_BYTES), max(MANY_BUCKETS, -(-size // MOST_BUCKET_BYTES))))


def pack_bytes(values: np.ndarray) -> bytes:
    """Numbers as byte planes, compressed: planes of zeros take no room. A few go as they are."""
    if len(values) < FEW:
        return b"\0" + values.tobytes()
    wide = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize)
    return b"\1" + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(wide.T).tobytes())


def unpack_bytes(data: bytes, kind) -> np.ndarray:
    if not data[0]:
        return np.frombuffer(data, kind, offset=1)
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(kind)


def pack_names(names: np.ndarray) -> bytes:
    """Sorted names by their gaps; a few go as they are."""
    return pack_bytes(names if len(names) < FEW else np.diff(names, prepend=np.uint64(0)))


def unpack_names(data: bytes) -> np.ndarray:
    if not data[0]:
        return unpack_bytes(data, np.uint64)
    return np.cumsum(unpack_bytes(data, np.uint64), dtype=np.uint64)


def bucket_parts(names: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """The buckets that sorted names fall into, and the part of the names in each."""
    if not len(names):
        return
    if buckets == 1:
        yield 0, slice(0, len(names))
        return
    at = np.minimum(names // np.uint64((1 << 64) // buckets), np.uint64(buckets - 1))
    starts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    ends = np.append(starts[1:], len(names))
    for bucket, start, end in zip(at[starts].tolist(), starts.tolist(), ends.tolist(), strict=True):
        yield bucket, slice(start, end)


def chunks(batches: Iterator[pa.RecordBatch], most: int = SHARD_BYTES) -> Iterator[pa.Table]:
    """The partition's rows in tables whose texts hold about `most` bytes."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        upto = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            base = int(upto[at - 1]) if at else 0
            fit = int(np.searchsorted(upto, base + most - size, side="right"))
            to = max(at + (not held), fit)
            if to > at:
                held.append(batch.slice(at, to - at))
                size += int(upto[to - 1]) - base
                at = to
            if at < batch.num_rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def text_of(table: pa.Table) -> pa.Array:
    return pa.concat_arrays(table.column("text").chunks)


ASKED_ROWS = pa.schema(
    [
        ("part", pa.int32()),
        ("bucket", pa.int32()),
        ("shards", pa.list_(pa.int32())),
        ("names", pa.list_(pa.binary())),
        ("numbers", pa.list_(pa.binary())),
    ]
)
ROWS_A_BATCH = 256


class Questions:
    """What the shards of a partition ask, by bucket."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.shards = 0
        self.lists: dict[int, tuple[list[int], list[bytes], list[bytes]]] = {}

    def add(self, names: np.ndarray, numbers: np.ndarray) -> None:
        plain, plain_numbers, size = names.tobytes(), numbers.tobytes(), numbers.itemsize
        for bucket, part in bucket_parts(names, self.buckets):
            if bucket not in self.lists:
                self.lists[bucket] = [], [], []
            shards, packed, own = self.lists[bucket]
            shards.append(self.shards)
            # With very many buckets most lists are a name or two: cut from the whole.
            if part.stop - part.start < FEW:
                packed.append(b"\0" + plain[8 * part.start : 8 * part.stop])
                own.append(b"\0" + plain_numbers[size * part.start : size * part.stop])
            else:
                packed.append(pack_names(names[part]))
                own.append(pack_bytes(numbers[part]))
        self.shards += 1

    def rows(self, part: int) -> Iterator[tuple]:
        if self.shards:
            # Dealt to as many groups as there are buckets.
            yield part, -1 - part % self.buckets, [self.shards], [], []
        for bucket, lists in self.lists.items():
            yield part, bucket, *lists


class Answers(dict):
    """Answers to one shard: topic -> bucket -> bytes."""

    def get_list(self, topic: str, names: np.ndarray, buckets: int, kind) -> np.ndarray:
        """The answers to sorted `names`, in their order."""
        out = np.empty(len(names), kind)
        for bucket, part in bucket_parts(names, buckets):
            out[part] = unpack_bytes(self[topic][bucket], kind)
        return out


def partitions(docs: DataFrame) -> int:
    return docs.rdd.getNumPartitions()


def ask_first(docs: DataFrame, build: Callable, buckets: int) -> DataFrame:
    """Questions that need no answers: `build(table)` gives sorted names and numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = Questions(buckets)
        for table in chunks(batches):
            asked.add(*build(table))
        give_back()
        rows = asked.rows(TaskContext.get().partitionId())
        while some := list(islice(rows, ROWS_A_BATCH)):
            columns = [pa.array(x, f.type) for x, f in zip(zip(*some, strict=True), ASKED_ROWS, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=ASKED_ROWS)

    return docs.mapInArrow(run, ASKED)


def _row_chunks(rows: Iterator, most: int = SHARD_BYTES) -> Iterator[tuple[list, list]]:
    """The same shards as `chunks`, from rows of id, text and size of the text."""
    ids: list = []
    texts: list = []
    size = 0
    for doc, text, own in rows:
        own = own or 0
        if ids and size + own > most:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(doc)
        texts.append(text)
        size += own
    if ids:
        yield ids, texts


def _sorted_answers(rows: Iterator) -> Iterator[list]:
    """Of the answers to a partition, those to one shard after another."""
    count = 0
    held: dict[int, list] = {}
    for _, group in rows:
        for row in group:
            if row is None:
                continue
            _, bucket, topic, shards, lists = row
            if bucket < 0:
                count = max(count, shards[0])
            for shard, answer in zip(shards, lists, strict=bucket >= 0):
                held.setdefault(shard, []).append((topic, bucket, bytes(answer)))
    for number in range(max(count, max(held, default=-1) + 1)):
        yield held.pop(number, [])


def with_answers(docs: DataFrame, answers: DataFrame, visit: Callable, schema: T.StructType) -> DataFrame:
    """Rows of `visit(partition, shards)`; `shards` gives (table, answers) one by one.

    The documents stay where they are read; answers go to the partition that asked. Both
    pass through the task shard by shard.
    """
    count = partitions(docs)
    context = docs.sparkSession.sparkContext
    kind = pa.from_numpy_dtype("int64") if docs.schema["doc_id"].dataType == T.LongType() else None

    def run(part: int, pairs: Iterator) -> Iterator[tuple]:
        def shards() -> Iterator[tuple[pa.Table, Answers]]:
            for (ids, texts), sent in pairs:
                got = Answers()
                for topic, bucket, answer in sent:
                    got.setdefault(topic, {})[bucket] = answer
                columns = {"doc_id": pa.array(ids, kind), "text": pa.array(texts, pa.large_string())}
                yield pa.table(columns), got

        yield from visit(part, shards())
        give_back()

    sized = docs.select("doc_id", "text", F.octet_length("text"))
    read = sized.rdd.mapPartitions(_row_chunks)
    sent = answers.select("part", "bucket", "topic", "shards", "answers").rdd.map(lambda r: (r["part"], tuple(r)))
    none = context.parallelize(range(count), max(count, 1)).map(lambda p: (p, None))
    gathered = sent.union(none).groupByKey(count, partitionFunc=lambda p: p).mapPartitions(_sorted_answers)
    # A session may deal answers to more partitions; the documents have none there.
    spare = gathered.getNumPartitions() - count
    if spare:
        read = read.union(context.parallelize([], spare))
    one = BatchedSerializer(CPickleSerializer(), 1)
    paired = read._reserialize(one).zip(gathered._reserialize(one))
    return docs.sparkSession.createDataFrame(
        paired.mapPartitionsWithIndex(run), schema, verifySchema=False
    )


def ask(docs: DataFrame, answers: DataFrame, build: Callable, buckets: int) -> DataFrame:
    """Questions that need earlier answers: `build(table, answers)`."""

    def visit(part: int, shards: Iterator) -> Iterator[tuple]:
        asked = Questions(buckets)
        for table, got in shards:
            asked.add(*build(table, got))
        yield from asked.rows(part)

    return with_answers(docs, answers, visit, T.StructType.fromDDL(ASKED))


def answered(asked: DataFrame, topic: str, reduce: Callable, kind) -> DataFrame:
    """One bucket at a time: `reduce(names, numbers)` of all shards' questions.

    `names` and `numbers` are those of all shards one after another. The result is an
    array in that order, and a few sums over the whole bucket that come back in a row of
    partition -1.
    """

    columns = ["part", "bucket", "topic", "shards", "answers"]

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        bucket = int(rows["bucket"].iloc[0])
        asked_by = zip(rows["part"], rows["shards"], strict=True)
        if bucket < 0:
            return pd.DataFrame([(p, bucket, topic, x, []) for p, x in asked_by], columns=columns)
        lists = rows["names"].tolist()
        names = [unpack_names(x) for part in lists for x in part]
        numbers = [unpack_bytes(x, kind) for part in rows["numbers"] for x in part]
        ends = np.cumsum([len(x) for x in names])
        answers, sums = reduce(np.concatenate(names), np.concatenate(numbers))
        cut = iter(np.split(answers, ends[:-1]))
        made = [(p, bucket, topic, x, [pack_bytes(next(cut)) for _ in x]) for p, x in asked_by]
        if sums is not None:
            made.append((-1, bucket, topic, [0], [sums.astype(np.int64).tobytes()]))
        del names, numbers, answers
        give_back()
        return pd.DataFrame(made, columns=columns)

    return asked.groupBy("bucket").applyInPandas(run, ANSWER)


def grouped(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts names, and where each distinct one begins in that order."""
    order = np.argsort(names, kind="stable")
    line = names[order]
    first = np.flatnonzero(np.concatenate(([True], line[1:] != line[:-1]))) if len(line) else np.empty(0, int)
    return order, first


def summed(names: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """For each place, the sum of the numbers of its name."""
    order, first = grouped(names)
    out = np.empty(len(names), np.int64)
    if len(names):
        sums = np.add.reduceat(numbers[order].astype(np.int64), first)
        out[order] = np.repeat(sums, np.diff(np.append(first, len(names))))
    return out


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables that end where a group ends, of rows sorted by integer keys."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        if not table.num_rows:
            continue
        other = np.zeros(table.num_rows, bool)
        for key in keys:
            column = table.column(key).to_numpy()
            other |= column != column[-1]
        cut = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).combine_chunks()
    if held is not None and held.num_rows:
        yield held


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """First row of each group, and the number of rows."""
    changes = np.zeros(table.num_rows, bool)
    changes[:1] = True
    for key in keys:
        column = table.column(key).to_numpy()
        changes[1:] |= column[1:] != column[:-1]
    return np.append(np.flatnonzero(changes), table.num_rows)

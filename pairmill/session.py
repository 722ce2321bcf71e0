"""Session defaults and durable intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Keeps the state of streams on disk; Spark's default keeps all of it on the heap.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Runtime settings the plans are written for. All are ordinary Spark options, so a
# cluster can override any of them with spark-submit --conf.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str = "pairmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with DEFAULTS applied; `conf` uses `__` for dots, and wins."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Counting pairs shuffles several times its text; a reduce task should take about this,
# which it spills through in sorted runs. Up to FINE_TASKS take less, which they can hold.
SHUFFLE_GROWTH = 8
SHUFFLE_BYTES = 1024 * 1024 * 1024
FINE_BYTES = 32 * 1024 * 1024
FINE_TASKS = 2048


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Raise the shuffle partitions to what an input of that size needs; return them.

    Spark's default of 200 is for gigabytes. Too many do no harm: adaptive execution
    joins small ones. 100 TB make 800,000 partitions of 1 GiB.
    """
    wanted = max(
        -(-input_bytes * SHUFFLE_GROWTH // SHUFFLE_BYTES), 2 * spark.sparkContext.defaultParallelism
    )
    count = max(wanted, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set("spark.sql.shuffle.partitions", str(count))
    return count


def fine_tasks(spark: SparkSession, input_bytes: int) -> int:
    """Tasks for a sum of what an input of that size makes that is to be held in memory.

    A number of its own, as adaptive execution would join the partitions to larger ones.
    """
    made = input_bytes * SHUFFLE_GROWTH
    fine = min(-(-made // FINE_BYTES), FINE_TASKS)
    return max(fine, -(-made // SHUFFLE_BYTES), 2 * spark.sparkContext.defaultParallelism)


# Documents that a Python worker gets at once: some megabytes of tokens, of which it holds two
# batches and the JVM one more. Spark's 10,000 are 50 MB and beyond.
BATCH_ROWS = 1000


def bound_batches(spark: SparkSession) -> None:
    """Lower the rows of an Arrow batch to BATCH_ROWS; a lower setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    held = int(spark.conf.get(key))
    if not 0 < held <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def state_on_disk(spark: SparkSession) -> None:
    """Keep the state of the streams that start from here on in RocksDB.

    Lists and timers of a job need it, and so does the set of all replies ever seen. A
    stream that goes on from a checkpoint keeps the store it was started with.
    """
    for key in DEFAULTS:
        if "stateStore" in key:
            spark.conf.set(key, DEFAULTS[key])


def planned_bytes(df: DataFrame) -> int:
    """What the optimizer expects the rows to take: for tables of files, from their size.

    0 where it knows nothing, as of rows made by a program.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size < 1 << 60 else 0


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for durable tables: `spark.checkpoint.dir`.

    Only a local master, which has one machine and so no shared folder, gets a
    temporary folder when nothing is set. On a cluster an unset folder is an error:
    a machine-local one would be lost with its executor.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    made = tempfile.mkdtemp(prefix="pairmill-")
    context.setCheckpointDir(made)
    return made


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{_own_dir(spark)}/{label}-{uuid.uuid4().hex}"


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/pairmill/{spark.sparkContext.applicationId}"


def release(spark: SparkSession, path: str | None = None) -> None:
    """Delete this application's stored tables, or the one at `path`, when no plan reads them."""
    gone = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path or _own_dir(spark))
    gone.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(gone, True)


def publish(spark: SparkSession, made: str, path: str) -> None:
    """Give a finished folder its name in one step, so that a stream sees all of it or nothing."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    to = hadoop.Path(path)
    system = to.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(to.getParent())
    if not system.rename(hadoop.Path(made), to):
        raise OSError(f"{made} could not become {path}")


def exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def is_folder(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory()


def durable(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as a table in the shared folder and read it back.

    This cuts the lineage: a lost executor re-reads files instead of replaying the
    plan, which also pins values such as partition numbers that a replay could change.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def computed_once(df: DataFrame, label: str) -> DataFrame:
    """Store `df` unless it only reads files: for steps that would evaluate it more than once.

    A sort over ranges, for one, evaluates its input for a sample of the keys first.
    """
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    cheap = ("Relation", "Project", "Filter")
    lines = [line.lstrip(" +-:") for line in plan.splitlines() if line]
    reads = all(line.startswith(cheap) for line in lines) and "PythonUDF" not in plan
    return df if reads else durable(df, label)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give an input with fewer splits than cores enough of them.

    One row group is one scan task however many cores wait. An input with plenty of
    splits, which is what a cluster reads, is returned as it is: no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores * 2, *[F.col(k) for k in keys])

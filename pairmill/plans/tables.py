"""Inputs of the registered queries, derived from the test tables.

The tables hold no yearly n-grams, labels, task lists or replies, so each is derived
by a fixed rule that SQL can state too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairmill.functions.text import words
from pairmill.operators.evaluation import label_set
from pairmill.operators.skew import number_rows
from pairmill.session import fresh_path, spread

BUCKET = "results"
BATCH = 7
ROUND = 20
LABEL_MIN_COUNT = 20
RELATED_MIN_LETTERS = 5


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """`doc_id, source, year, text`: years 1990..2009 by document number."""
    rows = table(spark, sf, "documents").select(
        "doc_id", "source", (F.lit(1990) + F.col("doc_id") % 20).alias("year"), "text"
    )
    return spread(rows, "doc_id")


def adjacent_words(spark: SparkSession, sf: str) -> DataFrame:
    """`a, b`: each two neighbouring words of the documents, as they are written."""
    split = documents(spark, sf).select(words(F.col("text")).alias("t"))
    sized = split.withColumn("n", F.size("t"))
    both = F.arrays_zip(F.slice("t", 1, F.greatest(F.col("n") - 1, F.lit(0))), F.slice("t", 2, F.col("n")))
    return sized.where("n > 1").select(F.inline(both).alias("a", "b"))


def labels(pairs: DataFrame) -> DataFrame:
    """Labels for the frequent pairs: related if both words are long."""
    frequent = pairs.where((F.col("c_pair") >= LABEL_MIN_COUNT) & (F.col("w1") != F.col("w2")))
    long = (F.length("w1") >= RELATED_MIN_LETTERS) & (F.length("w2") >= RELATED_MIN_LETTERS)
    return label_set(frequent.where(long), frequent.where(~long))


def _task_columns() -> list:
    page = F.col("page_id")
    operation = F.element_at(
        F.array(*[F.lit(o) for o in ("ToText", "ToHTML", "ToImage", "ToWord")]),
        (page % 4 + 1).cast("int"),
    )
    url = F.when(page % 10 == 3, F.concat(F.lit("missing://"), page.cast("string")))
    return [
        F.concat(F.lit("job"), (page % 5).cast("string")).alias("local_id"),
        operation.alias("operation"),
        F.coalesce(url, F.col("url")).alias("url"),
    ]


def task_rows(pages: DataFrame) -> DataFrame:
    """`page_id, local_id, operation, url` of a page table or stream."""
    return pages.select("page_id", *_task_columns())


def tasks(spark: SparkSession, sf: str) -> DataFrame:
    """Numbered tasks: `local_id, task_no, num_tasks, operation, url`."""
    rows = task_rows(table(spark, sf, "pages"))
    numbered = number_rows(rows, ["local_id"], ["page_id"], "task_no", "num_tasks")
    return numbered.select("local_id", "task_no", "num_tasks", "operation", "url")


def page_documents(spark: SparkSession, sf: str) -> DataFrame:
    """`url, html`, where some pages are empty."""
    pages = table(spark, sf, "pages")
    html = F.when(F.col("page_id") % 25 == 7, "").otherwise(F.col("html"))
    return spread(pages.select("page_id", "url", html.alias("html")), "page_id").drop("page_id")


EVENT_STREAM = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)
PAGE_STREAM = "page_id bigint, url string, html string"


def replies_of(events: DataFrame) -> DataFrame:
    """Replies of an event table or stream."""
    return events.select(
        F.col("user_id").alias("local_id"),
        F.col("event_id").alias("task_no"),
        F.lit(ROUND).cast("bigint").alias("num_tasks"),
        F.col("event_type").alias("operation"),
        (F.col("event_type") == "error").alias("is_error"),
        "ts",
    )


def replies(spark: SparkSession, sf: str) -> DataFrame:
    return replies_of(table(spark, sf, "events"))


def repeated(rows: DataFrame) -> DataFrame:
    """Replies with every tenth one delivered twice."""
    copies = F.when(F.col("task_no") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("*", F.explode(copies).alias("_copy")).drop("_copy")


def answered(rows: DataFrame) -> DataFrame:
    """Replies of the event table with a url and a result."""
    url = F.concat(F.lit("event://"), F.col("task_no").cast("string"))
    return rows.withColumns({"url": url, "result": F.concat(F.lit("done://"), F.col("task_no").cast("string"))})


REPLY_STREAM = (
    "local_id bigint, task_no bigint, num_tasks bigint, operation string, is_error boolean, ts timestamp_ntz"
)
# Micro-batches of the reply streams, at least.
REPLY_BATCHES = 4
REPEAT_SECONDS = 400


def write_reply_files(spark: SparkSession, sf: str) -> tuple[str, int]:
    """The replies as files whose times overlap; every tenth again, later, in another file."""
    rows = replies(spark, sf).withColumn("file", F.col("task_no") % REPLY_BATCHES)
    late = F.expr(f"ts + interval {REPEAT_SECONDS} seconds")
    again = rows.where("task_no % 10 = 0").withColumns(
        {"ts": late, "file": (F.col("file") + 1) % REPLY_BATCHES}
    )
    path = fresh_path(spark, "reply-files")
    rows.unionByName(again).repartition("file").write.partitionBy("file").parquet(path)
    return path, len(spark.read.parquet(path).inputFiles())


def write_task_lists(spark: SparkSession, sf: str) -> str:
    """Task lists by job, 000 to 004; the lines of some pages lack their tab."""
    rows = task_rows(table(spark, sf, "pages"))
    line = F.concat_ws("\t", "operation", "url")
    broken = F.when(F.col("page_id") % 7 == 3, F.col("url")).otherwise(line)
    job = F.concat(F.lit("00"), (F.col("page_id") % 5).cast("string"))
    path = fresh_path(spark, "task-lists")
    rows.select(job.alias("local_id"), broken.alias("value")).write.partitionBy("local_id").text(path)
    return path


# Ids from here on are no doubles.
WIDE = 1 << 53
SLICES = 4
HORIZON_SECONDS = 10 * 86_400
LATE_SECONDS = 40

WIDE_STREAM = REPLY_STREAM


def wide_replies(spark: SparkSession, sf: str) -> DataFrame:
    """Replies with ids beyond 2**53, one null job, and `slice`, the quarter of their time."""
    rows = replies(spark, sf).withColumn("_second", F.unix_seconds(F.col("ts").cast("timestamp")))
    span = rows.agg(F.min("_second").alias("low"), F.max("_second").alias("high")).first()
    low, high = span.low or 0, span.high or 0
    part = F.expr(f"(_second - {low}) * {SLICES} div {high - low + 1}")
    return rows.select(
        F.when(F.col("local_id") % 25 != 0, F.col("local_id") + WIDE).alias("local_id"),
        (F.col("task_no") + WIDE).alias("task_no"),
        "num_tasks",
        "operation",
        "is_error",
        "ts",
        part.cast("int").alias("slice"),
    )


def delivered(spark: SparkSession, sf: str) -> DataFrame:
    """The wide replies as they are delivered: `slice` is the quarter they arrive in.

    Every tenth comes again one quarter later, every seventh comes two quarters late.
    """
    rows = wide_replies(spark, sf)
    number = F.col("task_no") - WIDE
    late = F.col("slice") + F.when(number % 7 == 3, 2).otherwise(0)
    again = rows.where(number % 10 == 0).withColumn("slice", late + 1)
    return rows.withColumn("slice", late).unionByName(again)


TASK_STREAM = "local_id bigint, task_no bigint, operation string, sent_at timestamp"
ANSWER_STREAM = "local_id bigint, task_no bigint, answered_at timestamp"


def sent_tasks(spark: SparkSession, sf: str) -> DataFrame:
    """A task for each wide reply, sent when that one was made, and its quarter."""
    sent = F.col("ts").cast("timestamp").alias("sent_at")
    return wide_replies(spark, sf).select("local_id", "task_no", "operation", sent, "slice")


def answers(spark: SparkSession, sf: str) -> DataFrame:
    """Answers to the sent tasks, 0 to 240 s later; every 17th task has none."""
    number = F.col("task_no") - WIDE
    rows = sent_tasks(spark, sf).where(number % 17 != 0)
    delay = F.make_dt_interval(secs=(number % 7 * LATE_SECONDS).cast("int"))
    return rows.select("local_id", "task_no", (F.col("sent_at") + delay).alias("answered_at"), "slice")


def heartbeat(rows: DataFrame, time: str) -> DataFrame:
    """A row without job and task, a day after all others, in a quarter of its own."""
    later = rows.agg((F.max(time) + F.expr("interval 1 day")).alias(time))
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields if f.name not in (time, "slice")]
    return later.select(*nulls, time, F.lit(SLICES).alias("slice")).select(*rows.columns)


ORDERED_TASK = "local_id string, task_no bigint, num_tasks bigint, operation string, url string, at bigint"


def _in_quarters(rows: DataFrame, at: str) -> DataFrame:
    """`slice`: the quarter of the range of the given number."""
    span = rows.agg(F.min(at).alias("low"), F.max(at).alias("high")).first()
    low, high = span.low or 0, span.high or 0
    return rows.withColumn("slice", F.expr(f"({at} - {low}) * {SLICES} div {high - low + 1}").cast("int"))


def task_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    """The page tasks in four quarters of page numbers; each quarter's tasks come again for
    another job one quarter later."""
    rows = task_rows(table(spark, sf, "pages"))
    numbered = number_rows(rows, ["local_id"], ["page_id"], "task_no", "num_tasks")
    first = _in_quarters(numbered, "page_id").drop("page_id")
    again = first.withColumns(
        {"local_id": F.replace("local_id", F.lit("job"), F.lit("again")), "slice": F.col("slice") + 1}
    )
    return first.unionByName(again)


def ordered_tasks(spark: SparkSession, sf: str) -> tuple[DataFrame, int]:
    """Tasks of many jobs that begin one after another, and the order number of a marker."""
    rows = task_rows(table(spark, sf, "pages"))
    job = F.expr("concat('job', (page_id + 7 * (page_id % 3)) div 20)")
    numbered = number_rows(rows.withColumn("local_id", job), ["local_id"], ["page_id"], "task_no", "num_tasks")
    placed = _in_quarters(numbered, "page_id").withColumn("at", 2 * F.col("page_id")).drop("page_id")
    last = placed.agg(F.max("at")).first()[0] or 0
    return placed, last // 4 * 2 + 1


# Put behind each page: references of all kinds, and a script that names another tag.
REFERENCES = (
    "<p>it&#8217;s caf&eacute; &amp;lt; &#x41;&nbsp;&unknown; &#0; &#1114112; &#55296; &hearts;&copy;</p>"
    "<script>a</style>b</script><style>c</script>d</style >e"
)

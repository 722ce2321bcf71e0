"""Bulk document conversion with the error kept on the row.

Tables: tasks `local_id, task_no, num_tasks, operation, url`; documents `url, html`;
replies: the task columns with `result` (a link or an error text) and `is_error`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairmill.functions.html import html_to_text, text_to_html
from pairmill.operators.skew import lookup_join
from pairmill.session import durable

# Error texts, and name prefix and ending of each operation's results.
LOAD_ERROR = "java.io.FileNotFoundException: "
INVALID = "Invalid operation"
CORRUPTED = "Corrupted File"
RESULT_NAMES = {"ToImage": ("IMAGE", "1.png"), "ToHTML": ("HTML", ".html"), "ToText": ("TEXT", ".txt")}

# What each operation makes of a document. Any other operation is invalid, and so is
# ToImage, for which there is no converter here.
CONVERTERS: dict[str, Callable[[Column], Column]] = {
    "ToHTML": lambda html: text_to_html(html_to_text(html)),
    "ToText": html_to_text,
}

DEFAULT_BASE = "https://results.example/"


def work_items(tasks: DataFrame) -> DataFrame:
    """Each (operation, url) once, with its number of tasks.

    However many tasks ask for one document, it is fetched and converted once per
    operation; the partial sums also keep a much-asked url out of the shuffle.
    """
    return tasks.groupBy("operation", "url").agg(F.count(F.lit(1)).alias("requests"))


def fetch(work: DataFrame, documents: DataFrame) -> DataFrame:
    """Work items with their document; `html` is null where there is none.

    Found and missing items are two joins, so that the bodies of documents nobody
    asked for stay where they are when the work list is small enough to be broadcast,
    and the search for missing ones reads the url column only. Of a url that is listed
    more than once the least text counts, so that a work item has one document.
    """
    asked = documents.select("url", "html").join(work.select("url"), "url", "left_semi")
    found = work.join(asked.groupBy("url").agg(F.min("html").alias("html")), "url")
    missing = work.join(documents.select("url"), "url", "left_anti")
    return found.unionByName(missing.withColumn("html", F.lit(None).cast("string")))


def load_error(html: Column, url: Column) -> Column:
    return F.when(html.isNull(), F.concat(F.lit(LOAD_ERROR), F.coalesce(url, F.lit("null"))))


def converted(
    fetched: DataFrame, converters: dict[str, Callable[[Column], Column]] | None = None
) -> DataFrame:
    """Add `content` and `error`, one of which is null.

    The first error that applies is kept: no document, then no such operation, then
    an empty result.
    """
    converters = converters or CONVERTERS
    operation, html = F.col("operation"), F.col("html")
    content = F.lit(None).cast("string")
    for name, convert in converters.items():
        content = F.when(operation == name, convert(html)).otherwise(content)
    with_content = fetched.withColumn("content", content)
    error = (
        F.when(html.isNull(), load_error(html, F.col("url")))
        .when(operation.isNull() | ~operation.isin(*converters), INVALID)
        .when(F.length("content") == 0, CORRUPTED)
    )
    return with_content.select(
        *[c for c in fetched.columns if c != "html"],
        error.alias("error"),
        F.when(error.isNull(), F.col("content")).alias("content"),
    )


def converted_by(
    fetched: DataFrame, operation: str, convert: Callable[[pd.Series], pd.Series]
) -> DataFrame:
    """`converted` for one operation with a user's function over batches of html.

    An exception fails the row it comes from, not the job: the batch is tried whole
    and, if that raises, row by row. The other columns pass as they are, in Arrow.
    """

    def attempt(html: pd.Series) -> tuple[pd.Series, pd.Series]:
        try:
            return convert(html), pd.Series(None, index=html.index, dtype=object)
        except Exception as problem:
            if len(html) == 1:
                return pd.Series([None], html.index), pd.Series([repr(problem)], html.index)
            pairs = [attempt(html.iloc[i : i + 1]) for i in range(len(html))]
            return pd.concat([p[0] for p in pairs]), pd.concat([p[1] for p in pairs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            html = batch["html"].to_pandas()[batch["_own"].to_numpy(zero_copy_only=False)]
            content, problem = attempt(html) if len(html) else (html, html)
            made = [
                pa.array(x.reindex(range(batch.num_rows)).astype(object).where(lambda v: v.notna(), None), pa.string())
                for x in (problem, content)
            ]
            columns = [batch[f.name] for f in names]
            yield pa.RecordBatch.from_arrays([*columns, batch["_own"], *made], names=[*labels, "_own", "error", "content"])

    names = [f for f in fetched.schema.fields if f.name != "html"]
    labels = [f.name for f in names]
    own = F.coalesce(F.col("html").isNotNull() & (F.col("operation") == operation), F.lit(False))
    # No document, then no such operation: what other rows get is known beforehand.
    missing = F.coalesce(load_error(F.col("html"), F.col("url")), F.lit(INVALID))
    marked = fetched.select(*labels, "html", own.alias("_own"), F.when(~own, missing).alias("_missing"))
    names = [*names, marked.schema["_missing"]]
    labels = [f.name for f in names]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in names)
    done = marked.mapInArrow(run, f"{schema}, _own boolean, error string, content string")
    empty = F.when(F.col("_own") & (F.length("content") == 0), CORRUPTED)
    error = F.coalesce("_missing", "error", empty)
    return done.select(
        *labels[:-1], error.alias("error"), F.when(error.isNull(), F.col("content")).alias("content")
    )


def result_name(operation: Column, local_id: Column, task_no: Column) -> Column:
    """A name per task that a retry reproduces."""
    digest = F.sha2(F.concat_ws(",", local_id, task_no.cast("string")), 256)
    name = F.lit(None).cast("string")
    for op, (prefix, ending) in RESULT_NAMES.items():
        name = F.when(operation == op, F.concat(F.lit(prefix), digest, F.lit(ending))).otherwise(name)
    return name


def result_link(bucket: Column, name: Column, base: str = DEFAULT_BASE) -> Column:
    return F.concat(F.lit(base), bucket, F.lit("/"), name)


# Tasks of one work item served by one copy of its content.
TASKS_PER_COPY = 10_000


def _never_null(name: str) -> Column:
    return F.when(F.col(name).isNull(), "-").otherwise(F.concat(F.lit("+"), F.col(name)))


def replies(tasks: DataFrame, outcomes: DataFrame, bucket: str, base: str = DEFAULT_BASE) -> DataFrame:
    """One reply per task, from the stored outcomes of the work items.

    Only (operation, url, error) is joined to the tasks, not the content, and a url
    that very many tasks name does not gather them in one task (see lookup_join).
    """
    # As texts of their own, a null operation and a null url meet their outcome too.
    safe = {"_operation": _never_null("operation"), "_url": _never_null("url")}
    slim = outcomes.withColumns(safe).select(*safe, "error", "requests")
    rows = lookup_join(
        tasks.withColumns(safe), slim, "requests", {k: k for k in safe}, {"error": "error"}, ["task_no"]
    )
    link = result_link(
        F.lit(bucket), result_name(F.col("operation"), F.col("local_id"), F.col("task_no")), base
    )
    return rows.select(
        *tasks.columns,
        F.coalesce("error", link).alias("result"),
        F.col("error").isNotNull().alias("is_error"),
    )


def result_contents(tasks: DataFrame, outcomes: DataFrame) -> DataFrame:
    """`local_id, task_no, operation, name, content`: one result per task that succeeded.

    Work items with many tasks are copied once per TASKS_PER_COPY of them, and each
    task meets one of the copies, so no task of the join writes a whole hot item.
    """
    done = outcomes.where(F.col("error").isNull())
    asked = lookup_join(
        tasks,
        done.select("operation", "url", "requests"),
        "requests",
        {"operation": "operation", "url": "url"},
        {"requests": "requests"},
        ["task_no"],
    )
    last_copy = (F.col("requests") / F.lit(TASKS_PER_COPY)).cast("int")
    wanted = asked.withColumn("copy", F.pmod(F.hash("local_id", "task_no"), last_copy + 1))
    copies = done.select(
        "operation", "url", "content", F.explode(F.sequence(F.lit(0), last_copy)).alias("copy")
    )
    name = result_name(F.col("operation"), F.col("local_id"), F.col("task_no"))
    return wanted.join(copies, ["operation", "url", "copy"]).select(
        "local_id", "task_no", "operation", name.alias("name"), "content"
    )


def convert_tasks(tasks: DataFrame, documents: DataFrame, bucket: str) -> tuple[DataFrame, DataFrame]:
    """Convert every task: the stored outcomes of the work items and the replies."""
    work = durable(work_items(tasks), "work")
    outcomes = durable(converted(fetch(work, documents)), "outcomes")
    return outcomes, replies(tasks, outcomes, bucket)

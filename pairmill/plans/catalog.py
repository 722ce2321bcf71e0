"""The registered queries: name -> f(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairmill.functions import messages
from pairmill.functions.html import html_to_plain, html_to_text, text_to_html
from pairmill.operators import conversion, evaluation, jobs, ngrams, pairs, scoring
from pairmill.plans import counters, flow, tables
from pairmill.session import durable, fresh_path, publish, spread
from pairmill.sinks import keyvalue as kv_out
from pairmill.sinks import objects, report
from pairmill.sinks import sequencefile as seq_out
from pairmill.sources import corpus as corpus_in
from pairmill.sources import keyvalue as kv_in
from pairmill.sources import labels as label_in
from pairmill.sources import sequencefile as seq_in
from pairmill.sources import summary as summary_in
from pairmill.sources import tasks as task_in
from pairmill.streaming import completion, control, intake, pending
from pairmill.streaming import conversion as stream_conversion

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def six(*names: str) -> dict:
    """Doubles as they are compared: six decimals."""
    return {n: F.round(n, 6) for n in names}


def counts(spark, sf) -> flow.Counts:
    return flow.from_text(tables.documents(spark, sf))


def stats(spark, sf) -> DataFrame:
    return counts(spark, sf).stats()


def labelled(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Base-10 scores of the labelled pairs of the label decade, and the labels.

    Of the pair table the label decade and the pairs that may give a label are stored, by
    decade: the labels come from it, and of the label decade alone the pairs with a label
    go on to the word weights.
    """
    text = counts(spark, sf)
    path = fresh_path(spark, "pairs")
    needed = (F.col("decade") == evaluation.LABEL_DECADE) | (F.col("c_pair") >= tables.LABEL_MIN_COUNT)
    text.pairs.where(needed).write.partitionBy("decade").parquet(path)
    stored = spark.read.schema(text.pairs.schema).parquet(path)
    labels = durable(tables.labels(stored), "labels")
    in_decade = stored.where(F.col("decade") == evaluation.LABEL_DECADE)
    wanted = flow.Counts(evaluation.labelled_only(in_decade, labels), text.marginals, text.totals)
    return scoring.scored(wanted.stats(), base10=True), labels


# --- n-grams, pairs, words ---------------------------------------------------------


@query
def ngram_counts(spark, sf):
    return ngrams.ngram_counts(tables.documents(spark, sf))


@query
def pair_events(spark, sf):
    """Pair events of the n-gram table, counted per pair so that each one shows."""
    events = ngrams.pair_events(ngrams.ngram_counts(tables.documents(spark, sf)))
    return events.groupBy("decade", "w1", "w2").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum("weight").alias("weight"),
        F.max("weight").alias("heaviest"),
    )


@query
def center_pair_counts(spark, sf):
    table = ngrams.ngram_counts(tables.documents(spark, sf))
    return pairs.pair_counts(ngrams.pair_events(table, pairing="center"))


@query
def canonical_pairs(spark, sf):
    rows = pairs.canonical_pairs(tables.adjacent_words(spark, sf), "a", "b")
    return rows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n"))


@query
def canonical_pairs_cs(spark, sf):
    rows = pairs.canonical_pairs(tables.adjacent_words(spark, sf), "a", "b", lowercase=False)
    return rows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n"))


@query
def pair_counts(spark, sf):
    return counts(spark, sf).pairs


@query
def word_marginals(spark, sf):
    """From the pair table and the singles, as for imported counts."""
    text = counts(spark, sf)
    return pairs.word_marginals(text.pairs, text.singles())


@query
def token_marginals(spark, sf):
    """The same numbers from the tokens, as the flow uses them."""
    return counts(spark, sf).marginals


@query
def decade_totals(spark, sf):
    return counts(spark, sf).totals


@query
def decade_totals_all_years(spark, sf):
    """Totals of documents dated from 1880 to 2039."""
    docs = tables.documents(spark, sf).withColumn("year", F.lit(1880) + F.col("doc_id") % 160)
    return flow.from_text(docs).totals


@query
def ngram_files(spark, sf):
    """The n-gram table written as text with broken lines, read back, and counted by decade."""
    path = fresh_path(spark, "ngram-text")
    table = ngrams.ngram_counts(tables.documents(spark, sf))
    line = F.concat_ws("\t", *[F.col(c).cast("string") for c in corpus_in.FIELDS])
    broken = F.when(F.col("occurrences") >= 3, F.replace(line, F.lit("\t"), F.lit(" "))).otherwise(line)
    table.select(broken.alias("value")).write.text(path)
    good, bad = corpus_in.read_ngrams(spark, path)
    years = good.groupBy("year").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("occurrences").alias("occurrences")
    )
    return years.unionByName(
        bad.agg(F.lit(None).cast("int").alias("year"), F.count(F.lit(1)).alias("lines"), F.lit(None).cast("bigint").alias("occurrences"))
    )


@query
def pair_stats(spark, sf):
    return stats(spark, sf)


@query
def self_pairs(spark, sf):
    same = stats(spark, sf).where("w1 = w2")
    pmi = scoring.scored(same).withColumns(six("pmi"))
    return same.drop("n_total").join(pmi, ["decade", "w1", "w2"])


@query
def pmi(spark, sf):
    return scoring.scored(stats(spark, sf)).withColumns(six("pmi"))


@query
def ranked_pairs(spark, sf):
    return scoring.ranked_pairs(scoring.scored(stats(spark, sf))).withColumns(six("pmi"))


@query
def top_pairs(spark, sf):
    return scoring.top_pairs(scoring.scored(stats(spark, sf))).withColumns(six("pmi"))


@query
def stage_record_counts(spark, sf):
    text = counts(spark, sf)
    return pairs.stage_record_counts(text.stats(), text.singles(), text.marginals)


@query
def stage_counters(spark, sf):
    """What the stages themselves counted while the scores were made."""
    _, seen = counters.counted_run(counts(spark, sf))
    return counters.stage_records(seen, spark)


# --- key/value text and sequence files ---------------------------------------------


@query
def kv_format(spark, sf):
    return kv_out.format_kv(stats(spark, sf), "stats").select("decade", "line")


@query
def kv_parse(spark, sf):
    lines = kv_out.format_kv(stats(spark, sf), "stats").select(F.col("line").alias("value"))
    parsed = kv_in.parse_kv(lines, "stats")
    return parsed.withColumn("is_bad", F.col("bad").isNotNull()).drop("bad")


@query
def kv_files(spark, sf):
    """The statistics written as text by decade, read back and parsed."""
    path = fresh_path(spark, "kv")
    kv_out.write_kv(stats(spark, sf), path, "stats")
    parsed = kv_in.parse_kv(spark.read.text(path).select("value"), "stats")
    return parsed.withColumn("is_bad", F.col("bad").isNotNull()).drop("bad")


@query
def pmi_list_files(spark, sf):
    """Scores written as a list with broken lines, read back from files; rejects counted."""
    path = fresh_path(spark, "pmi-list")
    lines = kv_out.format_kv(scoring.scored(stats(spark, sf)), "scores")
    broken = F.when(F.col("w1").startswith("t"), F.replace("line", F.lit("\t"), F.lit(" "))).otherwise(F.col("line"))
    lines.select(broken.alias("value")).write.text(path)
    good, bad = kv_in.read_pmi_list(spark, path, evaluation.LABEL_DECADE)
    kinds = [(good, "good"), (bad, "reject")]
    counted = [x.agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("lines")) for x, kind in kinds]
    return counted[0].unionByName(counted[1])


@query
def row_kinds(spark, sf):
    text = counts(spark, sf)
    rows = kv_out.legacy_rows(text.pairs, text.singles(), text.totals)
    lines = kv_out.format_kv(rows).select(F.col("line").alias("value"))
    return kv_in.parse_kv(lines).groupBy("decade", "kind").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("c_pair").alias("c_pair"),
        F.sum("c_w1").alias("c_w1"),
        F.count("bad").alias("bad"),
    )


@query
def seqfile_pairs(spark, sf):
    scores, labels = labelled(spark, sf)
    path = fresh_path(spark, "seqfile")
    seq_out.write_pairs(scores, path)
    read = seq_in.read_pairs(spark, path, evaluation.LABEL_DECADE)
    return evaluation.labelled_only(read, labels).withColumns(six("pmi"))


# --- evaluation --------------------------------------------------------------------


def sweep(spark, sf) -> DataFrame:
    scores, labels = labelled(spark, sf)
    lines = kv_out.format_kv(evaluation.labelled_only(scores, labels), "scores")
    listed, _ = kv_in.parse_pmi_list(lines.select(F.col("line").alias("value")), evaluation.LABEL_DECADE)
    return evaluation.f_measure_sweep(evaluation.with_labels(listed, labels))


RATES = ("threshold", "precision", "recall", "f_measure")


@query
def gold_pairs(spark, sf):
    return tables.labels(counts(spark, sf).pairs)


@query
def builtin_labels_scored(spark, sf):
    """The built-in list with the scores that the documents give; null where they have none.

    Only events of labelled pairs are counted.
    """
    labels = label_in.builtin_labels(spark)
    text = counts(spark, sf)
    events = ngrams.text_pair_events(tables.documents(spark, sf))
    labelled_pairs = pairs.pair_counts(evaluation.labelled_events(events, labels))
    wanted = flow.Counts(labelled_pairs, text.marginals, text.totals)
    scores = scoring.scored(wanted.stats(), base10=True)
    return labels.join(scores, ["decade", "w1", "w2"], "left").withColumns(six("pmi"))


@query
def gold_labeled(spark, sf):
    return evaluation.with_labels(*labelled(spark, sf)).withColumns(six("pmi"))


@query
def gold_pmi(spark, sf):
    found = evaluation.labelled_only(*labelled(spark, sf))
    return scoring.in_score_order(found).withColumns(six("pmi"))


@query
def f_measure_sweep(spark, sf):
    return sweep(spark, sf).withColumns(six(*RATES))


@query
def f_measure_climb(spark, sf):
    accepted = evaluation.accepted_steps(sweep(spark, sf))
    return accepted.select("step", *RATES).withColumns(six(*RATES))


@query
def f_measure_best(spark, sf):
    best = evaluation.best_step(sweep(spark, sf))
    return best.select("step", *RATES).withColumns(six(*RATES))


# --- conversion --------------------------------------------------------------------


def page_replies(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    tasks = tables.tasks(spark, sf)
    outcomes, replies = conversion.convert_tasks(
        tasks, tables.page_documents(spark, sf), tables.BUCKET
    )
    return tasks, outcomes, replies


@query
def conversion_tasks(spark, sf):
    return tables.tasks(spark, sf)


@query
def task_batches(spark, sf):
    return jobs.task_batches(tables.tasks(spark, sf), tables.BATCH)


@query
def fetch_status(spark, sf):
    work = conversion.work_items(tables.tasks(spark, sf))
    fetched = conversion.fetch(work, tables.page_documents(spark, sf))
    return fetched.select(
        "operation",
        "url",
        "requests",
        F.coalesce(F.length("html"), F.lit(0)).cast("bigint").alias("n_chars"),
        conversion.load_error(F.col("html"), F.col("url")).alias("error"),
    )


@query
def convert_dispatch(spark, sf):
    return page_replies(spark, sf)[2]


@query
def pages_to_text(spark, sf):
    pages = spread(tables.table(spark, sf, "pages").select("page_id", "html"), "page_id")
    return pages.select("page_id", html_to_text(F.col("html")).alias("text"))


@query
def pages_to_plain(spark, sf):
    """Pages with references of all kinds and a script that names another tag, as text."""
    pages = spread(tables.table(spark, sf, "pages").select("page_id", "html"), "page_id")
    number = F.format_string("&#%d;&#x%x;", F.col("page_id") % 9000 + 33, F.col("page_id") % 9000 + 33)
    marked = F.concat(F.col("html"), F.lit(tables.REFERENCES), number)
    return pages.select("page_id", html_to_plain(marked).alias("text"))


@query
def docs_to_html(spark, sf):
    documents = spread(tables.table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    return documents.select("doc_id", text_to_html(F.col("text")).alias("html"))


@query
def result_links(spark, sf):
    tasks, outcomes, _ = page_replies(spark, sf)
    link = conversion.result_link(F.lit(tables.BUCKET), F.col("name"))
    return conversion.result_contents(tasks, outcomes).select(
        "local_id",
        "task_no",
        link.alias("link"),
        F.length("content").cast("bigint").alias("n_chars"),
        F.md5("content").alias("digest"),
    )


@query
def result_objects(spark, sf):
    """The converted pages written as one object each, and read back."""
    tasks, outcomes, _ = page_replies(spark, sf)
    path = fresh_path(spark, "objects")
    objects.write_objects(conversion.result_contents(tasks, outcomes), path)
    link = conversion.result_link(F.lit(tables.BUCKET), F.col("name"))
    return objects.read_objects(spark, path).select(
        link.alias("link"),
        F.length(F.col("content").cast("string")).cast("bigint").alias("n_chars"),
        F.md5("content").alias("digest"),
    )


@query
def message_codec(spark, sf):
    """Task and reply messages of all tasks, encoded and decoded."""
    _, _, replies = page_replies(spark, sf)
    bucket = F.lit(tables.BUCKET)
    flag = messages.flag_of(F.col("is_error"), messages.ERROR)
    task = messages.encode(messages.TASK, bucket=bucket)
    reply = messages.encode(messages.REPLY, flag=flag)
    texts = replies.select("task_no", task.alias("task"), reply.alias("reply"))
    t, r = messages.decode(messages.TASK, F.col("task")), messages.decode(messages.REPLY, F.col("reply"))
    read = texts.select("task_no", "task", "reply", t.alias("t"), r.alias("r"))
    return read.select(
        "task_no",
        "task",
        "reply",
        "t.local_id",
        "t.num_tasks",
        "t.operation",
        "t.url",
        "t.bucket",
        "r.result",
        "r.flag",
    )


# --- jobs and reports --------------------------------------------------------------


def finished(replies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Finished jobs and the summary lines of their replies."""
    done = jobs.finished_jobs(replies)
    return done, report.summary_lines(jobs.of_finished(replies, done))


@query
def dedup_responses(spark, sf):
    return jobs.first_replies(tables.repeated(tables.replies(spark, sf)), ["ts"])


@query
def pending_tasks(spark, sf):
    replies = tables.replies(spark, sf)
    return jobs.pending_tasks(replies, replies.where("task_no % 17 <> 0")).drop("ts")


@query
def job_progress(spark, sf):
    return jobs.job_progress(tables.replies(spark, sf))


@query
def job_completion(spark, sf):
    return jobs.job_completion(tables.replies(spark, sf), ["ts", "task_no"])


@query
def summary_lines(spark, sf):
    return finished(page_replies(spark, sf)[2])[1]


@query
def summary_parse(spark, sf):
    return report.parse_summary(finished(page_replies(spark, sf)[2])[1])


@query
def conversion_outcomes(spark, sf):
    return report.outcome_counts(report.parse_summary(finished(page_replies(spark, sf)[2])[1]))


@query
def html_report(spark, sf):
    done, lines = finished(page_replies(spark, sf)[2])
    return report.html_report(report.parse_summary(lines), done)


@query
def round_summaries(spark, sf):
    """Summary lines of the full rounds of all jobs, from replies with repeats."""
    first = jobs.first_replies(tables.repeated(tables.replies(spark, sf)), ["ts"])
    return report.round_lines(jobs.full_round_replies(tables.answered(first), ["ts", "task_no"]))


@query
def round_reports(spark, sf):
    """HTML reports of the full rounds of all jobs, one for each round."""
    first = jobs.first_replies(tables.repeated(tables.wide_replies(spark, sf).drop("slice")), ["ts"])
    full = jobs.full_round_replies(tables.answered(first), ["ts", "task_no"])
    summary = report.parse_summary(report.round_lines(full))
    rounds = summary.select("local_id", "round").distinct()
    return report.html_report(summary, rounds, report=("local_id", "round"), line="place")


@query
def task_list_files(spark, sf):
    """Task lists written to files and read back; their broken lines are counted apart."""
    path = tables.write_task_lists(spark, sf)
    good, bad = task_in.read_task_lists(spark, path, F.regexp_extract("path", "local_id=([^/]+)/", 1))
    of_tasks = good.groupBy("local_id", "operation").agg(
        F.count(F.lit(1)).alias("tasks"), F.max("num_tasks").alias("num_tasks")
    )
    of_rejects = bad.groupBy("local_id").agg(F.count(F.lit(1)).alias("rejects"))
    return of_tasks.join(of_rejects, "local_id", "left").na.fill(0, ["rejects"])


@query
def summary_files(spark, sf):
    """Summaries written to one folder per job and read back, with job names like 007."""
    replies = page_replies(spark, sf)[2]
    named = replies.withColumn("local_id", F.regexp_replace("local_id", "job", "00"))
    path = fresh_path(spark, "summaries")
    report.write_by_job(report.summary_lines(named), "task_no", "line", path)
    return summary_in.read_summary(spark, path)


# --- streams -----------------------------------------------------------------------


@query
def stream_tasks(spark, sf):
    pages = intake.read_table(spark, sf, "pages.parquet", tables.PAGE_STREAM)
    return intake.drained(tables.task_rows(pages), "stream-tasks")


@query
def stream_convert(spark, sf):
    """The page tasks as a stream; a task's number is its page."""
    pages = intake.read_table(spark, sf, "pages.parquet", tables.PAGE_STREAM)
    tasks = tables.task_rows(pages).withColumnRenamed("page_id", "task_no")
    return stream_conversion.drained(tasks, tables.page_documents(spark, sf), tables.BUCKET)


def reply_stream(spark, sf) -> DataFrame:
    """Replies in several micro-batches, out of time order, with late repeats."""
    path, files = tables.write_reply_files(spark, sf)
    batch = -(-files // tables.REPLY_BATCHES)
    return completion.first_replies(intake.read_folder(spark, path, tables.REPLY_STREAM, files_per_batch=batch))


@query
def stream_dedup_responses(spark, sf):
    # Which copy of a reply is first depends on the files, so the time is no result.
    return intake.drained(reply_stream(spark, sf).drop("ts", "file"), "stream-replies")


@query
def stream_job_completion(spark, sf):
    return intake.drained(completion.full_rounds(reply_stream(spark, sf)), "stream-rounds")


@query
def stream_round_summaries(spark, sf):
    """Summary lines of the full rounds, handed out by the stream as each fills.

    Replies come in four runs in order of time, with late repeats.
    """
    rows = tables.wide_replies(spark, sf)
    again = rows.where(F.col("task_no") % 10 == 0).withColumn("slice", F.col("slice") + 1)

    def build(replies: DataFrame) -> DataFrame:
        first = completion.first_replies(replies)
        return report.round_lines(tables.answered(completion.round_replies(first)))

    parts = {"replies": rows.unionByName(again)}
    return intake.drained_in_runs(
        parts, {"replies": tables.WIDE_STREAM}, tables.SLICES + 1, build, "stream-round-lines"
    )


@query
def stream_rejected_replies(spark, sf):
    """First replies with state for ten days only; what comes later is a reject."""
    parts = {"replies": tables.delivered(spark, sf)}
    judged = intake.drained_in_runs(
        parts,
        {"replies": tables.WIDE_STREAM},
        tables.SLICES + 3,
        lambda replies: completion.within_horizon(replies, tables.HORIZON_SECONDS),
        "stream-horizon",
    )
    return judged.select("local_id", "task_no", "operation", "kept")


@query
def stream_unanswered_tasks(spark, sf):
    """Tasks not answered in 180 s, and the replies that came later than that."""
    sent, answers = tables.sent_tasks(spark, sf), tables.answers(spark, sf)
    parts = {
        "tasks": sent.unionByName(tables.heartbeat(sent, "sent_at")),
        "replies": answers.unionByName(tables.heartbeat(answers, "answered_at")),
    }

    def build(tasks: DataFrame, replies: DataFrame) -> DataFrame:
        due = pending.unanswered(tasks, replies)
        late = pending.late_replies(tasks, replies)
        waited = F.lit(pending.REDELIVERY_SECONDS).cast("bigint")
        seconds = F.unix_seconds("answered_at") - F.unix_seconds("sent_at")
        task = ["local_id", "task_no", "operation"]
        return due.select(*task, F.lit("unanswered").alias("state"), waited.alias("seconds")).unionByName(
            late.select(*task, F.lit("late").alias("state"), seconds.alias("seconds"))
        )

    return intake.drained_in_runs(
        parts,
        {"tasks": tables.TASK_STREAM, "replies": tables.ANSWER_STREAM},
        tables.SLICES + 1,
        build,
        "stream-unanswered",
    )


def converted_in_runs(spark, sf) -> tuple[stream_conversion.Store, str]:
    """The arriving tasks converted in several runs: the store, and where the replies are."""
    home = fresh_path(spark, "stream-job")
    arrivals = durable(tables.task_arrivals(spark, sf), "arrivals")
    documents = tables.page_documents(spark, sf)
    for run in range(tables.SLICES + 1):
        arrivals.where(F.col("slice") == run).drop("slice").write.parquet(f"{home}/tasks/{run}")
        tasks = intake.read_folder(spark, f"{home}/tasks/*", tables.ORDERED_TASK.removesuffix(", at bigint"))
        store = stream_conversion.drain(tasks, documents, tables.BUCKET, f"{home}/replies", f"{home}/checkpoint")
    return store, f"{home}/replies"


@query
def stream_job_summaries(spark, sf):
    """Tasks to replies to full jobs to summary lines, all as streams."""
    _, path = converted_in_runs(spark, sf)
    replies = stream_conversion.reply_stream(spark, path)
    full = completion.round_replies(completion.first_replies(replies), arrival=("task_no",))
    return intake.drained(report.round_lines(full), "stream-summaries")


@query
def stream_outcome_ledger(spark, sf):
    """What the stream has converted: each (operation, url) once, with the run that did it."""
    store, _ = converted_in_runs(spark, sf)
    return store.ledger(spark).groupBy("operation", "url").agg(
        F.count(F.lit(1)).alias("conversions"),
        F.min("batch").alias("batch"),
        F.max("error").alias("error"),
        F.max(F.length("content")).cast("bigint").alias("n_chars"),
    )


@query
def stream_stopped_by_marker(spark, sf):
    """Replies of a stream that gets its marker half-way, and the tasks it refused."""
    home = fresh_path(spark, "stream-marker")
    rows, marker = tables.ordered_tasks(spark, sf)
    stop = spark.createDataFrame(
        [("", 0, 0, control.TERMINATE, "", marker)], tables.ORDERED_TASK
    ).withColumn("slice", F.expr(f"int({tables.SLICES} div 2)"))
    arrivals = durable(rows.unionByName(stop), "arrivals")
    store = stream_conversion.open_store(tables.page_documents(spark, sf), f"{home}/store")

    def convert(taken: DataFrame, number: int) -> None:
        replies = stream_conversion.convert_batch(taken, number, store, tables.BUCKET)
        replies.write.mode("overwrite").parquet(f"{home}/replies/batch={number}")

    def feed(running) -> None:
        for run in range(tables.SLICES):
            arrivals.where(F.col("slice") == run).drop("slice").write.parquet(f"{home}/made/{run}")
            publish(spark, f"{home}/made/{run}", f"{home}/tasks/{run}")
            running.processAllAvailable()

    arrivals.limit(0).drop("slice").write.parquet(f"{home}/tasks/none")
    tasks = intake.read_folder(spark, f"{home}/tasks/*", tables.ORDERED_TASK)
    control.run_until_marker(tasks, convert, f"{home}/gate", f"{home}/checkpoint", feed)
    task = ["local_id", "task_no"]
    done = spark.read.parquet(f"{home}/replies").select(*task, F.lit(True).alias("accepted"), "is_error")
    refused = spark.read.parquet(f"{home}/gate/refused").select(
        *task, F.lit(False).alias("accepted"), F.lit(None).cast("boolean").alias("is_error")
    )
    return done.unionByName(refused)

"""Streams: drained in several batches, restarted, equal to the batch result."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pairmill.operators import jobs
from pairmill.plans import tables
from pairmill.plans.catalog import QUERIES
from pairmill.session import publish
from pairmill.streaming import completion, control, intake, pending
from pairmill.streaming import conversion as stream_conversion

SCHEMA = "local_id bigint, task_no bigint, num_tasks bigint, is_error boolean, ts timestamp"


def replies(spark, n=600, seed=2):
    """Replies of one hot and several small jobs, many of them sent twice or more."""
    rng = random.Random(seed)
    made = []
    for i in range(n):
        job = 0 if i % 3 == 0 else 1 + i % 9
        for _ in range(rng.choice([1, 1, 1, 2])):
            made.append((job, i, 5 if job else 7, False, 1_700_000_000 + i))
    # One reply is a large share of all rows.
    made += [(1, 0, 5, False, 1_700_000_000)] * (n // 2)
    table = spark.createDataFrame(made, "local_id bigint, task_no bigint, num_tasks bigint, is_error boolean, at bigint")
    return table.withColumn("ts", F.timestamp_seconds("at")).drop("at")


def write_files(table, folder, files, start=0):
    for i in range(files):
        part = table.where(F.pmod(F.col("task_no"), F.lit(files)) == i).coalesce(1)
        part.write.mode("append").parquet(f"{folder}/in{start + i}")


def stream(spark, folder):
    return (
        spark.readStream.schema(SCHEMA)
        .option("maxFilesPerTrigger", 1)
        .parquet(f"{folder}/in*")
    )


def expected_rounds(table):
    first = jobs.first_replies(table, ["ts"])
    done = jobs.job_completion(first, ["ts", "task_no"]).where("is_complete")
    return rows(done, "local_id", "round", "replies")


def test_streamed_rounds_equal_batch(spark, tmp_path):
    table = replies(spark)
    write_files(table, tmp_path / "s", 3)
    kept = completion.first_replies(stream(spark, tmp_path / "s"))
    found = intake.drained(completion.full_rounds(kept), "test-rounds")
    assert rows(found) == expected_rounds(table)


def test_streamed_replies_without_repeats(spark, tmp_path):
    table = replies(spark)
    write_files(table.repartition(4), tmp_path / "s", 2)
    kept = completion.first_replies(stream(spark, tmp_path / "s"))
    found = rows(intake.drained(kept, "test-replies"), "local_id", "task_no")
    assert found == rows(table.select("local_id", "task_no").distinct())


def test_restart_goes_on_without_repeats(spark, tmp_path):
    table = replies(spark)
    early, late = table.where("task_no < 300"), table.where("task_no >= 300")
    folder, out, checkpoint = (str(tmp_path / n) for n in ("s", "out", "checkpoint"))

    def run():
        kept = completion.first_replies(stream(spark, folder))
        intake.drain(completion.full_rounds(kept), out, checkpoint)
        return rows(spark.read.parquet(out))

    write_files(early, folder, 1)
    assert run() == expected_rounds(early)
    # Nothing new: nothing is added.
    assert run() == expected_rounds(early)
    # The early replies come once more beside the late ones.
    write_files(table, folder, 1, start=1)
    assert run() == expected_rounds(table)
    assert late.count() > 0


def test_text_job_ids(spark, tmp_path):
    made = spark.createDataFrame([("j", i, 2, False) for i in range(5)], "local_id string, task_no bigint, num_tasks int, is_error boolean")
    path = str(tmp_path / "t")
    made.write.parquet(path)
    read = intake.read_folder(spark, path, made.schema.simpleString()[7:-1].replace(":", " "), files_per_batch=1)
    found = intake.drained(completion.full_rounds(read), "test-text")
    assert rows(found) == [("j", 0, 2), ("j", 1, 2)]


def test_streamed_conversion_equals_batch(spark, tmp_path):
    from pairmill.operators import conversion

    made = spark.createDataFrame(
        [("j", i, 40, "ToText" if i % 2 else "ToHTML", f"u{i % 4}") for i in range(40)],
        "local_id string, task_no bigint, num_tasks bigint, operation string, url string",
    )
    pages = spark.createDataFrame([("u0", "<p>a"), ("u1", "<p>b"), ("u2", "")], "url string, html string")
    folder, out, checkpoint = (str(tmp_path / n) for n in ("s", "out", "checkpoint"))
    write_files(made, folder, 2)
    schema = made.schema

    def tasks():
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in*")

    expected = rows(conversion.convert_tasks(made, pages, "b")[1])
    for _ in range(2):
        stream_conversion.drain(tasks(), pages, "b", out, checkpoint)
        assert rows(spark.read.parquet(out).drop("batch")) == expected


WIDE = "local_id bigint, task_no bigint, num_tasks bigint, is_error boolean, ts timestamp"
BIG = 2**53


def wide(spark, folder):
    """Two jobs that are one number as doubles, and one without a name; a file per round."""
    table = [(job, BIG + i, 2, False, 1_700_000_000 + i) for i in range(7) for job in (BIG, BIG + 1, None)]
    for part in range(4):
        made = [r for r in table if (r[1] - BIG) // 2 == part or (part and r[1] == BIG)]
        file = spark.createDataFrame(made, WIDE.replace("ts timestamp", "at bigint"))
        file.withColumn("ts", F.timestamp_seconds("at")).drop("at").coalesce(1).write.parquet(f"{folder}/in{part}")
    return stream(spark, folder)


def told(found, *columns):
    return sorted((tuple(r) for r in found.select(*columns).collect()), key=repr)


def test_ids_beyond_doubles(spark, tmp_path):
    jobs_of = (BIG, BIG + 1, None)
    replies = wide(spark, tmp_path / "s")
    once = intake.drained(completion.first_replies(replies), "test-ids")
    assert told(once, "local_id", "task_no") == sorted(((j, BIG + i) for j in jobs_of for i in range(7)), key=repr)
    rounds = intake.drained(completion.full_rounds(completion.first_replies(replies)), "test-ids")
    assert told(rounds, "local_id", "round", "replies") == sorted(((j, n, 2) for j in jobs_of for n in range(3)), key=repr)
    full = intake.drained(completion.round_replies(completion.first_replies(replies)), "test-ids")
    expected = [(j, BIG + i, i // 2, i % 2 + 1) for j in jobs_of for i in range(6)]
    assert told(full, "local_id", "task_no", "round", "place") == sorted(expected, key=repr)


def test_rounds_with_replies_equal_batch(spark, tmp_path):
    """Rounds that end in the middle of a batch, span several, or fill many times in one."""
    rng = random.Random(8)
    made = [(rng.choice([0, 0, 0, 1, 2]), i, 0, i % 5 == 0, 1_700_000_000 + i) for i in range(400)]
    made = [(job, i, {0: 7, 1: 90, 2: 1}[job], e, at) for job, i, _, e, at in made]
    table = spark.createDataFrame(made, "local_id bigint, task_no bigint, num_tasks bigint, is_error boolean, at bigint")
    table = table.withColumn("ts", F.timestamp_seconds("at")).drop("at").cache()
    folder, out, checkpoint = (str(tmp_path / n) for n in ("s", "out", "checkpoint"))
    for part in range(4):
        table.where(f"task_no div 100 = {part}").coalesce(1).write.parquet(f"{folder}/in{part}")
        # Each run goes on with the open rounds of the one before it.
        intake.drain(completion.round_replies(stream(spark, folder)), out, checkpoint)
    columns = ("local_id", "round", "place", "task_no", "is_error")
    assert rows(spark.read.parquet(out), *columns) == rows(jobs.full_round_replies(table, ["ts", "task_no"]), *columns)


def test_replies_without_a_round_size_are_in_no_round(spark, tmp_path):
    made = [("a", 1, None), ("a", 2, 0), ("a", 3, 2), ("a", 4, 2)]
    table = spark.createDataFrame([(*m, None) for m in made], "local_id string, task_no bigint, num_tasks bigint, ts timestamp")
    table.write.parquet(str(tmp_path / "t"))
    read = intake.read_folder(spark, str(tmp_path / "t"), "local_id string, task_no bigint, num_tasks bigint, ts timestamp")
    found = intake.drained(completion.round_replies(read), "test-sizes")
    assert rows(found, "task_no", "round", "place") == [(3, 0, 1), (4, 0, 2)]


def test_horizon_keeps_or_rejects_every_reply(spark, tmp_path):
    """Against a plain walk over the files: what is late is a reject, copies in time are dropped."""
    rng = random.Random(9)
    files = [[] for _ in range(6)]
    for i in range(300):
        home = i // 60
        files[home].append((i % 4 or None, i, 1_700_000_000 + i))
        if rng.random() < 0.5:
            files[min(5, home + rng.randrange(4))].append((i % 4 or None, i, 1_700_000_000 + i))
    files[2] += [(9, 1000, None), (9, 1000, None)]
    files[5] += [(9, 1000, None)]
    folder, out, checkpoint = (str(tmp_path / n) for n in ("s", "out", "checkpoint"))
    kept, rejects, seen, high = [], [], set(), 0
    for number, made in enumerate(files):
        for job, task, at in made:
            if at is not None and high and at <= high - 70:
                rejects.append((job, task))
            elif (job, task) not in seen:
                seen.add((job, task))
                kept.append((job, task))
        high = max([high, *(at for *_, at in made if at)])
        table = spark.createDataFrame([(j, t, 1, False, at) for j, t, at in made], WIDE.replace("ts timestamp", "at bigint"))
        table.withColumn("ts", F.timestamp_seconds("at")).drop("at").coalesce(1).write.parquet(f"{folder}/in{number}")
        intake.drain(completion.within_horizon(stream(spark, folder), 70), out, checkpoint)
    found = spark.read.parquet(out)
    assert told(found.where("kept"), "local_id", "task_no") == sorted(kept, key=repr)
    assert told(found.where("not kept"), "local_id", "task_no") == sorted(rejects, key=repr)
    assert rejects and {r[:2] for f in files for r in f} == {*kept, *rejects}


def test_tasks_to_send_again(spark, tmp_path):
    base = 1_700_000_000
    sent = [(1, 1, base), (1, 2, base + 5), (None, 1, base + 10), (None, 2, base + 20), (BIG, 1, base), (BIG + 1, 1, base)]
    answers = [(1, 1, base + 180), (1, 2, base + 186), (None, 2, base + 20), (BIG + 1, 1, base + 1), (BIG + 1, 1, base + 400), (7, 7, base)]
    for name, made, time in (("tasks", sent, "sent_at"), ("replies", answers, "answered_at")):
        for i, part in enumerate((made[:3], made[3:], [(None, None, base + 90_000)])):
            table = spark.createDataFrame(part, "local_id bigint, task_no bigint, at bigint")
            table = table.withColumn(time, F.timestamp_seconds("at")).drop("at").coalesce(1)
            table.write.parquet(str(tmp_path / name / str(i)))

    def read(name, time):
        path = str(tmp_path / name / "*")
        return intake.read_folder(spark, path, f"local_id bigint, task_no bigint, {time} timestamp", files_per_batch=1)

    streams = read("tasks", "sent_at"), read("replies", "answered_at")
    due = intake.drained(pending.unanswered(*streams), "test-due")
    assert told(due, "local_id", "task_no") == sorted([(1, 2), (None, 1), (BIG, 1)], key=repr)
    assert rows(due.select(F.unix_seconds("due_at") - F.unix_seconds("sent_at")).distinct()) == [(180,)]
    late = intake.drained(pending.late_replies(*streams), "test-late")
    assert told(late, "local_id", "task_no") == [(1, 2), (BIG + 1, 1)]


TASKS = "local_id string, task_no bigint, num_tasks bigint, operation string, url string"


def store_of(spark, tmp_path, parts=16):
    pages = [(f"u{i}", f"<p>{i}") for i in range(60)] + [("u3", "<p>A"), ("u3", None), (None, "x")]
    documents = spark.createDataFrame(pages, "url string, html string")
    return stream_conversion.open_store(documents, str(tmp_path / "store"), parts)


def test_a_batch_reads_the_parts_it_needs(spark, tmp_path):
    store = store_of(spark, tmp_path)
    plan = store.documents(spark, [1, 4])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [part" in plan and "(1,4)" in plan.replace(" ", "")
    files = store.documents(spark, [1, 4]).select(F.input_file_name()).distinct().collect()
    assert {f[0].split("part=")[1].split("/")[0] for f in files} <= {"1", "4"}
    # Opened again, it keeps its documents and parts.
    other = stream_conversion.open_store(spark.createDataFrame([], "url string, html string"), store.home, 3)
    assert other == store and other.documents(spark, list(range(16))).count() == 61


def test_outcomes_are_kept_and_a_batch_can_be_repeated(spark, tmp_path):
    store = store_of(spark, tmp_path)

    def batch(job, entries):
        made = [(job, i, len(entries), op, url) for i, (op, url) in enumerate(entries)]
        return spark.createDataFrame(made, TASKS)

    first = batch("a", [("ToText", "u3"), ("ToText", "u3"), ("ToHTML", "u3"), (None, "u1"), ("ToText", None), ("ToText", "gone")])
    second = batch("b", [("ToText", "u3"), ("ToText", "u5"), (None, "u1"), ("ToText", None)])
    expected = {}
    for number, tasks in ((0, first), (1, second), (1, second), (0, first), (1, second)):
        replies = rows(stream_conversion.convert_batch(tasks, number, store, "b"))
        assert len(replies) == tasks.count()
        assert expected.setdefault(number, replies) == replies
    ledger = store.ledger(spark).collect()
    keys = [(r.operation, r.url) for r in ledger]
    assert len(keys) == len(set(keys)) == 6
    assert {r.batch for r in ledger if r.url == "u5"} == {1} and sum(r.batch for r in ledger) == 1
    text = {(r.operation, r.url): (r.content, r.error) for r in ledger}
    assert text["ToText", "u3"] == ("3", None) and text[None, "u1"][1] == "Invalid operation"
    assert text["ToText", None][1] == text["ToText", "gone"][1].replace("gone", "null")


def test_stop_on_a_marker(spark, tmp_path):
    """Open jobs are finished, also by tasks behind the marker; later jobs are refused."""
    schema = TASKS + ", at bigint"
    quarters = [
        [("a", 1, 2, "ToText", "u", 1), (None, 1, 2, "ToText", "u", 2)],
        [("", 0, 0, control.TERMINATE, "", 5), ("b", 1, 1, "ToText", "u", 4), ("c", 1, 1, "ToText", "u", 6)],
        [("a", 2, 2, "ToText", "u", 7), ("a", 2, 2, "ToText", "u", 7), ("d", 1, 1, "ToText", "u", 8)],
        [(None, 2, 2, "ToText", "u", 9)],
    ]
    made = str(tmp_path / "tasks")
    seen = {}

    def feed(query):
        for i, part in enumerate(quarters):
            assert query.isActive
            spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{tmp_path}/made{i}")
            publish(spark, f"{tmp_path}/made{i}", f"{made}/{i}")
            query.processAllAvailable()

    spark.createDataFrame([], schema).write.parquet(f"{made}/none")
    tasks = intake.read_folder(spark, f"{made}/*", schema)
    control.run_until_marker(
        tasks, lambda taken, n: seen.update({n: rows_of(taken)}), f"{tmp_path}/gate", f"{tmp_path}/c", feed, timeout=120
    )
    got = [r for n in sorted(seen) for r in seen[n]]
    assert sorted({r[:2] for r in got}, key=repr) == sorted([("a", 1), (None, 1), ("b", 1), ("a", 2), (None, 2)], key=repr)
    refused = spark.read.parquet(f"{tmp_path}/gate/refused")
    assert rows(refused, "local_id", "task_no") == [("c", 1), ("d", 1)]
    assert not [q for q in spark.streams.active]


def rows_of(table):
    return [(r.local_id, r.task_no) for r in table.collect()]


def test_no_marker_no_end(spark, tmp_path):
    schema = TASKS + ", at bigint"
    spark.createDataFrame([("a", 1, 1, "ToText", "u", 1)], schema).write.parquet(f"{tmp_path}/t/0")
    tasks = intake.read_folder(spark, f"{tmp_path}/t/*", schema)
    with pytest.raises(TimeoutError):
        control.run_until_marker(tasks, lambda taken, n: None, f"{tmp_path}/gate", f"{tmp_path}/c", timeout=6)


@pytest.mark.parametrize("as_folder", [False, True])
def test_pages_may_be_a_folder_of_part_files(spark, tmp_path, as_folder):
    """The streams over `pages.parquet` read all of it, be it one file or many."""
    made = [(i, f"https://a.example/{i}", f"<p>page {i}</p>") for i in range(12)]
    pages = spark.createDataFrame(made, tables.PAGE_STREAM)
    pages.repartition(3).write.parquet(str(tmp_path / "pages.parquet"))
    home = tmp_path
    if not as_folder:
        home = tmp_path / "one"
        pages.coalesce(1).write.parquet(str(tmp_path / "single"))
        home.mkdir()
        next((tmp_path / "single").glob("part-*.parquet")).rename(home / "pages.parquet")
    for name in ("stream_tasks", "stream_convert"):
        assert QUERIES[name](spark, str(home)).count() == 12


def test_stream_without_a_file_converts_nothing(spark, tmp_path):
    spark.createDataFrame([], tables.PAGE_STREAM).write.parquet(str(tmp_path / "pages"))
    for part in (tmp_path / "pages").glob("part-*"):
        part.unlink()
    tasks = intake.read_folder(spark, str(tmp_path / "pages"), tables.PAGE_STREAM)
    tasks = tables.task_rows(tasks).withColumnRenamed("page_id", "task_no")
    documents = spark.createDataFrame([("u", "<p>x</p>")], "url string, html string")
    assert stream_conversion.drained(tasks, documents, "b").count() == 0


def test_horizon_holds_many_replies_in_one_part(spark, tmp_path):
    """Replies that share a part of the state are judged one by one, and leave it one by one."""
    base = 1_700_000_000
    files = [
        [(1, 1, base), (1, 2, base + 50), (None, 1, base), (1, 1, base), (2, 1, None)],
        [(1, 3, base + 100)],
        [(1, 1, base), (1, 2, base + 50), (2, 1, None), (None, 1, base), (1, 4, base + 101)],
    ]
    folder, out, checkpoint = (str(tmp_path / n) for n in ("s", "out", "checkpoint"))
    for number, made in enumerate(files):
        table = spark.createDataFrame([(j, t, 1, False, at) for j, t, at in made], WIDE.replace("ts timestamp", "at bigint"))
        table.withColumn("ts", F.timestamp_seconds("at")).drop("at").coalesce(1).write.parquet(f"{folder}/in{number}")
        intake.drain(completion.within_horizon(stream(spark, folder), 70, parts=1), out, checkpoint)
    found = told(spark.read.parquet(out), "local_id", "task_no", "kept")
    kept = [(1, 1), (1, 2), (None, 1), (2, 1), (1, 3), (1, 4)]
    late = [(1, 1), (None, 1)]
    assert found == sorted([(*r, True) for r in kept] + [(*r, False) for r in late], key=repr)

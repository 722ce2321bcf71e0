"""Conversion, jobs and reports."""

import glob
import os
import random

import pandas as pd
import pyarrow as pa
import pytest
from conftest import rows
from pyarrow import fs
from pyspark.sql import functions as F

from pairmill.functions.html import escape, html_to_plain, html_to_text, text_to_html
from pairmill.operators import conversion, jobs, skew
from pairmill.session import durable
from pairmill.sinks import objects, report
from pairmill.sources.documents import read_files
from pairmill.sources.summary import read_summary
from pairmill.sources.tasks import parse_tasks, read_task_lists

TASKS = "local_id string, task_no bigint, num_tasks bigint, operation string, url string"


def tasks(spark, entries):
    total = {}
    for job, *_ in entries:
        total[job] = total.get(job, 0) + 1
    made, seen = [], {}
    for job, operation, url in entries:
        seen[job] = seen.get(job, 0) + 1
        made.append((job, seen[job], total[job], operation, url))
    return spark.createDataFrame(made, TASKS)


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "v string").select(column(F.col("v"))).first()[0]


def test_html_to_text(spark):
    page = (
        "<!DOCTYPE html><HEAD><STYLE>p{}</STYLE><script>var a='</p>'\n;</script></HEAD>"
        "<p>one&nbsp;&amp;<!-- a\n<b>c</b> --> two</p\n><br>&lt;3&gt; &quot;x&#39; &copy;\t \n"
    )
    assert one(spark, html_to_text, page) == "one & two <3> \"x' &copy;"
    assert one(spark, html_to_text, "") == ""
    assert one(spark, html_to_text, "&amp;lt;") == "&lt;"


def test_text_to_html(spark):
    assert one(spark, text_to_html, "a<b\nc&d") == (
        "<html><body>\n<p>a&lt;b</p>\n<p>c&amp;d</p>\n</body></html>"
    )
    assert one(spark, text_to_html, "") == ""
    assert one(spark, escape, "&<>") == "&amp;&lt;&gt;"


DOCUMENTS = [("u1", "<p>hello</p>"), ("u2", ""), ("u3", "<br>")]


def documents(spark):
    return spark.createDataFrame(DOCUMENTS, "url string, html string")


def test_first_error_wins(spark):
    made = tasks(
        spark,
        [("j", op, u) for u in ("u1", "u2", "gone") for op in ("ToText", "ToHTML", "ToImage", "totext")],
    )
    outcomes, replies = conversion.convert_tasks(made, documents(spark), "b")
    found = {(r.operation, r.url): r for r in replies.collect()}
    assert len(found) == 12
    for op in ("ToText", "ToHTML", "ToImage", "totext"):
        assert found[op, "gone"].result == conversion.LOAD_ERROR + "gone"
    for url in ("u1", "u2"):
        assert found["ToImage", url].result == found["totext", url].result == "Invalid operation"
    assert found["ToText", "u2"].result == found["ToHTML", "u2"].result == "Corrupted File"
    ok = found["ToText", "u1"]
    assert not ok.is_error and ok.result.startswith("https://results.example/b/TEXT")
    assert ok.result.endswith(".txt") and found["ToHTML", "u1"].result.endswith(".html")
    assert sum(r.is_error for r in found.values()) == 10
    assert rows(outcomes.where("error IS NULL"), "operation", "content")[1] == ("ToText", "hello")


@pytest.mark.parametrize("large", [False, True])
def test_one_url_in_a_third_of_the_tasks(spark, monkeypatch, large):
    """The document is converted once; every task gets its reply and its result."""
    if large:
        monkeypatch.setattr(skew, "fits_broadcast", lambda table: False)
    monkeypatch.setattr(conversion, "TASKS_PER_COPY", 10)
    rng = random.Random(3)
    asked = [(f"j{i % 4}", "ToText", "u1" if i % 3 == 0 else rng.choice(["u2", "u3", "gone"])) for i in range(300)]
    made = tasks(spark, asked)
    outcomes, replies = conversion.convert_tasks(made, documents(spark), "b")
    assert outcomes.count() == 4
    assert rows(replies, *made.columns) == rows(made)
    assert replies.where("NOT is_error").count() == 100
    contents = conversion.result_contents(made, outcomes)
    assert rows(contents.select("content").distinct()) == [("hello",)]
    names = rows(contents, "name")
    assert len(set(names)) == 100
    links = rows(replies.where("NOT is_error"), "result")
    assert links == sorted((f"https://results.example/b/{n}",) for (n,) in names)


def test_names_survive_a_retry(spark):
    made = tasks(spark, [("j", "ToText", "u1"), ("j", "ToText", "u1")])
    first, second = (rows(conversion.convert_tasks(made, documents(spark), "b")[1]) for _ in range(2))
    assert first == second and len({r[-2] for r in first}) == 2


def test_user_converter_keeps_errors_on_the_row(spark):
    def shout(html: pd.Series) -> pd.Series:
        if html.str.contains("bad").any():
            raise ValueError("bad page")
        return html.str.upper()

    work = conversion.work_items(
        tasks(spark, [("j", op, u) for op in ("ToUpper", "ToText") for u in ("g1", "g2", "bad", "none", "empty")])
    )
    pages = spark.createDataFrame([("g1", "x"), ("g2", "y"), ("bad", "bad"), ("empty", "")], "url string, html string")
    found = conversion.converted_by(conversion.fetch(work, pages), "ToUpper", shout)
    got = {(r.operation, r.url): (r.error, r.content) for r in found.collect()}
    assert got["ToUpper", "g1"] == (None, "X") and got["ToUpper", "g2"] == (None, "Y")
    assert got["ToUpper", "bad"] == ("ValueError('bad page')", None)
    assert got["ToUpper", "empty"] == ("Corrupted File", None)
    assert got["ToUpper", "none"][0] == got["ToText", "none"][0] == conversion.LOAD_ERROR + "none"
    assert got["ToText", "g1"] == ("Invalid operation", None)


def test_task_lists_keep_line_order(spark, tmp_path):
    lines = [f"ToText\thttp://a.example/{i}\textra" for i in range(500)]
    (tmp_path / "big.txt").write_text("\r\n".join(lines))
    (tmp_path / "small.txt").write_text("ToHTML\thttp://b.example/0\nno tab here\n\nToImage\thttp://b.example/1")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        good, bad = read_task_lists(spark, str(tmp_path))
        found = good.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    big = sorted((r.task_no, r.url) for r in found if r.local_id.endswith("/big.txt"))
    assert big == [(i + 1, f"http://a.example/{i}") for i in range(500)]
    small = sorted((r.task_no, r.operation, r.num_tasks) for r in found if r.local_id.endswith("/small.txt"))
    assert small == [(1, "ToHTML", 2), (2, "ToImage", 2)]
    assert rows(bad, "value") == [("no tab here",)]


def test_task_line_without_tab_is_set_aside(spark):
    found = parse_tasks(spark.createDataFrame([("ToText\tu",), ("junk",)], "value string"))
    assert rows(found, "operation", "url", "bad") == [("ToText", "u", None), ("junk", None, "junk")]


def test_binary_files_are_documents(spark, tmp_path):
    (tmp_path / "a.html").write_text("<p>été</p>", encoding="utf8")
    found = read_files(spark, str(tmp_path)).first()
    assert found.url.endswith("/a.html") and found.html == "<p>été</p>"


def test_batches(spark):
    made = tasks(spark, [("j", "ToText", f"u{i}") for i in range(100)] + [("k", "ToText", "u")])
    found = rows(jobs.task_batches(made, 7))
    assert len([r for r in found if r[0] == "j"]) == 15 and ("j", 15, 2, 15) in found
    assert ("k", 1, 1, 1) in found
    spread = jobs.in_batches(made, 7).withColumn("p", F.spark_partition_id())
    per_batch = spread.groupBy("local_id", "batch").agg(F.count_distinct("p").alias("n"))
    assert {r.n for r in per_batch.collect()} == {1}


REPLIES = "local_id string, task_no bigint, num_tasks bigint, is_error boolean, at bigint"


def test_rounds_of_replies(spark):
    made = [("X", i, 3, i == 2, i) for i in range(1, 8)] + [("Y", 1, 2, False, 5)]
    found = rows(jobs.job_completion(spark.createDataFrame(made, REPLIES), ["at"]))
    assert found == [
        ("X", 0, 3, 3, 1, 1, 3, True), ("X", 1, 3, 3, 0, 4, 6, True), ("X", 2, 1, 3, 0, 7, 7, False),
        ("Y", 0, 1, 2, 0, 1, 1, False),
    ]


def test_rounds_of_a_hot_job(spark):
    rng = random.Random(5)
    made = [("hot" if i % 3 else f"j{i % 7}", i, 4, rng.random() < 0.2, i * 37 % 1009) for i in range(1009)]
    found = jobs.job_completion(spark.createDataFrame(made, REPLIES).repartition(6), ["at"])
    expected = []
    for job in {m[0] for m in made}:
        mine = sorted((m for m in made if m[0] == job), key=lambda m: m[4])
        for n in range(0, len(mine), 4):
            part = mine[n : n + 4]
            errors = sum(m[3] for m in part)
            expected.append((job, n // 4, len(part), 4, errors, part[0][1], part[-1][1], len(part) == 4))
    assert rows(found) == sorted(expected)


def test_repeated_and_missing_replies(spark):
    made = spark.createDataFrame(
        [("X", 1, 2, False, 9), ("X", 1, 2, True, 3), ("X", 1, 2, False, 4), ("Y", 1, 1, False, 1)], REPLIES
    )
    kept = jobs.first_replies(made, ["at"])
    assert rows(kept) == [("X", 1, 2, True, 3), ("Y", 1, 1, False, 1)]
    asked = tasks(spark, [("X", "ToText", "u"), ("X", "ToText", "u"), ("Y", "ToText", "u")])
    assert rows(jobs.pending_tasks(asked, kept), "local_id", "task_no") == [("X", 2)]
    assert rows(jobs.job_progress(kept)) == [("X", 1, 2, 0, 1), ("Y", 1, 1, 1, 0)]


def run_of_18(spark):
    """Nine pages and six images done, two images and one text failed."""
    outcomes = [("ToHTML", False)] * 9 + [("ToImage", False)] * 6 + [("ToImage", True)] * 2 + [("ToText", True)]
    made = [
        ("run", i + 1, 18, op, f"http://a.example/{i}.pdf", "Corrupted File" if bad else f"https://r.example/{i}", bad)
        for i, (op, bad) in enumerate(outcomes)
    ]
    return spark.createDataFrame(made, TASKS + ", result string, is_error boolean")


def test_summary_of_a_run(spark):
    run = run_of_18(spark)
    lines = report.summary_lines(run)
    text = dict(rows(lines, "task_no", "line"))
    assert text[1] == "< ToHTML >: \thttp://a.example/0.pdf\thttps://r.example/0\t --- "
    assert text[18] == "< ToText >: \thttp://a.example/17.pdf\t< Corrupted File >\t_exceptionMessage"
    parsed = report.parse_summary(lines)
    assert rows(report.outcome_counts(parsed)) == [
        ("ToHTML", "success", 9), ("ToImage", "error", 2), ("ToImage", "success", 6), ("ToText", "error", 1),
    ]
    assert rows(parsed.select(F.regexp_extract("operation", "< (.*) >", 1), "url")) == rows(run, "operation", "url")


def test_summary_files(spark, tmp_path):
    run = run_of_18(spark)
    lines = report.summary_lines(run)
    out = str(tmp_path / "summary")
    report.write_by_job(lines, "task_no", "line", out)
    back = read_summary(spark, out)
    assert rows(back) == rows(report.parse_summary(lines).drop("task_no"))
    written = []
    for part in sorted(glob.glob(f"{out}/local_id=run/part-*")):
        written += open(part, encoding="utf8").read().splitlines()
    assert written == [line for _, line in rows(lines, "task_no", "line")]


def test_only_finished_jobs_are_reported(spark, tmp_path):
    run = run_of_18(spark)
    open_job = run.where("task_no < 5").withColumn("local_id", F.lit("open"))
    requests = spark.createDataFrame([("none", 0), ("run", 18)], "local_id string, num_tasks bigint")
    done = jobs.finished_jobs(run.unionByName(open_job), requests)
    assert rows(done) == [("none", 0), ("run", 18)]
    lines = report.summary_lines(jobs.of_finished(run.unionByName(open_job), done))
    assert rows(lines.select("local_id").distinct()) == [("run",)]
    html = report.html_report(report.parse_summary(lines), done)
    out = str(tmp_path / "reports")
    report.write_by_job(html, "line_no", "html", out)
    pages = {}
    for job in ("none", "run"):
        parts = sorted(glob.glob(f"{out}/local_id={job}/part-*"))
        pages[job] = "".join(open(p, encoding="utf8").read() for p in parts).replace("\n", "")
    assert pages["none"] == "<html><body></body></html>"
    assert pages["run"].startswith(
        "<html><body>< ToHTML >: <a href=http://a.example/0.pdf>inputFileLink</a> "
        "<a href=https://r.example/0>outputFileLink</a><br>"
    )
    assert pages["run"].endswith("inputFileLink</a> < Corrupted File ><br></body></html>")
    assert pages["run"].count("<br>") == 18


def test_escaped_report(spark):
    made = spark.createDataFrame([("j", 1, "< ToText >: \tu?a&b\t< x >\t_exceptionMessage")], "local_id string, task_no bigint, line string")
    done = spark.createDataFrame([("j", 1)], "local_id string, replies bigint")
    found = report.html_report(report.parse_summary(made), done, escape=True)
    assert "&lt; ToText &gt;: <a href=u?a&amp;b>inputFileLink</a> &lt; x &gt;<br>" in [r.html for r in found.collect()]


def test_finished_lookup_of_a_large_job_table(spark, monkeypatch):
    run = run_of_18(spark)
    done = durable(jobs.job_progress(run).select("local_id", "replies"), "t")
    small = rows(jobs.of_finished(run, done))
    monkeypatch.setattr(skew, "fits_broadcast", lambda table: False)
    assert rows(jobs.of_finished(run, done)) == small and len(small) == 18


def test_results_by_operation(spark, tmp_path):
    made = tasks(spark, [("j", "ToText", "u1"), ("j", "ToHTML", "u1"), ("j", "ToText", "gone")])
    outcomes, _ = conversion.convert_tasks(made, documents(spark), "b")
    out = str(tmp_path / "results")
    report.write_results(conversion.result_contents(made, outcomes), out)
    assert rows(spark.read.parquet(out), "operation", "task_no") == [("ToHTML", 2), ("ToText", 1)]


def test_a_url_listed_twice_answers_once(spark):
    made = tasks(spark, [("j", "ToText", "u1"), ("j", "ToHTML", "u1"), ("j", "ToText", "u9")])
    pages = spark.createDataFrame(
        [("u1", "<p>b"), ("u1", "<p>a"), ("u1", None), ("u9", None), ("u9", None)], "url string, html string"
    )
    outcomes, replies = conversion.convert_tasks(made, pages, "b")
    assert len(rows(replies)) == 3
    texts = {(r.operation, r.url): (r.content, r.error) for r in outcomes.collect()}
    assert texts["ToText", "u1"] == ("a", None)
    assert texts["ToText", "u9"] == (None, conversion.LOAD_ERROR + "u9")


def test_user_converter_keeps_rows_without_an_operation(spark):
    made = spark.createDataFrame(
        [(None, "u1", 2**53 + 1), ("ToUpper", "u1", None), ("ToUpper", None, 2**53 + 3), (None, "gone", 1)],
        "operation string, url string, requests bigint",
    )
    fetched = made.join(spark.createDataFrame([("u1", "<p>a")], "url string, html string"), "url", "left")
    found = conversion.converted_by(fetched, "ToUpper", lambda html: html.str.upper())
    got = {(r.operation, r.url, r.requests): (r.error, r.content) for r in found.collect()}
    assert got == {
        (None, "u1", 2**53 + 1): ("Invalid operation", None),
        ("ToUpper", "u1", None): (None, "<P>A"),
        ("ToUpper", None, 2**53 + 3): (conversion.LOAD_ERROR + "null", None),
        (None, "gone", 1): (conversion.LOAD_ERROR + "gone", None),
    }


def test_a_job_without_a_name(spark):
    replies = spark.createDataFrame(
        [(None, 1, 2), (None, 2, 2), (2**53 + 1, 1, 2), (2**53 + 1, 1, 2), (2**53, 1, 1)],
        "local_id bigint, task_no bigint, num_tasks bigint",
    )
    done = jobs.finished_jobs(replies)
    # A repeated reply is no progress.
    assert {tuple(r) for r in done.collect()} == {(None, 2), (2**53, 1)}
    kept = [(r.local_id, r.task_no) for r in jobs.of_finished(replies, done).collect()]
    assert sorted(kept, key=repr) == sorted([(None, 1), (None, 2), (2**53, 1)], key=repr)
    sent = spark.createDataFrame([(None, 1), (None, 3), (2**53, 1), (2**53, 2)], "local_id bigint, task_no bigint")
    left = [tuple(r) for r in jobs.pending_tasks(sent, replies).collect()]
    assert sorted(left, key=repr) == sorted([(None, 3), (2**53, 2)], key=repr)


def test_a_report_for_each_round(spark):
    replies = spark.createDataFrame(
        [(j, i, 2, "ToText", f"u{i}", "r", i == 3, i) for j in ("a", None) for i in (1, 2, 3, 4, 5, 5)],
        "local_id string, task_no bigint, num_tasks bigint, operation string, url string, result string, is_error boolean, at bigint",
    )
    first = jobs.first_replies(replies, ["at"])
    lines = report.parse_summary(report.round_lines(jobs.full_round_replies(first, ["at"])))
    rounds = lines.select("local_id", "round").distinct()
    html = report.html_report(lines, rounds, report=("local_id", "round"), line="place")
    pages = {}
    for r in sorted(html.collect(), key=lambda r: r.line_no):
        pages[r.local_id, r.round] = pages.get((r.local_id, r.round), "") + r.html
    assert set(pages) == {(j, n) for j in ("a", None) for n in (0, 1)}
    link = "<a href=r>outputFileLink</a><br>"
    start = "< ToText >: <a href="
    assert pages[None, 1] == (
        f"<html><body>{start}u3>inputFileLink</a> < r ><br>{start}u4>inputFileLink</a> {link}</body></html>"
    )


def listing(path):
    return sorted(os.path.relpath(os.path.join(d, f), path) for d, _, files in os.walk(path) for f in files if not f.endswith(".crc"))


def test_one_object_per_result(spark, tmp_path):
    made = [(f"HTML{i}.html", f"page {i} é\r\n" * i) for i in range(50)] + [("none.txt", None)]
    path = str(tmp_path / "objects")
    table = spark.createDataFrame(made, "name string, content string")
    objects.write_objects(table.repartition(6), path)
    assert {(r.name, bytes(r.content).decode()) for r in objects.read_objects(spark, path).collect()} == {
        (n, c) for n, c in made if c
    }
    assert listing(path) == sorted(["_committed", *(n for n, _ in made)])
    # A write that is repeated leaves the same objects.
    objects.write_objects(table.repartition(3), path)
    assert listing(path) == sorted(["_committed", *(n for n, _ in made)])


def test_a_failed_write_leaves_no_object(spark, tmp_path):
    path = str(tmp_path / "objects")
    good = spark.createDataFrame([(f"a{i}", "x") for i in range(40)], "name string, content string").repartition(4)
    # One task ends, another fails after it has staged some of its objects.
    bad = spark.createDataFrame([*((f"b{i}", "x") for i in range(5)), ("b/7", "x")], "name string, content string")
    with pytest.raises(Exception, match="no name of an object"):
        objects.write_objects(good.union(bad.coalesce(1)), path)
    assert listing(path) == []


def test_objects_of_failed_attempts_are_taken_back(tmp_path, monkeypatch):
    """A task that fails while it gives its objects their names."""
    writer = objects.ObjectWriter(str(tmp_path / "o"))
    batch = pa.RecordBatch.from_pydict({"name": ["a", "b", "c"], "content": ["1", "2", "3"]})
    moved = []

    class Broken(fs.LocalFileSystem):
        def move(self, start, end):
            if len(moved) == 2:
                raise OSError("gone")
            moved.append(end)
            super().move(start, end)

    monkeypatch.setattr(objects, "open_folder", lambda path: (Broken(), path))
    with pytest.raises(OSError, match="gone"):
        writer.write(iter([batch]))
    assert len(moved) == 2 and listing(tmp_path / "o") == []
    monkeypatch.undo()
    done = writer.write(iter([batch]))
    assert done.objects == 3 and listing(tmp_path / "o")[-3:] == ["a", "b", "c"]
    writer.abort([done, None])
    assert listing(tmp_path / "o") == []


def test_references_are_read_once(spark):
    plain = {
        "it&#8217;s caf&eacute; &hearts;": "it’s café ♥",
        "&amp;lt; &amp;#65; &#38;amp;": "&lt; &#65; &amp;",
        "&#x41;&#X42;&#67;": "ABC",
        "&unknown; &; &#; &#x; &#0; &#55296; &#1114112; &#9999999; &lt": "&unknown; &; &#; &#x; &#0; &#55296; &#1114112; &#9999999; &lt",
        "&#128512;|&nbsp;&nbsp;|&AMP;|&Eacute;&eacute;": "😀| |&AMP;|Éé",
        "<script>a</style>b</script>c<style>d</script>e</style >f<SCRIPT\n>g</ScRiPt>": "c f",
        "": "",
        "&lt;": "<",
    }
    for html, text in plain.items():
        assert one(spark, html_to_plain, html) == text
    assert one(spark, html_to_plain, None) is None

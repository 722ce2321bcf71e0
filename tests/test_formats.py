"""Text, sequence-file and message formats."""

import glob
import math
import os

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pairmill.functions import messages
from pairmill.operators import scoring
from pairmill.plans import flow
from pairmill.sinks import keyvalue as kv_out
from pairmill.sinks import sequencefile as seq_out
from pairmill.sources import corpus
from pairmill.sources import keyvalue as kv_in
from pairmill.sources import sequencefile as seq_in

# n-grams of 3 to 5 words over two decades, a blank line, and two lines whose year is
# not set off by a tab.
LINES = []
for _late in (True, False):
    for _gram, _year, _n in (
        ("Tom is going sailing now", 5, 40), ("Tom and Nadia are tired", 1, 20),
        ("Nadia loves going sailing", 4, 10), ("He is going something", 2, 20),
        ("going something not boring", 6, 50), ("Tom boring class", 4, 30),
        ("class always boring", 1, 10), ("going sailing is fun!", 6, 30),
    ):
        LINES.append(f"{_gram}\t{(2010 if _late else 2000) + _year}\t{_n}\t5\t6")
    if _late:
        LINES.append("")
    LINES.append("Tom and Nadia are talking 2007\t20\t8\t8")


@pytest.fixture
def corpus_path(tmp_path):
    path = tmp_path / "corpus.txt"
    path.write_bytes("\r\n".join(LINES).encode())
    return str(path)


def test_corpus_scan(spark, corpus_path):
    good, rejects = corpus.read_ngrams(spark, corpus_path)
    assert good.count() == 16
    assert rows(rejects, "reason") == [("fields",), ("fields",)]
    assert {r.volumes for r in good.collect()} == {6}


def test_corpus_rejects(spark):
    lines = spark.createDataFrame(
        [('"quo\\te" x\t1999\t1\t1\t1',), ("a\tb\t1\t1\t1",), ("a\t1899\t1\t1\t1",), ("a\t2001\t1\t1\t1\t1",), ("a\t2001\t1.5\t1\t1",)],
        "value string",
    )
    good, rejects = corpus.parse_ngrams(lines)
    assert rows(good, "ngram") == [('"quo\\te" x',), ("a",)]
    assert rows(rejects, "reason") == [("fields",), ("number",), ("number",)]
    good, rejects = corpus.parse_ngrams(lines, decades=(0, 11))
    assert rows(good, "ngram") == [('"quo\\te" x',)]
    assert rows(rejects, "reason") == [("decade",), ("fields",), ("number",), ("number",)]


def test_corpus_to_scores(spark, corpus_path):
    good, _ = corpus.read_ngrams(spark, corpus_path)
    counts = flow.from_ngrams(good)
    # Both decades hold the same n-grams with the same counts.
    assert rows(counts.totals) == [(10, 1380), (11, 1380)]
    scores = scoring.scored(counts.stats())
    ten, eleven = ([tuple(r)[1:] for r in rows(scores) if r[0] == d] for d in (10, 11))
    assert len(ten) == 43 and ten == eleven
    assert counts.marginals.where("decade = 10").count() == 17
    best = scoring.top_pairs(scores, 1).first()
    assert (best.w1, best.w2) == ("always", "class")
    # c=10, c(always)=20, c(class)=80, N=1380
    assert best.pmi == pytest.approx(math.log(10 * 1380 / (20 * 80)), abs=1e-12)


def test_kv_files_round_trip(spark, corpus_path, tmp_path):
    good, _ = corpus.read_ngrams(spark, corpus_path)
    counts = flow.from_ngrams(good)
    legacy = kv_out.legacy_rows(counts.pairs, counts.singles(), counts.totals)
    out = str(tmp_path / "kv")
    kv_out.write_kv(legacy, out)
    assert sorted(os.path.basename(p) for p in glob.glob(f"{out}/decade=*")) == ["decade=10", "decade=11"]
    read = kv_in.parse_kv(corpus.read_lines(spark, out))
    pair, single, total = kv_in.split_kinds(read)
    assert rows(pair) == rows(counts.pairs, "decade", "w1", "w2", "c_pair")
    assert rows(single) == rows(counts.singles())
    assert rows(total) == rows(counts.totals)
    # The files of a decade, in name order, are sorted by key.
    keys = []
    for name in sorted(glob.glob(f"{out}/decade=10/part-*")):
        keys += [tuple(line.split("\t")[0].split(",")[:2]) for line in open(name, encoding="utf8")]
    assert keys == sorted(keys) and len(keys) == 44


def test_stats_file_by_decade(spark, corpus_path, tmp_path):
    good, _ = corpus.read_ngrams(spark, corpus_path)
    stats = flow.from_ngrams(good).stats()
    out = str(tmp_path / "stats")
    kv_out.write_stats(stats, out)
    one = spark.read.parquet(out).where("decade = 10")
    assert one.count() == 43
    assert "PartitionFilters: [isnotnull(decade" in one._jdf.queryExecution().toString()


def test_kv_bad_lines(spark):
    lines = ["a,b,10\t1,0,0", "a,b,x\t1,0,0", "a,b,10\t1,0", "a,,b,10\t1,0,0", "a,b,10", "a,*,10\t0,4,0", "*,*,10\t9,0,0"]
    read = kv_in.parse_kv(spark.createDataFrame([(v,) for v in lines], "value string"))
    assert rows(read.where("bad IS NOT NULL"), "bad") == sorted((v,) for v in lines[1:5])
    assert rows(read.where("bad IS NULL"), "kind") == [("pair",), ("total",), ("word",)]


def test_regrouped_layout(spark):
    line = spark.createDataFrame([("a,*,10\ta,b,10,4,4,0",)], "value string")
    found = kv_in.parse_kv(line, "regrouped").first()
    assert (found.p1, found.p2, found.p_decade, found.c_pair, found.c_w1) == ("a", "b", 10, 4, 4)


def test_two_totals_fail_the_job(spark):
    lines = spark.createDataFrame([("*,*,10\t9,0,0",), ("*,*,10\t8,0,0",)], "value string")
    with pytest.raises(PySparkException):
        kv_in.split_kinds(kv_in.parse_kv(lines))[2].collect()


def test_pmi_list(spark):
    lines = spark.createDataFrame([("a,b,7\t0.5",), ("c,d\t-1.25",), ("junk",)], "value string")
    good, bad = kv_in.parse_pmi_list(lines, 10)
    assert rows(good) == [(10, "a", "b", 0.5), (10, "c", "d", -1.25)]
    assert bad.count() == lines.count() - 2


def test_sequence_file_round_trip(spark, tmp_path):
    scores = spark.createDataFrame(
        [(10, "été", "sun", 0.1), (10, "a", "b", -2.5e-7)], "decade int, w1 string, w2 string, pmi double"
    )
    path = str(tmp_path / "seq")
    seq_out.write_pairs(scores, path)
    with open(sorted(glob.glob(f"{path}/part-*"))[0], "rb") as made:
        head = made.read(80)
    assert head.startswith(b"SEQ") and b"LongWritable" in head and b"Text" in head
    assert rows(seq_in.read_pairs(spark, path, 10)) == rows(scores)


def test_messages(spark):
    table = spark.createDataFrame(
        [("j1", 3, "ToText", "http://a.example/x", "b")], "local_id string, num_tasks bigint, operation string, url string, bucket string"
    )
    text = table.select(messages.encode(messages.TASK).alias("m"))
    assert rows(text) == [("j1;3;ToText;http://a.example/x;b",)]
    back = text.select(messages.decode(messages.TASK, F.col("m")).alias("t")).select("t.*")
    assert rows(back) == rows(table)
    request = spark.createDataFrame([("j1", "b", 7, True)], "local_id string, bucket string, batch_size int, last boolean")
    flag = messages.flag_of(F.col("last"), messages.TERMINATE)
    assert rows(request.select(messages.encode(messages.REQUEST, flag=flag))) == [("j1;b;7;_terminate",)]
    reply = spark.createDataFrame([("j1;3;u;Corrupted File;ToText;_exceptionMessage",)], "m string")
    found = reply.select(messages.decode(messages.REPLY, F.col("m")).alias("r")).select("r.*").first()
    assert (found.num_tasks, found.result, found.flag) == (3, "Corrupted File", messages.ERROR)


def test_bad_records_of_a_sequence_file_are_rejects(spark, tmp_path):
    path = str(tmp_path / "seq")
    lines = [(1 << 32, "a b\t1.5"), ((1 << 32) + 1, "a b\tmuch"), ((1 << 32) + 2, "alone\t2.0"), ((1 << 32) + 3, "")]
    spark.sparkContext.parallelize(lines, 2).saveAsNewAPIHadoopFile(
        path, seq_out.FORMAT, keyClass=seq_in.KEY, valueClass=seq_in.VALUE
    )
    good, bad = seq_in.read_checked(spark, path, 10)
    assert rows(good) == rows(seq_in.read_pairs(spark, path, 10)) == [(10, "a", "b", 1.5)]
    assert rows(bad) == [("",), ("a b\tmuch",), ("alone\t2.0",)]


def test_a_score_list_from_files(spark, tmp_path):
    (tmp_path / "list.txt").write_text("a,b\t0.5\na,b,10\t1.5\na b\t1\na,b\tx\n\n")
    good, bad = kv_in.read_pmi_list(spark, str(tmp_path / "list.txt"), 10)
    assert rows(good) == [(10, "a", "b", 0.5), (10, "a", "b", 1.5)]
    assert rows(bad) == [("",), ("a b\t1",), ("a,b\tx",)]

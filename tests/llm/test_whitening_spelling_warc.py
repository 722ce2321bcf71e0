"""Operators 11 to 13 against plain versions, and on nulls, ties, repeats and empty tables."""

import base64
import gzip
import hashlib
import io
import os
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from pairmill.llm import spelling, warc_index, whitening
from pairmill.llm.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

NAN, INF = float("nan"), float("inf")


# Embedding whitening


def plain_whitened(x, components):
    """Coordinates (sign free), shares and covariance error by one local eigh."""
    centred = x - x.sum(0) / len(x)
    covariance = centred.T @ centred / len(x)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values)[:components]
    return centred @ vectors[:, order] / np.sqrt(values[order]), values[order] / np.trace(covariance)


@tables
def test_whitening_query(spark):
    got = QUERIES["op13_embedding_whitening"](spark, SF).toPandas()
    rows = pq.read_table(f"{SF}/embeddings.parquet").to_pydict()
    x = np.floor(1024 * np.array(rows["embedding"], dtype=np.float64)) + 100_000
    white, shares = plain_whitened(x, 8)
    whole = x.astype(np.int64).astype(object)
    deviation = ((len(x) * whole - whole.sum(0)) ** 2).sum(1)
    assert len(got) == 8 * len(x) and set(got["n"]) == {len(x)}
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-8
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[rows["vec_id"]].to_numpy()
    for k in range(8):
        sign = np.sign(wide[0, k] * white[0, k])
        assert np.allclose(wide[:, k], sign * white[:, k], atol=1e-8)
        assert got[got["component"] == k + 1]["explained"].iloc[0] == pytest.approx(shares[k])
    first = got[got["component"] == 1].set_index("vec_id")["deviation"].loc[rows["vec_id"]]
    assert first.tolist() == deviation.tolist()


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, x int, at string, row string, emb array<float>")


def test_whitening_drops_what_cannot_be_used(spark):
    rng = np.random.default_rng(3)
    good = [(i, 1, "a", "r", rng.normal(size=5).astype("f4").tolist()) for i in range(40)]
    good += [good[7], (None, None, None, None, good[8][4])]
    bad = [None, [], [1.0, None, 2.0, 3.0, 4.0], [NAN] * 5, [INF, 0.0, 0.0, 0.0, 0.0], [1.0, 2.0]]
    rows = vectors(spark, good + [(100 + i, 2, "b", "s", v) for i, v in enumerate(bad)])
    got = whitening.whiten(rows, "emb", components=3).collect()
    assert len(got) == 42 and {r.n for r in got} == {42}
    assert sum(r.row.vec_id == 7 for r in got) == 2 and sum(r.row.vec_id is None for r in got) == 1
    assert {r.row.at for r in got} == {"a", None} and got[0].identity_error < 1e-8
    x = np.array([g[4] for g in good], dtype="f8")
    white, shares = plain_whitened(x, 3)
    assert got[0].explained == pytest.approx(shares.tolist())
    ours = {r.row.vec_id: r.whitened for r in got}
    signs = [np.sign(ours[0][k] * white[0, k]) for k in range(3)]
    assert all(np.allclose(ours[i], white[i] * signs) for i in range(40))


def test_whitening_of_few_vectors(spark):
    assert whitening.whiten(vectors(spark, []), "emb").collect() == []
    one = whitening.whiten(vectors(spark, [(1, 1, "", "", [1.0, 2.0])]), "emb").collect()
    assert [(r.n, r.whitened, r.explained, r.identity_error) for r in one] == [(1, [], [], None)]
    same = whitening.whiten(vectors(spark, [(i, 1, "", "", [1.0, 2.0]) for i in range(5)]), "emb").collect()
    assert [(r.n, r.whitened) for r in same] == [(5, [])] * 5
    line = [(i, 1, "", "", [float(i), 2.0 * i]) for i in range(6)]
    flat = whitening.whiten(vectors(spark, line), "emb").collect()
    assert {len(r.whitened) for r in flat} == {1} and flat[0].explained == pytest.approx([1.0])


def test_whitening_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 8 * 4 * 10)
    monkeypatch.setattr(whitening, "BLOCKS_A_TASK", 3)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(997, 4)) * [5, 3, 2, 1] + [100, -50, 3, 0]
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "i int, v array<double>")
    got = whitening.whiten(rows.repartition(7), "v", components=4).collect()
    white, _ = plain_whitened(x, 4)
    ours = {r.row.i: r.whitened for r in got}
    signs = [np.sign(ours[0][k] * white[0, k]) for k in range(4)]
    assert len(ours) == 997 and all(np.allclose(ours[i], white[i] * signs) for i in range(997))


def test_blocks_grow_with_the_rows():
    assert whitening.block_rows(1000, 64) == whitening.block_rows(10**6, 64) == 1024
    assert whitening.block_rows(10**8, 64) == -(-(10**8) // whitening.MANY_BLOCKS)
    assert whitening.block_rows(4 * 10**11, 64) == 65536


# Spelling variants


def plain_words(docs):
    found = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    at = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def plain_groups(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, words[w], len(near[w]), form[w], words.get(form[w]), root))
    return sorted(out)


def grouped(df):
    return sorted(tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect())


@tables
def test_spelling_query(spark):
    docs = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    words = plain_words(zip(docs["doc_id"], docs["text"], strict=True))
    assert grouped(QUERIES["op11_spelling_variants"](spark, SF)) == plain_groups(words)


@pytest.mark.parametrize("hot", [1, 3, 1000])
def test_spelling_finds_every_pair(spark, hot):
    """All words of a few letters, so that most chunks are shared, repeated and shifted."""
    rng = random.Random(hot)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(5, 10))): rng.randrange(3, 90) for _ in range(500)}
    words |= {"aaaaa": 80, "aaaaaa": 40, "aaaaaaa": 20, "aaaaaaaa": 10, "a" * 300: 5, "a" * 299 + "b": 30}
    table = spark.createDataFrame(list(words.items()), "word string, n bigint")
    assert grouped(spelling.group(table, hot_chunk=hot)) == plain_groups(words)


def test_spelling_sends_no_exploded_table(spark, tmp_path):
    """Spark's estimate of chunks and grams is that of the words; only the hot chunks, which are counted, are broadcast."""
    words = [(f"{a}{b}house", a * 20 + b) for a in range(9) for b in range(9)]
    spark.createDataFrame(words, "word string, n bigint").write.parquet(f"{tmp_path}/words")
    found = spelling.near_pairs(spark.read.parquet(f"{tmp_path}/words"), hot_chunk=1)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    joins = re.findall(r"(\w+Join) .*(Inner|LeftAnti|LeftSemi)", plan)
    assert sorted(joins) == [("BroadcastHashJoin", "LeftAnti")] + 2 * [("BroadcastHashJoin", "LeftSemi")] + 2 * [("SortMergeJoin", "Inner")]


def test_spelling_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(spelling, "PIECE", 64)
    monkeypatch.setattr(spelling, "HELD_WORDS", 5)
    rng = random.Random(2)
    base = ["grammar", "grammer", "gramar", "Ünlaut", "ünlaut", "naïve", "naive", "über", "x" * 500]
    docs = [(i % 7 or None, " ".join(rng.choice(base) for _ in range(60))) for i in range(20)]
    docs += [(1, None), (2, ""), (3, "1234 \n\t "), (None, "GRAMMAR,grammar;Grammar"), docs[3], docs[3]]
    rows = spark.createDataFrame([(d, t, "w", 1) for d, t in docs], "doc_id bigint, text string, word string, n int")
    assert grouped(spelling.variants(rows)) == plain_groups(plain_words(docs))
    assert grouped(spelling.variants(rows.limit(0))) == []
    plain = Counter(w for _, t in docs for w in re.findall("[a-zÀ-ÿ]{5,}", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")))
    assert {r.word: r.n for r in spelling.count_words(rows, slip=None).collect()} == plain


def test_chains_of_forms(spark):
    links = [(f"w{i}", f"w{i + 1}") for i in range(37)] + [("v", "w5")]
    got = {r.word: r.root for r in spelling.roots(spark.createDataFrame(links, "word string, form string")).collect()}
    assert got == {**{f"w{i}": "w37" for i in range(37)}, "v": "w37"}


# Capture index


def plain_records(pages):
    """Response or revisit of each page, by equal payloads; nulls after all ids."""
    first = {}
    for i, (page, _, html) in enumerate(pages):
        body = html or ""
        first[body] = min(first.get(body, (True, 0, i + 1)), (page is None, page or 0, i))
    out = []
    for i, (page, _, html) in enumerate(pages):
        body = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        no_id, least, at = first[html or ""]
        kind = "response" if at == i else "revisit"
        out.append((page, len(body), digest, kind, None if no_id or at == i else least))
    return out


def order(rows):
    return sorted(rows, key=repr)


@tables
def test_warc_query(spark):
    pages = pq.read_table(f"{SF}/pages.parquet").to_pydict()
    expected = plain_records(list(zip(pages["page_id"], pages["url"], pages["html"], strict=True)))
    got = QUERIES["op12_warc_index"](spark, SF)
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert order(tuple(r) for r in got.select(*columns).collect()) == order(expected)


PAGES = [
    (5, "http://www.example.org/a?b=1#c", "<p>one</p>"),
    (3, "https://example.org:8080/a\r\nX-Bad: 1", "<p>one</p>"),
    (9, None, None),
    (4, "no address", ""),
    (None, "http://user:pw@example.org/ü", "<p>one</p>"),
    (None, "http://é.example/", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n"),
    (7, "http://www.example.org/a?b=1", "x" * 300_000 + "é"),
    (7, "http://www.example.org/a?b=1", "y"),
    (8, "http://long.example/" + "p" * 700 + "1", "1"),
    (10, "http://long.example/" + "p" * 700 + "2", "2"),
]


@pytest.fixture
def archived(spark):
    rows = spark.createDataFrame([(*p, "n", 1) for p in PAGES], "id bigint, url string, html string, key string, row int")
    return warc_index.write(rows.coalesce(1), "id", "url", "html")


def test_warc_records_come_back(spark, archived, monkeypatch):
    monkeypatch.setattr(warc_index, "BLOCK_ENTRIES", 2)
    index = warc_index.build(archived)
    urls = spark.createDataFrame([(p[1],) for p in PAGES], "url string")
    keys = urls.select(warc_index.surt(F.col("url")).alias("key"))
    found = warc_index.find(keys, index).collect()
    assert len(found) == len(PAGES)
    got = warc_index.read(warc_index.find(keys, index)).collect()
    rows = [
        (None if r.id is None else int(r.id), r.payload_bytes, r.payload_digest, r.record_type,
         None if r.refers_to is None else int(r.refers_to))
        for r in got
    ]
    assert order(rows) == order(plain_records(PAGES))
    texts = {bytes(r.payload).decode() for r in got if r.payload is not None}
    assert texts == {h or "" for _, _, h in PAGES}
    assert all("\n" not in (r.uri or "") for r in got)
    one = spark.createDataFrame([("http://www.example.org/a?b=1",)], "url string")
    hits = warc_index.read(warc_index.find(one.select(warc_index.surt(F.col("url")).alias("key")), index))
    assert sorted(int(r.id) for r in hits.collect()) == [5, 7, 7]
    none = spark.createDataFrame([("org,example)/nowhere",), (None,), ("zz",)], "key string")
    assert warc_index.find(none, index).collect() == []


def test_warc_files_are_archives(spark, archived):
    """The files by themselves: gzip members, each a record whose length is as it says."""
    place = archived.select("root", "file").distinct().collect()
    names = []
    for root, file in place:
        system, path = fs.FileSystem.from_uri(root)
        plain = gzip.decompress(system.open_input_file(f"{path}/{file}").read())
        stream = io.BytesIO(plain)
        while line := stream.readline():
            assert line == b"WARC/1.1\r\n"
            heads = dict(x.decode().rstrip("\r\n").split(": ", 1) for x in iter(stream.readline, b"\r\n"))
            stream.read(int(heads["Content-Length"]))
            assert stream.read(4) == b"\r\n\r\n"
            names.append(heads["WARC-Record-ID"])
    assert len(names) == len(set(names)) == len(PAGES)


def test_index_of_a_frequent_key(spark, monkeypatch):
    monkeypatch.setattr(warc_index, "BLOCK_ENTRIES", 7)
    monkeypatch.setattr(warc_index, "LEAST_SHARD", 50)
    made = [(i, "http://hot.example/" if i % 3 else f"http://h{i}.example/", f"page {i}") for i in range(600)]
    rows = spark.createDataFrame(made, "id bigint, url string, html string")
    index = warc_index.build(warc_index.write(rows, "id", "url", "html"))
    assert index.count() > 3
    keys = spark.createDataFrame([("example,hot)/",), ("example,h3)/",)], "key string")
    assert sorted(int(r.id) for r in warc_index.read(warc_index.find(keys, index)).collect()) == sorted(
        [3, *(i for i in range(600) if i % 3)]
    )


def test_empty_archive(spark):
    none = spark.createDataFrame([], "id bigint, url string, html string")
    index = warc_index.build(warc_index.write(none, "id", "url", "html"))
    keys = spark.createDataFrame([("a",)], "key string")
    assert warc_index.read(warc_index.find(keys, index)).collect() == []


def test_sort_keys(spark):
    urls = ["http://WWW.Example.org:80/P?q#f", "x", None, "http://a.b", "ftp://h/?", "http://u@a.b:9/c"]
    got = spark.createDataFrame([(u,) for u in urls], "url string").select(warc_index.surt(F.col("url")).alias("k"))
    assert [r.k for r in got.collect()] == ["org,example,www:80)/P?q", "", "", "b,a)", "h)/?", "b,a:9)/c"]

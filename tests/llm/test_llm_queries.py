"""The registered queries of the text operators: with SQL, or against plain versions."""

import os

import pyarrow.parquet as pq
import pytest
from brute import decontaminated, emptied, jaccard_components, line_dedup, lm_scores, sha, substring_dedup
from compare import connect, difference

import __spark_entry__ as contract
import corpus_pipeline
from pairmill.llm.oracle import ORACLE
from pairmill.llm.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def table(name, *columns):
    rows = pq.read_table(f"{SF}/{name}.parquet", columns=list(columns)).to_pylist()
    return [tuple(r[c] for c in columns) for r in rows]


def ran(spark, name, *columns):
    return sorted(tuple(r) for r in contract.queries()[name](spark, SF).select(*columns).collect())


@pytest.fixture(scope="module")
def docs():
    return table("documents", "doc_id", "text")


def test_names():
    numbers = {int(n[2:].split("_")[0]) for n in QUERIES}
    assert numbers == set(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, SF), connect(SF), ORACLE[name]) is None


def test_packing(spark, docs):
    rows = QUERIES["op1_best_fit_packing"](spark, SF).collect()
    lengths = {}
    for r in rows:
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
    assert lengths == {d: len((t or "").split()) + 1 for d, t in docs}
    bins = {}
    for r in rows:
        bins.setdefault((r.bin, r.capacity), []).append((r.start, r.length))
    assert len({b for b, _ in bins}) == len(bins)
    for (_, capacity), parts in bins.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at <= capacity and capacity in (512, 1024, 2048, 4096)


def test_line_dedup(spark, docs):
    found = ran(spark, "op4_line_dedup", "doc_id", "kept_sha256")
    assert found == sorted((d, sha(t or "")) for d, t in line_dedup(docs))


def test_decontamination(spark, docs):
    expected = decontaminated(docs, table("benchmark", "item_id", "text"))
    found = ran(spark, "op6_decontamination", "doc_id", "n_words", "n_hit", "n_items", "items_sha256")
    assert found == sorted(expected)
    assert any(r[2] for r in expected)


def test_lm_scores(spark, docs):
    expected, *_ = lm_scores(docs)
    columns = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    found = ran(spark, "op7_backoff_automaton", *columns)
    for a, b in zip(found, sorted(expected), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:])
    held = [r for r in found if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)


def test_ngram_join(spark, docs):
    found = ran(spark, "op9_ngram_jaccard_join", "doc_id", "n_shingles", "component_id")
    assert found == sorted(jaccard_components(docs, 3, 90, 100))


def test_substring_dedup(spark, docs):
    found = ran(spark, "op10_substring_dedup", "doc_id", "n_words", "n_removed", "kept_sha256")
    expected = substring_dedup(docs)
    assert found == sorted(expected)
    assert any(r[2] for r in expected)


def test_surrogates_leave_clean_texts(spark, docs):
    texts = dict(docs)
    for r in QUERIES["op3_surrogates"](spark, SF).collect():
        assert (r.text == texts[r.doc_id]) == (r.n_entities == 0)


def test_pipeline(spark, docs):
    """Each stage on what the one before it kept, against plain versions."""
    texts = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        texts = corpus_pipeline.durable(stage(spark, texts, SF), name)
        if name != "best_fit_packing":
            assert texts.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept[name] = texts
    rows = lambda n: [(r.doc_id, r.text) for r in kept[n].select("doc_id", "text").collect()]
    good, lines = rows("quality_rules"), rows("line_dedup")
    assert {d for d, _ in good} < {d for d, _ in docs}
    texts_of = dict(good)
    left = [(d, t) for d, t in line_dedup(good) if not emptied(texts_of[d], t)]
    assert sorted(lines) == sorted(left)
    assert all(t.split() for _, t in lines)
    heads = {d for d, _, c in jaccard_components(lines, 5, 8, 10) if c == d}
    unlike = rows("ngram_jaccard_join")
    assert {d for d, _ in unlike} == heads
    hits = {r[0] for r in decontaminated(unlike, table("benchmark", "item_id", "text")) if r[2]}
    clean = rows("decontamination")
    assert {d for d, _ in clean} == heads - hits
    packed = kept["best_fit_packing"].collect()
    assert {r.doc_id for r in packed} == {d for d, _ in clean}
    assert sum(r.length for r in packed) == sum(len(t.split()) + 1 for _, t in clean)

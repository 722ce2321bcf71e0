"""Counting: n-grams, pairs, marginals, totals and statistics against brute force."""

import math
import random
import re
import tracemalloc
from collections import Counter
from itertools import combinations

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pairmill.functions.text import canonical_pair, decade_of
from pairmill.operators import coded, ngrams, pairs, scoring, skew
from pairmill.plans import counters, flow
from pairmill.session import durable

WORDS = ["sun", "moon", "Été", "ß", "star", "tide", "the", "of"]


def some_documents(seed=1, n=40):
    rng = random.Random(seed)
    made = []
    for i in range(n):
        # A third of all words is `the`; some documents are short or have no words.
        length = rng.choice([0, 1, 2, 3, 4, 5, 6, 9, 30])
        text = " ".join("the" if rng.random() < 0.33 else rng.choice(WORDS) for _ in range(length))
        made.append((i, f"s{i % 3}", 1990 + i % 20, text + rng.choice(["", "!", " -- 42"])))
    return made


def documents(spark, made):
    return spark.createDataFrame(made, "doc_id bigint, source string, year bigint, text string")


def slices_of(text, n=5):
    t = [w for w in re.split(r"[^a-zà-ÿß]+", text.lower()) if w]
    if not t:
        return []
    return [tuple(t[i : i + n]) for i in range(max(len(t) - n, 0) + 1)]


def brute(made):
    """Pairs, singles, marginals and totals from every n-gram and pair of positions."""
    pair, single, word, total = Counter(), Counter(), Counter(), Counter()
    for _, _, year, text in made:
        d = (year - 1900) // 10
        for g in slices_of(text):
            if len(g) == 1:
                single[d, g[0]] += 1
                word[d, g[0]] += 1
                total[d] += 1
            for a, b in combinations(g, 2):
                pair[(d, *sorted((a, b)))] += 1
                word[d, a] += 1
                word[d, b] += 1
                total[d] += 1
    return pair, single, word, total


def as_rows(counter):
    return sorted((*(k if isinstance(k, tuple) else (k,)), v) for k, v in counter.items())


def test_ngram_counts(spark):
    made = some_documents()
    seen = {}
    for doc, source, year, text in made:
        for g in slices_of(text):
            seen.setdefault((" ".join(g), year), []).append((doc, source))
    expected = sorted(
        (*k, len(v), len({d for d, _ in v}), len({s for _, s in v})) for k, v in seen.items()
    )
    table = ngrams.ngram_counts(documents(spark, made))
    assert rows(table, "ngram", "year", "occurrences", "pages", "volumes") == expected


@pytest.mark.parametrize("seed", [1, 2])
def test_text_and_ngram_routes_equal_brute_force(spark, seed):
    made = some_documents(seed)
    docs = documents(spark, made)
    pair, single, word, total = brute(made)
    for counts in (flow.from_text(docs), flow.from_ngrams(ngrams.ngram_counts(docs))):
        assert rows(counts.pairs, "decade", "w1", "w2", "c_pair") == as_rows(pair)
        assert rows(counts.singles()) == as_rows(single)
        assert rows(counts.marginals, "decade", "w", "c_w") == as_rows(word)
        assert rows(counts.totals) == as_rows(total)
        weights = sorted(
            (d, a, b, c, *((2 * word[d, a], c) if a == b else (word[d, a], word[d, b])), total[d])
            for (d, a, b), c in pair.items()
        )
        assert rows(counts.stats()) == weights
        # The contract's own definitions agree with the token route.
        assert rows(pairs.word_marginals(counts.pairs, counts.singles())) == as_rows(word)
        assert rows(pairs.decade_totals(counts.pairs, counts.singles())) == as_rows(total)


def test_marginals_add_up(spark):
    pair, single, word, _ = brute(some_documents(3))
    assert sum(word.values()) == 2 * sum(pair.values()) + sum(single.values())


def test_center_pairing(spark):
    table = spark.createDataFrame(
        [("a b c d e", 2001, 3), ("x y", 2001, 2), ("z", 2001, 7)], "ngram string, year int, occurrences bigint"
    )
    found = pairs.pair_counts(ngrams.pair_events(table, "center"))
    assert rows(found, "w1", "w2", "c_pair") == [
        ("a", "c", 3), ("b", "c", 3), ("c", "d", 3), ("c", "e", 3), ("x", "y", 2),
    ]
    words = pairs.token_marginals(ngrams.token_events(table, "center"))
    assert rows(words, "w", "c_w", "c_single") == [
        ("a", 3, 0), ("b", 3, 0), ("c", 12, 0), ("d", 3, 0), ("e", 3, 0),
        ("x", 2, 0), ("y", 2, 0), ("z", 7, 7),
    ]
    with pytest.raises(ValueError):
        ngrams.pair_events(table, "edge")


def test_stop_words_leave_before_pairing(spark):
    table = spark.createDataFrame([("the cat sat", 2001, 1)], "ngram string, year int, occurrences bigint")
    found = ngrams.pair_events(table, stop_words=["the"])
    assert rows(found, "w1", "w2") == [("cat", "sat")]


def test_all_years_count(spark):
    table = spark.createDataFrame(
        [("a b", 1899, 1), ("a b", 1900, 1), ("a b", 2019, 1), ("a b", 2020, 1)],
        "ngram string, year int, occurrences bigint",
    )
    assert rows(ngrams.pair_events(table), "decade") == [(-1,), (0,), (11,), (12,)]
    assert rows(spark.range(1).select(decade_of(F.lit(2005)))) == [(10,)]


GOLDEN_PAIRS = [(10, "a", "b", 4), (10, "a", "a", 2)]


def golden(spark):
    pair = spark.createDataFrame(GOLDEN_PAIRS, "decade int, w1 string, w2 string, c_pair bigint")
    single = spark.createDataFrame([(10, "a", 3)], "decade int, w string, c_single bigint")
    marginal = durable(pairs.word_marginals(pair, single), "test")
    return pair, single, marginal, pairs.decade_totals(pair, single)


def test_golden_marginals_self_pair_and_pmi(spark):
    pair, single, marginal, total = golden(spark)
    assert rows(marginal) == [(10, "a", 11), (10, "b", 4)]
    stats = pairs.pair_stats(pair, marginal, total)
    assert rows(stats) == [(10, "a", "a", 2, 22, 2, 9), (10, "a", "b", 4, 11, 4, 9)]
    pmi = {r.w2: r.pmi for r in scoring.scored(stats).collect()}
    assert pmi["b"] == pytest.approx(math.log(36 / 44))
    assert pmi["a"] == pytest.approx(math.log(18 / 44))
    assert rows(pairs.pair_stats(pair, marginal, total, "marginal"))[0] == (10, "a", "a", 2, 11, 11, 9)
    assert rows(pairs.pair_stats(pair, marginal, total, "drop")) == [(10, "a", "b", 4, 11, 4, 9)]
    with pytest.raises(ValueError):
        pairs.pair_stats(pair, marginal, total, "half")


def test_golden_stage_record_counts(spark):
    pair, single, marginal, total = golden(spark)
    stats = pairs.pair_stats(pair, marginal, total)
    found = pairs.stage_record_counts(stats, single, marginal)
    assert rows(found) == [(10, 2, 6), (10, 3, 7), (10, 4, 5), (10, 5, 2)]


def test_pmi_is_null_without_counts(spark):
    from pairmill.functions.scores import pmi_ln

    table = spark.createDataFrame([(0, 1, 1, 1), (1, 1, 1, 0), (1, 2, 2, 8)], "c long, a long, b long, n long")
    found = [r[0] for r in table.select(pmi_ln(F.col("c"), F.col("a"), F.col("b"), F.col("n"))).collect()]
    assert found[:2] == [None, None] and found[2] == pytest.approx(math.log(2))


def test_shuffled_lookup_equals_broadcast_lookup(spark, monkeypatch):
    """Beyond the broadcast size, with hot words served apart, nothing changes."""
    counts = flow.from_text(documents(spark, some_documents(5, 120)))
    small = rows(counts.stats())
    monkeypatch.setattr(pairs, "fits_broadcast", lambda table: False)
    monkeypatch.setattr(skew, "HOT_SALTS", 7)
    for keep in (0, 1, 3, 1000):
        heaviest = lambda lookup, weight, keep=keep: lookup.orderBy(F.desc(weight)).limit(keep)
        monkeypatch.setattr(skew, "heaviest", heaviest)
        assert rows(counts.stats()) == small


def test_salt_stays_in_the_join_key(spark, monkeypatch):
    counts = flow.from_text(documents(spark, some_documents(5)))
    monkeypatch.setattr(pairs, "fits_broadcast", lambda table: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = counts.stats()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line and "w1" in line]
    assert joins and all("_salt" in line for line in joins[:2])


def test_missing_word_drops_the_pair(spark, monkeypatch):
    pair, _, marginal, total = golden(spark)
    known = marginal.where("w <> 'b'")
    expected = [(10, "a", "a", 2, 22, 2, 9)]
    assert rows(pairs.pair_stats(pair, known, total)) == expected
    monkeypatch.setattr(pairs, "fits_broadcast", lambda table: False)
    assert rows(pairs.pair_stats(pair, known, total)) == expected


def test_fits_broadcast_measures_text(spark):
    table = spark.createDataFrame([("x" * 1000,)] * 10, "w string")
    assert skew.fits_broadcast(table, 11_000) and not skew.fits_broadcast(table, 10_000)
    assert skew.fits_broadcast(table.where("false"), 0)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("aAbBÉéz"), st.sampled_from("aAbBÉéz")), min_size=1))
def test_canonical_pair_ignores_order_and_case(spark, entries):
    made = spark.createDataFrame(entries, "a string, b string")
    w1, w2 = canonical_pair(F.col("a"), F.col("b"))
    v1, v2 = canonical_pair(F.upper("b"), F.col("a"))
    for r in made.select(w1.alias("w1"), w2.alias("w2"), v1.alias("v1"), v2.alias("v2")).collect():
        assert (r.w1, r.w2) == (r.v1, r.v2) and r.w1 <= r.w2 and r.w1 == r.w1.lower()


def test_canonical_pair_may_keep_case(spark):
    made = spark.createDataFrame([("harvard", "Yale")], "a string, b string")
    assert rows(pairs.canonical_pairs(made, "a", "b", lowercase=False)) == [("Yale", "harvard")]
    assert rows(pairs.canonical_pairs(made, "a", "b")) == [("harvard", "yale")]


def test_top_and_ranked(spark):
    scores = spark.createDataFrame(
        [(9, "a", chr(98 + i), float(i % 4)) for i in range(20)] + [(10, "a", "b", 1.0)],
        "decade int, w1 string, w2 string, pmi double",
    )
    ranked = rows(scoring.ranked_pairs(scores), "decade", "place", "w2", "pmi")
    nine = sorted(((-float(i % 4), chr(98 + i)) for i in range(20)))
    assert ranked == [(9, n + 1, w, -p) for n, (p, w) in enumerate(nine)] + [(10, 1, "b", 1.0)]
    top = rows(scoring.top_pairs(scores, 3), "decade", "place", "w2", "pmi")
    assert top == [r for r in ranked if r[1] <= 3]


def test_top_pairs_limits_before_the_shuffle(spark):
    scores = spark.createDataFrame([(9, "a", "b", 1.0)], "decade int, w1 string, w2 string, pmi double")
    plan = scoring.top_pairs(scores)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_number_rows_of_a_hot_group(spark):
    rng = random.Random(7)
    made = [("hot" if i % 3 else f"g{i % 50}", i * 7919 % 3001, rng.random()) for i in range(3000)]
    table = spark.createDataFrame(made, "g string, o int, x double").repartition(8)
    found = rows(skew.number_rows(table, ["g"], ["o"], "n", "total"), "g", "o", "n", "total")
    groups = {}
    for g, o, _ in made:
        groups.setdefault(g, []).append(o)
    assert found == sorted(
        (g, o, n + 1, len(v)) for g, v in groups.items() for n, o in enumerate(sorted(v))
    )


def test_counters_equal_the_formula(spark):
    docs = spark.createDataFrame(
        [(1, "s", 1990, "a b a c"), (2, "s", 2005, "one"), (3, "t", 2006, "b a b a d e f")],
        "doc_id bigint, source string, year int, text string",
    )
    counts = flow.from_text(docs)
    scores, seen = counters.counted_run(counts, "r1")
    formula = pairs.stage_record_counts(counts.stats(), counts.singles(), counts.marginals)
    assert rows(counters.stage_records(seen, spark)) == rows(formula.groupBy("stage").agg(F.sum("records")))
    assert seen.of("pairs")["records"] == counts.pairs.count()
    assert seen.of("stats")["positive"] == scores.count() == seen.of("scores")["records"]
    stored = {(r.run, r.stage, r.number): r.value for r in seen.table(spark).collect()}
    assert stored["r1", "words", "singles"] == counts.singles().count()


def test_ranks_evaluate_their_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def watch(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    made = spark.range(0, 500, 1, 4).selectExpr("cast(id % 3 as int) as g", "id").mapInArrow(watch, "g int, id bigint")
    numbered = skew.number_rows(made, ["g"], ["id"], "n", "total")
    assert rows(numbered.groupBy("g").agg(F.max("n"), F.max("total"))) == [(0, 167, 167), (1, 167, 167), (2, 166, 166)]
    assert seen.value == 500


@pytest.mark.parametrize("most", [0, 9, coded.CODES])
def test_coded_counts_equal_plain_counts(spark, monkeypatch, most):
    """Whether all, some or no words have a code, and however few events a task holds."""
    monkeypatch.setattr(coded, "EVENTS", 50)
    monkeypatch.setattr(coded, "TOKENS", 7)
    made = [*some_documents(5), (90, None, None, "sun sun sun"), (91, "s", 1890, "tide"), (92, "s", 1995, None)]
    docs = documents(spark, made)
    marginals = durable(pairs.token_marginals(ngrams.text_token_events(docs)), "marginals")
    codes = coded.word_codes(marginals, most)
    counts = coded.spelled(coded.coded_pair_counts(docs, codes, ngrams.ORDER), codes)
    others = pairs.pair_counts(coded.rare_pair_events(docs, codes, ngrams.ORDER))
    assert (codes.table.count() > 0) == (most > 0) and codes.table.count() <= most
    assert (counts.count() > 0, others.count() > 0) == (most > 0, most < coded.CODES)
    plain = pairs.pair_counts(ngrams.text_pair_events(docs))
    columns = ["decade", "w1", "w2", "c_pair"]
    assert rows(counts.unionByName(others, allowMissingColumns=True), *columns) == rows(plain, *columns)
    totals = pairs.totals_of(marginals)
    table = flow.Counts(plain, marginals, totals, counts, others)
    for rule in pairs.SELF_PAIRS:
        assert rows(table.stats(rule)) == rows(pairs.pair_stats(plain, marginals, totals, rule))


def test_pair_sums_take_one_array_of_events(spark, monkeypatch):
    """Beside its array of events a task makes small arrays only."""
    for name, size in (("EVENTS", 1 << 20), ("TOKENS", 1 << 14), ("SLICE", 1 << 12)):
        monkeypatch.setattr(coded, name, size, raising=False)
    taken = []

    class Text:
        def mapInArrow(self, function, schema):
            taken.append(function)
            raise InterruptedError

    monkeypatch.setattr(coded, "_tokenized", lambda documents: Text())
    words, rng = [f"w{i}" for i in range(500)], random.Random(3)
    codes = coded.word_codes(spark.createDataFrame([(9, w, 7) for w in words], "decade int, w string, c_w bigint"))
    with pytest.raises(InterruptedError):
        coded.coded_pair_counts(None, codes, 5)
    texts = [rng.choices(words, k=1000) for _ in range(400)]
    batch = pa.RecordBatch.from_arrays([pa.array([9] * 400, pa.int32()), pa.array(texts)], names=["decade", "t"])
    tracemalloc.start()
    total = sum(pc.sum(made["c"]).as_py() for made in taken[0](iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert total == 400 * 996 * 10
    assert peak < 2 * 8 * coded.EVENTS


def test_text_pairs_pass_the_shuffle_as_numbers(spark):
    plan = flow.from_text(documents(spark, some_documents())).weighted._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(dealt) == 1 and "pair#" in dealt[0] and "w1" not in dealt[0]


def test_ngram_counts_are_shuffled_once(spark):
    plan = ngrams.ngram_counts(documents(spark, some_documents()))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_pairs_of_rare_words_pass_one_shuffle(spark, monkeypatch):
    """Pairs with a word without a code are dealt by that word, once, with any word table."""
    monkeypatch.setattr(coded.word_codes, "__defaults__", (9,))
    monkeypatch.setattr(coded, "PARTNERS", 3)
    made = [*some_documents(5), (90, None, None, "sun sun sun"), (91, "s", 1890, "tide"), (92, "s", 1995, None)]
    docs = documents(spark, made)
    counts = flow.from_text(docs)
    assert 0 < counts.weighted.count() < counts.pairs.count()
    plain = pairs.pair_counts(ngrams.text_pair_events(docs))
    assert rows(counts.pairs) == rows(plain) and rows(counts.with_weights().select(*plain.columns)) == rows(plain)
    for small in (True, False):
        monkeypatch.setattr(pairs, "fits_broadcast", lambda table, small=small: small)
        for rule in pairs.SELF_PAIRS:
            assert rows(counts.stats(rule)) == rows(pairs.pair_stats(plain, counts.marginals, counts.totals, rule))
    # The partners of a rare word are dealt once, and its pairs meet all weights where they lie.
    plan = counts.rare._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert [line for line in dealt if "REPARTITION_BY_COL" in line] and not any("w1" in line or "code" in line for line in dealt)
    _, seen = counters.counted_run(counts, "r")
    assert seen.of("pairs")["records"] == plain.count()


def test_token_sums_equal_token_events(spark, monkeypatch):
    monkeypatch.setattr(coded, "TOKENS", 7)
    docs = documents(spark, [*some_documents(3), (90, None, None, "sun sun"), (91, "s", 1890, "tide"), (92, "s", 1995, None)])
    for order in (1, 2, 5):
        plain = pairs.token_marginals(ngrams.text_token_events(docs, order))
        assert rows(pairs.token_marginals(coded.text_token_sums(docs, order))) == rows(plain)

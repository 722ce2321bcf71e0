"""Labels, thresholds and the F-measure climb."""

import pytest
from conftest import rows

from pairmill.operators import evaluation, pairs
from pairmill.sources.labels import RELATED, UNRELATED, builtin_labels, word_pairs


def test_builtin_list_sizes(spark):
    assert (len(word_pairs(RELATED)), len(word_pairs(UNRELATED))) == (58, 81)
    labels = builtin_labels(spark).collect()
    assert sum(r.related for r in labels) == 56 and sum(not r.related for r in labels) == 81
    assert {r.decade for r in labels} == {10}
    assert [r for r in labels if r.w1 == r.w2 == "tiger"]


def test_capitals_never_match_unless_normalized(spark):
    def capital(labels):
        return [r for r in labels if (r.w1 + r.w2) != (r.w1 + r.w2).lower()]

    kept = capital(builtin_labels(spark).collect())
    assert (sum(r.related for r in kept), sum(not r.related for r in kept)) == (6, 4)
    assert not capital(builtin_labels(spark, normalize=True).collect())


def test_label_lookup(spark):
    scores = spark.createDataFrame(
        [(10, "bank", "money", 1.5), (10, "money", "operation", 0.1), (10, "a", "b", 9.0), (10, "harvard", "yale", 2.0)],
        "decade int, w1 string, w2 string, pmi double",
    )
    labels = builtin_labels(spark)
    assert rows(evaluation.labelled_only(scores, labels), "w1") == [("bank",), ("money",)]
    found = rows(evaluation.with_labels(scores, labels), "w1", "related")
    assert found == [("bank", True), ("money", False)]
    folded = evaluation.labelled_only(scores, builtin_labels(spark, normalize=True))
    assert folded.count() == 3


def test_ladder_is_summed(spark):
    ladder = evaluation.thresholds()
    assert ladder[:2] == [0.2, 0.30000000000000004] and ladder[6] == 0.7999999999999999
    assert len(ladder) == 30


def labelled(spark, entries):
    return spark.createDataFrame(entries, "pmi double, related boolean")


def climb(spark, entries):
    sweep = evaluation.f_measure_sweep(labelled(spark, entries))
    taken = evaluation.accepted_steps(sweep).orderBy("step").collect()
    best = evaluation.best_step(sweep).collect()
    return [round(r.f_measure, 6) for r in taken], [(r.step, round(r.threshold, 6)) for r in best]


def test_climb_stops_at_the_first_drop(spark):
    assert climb(spark, [(0.25, True), (0.35, False), (0.45, True)]) == ([0.8], [(0, 0.2)])


def test_equal_f_is_accepted_and_zero_over_zero_stops(spark):
    assert climb(spark, [(0.25, False), (0.45, True)]) == ([0.666667, 1.0, 1.0], [(2, 0.4)])


def test_no_related_row_gives_nothing(spark):
    assert climb(spark, [(0.25, False), (0.9, False)]) == ([], [])


def test_sweep_counts_every_step(spark):
    entries = [(0.1, True), (0.2, True), (0.35, False), (9.0, True), (float("nan"), True), (None, True), (-1.0, False)]
    found = evaluation.f_measure_sweep(labelled(spark, entries)).orderBy("step").collect()
    assert len(found) == 30
    for r, t in zip(found, evaluation.thresholds()):
        usable = [(p, y) for p, y in entries if p is not None and p == p]
        assert r.threshold == t
        assert r.tp == sum(p >= t and y for p, y in usable)
        assert r.fp == sum(p >= t and not y for p, y in usable)
        assert r.fn == sum(p < t and y for p, y in usable)
        if r.tp:
            assert r.f_measure == pytest.approx(2 * r.tp / (2 * r.tp + r.fp + r.fn))


def test_sweep_of_nothing(spark):
    found = evaluation.f_measure_sweep(labelled(spark, [])).collect()
    assert len(found) == 30 and all(r.tp == 0 and r.f_measure is None for r in found)


def test_events_are_filtered_before_they_are_counted(spark, monkeypatch):
    made = [(10, "a", "b", 2), (10, "a", "b", 3), (10, "a", "c", 9), (9, "a", "b", 7), (10, "x", "y", 1)]
    events = spark.createDataFrame(made, "decade int, w1 string, w2 string, weight bigint")
    labels = spark.createDataFrame([("a", "b", True), ("x", "y", False), ("u", "v", True)], "w1 string, w2 string, related boolean")
    expected = [(10, "a", "b", 5), (10, "x", "y", 1)]
    for small in (True, False):
        monkeypatch.setattr(evaluation, "fits_broadcast", lambda table, small=small: small)
        kept = evaluation.labelled_events(events, labels)
        assert rows(pairs.pair_counts(kept), "decade", "w1", "w2", "c_pair") == expected
        plan = kept._jdf.queryExecution().optimizedPlan().toString()
        assert "LeftSemi" in plan and "Aggregate" not in plan

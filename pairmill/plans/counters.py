"""Records counted while a stage runs, by observations of its plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pairmill.operators.pairs import weighted_stats
from pairmill.operators.scoring import scored
from pairmill.plans.flow import Counts
from pairmill.session import durable


class Counters:
    """Numbers that the stages of one run report as they pass their rows on."""

    def __init__(self, run: str):
        self.run = run
        self.seen: dict[str, Observation] = {}

    def watch(self, rows: DataFrame, stage: str, **numbers: Column) -> DataFrame:
        """The same rows; when they have been computed, `numbers` over all of them are known."""
        self.seen[stage] = Observation(f"{self.run}-{stage}")
        named = [value.alias(name) for name, value in numbers.items()]
        return rows.observe(self.seen[stage], F.count(F.lit(1)).alias("records"), *named)

    def of(self, stage: str) -> dict[str, int]:
        """What the stage reported; waits until it has run."""
        return self.seen[stage].get

    def table(self, spark: SparkSession) -> DataFrame:
        """Stored `run, stage, number, value` of all stages."""
        rows = [(self.run, s, n, v) for s in self.seen for n, v in self.of(s).items()]
        return durable(spark.createDataFrame(rows, "run string, stage string, number string, value bigint"), "counters")


def counted_run(counts: Counts, run: str = "run") -> tuple[DataFrame, Counters]:
    """Scores of all pairs, stored, and what its stages counted on the way."""
    counters = Counters(run)
    words = durable(counters.watch(counts.marginals, "words", singles=F.count_if(F.col("c_single") > 0)), "words")
    totals = durable(counters.watch(counts.totals, "decades"), "totals")
    # Pairs that come with the weights of their words need not join the word table.
    weighted = counts.with_weights()
    seen = counters.watch(counts.pairs if weighted is None else weighted, "pairs", weight=F.sum("c_pair"))
    stats = Counts(seen, words, totals).stats() if weighted is None else weighted_stats(seen, totals)
    good = (F.col("c_w1") > 0) & (F.col("c_w2") > 0)
    kept = counters.watch(stats, "stats", positive=F.count_if(good))
    scores = durable(counters.watch(scored(kept), "scores"), "scores")
    return scores, counters


def stage_records(counters: Counters, spark: SparkSession) -> DataFrame:
    """`stage, records` handed on by stages 2 to 5 of the counting flow, from the counters.

    The formulas are those of `pairs.stage_record_counts`, over all decades.
    """
    p, w, d = (counters.of(s)["records"] for s in ("pairs", "words", "decades"))
    s = counters.of("words")["singles"]
    rows = [(2, 2 * p + s + d), (3, 2 * p + w + d), (4, 2 * p + d), (5, counters.of("scores")["records"])]
    return spark.createDataFrame(rows, "stage int, records bigint")

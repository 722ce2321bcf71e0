"""Counts per pair, word and decade, and the joined statistics table.

Tables: pairs `decade, w1, w2, c_pair`; singles `decade, w, c_single`; marginals
`decade, w, c_w`; totals `decade, n_total`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmill.functions.text import canonical_pair
from pairmill.operators.skew import fits_broadcast, lookup_join


def canonical_pairs(pairs: DataFrame, a: str, b: str, lowercase: bool = True) -> DataFrame:
    """Replace columns `a`, `b` by the canonical pair `w1`, `w2`."""
    w1, w2 = canonical_pair(F.col(a), F.col(b), lowercase)
    rest = [c for c in pairs.columns if c not in (a, b)]
    return pairs.select(w1.alias("w1"), w2.alias("w2"), *rest)


def pair_counts(events: DataFrame) -> DataFrame:
    """Total weight per decade and pair."""
    return events.groupBy("decade", "w1", "w2").agg(F.sum("weight").alias("c_pair"))


def word_marginals(pairs: DataFrame, singles: DataFrame) -> DataFrame:
    """Weight of each word: its singles plus all its pairs, a self-pair twice."""
    halves = pairs.select(
        "decade", F.explode(F.array("w1", "w2")).alias("w"), F.col("c_pair").alias("c")
    )
    alone = singles.select("decade", "w", F.col("c_single").alias("c"))
    return halves.unionByName(alone).groupBy("decade", "w").agg(F.sum("c").alias("c_w"))


def decade_totals(pairs: DataFrame, singles: DataFrame) -> DataFrame:
    """Weight of all pairs and singles per decade."""
    weights = pairs.select("decade", F.col("c_pair").alias("c")).unionByName(
        singles.select("decade", F.col("c_single").alias("c"))
    )
    return weights.groupBy("decade").agg(F.sum("c").alias("n_total"))


def token_marginals(tokens: DataFrame) -> DataFrame:
    """`word_marginals` from token events, with the single part kept beside it.

    The same numbers from the word counts alone: a word adds its weight once per
    partner. The pair table is not read, and the rows shuffled are words, not pairs.
    """
    return tokens.groupBy("decade", "w").agg(
        F.sum(F.col("paired") + F.col("single")).alias("c_w"),
        F.sum("single").alias("c_single"),
    )


def totals_of(marginals: DataFrame) -> DataFrame:
    """`decade_totals` from token marginals: every pair is counted at two words."""
    return marginals.groupBy("decade").agg(F.expr("sum(c_w + c_single) div 2").alias("n_total"))


SELF_PAIRS = ("doubled", "marginal", "drop")


def pair_stats(
    pairs: DataFrame, marginals: DataFrame, totals: DataFrame, self_pairs: str = "doubled"
) -> DataFrame:
    """Each pair with the weights of its words and of its decade.

    A pair of a word with itself gets, under `doubled`, twice the word's weight as
    `c_w1` and its own weight as `c_w2`; under `marginal` the word's weight in both;
    under `drop` it is left out. `marginals` is a stored table (see `lookup_join`).
    """
    weights = marginals.select("decade", "w", "c_w")
    small = fits_broadcast(weights)
    w2 = {"decade": "decade", "w2": "w"}
    first = with_first_weight(pairs, marginals, small)
    both = lookup_join(first, weights, "c_w", w2, {"c_w": "c_w2"}, ["w1"], small)
    return weighted_stats(both, totals, self_pairs)


def with_first_weight(pairs: DataFrame, marginals: DataFrame, small: bool | None = None) -> DataFrame:
    """Pairs with `c_w1`, the weight of their first word; `small` hands over a measurement."""
    weights = marginals.select("decade", "w", "c_w")
    small = fits_broadcast(weights) if small is None else small
    return lookup_join(pairs, weights, "c_w", {"decade": "decade", "w1": "w"}, {"c_w": "c_w1"}, ["w2"], small)


def weighted_stats(weighted: DataFrame, totals: DataFrame, self_pairs: str = "doubled") -> DataFrame:
    """`pair_stats` of pairs that have the weights of their words, `c_w1` and `c_w2`."""
    if self_pairs not in SELF_PAIRS:
        raise ValueError(f"self_pairs must be one of {SELF_PAIRS}, not {self_pairs!r}")
    if self_pairs == "drop":
        weighted = weighted.where("w1 <> w2")
    # One row per decade: years are whole numbers, so a table of any real corpus is tiny.
    rows = weighted.join(F.broadcast(totals), "decade")
    c_w1, c_w2 = F.col("c_w1"), F.col("c_w2")
    if self_pairs == "doubled":
        same = F.col("w1") == F.col("w2")
        c_w1 = F.when(same, c_w1 * 2).otherwise(c_w1)
        c_w2 = F.when(same, F.col("c_pair")).otherwise(c_w2)
    return rows.select(
        "decade", "w1", "w2", "c_pair", c_w1.alias("c_w1"), c_w2.alias("c_w2"), "n_total"
    )


def stage_record_counts(stats: DataFrame, singles: DataFrame, marginals: DataFrame) -> DataFrame:
    """Records handed on by stages 2 to 5 of the counting flow, per decade and stage.

    With P pairs, S one-word rows and W words in the decade, and one total row:
    stage 2 hands on 2P+S+1, stage 3 2P+W+1, stage 4 2P+1, and stage 5 the pairs
    whose two word weights are positive. `stats` must hold every pair.
    """
    of_pairs = stats.groupBy("decade").agg(
        F.count(F.lit(1)).alias("p"), F.count_if((F.col("c_w1") > 0) & (F.col("c_w2") > 0)).alias("k")
    )
    of_singles = singles.groupBy("decade").agg(F.count(F.lit(1)).alias("s"))
    of_words = marginals.groupBy("decade").agg(F.count(F.lit(1)).alias("w"))
    # Three tables of one row per decade.
    sizes = of_pairs.join(of_singles, "decade", "full").join(of_words, "decade", "full").na.fill(0)
    stages = F.expr("stack(4, 2, 2*p+s+1, 3, 2*p+w+1, 4, 2*p+1, 5, k)")
    return sizes.select("decade", stages.alias("stage", "records"))

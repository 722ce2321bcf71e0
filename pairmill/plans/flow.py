"""The co-occurrence flow: text or n-grams to count tables.

The word table is stored once, because four steps read it (the decade totals, the size
check and two lookups) and it is far smaller than what it is counted from. The pair
table, the large one, stays a lazy plan and is never written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from pairmill.operators import coded, ngrams, pairs
from pairmill.session import bound_batches, durable, planned_bytes, size_shuffles


@dataclass(frozen=True)
class Counts:
    """Count tables of one corpus (columns: see operators.pairs)."""

    pairs: DataFrame
    marginals: DataFrame
    totals: DataFrame
    # The pair table in two: pairs that have their word weights already, and the others.
    weighted: DataFrame | None = None
    others: DataFrame | None = None
    # Those others with the weights of their words; `rarest` lack that of the first one.
    rare: DataFrame | None = None
    rarest: DataFrame | None = None

    def with_weights(self) -> DataFrame | None:
        """All pairs with the weights of their words, if they come with them."""
        if self.rare is None:
            return None
        rarest = pairs.with_first_weight(self.rarest, self.marginals)
        return self.weighted.unionByName(self.rare).unionByName(rarest)

    def stats(self, self_pairs: str = "doubled") -> DataFrame:
        if self.weighted is None:
            return pairs.pair_stats(self.pairs, self.marginals, self.totals, self_pairs)
        if self.rare is not None:
            return pairs.weighted_stats(self.with_weights(), self.totals, self_pairs)
        heavy = pairs.weighted_stats(self.weighted, self.totals, self_pairs)
        return heavy.unionByName(pairs.pair_stats(self.others, self.marginals, self.totals, self_pairs))

    def singles(self) -> DataFrame:
        return self.marginals.where("c_single > 0").select("decade", "w", "c_single")


def _stored(token_events: DataFrame) -> DataFrame:
    return durable(pairs.token_marginals(token_events), "marginals")


def from_text(documents: DataFrame, order: int = ngrams.ORDER) -> Counts:
    """Counts of a text table `doc_id, source, year, text`."""
    size_shuffles(documents.sparkSession, planned_bytes(documents))
    bound_batches(documents.sparkSession)
    marginals = _stored(coded.text_token_sums(documents, order))
    codes = coded.word_codes(marginals)
    weighted = coded.spelled(coded.coded_pair_counts(documents, codes, order), codes)
    lists = coded.rare_pair_lists(documents, codes, order)
    others = coded.rare_pair_counts(lists, codes)
    rare, rarest = coded.rare_weighted_pairs(lists, codes, marginals)
    both = weighted.select(*others.columns).unionByName(others)
    return Counts(both, marginals, pairs.totals_of(marginals), weighted, others, rare, rarest)


def from_ngrams(counts: DataFrame, pairing: str = "all", stop_words=None) -> Counts:
    """Counts of a yearly n-gram table `ngram, year, occurrences`."""
    size_shuffles(counts.sparkSession, planned_bytes(counts))
    marginals = _stored(ngrams.token_events(counts, pairing, stop_words))
    return Counts(
        pairs.pair_counts(ngrams.pair_events(counts, pairing, stop_words)),
        marginals,
        pairs.totals_of(marginals),
    )

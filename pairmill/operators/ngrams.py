"""From text to n-grams, and from n-grams to weighted word pairs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairmill.functions.text import canonical_pair, decade_of, tokens

# Words per n-gram.
ORDER = 5


def slices(documents: DataFrame, order: int = ORDER) -> DataFrame:
    """One row per token: its place, the document length, and the next words.

    Input: `doc_id, source, year, text`. Output: `doc_id, source, year, place` (from
    0), `length`, and `t0..t{order-1}`, null past the end of the document. All n-grams
    and all pairs of a document can be read off these rows, so its text is split
    once and nothing larger than a few words is copied per token.
    """
    kept = ["doc_id", "source", "year"]
    split = documents.select(*kept, tokens(F.col("text")).alias("t"))
    # The length is a column of its own, so that the rows made below carry it and
    # not the whole token array.
    sized = split.select(*kept, "t", F.size("t").alias("length"))
    length = F.col("length")
    ahead = [F.col("t")] + [F.slice("t", k + 1, length) for k in range(1, order)]
    places = F.sequence(F.lit(0), F.greatest(length, F.lit(1)) - 1)
    # No tokens: a null array, which makes no rows.
    rows = F.when(length > 0, F.arrays_zip(places, *ahead))
    return sized.select(
        *kept, "length", F.inline(rows).alias("place", *[f"t{k}" for k in range(order)])
    )


def ngrams(documents: DataFrame, order: int = ORDER) -> DataFrame:
    """Every run of `order` tokens; a shorter document is one n-gram by itself."""
    whole = F.col("place") <= F.greatest(F.col("length") - order, F.lit(0))
    text = F.concat_ws(" ", *[f"t{k}" for k in range(order)])
    return (
        slices(documents, order)
        .where(whole)
        .select("doc_id", "source", "year", text.alias("ngram"))
    )


def ngram_counts(documents: DataFrame, order: int = ORDER) -> DataFrame:
    """The yearly n-gram table: occurrences, documents and sources per (ngram, year).

    `doc_id` is unique, so the n-grams of a document are counted inside its row: they
    are sorted, and each run of equal ones becomes one (ngram, n). What is shuffled is
    then one row per document and n-gram, and the distinct documents are its rows. They
    are dealt by (ngram, year) once, and the distinct sources are counted where they lie:
    few n-grams come again in a task, so sums before the shuffle would save next to none.
    """
    kept = ["year", "source"]
    split = documents.select(*kept, tokens(F.col("text")).alias("t"))
    last = F.greatest(F.size("t") - order, F.lit(0))
    grams = F.transform(
        F.sequence(F.lit(1), last + 1), lambda i: F.concat_ws(" ", F.slice("t", i, order))
    )
    made = split.select(*kept, F.when(F.size("t") > 0, F.sort_array(grams)).alias("g"))
    g, n = F.col("g"), F.size("g")
    # Places (from 1) where a run starts, closed by the place after the last.
    starts = F.filter(F.sequence(F.lit(1), n), lambda i: (i == 1) | (F.get(g, i - 1) != F.get(g, i - 2)))
    runs = made.select(*kept, "g", F.concat(starts, F.array(n + 1)).alias("starts"))
    bounds = F.arrays_zip(
        F.col("starts").alias("first"), F.slice("starts", 2, F.size("starts")).alias("after")
    )
    counted = F.transform(
        F.filter(bounds, lambda b: b["after"].isNotNull()),
        lambda b: F.struct(F.get(g, b["first"] - 1).alias("ngram"), (b["after"] - b["first"]).alias("n")),
    )
    per_document = runs.select(*kept, F.inline(counted).alias("ngram", "n"))
    return per_document.repartition("ngram", "year").groupBy("ngram", "year").agg(
        F.sum("n").alias("occurrences"),
        F.count(F.lit(1)).alias("pages"),
        F.count_distinct("source").alias("volumes"),
    )


def _tokenized(counts: DataFrame, stop_words: Iterable[str] | None) -> DataFrame:
    decade = decade_of(F.col("year"))
    return counts.where(decade.isNotNull()).select(
        decade.alias("decade"),
        tokens(F.col("ngram"), stop_words).alias("t"),
        F.col("occurrences").alias("weight"),
    )


def _position_pairs(t: Column, pairing: str) -> Column:
    """Pairs of distinct positions: `all` of them, or the `center` with each other."""
    last = F.size(t) - 1

    def pair(i, j):
        w1, w2 = canonical_pair(t[i], t[j], lowercase=False)
        return F.struct(w1.alias("w1"), w2.alias("w2"))

    if pairing == "all":
        pairs = F.flatten(
            F.transform(
                F.sequence(F.lit(0), last - 1),
                lambda i: F.transform(F.sequence(i + 1, last), lambda j: pair(i, j)),
            )
        )
    elif pairing == "center":
        middle = F.floor(F.size(t) / 2).cast("int")
        others = F.filter(F.sequence(F.lit(0), last), lambda j: j != middle)
        pairs = F.transform(others, lambda j: pair(middle, j))
    else:
        raise ValueError(f"pairing must be 'all' or 'center', not {pairing!r}")
    return F.when(last > 0, pairs)


def pair_events(
    counts: DataFrame, pairing: str = "all", stop_words: Iterable[str] | None = None
) -> DataFrame:
    """Weighted pairs of an n-gram table: one row per n-gram and pair of positions."""
    rows = _tokenized(counts, stop_words)
    return rows.select(
        "decade", F.inline(_position_pairs(F.col("t"), pairing)).alias("w1", "w2"), "weight"
    )


def text_pair_events(documents: DataFrame, order: int = ORDER) -> DataFrame:
    """The pair events of a text's n-grams, without building the n-grams.

    Two tokens at most order-1 apart share every n-gram that starts late enough to
    reach the second and early enough to hold the first. Counting those starts gives
    the weight, so each token makes order-1 rows, not order*(order-1)/2 for each of
    the n-grams it is in. The sums per pair equal those of `pair_events`.
    """
    decade = decade_of(F.col("year"))
    near = slices(documents.where(decade.isNotNull()), order)
    gaps = [(F.lit(k), F.col(f"t{k}")) for k in range(1, order)]
    rows = near.select(
        decade.alias("decade"),
        "length",
        "place",
        "t0",
        F.stack(F.lit(len(gaps)), *[c for gap in gaps for c in gap]).alias("gap", "other"),
    ).where(F.col("other").isNotNull())
    w1, w2 = canonical_pair(F.col("t0"), F.col("other"), lowercase=False)
    weight = _shared_ngrams(F.col("place"), F.col("place") + F.col("gap"), F.col("length"), order)
    return rows.select("decade", w1.alias("w1"), w2.alias("w2"), weight.alias("weight"))


def _shared_ngrams(first: Column, last: Column, length: Column, order: int) -> Column:
    """How many n-grams of the document hold both places."""
    latest = F.least(first, length - order)
    earliest = F.greatest(last - (order - 1), F.lit(0))
    count = F.when(length > order, latest - earliest + 1).otherwise(1)
    return count.cast("bigint")


def text_token_events(documents: DataFrame, order: int = ORDER) -> DataFrame:
    """Per token: in how many pair events it takes part, and as a single how often.

    Output `decade, w, paired, single`. A token is in one event with each other token
    of each n-gram that holds it.
    """
    decade = decade_of(F.col("year"))
    rows = slices(documents.where(decade.isNotNull()), 1)
    place, length = F.col("place"), F.col("length")
    partners = F.least(length, F.lit(order)) - 1
    return rows.select(
        decade.alias("decade"),
        F.col("t0").alias("w"),
        (_shared_ngrams(place, place, length, order) * partners).alias("paired"),
        F.when(length == 1, 1).otherwise(0).cast("bigint").alias("single"),
    )


def token_events(
    counts: DataFrame, pairing: str = "all", stop_words: Iterable[str] | None = None
) -> DataFrame:
    """`text_token_events` for an n-gram table."""
    sized = _tokenized(counts, stop_words).withColumn("length", F.size("t"))
    # A slice, not the column: for a bare column Spark adds a test that it is not empty
    # and moves it below, where the text would be split a second time.
    each = F.posexplode(F.slice("t", 1, F.col("length")))
    rows = sized.select("decade", "weight", "length", each.alias("place", "w"))
    length = F.col("length")
    partners = length - 1
    if pairing == "center":
        middle = F.floor(length / 2).cast("int")
        partners = F.when(F.col("place") == middle, length - 1).otherwise(1)
    elif pairing != "all":
        raise ValueError(f"pairing must be 'all' or 'center', not {pairing!r}")
    alone = length == 1
    return rows.select(
        "decade",
        "w",
        F.when(alone, 0).otherwise(F.col("weight") * partners).alias("paired"),
        F.when(alone, F.col("weight")).otherwise(0).alias("single"),
    )

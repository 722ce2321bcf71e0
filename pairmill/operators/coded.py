"""Pair counts of a text under word codes, for the pairs of its heavier words.

The heaviest words of all decades (CODES at most) get numbers in the order (decade, word).
A pair of two of them is one number, which a task counts in numpy and the shuffle carries
in place of a decade and two words. All other pairs have a word without a code and go by it
(`rare_pair_lists`), so that none is left out; how many words have a code decides only which
way a pair takes. A word without a code weighs little beside the heaviest, so its partners
and its own weight can meet in one task, and such a pair passes one shuffle too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmill.functions.text import decade_of, tokens
from pairmill.session import durable, fine_tasks, planned_bytes

# Words with a code, at most: a broadcast of some 100 MB.
CODE_BITS = 20
CODES = 1 << CODE_BITS

# Pair events that a task counts at once, in one array of 8 bytes each; tokens that it places
# at once, and places whose pairs it makes, and events it sums, at once. Beside the array a
# task holds a batch of documents, its tokens as 4-byte numbers, and what a slice makes.
EVENTS = 1 << 24
TOKENS = 1 << 19
SLICE = 1 << 18

# Partners of a word without a code that one row has, at most.
PARTNERS = 1 << 12

# A partner and its weight are one number: the code in the high bits.
WEIGHT_BITS = 64 - 2 * CODE_BITS


@dataclass(frozen=True)
class WordCodes:
    """Stored `code, decade, w, c_w`, and the words of each decade for the tasks."""

    table: DataFrame
    words: Broadcast


def word_codes(marginals: DataFrame, most: int = CODES) -> WordCodes:
    """Codes of the words of largest weight.

    Weights fall into classes, eight for each doubling; whole classes are taken, the
    heaviest first, while they hold no more than `most` words.
    """
    spark = marginals.sparkSession
    heavy = marginals.where("c_w > 0").withColumn("_class", F.floor(F.log2("c_w") * 8))
    # At most 8 * 63 classes.
    classes = heavy.groupBy("_class").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("_class")).collect()
    least, held = None, 0
    for row in classes:
        held += row.n
        if held > most:
            break
        least = row["_class"]
    chosen = heavy.where(F.col("_class") >= F.lit(least)).select("decade", "w", "c_w").toArrow()
    chosen = chosen.sort_by([("decade", "ascending"), ("w", "ascending")])
    coded = chosen.add_column(0, "code", pa.array(np.arange(len(chosen), dtype=np.int64)))
    listed = {}
    decades = np.asarray(chosen["decade"])
    for decade in np.unique(decades).tolist():
        first, after = np.searchsorted(decades, [decade, decade + 1]).tolist()
        listed[decade] = (first, chosen["w"][first:after].combine_chunks())
    table = durable(spark.createDataFrame(coded), "codes")
    return WordCodes(table, spark.sparkContext.broadcast(listed))


def _runs() -> Callable:
    """A function that splits batches `decade, t` into runs, and that the workers get by value."""
    most = TOKENS

    def runs(batch: pa.RecordBatch) -> Iterator[tuple]:
        """Some documents at a time: the decades; per token its place, document length and decade's number; the tokens."""
        tokens_of = batch["t"]
        lengths = pc.fill_null(pc.list_value_length(tokens_of), 0).to_numpy().astype(np.int64)
        flat, ends = tokens_of.flatten(), np.cumsum(lengths)
        decades = batch["decade"].to_numpy()
        at = 0
        while at < len(lengths):
            begun = ends[at] - lengths[at]
            to = max(at + 1, int(np.searchsorted(ends, begun + most, "right")))
            own, held = lengths[at:to], flat.slice(begun, ends[to - 1] - begun)
            if len(held):
                found, number = np.unique(decades[at:to], return_inverse=True)
                place = np.arange(len(held), dtype=np.int32)
                place -= np.repeat((np.cumsum(own) - own).astype(np.int32), own)
                length, number = (np.repeat(x.astype(np.int32), own) for x in (own, number))
                yield found, place, length, number, held.dictionary_encode()
            at = to

    return runs


def _placed(codes: WordCodes, order: int) -> Callable:
    """A function that makes the pairs of batches `decade, t`, and that the workers get by value."""
    listed, runs, most = codes.words, _runs(), SLICE

    def pairs(batch: pa.RecordBatch) -> Iterator[tuple]:
        """Per run the words and decades; per slice and gap both words, decade's number, codes (-1: none) and weight of each pair, in 4 bytes each."""
        for found, place, length, decade, coded in runs(batch):
            word, names = coded.indices.to_numpy(), coded.dictionary
            code = np.full(len(word), -1, np.int32)
            for number, d in enumerate(found.tolist()):
                if d in listed.value:
                    first, known = listed.value[d]
                    at = pc.index_in(names, value_set=known)
                    numbers = pc.fill_null(pc.add(at, pa.scalar(first, pa.int32())), -1).to_numpy()
                    here = decade == number
                    code[here] = numbers[word[here]]
            yield names, found, at_gaps(place, length, decade, word, code)

    def at_gaps(place, length, decade, word, code) -> Iterator[tuple]:
        for begun in range(0, len(place), most):
            here = slice(begun, begun + most)
            for gap in range(1, order):
                i = begun + np.flatnonzero(place[here] + gap < length[here])
                first, n = place[i], length[i]
                # As ngrams._shared_ngrams.
                shared = np.minimum(first, n - order) - np.maximum(first + gap - (order - 1), 0) + 1
                weight = np.where(n > order, shared, np.int32(1))
                yield word[i], word[i + gap], decade[i], code[i], code[i + gap], weight

    return pairs


def _tokenized(documents: DataFrame) -> DataFrame:
    decade = decade_of(F.col("year"))
    return documents.where(decade.isNotNull()).select(decade.alias("decade"), tokens(F.col("text")).alias("t"))


def text_token_sums(documents: DataFrame, order: int) -> DataFrame:
    """`ngrams.text_token_events` with the events of a word in a run of documents summed."""
    runs = _runs()

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found, place, length, number, coded in runs(batch):
                names = coded.dictionary
                key = number.astype(np.int64) * len(names) + coded.indices.to_numpy()
                # As ngrams._shared_ngrams. The sums are whole numbers far below 2^53.
                shared = np.minimum(place, length - order) - np.maximum(place - (order - 1), 0) + 1
                paired = np.where(length > order, shared, 1) * (np.minimum(length, order) - 1)
                there = np.flatnonzero(np.bincount(key))
                paired, single = np.bincount(key, paired)[there], np.bincount(key, length == 1)[there]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[there // len(names)], pa.int32()), names.take(pa.array(there % len(names))), pa.array(paired.astype(np.int64)), pa.array(single.astype(np.int64))],
                    names=["decade", "w", "paired", "single"],
                )

    return _tokenized(documents).mapInArrow(sums, "decade int, w string, paired bigint, single bigint")


def coded_pair_counts(documents: DataFrame, codes: WordCodes, order: int) -> DataFrame:
    """`code1, code2, c_pair` of the pairs of two words with a code.

    A task counts EVENTS pair events at a time and hands on sums; these are summed again
    behind one shuffle.
    """
    pairs, most, part, bits, weight_bits = _placed(codes, order), EVENTS, SLICE, CODE_BITS, WEIGHT_BITS
    if order >= 1 << weight_bits:
        raise ValueError(f"no n-grams of {order} words")

    def sums(events: np.ndarray) -> Iterator[pa.RecordBatch]:
        events.sort()
        weights = np.uint64((1 << weight_bits) - 1)
        at = 0
        while at < len(events):
            last = events[min(at + part, len(events)) - 1] | weights
            to = int(np.searchsorted(events, last, "right"))
            pair, weight = events[at:to] >> np.uint64(weight_bits), events[at:to] & weights
            starts = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
            total = np.add.reduceat(weight, starts).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pair[starts].astype(np.int64)), pa.array(total)], names=["pair", "c"])
            at = to

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = np.empty(most, np.uint64), 0
        for batch in batches:
            for _, _, _, a, b, weight in (gap for _, _, gaps in pairs(batch) for gap in gaps):
                both = (a >= 0) & (b >= 0)
                a, b = a[both], b[both]
                packed = np.minimum(a, b).astype(np.uint64) << np.uint64(bits) | np.maximum(a, b).astype(np.uint64)
                packed = packed << np.uint64(weight_bits) | weight[both].astype(np.uint64)
                while len(packed):
                    now = packed[: most - size]
                    held[size : size + len(now)] = now
                    size, packed = size + len(now), packed[len(now) :]
                    if size == most:
                        yield from sums(held)
                        size = 0
        if size:
            yield from sums(held[:size])

    parts = _tokenized(documents).mapInArrow(counted, "pair bigint, c bigint")
    # Dealt by hand: the sums of a task have no pair twice, to sum them there again is in vain.
    # So many that a task holds its sums: sorted runs of them would take longer.
    spark = documents.sparkSession
    tasks = fine_tasks(spark, planned_bytes(documents))
    total = parts.repartition(tasks, "pair").groupBy("pair").agg(F.sum("c").alias("c_pair"))
    return total.select(
        F.shiftright("pair", bits).alias("code1"), F.col("pair").bitwiseAND(CODES - 1).alias("code2"), "c_pair"
    )


def rare_pair_lists(documents: DataFrame, codes: WordCodes, order: int) -> DataFrame:
    """`decade, w, heavy, other, weight`: the pairs that have a word w without a code.

    `heavy` lists partners with a code, as code and weight in one number. A pair of two words
    without a code is a row of its own, w the larger word, with `other` and `weight`.
    """
    pairs, most, bits = _placed(codes, order), PARTNERS, WEIGHT_BITS
    lists = pa.list_(pa.int64())

    def batch_of(decade, w, heavy, other, weight) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(decade, pa.int32()), w, heavy, other, weight], names=["decade", "w", "heavy", "other", "weight"])

    def mixed(names: pa.Array, found: np.ndarray, events: list[tuple]) -> pa.RecordBatch:
        """One row for each decade and word, or a few if it has many partners."""
        w, number, partner = (np.concatenate(x) for x in zip(*events, strict=True))
        key = number.astype(np.int64) * len(names) + w
        order = np.argsort(key, kind="stable")
        key = key[order]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        at = np.arange(len(key)) - np.repeat(starts, np.diff(np.append(starts, len(key))))
        starts = np.flatnonzero(at % most == 0)
        heavy = pa.ListArray.from_arrays(pa.array(np.append(starts, len(key)), pa.int32()), pa.array(partner[order]))
        key, n = key[starts], len(starts)
        return batch_of(found[key // len(names)], names.take(pa.array(key % len(names))), heavy, pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, found, gaps in (run for batch in batches for run in pairs(batch)):
            rank, events = None, []
            for v, w, decade, a, b, weight in gaps:
                one = np.flatnonzero((a < 0) != (b < 0))
                if len(one):
                    first = a[one] < 0
                    partner = np.where(first, b[one], a[one]).astype(np.int64) << bits | weight[one]
                    events.append((np.where(first, v[one], w[one]), decade[one], partner))
                two = np.flatnonzero((a < 0) & (b < 0))
                if len(two):
                    if rank is None:
                        rank = np.empty(len(names), np.int64)
                        rank[pc.sort_indices(names).to_numpy()] = np.arange(len(names))
                    v, w = v[two], w[two]
                    turned = rank[v] > rank[w]
                    w1, w2 = pa.array(np.where(turned, w, v)), pa.array(np.where(turned, v, w))
                    yield batch_of(found[decade[two]], names.take(w2), pa.nulls(len(two), lists), names.take(w1), pa.array(weight[two], pa.int64()))
            if events:
                yield mixed(names, found, events)

    schema = "decade int, w string, heavy array<bigint>, other string, weight bigint"
    return _tokenized(documents).mapInArrow(made, schema)


def _partners(rows: DataFrame, *kept: str) -> DataFrame:
    """One row per partner: `code` (of a word that has one) or `other`, and `weight`."""
    each = rows.select("decade", "w", *kept, "other", "weight", F.explode_outer("heavy").alias("_entry"))
    weight = F.col("_entry").bitwiseAND((1 << WEIGHT_BITS) - 1)
    return each.select(
        "decade", "w", *kept, "other", F.shiftright("_entry", WEIGHT_BITS).alias("code"), F.coalesce(weight, "weight").alias("weight")
    )


def _in_order(w: str, partner, *values) -> list:
    return [F.col("decade"), F.least(w, partner).alias("w1"), F.greatest(w, partner).alias("w2"), *values]


def _with_words(rows: DataFrame, codes: WordCodes) -> DataFrame:
    # As the inner joins of `spelled` ask for them, so that one broadcast serves both; the driver has to hold each.
    words = codes.table.where("code is not null").select("code", F.col("decade").alias("_its_decade"), F.col("w").alias("_word"))
    found = rows.join(F.broadcast(words), "code", "left").withColumn("_partner", F.coalesce("other", "_word"))
    return found.withColumn("decade", F.greatest("decade", "_its_decade")).drop("_its_decade")


def rare_pair_events(documents: DataFrame, codes: WordCodes, order: int) -> DataFrame:
    """`decade, w1, w2, weight` of all other pairs, as `ngrams.text_pair_events` has them."""
    events = _with_words(_partners(rare_pair_lists(documents, codes, order)), codes)
    return events.select(_in_order("w", F.col("_partner"), F.col("weight")))


def rare_pair_counts(lists: DataFrame, codes: WordCodes) -> DataFrame:
    """`decade, w1, w2, c_pair` of the pairs of `rare_pair_lists`, dealt by the word without a code."""
    dealt = _partners(lists.repartition("decade", "w"))
    sums = dealt.groupBy("decade", "w", "other", "code").agg(F.sum("weight").alias("c_pair"))
    return _with_words(sums, codes).select(_in_order("w", F.col("_partner"), F.col("c_pair")))


def rare_weighted_pairs(lists: DataFrame, codes: WordCodes, marginals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`rare_pair_counts` with the weights of the words.

    The weight of w joins its lists where they are dealt, before partners become rows; that
    of a partner with a code comes with the code: `decade, w1, w2, c_pair, c_w1, c_w2`. Pairs
    of two words without a code are apart and lack the weight of the first: `c_w1`.
    """
    weights = marginals.select("decade", "w", F.col("c_w").alias("_own"))
    dealt = lists.repartition("decade", "w").join(weights.hint("shuffle_hash"), ["decade", "w"])
    sums = _partners(dealt, "_own").groupBy("decade", "w", "other", "code").agg(
        F.sum("weight").alias("c_pair"),
        F.first("_own").alias("_own"),
        # A value of the sums, so that the rows are parted here and not in the text, which would be read twice.
        F.bool_or(F.col("other").isNotNull()).alias("_two"),
    )
    words = codes.table.select("code", F.col("decade").alias("_its_decade"), F.col("w").alias("_partner"), F.col("c_w").alias("_its"))
    one = sums.where("not _two").join(F.broadcast(words), "code").withColumn("decade", F.greatest("decade", "_its_decade"))
    own, its = F.col("_own"), F.col("_its")
    first = F.col("w") <= F.col("_partner")
    c_w1, c_w2 = F.when(first, own).otherwise(its), F.when(first, its).otherwise(own)
    one = one.select(_in_order("w", F.col("_partner"), F.col("c_pair"), c_w1.alias("c_w1"), c_w2.alias("c_w2")))
    w1 = F.when(F.col("_two"), F.col("other")).alias("w1")
    two = sums.where("_two").select("decade", w1, F.col("w").alias("w2"), "c_pair", own.alias("c_w2"))
    return one, two


def spelled(counts: DataFrame, codes: WordCodes) -> DataFrame:
    """`decade, w1, w2, c_pair, c_w1, c_w2` of counts under codes."""
    # Both have one decade; both sides are alike, as that of the rare words, so that one broadcast serves all.
    words = codes.table.select("code", "decade", "w", "c_w")
    first, second = (F.broadcast(words).alias(side) for side in ("first", "second"))
    rows = counts.join(first, F.col("code1") == F.col("first.code")).join(
        second, F.col("code2") == F.col("second.code")
    )
    return rows.select(
        F.greatest("first.decade", "second.decade").alias("decade"),
        F.col("first.w").alias("w1"),
        F.col("second.w").alias("w2"),
        "c_pair",
        F.col("first.c_w").alias("c_w1"),
        F.col("second.c_w").alias("c_w2"),
    )

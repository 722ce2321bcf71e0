"""Language-model scores from a weighted backoff automaton (operator 7).

States are the words seen in training and a root. State u has an arc for each word v that
followed it, with weight log10 of the smoothed p(v | u), and a failure arc to the root
with weight log10 of its backoff share. The root has an arc for every word (add-0.1
smoothed counts). A text starts in the state of the end sign and is read once from left
to right: follow the arc of the next word, else fail to the root and follow its arc.

    p(v | u) = (1 - s) * count(u v) / count(u) + s * p(v),   s = share of u's count class

The share of a class of states (by size of their count) is the part of its training
steps that were seen only once, so p sums to one for each state. All pairs are kept.

No task holds the whole automaton. A shard asks for the counts of the words and pairs
that its documents have, which gives the arcs that its documents can take; the same
questions carry its training counts, so each is sent once.

Defined cases: a null text is empty and scores its end sign; a null doc_id is read as
empty text; without any training token every word has the root's smoothed weight; repeated
rows are counted and scored one by one; other columns do not matter; an empty table gives
no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairmill.llm.shards import (
    Answers,
    answered,
    ask,
    ask_first,
    bucket_count,
    grouped,
    partitions,
    stable,
    summed,
    text_of,
    with_answers,
)
from pairmill.llm.textscan import SPACED, mix, scan
from pairmill.session import durable

# Smoothing of the root's counts.
ADD = 0.1
# One document in so many is held out.
FOLDS = 10
# Bounds of a backoff share.
SHARES = (0.02, 0.98)
END = np.uint64(0x2545F4914F6CDD1D)
CLASSES = 64


def is_held_out(doc_id) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % FOLDS == 0


class Shard:
    """Tokens of a block of documents: words, and an end sign after each text."""

    def __init__(self, table: pa.Table):
        found = scan(text_of(table), SPACED, lower=True)
        sizes = found.counts() + 1
        self.first = np.concatenate(([0], np.cumsum(sizes)))
        self.tokens = np.full(self.first[-1], END, np.uint64)
        inner = np.ones(len(self.tokens), bool)
        inner[self.first[1:] - 1] = False
        self.tokens[inner] = found.names
        self.ids = table.column("doc_id").to_pylist()
        self.held_out = np.array([is_held_out(i) for i in self.ids], bool)
        self.trains = np.repeat(~self.held_out, sizes)
        # The state before a token: the token before it, the end sign at the start.
        self.state = np.concatenate(([END], self.tokens[:-1]))

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct tokens, the end sign among them, and their training counts."""
        names = np.append(self.tokens, END)
        return distinct_counts(names, np.append(self.trains, False))

    def pairs(self) -> np.ndarray:
        return mix(self.state * np.uint64(0x9E3779B97F4A7C15) ^ mix(self.tokens))


def distinct_counts(names: np.ndarray, counted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order, first = grouped(names)
    counts = np.add.reduceat(counted[order].astype(np.int64), first) if len(names) else counted
    return names[order][first], counts.astype(np.int64)


def class_of(counts: np.ndarray) -> np.ndarray:
    """Count classes by powers of two; 0 for a count of 0."""
    return np.frexp(counts.astype(np.float64))[1].astype(np.int64)


def _word_totals(names: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Training counts of all words; the bucket's number of tokens and of words."""
    totals = summed(names, counts)
    order, first = grouped(names)
    seen = totals[order][first]
    return totals, np.array([counts.sum(), (seen > 0).sum()])


def _pair_totals(names: np.ndarray, packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Training counts of all pairs; per count class of the state: steps, and those seen once."""
    counts, classes = packed // CLASSES, packed % CLASSES
    totals = summed(names, counts)
    order, first = grouped(names)
    seen, kind = totals[order][first], classes[order][first]
    steps = np.bincount(kind, seen, CLASSES)
    once = np.bincount(kind, seen == 1, CLASSES)
    return totals, np.concatenate((steps, once))


def _notes(answers: DataFrame, length: int) -> np.ndarray:
    """Sum of the buckets' notes: a few numbers per bucket, summed in Spark."""
    add = lambda a, b: [x + y for x, y in zip(a, b, strict=True)]
    notes = answers.where("part < 0").select("answers").rdd.map(
        lambda r: np.frombuffer(bytes(r["answers"][0]), np.int64).tolist()
    )
    return np.array(notes.treeReduce(add) if not notes.isEmpty() else [0] * length, np.int64)


def score(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """`doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`."""
    rows = stable(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")))
    id_type = rows.schema["doc_id"].dataType
    schema = T.StructType.fromDDL(
        "held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double"
    )
    schema = T.StructType([T.StructField("doc_id", id_type), *schema.fields])
    if not partitions(rows):
        return docs.sparkSession.createDataFrame([], schema)
    buckets = bucket_count(rows)

    asked = ask_first(rows, lambda t: Shard(t).words(), buckets)
    words = durable(answered(asked, "words", _word_totals, np.int64), "word-totals")
    train_tokens, train_words = (int(x) for x in _notes(words, 2))
    words = words.where("part >= 0")

    def states_of(shard: Shard, got: Answers) -> tuple[np.ndarray, np.ndarray]:
        """Training counts of each token, and of each token's state."""
        names, _ = shard.words()
        totals = got.get_list("words", names, buckets, np.int64)
        counts = totals[np.searchsorted(names, shard.tokens)]
        end = totals[np.searchsorted(names, END)]
        return counts, np.concatenate(([end], counts[:-1]))

    def ask_pairs(table: pa.Table, got: Answers) -> tuple[np.ndarray, np.ndarray]:
        shard = Shard(table)
        _, before = states_of(shard, got)
        # A state without training steps has no arcs to ask for.
        known = before > 0
        pairs = shard.pairs()[known]
        order, first = grouped(pairs)
        counts = shard.trains[known][order].astype(np.int64)
        counts = np.add.reduceat(counts, first) if len(pairs) else counts
        return pairs[order][first], counts * CLASSES + class_of(before[known][order][first])

    asked = ask(rows, words, ask_pairs, buckets)
    pairs = durable(answered(asked, "pairs", _pair_totals, np.int64), "pair-totals")
    steps, once = np.split(_notes(pairs, 2 * CLASSES), 2)
    pairs = pairs.where("part >= 0")
    shares = np.clip(once / np.maximum(steps, 1), *SHARES)

    def finish(part: int, shards: Iterator) -> Iterator[tuple]:
        for table, got in shards:
            yield from result_rows(table, got)

    def result_rows(table: pa.Table, got: Answers) -> Iterator[tuple]:
        shard = Shard(table)
        counts, before = states_of(shard, got)
        root = (counts + ADD) / (train_tokens + ADD * (train_words + 1))
        known = before > 0
        pair = shard.pairs()[known]
        names = np.unique(pair)
        arcs = got.get_list("pairs", names, buckets, np.int64)[np.searchsorted(names, pair)]
        share = shares[class_of(before[known])]
        weight = np.log10(root)
        arc = (1 - share) * arcs / before[known] + share * root[known]
        step = weight.copy()
        step[known] = np.where(arcs > 0, np.log10(arc), np.log10(share) + weight[known])
        first = shard.first[:-1]
        if not len(first):
            return
        base = np.add.reduceat(weight, first)
        model = np.add.reduceat(step, first)
        n_known = np.add.reduceat((counts > 0).astype(np.int64), first)
        for i, doc in enumerate(shard.ids):
            yield (
                doc,
                bool(shard.held_out[i]),
                int(shard.first[i + 1] - shard.first[i]),
                int(n_known[i]),
                train_tokens,
                float(base[i]),
                float(model[i]),
            )

    return with_answers(rows, words.unionByName(pairs), finish, schema)

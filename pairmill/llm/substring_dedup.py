"""Substring deduplication by recompression (operator 10).

The words of a text become symbols. First each run of one word gets a name of word and
length, then, round by round, each pair of neighbours of which the left is of the round's
left class and the right of its right class gets a name of its own. Names are hashes, so
all shards give the same name to the same content without speaking. A symbol also keeps
the span of words that decides it: equal word sequences hold equal symbols wherever that
span lies inside. Every window of words thus has one symbol of the highest possible level,
the leftmost, that depends on its own words only.

1. Shards ask which of these symbols stand in two documents or more.
2. Windows whose symbol does are verified: shards ask for the smallest document of each
   such window's own name.
3. Words covered by a window that starts in a smaller document go.

Names are 64-bit hashes: two of n different windows share one by chance with n**2 / 2**65.

Defined cases: a null or empty text has no words and keeps none; texts shorter than a
window stay whole; rows that repeat a doc_id count as one document, so none removes from
the other; a null doc_id comes after all others; other columns do not matter; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
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
from pairmill.llm.textscan import SPACED, covered, mix, multipliers, scan, whole_windows, windows
from pairmill.session import durable

WINDOW = 13
# Rounds of pairs; a symbol of the last one holds about (4/3)**rounds words.
ROUNDS = 6
LAST_ID = np.iinfo(np.int64).max


def levels(names: np.ndarray, first: np.ndarray, rounds: int) -> list[tuple]:
    """(names, span starts, span ends) of the symbols of each level, lowest first.

    A span that depends on where a text begins or ends reaches beyond it.
    """
    n = len(names)
    begins = np.zeros(n, bool)
    begins[first[:-1][first[:-1] < first[1:]]] = True
    places = np.arange(n)
    out = [(names, places, places + 1)]
    # Runs of one word. A symbol of this level is decided by its two neighbours too.
    head = begins | np.concatenate(([True], names[1:] != names[:-1]))[:n]
    start = np.flatnonzero(head)
    end = np.append(start[1:], n)
    size = (end - start).astype(np.uint64)
    own = names[start]
    own = np.where(size > 1, mix(own * np.uint64(0x9FB21C651E98DF25) + size), own)
    low, high, new = start - 1, end + 1, begins[start]
    out.append((own, low, high))
    for r, seed in enumerate(multipliers(rounds, 11)):
        m = len(own)
        if m < 2:
            break
        right = (mix(own ^ seed) >> np.uint64(63)).astype(bool)
        # Is the next symbol of the same text?
        joined = ~new[1:]
        pair = ~right[:-1] & right[1:] & joined
        merged_left = np.append(pair, False)
        merged_right = np.concatenate(([False], pair))
        # What an unpaired symbol's neighbour is decides that it stays unpaired.
        next_high = np.append(np.where(joined, high[1:], high[:-1] + 1), high[-1] + 1)
        last_low = np.concatenate(([low[0] - 1], np.where(joined, low[:-1], low[1:] - 1)))
        two = mix(own[:-1] * np.uint64(0xD6E8FEB86659FD93) + own[1:] * np.uint64(0xA0761D6478BD642F) + seed)
        name = np.where(merged_left, np.append(two, np.uint64(0)), own)
        high = np.where(merged_left | ~right, next_high, high)
        low = np.where(~merged_left & right, last_low, low)
        keep = ~merged_right
        own, low, high, new = name[keep], low[keep], high[keep], new[keep]
        out.append((own, low, high))
    return out


def anchors(names: np.ndarray, first: np.ndarray, window: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows, and the name of each one's symbol."""
    starts = np.flatnonzero(whole_windows(first, max(0, len(names) - window + 1), window))
    found = np.zeros(len(starts), np.uint64)
    rest = np.arange(len(starts))
    table = levels(names, first, rounds)
    for level in range(len(table) - 1, -1, -1):
        if not len(rest):
            break
        own, low, high = table[level]
        at = np.searchsorted(low, starts[rest])
        inside = np.minimum(at, len(own) - 1)
        fits = (at < len(own)) & (high[inside] <= starts[rest] + window)
        found[rest[fits]] = mix(own[inside[fits]] + np.uint64(level))
        rest = rest[~fits]
    return starts, found


class Shard:
    """A block of documents with its windows."""

    def __init__(self, table: pa.Table, window: int, rounds: int):
        self.window = window
        self.words = scan(text_of(table), SPACED, lower=False)
        ids = pc.fill_null(table.column("doc_id").cast(pa.int64()), LAST_ID)
        self.ids = ids.to_numpy()
        self.starts, self.anchor = anchors(self.words.names, self.words.first, window, rounds)
        self.doc = np.searchsorted(self.words.first, self.starts, side="right") - 1

    def symbols(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct names of symbols, and whether two documents here have it."""
        if not len(self.anchor):
            return np.empty(0, np.uint64), np.empty(0, np.uint8)
        change = (self.anchor[1:] != self.anchor[:-1]) | (self.doc[1:] != self.doc[:-1])
        head = np.concatenate(([True], change))
        names, docs = self.anchor[head], self.doc[head]
        order, first = grouped(names)
        docs = docs[order]
        shared = np.minimum.reduceat(docs, first) != np.maximum.reduceat(docs, first)
        return names[order][first], shared.astype(np.uint8)

    def candidates(self, got: Answers, buckets: int) -> tuple:
        """Windows whose symbol is shared: places, names, and distinct names with least id."""
        names, _ = self.symbols()
        shared = got.get_list("symbols", names, buckets, np.uint8).astype(bool)
        chosen = shared[np.searchsorted(names, self.anchor)] if len(names) else np.empty(0, bool)
        place, doc = self.starts[chosen], self.doc[chosen]
        name = windows(self.words.names, self.window)[place]
        order, first = grouped(name)
        ids = self.ids[doc]
        least = np.minimum.reduceat(ids[order], first) if len(order) else ids
        return place, ids, name, name[order][first], least

    def removed(self, got: Answers, buckets: int) -> np.ndarray:
        """Which words a window covers that starts in a smaller document."""
        place, ids, name, distinct, least = self.candidates(got, buckets)
        smaller = got.get_list("windows", distinct, buckets, np.uint8).astype(bool)
        at = np.searchsorted(distinct, name)
        gone = place[smaller[at] | (least[at] < ids)] if len(place) else place
        return covered(gone, self.window, len(self.words.names))


def kept_texts(words, keep: np.ndarray) -> Iterator[bytes]:
    """Each text's kept words, joined by one space."""
    starts, ends = words.starts[keep], words.ends[keep]
    upto = np.concatenate(([0], np.cumsum(keep)))[words.first]
    for a, z in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True):
        s, e = starts[a:z], ends[a:z]
        sizes = e - s + 1
        before = np.cumsum(sizes) - sizes
        if not len(s):
            yield b""
            continue
        place = np.arange(int(sizes.sum())) - np.repeat(before - s, sizes)
        line = words.data[np.minimum(place, len(words.data) - 1)]
        line[before + sizes - 1] = 0x20
        yield line[:-1].tobytes()


def _shared(names: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, None]:
    """Does a name come from two shards, or twice from one?"""
    return (summed(names, flags.astype(np.int64) + 1) > 1).astype(np.uint8), None


def _not_least(names: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, None]:
    """Has another shard a smaller document with this window?"""
    order, first = grouped(names)
    out = np.zeros(len(names), np.uint8)
    if len(names):
        least = np.minimum.reduceat(ids[order], first)
        out[order] = ids[order] > np.repeat(least, np.diff(np.append(first, len(names))))
    return out, None


def dedup(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    window: int = WINDOW,
    rounds: int = ROUNDS,
    with_text: bool = True,
) -> DataFrame:
    """`doc_id, n_words, n_removed, kept_sha256` and, if wanted, `kept_text`."""
    rows = stable(docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text")))
    result = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    schema = T.StructType.fromDDL(result + (", kept_text string" if with_text else ""))
    if not partitions(rows):
        return docs.sparkSession.createDataFrame([], schema)
    buckets = bucket_count(rows)
    asked = ask_first(rows, lambda t: Shard(t, window, rounds).symbols(), buckets)
    shared = durable(answered(asked, "symbols", _shared, np.uint8), "shared-symbols")

    def ask_windows(table: pa.Table, got: Answers) -> tuple[np.ndarray, np.ndarray]:
        return Shard(table, window, rounds).candidates(got, buckets)[3:]

    asked = ask(rows, shared, ask_windows, buckets)
    smaller = durable(answered(asked, "windows", _not_least, np.int64), "smaller-windows")

    def finish(part: int, shards: Iterator) -> Iterator[tuple]:
        for table, got in shards:
            yield from result_rows(table, got)

    def result_rows(table: pa.Table, got: Answers) -> Iterator[tuple]:
        shard = Shard(table, window, rounds)
        gone = shard.removed(got, buckets)
        words = shard.words
        lost = np.diff(np.concatenate(([0], np.cumsum(gone)))[words.first])
        counts = zip(
            table.column("doc_id").to_pylist(),
            words.counts().tolist(),
            lost.tolist(),
            kept_texts(words, ~gone),
            strict=True,
        )
        for doc, n, k, kept in counts:
            row = doc, n, k, hashlib.sha256(kept).hexdigest()
            yield (*row, kept.decode("utf-8", "replace")) if with_text else row

    return with_answers(rows, shared.unionByName(smaller), finish, schema)

"""Benchmark decontamination with training suffix arrays (operator 6).

Each block of whole documents is a shard with a suffix array over its words: the places
whose next words can start a benchmark window at all, sorted by the words that follow.
Every benchmark suffix is binary-searched in it; the range that is found gives all
verbatim places of its window, and each is followed as far as both texts agree.

The benchmark travels to the tasks in blocks of a checked size; more blocks are more
passes of one job over the same rows, so a benchmark of any size is searched whole.

Defined cases: a null or empty text has no words and no hits; an item without words never
occurs; repeated benchmark rows with one id count as one item; a null item id is read as
the empty one; repeated documents are judged one by one; the documents' columns are kept
as they are; an empty benchmark leaves all documents clean.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairmill.llm.shards import SHARD_BYTES, give_back
from pairmill.llm.textscan import LETTERS, covered, mix, multipliers, pieces, scan

WINDOW = 10
# Words that a place must share with a benchmark suffix to enter the suffix array.
PREFIX = 4
# Benchmark text sent to the tasks at once.
BLOCK_BYTES = 16 * 1024 * 1024
# Places followed at a time.
STEP = 1 << 19

FOUND = "n_words bigint, spans array<bigint>, items array<string>, longest bigint, place bigint"


class Suffixes:
    """The windows' suffixes of a block of benchmark items, ready to be searched for."""

    def __init__(self, ids: list[str], texts: list[str], window: int):
        self.window, self.ids = window, np.array(ids, dtype=object)
        found = scan(pa.array(texts, pa.large_string()), LETTERS, lower=True)
        self.words, sizes = found.names, found.counts()
        long = np.maximum(sizes - window + 1, 0)
        number = np.where(sizes == 0, 0, np.maximum(long, 1))
        self.item = np.repeat(np.arange(len(ids)), number)
        within = np.arange(len(self.item)) - np.repeat(np.cumsum(number) - number, number)
        self.at = found.first[:-1][self.item] + within
        self.end = found.first[1:][self.item]
        self.need = np.minimum(sizes[self.item], window)
        self.low, self.high = self._bounds()
        self.tables = {}
        for p in sorted(set(np.minimum(self.need, PREFIX).tolist())):
            table = np.zeros(1 << 22, bool)
            own = np.minimum(self.need, PREFIX) == p
            table[prefixes(self.words, self.at[own], p)] = True
            self.tables[p] = table

    def _bounds(self) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest key that starts with the words of each window."""
        rows = gathered(self.words, self.at, self.at + self.need, self.window)
        over = np.arange(self.window) >= self.need[:, None]
        return keys_of(rows), keys_of(np.where(over, ~np.uint64(0), rows))


def prefixes(words: np.ndarray, at: np.ndarray | slice, p: int) -> np.ndarray:
    """22 bits of the p words from each place on."""
    total = np.zeros(len(words) - p + 1 if isinstance(at, slice) else len(at), np.uint64)
    for j, m in enumerate(multipliers(p, 5)):
        total += (words[j : j + len(total)] if isinstance(at, slice) else words[at + j]) * m
    return (mix(total) >> np.uint64(42)).astype(np.int64)


def gathered(words: np.ndarray, at: np.ndarray, end: np.ndarray, k: int) -> np.ndarray:
    """k words from each place on, 0 from `end` on."""
    places = at[:, None] + np.arange(k)
    safe = np.minimum(places, max(len(words) - 1, 0))
    return np.where(places < end[:, None], words[safe], np.uint64(0))


def keys_of(rows: np.ndarray) -> np.ndarray:
    """Rows of words as byte strings that sort as the rows do."""
    wide = np.ascontiguousarray(rows.astype(">u8"))
    return wide.view(f"S{8 * rows.shape[1]}").ravel()


def matches(names: np.ndarray, first: np.ndarray, test: Suffixes) -> Iterator[tuple]:
    """(suffix, place) of all verbatim occurrences in a shard, some at a time."""
    hit = np.zeros(len(names), bool)
    for p, table in test.tables.items():
        if len(names) >= p:
            hit[: len(names) - p + 1] |= table[prefixes(names, slice(None), p)]
    places = np.flatnonzero(hit)
    ends = first[np.searchsorted(first, places, side="right")]
    keys = keys_of(gathered(names, places, ends, test.window))
    order = np.argsort(keys, kind="stable")
    array = keys[order]
    low = np.searchsorted(array, test.low, side="left")
    found = np.searchsorted(array, test.high, side="right") - low
    suffix = np.flatnonzero(found)
    upto = np.cumsum(found[suffix])
    at = 0
    while at < len(suffix):
        base = upto[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(upto, base + STEP, side="right")))
        number = found[suffix[at:to]]
        which = np.repeat(suffix[at:to], number)
        within = np.arange(len(which)) - np.repeat(np.cumsum(number) - number, number)
        yield which, places[order[low[which] + within]]
        at = to


def match_lengths(names, ends, test: Suffixes, which, place) -> np.ndarray:
    """How many words both texts share from each match on."""
    size = test.need[which].copy()
    room = np.minimum(ends[place] - place, test.end[which] - test.at[which])
    alive = np.flatnonzero(size < room)
    while len(alive):
        same = names[place[alive] + size[alive]] == test.words[test.at[which[alive]] + size[alive]]
        alive = alive[same]
        size[alive] += 1
        alive = alive[size[alive] < room[alive]]
    return size


def search(texts: pa.Array, test: Suffixes) -> dict[str, list]:
    """What a block of the benchmark has in each text."""
    words = scan(texts, LETTERS, lower=True)
    n, total = len(texts), len(words.names)
    ends = np.repeat(words.first[1:], words.counts())
    hit = np.zeros(total, bool)
    longest, spot = np.zeros(n, np.int64), np.full(n, -1, np.int64)
    met: set[int] = set()
    for which, place in matches(words.names, words.first, test):
        hit |= covered(place, test.need[which], total)
        doc = np.searchsorted(words.first, place, side="right") - 1
        met.update(np.unique(doc * len(test.ids) + test.item[which]).tolist())
        size = match_lengths(words.names, ends, test, which, place)
        order = np.lexsort((place, -size, doc))
        head = order[np.flatnonzero(np.diff(doc[order], prepend=-1))]
        # Of equal lengths the earliest place, whatever was searched first.
        begin = place[head] - words.first[doc[head]]
        most = longest[doc[head]]
        better = (size[head] > most) | ((size[head] == most) & (begin < spot[doc[head]]))
        head = head[better]
        longest[doc[head]] = size[head]
        spot[doc[head]] = place[head] - words.first[doc[head]]
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    # A run of hit words may cross into the next text; texts cut it again.
    spans: list[list[int]] = [[] for _ in range(n)]
    for a, b in edges.reshape(-1, 2).tolist():
        doc = int(np.searchsorted(words.first, a, side="right")) - 1
        while a < b:
            start, end = int(words.first[doc]), int(words.first[doc + 1])
            if a < end:
                spans[doc] += [a - start, min(b, end) - start]
                a = min(b, end)
            doc += 1
    items: list[list[str]] = [[] for _ in range(n)]
    for pair in met:
        items[pair // len(test.ids)].append(test.ids[pair % len(test.ids)])
    return {
        "n_words": words.counts(),
        "spans": spans,
        "items": items,
        "longest": longest,
        "place": spot,
    }


def _merge(old: dict, new: dict) -> dict:
    spans = []
    for a, b in zip(old["spans"], new["spans"], strict=True):
        marks = sorted(zip((a + b)[::2], (a + b)[1::2], strict=True))
        out: list[int] = []
        for s, e in marks:
            if out and s <= out[-1]:
                out[-1] = max(out[-1], e)
            else:
                out += [s, e]
        spans.append(out)
    most, size = np.asarray(old["longest"]), np.asarray(new["longest"])
    earlier = np.asarray(new["place"]) < np.asarray(old["place"])
    better = (size > most) | ((size == most) & (size > 0) & earlier)
    return {
        "n_words": new["n_words"],
        "spans": spans,
        "items": [a + b for a, b in zip(old["items"], new["items"], strict=True)],
        "longest": np.where(better, new["longest"], old["longest"]),
        "place": np.where(better, new["place"], old["place"]),
    }


def _summary(found: dict) -> pa.Table:
    none = hashlib.sha256(b"").hexdigest()
    listed = [sorted(set(x)) for x in found["items"]]
    hits = [sum(s[1::2]) - sum(s[::2]) for s in found["spans"]]
    digest = [hashlib.sha256(",".join(x).encode()).hexdigest() if x else none for x in listed]
    return pa.table(
        {
            "n_words": pa.array(np.asarray(found["n_words"]), pa.int64()),
            "n_hit": pa.array(hits, pa.int64()),
            "n_items": pa.array([len(x) for x in listed], pa.int64()),
            "items_sha256": pa.array(digest, pa.string()),
            "contaminated": pa.array([h > 0 for h in hits], pa.bool_()),
            "longest_match": pa.array(np.asarray(found["longest"]), pa.int64()),
            "longest_at": pa.array(np.asarray(found["place"]), pa.int64()),
        }
    )


SUMMARY = (
    "n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, "
    "longest_match bigint, longest_at bigint"
)


def benchmark_blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> list[list]:
    """The items in blocks of about `block_bytes`; each is read to the driver by itself."""
    rows = benchmark.select(
        F.coalesce(F.col(item).cast("string"), F.lit("")).alias("i"),
        F.coalesce(F.col(text), F.lit("")).alias("t"),
    )
    size = rows.agg(F.sum(F.octet_length("t") + F.octet_length("i") + 16)).first()[0] or 0
    blocks = -(-size // block_bytes)
    dealt = F.pmod(F.xxhash64("i", "t"), F.lit(max(1, blocks)))
    return [rows.where(dealt == b).distinct().collect() for b in range(blocks)]


def mark(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    keep: list[str] | None = None,
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """`doc` (the row, or the columns of `keep`) and its SUMMARY; no shuffle."""
    blocks = benchmark_blocks(benchmark, item, item_text, block_bytes)
    tests = [[(r["i"], r["t"]) for r in rows] for rows in blocks] or [[]]
    rows = docs.select(
        F.struct(*(keep if keep is not None else ["*"])).alias("doc"), F.col(text).alias("text")
    )
    doc_field = rows.schema["doc"]

    def judged(number: int):
        block, last = tests[number], number == len(tests) - 1

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            test = Suffixes([i for i, _ in block], [t for _, t in block], window)
            for batch in batches:
                for part in pieces(iter([batch]), "text", SHARD_BYTES):
                    found = search(part.column("text"), test)
                    if number:
                        old = {n: part.column(n) for n in found}
                        lists = {n: old[n].to_pylist() for n in ("spans", "items")}
                        plain = {n: old[n].to_numpy() for n in ("longest", "place")}
                        found = _merge(lists | plain, found)
                    doc = part.column("doc")
                    if last:
                        yield from _summary(found).add_column(0, "doc", doc).to_batches()
                        continue
                    made = {"doc": doc, "text": part.column("text")}
                    made["n_words"] = pa.array(np.asarray(found["n_words"]), pa.int64())
                    made["spans"] = pa.array(found["spans"], pa.list_(pa.int64()))
                    made["items"] = pa.array(found["items"], pa.list_(pa.string()))
                    made["longest"] = pa.array(np.asarray(found["longest"]), pa.int64())
                    made["place"] = pa.array(np.asarray(found["place"]), pa.int64())
                    yield pa.RecordBatch.from_pydict(made)
            give_back()

        return run

    for number in range(len(tests)):
        last = number == len(tests) - 1
        more = T.StructType.fromDDL(SUMMARY if last else f"text string, {FOUND}")
        rows = rows.mapInArrow(judged(number), T.StructType([doc_field, *more.fields]))
    return rows


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents without a benchmark window, with the columns they came with."""
    return mark(docs, benchmark, text).where("not contaminated").select("doc.*")

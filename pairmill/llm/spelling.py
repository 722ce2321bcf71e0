"""Spelling variant grouping (operator 11) by asymmetric q-chunks.

Words are counted over all texts. Two words are near if one insertion, deletion or
replacement of a code point turns one into the other. Of a pair, the shorter word (both,
if equally long) is cut into two disjoint chunks, its halves; the other gives its
positional grams of the same sizes. One edit leaves one of the chunks whole and moves it by
one place at most, so joining chunks with the grams within shift one loses no pair; the
edit distance is then verified. Grams further than one place from every chunk can meet none
and are not made.

A chunk that more than `HOT_CHUNK` words share is refined: the half beside it is cut into
two chunks again, of which one edit leaves one whole, and the join asks for both. That is
as exact, and the candidates of a common beginning or ending don't grow with its square.

A word's form is its near word with the most occurrences, if those are at least twice its
own (ties: first in code-point order). Occurrences double at each step, so following forms
ends; the root is the last one, found by doubling the steps, in as many rounds as the
longest chain has binary digits.

Defined cases: null and empty texts have no words; a null id counts as an empty one;
repeated rows count each; a run longer than any other is a word like others; without words
the result is empty; other columns do not matter.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmill.llm.common import lookup
from pairmill.session import durable

LEAST_LETTERS = 5
LEAST_COUNT = 3
# One run in so many, chosen by document and run, has lost a letter.
SLIP = 97
# How many times as frequent a form must be.
TIMES = 2

# Words that a task counts before it hands them on; they are summed after the shuffle.
HELD_WORDS = 400_000
# Code points of a long text looked through at a time.
PIECE = 1 << 20
# Words that share a chunk from which on it is refined.
HOT_CHUNK = 1000

LOWER = bytes(range(0x41)) + bytes(range(0x61, 0x7B)) + bytes(range(0x5B, 0x100))


def _runs(text: str, least: int) -> Iterator[list[str]]:
    """Maximal runs of letters of at least `least` code points, piece by piece."""
    letters = "a-zÀ-ÿ"
    run, other = re.compile(f"[{letters}]{{{least},}}"), re.compile(f"[^{letters}]")
    at = 0
    while at < len(text):
        # A piece ends where a run ends.
        end = other.search(text, at + PIECE)
        to = end.start() if end else len(text)
        yield run.findall(text, at, to)
        at = to


def count_words(docs: DataFrame, slip: int | None = SLIP, least: int = LEAST_LETTERS) -> DataFrame:
    """`word, n`: the runs of letters of all texts, A-Z lower-cased, and their occurrences.

    `slip` deletes a code point of each run whose crc32 together with the id it divides.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def handed() -> pa.RecordBatch:
            made = [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())]
            found.clear()
            return pa.RecordBatch.from_arrays(made, names=["word", "n"])

        for batch in batches:
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                if not text.is_valid:
                    continue
                lowered = text.as_buffer().to_pybytes().translate(LOWER).decode()
                seed = crc32(f"{doc.as_py() if doc.is_valid else ''}:".encode())
                for runs in _runs(lowered, least):
                    for run, n in Counter(runs).items():
                        if slip:
                            h = crc32(run.encode(), seed)
                            if h % slip == 0:
                                at = h % len(run)
                                run = run[:at] + run[at + 1 :]
                                if len(run) < least:
                                    continue
                        found[run] += n
                    if len(found) >= HELD_WORDS:
                        yield handed()
        if found:
            yield handed()

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    counted = rows.mapInArrow(count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def chunks(words: DataFrame) -> DataFrame:
    """`l, part, chunk, at, word, n`: the two halves of each word of length `l`."""
    sized = words.select("word", "n", F.length("word").alias("l"))
    halves = "inline(array(struct(1, 0, l div 2), struct(2, l div 2, l - l div 2))) as (part, at, size)"
    return sized.selectExpr("word", "n", "l", halves).selectExpr(
        "l", "part", "substring(word, at + 1, size) as chunk", "at", "word", "n"
    )


def grams(words: DataFrame, least: int) -> DataFrame:
    """`l, part, chunk, g, other, other_n`: grams that a chunk of a word of length `l` can meet.

    `l` is the word's own length and the one below; `g`, the place, is within one of the chunk's.
    """
    sized = words.select("word", "n", F.length("word").alias("m"))
    lengths = sized.selectExpr("*", "explode(array(m - 1, m)) as l").where(f"l >= {least}")
    places = lengths.selectExpr(
        "*",
        """inline(array(
            struct(1, l div 2, 0), struct(1, l div 2, 1),
            struct(2, l - l div 2, l div 2 - 1), struct(2, l - l div 2, l div 2),
            struct(2, l - l div 2, l div 2 + 1))) as (part, size, g)""",
    ).where("g >= 0 and g + size <= m")
    return places.selectExpr(
        "l", "part", "substring(word, g + 1, size) as chunk", "g", "word as other", "n as other_n"
    )


# The two chunks of the half beside a chunk: number, place and size.
BESIDE = """inline(if(part = 1,
    array(struct(1, l div 2, (l - l div 2) div 2),
          struct(2, l div 2 + (l - l div 2) div 2, l - l div 2 - (l - l div 2) div 2)),
    array(struct(1, 0, l div 2 div 2), struct(2, l div 2 div 2, l div 2 - l div 2 div 2)))) as (sub, s_at, s_size)"""


def refined_chunks(hot: DataFrame) -> DataFrame:
    cut = hot.selectExpr("*", BESIDE)
    return cut.selectExpr("l", "part", "chunk", "sub", "substring(word, s_at + 1, s_size) as piece", "word", "n")


def refined_grams(hot: DataFrame) -> DataFrame:
    cut = hot.selectExpr("*", BESIDE).selectExpr("*", "explode(array(s_at - 1, s_at, s_at + 1)) as s_g")
    cut = cut.where("s_g >= 0 and s_g + s_size <= length(other)")
    return cut.selectExpr(
        "l", "part", "chunk", "sub", "substring(other, s_g + 1, s_size) as piece", "other", "other_n"
    )


def near_pairs(words: DataFrame, least: int = LEAST_LETTERS, hot_chunk: int = HOT_CHUNK) -> DataFrame:
    """`word, n, other, other_n`: each pair of words one edit apart, once.

    `words` is a stored table `word, n` of distinct words of `least` code points or more. Its
    chunks and grams are many rows for each word, which Spark's estimate does not know: it
    would broadcast them by the size of the word table. They are joined through the shuffle.
    """
    key = ["l", "part", "chunk"]
    one, other = chunks(words), grams(words, least)
    hot = durable(one.groupBy(*key).agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > hot_chunk), "hot-chunks")
    marked = hot.select(*key).hint("broadcast" if _few(hot) else "merge")

    def verified(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
        met = a.hint("merge").join(b, on).where("l < length(other) or word < other")
        return met.where(F.levenshtein("word", "other", 1) == 1).select("word", "n", "other", "other_n")

    cold = verified(one.join(marked, key, "left_anti"), other, key)
    warm = verified(
        refined_chunks(one.join(marked, key, "left_semi")),
        refined_grams(other.join(marked, key, "left_semi")),
        [*key, "sub", "piece"],
    )
    return cold.unionByName(warm).dropDuplicates(["word", "other"])


# Chunks sent to every executor: at most this many, of 64 code points at most.
MOST_SENT = 50_000


def _few(hot: DataFrame) -> bool:
    size = hot.agg(F.count(F.lit(1)).alias("n"), F.max(F.length("chunk")).alias("most")).first()
    return size.n <= MOST_SENT and (size.most or 0) <= 64


def roots(links: DataFrame) -> DataFrame:
    """`word, root`: the last word that `word, form` links lead to; they have no circles."""
    known = durable(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        # Doubled steps: the root so far leads to its own root so far.
        after = lookup(known, further, ["root"])
        after = durable(
            after.select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "roots",
        )
        moved = after.where("moved").limit(1).count()
        known = after.drop("moved")
        if not moved:
            return known


def group(words: DataFrame, least: int = LEAST_LETTERS, times: int = TIMES, hot_chunk: int = HOT_CHUNK) -> DataFrame:
    """`word, n, n_near, form, form_n, root` of a table `word, n` of distinct words."""
    words = durable(words.select("word", F.col("n").cast("bigint").alias("n")), "words")
    pairs = durable(near_pairs(words, least, hot_chunk), "near-words")
    turned = pairs.selectExpr("other as word", "other_n as n", "word as other", "n as other_n")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other"))
    near = (
        pairs.unionByName(turned).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    )
    joined = words.join(near.hint("merge"), "word", "left")
    found = durable(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(-F.col("best.less") >= times * F.col("n"), F.col("best.other")).alias("form"),
            F.when(-F.col("best.less") >= times * F.col("n"), -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    last = roots(found.where("form is not null"))
    return lookup(found, last, ["word"]).select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )


def variants(
    docs: DataFrame, slip: int | None = SLIP, least: int = LEAST_LETTERS, least_count: int = LEAST_COUNT
) -> DataFrame:
    """Words of all texts with their near words, forms and roots; see `group`."""
    words = count_words(docs, slip, least).where(F.col("n") >= least_count)
    return group(words, least)

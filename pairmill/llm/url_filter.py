"""URL filter (operator 2): a blocked Bloom filter, then an exact join, then rules.

Listed URLs are brought to a canonical form and entered into a filter of 256-bit blocks,
kept as a table with one row per block. A URL that may be listed (all of its bits stand
in its block) goes on to the join with the list itself, which removes false positives.
Rules on host and path, where one fits, overrule the list.

Defined cases: a null URL, or one without `://`, has an empty host and path, fits no rule
and is never listed; repeated list rows count once; repeated pages are judged one by one;
the input's columns are kept as they are; an empty list blocks nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairmill.llm.common import ascii_lower, is_small, lookup
from pairmill.session import durable

# Rule (host and path) and verdict.
RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)

WORDS = 4  # 64-bit words of a block
BITS_PER_URL = 16
URLS_PER_BLOCK = WORDS * 64 // BITS_PER_URL
TRACKING = r"(?i)^(utm_[a-z]+|ref|gclid|fbclid)="


def host_of(url: Column) -> Column:
    """After the first `://`, up to `/`, `?`, `#` or the end; A-Z lower-cased."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """After the host, up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without `www.`, path without a last slash, sorted query without tracking.

    Null where the URL has no `://`.
    """
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    parts = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    parts = F.array_join(F.sort_array(parts), "&")
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    asked = F.when(parts != "", F.concat(F.lit("?"), parts)).otherwise("")
    return F.when(url.contains("://"), F.concat(host, path, asked))


def _bit(key: Column, seed: int, word: int) -> Column:
    """One bit of the given word, chosen by the key."""
    place = F.pmod(F.xxhash64(F.lit(seed + word), key), F.lit(64)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)


def masks(key: Column) -> list[Column]:
    """The bits of a key: one in each word of its block."""
    return [_bit(key, 101, j).alias(f"m{j}") for j in range(WORDS)]


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(7), key), F.lit(blocks)).cast("bigint").alias("block")


def bloom(keys: DataFrame, n: int) -> tuple[DataFrame, int]:
    """The filter over `key`: a stored table `block, w0..`, and its number of blocks."""
    blocks = max(1, -(-n // URLS_PER_BLOCK))
    bits = keys.select(block_of(F.col("key"), blocks), *masks(F.col("key")))
    table = bits.groupBy("block").agg(*[F.bit_or(f"m{j}").alias(f"w{j}") for j in range(WORDS)])
    return durable(table, "bloom"), blocks


def possible(rows: DataFrame, table: DataFrame, blocks: int) -> DataFrame:
    """Distinct `key` of rows that the filter lets pass: all listed ones and a few more.

    A filter of a checked size is broadcast; a larger one is joined by block, which the
    keys, distinct by then, fill evenly.
    """
    keys = rows.select("key").where("key is not null").distinct()
    marked = keys.select("key", block_of(F.col("key"), blocks), *masks(F.col("key")))
    side = F.broadcast(table) if is_small(table) else table
    fits = F.lit(True)
    for j in range(WORDS):
        fits &= F.col(f"w{j}").bitwiseAND(F.col(f"m{j}")) == F.col(f"m{j}")
    return marked.join(side, "block").where(fits).select("key")


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits host (or a parent domain) and path, as struct; else null."""
    fitting = []
    for rule, verdict in sorted(rules, key=lambda r: -len(r[0])):
        name, slash, below = rule.partition("/")
        fits = (host == name) | host.endswith("." + name)
        fitting.append(
            F.when(
                fits & path.startswith(slash + below),
                F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict")),
            )
        )
    return F.coalesce(*fitting) if fitting else F.lit(None).cast("struct<rule:string,verdict:string>")


def judge(
    pages: DataFrame,
    listed: DataFrame,
    url: str = "url",
    listed_url: str = "url",
    rules: Sequence[tuple[str, str]] = RULES,
) -> DataFrame:
    """`page` (the row as it came), `host`, `path`, `rule`, `listed`, `verdict`."""
    rows = pages.select(
        F.struct("*").alias("page"),
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
        canonical(F.col(url)).alias("key"),
    )
    entries = listed.select(canonical(F.col(listed_url)).alias("key")).where("key is not null")
    entries = durable(entries.distinct(), "listed")
    table, blocks = bloom(entries, entries.count())
    # Distinct on both sides: the exact join has one row per key.
    hits = possible(rows, table, blocks).join(entries, "key", "left_semi")
    found = durable(hits.withColumn("listed", F.lit(True)), "listed-hits")
    fitted = rule_of(F.col("host"), F.col("path"), rules)
    joined = lookup(rows, found, ["key"]).withColumn("_rule", fitted)
    in_list = F.coalesce("listed", F.lit(False))
    return joined.select(
        "page",
        "host",
        "path",
        F.col("_rule.rule").alias("rule"),
        in_list.alias("listed"),
        F.coalesce("_rule.verdict", F.when(in_list, "block").otherwise("allow")).alias("verdict"),
    )

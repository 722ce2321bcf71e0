"""Quality rules judged per document and per host (operator 8). DataFrame functions only.

Each document is held against fixed rules. Failures are summed per host, the host's
failure rate is shrunk towards a beta prior that is fitted to all hosts, and the host's
verdict is joined back to its documents.

Defined cases: a null text has no words and no lines; a null host and an empty one are
the same host; repeated rows are judged one by one and each counts for its host; columns
of the input are kept as they are, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairmill.llm.common import lookup
from pairmill.session import durable

# A document fails on fewer words, or on a larger share of words in repeated windows.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# It also counts as a failure of its host beyond these.
MAX_SYMBOLS_PER_100_WORDS = 10
MAX_DUP_LINE_PERCENT = 30
# A host is rejected when more than this share of its documents is estimated to fail.
MAX_HOST_RATE = 0.5
# Bounds of the prior's weight, in documents.
PRIOR_WEIGHT = (1.0, 1000.0)

SPACE = r"[\x20\x09-\x0D]+"
SPACES = "".join(map(chr, [0x20, *range(0x09, 0x0E)]))
SYMBOLS = "#*$%&|<>"


def with_counts(rows: DataFrame, text: str) -> DataFrame:
    """Add struct `q` with the counts of each text.

    Repeated windows are found by sorting the hashes of a text's own three-word windows;
    two of its windows share a 64-bit hash by chance about once in 10**11 long texts.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    split = rows.select(
        "*",
        F.filter(F.split(body, SPACE), lambda w: w != "").alias("_w"),
        F.filter(F.split(body, "\n"), lambda x: F.translate(x, SPACES, "") != "").alias("_lines"),
        F.length(F.translate(body, SPACES, "")).cast("bigint").alias("_chars"),
        (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("bigint").alias("_symbols"),
    )
    heads = F.slice("_w", 1, F.greatest(F.size("_w") - 2, F.lit(0)))
    hashed = split.select(
        "*",
        F.transform(
            heads, lambda w, i: F.xxhash64(w, F.get("_w", i + 1), F.get("_w", i + 2))
        ).alias("_h"),
    )
    placed = hashed.select(
        "*",
        F.when(
            F.size(F.array_distinct("_h")) < F.size("_h"),
            F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        )
        .otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
        .alias("_s"),
    )
    again = placed.select(
        "*",
        F.sort_array(
            F.transform(
                F.filter(
                    "_s",
                    lambda x, k: x["h"].eqNullSafe(F.get("_s", k + 1)["h"])
                    | x["h"].eqNullSafe(F.get("_s", k - 1)["h"]),
                ),
                lambda x: x["i"],
            )
        ).alias("_p"),
    )
    # A place covers three words, or as many as there are before the next place.
    repeated = F.aggregate(
        F.transform("_p", lambda x, k: F.least(F.coalesce(F.get("_p", k + 1) - x, F.lit(3)), F.lit(3))),
        F.lit(0),
        lambda a, b: a + b,
    )
    counts = {
        "n_words": F.size("_w"),
        "word_chars": F.col("_chars"),
        "n_symbols": F.col("_symbols"),
        "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": repeated,
    }
    # As a generator's result the counts are computed once: a filter on them stays above.
    made = F.struct(*[c.cast("bigint").alias(n) for n, c in counts.items()])
    return again.select(*rows.columns, F.explode(F.array(made)).alias("q"))


def base_failed(q: str = "q") -> Column:
    return (F.col(f"{q}.n_words") < MIN_WORDS) | (
        100 * F.col(f"{q}.n_repeat_words") > MAX_REPEAT_PERCENT * F.col(f"{q}.n_words")
    )


def host_failed(q: str = "q") -> Column:
    """What counts as a failure of the host: a base rule, symbols, or repeated lines."""
    return (
        base_failed(q)
        | (100 * F.col(f"{q}.n_symbols") > MAX_SYMBOLS_PER_100_WORDS * F.col(f"{q}.n_words"))
        | (100 * F.col(f"{q}.n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col(f"{q}.n_lines"))
    )


def host_rates(rows: DataFrame) -> DataFrame:
    """`host, n_docs, n_failed, rate, host_ok` from rows with `host` and `q`.

    Prior: a beta distribution whose mean is that of the hosts' rates and whose variance
    is theirs less the part that chance explains.
    """
    hosts = durable(
        rows.groupBy("host").agg(
            F.count(F.lit(1)).alias("n_docs"), F.count_if(host_failed()).alias("n_failed")
        ),
        "hosts",
    )
    raw = F.col("n_failed") / F.col("n_docs")
    seen = hosts.agg(
        F.avg(raw).alias("m"), F.var_pop(raw).alias("v"), F.avg(1 / F.col("n_docs")).alias("inverse")
    ).first()
    mean = seen["m"] or 0.0
    chance = mean * (1 - mean)
    variance = (seen["v"] or 0.0) - chance * (seen["inverse"] or 0.0)
    low, high = PRIOR_WEIGHT
    weight = min(high, max(low, chance / variance - 1)) if variance > 0 else high
    rate = (F.col("n_failed") + mean * weight) / (F.col("n_docs") + weight)
    # Nine decimals, so that the order of a sum decides nothing.
    return hosts.select("*", F.round(rate, 9).alias("rate")).withColumn(
        "host_ok", F.col("rate") <= MAX_HOST_RATE
    )


def judge(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """`doc` (the row as it came), `q` (its counts), `base_failed`, `rate`, `kept`."""
    rows = with_counts(
        docs.select(
            F.struct("*").alias("doc"),
            F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
            F.col(text).alias("text"),
        ),
        "text",
    ).drop("text")
    slim = with_counts(
        docs.select(
            F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), F.col(text).alias("text")
        ),
        "text",
    )
    verdicts = durable(host_rates(slim), "host-verdicts").select("host", "rate", "host_ok")
    return lookup(rows, verdicts, ["host"], "inner").select(
        "doc",
        "host",
        "q",
        base_failed().alias("base_failed"),
        "rate",
        (~base_failed() & F.col("host_ok")).alias("kept"),
    )


def keep(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The documents that pass, with the columns they came with."""
    return judge(docs, text, host).where("kept").select("doc.*")

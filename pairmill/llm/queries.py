"""The queries of this package: name -> f(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairmill.llm import (
    chat_format,
    decontaminate,
    host_rules,
    line_dedup,
    lm_score,
    ngram_join,
    packing,
    spelling,
    substring_dedup,
    surrogates,
    url_filter,
    warc_index,
    whitening,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# The list of op2 stands in for a published one: the URLs of all hosts whose SHA-256 begins
# with one of these digits (an eighth of them, whatever their names), and of each a URL that
# no page has.
LISTED_DIGITS = "01"


@query
def op2_url_filter(spark, sf):
    """All pages against a list made of an eighth of their hosts, and the rules."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    digit = F.substring(F.sha2(url_filter.host_of(F.col("url")), 256), 1, 1)
    chosen = pages.where(F.col("url").contains("://") & digit.isin(*LISTED_DIGITS)).select("url")
    listed = chosen.unionByName(chosen.select(F.concat("url", F.lit("/never-seen")).alias("url")))
    return url_filter.judge(pages, listed).select(
        "page.page_id", "host", "path", "rule", "listed", "verdict"
    )


@query
def op5_chat_format(spark, sf):
    """All conversations, and one whose texts hold control strings."""
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema
    )
    done = chat_format.format_records(chat_format.records_of(rows.unionByName(extra)))
    back = done.select(
        "conv_id",
        "layout",
        chat_format.parsed(F.col("formatted")).alias("turns"),
        chat_format.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
    return back.select(
        "conv_id",
        "layout",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(chat_format.digest_text(F.col("turns")), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query
def op8_host_rules(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    return host_rules.judge(docs).select(
        "doc.doc_id",
        "q.n_words",
        "q.word_chars",
        "q.n_symbols",
        "q.n_dup_lines",
        "q.n_repeat_words",
        "base_failed",
        "kept",
        F.col("rate").alias("host_rate"),
    )


@query
def op1_best_fit_packing(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return packing.pack(docs, packing.text_length(F.col("text")))


@query
def op6_decontamination(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    marked = decontaminate.mark(docs, table(spark, sf, "benchmark"), keep=["doc_id"])
    return marked.select("doc.doc_id", *[c for c in marked.columns if c != "doc"])


@query
def op10_substring_dedup(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return substring_dedup.dedup(docs, with_text=False)


@query
def op7_backoff_automaton(spark, sf):
    return lm_score.score(table(spark, sf, "documents").select("doc_id", "text"))


@query
def op9_ngram_jaccard_join(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return ngram_join.join(docs, k=3, num=90, den=100)


@query
def op4_line_dedup(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return line_dedup.dedup(docs).select(
        "doc.doc_id",
        "n_lines",
        "n_removed",
        F.length("kept").cast("bigint").alias("kept_chars"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op3_surrogates(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return surrogates.pseudonymize(docs).select(
        "doc.doc_id", F.col("replaced").alias("text"), "n_entities"
    )


@query
def op11_spelling_variants(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return spelling.variants(docs).select("word", "form", "root", "n", "n_near", "form_n")


@query
def op12_warc_index(spark, sf):
    """All pages archived, then each URL looked up in the index and its records read."""
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    index = warc_index.build(warc_index.write(pages, "page_id", "url", "html"))
    wanted = pages.select(warc_index.surt(F.col("url")).alias("key"))
    records = warc_index.read(warc_index.find(wanted, index), with_payload=False)
    kind = pages.schema["page_id"].dataType
    return records.select(
        F.col("id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


@query
def op13_embedding_whitening(spark, sf):
    """All usable embeddings, as whole numbers, on their first eight components."""
    scaled = F.transform(
        "embedding", lambda c: (F.floor(c.cast("double") * 1024).cast("bigint") + 100_000).cast("bigint")
    )
    # An entry without a finite value has no whole number: it stays null and drops the row.
    finite = F.forall(
        F.col("embedding"),
        lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")),
    )
    rows = table(spark, sf, "embeddings").select("vec_id", F.when(finite, scaled).alias("x"))
    done = whitening.whiten(rows, "x", components=8, exact="bigint")
    apart = F.zip_with("row.x", "sums", lambda x, s: x * F.col("n") - s)
    squares = F.aggregate(apart, F.lit(0).cast("bigint"), lambda total, d: total + d * d)
    return done.select(
        F.col("row.vec_id").alias("vec_id"),
        "n",
        squares.alias("deviation"),
        F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c"),
        "identity_error",
    ).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        "n",
        "deviation",
        F.col("c.whitened").alias("whitened"),
        F.col("c.explained").alias("explained"),
        "identity_error",
    )

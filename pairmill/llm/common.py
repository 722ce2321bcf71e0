"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairmill.session import durable

# Largest table sent whole to every executor; checked before each broadcast.
SMALL_BYTES = 32 * 1024 * 1024

# A key with more rows than this share of a shuffle partition's rows is hot.
HOT_SHARE = 0.25


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all other letters as they are."""
    upper = "".join(map(chr, range(0x41, 0x5B)))
    return F.translate(text, upper, upper.lower())


def is_small(stored: DataFrame, limit: int = SMALL_BYTES) -> bool:
    """Measure a stored table: may it be sent to every executor?"""
    width = F.lit(32 + 8 * len(stored.columns)).cast("bigint")
    for f in stored.schema.fields:
        if f.dataType.typeName() in ("string", "binary"):
            width += F.coalesce(F.octet_length(f.name), F.lit(0))
        elif f.dataType.typeName() == "array":
            width += 8 * F.greatest(F.size(f.name), F.lit(0))
    return (stored.agg(F.sum(width)).first()[0] or 0) <= limit


def lookup(rows: DataFrame, stored: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join rows with a stored table that has one row per key; no key becomes a hot task.

    A table of a checked size is broadcast. Beyond that size the keys with a large
    share of the rows are counted (there are few of them, by that share) and their
    table rows broadcast; all other rows are joined by key.
    """
    if is_small(stored):
        return rows.join(F.broadcast(stored), list(keys), how)
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = durable(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "key-counts")
    total = counted.agg(F.sum("_n")).first()[0] or 0
    hot = counted.where(F.col("_n") > max(10_000, total * HOT_SHARE / parts)).drop("_n")
    marked = rows.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), list(keys), "left")
    cold = marked.where("_hot is null").drop("_hot").join(stored, list(keys), how)
    few = stored.join(F.broadcast(hot), list(keys), "left_semi")
    warm = marked.where("_hot").drop("_hot").join(F.broadcast(few), list(keys), how)
    return cold.unionByName(warm)


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """`node, component`: the smallest node that a node reaches over `a, b` edges.

    Each round every node points at the least of itself and its neighbours, pointers are
    doubled until all lead to the end, and each edge goes on between the ends of its nodes,
    once, unless both have one end. An end that no node points at has a lesser neighbour
    then, so two rounds at least halve the nodes that have edges. All steps are stored in
    the shared folder.
    """
    a, b = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    links = durable(edges.where("a <> b").select(a, b).distinct(), label)
    found = None
    while True:
        both = links.union(links.select("b", "a"))
        ends = _ends(durable(_least(both), label), label)
        if found is None:
            found = ends
        else:
            further = ends.select(F.col("node").alias("component"), F.col("component").alias("_end"))
            moved = lookup(found, further, ["component"])
            found = durable(moved.select("node", F.coalesce("_end", "component").alias("component")), label)
        for side in ("a", "b"):
            end = ends.select(F.col("node").alias(side), F.col("component").alias("_end"))
            links = lookup(links, end, [side], "inner").drop(side).withColumnRenamed("_end", side)
            links = durable(links, label) if side == "a" else links
        links = durable(links.where("a <> b").select(a, b).distinct(), label)
        if links.isEmpty():
            return found


def _ends(pointers: DataFrame, label: str) -> DataFrame:
    """Stored `node, component` pointers to lesser nodes, each followed to its end."""
    while True:
        ahead = pointers.select(F.col("node").alias("component"), F.col("component").alias("_end"))
        jumped = lookup(pointers, ahead, ["component"], "inner").select("node", F.col("_end").alias("component"), (F.col("_end") != F.col("component")).alias("_moved"))
        jumped = durable(jumped, label)
        pointers = jumped.drop("_moved")
        if jumped.where("_moved").isEmpty():
            return pointers


def _least(links: DataFrame) -> DataFrame:
    return links.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.first("a")).alias("component")
    )

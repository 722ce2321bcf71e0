"""Scored pairs to Hadoop sequence files (see sources.sequencefile)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmill.sources.sequencefile import KEY, VALUE

FORMAT = "org.apache.hadoop.mapreduce.lib.output.SequenceFileOutputFormat"

# Record numbers start beyond 32 bits: smaller ones would be stored as ints.
FIRST_ID = 1 << 32


def write_pairs(scores: DataFrame, path: str) -> None:
    """One record per scored pair, written by the tasks that hold the rows."""
    text = F.concat_ws("\t", F.concat_ws(" ", "w1", "w2"), F.col("pmi").cast("string"))
    records = scores.select(
        (F.monotonically_increasing_id() + F.lit(FIRST_ID)).alias("id"), text.alias("value")
    )
    records.rdd.map(tuple).saveAsNewAPIHadoopFile(path, FORMAT, keyClass=KEY, valueClass=VALUE)

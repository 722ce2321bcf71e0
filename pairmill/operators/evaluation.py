"""Scores measured against labelled pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairmill.functions.scores import f_measure, precision, recall
from pairmill.operators.skew import fits_broadcast

# The decade the labels speak about.
LABEL_DECADE = 10

# Threshold ladder: start, step and number of steps.
FIRST_THRESHOLD = 0.2
THRESHOLD_STEP = 0.1
THRESHOLD_STEPS = 30


def thresholds(
    first: float = FIRST_THRESHOLD, step: float = THRESHOLD_STEP, steps: int = THRESHOLD_STEPS
) -> list[float]:
    """The ladder by repeated addition, which differs from first + i*step."""
    ladder = [first]
    while len(ladder) < steps:
        ladder.append(ladder[-1] + step)
    return ladder


def label_set(related: DataFrame, unrelated: DataFrame) -> DataFrame:
    """`w1, w2, related`: both sets, each pair once, related winning."""
    both = related.select("w1", "w2", F.lit(True).alias("related")).unionByName(
        unrelated.select("w1", "w2", F.lit(False).alias("related"))
    )
    return both.groupBy("w1", "w2").agg(F.max("related").alias("related"))


def labelled_only(scores: DataFrame, labels: DataFrame) -> DataFrame:
    """Scored pairs that carry a label (semi-join).

    No broadcast hint: labels may be derived from data, so Spark decides by size.
    """
    return scores.join(labels, ["w1", "w2"], "left_semi")


def labelled_events(events: DataFrame, labels: DataFrame) -> DataFrame:
    """The pair events of the label decade that carry a label: before they are counted.

    `labels` is a stored table. One of a checked size is sent to the tasks, so the events
    of other pairs go into no shuffle; else both sides are joined by the pair.
    """
    wanted = labels.select("w1", "w2")
    wanted = F.broadcast(wanted) if fits_broadcast(wanted) else wanted
    return events.where(F.col("decade") == LABEL_DECADE).join(wanted, ["w1", "w2"], "left_semi")


def with_labels(scores: DataFrame, labels: DataFrame) -> DataFrame:
    """Scored pairs that carry a label, with the label."""
    return scores.join(labels.select("w1", "w2", "related"), ["w1", "w2"])


def f_measure_sweep(labelled: DataFrame, ladder: list[float] | None = None) -> DataFrame:
    """tp, fp, fn, precision, recall and F at every threshold of the ladder.

    Input `pmi, related`. A row is positive at the thresholds up to its score, so one
    grouping by how many thresholds it reaches is enough: the data is read once and
    leaves len(ladder)+1 rows, from which the sums are running totals.
    """
    ladder = ladder or thresholds()
    steps = F.array(*[F.lit(t) for t in ladder])
    reached = F.size(F.filter(steps, lambda t: F.col("pmi") >= t))
    usable = labelled.where(F.col("pmi").isNotNull() & ~F.isnan("pmi"))
    counted = usable.groupBy(reached.alias("reached")).agg(
        F.count_if("related").alias("rel"), F.count_if(~F.col("related")).alias("unrel")
    )
    # Per threshold i: the ladder's own rows, so a step no score stops at is there too.
    rungs = labelled.sparkSession.createDataFrame(
        [(i, float(t), i + 1) for i, t in enumerate(ladder)] + [(-1, None, 0)],
        "step int, threshold double, reached int",
    )
    filled = rungs.join(counted, "reached", "left").na.fill(0, ["rel", "unrel"])
    # len(ladder)+1 rows in all.
    up = Window.orderBy("reached").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    below = Window.orderBy("reached").rowsBetween(Window.unboundedPreceding, -1)
    sums = filled.select(
        "step",
        "threshold",
        F.sum("rel").over(up).alias("tp"),
        F.sum("unrel").over(up).alias("fp"),
        F.coalesce(F.sum("rel").over(below), F.lit(0)).alias("fn"),
    ).where(F.col("step") >= 0)
    rated = sums.withColumn("precision", precision(F.col("tp"), F.col("fp"))).withColumn(
        "recall", recall(F.col("tp"), F.col("fn"))
    )
    return rated.withColumn("f_measure", f_measure(F.col("precision"), F.col("recall")))


def accepted_steps(sweep: DataFrame) -> DataFrame:
    """The steps climbed: F never falls; the first drop or undefined F ends the climb."""
    # One row per threshold.
    climb = Window.orderBy("step")
    rises = F.coalesce(
        F.col("f_measure") >= F.lag("f_measure", 1, 0.0).over(climb), F.lit(False)
    )
    failed = F.max(F.when(~F.col("_rises"), 1).otherwise(0)).over(
        climb.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        sweep.withColumn("_rises", rises)
        .withColumn("_failed", failed)
        .where(F.col("_failed") == 0)
        .drop("_rises", "_failed")
    )


def best_step(sweep: DataFrame) -> DataFrame:
    """The last accepted step; no row if the first step already fails."""
    return accepted_steps(sweep).orderBy(F.desc("step")).limit(1)

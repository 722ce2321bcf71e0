"""Lookup joins and row numbers that stay balanced when one key dominates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairmill.session import computed_once, durable

# Keys served by broadcast in a lookup join. It is a count of rows, so the broadcast
# stays a few hundred kilobytes whatever the size of the data.
HOT_KEYS = 4096

# Hash ranges over which the rows of one hot key are spread in the shuffle.
HOT_SALTS = 1024


# Largest table sent whole to every executor.
BROADCAST_BYTES = 128 * 1024 * 1024


def fits_broadcast(table: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Measure a stored table: is it small enough to send to every executor?"""
    texts = [f.name for f in table.schema.fields if f.dataType.typeName() == "string"]
    width = F.lit(32 + 8 * len(table.columns))
    for name in texts:
        width = width + F.coalesce(F.octet_length(name), F.lit(0))
    return (table.agg(F.sum(width)).first()[0] or 0) <= limit


def heaviest(lookup: DataFrame, weight: str, keep: int = HOT_KEYS) -> DataFrame:
    """The `keep` rows of largest weight: a top-k, so bounded by construction.

    Every key left out has at most a 1/keep share of the total weight.
    """
    return lookup.orderBy(F.desc(weight)).limit(keep)


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    weight: str,
    on: dict[str, str],
    values: dict[str, str],
    spread_by: Sequence[str],
    small: bool | None = None,
) -> DataFrame:
    """Inner join of `rows` with a lookup that has one row per key.

    `on` maps columns of `rows` to lookup columns, `values` maps lookup columns to
    output names. `lookup` is a stored table, so measuring it is cheap: a small one is
    broadcast. From a large one the keys of largest `weight` are broadcast. Rows with
    such a key take their values there, and pass the shuffle join under a salt over
    `spread_by`, where nothing matches them, so no task gets a whole hot key. All
    other rows are joined by key as usual. Every row is kept or dropped by the same
    rule as in a plain inner join. `small` hands over an earlier measurement.
    """
    names = list(values.values())
    keys = list(on)
    if fits_broadcast(lookup) if small is None else small:
        small = lookup.select(
            *[F.col(right).alias(left) for left, right in on.items()],
            *[F.col(c).alias(n) for c, n in values.items()],
        )
        return rows.join(F.broadcast(small), keys).select(*rows.columns, *names)
    head = heaviest(lookup, weight).select(
        *[F.col(right).alias(left) for left, right in on.items()],
        F.struct(*[F.col(c).alias(n) for c, n in values.items()]).alias("_hot"),
    )
    tail = lookup.select(
        *[F.col(right).alias(left) for left, right in on.items()],
        F.struct(*[F.col(c).alias(n) for c, n in values.items()]).alias("_cold"),
        # Always 0, but computed from a column: a literal would be folded into the
        # join condition and the salt would drop out of the shuffle key.
        F.pmod(F.hash(F.col(on[keys[0]])), F.lit(1)).alias("_salt"),
    )
    salted = rows.join(F.broadcast(head), keys, "left").withColumn(
        "_salt",
        F.when(F.col("_hot").isNull(), 0).otherwise(
            F.pmod(F.hash(*spread_by), F.lit(HOT_SALTS)) + 1
        ),
    )
    found = salted.join(tail, [*keys, "_salt"], "left").withColumn(
        "_found", F.coalesce("_hot", "_cold")
    )
    return found.where(F.col("_found").isNotNull()).select(
        *rows.columns, *[F.col("_found")[n].alias(n) for n in names]
    )


def number_rows(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column | str],
    number: str,
    total: str | None = None,
) -> DataFrame:
    """1-based position of each row in its group, as `row_number()` would give it.

    A plain window sends a whole group to one task. Here the rows are range-sorted on
    (group, order) into even slots, a hot group covering many of them, and numbered as
    they are stored. A run of a group in a slot starts at its least number; the rows of
    the group in earlier slots are added. `order` must be a total order within the
    group. Rows with a null group are numbered as a group. `total` adds the group size.
    """
    ids = F.monotonically_increasing_id()
    # Finding the ranges reads a sample of the keys: of stored rows, not of a plan run twice.
    slotted = durable(
        computed_once(df, "numbered").repartitionByRange(*group, *order).sortWithinPartitions(*group, *order).withColumn("_id", ids),
        "slots",
    ).withColumn("_slot", F.shiftright("_id", 33))
    # One row per (group, slot): a group has at most as many as there are slots.
    runs = slotted.groupBy(*group, "_slot").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    in_group = Window.partitionBy(*group)
    earlier = in_group.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    shifts = runs.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
        F.col("_slot").alias("_at"),
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
        F.sum("_n").over(in_group).alias("_total"),
    )
    shifts = durable(shifts, "shifts")
    same = F.col("_slot") == F.col("_at")
    for i, g in enumerate(group):
        same &= F.col(g).eqNullSafe(F.col(f"_g{i}"))
    joined = slotted.join(F.broadcast(shifts) if fits_broadcast(shifts) else shifts, same)
    kept = [F.col(c) for c in df.columns]
    kept.append((F.col("_id") + F.col("_shift")).alias(number))
    if total:
        kept.append(F.col("_total").alias(total))
    return joined.select(*kept)

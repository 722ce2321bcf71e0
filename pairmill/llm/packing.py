"""Best-fit packing of documents into sequences of several permitted lengths (operator 1).

Documents are dealt to shards of bounded size. A shard sorts its pieces by falling length
and puts each into the open bin that it fills best; where none fits it opens the bin size
of least cost per token that the pieces left over can still use. All limits on the size
of new bins are tried and the cheapest packing is kept; at last every bin shrinks to the
least costly permitted length that holds its contents.

Defined cases: a document longer than the largest length is cut into pieces, all of them
packed; a document of null or no length takes no space and has a null bin; equal lengths
are ordered by document, those without an id last; repeated rows are packed one by one; other columns do not matter;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairmill.session import durable

CAPACITIES = (512, 1024, 2048, 4096)
# What a sequence costs beside its tokens.
SEQUENCE_COST = 32
# Pieces of a shard, about.
SHARD_PIECES = 100_000

SPACE = r"[\x20\x09-\x0D]+"


def text_length(text: Column) -> Column:
    """Words and one end sign; a null text has the end sign only."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")
    return (F.size(words) + 1).cast("bigint")


def _cost(capacity: int, overhead: int) -> int:
    return capacity + overhead


def _fill(lengths: np.ndarray, sizes: Sequence[int], overhead: int) -> tuple[list[int], list[int]]:
    """Bin of each piece, and the fill of each bin; lengths fall, new bins are of `sizes`."""
    open_bins: list[list[int]] = [[] for _ in range(max(sizes) + 1)]
    free = 0  # bit r is set while a bin with room r is open
    bins, fills = [], []
    left = int(lengths.sum())
    for n in lengths.tolist():
        above = free >> n
        if above:
            room = n + (above & -above).bit_length() - 1
            at = open_bins[room].pop()
            if not open_bins[room]:
                free ^= 1 << room
            fills[at] += n
        else:
            fit = [c for c in sizes if c >= n]
            size = min(fit, key=lambda c: (_cost(c, overhead) / min(c, left), c))
            at, room = len(fills), size
            fills.append(n)
        room -= n
        if room:
            if not open_bins[room]:
                free |= 1 << room
            open_bins[room].append(at)
        bins.append(at)
        left -= n
    return bins, fills


def best_fit(
    lengths: np.ndarray, capacities: Sequence[int], overhead: int
) -> tuple[np.ndarray, np.ndarray]:
    """Bin of each piece and capacity of each bin, the cheapest over all bin-size limits."""
    capacities = sorted(capacities)
    held = np.array(capacities)
    best = None
    for most in range(len(capacities)):
        if capacities[most] < lengths.max():
            continue
        bins, fills = _fill(lengths, capacities[: most + 1], overhead)
        # Downsizing: the smallest permitted length that holds the contents.
        shrunk = held[np.searchsorted(held, fills)]
        cost = int(shrunk.sum()) + overhead * len(fills)
        if best is None or cost < best[0]:
            best = cost, np.array(bins), shrunk
    return best[1], best[2]


def pack(
    docs: DataFrame,
    length: Column,
    key: str = "doc_id",
    capacities: Sequence[int] = CAPACITIES,
    overhead: int = SEQUENCE_COST,
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """`doc_id, piece, length, bin, start, capacity`: each piece's place in a sequence."""
    most = max(capacities)
    sizes = durable(
        docs.select(F.col(key).alias("doc_id"), length.cast("bigint").alias("n")), "lengths"
    )
    whole = F.when(F.col("n") > 0, F.sequence(F.lit(0).cast("bigint"), F.expr(f"(n - 1) div {most}")))
    cut = sizes.select("doc_id", "n", F.explode(whole).alias("piece")).select(
        "doc_id", "piece", F.least(F.lit(most), F.col("n") - F.col("piece") * most).alias("length")
    )
    counted = sizes.agg(F.sum(F.expr(f"if(n > 0, (n - 1) div {most} + 1, 0)"))).first()[0] or 0
    shards = max(1, -(-counted // shard_pieces))
    # The row number spreads rows that repeat one document.
    row = F.monotonically_increasing_id()
    dealt = cut.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", row), F.lit(shards)))

    # In Arrow: in pandas an id beside a null one would become a double.
    def pack_shard(key: tuple, rows: pa.Table) -> pa.Table:
        falling = [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")]
        rows = rows.take(pc.sort_indices(rows, sort_keys=falling))
        lengths = rows["length"].to_numpy()
        bins, held = best_fit(lengths, capacities, overhead)
        order = np.argsort(bins, kind="stable")
        ends = np.cumsum(lengths[order])
        starts = ends - lengths[order]
        first = np.flatnonzero(np.diff(bins[order], prepend=-1))
        base = np.repeat(starts[first], np.diff(np.append(first, len(order))))
        laid = rows.select(["doc_id", "piece", "length"]).take(pa.array(order))
        made = [(key[0].as_py() << 32) + bins[order], starts - base, held[bins[order]]]
        for name, values in zip(("bin", "start", "capacity"), made, strict=True):
            laid = laid.append_column(name, pa.array(values.astype(np.int64)))
        return laid

    kind = sizes.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece bigint, length bigint, bin bigint, start bigint, capacity bigint"
    packed = dealt.groupBy("shard").applyInArrow(pack_shard, schema)
    none = sizes.where("n is null or n <= 0").selectExpr(
        "doc_id", "0L as piece", "0L as length", "cast(null as bigint) as bin",
        "cast(null as bigint) as start", "cast(null as bigint) as capacity",
    )
    return packed.unionByName(none)

"""Embedding whitening (operator 13) with MLlib's BlockMatrix.

Usable vectors get consecutive row numbers; centred rows become the blocks of a tall
distributed matrix. Its transpose times itself is the scatter matrix, one block of
dimensions x dimensions, which alone reaches the driver. A local `eigh` of the covariance
gives the whitening matrix (unit eigenvectors over the root of their eigenvalues), and the
tall matrix times that one projects all rows.

The middle dimension of the first product is split, so that blocks are multiplied and
summed in many tasks. A block has more rows the more rows there are, up to
`MOST_BLOCK_BYTES`: the driver sees the numbers of the blocks (16 million at 100 TB).

Defined cases: a vector that is null, empty or holds a null or non-finite entry is
dropped; so is one whose length is not the most frequent one (the longer of two as
frequent). Repeated rows count and come back one by one. Eigenvalues that are zero up to
rounding have no component: equal vectors, or a single one, give rows with empty arrays.
An empty table gives no rows. Other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmill.session import durable

BLOCK_BYTES = 1 << 19
MOST_BLOCK_BYTES = 1 << 25
# Blocks that one task of the first product multiplies and sums.
BLOCKS_A_TASK = 16
# Up to this number, blocks keep their least size.
MANY_BLOCKS = 4096
# An eigenvalue below this share of their sum is rounding.
ZERO_SHARE = 1e-12


def block_rows(n: int, width: int) -> int:
    """Rows of a block: more of them once there would be very many blocks."""
    least = max(1, BLOCK_BYTES // (8 * width))
    most = max(1, MOST_BLOCK_BYTES // (8 * width))
    return min(most, max(least, -(-n // MANY_BLOCKS)))


def usable(rows: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """`row` (as it came), `x` (doubles) and `at`: vectors that can be used, numbered from 0.

    The rows are stored first, with the number Spark gave them; the rows of earlier
    partitions are added. There is one count for each partition. Their number comes second.
    """
    sound = F.forall(F.col("x"), lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    wide = rows.select(F.struct("*").alias("row"), F.col(vector).cast("array<double>").alias("x"))
    # Size of a null array is null or -1 by setting; neither is above 0.
    kept = stored(wide.where((F.size("x") > 0) & sound))
    usual = kept.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).take(2)
    if len(usual) > 1:
        kept = stored(kept.drop("_id").where(F.size("x") == usual[0].width))
    counts = sorted(tuple(r) for r in kept.groupBy(F.shiftright("_id", 33)).count().collect())
    starts, upto = [], 0
    for number, count in counts:
        starts.append((number, upto - (number << 33)))
        upto += count
    start = rows.sparkSession.createDataFrame(starts, "part bigint, shift bigint")
    placed = kept.withColumn("part", F.shiftright("_id", 33)).join(F.broadcast(start), "part")
    return placed.select("row", "x", (F.col("_id") + F.col("shift")).alias("at")), upto


def stored(rows: DataFrame) -> DataFrame:
    return durable(rows.withColumn("_id", F.monotonically_increasing_id()), "vectors")


def sums(kept: DataFrame, exact: str = "double") -> list:
    """Sum of each dimension, in the given type."""
    parts = kept.select(F.posexplode("x")).groupBy("pos").agg(F.sum(F.col("col").cast(exact)).alias("s"))
    return [r.s for r in sorted(parts.collect())]


def blocks_of(kept: DataFrame, mean: list[float], n: int) -> BlockMatrix:
    """The centred rows as a tall matrix of full-width blocks."""
    width = len(mean)
    height = block_rows(n, width)
    centre = np.array(mean)

    def fill(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("at")
        values = np.stack(rows["x"].to_list()) - centre
        # MLlib wants columns one after another.
        return pd.DataFrame({"block": [key[0]], "entries": [values.tobytes(order="F")]})

    numbered = kept.select(F.expr(f"at div {height}").alias("block"), "at", "x")
    made = durable(numbered.groupBy("block").applyInPandas(fill, "block bigint, entries binary"), "blocks")

    def matrix(r) -> tuple:
        values = np.frombuffer(bytes(r.entries))
        return (r.block, 0), DenseMatrix(len(values) // width, width, values)

    return BlockMatrix(made.rdd.map(matrix), height, width, n, width)


def scatter(tall: BlockMatrix) -> np.ndarray:
    """Transpose times the matrix itself, brought to the driver: width x width."""
    splits = max(1, tall.numRowBlocks // BLOCKS_A_TASK)
    # The Python method leaves out the number of splits of the middle dimension, without
    # which all blocks would meet in one task.
    turned = tall.transpose()
    made = turned._java_matrix_wrapper.call("multiply", tall._java_matrix_wrapper._java_model, splits)
    product = BlockMatrix(made, turned.rowsPerBlock, tall.colsPerBlock)
    return product.toLocalMatrix().toArray()


def whitening_matrix(covariance: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns that project to unit variance, and their eigenvalues, falling."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > ZERO_SHARE * max(np.trace(covariance), 0.0)]
    return vectors[:, order] / np.sqrt(values[order]), values[order]


def projected(tall: BlockMatrix, matrix: np.ndarray, spark) -> DataFrame:
    """`at, whitened`: the tall matrix times the whitening matrix, by rows."""
    width, count = matrix.shape
    small = [((0, 0), DenseMatrix(width, count, matrix.ravel(order="F")))]
    right = BlockMatrix(spark.sparkContext.parallelize(small, 1), width, count, width, count)
    height = tall.rowsPerBlock

    def packed(block: tuple) -> tuple:
        (number, _), values = block
        return number, values.toArray().tobytes()

    made = spark.createDataFrame(tall.multiply(right).blocks.map(packed), "block bigint, entries binary")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch["block"].to_pylist(), batch["entries"], strict=True):
                values = np.frombuffer(data.as_buffer()).reshape(-1, count)
                at = pa.array(np.arange(len(values)) + block * height)
                ends = pa.array(np.arange(len(values) + 1, dtype=np.int32) * count)
                lists = pa.ListArray.from_arrays(ends, pa.array(values.ravel()))
                yield pa.RecordBatch.from_arrays([at, lists], names=["at", "whitened"])

    return made.mapInArrow(rows, "at bigint, whitened array<double>")


def identity_error(white: DataFrame, count: int) -> float:
    """Largest entry of the whitened rows' covariance less the identity, without sign."""
    entry = [F.col("whitened")[i] for i in range(count)]
    off = [
        F.abs(F.covar_pop(entry[i], entry[j]) - F.lit(float(i == j)))
        for i in range(count)
        for j in range(i, count)
    ]
    return white.agg(F.array_max(F.array(*off)).alias("e")).first().e


def whiten(rows: DataFrame, vector: str, components: int = 8, exact: str = "double") -> DataFrame:
    """`row` (as it came), `n`, `sums`, `whitened`, `explained`, `identity_error`.

    `n` usable vectors, `sums` of each dimension (as type `exact`), `whitened` the
    coordinates of the row on the first components, `explained` their shares of the
    variance (arrays of up to `components` doubles).
    """
    spark = rows.sparkSession
    kept, n = usable(rows, vector)
    total, shares, error = sums(kept, exact), [], None
    white = kept.selectExpr("at", "cast(array() as array<double>) as whitened")
    if n:
        tall = blocks_of(kept, [float(s) / n for s in total], n)
        covariance = scatter(tall) / n
        matrix, values = whitening_matrix(covariance, components)
        shares = [float(v / np.trace(covariance)) for v in values]
    if shares:
        white = durable(projected(tall, matrix, spark), "whitened")
        error = identity_error(white, len(shares))
    return kept.join(white, "at").select(
        "row",
        F.lit(n).cast("bigint").alias("n"),
        F.lit(total).cast(f"array<{exact}>").alias("sums"),
        "whitened",
        F.lit(shares).cast("array<double>").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )

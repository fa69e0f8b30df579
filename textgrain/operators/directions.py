"""The leading direction of a table of vectors of any width."""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgrain.functions.vectors import dot
from textgrain.operators.lookup import BROADCAST_BYTES
from textgrain.session import durable, scratch

# Directions that one pass over the rows moves.
BLOCK = 8
# Blocks of powers that are kept before the best of them start anew.
KEPT = 6
TOLERANCE = 1e-12
# Passes after which the best direction so far is returned with a warning.
PASSES = 80


def moved(rows: DataFrame, block: np.ndarray, column: str) -> np.ndarray:
    """``G @ block`` for the Gram matrix G of the rows, which is never formed.

    A row's products with the directions stay in the row; the exchange moves partial sums of
    one row per dimension.  The directions are one small row, ``width * BLOCK`` numbers.
    """
    spark, (width, count) = rows.sparkSession, block.shape
    axes = spark.createDataFrame([([[float(x) for x in axis] for axis in block.T],)], "axes array<array<double>>")
    shares = rows.withColumn("_axes", axes.scalar()).withColumn("_share", F.transform("_axes", lambda axis: dot(column, axis)))
    entries = shares.select("_share", F.posexplode(column).alias("dim", "x"))
    sums = entries.groupBy("dim").agg(*[F.sum(F.col("x") * F.get("_share", j)).alias(f"s{j}") for j in range(count)])
    found = np.zeros((width, count))
    for row in sums.filter(F.col("dim") < width).collect():
        found[row[0]] = [x or 0.0 for x in row[1:]]
    return found


def independent(block: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span what ``block`` adds to an orthonormal basis."""
    scale = np.linalg.norm(block, axis=0)
    block = block[:, scale > 0] / scale[scale > 0]
    for _ in range(2):
        block = block - basis @ (basis.T @ block)
        axes, sizes, _ = np.linalg.svd(block, full_matrices=False)
        block = axes[:, sizes > 1e-10]
    return block


def leading_direction(
    rows: DataFrame, column: str = "vec", tolerance: float = TOLERANCE, passes: int = PASSES
) -> np.ndarray:
    """Leading right singular vector of the (uncentred) rows, by block powers.

    Every pass over the rows multiplies a block of directions by the Gram matrix.  The powers
    are kept, and the best direction in their span is taken; it is finished when its residual,
    relative to its eigenvalue, is at most ``tolerance``, or when the span is all there is.
    The driver holds ``width * BLOCK * KEPT`` numbers twice, never ``width ** 2`` and never a row.

    Cases: null vectors are left out and null entries count as zero; a shorter vector has
    zeros at its end.  Without any vector the result is empty; for zero vectors it is zeros.
    Of two equally strong directions any mixture may be returned.
    """
    with scratch():
        vectors = rows.select(F.col(column).cast("array<double>").alias(column)).filter(F.col(column).isNotNull())
        vectors = durable(vectors.withColumn(column, F.transform(column, lambda x: F.coalesce(x, F.lit(0.0)))))
        width = vectors.agg(F.max(F.size(column))).first()[0] or 0
        if not width:
            return np.zeros(0)
        count = min(BLOCK, width, BROADCAST_BYTES // (8 * width))
        if not count:
            raise ValueError(f"vectors of {width} components are too wide for one direction to be sent along")
        padded = F.concat(column, F.array_repeat(F.lit(0.0), F.lit(width) - F.size(column)))
        vectors = vectors.withColumn(column, F.when(F.size(column) < width, padded).otherwise(F.col(column)))
        basis, images = np.zeros((width, 0)), np.zeros((width, 0))
        block = independent(np.random.default_rng(0).normal(size=(width, count)), basis)
        for _ in range(passes):
            basis, images = np.hstack((basis, block)), np.hstack((images, moved(vectors, block, column)))
            small = basis.T @ images
            values, axes = np.linalg.eigh((small + small.T) / 2)
            if values[-1] <= 0:
                return np.zeros(width)
            best = basis @ axes[:, -1]
            left = np.linalg.norm(images @ axes[:, -1] - values[-1] * best) / values[-1]
            fresh = images[:, -block.shape[1] :]
            if basis.shape[1] + count > count * KEPT:
                # The strongest directions so far carry on; the next block are their own images.
                basis, images = basis @ axes[:, -2 * count :], images @ axes[:, -2 * count :]
                fresh = images[:, -count:]
            block = independent(fresh, basis)
            if left <= tolerance or not block.shape[1]:
                break
        else:
            warnings.warn(f"the leading direction has a residual of {left:.1e} after {passes} passes", stacklevel=2)
        return best / np.linalg.norm(best)

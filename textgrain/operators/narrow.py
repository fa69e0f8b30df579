"""Max-margin fits of many rows with few dense features, by Newton steps on a smoothed loss.

The problem and its certificate are those of ``hinge``.  The corner of the hinge is rounded over a
width that shrinks as the fit goes on; the slopes of the rounded losses, times ``C``, are dual
values within their bounds, so every look at the rows gives a primal and a dual value.  A look sums
the gradient and the curvature over all rows: a square of numbers as wide as the vectors per
partition, whatever the number of rows.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from textgrain.operators.hinge import GAP, SCALES

# Looks after which a fit is returned as it is.
LOOKS = 200
# The width of the rounding at first, so that all rows bend the loss of no weights, and what it is
# divided by once what is left of the slope is SHORT, as a part of what the rounding takes off the
# loss, unless that is already FINE, as a part of the gap that is wanted.
WIDTH, NARROWER, SHORT, FINE = 4.0, 4.0, 0.3, 0.5
# How far along a Newton step the rounded loss is tried.
LENGTHS = 0.6 ** np.arange(30)


def rounded(margins: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray]:
    """Losses and their slopes, between 0 and 1."""
    slope = np.clip((1.0 - margins) / width, 0.0, 1.0)
    return slope * (1.0 - margins) - 0.5 * width * slope**2, slope


def signed_rows(batch: pa.RecordBatch, size: int) -> np.ndarray:
    """The vectors and the constant 1 of the intercept, times the sign of their label."""
    sign = np.where(np.asarray(batch.column("label").cast(pa.int64())) == 1, 1.0, -1.0)
    vectors = np.asarray(batch.column("vec").flatten(), np.float64).reshape(-1, size)
    return np.column_stack((vectors, np.ones(len(sign)))) * sign[:, None]


def summed(rows: DataFrame, measure) -> np.ndarray:
    """The sum of ``measure(batch)`` over all batches; one row per partition passes through the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum(measure(batch) for batch in batches if batch.num_rows)
        if np.ndim(total):
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["numbers"])

    return sum(np.array(r["numbers"]) for r in rows.mapInArrow(run, "numbers array<double>").collect())


def look(rows: DataFrame, weights: np.ndarray, width: float) -> tuple[np.ndarray, float, float, np.ndarray, np.ndarray]:
    """Hinge losses per multiple of the weights, rounded loss, and sums of slopes, gradient and curvature."""
    size, count = len(weights), len(SCALES)

    def measure(batch: pa.RecordBatch) -> np.ndarray:
        x = signed_rows(batch, size - 1)
        margins = x @ weights
        loss, slope = rounded(margins, width)
        near = x[(slope > 0) & (slope < 1)]
        hinges = [np.maximum(0.0, 1.0 - k * margins).sum() for k in SCALES]
        return np.concatenate((hinges, [loss.sum(), slope.sum()], slope @ x, (near.T @ near).ravel()))

    hinges, loss, slopes, gradient, curvature = np.split(summed(rows, measure), np.cumsum([count, 1, 1, size]))
    return hinges, float(loss[0]), float(slopes[0]), gradient, curvature.reshape(size, size)


def along(rows: DataFrame, weights: np.ndarray, way: np.ndarray, width: float) -> np.ndarray:
    """The rounded loss at every one of ``LENGTHS``."""
    size = len(weights) - 1

    def measure(batch: pa.RecordBatch) -> np.ndarray:
        x = signed_rows(batch, size)
        margins, change = x @ weights, x @ way
        return np.array([rounded(margins + t * change, width)[0].sum() for t in LENGTHS])

    return summed(rows, measure)


def fitted_dense(rows: DataFrame, size: int, c: float, gap: float = GAP, looks: int = LOOKS) -> tuple[np.ndarray, float, float]:
    """Weights with the intercept as the last, primal and dual value, of ``(label, vec)`` rows.

    ``rows`` should be a written table: it is read some dozen times.
    """
    weights, width = np.zeros(size + 1), WIDTH
    best, primal, dual = weights, np.inf, -np.inf
    for _ in range(looks):
        hinges, loss, slopes, gradient, curvature = look(rows, weights, width)
        primals = 0.5 * (weights @ weights) * SCALES**2 + c * hinges
        if primals.min() < primal:
            primal, best = float(primals.min()), weights * SCALES[primals.argmin()]
        dual = max(dual, float(c * slopes - 0.5 * c**2 * (gradient @ gradient)))
        if primal - dual <= gap * max(primal, 1e-12):
            return best, primal, dual
        down = c * gradient - weights
        way = np.linalg.solve(np.eye(size + 1) + c / width * curvature, down)
        off = c * (hinges[0] - loss)
        if 0.5 * (down @ down) <= SHORT * off and off > FINE * gap * primals[0]:
            # The next look is at the same weights with a narrower rounding.
            width /= NARROWER
            continue
        moved = weights + LENGTHS[:, None] * way
        values = 0.5 * (moved**2).sum(1) + c * along(rows, weights, way, width)
        weights = moved[values.argmin()]
    warnings.warn(f"a dense fit has a gap above {gap} after {looks} looks", stacklevel=2)
    return best, primal, dual

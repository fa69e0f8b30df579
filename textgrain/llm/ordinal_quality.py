"""Document grades by an ordinal cumulative-link regression on hashed text.

**Model.**  Grades 0 < 1 < ... < G share one weight vector over hashed words and symbol runs;
ordered thresholds turn the score into tail probabilities
``P(grade >= g) = logistic(score - threshold_g)``.  Their sum is the expected grade, and a
tail probability decides what is kept.

**Fit.**  Limited-memory quasi-Newton steps on the penalised likelihood.  Each step is one
Spark pass that sums loss and gradient over the rows; the driver holds weights and a few
gradients of ``slots`` numbers.  The labelled rows are limited to about ``max_rows``, chosen
by a hash of the key (a documented bound of the fit only; every document is scored).

Cases: a null or empty text has no features but the shape ones and is scored like any other.
Labelled rows with a null grade or key are not used; repeated rows count each.  Grades need
not be contiguous: the thresholds separate the grades present.  With fewer than two grades in
the labels nothing is learned: tail probabilities are 1.  Empty documents give an empty
result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgrain.llm.common import LOWER_CODES, prefix_hash, span_hash, text_runs
from textgrain.session import durable

SLOTS = 1 << 17
MAX_ROWS = 20_000
FIT_PARTS = 12
# Features are made of about this many bytes at a time.
RUN_BYTES = 1 << 20
PENALTY = 2e-6
STEPS = 60
MEMORY = 8
SHAPE_BUCKETS = 16
SHAPE_WEIGHT = 0.5
# Words longer than this also count by their beginning; the counts of a row are divided by
# this power of their length, so that a few telling words still show in a long text.
STEM_BYTES = 5
DAMPING = 0.7

# Byte classes: 0 blank or control, 1 letters and digits (and all of non-ASCII), 2 symbols.
BYTE_CLASS = np.full(256, 1, np.uint8)
BYTE_CLASS[:33] = 0
BYTE_CLASS[127] = 0
for _low, _high in ((33, 48), (58, 65), (91, 97), (123, 127)):
    BYTE_CLASS[_low:_high] = 2


def features(raw: np.ndarray, offsets: np.ndarray, slots: int = SLOTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, slot, value)`` of the texts: damped counts per row, and three shape slots."""
    rows = len(offsets) - 1
    kind = BYTE_CLASS[raw]
    change = np.ones(len(raw) + 1, bool)
    if len(raw):
        change[1:-1] = kind[1:] != kind[:-1]
        change[offsets] = True
    edges = np.flatnonzero(change)
    starts, ends = edges[:-1], edges[1:]
    if len(starts):
        full = kind[starts] > 0
        starts, ends = starts[full], ends[full]
    owner = np.searchsorted(offsets, starts, side="right") - 1
    words = slots - 3 * SHAPE_BUCKETS
    sums = prefix_hash(raw, LOWER_CODES)
    whole = span_hash(sums, starts, ends)
    stems = np.flatnonzero(ends - starts > STEM_BYTES)
    stem = span_hash(sums, starts[stems], starts[stems] + STEM_BYTES) ^ np.uint64(1)
    slot = (np.concatenate((whole, stem)) % np.uint64(words)).astype(np.int64)
    keys, counts = np.unique(np.concatenate((owner, owner[stems])) * slots + slot, return_counts=True)
    row, slot = keys // slots, keys % slots
    value = 1 + np.log(counts)
    norm = np.sqrt(np.bincount(row, value * value, minlength=rows)) ** DAMPING
    value = value / norm[row]
    # Shape: shares of symbol runs, of runs that repeat the one before, of capitals among bytes.
    runs = np.bincount(owner, minlength=rows)
    symbols = np.bincount(owner, kind[starts] == 2, minlength=rows) / np.maximum(1, runs)
    capitals = np.concatenate(([0], np.cumsum((raw >= 65) & (raw <= 90))))
    capitals = (capitals[offsets[1:]] - capitals[offsets[:-1]]) / np.maximum(1, np.diff(offsets))
    again = np.flatnonzero((whole[1:] == whole[:-1]) & (owner[1:] == owner[:-1])) + 1
    repeats = np.bincount(owner[again], minlength=rows) / np.maximum(1, runs)
    every = np.arange(rows)
    shape = [words + k * SHAPE_BUCKETS + np.minimum(SHAPE_BUCKETS - 1, (share * SHAPE_BUCKETS)).astype(np.int64) for k, share in enumerate((symbols, capitals, repeats))]
    return np.concatenate((row, every, every, every)), np.concatenate((slot, *shape)), np.concatenate((value, np.full(3 * rows, SHAPE_WEIGHT)))


def logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class OrdinalModel:
    grades: list[int]
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """``P(grade >= grades[k])`` for k = 1, 2, ... as columns."""
        return logistic(scores[:, None] - self.thresholds[None])


def thresholds_of(free: np.ndarray) -> np.ndarray:
    """Ordered thresholds: the first is free, the gaps are exponentials."""
    return np.cumsum(np.concatenate((free[:1], np.exp(free[1:]))))


def loss_and_gradient(row, slot, value, level, parameters, slots) -> tuple[float, np.ndarray]:
    """Negative log-likelihood of the rows and its gradient in weights and free thresholds."""
    weights, free = parameters[:slots], parameters[slots:]
    cuts = thresholds_of(free)
    score = np.bincount(row, weights[slot] * value, minlength=len(level))
    tails = np.concatenate((np.ones((len(level), 1)), logistic(score[:, None] - cuts), np.zeros((len(level), 1))), axis=1)
    slopes = tails * (1 - tails)
    line = np.arange(len(level))
    chance = np.maximum(tails[line, level] - tails[line, level + 1], 1e-12)
    loss = -np.log(chance).sum()
    by_score = -(slopes[line, level] - slopes[line, level + 1]) / chance
    gradient = np.zeros(len(parameters))
    gradient[:slots] = np.bincount(slot, by_score[row] * value, minlength=slots)
    by_cut = np.zeros(len(cuts) + 2)
    np.add.at(by_cut, level, slopes[line, level] / chance)
    np.add.at(by_cut, level + 1, -slopes[line, level + 1] / chance)
    by_cut = by_cut[1:-1]
    later = np.cumsum(by_cut[::-1])[::-1]
    gradient[slots:] = later
    gradient[slots + 1 :] *= np.exp(free[1:])
    return float(loss), gradient


def minimise(objective: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, steps: int = STEPS, tolerance: float = 1e-5) -> np.ndarray:
    """Limited-memory quasi-Newton descent with halved steps; keeps the best point."""
    point, (value, slope) = start, objective(start)
    moves: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        direction = -slope
        used = []
        for move, turn, rho in reversed(moves):
            alpha = rho * (move @ direction)
            direction = direction - alpha * turn
            used.append(alpha)
        if moves:
            move, turn, _ = moves[-1]
            direction *= (move @ turn) / (turn @ turn)
        for (move, turn, rho), alpha in zip(moves, reversed(used)):
            direction = direction + (alpha - rho * (turn @ direction)) * move
        length = 1.0 if moves else 1.0 / max(1e-12, np.abs(slope).max())
        expected = slope @ direction
        for _ in range(12):
            trial = point + length * direction
            new_value, new_slope = objective(trial)
            if new_value <= value + 1e-4 * length * expected:
                break
            length /= 2
        else:
            return point
        move, turn = trial - point, new_slope - slope
        if move @ turn > 1e-12:
            moves = (moves + [(move, turn, 1 / (move @ turn))])[-MEMORY:]
        gain = value - new_value
        point, value, slope = trial, new_value, new_slope
        if gain <= tolerance * max(1.0, abs(value)):
            break
    return point


def unpack(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    slots, values = batch.column(0), batch.column(1)
    sizes = np.diff(np.asarray(slots.offsets))
    return np.repeat(np.arange(batch.num_rows), sizes), np.asarray(slots.flatten()), np.asarray(values.flatten()), np.asarray(batch.column(2))


def fit_ordinal(
    labelled: DataFrame, key: str, text: str, grade: str, max_rows: int = MAX_ROWS, slots: int = SLOTS, penalty: float = PENALTY
) -> OrdinalModel:
    """Fit on rows ``(key, text, grade)``; about ``max_rows`` of them, by hash of the key."""
    rows = labelled.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(grade).cast("long").alias("grade")).filter(
        F.col("key").isNotNull() & F.col("grade").isNotNull()
    )
    sizes = {r["grade"]: r["n"] for r in rows.groupBy("grade").agg(F.count(F.lit(1)).alias("n")).collect()}
    grades = sorted(sizes)
    if len(grades) < 2:
        return OrdinalModel(grades, np.zeros(slots), np.zeros(0))
    total = sum(sizes.values())
    million = 1_000_000
    kept = rows if total <= max_rows else rows.filter(F.pmod(F.xxhash64("key"), F.lit(million)) < F.lit(max_rows * million // total))
    level = F.array_position(F.array(*[F.lit(g) for g in grades]), F.col("grade")) - 1

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, raw, offsets in text_runs(batch.column(0), RUN_BYTES):
                row, slot, value = features(raw, offsets, slots)
                order = np.argsort(row, kind="stable")
                bounds = np.searchsorted(row[order], np.arange(last - first + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(column[order].astype(kind))) for column, kind in ((slot, np.int32), (value, np.float64))]
                yield pa.RecordBatch.from_arrays([*lists, batch.column(1).slice(first, last - first)], ["slot", "value", "level"])

    table = durable(
        kept.select("text", level.cast("long").alias("level")).mapInArrow(prepare, "slot array<int>, value array<double>, level bigint")
        .repartition(FIT_PARTS)
    )
    number = int(table.count())

    def objective(parameters: np.ndarray) -> tuple[float, np.ndarray]:
        shared = table.sparkSession.sparkContext.broadcast(parameters)

        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            loss, gradient = 0.0, np.zeros(len(shared.value))
            for batch in batches:
                more, slope = loss_and_gradient(*unpack(batch), shared.value, slots)
                loss, gradient = loss + more, gradient + slope
            yield pa.RecordBatch.from_arrays([pa.array([loss]), pa.array([gradient.tobytes()], pa.binary())], ["loss", "gradient"])

        loss, gradient = 0.0, np.zeros(len(parameters))
        # One row per part of the bounded sample, FIT_PARTS at most.
        for row in table.mapInArrow(part, "loss double, gradient binary").collect():
            loss += row["loss"]
            gradient += np.frombuffer(row["gradient"])
        shared.unpersist()
        weights = parameters[:slots]
        gradient /= number
        gradient[:slots] += penalty * weights
        return loss / number + 0.5 * penalty * float(weights @ weights), gradient

    share = np.cumsum([sizes[g] / total for g in grades])[:-1]
    cuts = np.log(share / (1 - share))
    free = np.concatenate((cuts[:1], np.log(np.maximum(1e-3, np.diff(cuts)))))
    fitted = minimise(objective, np.concatenate((np.zeros(slots), free)))
    return OrdinalModel(grades, fitted[:slots], thresholds_of(fitted[slots:]))


def grade_documents(docs: DataFrame, model: OrdinalModel, text: str = "text", prefix: str = "") -> DataFrame:
    """All columns of ``docs``, with ``{prefix}expected_grade`` and ``{prefix}tail``.

    ``tail`` is the probability of the best grade.  Columns of these names are replaced.
    """
    names = [f"{prefix}expected_grade", f"{prefix}tail"]
    kept = docs.drop(*names)
    # The weights have a fixed number of slots, whatever the documents.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<expected: double, tail: double>")
    def graded(texts: pa.Array) -> pa.Array:
        model = shared.value
        expected, tail = np.full(len(texts), float(max(model.grades, default=0))), np.ones(len(texts))
        if len(model.thresholds):
            gaps = np.diff(model.grades)
            for first, last, raw, offsets in text_runs(texts, RUN_BYTES):
                row, slot, value = features(raw, offsets, len(model.weights))
                tails = model.tails(np.bincount(row, model.weights[slot] * value, minlength=last - first))
                expected[first:last] = model.grades[0] + tails @ gaps
                tail[first:last] = tails[:, -1]
        return pa.StructArray.from_arrays([pa.array(expected), pa.array(tail)], ["expected", "tail"])

    column: Column = graded(F.col(text))
    return kept.withColumn("_graded", column).select(
        *kept.columns, F.col("_graded.expected").alias(names[0]), F.col("_graded.tail").alias(names[1])
    )


def quality_grade(quality: Column, toxic: Column) -> Column:
    """0 toxic, 1 of low quality, 2 good; null where neither label is known."""
    return F.when(toxic == 1, 0).when(quality == 0, 1).when(quality == 1, 2)


# A document is kept if it is good with at least this probability.
KEPT_FROM = 0.5


def fit_quality(docs: DataFrame, labels: DataFrame) -> OrdinalModel:
    """The ordinal model of the labelled documents ``(doc_id, text)`` and ``(doc_id, quality, toxic)``."""
    graded = labels.select("doc_id", quality_grade(F.col("quality"), F.col("toxic")).alias("grade"))
    return fit_ordinal(docs.select("doc_id", "text").join(graded, "doc_id"), "doc_id", "text", "grade")

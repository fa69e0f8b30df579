"""Language identification by sparse multinomial logistic regression.

**Features.**  Hashed character 1-, 2- and 3-grams of the lower-cased text: damped counts
times inverse document frequency, scaled to length 1.  Document frequencies are counted over
all training documents.

**Training.**  Follow-the-regularised-leader with per-coordinate rates and elastic-net
penalties, on a bounded sample of about ``max_rows`` training documents (by hash of the key).
The sample is dealt by hash into a fixed number of shards; every epoch each shard continues
from the common state and the states are averaged, so the result does not depend on the
number of cores.

**Calibration.**  A tenth of the sample is kept out of the descent; a temperature fitted on
it scales the scores before the softmax.

Cases: a text that is null or holds no letter is ``und`` with score 0.  Rows with a null
language do not train; a null key hashes as the empty text.  Without any training row
everything is ``und``; with one language that one is predicted with score 1.  Ties go to the
first language in order.  Repeated rows count each.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgrain.llm.common import text_runs
from textgrain.session import durable

SLOTS = 1 << 16
MAX_ROWS = 12_000
SHARDS = 6
EPOCHS = 3
# Rates and penalties of the descent.
ALPHA, BETA, LASSO, RIDGE = 1.0, 1.0, 0.05, 0.05
HELD_OUT_ONE_IN = 10
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


def gram_counts(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Slots and counts of the character 1-, 2- and 3-grams of every text."""
    for text in texts:
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        if not len(codes):
            yield np.zeros(0, np.int64), np.zeros(0, np.int64)
            continue
        one = codes * np.uint32(0x9E3779B1) + np.uint32(0x7F4A7C15)
        parts = [one]
        if len(codes) > 1:
            two = (one[:-1] ^ (one[1:] >> np.uint32(7))) * np.uint32(0x85EBCA6B) + one[1:]
            parts.append(two)
            if len(codes) > 2:
                parts.append((two[:-1] ^ (one[2:] >> np.uint32(9))) * np.uint32(0xC2B2AE35) + one[2:] * np.uint32(3))
        slots = [((p ^ (p >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(16) for p in parts]
        counts = np.bincount(np.concatenate(slots), minlength=SLOTS)
        used = np.flatnonzero(counts)
        yield used, counts[used]


def lists(texts: pa.Array) -> Iterator[list[str]]:
    texts = pc.fill_null(texts, "")
    for first, last, _, _ in text_runs(texts):
        yield texts.slice(first, last - first).to_pylist()


def weighted(slots: np.ndarray, counts: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    values = (1 + np.log(counts)) * rarity[slots]
    return values / max(1e-12, np.sqrt((values * values).sum()))


def softmax(scores: np.ndarray) -> np.ndarray:
    grown = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return grown / grown.sum(axis=-1, keepdims=True)


@dataclass
class LanguageModel:
    languages: list[str]
    rarity: np.ndarray
    weights: np.ndarray
    temperature: float

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for text, (slots, counts) in zip(texts, gram_counts(texts)):
            if not self.languages or not LETTER.search(text):
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            values = weighted(slots, counts, self.rarity)
            chance = softmax((values @ self.weights[slots] + self.weights[-1]) / self.temperature)
            best = int(chance.argmax())
            names.append(self.languages[best])
            scores.append(float(chance[best]))
        return names, scores


def document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """Rows per slot, and all rows; each task sends one row per slot at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, number = np.zeros(SLOTS, np.int64), 0
        for batch in batches:
            for texts in lists(batch.column(0)):
                number += len(texts)
                for slots, _ in gram_counts(texts):
                    seen[slots] += 1
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1).astype(np.int32)), pa.array(np.append(seen[used], number))], ["slot", "n"]
        )

    counted = rows.select("text").mapInArrow(count, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
    # SLOTS + 1 rows at most.
    table = counted.toArrow()
    slots, numbers = np.asarray(table.column("slot").combine_chunks()), np.asarray(table.column("n").combine_chunks())
    frequency = np.zeros(SLOTS, np.int64)
    frequency[slots[slots >= 0]] = numbers[slots >= 0]
    return frequency, int(numbers[slots < 0].sum())


def leader_weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Closed-form weights of the state: zero inside the lasso band, shrunk outside."""
    shrunk = np.sign(z) * LASSO - z
    return np.where(np.abs(z) <= LASSO, 0.0, shrunk / ((BETA + np.sqrt(n)) / ALPHA + RIDGE))


def descend(z: np.ndarray, n: np.ndarray, rows: pd.DataFrame) -> None:
    """One pass of the descent over the rows, in place; the last slot is the intercept."""
    for slots, values, label in zip(rows["slots"], rows["values"], rows["label"]):
        at = np.append(slots, len(z) - 1)
        x = np.append(values, 1.0)
        zs, ns = z[at], n[at]
        weights = leader_weights(zs, ns)
        slope = softmax(x @ weights)
        slope[label] -= 1
        gradient = x[:, None] * slope
        grown = ns + gradient * gradient
        z[at] = zs + gradient - (np.sqrt(grown) - np.sqrt(ns)) / ALPHA * weights
        n[at] = grown


def train_language(rows: DataFrame, max_rows: int = MAX_ROWS) -> LanguageModel:
    """The model of rows ``(key, text, lang)``."""
    rows = rows.filter(F.col("lang").isNotNull()).withColumn("key", F.coalesce(F.col("key").cast("string"), F.lit("")))
    # One row per language.
    languages = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    frequency, number = document_frequencies(rows)
    rarity = np.log((1 + number) / (1 + frequency)) + 1
    if len(languages) < 2:
        return LanguageModel(languages, rarity, np.zeros((SLOTS + 1, len(languages))), 1.0)
    million = 1_000_000
    place = F.pmod(F.xxhash64("key", "text"), F.lit(million))
    sample = rows if number <= max_rows else rows.filter(place < F.lit(max_rows * million // number))
    labels = {name: i for i, name in enumerate(languages)}

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in lists(batch.column(0)):
                made = [(s.astype(np.int32), weighted(s, c, rarity)) for s, c in gram_counts(texts)]
                names = batch.column(1).slice(done, len(texts)).to_pylist()
                columns = [pa.array([s for s, _ in made], pa.list_(pa.int32())), pa.array([v for _, v in made], pa.list_(pa.float64())), pa.array([labels[x] for x in names], pa.int32())]
                yield pa.RecordBatch.from_arrays([*columns, batch.column(2).slice(done, len(texts))], ["slots", "values", "label", "order"])
                done += len(texts)

    order = F.xxhash64(F.lit("order"), "key", "text")
    table = durable(sample.select("text", "lang", order.alias("order")).mapInArrow(prepare, "slots array<int>, values array<double>, label int, order bigint"))
    table = table.withColumn("part", F.pmod(F.col("order"), F.lit(HELD_OUT_ONE_IN))).withColumn("shard", F.pmod(F.shiftright("order", 8), F.lit(SHARDS)))
    fitted = durable(table.filter(F.col("part") > 0).repartition(SHARDS, "shard"))
    shape = (SLOTS + 1, len(languages))
    z, n = np.zeros(shape), np.zeros(shape)
    context = rows.sparkSession.sparkContext
    for _ in range(EPOCHS):
        shared = context.broadcast((z, n))

        def epoch(part: pd.DataFrame) -> pd.DataFrame:
            z, n = (array.copy() for array in shared.value)
            before = z.copy(), n.copy()
            descend(z, n, part.sort_values("order", kind="stable"))
            used = np.flatnonzero((z != before[0]).any(1) | (n != before[1]).any(1))
            return pd.DataFrame({"slots": [used.astype(np.int32).tobytes()], "z": [(z - before[0])[used].tobytes()], "n": [(n - before[1])[used].tobytes()]})

        # One row per shard, of SLOTS times the languages at most.
        moves = fitted.groupBy("shard").applyInPandas(epoch, "slots binary, z binary, n binary").collect()
        shared.unpersist()
        for move in moves:
            used = np.frombuffer(move["slots"], np.int32)
            z[used] += np.frombuffer(move["z"]).reshape(len(used), -1) / len(moves)
            n[used] += np.frombuffer(move["n"]).reshape(len(used), -1) / len(moves)
    weights = leader_weights(z, n)
    return LanguageModel(languages, rarity, weights, temperature_of(table.filter(F.col("part") == 0), weights))


def temperature_of(rows: DataFrame, weights: np.ndarray) -> float:
    """The temperature with the least log-loss on rows that took no part in the descent."""
    grid = np.exp(np.linspace(np.log(0.02), np.log(20), 141))
    width = weights.shape[1]

    def losses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(grid))
        for batch in batches:
            for slots, values, label in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist()):
                scores = (np.asarray(values.values) @ weights[np.asarray(slots.values)] if len(slots) else np.zeros(width)) + weights[-1]
                total -= np.log(np.maximum(softmax(scores[None] / grid[:, None])[:, label], 1e-300))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(grid))), pa.array(total)], ["point", "loss"])

    found = rows.select("slots", "values", "label").mapInArrow(losses, "point bigint, loss double").groupBy("point").agg(F.sum("loss").alias("loss"))
    best = found.orderBy("loss", "point").first()
    return float(grid[best["point"]]) if best and best["loss"] > 0 else 1.0


def held_out(key: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def identify_languages(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, held_out, lang_pred, score)`` of every row."""
    # Weights of SLOTS times the languages, whatever the documents.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names: list[str] = []
            scores: list[float] = []
            for texts in lists(batch.column(2)):
                found = shared.value.predict(texts)
                names += found[0]
                scores += found[1]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["key", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(key).alias("key"), held_out(F.col(key)).alias("held_out"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(predict, f"key {kind}, held_out boolean, lang_pred string, score double").withColumnRenamed("key", key)


def fit_languages(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> LanguageModel:
    """Train on the rows that are not held out."""
    rows = docs.filter(~held_out(F.col(key))).select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    return train_language(rows)

"""Numeric features: column agreement, coercion, label codes, scaling, profiles."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import ElementwiseProduct, IndexToString, StringIndexer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgrain.functions.text import sentences, word_runs

# Fixed value: columns of a profile table that are never features.
NOT_FEATURES = ("filename", "text", "label")


def common_features(*tables: DataFrame, exclude: Sequence[str] = NOT_FEATURES) -> list[str]:
    """Sorted names present in every table."""
    shared = set(tables[0].columns)
    for table in tables[1:]:
        shared &= set(table.columns)
    return sorted(shared - set(exclude))


def as_number(column: Column | str) -> Column:
    """A double; what is not a number, NaN included, becomes 0."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.nanvl(column.try_cast("double"), F.lit(0.0)), F.lit(0.0))


def coerce_numeric(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.withColumns({name: as_number(f"`{name}`") for name in features})


def repair_key(df: DataFrame, wrong: str = "ilename", right: str = "filename") -> DataFrame:
    """Undo the loss of the first letter of the key column's name."""
    if wrong in df.columns and right not in df.columns:
        return df.withColumnRenamed(wrong, right)
    return df


def remap_labels(profile: DataFrame, mapping: DataFrame) -> DataFrame:
    """Attach ``label`` by ``filename``; a label column that is already there is replaced."""
    return repair_key(profile).drop("label").join(mapping.select("filename", "label"), "filename", "left")


def label_codes(train: DataFrame, column: str = "label", output: str = "code") -> tuple:
    """Fitted encoder (sorted classes to 0..k-1) and its inverse."""
    text = train.select(F.col(column).cast("string").alias(column))
    encoder = StringIndexer(inputCol=column, outputCol=output, stringOrderType="alphabetAsc").fit(text)
    decoder = IndexToString(inputCol=output, outputCol=f"{output}_label", labels=encoder.labels)
    return encoder, decoder


def surface_profile(docs: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Length and variety measures of every text: no shuffle, one pass.

    A row is worked out on its own, so the size of a source or language does not matter.
    """
    parts = docs.select(
        "doc_id",
        *keep,
        F.size(sentences("text")).alias("n_sentences"),
        word_runs("text").alias("_tokens"),
    )
    letters = F.aggregate("_tokens", F.lit(0), lambda acc, t: acc + F.char_length(t))
    n = F.size("_tokens")
    counted = parts.select(
        "doc_id",
        *keep,
        "n_sentences",
        n.alias("n_tokens"),
        F.size(F.array_distinct("_tokens")).alias("n_types"),
        letters.alias("_letters"),
    )

    def per(top: str, bottom: str) -> Column:
        return F.when(F.col(bottom) == 0, F.lit(0.0)).otherwise(F.col(top) / F.col(bottom))

    return counted.select(
        "doc_id",
        *keep,
        "n_sentences",
        "n_tokens",
        "n_types",
        per("n_tokens", "n_sentences").alias("tokens_per_sentence"),
        per("_letters", "n_tokens").alias("chars_per_token"),
        per("n_types", "n_tokens").alias("type_token_ratio"),
    )


# Numeric columns of the surface profile.
SURFACE_FEATURES = (
    "n_sentences",
    "n_tokens",
    "n_types",
    "tokens_per_sentence",
    "chars_per_token",
    "type_token_ratio",
)


def pos_shares(processed: DataFrame) -> DataFrame:
    """``(doc_id, pos, share)`` of the tagged tokens of every document."""
    tags = processed.select("doc_id", F.size("pos").alias("n"), F.explode_outer("pos").alias("pos"))
    tags = tags.filter(F.col("pos").isNotNull())
    return tags.groupBy("doc_id", "n", "pos").agg(F.count(F.lit(1)).alias("cnt")).select(
        "doc_id", "pos", (F.col("cnt") / F.col("n")).alias("share")
    )


def population_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: mean and population deviation of every column, in one aggregation."""
    moments = []
    for name in columns:
        moments += [F.avg(name).alias(f"{name}_mean"), F.stddev_pop(name).alias(f"{name}_std")]
    return df.agg(*moments)


@dataclass(frozen=True)
class Scaler:
    """Affine scaling learned on training rows; a constant component keeps scale 1."""

    mean: tuple[float, ...]
    std: tuple[float, ...]

    def centred(self, vector: Column | str) -> Column:
        """``(x - mean) / std`` on an ``array<double>`` column."""
        vector = F.col(vector) if isinstance(vector, str) else vector
        centre = F.array(*[F.lit(x) for x in self.mean])
        shrink = F.array(*[F.lit(1.0 / s) for s in self.std])
        return F.zip_with(F.zip_with(vector, centre, lambda x, m: x - m), shrink, lambda x, s: x * s)

    def scale_only(self, input_col: str, output_col: str) -> ElementwiseProduct:
        """``x / std`` on an ml vector column: sparse vectors stay sparse."""
        weights = Vectors.dense(1.0 / np.asarray(self.std))
        return ElementwiseProduct(scalingVec=weights, inputCol=input_col, outputCol=output_col)


# A feature whose deviation is below this part of its mean is constant but for rounding.
CONSTANT = 1e-12


def fit_scaler(train: DataFrame, column: str = "vec") -> Scaler:
    """Mean and population deviation of an array or ml vector column, summed on the executors."""
    is_array = train.schema[column].dataType.typeName() == "array"
    vector = array_to_vector(F.col(column).cast("array<double>")) if is_array else F.col(column)
    stats = train.agg(Summarizer.metrics("mean", "std", "count").summary(vector).alias("m")).first()["m"]
    n = stats["count"]
    # The summariser divides by n - 1.
    std = stats["std"].toArray() * np.sqrt((n - 1) / n) if n > 1 else np.zeros(stats["mean"].size)
    std = np.where(std > CONSTANT * np.abs(stats["mean"].toArray()), std, 1.0)
    return Scaler(tuple(map(float, stats["mean"].toArray())), tuple(map(float, std)))


def sparse_deviations(counts: DataFrame, documents: int | Column) -> DataFrame:
    """``(feature, std)`` over all documents of long ``(feature, freq)`` rows.

    Absent features are zeros, so the deviation follows from the present values alone:
    no vector and no vocabulary are built, and the grouping combines on the map side.
    """
    n = F.lit(documents) if isinstance(documents, int) else documents
    grouped = counts.groupBy("feature").agg(
        F.count(F.lit(1)).alias("k"), F.avg("freq").alias("m"), F.var_pop("freq").alias("v")
    )
    k, m, v = F.col("k"), F.col("m"), F.col("v")
    spread = F.sqrt((k * v + k * (n - k) / n * m * m) / n)
    return grouped.select("feature", F.when(spread <= CONSTANT * F.abs(k * m / n), F.lit(1.0)).otherwise(spread).alias("std"))

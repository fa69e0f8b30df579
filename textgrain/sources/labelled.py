"""Readers for labelled texts, feature matrices and profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgrain.functions.text import NULL_POLICIES


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fail before any job runs when columns are missing."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def _csv(spark: SparkSession, header: bool):
    # Texts contain line breaks and doubled quotes; fields have no length limit.
    return (
        spark.read.option("header", header)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("maxCharsPerColumn", -1)
    )


def read_labelled(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header that has at least ``text`` and ``label``; all columns strings.

    A quoted multi-line CSV cannot be split, so convert it once with ``write_table`` and
    read the Parquet copy from then on.
    """
    return require_columns(_csv(spark, True).csv(path), ["text", "label"])


def read_positional(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """First column is the text, second the label, whatever they are called."""
    raw = _csv(spark, header).csv(path)
    first, second = raw.columns[:2]
    return raw.select(F.col(f"`{first}`").alias("text"), F.col(f"`{second}`").alias("label"))


def read_trimmed(spark: SparkSession, path: str) -> DataFrame:
    """Header names stripped of blanks, incomplete rows dropped, label an int."""
    raw = _csv(spark, True).option("ignoreLeadingWhiteSpace", False).csv(path)
    named = require_columns(raw.toDF(*[c.strip() for c in raw.columns]), ["text", "label"])
    return trimmed(named)


def trimmed(df: DataFrame) -> DataFrame:
    return df.select("text", "label").dropna().withColumn("label", F.col("label").cast("int"))


def with_null_policy(df: DataFrame, policy: str = "drop", column: str = "text") -> DataFrame:
    """What to do with null texts: ``drop`` the row, or a policy of ``null_text``."""
    from textgrain.functions.text import null_text

    if policy == "drop":
        return df.filter(F.col(column).isNotNull())
    if policy not in NULL_POLICIES:
        raise ValueError(f"unknown null policy {policy!r}")
    return df.withColumn(column, null_text(column, policy))


def features_and_label(
    df: DataFrame, exclude: Sequence[str] = (), label: str = "label"
) -> tuple[list[str], DataFrame]:
    """Feature names in column order, and the rows with one ``vec`` array and the label."""
    require_columns(df, [label])
    names = [c for c in df.columns if c != label and c not in exclude]
    vec = F.array(*[F.col(f"`{c}`").cast("double") for c in names])
    return names, df.select(*exclude, vec.alias("vec"), F.col(label).cast("int").alias(label))


def select_columns(df: DataFrame, columns: Sequence[str], label: str = "label") -> DataFrame:
    """Only the wanted columns and the label; a Parquet scan then reads nothing else."""
    require_columns(df, [*columns, label])
    return df.select(*columns, F.col(label).cast("int").alias(label))


def encoder_inputs(df: DataFrame, ids: str = "input_ids", mask: str = "attention_mask") -> DataFrame:
    """Model input columns, with the label under the name trainers expect."""
    return df.withColumnRenamed("label", "labels").select(ids, mask, "labels")

"""Writers for tables, wide matrices, document exports and label mappings."""

from __future__ import annotations

from pyspark.ml.base import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgrain.functions.text import document_key, one_sentence_per_line

def column_meaning(name: str) -> str | None:
    """What a column of this engine's cross-validation table holds."""
    measures = {"accuracy": "share of held-out rows put into their class", "f1_macro": "unweighted mean of both classes' F1 on held-out rows", "roc_auc": "area under the held-out ROC curve, ties counted half"}
    plain = {
        "model_id": "model_ and the place of (feature set, C) in the grid, from 1",
        "classifier": "kind of model fitted",
        "representation": "name of the feature set",
        "columns": "n-gram families that make up the feature set",
        "C": "weight of the summed hinge loss against half the squared length of the weights",
    }
    for measure, text in measures.items():
        part = name.removeprefix(f"{measure}_")
        if part == "mean":
            return f"{text}; mean over the held-out folds"
        if part == "std":
            return f"{text}; population deviation over the held-out folds"
        if part.startswith("fold_"):
            return f"{text}; held-out fold {part.removeprefix('fold_')}"
    return plain.get(name)


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Parquet, or CSV with a header for interchange."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    else:
        writer.format(fmt).save(path)


def write_result(df: DataFrame, path: str) -> None:
    """A small result table (metrics, losses, top lists) as one CSV file."""
    write_table(df.coalesce(1), path, "csv")


def wide_matrix(df: DataFrame, width: int, prefix: str = "emb", label: str = "label") -> DataFrame:
    """One column per vector component, ``emb_0 ..`` or ``f_0 ..``, then the label."""
    columns = [F.get("vec", i).alias(f"{prefix}_{i}") for i in range(width)]
    return df.select(*columns, label)


def document_export(docs: DataFrame, number: str = "doc_id") -> DataFrame:
    """``(split, filename, text)`` with one sentence per line."""
    return docs.select(
        "split",
        document_key("split", number).alias("filename"),
        one_sentence_per_line("text").alias("text"),
    )


def write_documents(docs: DataFrame, path: str, number: str = "doc_id") -> None:
    document_export(docs, number).write.mode("overwrite").partitionBy("split").parquet(path)


def label_mapping(docs: DataFrame, number: str = "doc_id") -> DataFrame:
    return docs.select(document_key("split", number).alias("filename"), "label")


def with_legend(df: DataFrame) -> DataFrame:
    """Attach the meaning of each known column as its comment."""
    for name in df.columns:
        meaning = column_meaning(name)
        if meaning is not None:
            df = df.withMetadata(name, {"comment": meaning})
    return df


def save_model(model: Model, path: str) -> None:
    model.write().overwrite().save(path)

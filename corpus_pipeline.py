"""The corpus pipeline: quality, near duplicates, repeated passages, benchmark leaks, tokens.

Every stage takes ``(spark, docs, sf_dir)`` and works on all documents that the one before
kept.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgrain.llm.chosen_path import near_components
from textgrain.llm.common import read_table
from textgrain.llm.ordinal_quality import KEPT_FROM, fit_quality, grade_documents
from textgrain.llm.piece_encoding import encode_texts
from textgrain.llm.string_tiling import contamination
from textgrain.llm.suffix_buckets import without_repeats
from textgrain.session import durable


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are good with a probability of one half at least; the others go.

    The model is fitted on the labelled ones among ``docs``; a document without text is graded
    like any other.
    """
    labels = read_table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    model = fit_quality(docs, labels)
    return grade_documents(docs, model, prefix="__quality_").filter(F.col("__quality_tail") >= KEPT_FROM).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, 0.8) the smallest id; repeated rows once."""
    kept = near_components(docs, size=5).filter("kept").select(F.col("doc_id").alias("__kept_id")).distinct()
    left = docs.join(kept, F.col("doc_id").eqNullSafe(F.col("__kept_id")), "left_semi")
    return left.dropDuplicates(["doc_id", "text"]).select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts without the bytes of strings of 200 bytes that occur elsewhere; all documents stay."""
    cleaned = without_repeats(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cleaned


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not cover half of a benchmark item."""
    found = contamination(docs, read_table(spark, sf_dir, "benchmark", "item_id", "text"))
    leaks = found.filter("contaminated").select(F.col("doc_id").alias("__leak_id")).distinct()
    return docs.join(leaks, F.col("doc_id").eqNullSafe(F.col("__leak_id")), "left_anti").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, ids)`` of what is left."""
    return encode_texts(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality", quality),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("benchmark leaks", benchmark_leaks),
    ("tokens", tokens),
]

# A fitted model decides in the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``, each on the written rows of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = durable(docs)
    return docs

"""The labelled corpus, splits and word vectors as built from the raw tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textgrain.functions.text import word_runs
from textgrain.operators.ordering import sorted_positions
from textgrain.session import durable


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "text")


def split_of(number: Column | str = "doc_id") -> Column:
    """Half of the documents train, a quarter validate, a quarter test."""
    number = F.col(number) if isinstance(number, str) else number
    part = F.pmod(number, F.lit(4))
    return F.when(part < 2, "train").when(part == 2, "validation").otherwise("test")


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, text, label, split)`` of the labelled documents."""
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    return documents(spark, folder).join(labels, "doc_id").withColumn("split", split_of())


def ranked_word_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """``(token, vec)``: the word of frequency rank r takes embedding row r - 1."""
    words = (
        documents(spark, folder)
        .select(F.explode(word_runs("text")).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    ranked = sorted_positions(words, F.col("cnt").desc(), F.col("token").asc(), name="rank")
    vectors = table(spark, folder, "embeddings").select(
        (F.col("vec_id") + 1).alias("rank"), F.col("embedding").alias("vec")
    )
    return durable(ranked.join(vectors, "rank").select("token", "vec"))


EMBEDDING_WIDTH = 64

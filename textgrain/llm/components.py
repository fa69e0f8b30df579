"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgrain.session import durable, scratch


def large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node around it."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.filter(F.col("a") != F.col("b")).unionByName(least.withColumnRenamed("m", "b"))


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` of every node of the links ``(a, b)`` that is not its component's smallest.

    The links of a round are a written table; a node with any number of links is only ever
    aggregated before a shuffle, and joined by a join that can be split.
    """
    links = durable(
        links.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    while not links.isEmpty():
        with scratch() as tables:
            links = tables.keep(durable(small_star(durable(large_star(links).distinct())).distinct()))
        # Finished when every node has one link, to a node that has none.
        doubled = links.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
        chained = links.join(links.select(F.col("a").alias("b")).distinct(), "b", "left_semi")
        if doubled.isEmpty() and chained.isEmpty():
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))

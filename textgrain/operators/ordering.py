"""Positions and running totals over a whole table without a one-task window.

The rows are split into ordered buckets; each bucket is summed, the small table of bucket
sums is accumulated, and every row adds its bucket's offset to a window that never leaves
the bucket.  Only the table of bucket sums (one row per bucket and group) is ever handled
by a single task.

Two ways to get ordered buckets:

* ``range_buckets``: any sort key.  Range partitioning samples the key, so the buckets are
  even whatever its distribution; the layout is made durable before it is used.
* ``hash_bucket``: the sort key is a uniform hex digest, so its leading digits already
  are even, ordered buckets; nothing has to be sampled or written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textgrain.session import durable

BUCKET = "_bucket"
# Bytes of text in a part whose n-grams are counted.
PLACED_BYTES = 4 << 20


def by_document(df: DataFrame, key: str = "doc_id", size: Column | None = None, most: int = PLACED_BYTES) -> DataFrame:
    """Place the rows of a document together, in ``spark.sql.shuffle.partitions`` parts or more.

    The number is given explicitly so that adaptive execution leaves it alone: it would
    merge parts by the bytes of the texts, which the following explode multiplies.  With
    ``size``, the bytes of a row, there are so many parts that one holds about ``most`` bytes at
    most: what a task counts then does not grow with the table.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if size is not None:
        parts = max(parts, int(df.agg(F.sum(size)).first()[0] or 0) // most + 1)
    return df.repartition(parts, key)


def seeded_key(seed: int, *ids: Column | str) -> Column:
    """A uniform, reproducible 32-digit sort key for a row id."""
    parts = [F.lit(str(seed))] + [(F.col(i) if isinstance(i, str) else i).cast("string") for i in ids]
    return F.md5(F.concat_ws("-", *parts))


def hash_bucket(key: Column | str, digits: int = 3) -> Column:
    """Ordered bucket of a hex digest: 16 ** ``digits`` even buckets."""
    return F.substring(key, 1, digits)


def range_buckets(df: DataFrame, *keys: Column) -> DataFrame:
    """Add ``_bucket``: rows of a lower bucket sort before rows of a higher one."""
    ranged = df.repartitionByRange(*keys).withColumn(BUCKET, F.spark_partition_id())
    return durable(ranged)


def with_running_totals(
    df: DataFrame,
    order: Sequence[Column],
    totals: dict[str, Column],
    within: Sequence[str] = (),
    bucket: str = BUCKET,
) -> DataFrame:
    """Add, per entry of ``totals``, its inclusive running sum in ``order``.

    ``within`` names grouping columns; a group may hold any share of the table because
    its buckets are handled by different tasks.
    """
    within = list(within)
    inner = Window.partitionBy(*within, bucket).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    outer = Window.partitionBy(*within).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(*within, bucket).agg(
        *[F.sum(value).alias(f"_sum_{name}") for name, value in totals.items()]
    )
    offsets = sums.select(
        *within,
        bucket,
        *[
            F.coalesce(F.sum(f"_sum_{name}").over(outer), F.lit(0)).alias(f"_off_{name}")
            for name in totals
        ],
    )
    local = df.select("*", *[F.sum(value).over(inner).alias(name) for name, value in totals.items()])
    # One row per bucket and group, so the broadcast side does not grow with the rows.
    joined = local.join(F.broadcast(offsets), [*within, bucket])
    return joined.select(
        *df.columns, *[(F.col(name) + F.col(f"_off_{name}")).alias(name) for name in totals]
    )


def sorted_positions(df: DataFrame, *keys: Column, name: str = "position") -> DataFrame:
    """Add the 1-based position of every row in the order of ``keys``."""
    placed = range_buckets(df, *keys)
    return with_running_totals(placed, keys, {name: F.lit(1)}).drop(BUCKET)


def shuffled_positions(
    df: DataFrame, row_id: str, seed: int = 42, within: Sequence[str] = (), name: str = "position"
) -> DataFrame:
    """Add the 1-based position of every row in a seeded random order, per group."""
    keyed = df.withColumn("_key", seeded_key(seed, row_id))
    keyed = keyed.withColumn(BUCKET, hash_bucket("_key"))
    ranked = with_running_totals(keyed, [F.col("_key"), F.col(row_id)], {name: F.lit(1)}, within)
    return ranked.drop("_key", BUCKET)

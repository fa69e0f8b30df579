"""Equi-joins of many rows against a keyed table, safe against hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds more than one row in this many.  Fewer than this many keys
# can be hot at once, whatever the data: that bounds the broadcast table of hot keys.
HOT_ONE_IN = 500
# A table is broadcast only when it was measured to be smaller than this.
BROADCAST_BYTES = 64 << 20


def measured_bytes(table: DataFrame, key: str, row_bytes: int) -> int:
    """Size of the table: its key bytes plus ``row_bytes`` for the rest of every row."""
    size = table.agg(
        (F.coalesce(F.sum(F.octet_length(F.col(key).cast("string"))), F.lit(0)) + F.count(F.lit(1)) * row_bytes)
    )
    return int(size.first()[0])


def hot_keys(rows: DataFrame, key: str, one_in: int = HOT_ONE_IN) -> DataFrame:
    """``(key, _salts)`` for the keys that hold more than one in ``one_in`` of the rows.

    ``_salts`` grows with the key's share, so that every salted piece is at most about
    one in ``one_in`` of the rows.
    """
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_size"))
    everything = sizes.agg(F.sum("_size")).scalar()
    return sizes.select(
        key, F.ceil(F.col("_size") * F.lit(one_in) / everything).cast("int").alias("_salts")
    ).filter((F.col("_salts") > 1) & F.col(key).isNotNull())


def keyed_lookup(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    spread: str,
    how: str = "inner",
    row_bytes: int = 128,
    limit: int = BROADCAST_BYTES,
    one_in: int = HOT_ONE_IN,
) -> DataFrame:
    """Join ``rows`` with ``table``, whose ``key`` is unique.

    The table is measured first.  A small one is broadcast: ``rows`` are not moved and
    keep their partitioning.  A larger one is joined by shuffling both sides, with the
    rows of a hot key split by a hash of ``spread`` over several salts and just that
    key's table row repeated once per salt.
    """
    if measured_bytes(table, key, row_bytes) <= limit:
        return rows.join(F.broadcast(table), key, how)
    found = shuffled_lookup(rows.filter(F.col(key).isNotNull()), table, key, spread, how, one_in)
    if how == "inner":
        return found
    # Null keys find nothing and can be any number: they do not take part in the shuffle.
    return found.unionByName(rows.filter(F.col(key).isNull()), allowMissingColumns=True)


def shuffled_lookup(rows: DataFrame, table: DataFrame, key: str, spread: str, how: str, one_in: int = HOT_ONE_IN) -> DataFrame:
    """The join with both sides moved and the rows of hot keys salted."""
    hot = F.broadcast(hot_keys(rows, key, one_in))
    salted = rows.join(hot, key, "left").withColumn(
        "_salt", F.coalesce(F.pmod(F.xxhash64(spread), F.col("_salts")), F.lit(0)).cast("int")
    )
    repeated = table.join(hot, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
    )
    joined = salted.drop("_salts").join(repeated.drop("_salts"), [key, "_salt"], how)
    return joined.drop("_salt")

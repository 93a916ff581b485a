"""Uniqueness: duplicate elimination and insert-if-absent."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmart.schemas import ORDER_COLUMNS

# Up to this many keys (36-character ids: about 100 MB as a hash relation) are
# broadcast to the scan of the existing table; more are joined by shuffle.
BROADCAST_KEYS = 500_000
# Up to this many new keys per shuffle partition are held as a hash table (some
# 200 MB); beyond it the join is left to Spark's sort-merge join, which spills.
HASH_KEYS_PER_PARTITION = 2_000_000


def dedup_first_wins(
    df: DataFrame, keys: list[str] | None = None, order: list[str] | None = None
) -> DataFrame:
    """One row per key, the first in arrival order.

    ``row_number() = 1`` is planned with a group limit in front of the exchange, so
    every task keeps one row per key before the shuffle: a key that holds a third
    of all rows reaches its reducer as one row per map task.
    """
    keys = keys or ["event_id"]
    order = order or ORDER_COLUMNS
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).where(F.col("__rank") == 1).drop("__rank")


def absent_rows(
    new: DataFrame,
    existing: DataFrame,
    key: str = "event_id",
    keys: DataFrame | None = None,
    key_count: int | None = None,
) -> DataFrame:
    """Rows of ``new`` (unique on ``key``) whose key is not in ``existing``.

    Only the key column of ``existing`` is read. The keys both sides share are found
    first by streaming ``existing`` past a hash table of the new keys, so the large
    side is never sorted, and not shuffled either when it is bucketed on the key or
    when the new keys are few. The anti-join then meets only the shared keys.

    ``keys`` may name a cheaper source of the new keys than ``new`` itself (a
    superset is fine); ``key_count`` is an upper bound of their number when the
    caller knows one, and decides between broadcast, hash and sort-merge join.
    """
    side = (new if keys is None else keys).select(key).distinct()
    few = key_count is not None and key_count <= BROADCAST_KEYS
    partitions = int(new.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if few:
        side = F.broadcast(side)
    elif key_count is not None and key_count <= HASH_KEYS_PER_PARTITION * partitions:
        side = side.hint("shuffle_hash")
    shared = existing.select(key).join(side, key, "left_semi")
    return new.join(F.broadcast(shared) if few else shared, key, "left_anti")


def duplicate_keys(df: DataFrame, key: str = "event_id") -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)

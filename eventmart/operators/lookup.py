"""Joins against dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart import schemas
from eventmart.functions import casts

# A dimension is broadcast only when it was counted and is at most this long
# (two narrow columns, so well below 100 MB).
BROADCAST_ROWS = 1_000_000


def seed_dim(spark: SparkSession, rows: list[tuple[int, str]]) -> DataFrame:
    """A fixed dimension (five rows at most) as SQL literals, so its size is known to the planner."""
    values = ", ".join(f"({i}S, '{name}')" for i, name in rows)
    return spark.sql(f"SELECT id, name FROM VALUES {values} AS seeds(id, name)")


def event_types(spark: SparkSession) -> DataFrame:
    return seed_dim(spark, schemas.EVENT_TYPE_SEEDS)


def payment_methods(spark: SparkSession) -> DataFrame:
    return seed_dim(spark, schemas.PAYMENT_METHOD_SEEDS)


def vendors(spark: SparkSession) -> DataFrame:
    return seed_dim(spark, schemas.VENDOR_SEEDS)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` when its counted size allows it.

    Beyond the limit the join is left to AQE, which picks a shuffled join and
    splits skewed partitions. The count stops at the limit.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def resolve_name(df: DataFrame, text: Column, dim: DataFrame, id_column: str) -> DataFrame:
    """LEFT JOIN a name dimension (unique names) on the normalised text, adding its id.

    Whether ``dim`` is broadcast is the caller's choice, see ``name_dim``.
    """
    d = dim.select(F.col("id").alias(id_column), F.col("name").alias(f"__{id_column}_name"))
    key = f"__{id_column}_name"
    return df.join(d, casts.batch_name(text) == d[key], "left").drop(key)


def name_dim(stored: DataFrame | None, seeds: DataFrame) -> DataFrame:
    """The stored dimension, broadcast if it was counted and is small, or else its seeds."""
    return F.broadcast(seeds) if stored is None else broadcast_if_small(stored)


def fk_lookup(raw: DataFrame, types: DataFrame | None = None, methods: DataFrame | None = None) -> DataFrame:
    """Resolve event_type and payment_method of raw rows to ids of the stored dimensions (default: their seeds)."""
    spark = raw.sparkSession
    out = resolve_name(raw, F.col("event_type"), name_dim(types, event_types(spark)), "event_type_id")
    return resolve_name(out, F.col("payment_method"), name_dim(methods, payment_methods(spark)), "payment_method_id")


def unknown_keys(keys: DataFrame, key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Distinct non-NULL keys absent from ``dim``, with the number of rows behind each.

    Rows are counted per key before the anti-join, so the join sees each key once
    and a key that holds most of the rows costs no more than any other.
    """
    counted = keys.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.join(dim.select(F.col(dim_key).alias(key)), key, "left_anti")

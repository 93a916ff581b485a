"""Growing dimensions: members are discovered in the data and only ever added."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.functions import casts


def insert_if_absent(existing: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """The candidate members (unique on ``key``) that ``existing`` does not hold yet."""
    return candidates.join(existing.select(key), key, "left_anti")


def zone_candidates(raw: DataFrame) -> DataFrame:
    """One row per zone number written in digits; names are filled in later."""
    text = F.col("zone_id")
    return (
        raw.where(casts.is_digits(text))
        .select(casts.batch_int(text).alias("zone_id"))
        .where(F.col("zone_id").isNotNull())
        .distinct()
        .withColumn("zone_name", F.lit(None).cast("string"))
    )


def dim_zone_discover(raw: DataFrame, dim_zone: DataFrame) -> DataFrame:
    """Zones of ``raw`` to be added to ``dim_zone``."""
    return insert_if_absent(dim_zone, zone_candidates(raw), "zone_id")


def vendor_candidates(raw: DataFrame) -> DataFrame:
    """One row per vendor number written in digits, named after its text.

    '1' and '01' are the same vendor; the lowest of the names is kept. The minimum
    is combined on the map side, so a vendor on most of the rows costs nothing extra.
    """
    text = F.col("vendor_id")
    return (
        raw.where(casts.is_digits(text))
        .select(casts.batch_smallint(text).alias("id"), F.concat(F.lit("Vendor "), text).alias("name"))
        .where(F.col("id").isNotNull())
        .distinct()
        .groupBy("id")
        .agg(F.min("name").alias("name"))
    )


def dim_vendor_register(raw: DataFrame, dim_vendor: DataFrame) -> DataFrame:
    """Vendors of ``raw`` to be added to ``dim_vendor``; known vendors keep their name."""
    return insert_if_absent(dim_vendor, vendor_candidates(raw), "id")


def zone_enrich(dim_zone: DataFrame, names: DataFrame) -> DataFrame:
    """``dim_zone`` with names taken from a reference list (zone_id, zone_name).

    A name in the list replaces the present one; zones outside the list keep theirs.
    The list may repeat a zone: its lowest name is used.
    """
    lookup = names.groupBy("zone_id").agg(F.min("zone_name").alias("__new_name"))
    return dim_zone.join(lookup, "zone_id", "left").select(
        "zone_id", F.coalesce("__new_name", "zone_name").alias("zone_name")
    )


def seed_usage(raw_names: DataFrame, column: str, seeds: DataFrame) -> DataFrame:
    """Every seeded member with the number of raw rows that name it (0 when none does).

    Rows are counted per spelling before they are normalised and joined.
    """
    spelled = raw_names.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    named = spelled.groupBy(casts.batch_name(F.col(column)).alias("name")).agg(F.sum("n").alias("n"))
    return seeds.join(named, "name", "left").select(
        "id", "name", F.coalesce("n", F.lit(0)).cast("long").alias("row_count")
    )

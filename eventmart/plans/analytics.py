"""The analytical queries and downstream models over the fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.operators import lookup
from eventmart.operators.access import month_of


def money(total: Column) -> Column:
    return F.round(total, 2)


def mean(c: str, scale: int = 2) -> Column:
    """Average rounded once: avg() of a decimal would round to six digits first."""
    return F.round(F.sum(c) / F.count(c), scale)


def mean_minutes(seconds: str) -> Column:
    return F.round(F.sum(seconds).cast("decimal(20,0)") / F.count(seconds) / 60, 1)


def month_column(fact: DataFrame) -> Column:
    """The stored month where the table is partitioned by it, else derived."""
    return F.col("event_month") if "event_month" in fact.columns else month_of(F.col("event_timestamp"))


def q1_monthly_revenue(
    fact: DataFrame, include_anomalies: bool = False, types: DataFrame | None = None
) -> DataFrame:
    """Monthly revenue by event type.

    Grouped by the stored id and joined to the names afterwards: the join sees one
    row per group. Anomalies are excluded, so ``anomaly_count`` is 0 unless
    ``include_anomalies`` is set. Names come from ``types``, by default the seeds.
    """
    rows = fact if include_anomalies else fact.where(~F.col("is_anomaly"))
    grouped = (
        rows.where(F.col("event_type_id").isNotNull())
        .groupBy(month_column(fact).alias("month"), "event_type_id")
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            money(F.sum("total_value")).alias("gross_revenue"),
            mean("total_value").alias("avg_revenue_per_event"),
            money(F.sum("sub_value")).alias("total_surcharge"),
            F.count_if("is_anomaly").alias("anomaly_count"),
        )
    )
    names = lookup.name_dim(types, lookup.event_types(fact.sparkSession)).select(
        F.col("id").alias("event_type_id"), F.col("name").alias("event_type")
    )
    return (
        grouped.join(names, "event_type_id")
        .select(
            "month",
            "event_type",
            "total_events",
            "gross_revenue",
            "avg_revenue_per_event",
            "total_surcharge",
            "anomaly_count",
        )
        .orderBy(F.col("month").asc(), F.col("gross_revenue").desc_nulls_first(), "event_type")
    )


def q2_top_entities(fact: DataFrame, limit: int = 20, methods: DataFrame | None = None) -> DataFrame:
    """Top entities by revenue, with payment counts and the dominant method.

    Ties in the dominant method go card, cash, account, voucher; ties in revenue go
    to the lower entity_id.
    """
    names = lookup.name_dim(methods, lookup.payment_methods(fact.sparkSession)).select(
        F.col("id").alias("payment_method_id"), F.col("name").alias("payment_name")
    )
    rows = fact.where(~F.col("is_anomaly")).join(names, "payment_method_id")
    methods = ["card", "cash", "account", "voucher"]
    totals = rows.groupBy("entity_id").agg(
        F.count(F.lit(1)).alias("total_trips"),
        money(F.sum("total_value")).alias("total_revenue"),
        mean("total_value").alias("avg_revenue"),
        mean_minutes("duration_seconds").alias("avg_duration_min"),
        *[F.count_if(F.col("payment_name") == m).alias(f"paid_{m}") for m in methods],
    )
    most = F.greatest(*[F.col(f"paid_{m}") for m in methods])
    dominant = F.coalesce(*[F.when(most == F.col(f"paid_{m}"), F.lit(m)) for m in methods])
    return (
        totals.withColumn("dominant_payment", dominant)
        .orderBy(F.col("total_revenue").desc_nulls_first(), "entity_id")
        .limit(limit)
    )


def daily_rollup(fact: DataFrame, types: DataFrame | None = None) -> DataFrame:
    """Daily report by event type (unresolved types under NULL)."""
    grouped = fact.groupBy(F.to_date("event_timestamp").alias("day"), "event_type_id").agg(
        F.count(F.lit(1)).alias("total_events"),
        money(F.sum(F.when(~F.col("is_anomaly"), F.col("total_value")))).alias("gross_revenue"),
        F.count_if("is_anomaly").alias("anomaly_count"),
        F.sum("passenger_count").alias("passengers"),
    )
    names = lookup.name_dim(types, lookup.event_types(fact.sparkSession)).select(
        F.col("id").alias("event_type_id"), F.col("name").alias("event_type")
    )
    return grouped.join(names, "event_type_id", "left").select(
        "day", "event_type", "total_events", "gross_revenue", "anomaly_count", "passengers"
    )


def entity_metrics(fact: DataFrame) -> DataFrame:
    """Lifetime figures per entity."""
    clean = ~F.col("is_anomaly")
    return fact.groupBy("entity_id").agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if("is_anomaly").alias("anomaly_count"),
        money(F.sum(F.when(clean, F.col("total_value")))).alias("total_revenue"),
        F.sum("duration_seconds").alias("total_duration_seconds"),
        F.min("event_timestamp").alias("first_event"),
        F.max("event_timestamp").alias("last_event"),
    )

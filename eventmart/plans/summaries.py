"""Tables kept beside the facts: the anomalies, and partial sums by day and by entity.

Layout below the warehouse folder::

    summary_anomalies/event_month=.../load=.../   rows of the fact table with is_anomaly
    summary_daily/event_month=.../load=.../       partial sums by day and event type
    summary_entities/event_month=.../load=.../    partial figures by entity

Each load adds the figures of the rows it inserted. They are found by their load time, which all
of them share, so of the months that a load touches only the files it wrote are
read. A load that is cut short is finished by the next one: its figures replace what
it left. A month that retires takes its figures along; smallest and largest times are
merged from the months that are left, which subtracting couldn't give.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart import schemas
from eventmart.operators import access, lookup, storage
from eventmart.plans.analytics import money

PLACE = [T.StructField("event_month", T.DateType()), T.StructField("load", T.LongType())]
SUM = T.DecimalType(38, 2)
DAILY_SCHEMA = T.StructType(
    [
        T.StructField("day", T.DateType()),
        T.StructField("event_type_id", T.ShortType()),
        T.StructField("total_events", T.LongType()),
        T.StructField("gross_revenue", SUM),
        T.StructField("anomaly_count", T.LongType()),
        T.StructField("passengers", T.LongType()),
        *PLACE,
    ]
)
ENTITY_SCHEMA = T.StructType(
    [
        T.StructField("entity_id", T.IntegerType()),
        T.StructField("total_events", T.LongType()),
        T.StructField("anomaly_count", T.LongType()),
        T.StructField("total_revenue", SUM),
        T.StructField("total_duration_seconds", T.LongType()),
        T.StructField("first_event", T.TimestampType()),
        T.StructField("last_event", T.TimestampType()),
        *PLACE,
    ]
)
ANOMALY_SCHEMA = T.StructType([*schemas.nullable(schemas.FACT_SCHEMA).fields, *PLACE])
SCHEMAS = {"summary_anomalies": ANOMALY_SCHEMA, "summary_daily": DAILY_SCHEMA, "summary_entities": ENTITY_SCHEMA}


def clean_sum() -> Column:
    return F.sum(F.when(~F.col("is_anomaly"), F.col("total_value"))).cast(SUM)


def daily_parts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("event_month", F.to_date("event_timestamp").alias("day"), "event_type_id").agg(
        F.count(F.lit(1)).alias("total_events"),
        clean_sum().alias("gross_revenue"),
        F.count_if("is_anomaly").alias("anomaly_count"),
        F.sum("passenger_count").alias("passengers"),
    )


def entity_parts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("event_month", "entity_id").agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if("is_anomaly").alias("anomaly_count"),
        clean_sum().alias("total_revenue"),
        F.sum("duration_seconds").alias("total_duration_seconds"),
        F.min("event_timestamp").alias("first_event"),
        F.max("event_timestamp").alias("last_event"),
    )


class Summaries:
    """The tables of one warehouse folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str) -> DataFrame:
        return storage.read_or_empty(self.spark, self.path(name), SCHEMAS[name])

    def add(self, fact: DataFrame, load: int, months: list | None = None) -> None:
        """Keep the figures of the rows with load time ``load`` (microseconds), replacing what there is of that load.

        ``months`` are those the rows may be in; without them all months are looked through.
        """
        rows = fact.where(F.col("ingested_at") == F.timestamp_micros(F.lit(load)))
        if months is not None:
            rows = rows.where(F.col("event_month").isin([F.lit(m) for m in months]))
        self._write(rows, load)

    def rebuild(self, fact: DataFrame) -> None:
        """Make the tables of a warehouse folder that has none."""
        for name in SCHEMAS:
            storage.delete(self.spark, self.path(name))
        self._write(fact, 0)

    def _write(self, rows: DataFrame, load: int) -> None:
        anomalies = access.anomaly_scan(rows).select(*schemas.FACT_SCHEMA.names, "event_month")
        for name, part in (("summary_anomalies", anomalies), ("summary_daily", daily_parts(rows)), ("summary_entities", entity_parts(rows))):
            part = part.withColumn("load", F.lit(load).cast("long")).select(*SCHEMAS[name].names)
            writer = part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy("event_month", "load").parquet(self.path(name))

    def drop_month(self, month: str) -> None:
        for name in SCHEMAS:
            storage.delete(self.spark, f"{self.path(name)}/event_month={month}")

    # --- reads ------------------------------------------------------------------

    def anomalies(self) -> DataFrame:
        """The rows of ``access.anomaly_scan``, without reading any others."""
        return self.table("summary_anomalies").drop("load")

    def daily_rollup(self, types: DataFrame | None = None) -> DataFrame:
        """The rows of ``analytics.daily_rollup``, from partial sums."""
        sums = self.table("summary_daily").groupBy("day", "event_type_id").agg(
            F.sum("total_events").alias("total_events"),
            money(F.sum("gross_revenue")).alias("gross_revenue"),
            F.sum("anomaly_count").alias("anomaly_count"),
            F.sum("passengers").alias("passengers"),
        )
        names = lookup.name_dim(types, lookup.event_types(self.spark)).select(F.col("id").alias("event_type_id"), F.col("name").alias("event_type"))
        return sums.join(names, "event_type_id", "left").select("day", "event_type", "total_events", "gross_revenue", "anomaly_count", "passengers")

    def entity_metrics(self) -> DataFrame:
        """The rows of ``analytics.entity_metrics``, from partial figures."""
        return self.table("summary_entities").groupBy("entity_id").agg(
            F.sum("total_events").alias("total_events"),
            F.sum("anomaly_count").alias("anomaly_count"),
            money(F.sum("total_revenue")).alias("total_revenue"),
            F.sum("total_duration_seconds").alias("total_duration_seconds"),
            F.min("first_event").alias("first_event"),
            F.max("last_event").alias("last_event"),
        )

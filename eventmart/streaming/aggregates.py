"""Downstream of the ingest: windowed revenue, freshness and a second sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart import schemas
from eventmart.operators import storage
from eventmart.operators.access import month_of
from eventmart.streaming.ingest import Ingest

REVENUE_SCHEMA = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("total_events", T.LongType()),
        T.StructField("gross_revenue", T.DecimalType(20, 2)),
        T.StructField("run_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


def window_sums(events: DataFrame, window: str = "1 day") -> DataFrame:
    """Events and revenue (anomalies excluded) per window and event type."""
    clean = F.when(~F.col("is_anomaly"), F.col("total_value"))
    sums = events.groupBy(F.window("event_timestamp", window).alias("w"), "event_type").agg(
        F.count(F.lit(1)).alias("total_events"), F.sum(clean).cast("decimal(20,2)").alias("gross_revenue")
    )
    return sums.select(F.col("w.start").alias("window_start"), "event_type", "total_events", "gross_revenue")


class RevenueSink(Ingest):
    """Ingest that keeps partial revenue sums of every batch, in a folder of the batch.

    A repeated batch replaces its sums, so they count every stored event once, and events
    of any age are in them: there is no watermark. ``revenue`` adds the parts up.
    """

    window = "1 day"

    def write(self, batch: DataFrame, batch_id: int) -> bool:
        wrote = super().write(batch, batch_id)
        if wrote:
            window_sums(self.events_of(batch_id), self.window).coalesce(1).write.mode("overwrite").parquet(self.folder("revenue_parts", batch_id))
        return wrote


def revenue(spark: SparkSession, target: str) -> DataFrame:
    """Events and revenue per window and event type, over all batches of all runs."""
    parts = storage.read_or_empty(spark, f"{target}/revenue_parts", REVENUE_SCHEMA)
    return parts.groupBy("window_start", "event_type").agg(
        F.sum("total_events").alias("total_events"), F.sum("gross_revenue").alias("gross_revenue")
    )


def freshness(events: DataFrame, by: list[str | Column], target_seconds: int = 30) -> DataFrame:
    """Delay between event and receipt, in seconds to the microsecond: maximum, 95th percentile and rows within the target."""
    lag = (F.unix_micros("received_at") - F.unix_micros("event_timestamp")) / 1_000_000
    return (
        events.withColumn("lag_seconds", lag)
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.max("lag_seconds").alias("max_lag_seconds"),
            F.percentile_approx("lag_seconds", 0.95).alias("p95_lag_seconds"),
            F.count_if(F.col("lag_seconds") <= target_seconds).alias("within_target"),
        )
    )


#: Leading bits of a delay that a histogram keeps: its bins are less than one part in 64 wide.
LAG_BITS = 7


def lag_edge(micros: Column) -> Column:
    """The largest delay of the same bin: the leading bits as they are, and all others set. Integers only, so any engine agrees."""
    micros = F.greatest(micros, F.lit(0).cast("long"))
    shift = F.greatest(F.length(F.bin(micros)) - LAG_BITS, F.lit(0))
    kept = F.call_function("shiftright", micros, shift) + 1
    return F.call_function("shiftleft", kept, shift) - 1


def lag_parts(events: DataFrame, by: list[str], target_seconds: int = 30) -> DataFrame:
    """A histogram of the delays of some events, by group: parts of different batches can be added up."""
    micros = F.unix_micros("received_at") - F.unix_micros("event_timestamp")
    return (
        events.withColumn("lag", micros)
        .groupBy(*by, lag_edge(F.col("lag")).alias("edge"))
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.max("lag").alias("max_lag"),
            F.count_if(F.col("lag") <= target_seconds * 1_000_000).alias("within_target"),
        )
    )


def merged_freshness(parts: DataFrame, by: list[str], share: float = 0.95) -> DataFrame:
    """The figures of ``freshness`` over all parts, from their histograms.

    The percentile is the upper edge of the bin that holds it: at most one part in 64 above the
    exact one (nearest rank), never below. A delay below zero counts as none there.
    """
    bins = parts.groupBy(*by, "edge").agg(F.sum("row_count").alias("n"), F.max("max_lag").alias("most"), F.sum("within_target").alias("within"))
    own = Window.partitionBy(*by)
    upto = F.sum("n").over(own.orderBy("edge").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = bins.withColumns({"upto": upto, "total": F.sum("n").over(own)})
    seconds = 1_000_000.0
    return ranked.groupBy(*by).agg(
        F.sum("n").alias("row_count"),
        (F.max("most") / seconds).alias("max_lag_seconds"),
        (F.min(F.when(F.col("upto") >= F.ceil(F.col("total") * F.lit(str(share)).cast("decimal(6,4)")), F.col("edge"))) / seconds).alias("p95_lag_seconds"),
        F.sum("within").alias("within_target"),
    )


class FreshnessSink(Ingest):
    """Ingest that keeps the histogram of delays of every batch, by event type; a repeated batch replaces its own."""

    target_seconds = 30

    def write(self, batch: DataFrame, batch_id: int) -> bool:
        wrote = super().write(batch, batch_id)
        if wrote:
            parts = lag_parts(self.events_of(batch_id), ["event_type"], self.target_seconds)
            parts.coalesce(1).write.mode("overwrite").parquet(self.folder("freshness_parts", batch_id))
        return wrote


LAG_SCHEMA = T.StructType([T.StructField("event_type", T.StringType())] + [T.StructField(c, T.LongType()) for c in ("edge", "row_count", "max_lag", "within_target")])


def stream_freshness(spark: SparkSession, target: str) -> DataFrame:
    """Freshness by event type over all batches of all runs."""
    return merged_freshness(storage.read_or_empty(spark, f"{target}/freshness_parts", LAG_SCHEMA), ["event_type"])


class DualSink(Ingest):
    """Ingest that feeds an analytical copy, partitioned by month, from every batch.

    The operational folder is written first and read back, so the copy gets exactly
    the rows that were new. Its folders carry run and batch below the month, so a
    repeated batch replaces its own rows there too.
    """

    def write(self, batch: DataFrame, batch_id: int) -> bool:
        if not super().write(batch, batch_id):
            return False
        keyed = self.events_of(batch_id).select(
            "*",
            month_of(F.col("event_timestamp")).alias("event_month"),
            F.lit(self.run_id).alias("run_id"),
            F.lit(batch_id).cast("long").alias("batch_id"),
        )
        # Written without a shuffle by month: one month may hold the whole batch.
        keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "event_month", "run_id", "batch_id"
        ).parquet(f"{self.target}/analytical_events")
        return True


def analytical_events(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(f"{target}/analytical_events")

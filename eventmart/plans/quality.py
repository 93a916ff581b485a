"""Data-quality checks, each as rows of one report.

Report columns: check, status ('ok' | 'warn' | 'fail' | 'info'), observed,
expected, is_issue. Aggregates are taken once: the fact table is read in one pass
by ``fact_profile`` and in a second one, of the key column only, for duplicates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart import schemas
from eventmart.operators import dedup
from eventmart.plans.analytics import month_column

REPORT_SCHEMA = "check string, status string, observed string, expected string, is_issue boolean"


def fact_profile(fact: DataFrame) -> DataFrame:
    """All one-pass figures of a fact table in one row.

    Aggregated per month first and over the months second, which gives the number
    of months without a distinct aggregate.
    """
    clean = F.when(~F.col("is_anomaly"), F.col("total_value"))
    monthly = fact.groupBy(month_column(fact).alias("month")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("is_anomaly").alias("anomalies"),
        F.count_if(F.col("event_type_id").isNull()).alias("null_event_type_id"),
        F.count_if(F.col("payment_method_id").isNull()).alias("null_payment_method_id"),
        F.min("event_timestamp").alias("earliest"),
        F.max("event_timestamp").alias("latest"),
        F.sum(clean).alias("revenue"),
        F.count(clean).alias("revenue_rows"),
        F.min(clean).alias("min_value"),
        F.max(clean).alias("max_value"),
    )
    zero = F.lit(0).cast("long")
    return monthly.agg(
        F.coalesce(F.sum("n"), zero).alias("fact_rows"),
        F.coalesce(F.sum("anomalies"), zero).alias("anomalies"),
        F.coalesce(F.sum("null_event_type_id"), zero).alias("null_event_type_id"),
        F.coalesce(F.sum("null_payment_method_id"), zero).alias("null_payment_method_id"),
        F.min("earliest").alias("earliest"),
        F.max("latest").alias("latest"),
        F.count("month").alias("months"),
        F.round(F.sum("revenue"), 2).cast("decimal(30,2)").alias("total_revenue"),
        F.round(F.sum("revenue") / F.sum("revenue_rows"), 2).cast("decimal(20,2)").alias("avg_per_event"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
    )


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def report_row(check: str, status: Column, observed: Column, expected: str | None, issue: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        status.alias("status"),
        observed.cast("string").alias("observed"),
        F.lit(expected).cast("string").alias("expected"),
        F.coalesce(issue, F.lit(False)).alias("is_issue"),
    )


def as_report(one_row: DataFrame, *rows: Column) -> DataFrame:
    """One aggregate row turned into report rows."""
    return one_row.select(F.inline(F.array(*rows)))


def status_of(*branches: tuple[Column, str], otherwise: str) -> Column:
    out = None
    for cond, name in branches:
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return out.otherwise(otherwise)


def load_report(raw: DataFrame, fact: DataFrame) -> DataFrame:
    """Counts after a load: staging rows, fact rows, anomalies."""
    counts = fact.agg(
        F.count(F.lit(1)).alias("fact_rows"), F.count_if("is_anomaly").alias("anomalies")
    ).select(
        F.expr(
            "stack(2, 'fact_events', fact_rows, 'anomalies (negative total_value)', anomalies)"
            " AS (table_name, row_count)"
        )
    )
    staged = row_count(raw, "row_count").select(F.lit("raw_events").alias("table_name"), "row_count")
    return staged.unionByName(counts)


def dq_tables(spark: SparkSession, present: dict[str, bool]) -> DataFrame:
    """Which tables exist; a missing streaming_events is only a warning.

    ``present`` comes from metadata probes (``Mart.present_tables``): no data is read.
    """
    rows = []
    for name in schemas.HEALTH_TABLES:
        there = present.get(name, False)
        optional = name == "streaming_events"
        status = "ok" if there else "warn" if optional else "fail"
        rows.append((f"table {name}", status, str(there).lower(), "true", not there and not optional))
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def graded_count(check: str, c: str, minimum: int) -> Column:
    n = F.col(c)
    status = status_of((n >= minimum, "ok"), (n > 0, "warn"), otherwise="fail")
    return report_row(check, status, n, f">= {minimum}", n < minimum)


# Report rows taken from the profile row, one function per section.


def fact_count_rows(minimum: int) -> list[Column]:
    return [graded_count("rows fact_events", "fact_rows", minimum)]


def anomaly_rows() -> list[Column]:
    n = F.col("anomalies")
    return [report_row("anomalies", F.when(n > 0, "ok").otherwise("warn"), n, "> 0", F.lit(False))]


def null_rows() -> list[Column]:
    def row(c: str) -> Column:
        n = F.col(c)
        return report_row(c, F.when(n == 0, "ok").otherwise("warn"), n, "0", n > 0)

    return [row("null_event_type_id"), row("null_payment_method_id")]


def date_rows() -> list[Column]:
    empty = F.col("earliest").isNull()
    status = F.when(empty, "fail").otherwise("ok")

    def time(c: str) -> Column:
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss")

    return [
        report_row("earliest event", status, time("earliest"), None, empty),
        report_row("latest event", status, time("latest"), None, F.lit(False)),
        report_row("months covered", status, F.col("months"), None, F.lit(False)),
    ]


def revenue_rows() -> list[Column]:
    names = ["total_revenue", "avg_per_event", "min_value", "max_value"]
    return [report_row(c, F.lit("info"), F.col(c), None, F.lit(False)) for c in names]


def stored_counts(raw: DataFrame, stream: DataFrame | None, minimum: int) -> DataFrame:
    """Row counts of staging (graded) and of the stream table (informational)."""
    staged = as_report(row_count(raw), graded_count("rows raw_events", "n", minimum))
    if stream is None:
        missing = [("rows streaming_events", "warn", None, None, False)]
        return staged.unionByName(raw.sparkSession.createDataFrame(missing, REPORT_SCHEMA))
    n = F.col("n")
    row = report_row("rows streaming_events", F.when(n > 0, "ok").otherwise("warn"), n, None, F.lit(False))
    return staged.unionByName(as_report(row_count(stream), row))


def dq_row_counts(
    raw: DataFrame,
    fact: DataFrame,
    stream: DataFrame | None = None,
    minimum: int = schemas.EXPECTED_MIN_ROWS,
) -> DataFrame:
    """Staging and fact must hold ``minimum`` rows; the stream table is informational."""
    loaded = as_report(row_count(fact, "fact_rows"), *fact_count_rows(minimum))
    return stored_counts(raw, stream, minimum).unionByName(loaded)


def dq_anomalies(fact: DataFrame) -> DataFrame:
    """Some anomalies are expected; none is a warning but not an issue."""
    return as_report(fact_profile(fact), *anomaly_rows())


def dq_duplicates(fact: DataFrame) -> DataFrame:
    """No event_id may occur twice."""
    dupes = row_count(dedup.duplicate_keys(fact))
    n = F.col("n")
    return as_report(
        dupes, report_row("duplicate event_ids", F.when(n == 0, "ok").otherwise("fail"), n, "0", n > 0)
    )


def dq_nulls(fact: DataFrame) -> DataFrame:
    """Unresolved dimension ids are warnings and issues."""
    return as_report(fact_profile(fact), *null_rows())


def dq_date_range(fact: DataFrame) -> DataFrame:
    """First and last event and months covered; an empty table is an issue."""
    return as_report(fact_profile(fact), *date_rows())


def dq_dim_sizes(dims: dict[str, DataFrame], zones: DataFrame) -> DataFrame:
    """Fixed dimensions must have exactly their expected size; zones are counted only."""
    n = F.col("n")
    out = as_report(row_count(zones), report_row("rows dim_zone", F.lit("ok"), n, None, F.lit(False)))
    for name, expected in schemas.EXPECTED_DIM_ROWS.items():
        status = F.when(n == expected, "ok").otherwise("warn")
        row = report_row(f"rows {name}", status, n, str(expected), n != expected)
        out = out.unionByName(as_report(row_count(dims[name]), row))
    return out


def dq_revenue(fact: DataFrame) -> DataFrame:
    """Revenue figures of the rows that are not anomalies; NULL when there are none."""
    return as_report(fact_profile(fact), *revenue_rows())


def health_report(
    spark: SparkSession,
    present: dict[str, bool],
    raw: DataFrame,
    fact: DataFrame,
    dims: dict[str, DataFrame],
    zones: DataFrame,
    stream: DataFrame | None = None,
    minimum: int = schemas.EXPECTED_MIN_ROWS,
) -> DataFrame:
    """All checks in one report.

    Every figure of the fact table but the duplicates comes out of one profile row,
    so the table is scanned once for all of them.
    """
    figures = fact_count_rows(minimum) + anomaly_rows() + null_rows() + date_rows() + revenue_rows()
    return (
        dq_tables(spark, present)
        .unionByName(stored_counts(raw, stream, minimum))
        .unionByName(as_report(fact_profile(fact), *figures))
        .unionByName(dq_duplicates(fact))
        .unionByName(dq_dim_sizes(dims, zones))
    )


def dq_summary(report: DataFrame) -> DataFrame:
    """Number of issues, and the exit code a health check would give."""
    return report.agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if("is_issue").alias("issues"),
        F.max(F.col("is_issue").cast("int")).alias("exit_code"),
    )


def validate_load(raw: DataFrame, fact: DataFrame) -> DataFrame:
    """Post-load validation: raises when the fact table is empty, else returns the figures.

    Unresolved event types and payment methods only lower the status to 'warn'.
    """
    profile = fact_profile(fact)
    row = profile.select(
        "fact_rows", "anomalies", "null_event_type_id", "null_payment_method_id"
    ).first()  # one aggregate row
    if row.fact_rows == 0:
        raise ValueError("the fact table is empty after the load")
    staged = row_count(raw).first().n
    values = [("raw_rows", staged, "info"), ("fact_rows", row.fact_rows, "ok"), ("anomalies", row.anomalies, "info")]
    for name in ("null_event_type_id", "null_payment_method_id"):
        values.append((name, row[name], "warn" if row[name] else "ok"))
    return raw.sparkSession.createDataFrame(values, "measure string, row_count long, status string")

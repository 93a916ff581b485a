"""Table schemas, seed rows and fixed values of the event star schema.

Nothing is inferred anywhere: sources are read with these schemas and writers
select these columns in this order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# Column order of the raw CSV file (positional scan).
RAW_COLUMNS = [
    "event_id",
    "event_timestamp",
    "entity_id",
    "zone_id",
    "destination_id",
    "vendor_id",
    "event_type",
    "rate_type",
    "duration",
    "passenger_count",
    "value",
    "sub_value",
    "total_value",
    "payment_method",
]

# Seed rows of the dimensions.
EVENT_TYPE_SEEDS = [(1, "standard"), (2, "express"), (3, "premium"), (4, "bulk"), (5, "scheduled")]
PAYMENT_METHOD_SEEDS = [(1, "card"), (2, "cash"), (3, "account"), (4, "voucher")]
VENDOR_SEEDS = [(1, "Vendor A"), (2, "Vendor B")]

# CHECK constraints.
RATE_TYPE_MIN, RATE_TYPE_MAX = 1, 6
DURATION_MIN = 0

# Thresholds and expectations of the health report.
EXPECTED_MIN_ROWS = 287_000
EXPECTED_DIM_ROWS = {"dim_event_type": 5, "dim_payment_method": 4, "dim_vendor": 2}
HEALTH_TABLES = [
    "dim_event_type",
    "dim_payment_method",
    "dim_vendor",
    "dim_zone",
    "raw_events",
    "fact_events",
    "streaming_events",
]
# ----------------------------------------------------------------------------

MONEY = T.DecimalType(10, 2)

# Where a row came from: (file, split start, row within the task) for files,
# (topic-partition, offset, 0) for Kafka. Their lexicographic order is arrival order.
ORDER_COLUMNS = ["source_file", "source_block", "source_row"]

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])

STAGING_SCHEMA = T.StructType(
    RAW_SCHEMA.fields
    + [
        T.StructField("source_file", T.StringType()),
        T.StructField("source_block", T.LongType()),
        T.StructField("source_row", T.LongType()),
        T.StructField("malformed_line", T.StringType()),
        T.StructField("reject_reason", T.StringType()),
        T.StructField("loaded_at", T.TimestampType()),
    ]
)

FACT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType(), False),
        T.StructField("event_timestamp", T.TimestampType(), False),
        T.StructField("entity_id", T.IntegerType(), False),
        T.StructField("zone_id", T.IntegerType()),
        T.StructField("destination_id", T.IntegerType()),
        T.StructField("vendor_id", T.ShortType()),
        T.StructField("event_type_id", T.ShortType()),
        T.StructField("rate_type", T.ShortType()),
        T.StructField("duration_seconds", T.IntegerType()),
        T.StructField("passenger_count", T.ShortType()),
        T.StructField("value", MONEY),
        T.StructField("sub_value", MONEY),
        T.StructField("total_value", MONEY),
        T.StructField("payment_method_id", T.ShortType()),
        T.StructField("is_anomaly", T.BooleanType(), False),
        T.StructField("ingested_at", T.TimestampType(), False),
    ]
)
FACT_COLUMNS = [f.name for f in FACT_SCHEMA.fields if f.name != "ingested_at"]

STREAM_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType(), False),
        T.StructField("event_timestamp", T.TimestampType(), False),
        T.StructField("entity_id", T.IntegerType(), False),
        T.StructField("zone_id", T.IntegerType()),
        T.StructField("destination_id", T.IntegerType()),
        T.StructField("vendor_id", T.ShortType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("rate_type", T.ShortType()),
        T.StructField("duration_seconds", T.IntegerType()),
        T.StructField("passenger_count", T.ShortType()),
        T.StructField("value", MONEY),
        T.StructField("sub_value", MONEY),
        T.StructField("total_value", MONEY),
        T.StructField("payment_method", T.StringType()),
        T.StructField("is_anomaly", T.BooleanType(), False),
        T.StructField("received_at", T.TimestampType(), False),
    ]
)
# How the stream table is stored: with the run and the batch that brought a row, by month.
RUN_FIELDS = [T.StructField("run_id", T.StringType()), T.StructField("batch_id", T.LongType())]
MONTH_FIELD = T.StructField("event_month", T.DateType())
STORED_STREAM_SCHEMA = T.StructType([*STREAM_SCHEMA.fields, *RUN_FIELDS, MONTH_FIELD])
STREAM_COLUMNS = [f.name for f in STREAM_SCHEMA.fields if f.name != "received_at"]

LOOKUP_DIM_SCHEMA = T.StructType(
    [T.StructField("id", T.ShortType(), False), T.StructField("name", T.StringType(), False)]
)
ZONE_SCHEMA = T.StructType(
    [T.StructField("zone_id", T.IntegerType(), False), T.StructField("zone_name", T.StringType())]
)


def nullable(schema: T.StructType) -> T.StructType:
    """The same schema with every column nullable, which is how parquet stores it."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])

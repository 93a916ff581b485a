"""The ``events`` table turned into raw text event rows (see FIXTURES.md).

One pass over the whole table; a second copy of some rows is added by exploding
a repeat count, not by reading the table twice. The same expressions, as SQL, are
in ``oracles.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart import schemas

MAPPED_TYPE = """CASE event_type WHEN 'click' THEN 'standard' WHEN 'view' THEN 'express'
 WHEN 'purchase' THEN 'premium' WHEN 'error' THEN 'bulk' ELSE 'scheduled' END"""

# Text columns by name, valid in Spark SQL and in DuckDB alike.
SHARED = {
    "event_id": """CASE WHEN k % 97 = 0 THEN 'bad-' || CAST(k AS STRING)
 WHEN k % 101 = 0 THEN lpad(CAST(k AS STRING), 8, '0') || '-ABCD-4000-8000-' || lpad(CAST(k AS STRING), 12, '0')
 ELSE lpad(CAST(k AS STRING), 8, '0') || '-abcd-4000-8000-' || lpad(CAST(k AS STRING), 12, '0') END""",
    "entity_id": "CAST(user_id AS STRING)",
    "zone_id": "CAST(k % 265 + 1 AS STRING)",
    "destination_id": "CAST((k * 7) % 265 + 1 AS STRING)",
    "vendor_id": "CASE WHEN k % 89 = 0 THEN NULL ELSE CAST(k % 4 + 1 AS STRING) END",
    "event_type": """CASE WHEN k % 211 = 0 THEN 'mystery' WHEN k % 3 = 0 THEN upper(m)
 WHEN k % 3 = 1 THEN '  ' || m || ' ' ELSE m END""",
    "rate_type": "CAST(k % 6 + 1 AS STRING)",
    "duration": "CAST((k * 37) % 5400 AS STRING)",
    "passenger_count": "CASE WHEN k % 50 = 3 THEN '1.5' ELSE CAST(k % 6 AS STRING) || '.0' END",
    "value": "CAST(v AS STRING)",
    "sub_value": "CAST(CAST(v * 0.1 AS DECIMAL(10,2)) AS STRING)",
    "total_value": """CASE WHEN k % 331 = 0 THEN '-' ELSE '' END
 || CAST(CAST(v + CAST(v * 0.1 AS DECIMAL(10,2)) AS DECIMAL(10,2)) AS STRING)""",
    "payment_method": """CASE WHEN k % 197 = 0 THEN NULL WHEN (k + user_id) % 7 < 3 THEN 'Card'
 WHEN (k + user_id) % 7 < 5 THEN ' cash' WHEN (k + user_id) % 7 = 5 THEN 'ACCOUNT' ELSE 'voucher' END""",
}
SPARK_TIME = "date_format(ts + make_interval(0, cast(k % 3 as int)), 'yyyy-MM-dd HH:mm:ss')"

# Bad values of the dirty variant: column -> (condition, text).
DIRTY = {
    "event_timestamp": ("k % 419 = 7", "'not-a-time'"),
    "entity_id": ("k % 431 = 7", "'None'"),
    "zone_id": ("k % 433 = 7", "'9999'"),
    "rate_type": ("k % 401 = 7", "'9'"),
    "duration": ("k % 409 = 7", "'-5'"),
    "total_value": ("k % 421 = 7", "NULL"),
}
#: Rows of the compact table that one task turns into text; a file of it is a few splits at any size.
ROWS_PER_TASK = 100_000
# How often a row occurs.
COPIES = "CASE WHEN k % 50 = 0 THEN 2 ELSE 1 END"


def tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks over which the work on the table is spread, in proportion to its rows."""
    return max(1, -(-spark.read.parquet(f"{sf_dir}/events.parquet").count() // ROWS_PER_TASK))  # footers only


def raw_events(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    """Raw rows: the fourteen text columns, the source key ``k`` and the order columns."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    base = events.select(
        F.col("event_id").alias("k"),
        F.col("user_id"),
        F.col("ts"),
        F.expr("CAST(value AS DECIMAL(10,2))").alias("v"),
        F.expr(MAPPED_TYPE).alias("m"),
    )
    n = tasks(spark, sf_dir)
    if n > 1:  # dealt out while the rows are narrow
        base = base.repartition(n)
    columns = []
    for name in schemas.RAW_COLUMNS:
        sql = SPARK_TIME if name == "event_timestamp" else SHARED[name]
        if dirty and name in DIRTY:
            cond, text = DIRTY[name]
            sql = f"CASE WHEN {cond} THEN {text} ELSE {sql} END"
        columns.append(F.expr(sql).alias(name))
    rows = base.select(*columns, "k", F.explode(F.expr(f"sequence(1, {COPIES})")).alias("copy"))
    return rows.select(
        *schemas.RAW_COLUMNS,
        "k",
        F.lit("events").alias("source_file"),
        F.col("k").alias("source_block"),
        F.col("copy").cast("long").alias("source_row"),
    )

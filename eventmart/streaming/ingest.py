"""Message stream -> streaming_events, once per event_id, whatever is replayed.

Layout below ``target``::

    streaming_events/run_id=.../batch_id=.../event_month=.../   accepted rows, first per event_id
    stream_keys/, stream_key_sets/                              their ids, see ``streaming.keys``
    stream_sets/<name>/                                         compacted rows, see ``streaming.compaction``
    rejected_messages/run_id=.../batch_id=.../                  the rest, with message and reason
    stream_metrics/run_id=.../batch_id=.../                     one row of counters per batch

A run is one checkpoint: its id is kept beside the checkpoint, so restarting it
continues the run, and a new checkpoint is a new run. A batch is written into its
own folder, and a batch repeated after a failure replaces its folder, so a half
written batch leaves nothing behind.

An id is stored once, whatever run brings it. Within a batch the first row in arrival
order wins: copies are dropped in front of the shuffle, so an id that holds a third of the
rows leaves each task as one row. Against everything stored before, a batch is compared by
way of the key table, whose cost doesn't grow with the number of batches. Counters are taken
of all messages, before anything is dropped.
"""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventmart import schemas
from eventmart.operators import dedup, storage, versions
from eventmart.operators.access import month_of
from eventmart.session import PROMPT_CLEANUP, configure, settings
from eventmart.sources.messages import EXPANSION
from eventmart.streaming import compaction
from eventmart.streaming.keys import KeyTable
from eventmart.streaming.parse import parse_messages

METRICS_SCHEMA = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("received", "inserted", "skipped", "anomalies")]
    + [T.StructField("logged_at", T.TimestampType())]
    + schemas.RUN_FIELDS
)
# The parse is one large expression: as one generated method the JVM would not compile
# it, so let Spark split it.
PARSE_SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000"}
# A micro-batch is written in files of up to this many rows, not one per shuffle partition.
ROWS_PER_FILE = 250_000
log = logging.getLogger(__name__)


def run_id_of(spark: SparkSession, checkpoint: str) -> str:
    """The stable id of the run that owns ``checkpoint``, made on first use."""
    marker = f"{checkpoint.rstrip('/')}-run_id.txt"
    storage.write_text(spark, marker, uuid.uuid4().hex[:12])
    return storage.read_text(spark, marker).strip()


def stream_events(spark: SparkSession, target: str) -> DataFrame:
    """The stream table with its run, batch and month columns (empty before the first batch)."""
    return compaction.Compaction(spark, target).events()


def stream_metrics(spark: SparkSession, target: str) -> DataFrame:
    """Counters of every batch; sum them for the totals of a run or of all runs."""
    return storage.read_or_empty(spark, f"{target}/stream_metrics", METRICS_SCHEMA)


def stream_rejects(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(f"{target}/rejected_messages")


def metrics_totals(metrics: DataFrame) -> DataFrame:
    return metrics.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("inserted", "skipped", "anomalies")]
    )


class Ingest:
    """Writes the micro-batches of one run into ``target`` (a foreachBatch sink)."""

    #: Batches that make a set of the key table, and buckets of a new key table.
    fan, buckets = versions.FAN, 64

    def __init__(self, spark: SparkSession, target: str, run_id: str):
        self.spark, self.target, self.run_id = spark, target.rstrip("/"), run_id
        self.keys = KeyTable(spark, self.target, self.buckets, self.fan)
        self.keys.heal()

    def folder(self, table: str, batch_id: int) -> str:
        return f"{self.target}/{table}/run_id={self.run_id}/batch_id={batch_id}"

    @staticmethod
    def save(rows: DataFrame, path: str, at_most: int) -> None:
        """Write a folder of the batch, ``at_most`` rows, replacing what a failed try left."""
        Ingest.sized(rows, at_most).write.mode("overwrite").parquet(path)

    @staticmethod
    def sized(rows: DataFrame, at_most: int) -> DataFrame:
        """As many partitions as files. Only the new rows are shuffled; the join with the history before it keeps its width."""
        return rows.repartition(at_most // ROWS_PER_FILE + 1)

    def save_events(self, rows: DataFrame, path: str, at_most: int) -> None:
        """Write the events of a batch by month, each file a stretch of time, so that reads by time skip files."""
        rows = rows.withColumn(schemas.MONTH_FIELD.name, month_of(F.col("event_timestamp")))
        files = at_most // ROWS_PER_FILE + 1
        rows = rows.repartition(1) if files == 1 else rows.repartitionByRange(files, "event_timestamp", "event_id")
        rows.sortWithinPartitions("event_timestamp").write.mode("overwrite").partitionBy(schemas.MONTH_FIELD.name).parquet(path)

    def events_of(self, batch_id: int) -> DataFrame:
        """What a batch has stored."""
        return self.spark.read.schema(schemas.nullable(schemas.STREAM_SCHEMA)).parquet(self.folder("streaming_events", batch_id)).select(*schemas.STREAM_SCHEMA.names)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        # Rows of one split are numbered here, before any shuffle, where the source did not.
        row = F.coalesce("source_row", F.monotonically_increasing_id())
        # The text of a message is kept for rejects only: it is larger than what was made of it.
        text = F.when(F.col("reject_reason").isNotNull(), F.col("message"))
        batch = batch.withColumns({"source_row": row, "message": text}).persist()
        try:
            with settings(self.spark, PROMPT_CLEANUP):  # the batch has a session of its own
                self.write(batch, batch_id)
        finally:
            batch.unpersist()

    def write(self, batch: DataFrame, batch_id: int) -> bool:
        """Write the batch; False if it had no messages."""
        good = F.col("reject_reason").isNull()
        counts = batch.agg(
            F.count(F.lit(1)).alias("received"),
            F.count_if(~good).alias("skipped"),
            F.count_if(good & F.col("is_anomaly")).alias("anomalies"),
        ).first()  # one aggregate row
        if counts.received == 0:
            return False
        rows = batch.where(good)
        fresh = dedup.dedup_first_wins(rows)
        stored = self.keys.candidates(rows, counts.received, self.run_id, batch_id)
        if stored is not None:
            fresh = dedup.absent_rows(fresh, stored, keys=rows, key_count=counts.received)
        fresh = fresh.select(*schemas.STREAM_COLUMNS, F.current_timestamp().alias("received_at"))
        self.save_events(fresh, self.folder("streaming_events", batch_id), counts.received)
        inserted = self.events_of(batch_id).count()  # footers only
        self.keys.add(self.events_of(batch_id), inserted, self.run_id, batch_id)
        if counts.skipped:
            rejects = batch.where(~good).select("message", "reject_reason", *schemas.ORDER_COLUMNS)
            self.save(rejects, self.folder("rejected_messages", batch_id), counts.skipped)
        values = {
            "received": counts.received,
            "inserted": inserted,
            "skipped": counts.skipped,
            "anomalies": counts.anomalies,
        }
        log.info("run %s batch %d: %s", self.run_id, batch_id, values)
        row = self.spark.range(1).select(
            *[F.lit(v).cast("long").alias(n) for n, v in values.items()], F.current_timestamp().alias("logged_at")
        )
        row.write.mode("overwrite").parquet(self.folder("stream_metrics", batch_id))
        self.keys.roll_up()
        return True


def start_ingest(
    messages: DataFrame,
    target: str,
    checkpoint: str,
    dedup_mode: str = "table",
    interval: str | None = None,
    sink: type[Ingest] = Ingest,
) -> StreamingQuery:
    """Start the ingest of a message stream.

    ``interval`` ('10 seconds') sets a steady trigger; without it the query drains
    what is there and stops. The size of a micro-batch is bounded at the source
    (``max_files`` / ``max_offsets``). Offsets are committed after the batch is
    written; a batch repeated for that reason replaces itself. ``dedup_mode`` is kept for callers: 'table'
    and 'state' both compare with the key table.
    """
    if dedup_mode not in ("table", "state"):
        raise ValueError("dedup_mode is 'table' or 'state'")
    spark = configure(messages.sparkSession)
    parsed = parse_messages(messages)
    writes = sink(spark, target, run_id_of(spark, checkpoint))
    writer = parsed.writeStream.foreachBatch(writes).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    # a task gets as many messages from compressed files as it would from plain ones
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes() // EXPANSION
    with settings(spark, PARSE_SETTINGS | PROMPT_CLEANUP | {"spark.sql.files.maxPartitionBytes": str(max(1, split))}):
        return writer.trigger(**trigger).start()


def drain(query: StreamingQuery) -> None:
    """Wait for a query that stops by itself and raise what stopped it."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()

"""JSON event messages: encoding, decoding, and stream sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart import schemas
from eventmart.sources.files import file_place

CORRUPT = "_corrupt"
MESSAGE_SCHEMA = T.StructType(schemas.RAW_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType())])
# Durable publishing: all replicas acknowledge, sends are retried, batches are compressed.
KAFKA_SINK_OPTIONS = {
    "kafka.acks": "all",
    "kafka.retries": "5",
    "kafka.retry.backoff.ms": "500",
    "kafka.linger.ms": "5",
    "kafka.compression.type": "gzip",
}
FILE_COMPRESSION = "gzip"
#: Bytes of messages in a byte of such a file, about.
EXPANSION = 8


def rows_to_json(raw: DataFrame) -> DataFrame:
    """Raw rows as messages: a flat JSON object of fourteen strings ('' for NULL).

    The key is the event_id, so all copies of an event meet in one topic partition
    and keep their order.
    """
    fields = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in schemas.RAW_COLUMNS]
    return raw.select(F.col("event_id").alias("key"), F.to_json(F.struct(*fields)).alias("value"))


def json_decode(messages: DataFrame) -> DataFrame:
    """Decode the ``value`` column; ``is_malformed`` marks text that is not a JSON object.

    Malformed text yields a struct of NULLs with the text in the corrupt column, and
    an empty or missing message yields a NULL struct: both count as malformed.
    """
    decoded = F.from_json(
        "value", MESSAGE_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    out = messages.withColumn("__m", decoded)
    carried = [c for c in messages.columns if c != "value"]
    return out.select(
        *[F.col(f"__m.{c}").alias(c) for c in schemas.RAW_COLUMNS],
        (F.col("__m").isNull() | F.col(f"__m.{CORRUPT}").isNotNull()).alias("is_malformed"),
        F.col("value").alias("message"),
        *carried,
    )


def publish_files(raw: DataFrame, path: str) -> None:
    """Messages as text files, one per line: a topic without a broker.

    They are compressed as on Kafka, to less than a fifth: every message repeats the names. One file is read by one task.
    """
    rows_to_json(raw).select("value").write.mode("append").text(path, compression=FILE_COMPRESSION)


def publish_kafka(raw: DataFrame, topic: str, bootstrap: str) -> None:
    """Messages to a Kafka topic (needs the Spark Kafka package on the class path)."""
    rows_to_json(raw).write.format("kafka").options(**KAFKA_SINK_OPTIONS).option(
        "kafka.bootstrap.servers", bootstrap
    ).option("topic", topic).save()


def file_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of messages from text files; ``max_files`` bounds a micro-batch.

    A stream cannot number its rows, so ``source_row`` is left to the batch writer.
    """
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    no_row = F.lit(None).cast("long").alias("source_row")
    return reader.load(path).select("value", *file_place(), no_row)


def kafka_stream(
    spark: SparkSession, topic: str, bootstrap: str, max_offsets: int | None = None
) -> DataFrame:
    """Stream of messages from Kafka, from the earliest offset when none is stored.

    One task per topic partition; ``max_offsets`` bounds a micro-batch.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select(
        F.col("value").cast("string").alias("value"),
        F.concat_ws("-", F.col("topic"), F.lpad(F.col("partition").cast("string"), 6, "0")).alias(
            "source_file"
        ),
        F.col("offset").alias("source_block"),
        F.lit(0).cast("long").alias("source_row"),
    )

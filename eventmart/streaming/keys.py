"""The key table of the stream: every id that was stored, for ever, at a bounded cost per batch.

Layout below ``target``::

    stream_keys/run_id=.../batch_id=.../        ids of one batch
    stream_key_sets/<name>/keys/bucket=.../     ids of many batches, by bucket, in order
    stream_key_sets/<name>/filter/              bits of the set's ids, by bucket and segment
    _stream_key_versions/                       which sets there are (``operators.versions``)

A batch opens the ids of the few batches that no set covers yet, and the filters of the
sets; of a set's ids it opens only the buckets in which the filter hits. A filter has
``BITS_PER_KEY`` bits for each id in bitmaps of 4 KB. All ``PROBES`` bits of an id are in
one bitmap, so an id meets a single row of the filter, and an absent one hits by chance
once in some 600 times. With the ids of 10,000 batches in a handful of sets, a
micro-batch of new ids lists a few folders and reads filters only.

The ids of a batch are written after its events. A batch that died in between is repeated by
its run; ``heal`` adds the ids when another run comes first.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.operators import dedup, storage, versions

#: Bits of a bitmap as Spark's bitmap functions make them.
SEGMENT_BITS = 32_768
BITS_PER_KEY, PROBES = 24, 3
KEY_SCHEMA = T.StructType([T.StructField("event_id", T.StringType())])
BUCKETED = T.StructType([*KEY_SCHEMA.fields, T.StructField("bucket", T.IntegerType())])
FILTER_SCHEMA = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("segment", T.IntegerType()), T.StructField("bitmap", T.BinaryType())])
#: A file of ids holds up to so many, about.
ROWS_PER_FILE = 1_000_000


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64("event_id"), F.lit(buckets)).cast("int")


def segment_of(segments: int) -> Column:
    return F.pmod(F.xxhash64("event_id", F.lit("segment")), F.lit(segments)).cast("int")


def probes() -> list[Column]:
    return [F.pmod(F.xxhash64("event_id", F.lit(k)), F.lit(SEGMENT_BITS)).cast("int") for k in range(PROBES)]


def bit(bitmap: str, at: Column) -> Column:
    """Whether a bit of a bitmap is set."""
    byte = F.conv(F.hex(F.substring(F.col(bitmap), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (at % 8).cast("int")) == 1


class KeyTable:
    """Ids of one stream table. ``buckets`` is fixed when the first set is written."""

    def __init__(self, spark: SparkSession, target: str, buckets: int = 64, fan: int = versions.FAN):
        self.spark, self.fan = spark, fan
        self.table, self.sets = f"{target}/stream_keys", f"{target}/stream_key_sets"
        self.events = f"{target}/streaming_events"
        self.versions = versions.Versions(spark, f"{target}/_stream_key_versions")
        marker = f"{target}/_stream_key_versions/buckets.txt"
        storage.write_text(spark, marker, str(buckets))
        self.buckets = int(storage.content(spark, marker))

    def heal(self) -> None:
        """Add the ids of batches whose events were written, but not their ids (also those of older tables)."""
        state, known = self.versions.current(), versions.batches(self.spark, self.table)
        there = [(r, b) for r, own in versions.batches(self.spark, self.events).items() for b in own]
        missing = [(r, b) for r, b in there if b not in known.get(r, ()) and not state.covers(r, b)]
        if missing:
            read = self.spark.read.schema(T.StructType([*KEY_SCHEMA.fields]).add("run_id", "string").add("batch_id", "long")).option("basePath", self.events)
            rows = read.parquet(*[versions.folder(self.events, r, b) for r, b in missing])
            rows.repartition("run_id", "batch_id").write.mode("append").partitionBy("run_id", "batch_id").parquet(self.table)

    def add(self, ids: DataFrame, n: int, run_id: str, batch_id: int) -> None:
        """Store the ids of a batch, replacing what a try before it left."""
        rows = ids.select("event_id").repartition(n // ROWS_PER_FILE + 1)
        rows.write.mode("overwrite").parquet(versions.folder(self.table, run_id, batch_id))

    def candidates(self, ids: DataFrame, n: int, run_id: str, batch_id: int) -> DataFrame | None:
        """Stored ids that include every one of ``ids`` (of which there are ``n`` at most) that is stored; None if there are none.

        Never those of the batch itself: it may be a repeat.
        """
        state = self.versions.current()
        own = [x for x in versions.uncovered(self.spark, self.table, state) if x != (run_id, batch_id)]
        read = self.spark.read.schema(KEY_SCHEMA)
        out = read.parquet(*[versions.folder(self.table, *x) for x in own]) if own else None
        for s, hit in self.hits(state.sets, ids, n):
            # a bucket that hits has ids, so its folder is there; the others aren't even listed
            part = read.parquet(*[f"{self.sets}/{s['name']}/keys/bucket={b}" for b in hit])
            out = part if out is None else out.unionAll(part)
        return out

    def bucketed(self, sets: list[dict]) -> DataFrame:
        parts = [self.spark.read.schema(BUCKETED).parquet(f"{self.sets}/{s['name']}/keys") for s in sets]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionAll(p)
        return out

    def hits(self, sets: list[dict], ids: DataFrame, n: int) -> list[tuple[dict, list[int]]]:
        """For each set in which any id hits the filter, the buckets in which one does."""
        if not sets:
            return []
        asked = ids.select("event_id").distinct().select(bucket_of(self.buckets).alias("bucket"), "event_id", *[p.alias(f"p{k}") for k, p in enumerate(probes())])
        found = None
        for k, s in enumerate(sets):
            side = asked.withColumn("segment", segment_of(s["segments"]))
            bits = self.spark.read.schema(FILTER_SCHEMA).parquet(f"{self.sets}/{s['name']}/filter")
            met = bits.join(F.broadcast(side) if n <= dedup.BROADCAST_KEYS else side, ["bucket", "segment"])
            for p in range(PROBES):
                met = met.where(bit("bitmap", F.col(f"p{p}")))
            part = met.select(F.lit(k).alias("set"), "bucket")
            found = part if found is None else found.unionAll(part)
        hit: dict[int, list[int]] = {}
        for r in found.distinct().collect():  # at most the buckets of each set
            hit.setdefault(r.set, []).append(r.bucket)
        return [(sets[k], sorted(own)) for k, own in sorted(hit.items())]

    def all(self) -> DataFrame:
        """Every stored id."""
        state = self.versions.current()
        own = versions.uncovered(self.spark, self.table, state)
        parts = [self.spark.read.schema(KEY_SCHEMA).parquet(*[versions.folder(self.table, *x) for x in own])] if own else []
        parts += [self.bucketed([s]).select("event_id") for s in state.sets]
        out = parts[0] if parts else self.spark.createDataFrame([], KEY_SCHEMA)
        for p in parts[1:]:
            out = out.unionAll(p)
        return out

    def roll_up(self) -> bool:
        """Merge what is due: finished batches into a set, sets of a level into one of the next. True if anything was."""
        state, did = self.versions.current(), False
        final = versions.uncovered(self.spark, self.table, state, final=True)
        if len(final) >= self.fan:
            ids = self.spark.read.schema(KEY_SCHEMA).parquet(*[versions.folder(self.table, *x) for x in final])
            made = self._write(ids.select("event_id", bucket_of(self.buckets).alias("bucket")), 1)
            last = state.covered | {r: max(b for q, b in final if q == r) for r, _ in final}
            state, did = versions.State([*state.sets, made], last), True
            self.versions.publish(state)
        while old := state.due(self.fan):
            made = self._write(self.bucketed(old), old[0]["level"] + 1)
            state, did = versions.State([s for s in state.sets if s not in old] + [made], state.covered), True
            self.versions.publish(state)
        if did:  # only this writer reads them
            versions.sweep(self.spark, self.table, self.sets, state)
        return did

    def _write(self, rows: DataFrame, level: int) -> dict:
        name = uuid.uuid4().hex[:12]
        path = f"{self.sets}/{name}"
        # stretches of buckets and ids: a large bucket is several files, so no task has more than a file to sort
        files = rows.count() // ROWS_PER_FILE + 1  # footers only
        laid = rows.repartition(1) if files == 1 else rows.repartitionByRange(files, "bucket", "event_id")
        laid.sortWithinPartitions("bucket", "event_id").write.partitionBy("bucket").parquet(f"{path}/keys")
        made = {"name": name, "level": level, "segments": 1}
        kept = self.bucketed([made])
        n = kept.count()  # footers only
        made |= {"rows": n, "segments": max(1, -(-n * BITS_PER_KEY // (self.buckets * SEGMENT_BITS)))}
        bits = kept.select("bucket", segment_of(made["segments"]).alias("segment"), F.explode(F.array(*probes())).alias("at"))
        maps = bits.groupBy("bucket", "segment").agg(F.bitmap_construct_agg(F.col("at").cast("long")).alias("bitmap"))
        maps.repartitionByRange("bucket", "segment").sortWithinPartitions("bucket", "segment").write.parquet(f"{path}/filter")
        return made

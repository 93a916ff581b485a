"""Compaction of the stream table, and reads by time that open only files in range.

Batches that can't be repeated any more (all but the last one of a run) are merged into
sets: ``stream_sets/<name>/events/event_month=.../``, each file a stretch of time, with run and batch
as columns. ``stream_sets/<name>/ranges`` has the first and last time of every file. Which sets count
stands in ``_stream_set_versions`` (``operators.versions``), which is switched in one step;
folders that were replaced stay until ``sweep``. It may run beside the ingest: that
never touches batches that are final.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart import schemas
from eventmart.operators import access, storage, versions

#: A task sorts the rows of a file, so this bounds its memory.
ROWS_PER_FILE = 1_000_000
STORED = schemas.nullable(schemas.STORED_STREAM_SCHEMA)
RANGE_SCHEMA = T.StructType([T.StructField("file", T.StringType()), T.StructField("first", T.TimestampType()), T.StructField("last", T.TimestampType())])


class Compaction:
    """Sets of the stream table below ``target``."""

    def __init__(self, spark: SparkSession, target: str, fan: int = versions.FAN):
        self.spark, self.fan, target = spark, fan, target.rstrip("/")
        self.table, self.sets = f"{target}/streaming_events", f"{target}/stream_sets"
        self.versions = versions.Versions(spark, f"{target}/_stream_set_versions")

    def _batches(self, own: list[tuple[str, int]]) -> DataFrame:
        read = self.spark.read.schema(STORED).option("basePath", self.table)
        return read.parquet(*[versions.folder(self.table, *x) for x in own])

    def _set(self, name: str) -> DataFrame:
        return self.spark.read.schema(STORED).parquet(f"{self.sets}/{name}/events")

    def events(self) -> DataFrame:
        """All rows of the version that is current now."""
        state = self.versions.current()
        if not state.sets:
            return storage.read_or_empty(self.spark, self.table, STORED)
        own = versions.uncovered(self.spark, self.table, state)
        return self._union([self._set(s["name"]) for s in state.sets] + ([self._batches(own)] if own else []))

    def between(self, start: str, end: str) -> DataFrame:
        """Rows with start <= event_timestamp < end (as ``access.time_range``), from files and months in range only."""
        state = self.versions.current()
        begin, stop = access.instant(start), access.instant(end)
        parts = []
        for s in state.sets:
            ranges = self.spark.read.schema(RANGE_SCHEMA).parquet(f"{self.sets}/{s['name']}/ranges")
            near = ranges.where((F.col("first") < F.lit(stop)) & (F.col("last") >= F.lit(begin))).select("file")
            if files := [r.file for r in near.collect()]:  # the files that the answer comes from
                read = self.spark.read.schema(STORED).option("basePath", f"{self.sets}/{s['name']}/events")
                parts.append(read.parquet(*files))
        own = versions.uncovered(self.spark, self.table, state)
        if own:
            parts.append(self._batches(own))
        rows = self._union(parts) if parts else self.spark.createDataFrame([], STORED)
        return access.time_range(rows, start, end)

    @staticmethod
    def _union(parts: list[DataFrame]) -> DataFrame:
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def compact(self) -> bool:
        """Merge the final batches that no set covers, then sets of a level that are due. True if anything was merged."""
        state, did = self.versions.current(), False
        final = versions.uncovered(self.spark, self.table, state, final=True)
        if final:
            made = self._write(self._batches(final), 1)
            last = state.covered | {r: max(b for q, b in final if q == r) for r, _ in final}
            state, did = versions.State([*state.sets, made], last), True
            self.versions.publish(state)
        while old := state.due(self.fan):
            made = self._write(self._union([self._set(s["name"]) for s in old]), old[0]["level"] + 1)
            state, did = versions.State([s for s in state.sets if s not in old] + [made], state.covered), True
            self.versions.publish(state)
        return did

    def sweep(self) -> int:
        """Delete what compaction replaced, and what one that died left; no reader may still use an older version."""
        return versions.sweep(self.spark, self.table, self.sets, self.versions.current())

    def _write(self, rows: DataFrame, level: int) -> dict:
        name = uuid.uuid4().hex[:12]
        path = f"{self.sets}/{name}"
        n = rows.count()  # footers only
        files = n // ROWS_PER_FILE + 1
        # by time, and ids within an instant, so that no instant has to fit into one file
        laid = rows.repartitionByRange(files, "event_timestamp", "event_id").sortWithinPartitions("event_timestamp")
        laid.write.partitionBy("event_month").parquet(f"{path}/events")
        times = self._set(name).groupBy(F.col("_metadata.file_path").alias("file"))
        ranges = times.agg(F.min("event_timestamp").alias("first"), F.max("event_timestamp").alias("last"))
        ranges.coalesce(1).write.parquet(f"{path}/ranges")
        return {"name": name, "level": level, "rows": n}

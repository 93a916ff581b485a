"""Batch facts and stream events as one table: as a query, and stored."""

from __future__ import annotations

import uuid
from collections import Counter
from functools import reduce
from operator import or_
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart import schemas
from eventmart.operators import dedup, lookup, storage, versions
from eventmart.streaming import compaction, ingest

if TYPE_CHECKING:
    from eventmart.plans.mart import Mart

#: Stored stream rows, with the bucket of their id.
STORED = T.StructType([f for f in schemas.FACT_SCHEMA.fields if f.name in schemas.FACT_COLUMNS] + [T.StructField("bucket", T.IntegerType())])
#: The name under which a version notes the last load, beside those of the runs.
LOADS = "loads"


def stream_as_facts(
    stream: DataFrame, types: DataFrame | None = None, methods: DataFrame | None = None
) -> DataFrame:
    """Stream rows in the shape of facts: names resolved to dimension ids."""
    return lookup.fk_lookup(stream, types, methods).select(*schemas.FACT_COLUMNS)


def unified_events(
    fact: DataFrame,
    stream: DataFrame,
    stream_rows: int | None = None,
    types: DataFrame | None = None,
    methods: DataFrame | None = None,
) -> DataFrame:
    """All events of both tables once; an event in both is taken from the batch side.

    Each side is unique by itself, so only stream rows are matched, against the ids
    of the fact table; fact rows pass through without a shuffle. ``stream_rows``, when
    known, lets the match hash the stream ids instead of sorting the stored ones.
    """
    extra = dedup.absent_rows(stream_as_facts(stream, types, methods), fact, keys=stream, key_count=stream_rows)
    return fact.select(*schemas.FACT_COLUMNS).unionByName(extra)


class UnifiedTable:
    """The unified events, stored: fact rows where they are, and beside them the stream rows that no fact row replaces.

    A stream row is written once, when its batch is final, to a bucket of its id below ``unified_sets/set=.../bucket=.../``.
    A batch row that arrives later takes its place: only buckets that hold a replaced row are written again, or
    that have come to consist of ``fan`` folders. Which folders count, and up to which load and stream
    batches they hold for, stands in ``_unified_versions``, which is switched in one step: a merge that dies leaves folders
    that nobody lists, and is run again. So neither the order of arrival nor a repeated merge changes the rows.

    A read is exact at any time: what was loaded or streamed since the last merge is
    matched on the spot, and costs in proportion to that. A single merge at a time is assumed.
    """

    def __init__(self, mart: Mart, buckets: int | None = None, fan: int = versions.FAN):
        self.mart, self.spark, self.fan = mart, mart.spark, fan
        self.sets = mart.path("unified_sets")
        self.versions = versions.Versions(mart.spark, mart.path("_unified_versions"))
        marker = mart.path("unified_bucket_count.txt")
        storage.write_text(self.spark, marker, str(buckets or mart.buckets))
        self.buckets = int(storage.content(self.spark, marker))

    def _folders(self, state: versions.State, buckets: set[int] | None = None) -> list[str]:
        return [f"{self.sets}/set={s['name']}/bucket={b}" for s in state.sets for b in s["buckets"] if buckets is None or b in buckets]

    def _stored(self, state: versions.State, buckets: set[int] | None = None) -> DataFrame:
        """Stored stream rows, of some buckets only if so asked."""
        paths = self._folders(state, buckets)
        if not paths:
            return self.spark.createDataFrame([], schemas.nullable(STORED))
        schema = T.StructType([*schemas.nullable(STORED).fields, T.StructField("set", T.StringType())])
        return self.spark.read.schema(schema).option("basePath", self.sets).parquet(*paths).select(*STORED.names)

    def _newer(self, state: versions.State) -> DataFrame:
        """Fact rows of the loads after the last one that was merged; the predicate reaches the scan."""
        return self.mart.fact().where(F.col("ingested_at") > F.timestamp_micros(F.lit(state.covered.get(LOADS, 0))))

    def _pending(self, state: versions.State, final: dict[str, int] | None = None) -> DataFrame:
        """Stream rows of batches that weren't merged, up to the ``final`` one of each run if given."""
        rows = ingest.stream_events(self.spark, self.mart.root)
        if final is not None:
            rows = rows.where(reduce(or_, [up_to(r, b) for r, b in final.items()], F.lit(False)))
        done = [up_to(r, b) for r, b in state.covered.items() if r != LOADS]
        return rows.where(~reduce(or_, done)) if done else rows

    def _as_facts(self, stream: DataFrame, facts: DataFrame) -> DataFrame:
        """Stream rows whose id no fact has, in the shape of facts."""
        rows = stream_as_facts(stream, self.mart.dim("dim_event_type"), self.mart.dim("dim_payment_method"))
        return dedup.absent_rows(rows, facts, keys=stream, key_count=stream.count())

    def events(self) -> DataFrame:
        """All events once, in the shape of facts, as of now."""
        state = self.versions.current()
        fact, newer = self.mart.fact(), self._newer(state)
        kept = self._stored(state).select(*schemas.FACT_COLUMNS)
        if state.sets and not newer.isEmpty():
            kept = kept.join(newer.select("event_id"), "event_id", "left_anti").select(*schemas.FACT_COLUMNS)
        out = fact.select(*schemas.FACT_COLUMNS).unionByName(kept)
        pending = self._pending(state)
        return out if pending.isEmpty() else out.unionByName(self._as_facts(pending, fact))

    def merge(self) -> list[int]:
        """Take in what came since the last merge; the buckets that were written again."""
        state = self.versions.current()
        newer = self._newer(state)
        load = newer.agg(F.max(F.unix_micros("ingested_at")).alias("at")).first().at
        # all but the last batch of a run, which may be repeated; compaction takes such batches only
        final = dict(compaction.Compaction(self.spark, self.mart.root).versions.current().covered)
        for r, own in versions.batches(self.spark, self.mart.path("streaming_events")).items():
            if len(own) > 1:
                final[r] = max(own[-2], final.get(r, -1))
        new = self._pending(state, final)
        due = {b for b, n in Counter(b for s in state.sets for b in s["buckets"]).items() if n >= self.fan}
        parts, again = [], set(due)
        if load is not None and state.sets:
            hit = self._stored(state).join(newer.select("event_id"), "event_id", "left_semi").select("bucket").distinct()
            again |= {r.bucket for r in hit.collect()}  # bucket numbers
        if again:
            old = self._stored(state, again)
            parts.append(old if load is None else old.join(newer.select("event_id"), "event_id", "left_anti").select(*old.columns))
        if not new.isEmpty():
            until = F.timestamp_micros(F.lit(max(load or 0, state.covered.get(LOADS, 0))))
            found = self._as_facts(new, self.mart.fact().where(F.col("ingested_at") <= until))
            parts.append(found.withColumn("bucket", F.pmod(F.xxhash64("event_id"), F.lit(self.buckets)).cast("int")))
        if load is None and not parts:
            return []
        sets = [s | {"buckets": [b for b in s["buckets"] if b not in again]} for s in state.sets]
        sets = [s for s in sets if s["buckets"]]
        if parts:
            name = uuid.uuid4().hex[:12]
            rows = reduce(DataFrame.unionByName, parts).select(*STORED.names)
            rows.repartition(self.buckets, "bucket").write.partitionBy("bucket").parquet(f"{self.sets}/set={name}")
            held = [int(n.removeprefix("bucket=")) for n in storage.children(self.spark, f"{self.sets}/set={name}") if n.startswith("bucket=")]
            sets += [{"name": name, "level": 0, "buckets": sorted(held)}] if held else []
        covered = state.covered | final | ({LOADS: load} if load is not None else {})
        self.versions.publish(versions.State(sets, covered))
        return sorted(again)

    def sweep(self) -> int:
        """Delete folders that are not listed any more; no reader may still use an older version."""
        state = self.versions.current()
        listed = {f"set={s['name']}": {f"bucket={b}" for b in s["buckets"]} for s in state.sets}
        old = []
        for name in storage.children(self.spark, self.sets):
            if not name.startswith("set="):
                continue
            if name not in listed:
                old.append(f"{self.sets}/{name}")
            else:
                own = storage.children(self.spark, f"{self.sets}/{name}")
                old += [f"{self.sets}/{name}/{b}" for b in own if b.startswith("bucket=") and b not in listed[name]]
        return sum(storage.delete(self.spark, p) for p in old)


def up_to(run_id: str, batch_id: int) -> Column:
    return (F.col("run_id") == run_id) & (F.col("batch_id") <= batch_id)

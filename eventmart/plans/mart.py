"""The warehouse folder: its tables, the batch load and month maintenance.

Layout below ``root``::

    raw_events/            staging, text, replaced by every load
    dim_event_type/ dim_payment_method/ dim_vendor/ dim_zone/
    fact_events/           event_month=.../  bucketed by event_id, sorted by entity_id
    rejected_events/       load_id=.../      rows a load did not accept, with the reason
    pending_loads/         a marker of the load that is running, or was cut short
    summary_*/             anomalies and partial sums, see ``plans.summaries``
    streaming_events/      written by the stream, see ``streaming.ingest``

The fact table is registered in the catalog because bucketing lives there: the
key column of a bucketed table joins with new keys without being shuffled, and
that join is what keeps event_id unique over the whole history.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart import schemas
from eventmart.operators import dedup, dims, lookup, storage, transform
from eventmart.operators.access import month_of
from eventmart.plans import quality
from eventmart.plans.summaries import Summaries
from eventmart.session import configure, settings
from eventmart.streaming import ingest

DIM_SCHEMAS = {
    "dim_event_type": schemas.LOOKUP_DIM_SCHEMA,
    "dim_payment_method": schemas.LOOKUP_DIM_SCHEMA,
    "dim_vendor": schemas.LOOKUP_DIM_SCHEMA,
    "dim_zone": schemas.ZONE_SCHEMA,
}


class Mart:
    """One warehouse folder. A single writer at a time is assumed."""

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        """Open ``root``, creating what is missing.

        ``buckets`` is the number of fact files per month and load; it is fixed when
        the folder is created. Size it so that a month divided by it is 1-2 GB, and not
        below spark.sql.shuffle.partitions, which is the default.
        """
        self.spark = configure(spark)
        self.root = root.rstrip("/")
        marker = self.path("bucket_count.txt")
        wanted = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        storage.write_text(spark, marker, str(wanted))
        self.buckets = int(storage.read_text(spark, marker))
        self.database = "eventmart_" + uuid.uuid5(uuid.NAMESPACE_URL, self.root).hex[:16]
        self.fact_table = f"{self.database}.fact_events"
        self.summaries = Summaries(spark, self.root)
        self._create_tables()

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    # --- tables ---------------------------------------------------------------

    def _create_tables(self) -> None:
        """Create what is missing: the catalog entry, the seeded and the still empty tables."""
        spark = self.spark
        catalog = self.path("catalog")  # an empty folder: dropping a database deletes its location
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{catalog}'")
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.FACT_SCHEMA.fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.fact_table} ({columns}, event_month date) USING parquet"
            f" PARTITIONED BY (event_month)"
            f" CLUSTERED BY (event_id) SORTED BY (entity_id) INTO {self.buckets} BUCKETS"
            f" LOCATION '{self.path('fact_events')}'"
        )
        self._recover_months()
        self._finish_zones()
        self.finish_pending()
        if storage.write_text(spark, self.path("pending_loads/summaries.txt"), "made") and self.months():
            self.summaries.rebuild(self.fact())  # a folder of an earlier release
        seeds = {
            "dim_event_type": lookup.event_types(spark),
            "dim_payment_method": lookup.payment_methods(spark),
            "dim_vendor": lookup.vendors(spark),
        }
        empty = {"dim_zone": schemas.ZONE_SCHEMA, "raw_events": schemas.STAGING_SCHEMA}
        seeds |= {n: spark.createDataFrame([], schemas.nullable(schema)) for n, schema in empty.items()}
        for name, rows in seeds.items():
            if not storage.has_data(spark, self.path(name)):
                rows.write.mode("append").parquet(self.path(name))

    def _recover_months(self) -> None:
        """Register month folders the catalog doesn't know: what a load left that died after its files.

        The names of both are compared first, one per month; the repair, which lists all of them
        deeply, is run only where they differ.
        """
        names = storage.children(self.spark, self.path("fact_events"))
        if {n.removeprefix("event_month=") for n in names if n.startswith("event_month=")} - set(self.months()):
            self.spark.sql(f"MSCK REPAIR TABLE {self.fact_table}")

    def finish_pending(self) -> None:
        """Finish what a load left that was cut short: register its months, and keep the figures of its rows."""
        for name in storage.children(self.spark, self.path("pending_loads")):
            if name.startswith("load-"):
                self._recover_months()
                self.summaries.add(self.fact(), int(name.removeprefix("load-").removesuffix(".txt")))
                storage.delete(self.spark, self.path(f"pending_loads/{name}"))

    def _append(self, members: DataFrame, name: str) -> None:
        """Add dimension members; most loads have none, and then no file is written."""
        if not members.isEmpty():
            members.write.mode("append").parquet(self.path(name))

    def dim(self, name: str) -> DataFrame:
        return storage.read_or_empty(self.spark, self.path(name), DIM_SCHEMAS[name])

    def fact(self) -> DataFrame:
        return self.spark.table(self.fact_table)

    def raw(self) -> DataFrame:
        return storage.read_or_empty(self.spark, self.path("raw_events"), schemas.STAGING_SCHEMA)

    def months(self) -> list[str]:
        """Month partitions, as text: catalog metadata, one entry per month."""
        rows = self.spark.sql(f"SHOW PARTITIONS {self.fact_table}").collect()
        return sorted(r.partition.split("=", 1)[1] for r in rows)

    def present_tables(self) -> dict[str, bool]:
        """Which of the health-checked tables exist (metadata probes only)."""
        found = {n: storage.exists(self.spark, self.path(n)) for n in schemas.HEALTH_TABLES}
        found["fact_events"] = self.spark.catalog.tableExists(self.fact_table)
        return found

    def register_views(self, prefix: str = "") -> None:
        """Temporary views of all tables, for queries in SQL."""
        views = {name: self.dim(name) for name in DIM_SCHEMAS}
        views |= {"fact_events": self.fact(), "raw_events": self.raw()}
        views["streaming_events"] = ingest.stream_events(self.spark, self.root)
        for name, df in views.items():
            df.createOrReplaceTempView(prefix + name)

    # --- batch load -----------------------------------------------------------

    def stage_reload(self, raw: DataFrame) -> DataFrame:
        """Replace staging by ``raw``, judged and stamped with the load time."""
        if "malformed_line" not in raw.columns:
            raw = raw.withColumn("malformed_line", F.lit(None).cast("string"))
        columns = [*schemas.RAW_COLUMNS, *schemas.ORDER_COLUMNS, "malformed_line"]
        judged = transform.judge(raw.select(*columns))
        staged = judged.withColumn("loaded_at", F.current_timestamp())
        staged.select(*schemas.STAGING_SCHEMA.names).write.mode("overwrite").parquet(self.path("raw_events"))
        return self.raw()

    def update_dimensions(self, staged: DataFrame) -> None:
        """Add the zones and vendors that staging mentions for the first time."""
        self._append(dims.dim_zone_discover(staged, self.dim("dim_zone")), "dim_zone")
        self._append(dims.dim_vendor_register(staged, self.dim("dim_vendor")), "dim_vendor")

    def unknown_members(self, staged: DataFrame) -> tuple[DataFrame | None, DataFrame | None]:
        """Keys of staging without a dimension row, or None where there are none.

        Digit texts were added by ``update_dimensions``, so only the odd spellings
        (' 12 ', '-5') are looked up: one column each, reduced to distinct keys.
        """
        out = []
        for key, cast, dim, dim_key in (
            ("zone_id", "int", "dim_zone", "zone_id"),
            ("vendor_id", "smallint", "dim_vendor", "id"),
        ):
            odd = staged.where(~F.col(key).rlike(transform.casts.DIGITS)).select(F.col(key).try_cast(cast).alias(key))
            unknown = lookup.unknown_keys(odd, key, self.dim(dim), dim_key)
            out.append(None if unknown.isEmpty() else unknown)
        return out[0], out[1]

    def insert_facts(
        self,
        rows: DataFrame,
        keys: DataFrame | None = None,
        key_count: int | None = None,
        scope: str = "all",
        months: list | None = None,
    ) -> None:
        """Insert the first row per event_id, unless the fact table has that id already.

        Everything is shuffled once, by event_id into as many partitions as there are
        buckets: the duplicate elimination, the join with the stored keys and the
        bucketed write all use that one partitioning.

        ``scope='all'`` compares with every stored id. ``scope='month'`` reads only the
        ids of the months the new rows fall into; it is weaker, because an id that
        comes back with a time in another month is then inserted again. ``months`` are those
        that the rows fall into, when known.
        """
        if scope not in ("all", "month"):
            raise ValueError("scope is 'all' or 'month'")
        with settings(self.spark, {"spark.sql.shuffle.partitions": str(self.buckets)}):
            self.finish_pending()
            load = time.time_ns() // 1000
            marker = self.path(f"pending_loads/load-{load}.txt")
            storage.write_text(self.spark, marker, "running")
            self.fact_rows(rows, keys, key_count, scope, load).write.insertInto(self.fact_table)
            self.summaries.add(self.fact(), load, months)
            storage.delete(self.spark, marker)

    def fact_rows(
        self,
        rows: DataFrame,
        keys: DataFrame | None = None,
        key_count: int | None = None,
        scope: str = "all",
        load: int | None = None,
    ) -> DataFrame:
        """The rows ``insert_facts`` writes, in the layout of the fact table; ``load`` is their load time in microseconds."""
        stored = None
        self._recover_months()
        if self.months():
            stored = self.fact()
            if scope == "month":
                touched = rows.select(month_of(F.col("event_timestamp")).alias("m")).distinct().collect()  # months
                stored = stored.where(F.col("event_month").isin([F.lit(r.m) for r in touched]))
        rows = dedup.dedup_first_wins(rows)
        if stored is not None:
            rows = dedup.absent_rows(rows, stored, keys=keys, key_count=key_count)
        return rows.select(
            *schemas.FACT_COLUMNS,
            (F.current_timestamp() if load is None else F.timestamp_micros(F.lit(load))).alias("ingested_at"),
            month_of(F.col("event_timestamp")).alias("event_month"),
        ).repartition(self.buckets, "event_id")

    def transform_staged(
        self, staged: DataFrame, on_bad: str = "quarantine", load_id: str | None = None, scope: str = "all"
    ) -> None:
        """Staging to facts: extend dimensions, split off rejects, type, insert.

        ``on_bad='fail'`` refuses the whole load when any row is bad for another reason
        than its event_id (those rows are always skipped). ``scope`` is that of
        ``insert_facts``. Rejects go to the folder of ``load_id``, by default that of
        the source files: loading the same files again replaces it, others never do.
        """
        if on_bad not in ("quarantine", "fail"):
            raise ValueError("on_bad is 'quarantine' or 'fail'")
        self.update_dimensions(staged)
        zones, vendors = self.unknown_members(staged)
        judged = transform.mark_unknown(staged, "zone_id", zones)
        judged = transform.mark_unknown(judged, "vendor_id", vendors)
        rejected = transform.rejected_rows(judged)
        if on_bad == "fail":
            errors = (
                rejected.where(F.col("reject_reason") != transform.SKIPPED_REASON)
                .groupBy("reject_reason")
                .count()
                .collect()  # one row per reason
            )
            if errors:
                found = {r.reject_reason: r["count"] for r in errors}
                raise ValueError(f"load refused, bad rows: {found}")
        load_id = load_id or self.load_id_of(staged)
        rejected.write.mode("overwrite").parquet(self.path(f"rejected_events/load_id={load_id}"))
        # All ids of staging, not only the accepted ones: a superset is as good, and a
        # filter here would be evaluated on every stored key as well.
        facts = transform.fact_transform(judged, self.dim("dim_event_type"), self.dim("dim_payment_method"))
        times = staged.where("reject_reason IS NULL").select(month_of(transform.casts.batch_timestamp(F.col("event_timestamp"))).alias("m"))
        months = [r.m for r in times.distinct().collect()]  # one row per month
        self.insert_facts(facts, staged.select("event_id"), staged.count(), scope, months)

    @staticmethod
    def load_id_of(staged: DataFrame) -> str:
        """A name of the set of source files: their number and a hash that no order changes."""
        names = staged.select("source_file").where("source_file IS NOT NULL").distinct()
        found = names.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64("source_file")), F.lit(0)).alias("h")).first()
        return f"files-{found.n}-{found.h & (2**64 - 1):016x}"

    def load_batch(
        self, raw: DataFrame, on_bad: str = "quarantine", load_id: str | None = None, scope: str = "all"
    ) -> DataFrame:
        """Load raw rows and return the validation figures.

        Running the same load again changes nothing: its reject folder is replaced and
        its ids are present already.
        """
        staged = self.stage_reload(raw)
        self.transform_staged(staged, on_bad, load_id, scope)
        return quality.validate_load(staged, self.fact())

    def rejects(self) -> DataFrame:
        return self.spark.read.parquet(self.path("rejected_events"))

    def name_zones(self, names: DataFrame) -> None:
        """Write zone names (``names``: zone_id, zone_name) into the stored dimension.

        The new rows are written beside it, in full; then one marker makes them the ones that
        count, and they take the old ones' place. A job that dies before the marker changes
        nothing; after it, whoever opens the folder next finishes the exchange.
        """
        self._finish_zones()
        named = dims.zone_enrich(self.dim("dim_zone"), names)
        named.write.mode("overwrite").parquet(self.path("dim_zone-next"))
        storage.write_text(self.spark, self.path("dim_zone-next.txt"), "complete")
        self._finish_zones()

    def _finish_zones(self) -> None:
        """Exchange the zones for those written beside them, if these are complete. Every step can be repeated."""
        marker, aside = self.path("dim_zone-next.txt"), self.path("dim_zone-next")
        if not storage.exists(self.spark, marker):
            return
        if storage.exists(self.spark, aside):
            storage.delete(self.spark, self.path("dim_zone"))
            storage.rename(self.spark, aside, self.path("dim_zone"))
        storage.delete(self.spark, marker)

    # --- months ---------------------------------------------------------------

    def retire_months(self, before: str, archive: str) -> list[str]:
        """Move months before ``before`` ('yyyy-MM-dd') to ``archive``, partitioned by month.

        Rows are copied if absent, so a run that was cut short can simply be repeated;
        months are dropped only after every id in them was found in the archive.
        """
        spark, old = self.spark, [m for m in self.months() if m < before]
        if not old:
            return []
        retired = F.col("event_month").isin([F.lit(m).cast("date") for m in old])
        rows, schema = self.fact().where(retired), self.fact().schema
        kept = storage.read_or_empty(spark, archive, schema).where(retired)
        copied = dedup.absent_rows(rows, kept).select(*schema.names)
        copied.write.mode("append").partitionBy("event_month").parquet(archive)
        archived = storage.read_or_empty(spark, archive, schema).where(retired)
        if not rows.select("event_id").join(archived.select("event_id"), "event_id", "left_anti").isEmpty():
            raise RuntimeError("the archive is incomplete, nothing was dropped")
        for m in old:
            self.summaries.drop_month(m)  # first: a run cut short here finds the month again
            spark.sql(f"ALTER TABLE {self.fact_table} DROP IF EXISTS PARTITION (event_month = DATE'{m}')")
            storage.delete(spark, f"{self.path('fact_events')}/event_month={m}")
        return old

"""One query per operator, each over the whole test tables.

Money is returned as double and instants as timestamp without zone, the forms in
which two engines can be compared. Load times are never returned.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart import schemas
from eventmart.operators import access, dedup, dims, lookup, storage, transform
from eventmart.plans import analytics, quality, unify
from eventmart.plans.mart import Mart
from eventmart.session import PROMPT_CLEANUP, configure, fresh_path, settings
from eventmart.sources import files, messages
from eventmart.streaming import aggregates, compaction, ingest, parse
from parity import fixture

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

MIN_ROWS = 1_000  # floor of the row-count checks at test scale
SECOND_LOAD_FROM = "2024-03-01"


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    REGISTRY[fn.__name__] = run
    return fn


def plain(df: DataFrame) -> DataFrame:
    """Decimals as double, timestamps as timestamp_ntz."""
    out = []
    for f in df.schema.fields:
        to = {T.DecimalType: "double", T.TimestampType: "timestamp_ntz"}.get(type(f.dataType))
        out.append(F.col(f.name).cast(to).alias(f.name) if to else F.col(f.name))
    return df.select(*out)


def raw(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    return fixture.raw_events(spark, sf_dir, dirty)


def texts(df: DataFrame) -> DataFrame:
    return df.select(*schemas.RAW_COLUMNS)


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unique typed facts of the clean fixture."""
    return dedup.dedup_first_wins(transform.fact_transform(raw(spark, sf_dir))).select(*schemas.FACT_COLUMNS)


def resent(rows: DataFrame) -> DataFrame:
    """The same events sent again later with another value."""
    later = F.lit("later").alias("source_file")
    changed = (F.col("value").cast("decimal(10,2)") + 1).cast("decimal(10,2)").cast("string")
    return rows.withColumns({"value": changed, "source_file": later})


def stored(fact: DataFrame) -> DataFrame:
    """Rows of a fact table without its load time and partition column."""
    return plain(fact.select(*schemas.FACT_COLUMNS))


def new_mart(spark: SparkSession) -> Mart:
    return Mart(spark, fresh_path(spark, "mart"))


def loaded_mart(spark: SparkSession, sf_dir: str, dirty: bool = False) -> Mart:
    mart = new_mart(spark)
    mart.load_batch(raw(spark, sf_dir, dirty))
    return mart


def published(spark: SparkSession, sf_dir: str, parts: int = 4) -> str:
    """The dirty fixture as message files: ``parts`` of them, or as many times that as keep files small."""
    path = fresh_path(spark, "messages")
    files = parts * -(-fixture.tasks(spark, sf_dir) // parts)
    messages.publish_files(raw(spark, sf_dir, dirty=True).repartition(files, "event_id"), path)
    return path


def run_ingest(spark: SparkSession, source: str, target: str, mode: str = "table", sink=ingest.Ingest, batches: int = 2) -> None:
    """Drain ``source`` into ``target`` under a new checkpoint, in so many batches of as many files."""
    stream = messages.file_stream(spark, source, max_files=-(-len(storage.files(spark, source)) // batches))
    ingest.drain(ingest.start_ingest(stream, target, fresh_path(spark, "checkpoint"), mode, sink=sink))


def ingested(spark: SparkSession, sf_dir: str, mode: str = "table", sink=ingest.Ingest) -> str:
    target = fresh_path(spark, "stream")
    run_ingest(spark, published(spark, sf_dir), target, mode, sink)
    return target


def stream_rows(spark: SparkSession, target: str) -> DataFrame:
    return ingest.stream_events(spark, target).select(*schemas.STREAM_COLUMNS)


# --- sources ------------------------------------------------------------------


@query
def csv_scan_raw(spark, sf_dir):
    path = fresh_path(spark, "csv")
    files.csv_write(texts(raw(spark, sf_dir)), path)
    return texts(files.csv_scan_raw(spark, path))


@query
def csv_scan_by_name(spark, sf_dir):
    path = fresh_path(spark, "csv")
    files.csv_write(raw(spark, sf_dir).select(*reversed(schemas.RAW_COLUMNS)), path)
    return texts(files.csv_scan_by_name(spark, path))


@query
def csv_malformed_rows(spark, sf_dir):
    """All rows three times: well-formed, without their last field, and with one more."""
    rows, path = texts(raw(spark, sf_dir)), fresh_path(spark, "csv")
    more = rows.withColumn("extra", F.lit("x"))
    for name, df in (("good", rows), ("short", rows.select(*schemas.RAW_COLUMNS[:-1])), ("long", more)):
        files.csv_write(df, f"{path}/{name}")
    scan = files.csv_scan_raw(spark, [f"{path}/{n}" for n in ("good", "short", "long")])
    judged = transform.judge(scan)
    return judged.groupBy(F.coalesce("reject_reason", F.lit("accepted")).alias("reject_reason")).agg(
        F.count(F.lit(1)).alias("row_count"), F.count("malformed_line").alias("lines_kept")
    )


@query
def csv_by_name_mixed_headers(spark, sf_dir):
    """Files whose columns stand in opposite order, plain and compressed, in one scan."""
    rows, path = texts(raw(spark, sf_dir)), fresh_path(spark, "csv")
    files.csv_write(rows, f"{path}/forward")
    files.csv_write(rows.select(*reversed(schemas.RAW_COLUMNS)), f"{path}/backward")
    files.csv_write(rows, f"{path}/compressed", "gzip")
    return texts(files.csv_scan_by_name(spark, path))


@query
def stage_reload(spark, sf_dir):
    mart = new_mart(spark)
    mart.stage_reload(raw(spark, sf_dir))
    return mart.stage_reload(raw(spark, sf_dir, dirty=True)).select(*schemas.RAW_COLUMNS, "reject_reason")


@query
def rows_to_json(spark, sf_dir):
    return messages.rows_to_json(raw(spark, sf_dir, dirty=True))


@query
def json_decode(spark, sf_dir):
    """Every message, and every message again without its opening brace."""
    good = messages.rows_to_json(raw(spark, sf_dir)).select("value")
    broken = good.select(F.replace("value", F.lit("{"), F.lit("")).alias("value"))
    return messages.json_decode(good.unionAll(broken)).select(*schemas.RAW_COLUMNS, "is_malformed")


# --- batch transform ----------------------------------------------------------


@query
def uuid_filter(spark, sf_dir):
    return transform.uuid_filter(raw(spark, sf_dir)).select("event_id", "entity_id", "total_value")


@query
def fact_transform(spark, sf_dir):
    return plain(transform.fact_transform(raw(spark, sf_dir)).select(*schemas.FACT_COLUMNS))


@query
def dim_extended(spark, sf_dir):
    """A sixth event type and a fifth payment method, stored before the load: Q1, Q2's methods and the type's facts know them."""
    mart = new_mart(spark)
    for name, row in (("dim_event_type", (6, "mystery")), ("dim_payment_method", (5, "barter"))):
        spark.createDataFrame([row], mart.dim(name).schema).write.mode("append").parquet(mart.path(name))
    mart.load_batch(raw(spark, sf_dir))
    types = mart.dim("dim_event_type")
    q1 = analytics.q1_monthly_revenue(mart.fact(), types=types).groupBy("event_type").agg(F.sum("total_events").alias("in_q1"))
    found = access.type_lookup(mart.fact(), "mystery", types).agg(F.count(F.lit(1)).alias("found"))
    n = found.first().found
    return q1.withColumn("found", F.lit(n).cast("long"))


@query
def load_rejects_two_loads(spark, sf_dir):
    """Rejects of a load stay when other files are loaded, and are replaced when the same are."""
    mart = new_mart(spark)
    loads = [(raw(spark, sf_dir), "clean"), (raw(spark, sf_dir, dirty=True), "dirty")]
    for rows, name in [*loads, loads[0]]:
        mart.load_batch(rows.withColumn("source_file", F.lit(name)))
    return mart.rejects().groupBy("source_file", "reject_reason").agg(F.count(F.lit(1)).alias("row_count"))


@query
def zone_names_stored(spark, sf_dir):
    """Zone names written into the stored dimension."""
    mart = loaded_mart(spark, sf_dir)
    names = mart.dim("dim_zone").select("zone_id", F.concat(F.lit("Zone "), "zone_id").alias("zone_name"))
    mart.name_zones(names)
    return mart.dim("dim_zone")


@query
def fk_lookup(spark, sf_dir):
    out = lookup.fk_lookup(raw(spark, sf_dir))
    return out.select("event_id", "event_type", "payment_method", "event_type_id", "payment_method_id")


@query
def anomaly_flag(spark, sf_dir):
    flag = transform.anomaly_flag(F.col("total_value"))
    return raw(spark, sf_dir, dirty=True).select("event_id", "total_value", flag.alias("is_anomaly"))


@query
def check_constraints(spark, sf_dir):
    judged = transform.judge(raw(spark, sf_dir, dirty=True))
    return transform.reject_counts(judged)


@query
def fk_violations(spark, sf_dir):
    """Zones and vendors of the dirty rows, against dimensions built from the clean ones."""
    clean, dirty = raw(spark, sf_dir), transform.fact_transform(raw(spark, sf_dir, dirty=True))
    out = None
    for key, dim, dim_key in (
        ("zone_id", dims.zone_candidates(clean), "zone_id"),
        ("vendor_id", lookup.vendors(spark), "id"),
    ):
        unknown = lookup.unknown_keys(dirty, key, dim, dim_key)
        part = unknown.select(F.lit(key).alias("key_name"), F.col(key).cast("int").alias("key_value"), "row_count")
        out = part if out is None else out.unionAll(part)
    return out


@query
def dedup_first_wins(spark, sf_dir):
    """Every event sent twice, the second time with another value."""
    rows = raw(spark, sf_dir)
    both = transform.fact_transform(resent(rows).unionByName(rows))
    return plain(dedup.dedup_first_wins(both).select("event_id", "value", "total_value"))


# --- tables -------------------------------------------------------------------


@query
def fact_upsert(spark, sf_dir):
    """Two months first, then everything again with other values: first load wins."""
    mart, rows = new_mart(spark), raw(spark, sf_dir)
    mart.load_batch(rows.where(F.col("event_timestamp") < SECOND_LOAD_FROM))
    mart.load_batch(resent(rows))
    return stored(mart.fact())


@query
def load_batch(spark, sf_dir):
    """CSV file to fact table, twice, with bad rows in quarantine."""
    path, mart = fresh_path(spark, "csv"), new_mart(spark)
    files.csv_write(texts(raw(spark, sf_dir, dirty=True)), path)
    for _ in range(2):
        mart.load_batch(files.csv_scan_raw(spark, path))
    return stored(mart.fact())


@query
def load_rejects(spark, sf_dir):
    mart = loaded_mart(spark, sf_dir, dirty=True)
    return mart.rejects().select(*schemas.RAW_COLUMNS, "reject_reason")


@query
def seed_dims(spark, sf_dir):
    """Every seeded member with the raw rows that name it."""
    rows = raw(spark, sf_dir)
    parts = [
        ("dim_event_type", dims.seed_usage(rows, "event_type", lookup.event_types(spark))),
        ("dim_payment_method", dims.seed_usage(rows, "payment_method", lookup.payment_methods(spark))),
    ]
    tagged = [df.select(F.lit(n).alias("dim"), "id", "name", "row_count") for n, df in parts]
    return tagged[0].unionAll(tagged[1])


@query
def dim_zone_discover(spark, sf_dir):
    mart = new_mart(spark)
    rows = raw(spark, sf_dir, dirty=True)
    mart.update_dimensions(rows.where(F.col("event_timestamp") < SECOND_LOAD_FROM))
    mart.update_dimensions(rows)
    return mart.dim("dim_zone")


@query
def dim_vendor_register(spark, sf_dir):
    mart = new_mart(spark)
    rows = raw(spark, sf_dir)
    mart.update_dimensions(rows.where(F.col("event_timestamp") < SECOND_LOAD_FROM))
    mart.update_dimensions(rows)
    return mart.dim("dim_vendor")


@query
def zone_enrich(spark, sf_dir):
    """Zones named after the supplier of the same number; the others stay unnamed."""
    zones = dims.zone_candidates(raw(spark, sf_dir))
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    names = suppliers.select(F.col("s_suppkey").cast("int").alias("zone_id"), F.col("s_name").alias("zone_name"))
    return dims.zone_enrich(zones, names)


@query
def fact_by_month(spark, sf_dir):
    fact = loaded_mart(spark, sf_dir).fact()
    return plain(fact.select("event_month", "event_id", "event_timestamp", "total_value"))


@query
def retire_months(spark, sf_dir):
    """January moved to the archive: rows per place and month."""
    mart, archive = loaded_mart(spark, sf_dir), fresh_path(spark, "archive")
    mart.retire_months("2024-02-01", archive)
    places = [("fact", mart.fact()), ("archive", spark.read.parquet(archive))]
    counted = [
        df.groupBy(F.lit(n).alias("place"), "event_month").agg(F.count(F.lit(1)).alias("row_count"))
        for n, df in places
    ]
    return counted[0].unionAll(counted[1])


# --- analytics ----------------------------------------------------------------


@query
def q1_monthly_revenue(spark, sf_dir):
    return plain(analytics.q1_monthly_revenue(facts(spark, sf_dir)))


@query
def q1_with_anomalies(spark, sf_dir):
    return plain(analytics.q1_monthly_revenue(facts(spark, sf_dir), include_anomalies=True)).select(
        "month", "event_type", "total_events", "gross_revenue", "total_surcharge", "anomaly_count"
    )


@query
def q2_top_entities(spark, sf_dir):
    return plain(analytics.q2_top_entities(facts(spark, sf_dir)))


@query
def daily_rollup(spark, sf_dir):
    return plain(analytics.daily_rollup(facts(spark, sf_dir)))


@query
def entity_metrics(spark, sf_dir):
    return plain(analytics.entity_metrics(facts(spark, sf_dir)))


@query
def entity_lookup(spark, sf_dir):
    return stored(access.entity_lookup(loaded_mart(spark, sf_dir).fact(), 11))


@query
def zone_lookup(spark, sf_dir):
    return stored(access.zone_lookup(loaded_mart(spark, sf_dir).fact(), 42))


@query
def type_lookup(spark, sf_dir):
    return stored(access.type_lookup(loaded_mart(spark, sf_dir).fact(), "premium"))


@query
def time_range(spark, sf_dir):
    """Read from the month-partitioned table, so the months outside are pruned."""
    fact = loaded_mart(spark, sf_dir).fact()
    return stored(access.time_range(fact, "2024-02-01", "2024-02-08"))


@query
def anomaly_scan(spark, sf_dir):
    return stored(access.anomaly_scan(loaded_mart(spark, sf_dir).fact()))


def three_loads(spark: SparkSession, sf_dir: str) -> Mart:
    """Two months, then everything with other values, then the first load again; January retires."""
    mart, rows = new_mart(spark), raw(spark, sf_dir)
    first = rows.where(F.col("event_timestamp") < SECOND_LOAD_FROM)
    for load in (first, resent(rows), first):
        mart.load_batch(load)
    mart.retire_months("2024-02-01", fresh_path(spark, "archive"))
    return mart


@query
def anomaly_table(spark, sf_dir):
    """The anomalies kept beside the facts, over loads, a repeated load and a retired month."""
    return stored(three_loads(spark, sf_dir).summaries.anomalies())


@query
def daily_rollup_kept(spark, sf_dir):
    """The daily report from the partial sums of the same loads."""
    return plain(three_loads(spark, sf_dir).summaries.daily_rollup())


@query
def entity_metrics_kept(spark, sf_dir):
    return plain(three_loads(spark, sf_dir).summaries.entity_metrics())


# --- quality ------------------------------------------------------------------


@query
def load_report(spark, sf_dir):
    return quality.load_report(raw(spark, sf_dir), facts(spark, sf_dir))


@query
def validate_load(spark, sf_dir):
    return new_mart(spark).load_batch(raw(spark, sf_dir, dirty=True))


@query
def dq_tables(spark, sf_dir):
    return quality.dq_tables(spark, loaded_mart(spark, sf_dir).present_tables())


@query
def dq_row_counts(spark, sf_dir):
    stream = parse.parse_messages(messages.rows_to_json(raw(spark, sf_dir)))
    accepted = stream.where(F.col("reject_reason").isNull())
    return quality.dq_row_counts(raw(spark, sf_dir), facts(spark, sf_dir), accepted, MIN_ROWS)


@query
def dq_anomalies(spark, sf_dir):
    return quality.dq_anomalies(facts(spark, sf_dir))


@query
def dq_duplicates(spark, sf_dir):
    """Counted before duplicate elimination, so that there are some."""
    return quality.dq_duplicates(transform.fact_transform(raw(spark, sf_dir)))


@query
def dq_nulls(spark, sf_dir):
    return quality.dq_nulls(facts(spark, sf_dir))


@query
def dq_date_range(spark, sf_dir):
    return quality.dq_date_range(facts(spark, sf_dir))


@query
def dq_dim_sizes(spark, sf_dir):
    rows, known = raw(spark, sf_dir), lookup.vendors(spark)
    tables = {
        "dim_event_type": lookup.event_types(spark),
        "dim_payment_method": lookup.payment_methods(spark),
        "dim_vendor": known.unionByName(dims.dim_vendor_register(rows, known)),
    }
    return quality.dq_dim_sizes(tables, dims.zone_candidates(rows))


@query
def dq_revenue(spark, sf_dir):
    return quality.dq_revenue(facts(spark, sf_dir))


@query
def dq_summary(spark, sf_dir):
    mart = loaded_mart(spark, sf_dir)
    names = ["dim_event_type", "dim_payment_method", "dim_vendor"]
    report = quality.health_report(
        spark,
        mart.present_tables(),
        mart.raw(),
        mart.fact(),
        {n: mart.dim(n) for n in names},
        mart.dim("dim_zone"),
        minimum=MIN_ROWS,
    )
    return quality.dq_summary(report)


# --- streaming ----------------------------------------------------------------


@query
def stream_parse(spark, sf_dir):
    parsed = parse.parse_messages(messages.rows_to_json(raw(spark, sf_dir, dirty=True)))
    return plain(parsed.where(F.col("reject_reason").isNull()).select(*schemas.STREAM_COLUMNS))


@query
def stream_ingest(spark, sf_dir):
    return plain(stream_rows(spark, ingested(spark, sf_dir)))


@query
def stream_dedup_state(spark, sf_dir):
    return plain(stream_rows(spark, ingested(spark, sf_dir, "state")))


@query
def stream_replay(spark, sf_dir):
    """The same messages again under a new checkpoint: nothing is added."""
    source, target = published(spark, sf_dir), fresh_path(spark, "stream")
    for _ in range(2):
        run_ingest(spark, source, target)
    return plain(stream_rows(spark, target))


@query
def stream_rejects(spark, sf_dir):
    rejects = ingest.stream_rejects(spark, ingested(spark, sf_dir))
    return rejects.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("row_count"))


@query
def stream_metrics(spark, sf_dir):
    return ingest.metrics_totals(ingest.stream_metrics(spark, ingested(spark, sf_dir)))


class OftenMerged(ingest.Ingest):
    """Two batches make a set of the key table."""

    fan, buckets = 2, 8


def merged_stream(spark: SparkSession, sf_dir: str) -> str:
    """The dirty fixture in four batches, then all of it again in two under another checkpoint; key sets and row sets are merged."""
    source, target = published(spark, sf_dir, parts=8), fresh_path(spark, "stream")
    for batches in (4, 2):
        run_ingest(spark, source, target, sink=OftenMerged, batches=batches)
    table = compaction.Compaction(spark, target)
    table.compact()
    table.sweep()
    return target


@query
def stream_compacted(spark, sf_dir):
    """The stream table after batches and a replay, merged into sets, and what was replaced deleted."""
    return plain(stream_rows(spark, merged_stream(spark, sf_dir)))


@query
def stream_keys(spark, sf_dir):
    """Every id of the key table, as often as it is stored."""
    target = merged_stream(spark, sf_dir)
    stored_ids = OftenMerged(spark, target, "reader").keys.all()
    return stored_ids.groupBy("event_id").agg(F.count(F.lit(1)).alias("row_count"))


@query
def stream_time_range(spark, sf_dir):
    """A week of the merged stream, from the months and files that hold it."""
    table = compaction.Compaction(spark, merged_stream(spark, sf_dir))
    return plain(table.between("2024-02-01", "2024-02-08").select(*schemas.STREAM_COLUMNS))


@query
def stream_counters(spark, sf_dir):
    """Counters of both modes, over all batches: taken before duplicates are dropped."""
    out = None
    for mode in ("table", "state"):
        sums = [F.sum(c).cast("long").alias(c) for c in ("received", "inserted", "skipped", "anomalies")]
        totals = ingest.stream_metrics(spark, ingested(spark, sf_dir, mode)).agg(F.lit(mode).alias("mode"), *sums)
        out = totals if out is None else out.unionAll(totals)
    return out


def copies_in_files(spark: SparkSession, sf_dir: str) -> str:
    """Every event in three of four places of one folder, each time with another value; the files' names give the order."""
    rows, path = raw(spark, sf_dir), fresh_path(spark, "messages")
    rows = rows.where("copy = 1").withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(2))))
    changed = (F.col("value").cast("decimal(10,2)") + F.col("n")).cast("decimal(10,2)").cast("string")
    # a folder for each: its part files are named in the order of its rows, and no event is in a folder twice
    rows = rows.withColumns({"value": changed, "file": (F.col("k") + F.col("n")) % 4})
    with settings(spark, PROMPT_CLEANUP):  # each of them deals the table out again
        for n in range(4):
            messages.publish_files(rows.where(F.col("file") == n), f"{path}/file={n}")
    return path


@query
def stream_first_in_order(spark, sf_dir):
    """Of copies with different values in one batch, the one whose file comes first, in both modes; later batches change nothing."""
    source, out = copies_in_files(spark, sf_dir), None
    for mode in ("table", "state"):
        target, checkpoint = fresh_path(spark, "stream"), fresh_path(spark, "checkpoint")
        for _ in range(2):  # the second time under a new checkpoint
            ingest.drain(ingest.start_ingest(messages.file_stream(spark, source), target, checkpoint, mode))
            checkpoint = fresh_path(spark, "checkpoint")
        rows = plain(stream_rows(spark, target)).select(F.lit(mode).alias("mode"), "event_id", "value")
        out = rows if out is None else out.unionAll(rows)
    return out


@query
def stream_revenue_agg(spark, sf_dir):
    """Daily windows over the ingested stream."""
    target = ingested(spark, sf_dir, sink=aggregates.RevenueSink)
    return plain(aggregates.revenue(spark, target))


class Twice(aggregates.RevenueSink):
    """Every batch is written, and written again as after a failure."""

    def write(self, batch: DataFrame, batch_id: int) -> bool:
        super().write(batch, batch_id)
        return super().write(batch, batch_id)


@query
def stream_revenue_repeated(spark, sf_dir):
    """The same revenue when every micro-batch is repeated."""
    return plain(aggregates.revenue(spark, ingested(spark, sf_dir, sink=Twice)))


@query
def freshness(spark, sf_dir):
    """Every event received up to 44 seconds late, by its zone number."""
    lag = F.make_interval(secs=(F.col("zone_id") * 7 % 45).cast("decimal(18,6)"))
    received = facts(spark, sf_dir).withColumn("received_at", F.col("event_timestamp") + lag)
    return aggregates.freshness(received, ["event_type_id"]).drop("p95_lag_seconds")


@query
def freshness_over_batches(spark, sf_dir):
    """Delays to the microsecond in three batches: stored histograms, added up, with the 95th percentile."""
    micros = F.col("zone_id").cast("long") * 7 % 45 * 1_000_000 + F.col("entity_id") % 1000
    rows = facts(spark, sf_dir).withColumn("received_at", F.timestamp_micros(F.unix_micros("event_timestamp") + micros))
    path = fresh_path(spark, "freshness")
    for n in range(3):
        part = rows.where(F.crc32("event_id") % 3 == n)
        aggregates.lag_parts(part, ["event_type_id"]).write.parquet(f"{path}/batch={n}")
    return aggregates.merged_freshness(spark.read.parquet(path), ["event_type_id"])


@query
def dual_sink(spark, sf_dir):
    """Rows and revenue of the operational and of the analytical copy."""
    target = ingested(spark, sf_dir, sink=aggregates.DualSink)
    copies = [
        ("operational", stream_rows(spark, target)),
        ("analytical", aggregates.analytical_events(spark, target)),
    ]
    month = access.month_of(F.col("event_timestamp")).alias("month")
    parts = [
        df.groupBy(F.lit(n).alias("copy"), month).agg(
            F.count(F.lit(1)).alias("row_count"), F.sum("total_value").alias("total_value")
        )
        for n, df in copies
    ]
    return plain(parts[0].unionAll(parts[1]))


@query
def unified_events(spark, sf_dir):
    """Batch facts of the clean rows and stream rows of the dirty ones."""
    stream = stream_rows(spark, ingested(spark, sf_dir))
    return plain(unify.unified_events(loaded_mart(spark, sf_dir).fact(), stream, stream.count()))


@query
def unified_table(spark, sf_dir):
    """The stored union in two orders of arrival: the stream first and the facts in two loads, with merges in between, one of them repeated; facts first."""
    out = None
    for order in ("stream first", "facts first"):
        mart, rows, source = new_mart(spark), raw(spark, sf_dir), published(spark, sf_dir)
        table = unify.UnifiedTable(mart)
        if order == "facts first":
            mart.load_batch(rows)
            table.merge()
        run_ingest(spark, source, mart.root)
        run_ingest(spark, source, mart.root)  # under another checkpoint: nothing new
        table.merge()
        if order == "stream first":
            mart.load_batch(rows.where("k % 2 = 0"), load_id="even")
            table.merge()
            table.merge()
            mart.load_batch(rows.where("k % 2 = 1"), load_id="odd")
        table.sweep()
        found = plain(table.events()).select(F.lit(order).alias("arrival"), "*")
        out = found if out is None else out.unionAll(found)
    return out

"""Tables kept beside the facts, loads that are cut short, the exchange of zones, and histograms of delays."""

from __future__ import annotations

import gzip
import json
import random

import pytest
from conftest import row, uuid_of
from pyspark.sql import functions as F

from eventmart import schemas
from eventmart.operators import access, storage
from eventmart.plans import analytics
from eventmart.plans.mart import Mart
from eventmart.plans.summaries import Summaries
from eventmart.session import fresh_path
from eventmart.sources import files
from eventmart.streaming import aggregates, ingest, parse


def agree(mart: Mart) -> None:
    """What is kept equals what the facts give."""
    fact = mart.fact()
    pairs = [
        (mart.summaries.anomalies().select(*schemas.FACT_SCHEMA.names), access.anomaly_scan(fact).select(*schemas.FACT_SCHEMA.names)),
        (mart.summaries.daily_rollup(), analytics.daily_rollup(fact)),
        (mart.summaries.entity_metrics(), analytics.entity_metrics(fact)),
    ]
    for kept, made in pairs:
        assert sorted(kept.collect(), key=str) == sorted(made.collect(), key=str)


@pytest.fixture
def rows(raw_rows):
    def make(numbers, **changes):
        return raw_rows([row(n, event_timestamp=f"2024-{10 + n % 3}-0{1 + n % 9} 10:00:00", entity_id=str(n % 4), total_value=str(n - 3), **changes) for n in numbers])

    return make


def test_loads_repeats_and_retired_months(spark, rows):
    mart = Mart(spark, fresh_path(spark, "mart"))
    for numbers in (range(6), range(4, 14), range(6)):
        mart.load_batch(rows(numbers))
        agree(mart)
    assert mart.retire_months("2024-11-01", fresh_path(spark, "archive")) == ["2024-10-01"]
    agree(mart)
    assert not storage.exists(spark, mart.path("summary_daily/event_month=2024-10-01"))
    agree(Mart(spark, mart.root))


@pytest.mark.parametrize("after", ["facts", "some tables"])
def test_a_load_cut_short_is_finished_by_the_next_one(spark, rows, monkeypatch, after):
    mart = Mart(spark, fresh_path(spark, "mart"))
    mart.load_batch(rows(range(5)))
    write = Summaries._write

    def dies(self, new, load):
        if after == "some tables":
            write(self, new.where("event_month = DATE'2024-11-01'"), load)
        raise RuntimeError("gone")

    with monkeypatch.context() as m:
        m.setattr(Summaries, "_write", dies)
        with pytest.raises(RuntimeError):
            mart.load_batch(rows(range(3, 12)))
    assert mart.fact().count() == 12
    mart.load_batch(rows(range(3, 12)))
    agree(mart)
    assert storage.children(spark, mart.path("pending_loads")) == ["summaries.txt"]


def test_a_folder_without_tables_gets_them(spark, rows):
    mart = Mart(spark, fresh_path(spark, "mart"))
    mart.load_batch(rows(range(9)))
    for name in ("summary_anomalies", "summary_daily", "summary_entities", "pending_loads"):
        storage.delete(spark, mart.path(name))
    agree(Mart(spark, mart.root))


def test_a_load_reads_only_its_months(spark, rows):
    mart = Mart(spark, fresh_path(spark, "mart"))
    mart.load_batch(rows(range(9)))
    fact = mart.fact().where(F.col("event_month").isin([F.lit("2024-10-01").cast("date")]) & (F.col("ingested_at") == F.timestamp_micros(F.lit(1))))
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ingested_at)" in plan
    assert "event_month" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_the_repair_runs_only_for_unknown_months(spark, rows, monkeypatch):
    mart = Mart(spark, fresh_path(spark, "mart"))
    mart.load_batch(rows(range(9)))
    asked = []
    sql = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, q, *a, **b: (asked.append(q), sql(self, q, *a, **b))[1])
    mart.load_batch(rows(range(5, 12)))
    assert not [q for q in asked if "REPAIR" in q]


@pytest.mark.parametrize("step", ["delete", "rename"])
def test_zone_names_survive_a_job_that_dies(spark, rows, monkeypatch, step):
    mart = Mart(spark, fresh_path(spark, "mart"))
    mart.load_batch(rows(range(3)))
    zones = {r.zone_id for r in mart.dim("dim_zone").collect()}
    names = mart.dim("dim_zone").select("zone_id", F.lit("named").alias("zone_name"))

    def dies(*_):
        raise RuntimeError("gone")

    with monkeypatch.context() as m:
        m.setattr(storage, step, dies)
        with pytest.raises(RuntimeError):
            mart.name_zones(names)
    again = {r.zone_id: r.zone_name for r in Mart(spark, mart.root).dim("dim_zone").collect()}
    assert again == dict.fromkeys(zones, "named")


def test_compressed_files_by_name(spark, tmp_path):
    names = list(reversed(schemas.RAW_COLUMNS))
    with gzip.open(tmp_path / "a.csv.gz", "wt") as out:
        out.write(",".join(names) + "\n" + ",".join(row(1)[c] for c in names) + "\n")
    got = files.csv_scan_by_name(spark, str(tmp_path)).collect()
    assert [{c: r[c] for c in schemas.RAW_COLUMNS} for r in got] == [row(1)]


def test_a_header_without_known_names_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    with pytest.raises(ValueError, match="no known column"):
        files.csv_scan_by_name(spark, str(tmp_path))


def test_percentile_of_added_histograms(spark):
    rng = random.Random(2)
    lags = [(g, int(10 ** rng.uniform(0, 9))) for g in "ab" for _ in range(300)] + [("c", 0), ("c", -5), ("d", 127), ("d", 128)]
    events = spark.createDataFrame(lags, "event_type string, lag long").select(
        "event_type", F.timestamp_micros(F.lit(10**15)).alias("event_timestamp"), F.timestamp_micros(F.lit(10**15) + F.col("lag")).alias("received_at")
    )
    parts = [aggregates.lag_parts(events.where(F.col("lag") % 3 == k), ["event_type"]) for k in (-2, 0, 1, 2)]
    merged = aggregates.merged_freshness(parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3]), ["event_type"])
    got = {r.event_type: r for r in merged.collect()}
    for g in "abcd":
        own = sorted(x for h, x in lags if h == g)
        exact = max(0, own[-(-95 * len(own) // 100) - 1])
        assert got[g].row_count == len(own) and got[g].max_lag_seconds == own[-1] / 1e6
        assert exact <= round(got[g].p95_lag_seconds * 1e6) <= exact * (1 + 1 / 64)
        assert got[g].within_target == sum(x <= 30_000_000 for x in own)


def test_freshness_of_the_stream_when_batches_repeat(spark):
    target = fresh_path(spark, "stream")
    sink = aggregates.FreshnessSink(spark, target, "a")
    for b in range(2):
        lines = [(json.dumps(row(10 * b + i)), "f", 0, i) for i in range(3)]
        batch = parse.parse_messages(spark.createDataFrame(lines, "value string, source_file string, source_block long, source_row long"))
        sink(batch, b)
        sink(batch, b)
    got = aggregates.stream_freshness(spark, target).collect()
    assert [(r.event_type, r.row_count, r.within_target) for r in got] == [("standard", 6, 0)] and got[0].p95_lag_seconds >= got[0].max_lag_seconds * 0.9
    assert {r.event_id for r in ingest.stream_events(spark, target).collect()} == {uuid_of(n) for n in (0, 1, 2, 10, 11, 12)}

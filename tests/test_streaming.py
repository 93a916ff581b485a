"""Stream parsing, uniqueness, replay and the outputs downstream."""

from __future__ import annotations

import json
from decimal import Decimal

import pytest
from conftest import row, uuid_of
from pyspark.sql import functions as F

from eventmart import schemas
from eventmart.operators import dedup, lookup, transform
from eventmart.plans import unify
from eventmart.session import fresh_path
from eventmart.sources import messages
from eventmart.streaming import aggregates, ingest, parse


def parsed(spark, lines: list[str | None]) -> dict:
    df = spark.createDataFrame([(t, str(i)) for i, t in enumerate(lines)], "value string, source_file string")
    return {int(r.source_file): r for r in parse.parse_messages(df).collect()}


def message(n: int, **changes) -> str:
    return json.dumps({k: v or "" for k, v in row(n, **changes).items()})


@pytest.fixture
def topic(spark, tmp_path):
    """A folder of message files; returns a function that adds one file."""
    folder = tmp_path / "topic"
    folder.mkdir()

    def add(name: str, lines: list[str]) -> str:
        (folder / name).write_text("\n".join(lines) + "\n")
        return str(folder)

    return add


def run(spark, source: str, target: str, checkpoint: str, mode: str = "table", sink=ingest.Ingest) -> None:
    stream = messages.file_stream(spark, source, max_files=1)
    ingest.drain(ingest.start_ingest(stream, target, checkpoint, mode, sink=sink))


def values(spark, target: str) -> dict:
    rows = ingest.stream_events(spark, target).collect()
    assert len(rows) == len({r.event_id for r in rows})
    return {r.event_id: float(r.value) for r in rows}


def test_reject_reasons(spark):
    null_id = json.dumps(row(1) | {"event_id": None})
    no_id = json.dumps({k: v for k, v in row(1).items() if k != "event_id"})
    lines = [
        "not json", "[1]", "null", "", None, null_id, no_id, message(1, event_id="x"), message(1, event_timestamp="noon"),
        message(1, entity_id="None"), message(1, vendor_id="70000"), message(1, value="nan"), message(1),
    ]
    rows = parsed(spark, lines)
    assert [rows[i].reject_reason for i in range(len(lines))] == ["malformed_message"] * 5 + ["bad_event_id"] * 3 + [
        "bad_timestamp",
        "bad_entity_id",
        "out_of_range_vendor_id",
        "out_of_range_value",
        None,
    ]


def test_lenient_values(spark):
    got = parsed(
        spark,
        [
            message(
                1,
                event_id=f" {uuid_of(1).upper()}\t",
                event_type="\tBulk ",
                payment_method=" ",
                zone_id="3.9",
                rate_type="99",
                duration="-5",
                passenger_count="1.5",
                value="junk",
                total_value="-0.004",
            )
        ],
    )[0]
    assert got.reject_reason is None
    assert (got.event_id, got.event_type, got.payment_method) == (uuid_of(1), "bulk", None)
    assert (got.zone_id, got.rate_type, got.duration_seconds, got.passenger_count) == (3, 99, -5, 1)
    assert (got.value, got.total_value, got.is_anomaly) == (None, Decimal("0.00"), False)


def test_missing_total_is_no_anomaly(spark):
    got = parsed(spark, [message(1, total_value=""), message(2, total_value="-0.01")])
    assert (got[0].is_anomaly, got[1].is_anomaly) == (False, True)


def test_batch_and_stream_agree_on_plain_rows(spark, raw_rows):
    raw = raw_rows([row(i, event_type=t) for i, t in enumerate(["standard", " BULK ", "mystery"])])
    batch = transform.fact_transform(raw).select(*schemas.FACT_COLUMNS)
    stream = parse.parse_messages(messages.rows_to_json(raw))
    assert sorted(unify.stream_as_facts(stream).collect()) == sorted(batch.collect())


def test_messages_hold_fourteen_strings(raw_rows):
    got = messages.rows_to_json(raw_rows([row(1, zone_id=None)])).first()
    assert json.loads(got.value) == row(1, zone_id="") and got.key == uuid_of(1)


@pytest.mark.parametrize("mode", ["table", "state"])
def test_uniqueness_within_across_and_after_replay(spark, topic, mode):
    target, checkpoint = fresh_path(spark, "stream"), fresh_path(spark, "checkpoint")
    source = topic("1.json", [message(1, value="1"), message(2, value="1"), message(1, value="9"), "junk"])
    run(spark, source, target, checkpoint, mode)
    topic("2.json", [message(2, value="9"), message(3, value="2", total_value="-3")])
    run(spark, source, target, checkpoint, mode)  # same checkpoint: the new file only
    want = {uuid_of(1): 1.0, uuid_of(2): 1.0, uuid_of(3): 2.0}
    assert values(spark, target) == want
    run(spark, source, target, fresh_path(spark, "checkpoint"), mode)  # everything again
    assert values(spark, target) == want
    totals = ingest.metrics_totals(ingest.stream_metrics(spark, target)).first()
    assert (totals.inserted, totals.skipped) == (3, 2)
    rejects = ingest.stream_rejects(spark, target).collect()
    assert [(r.reject_reason, r.message) for r in rejects] == [("malformed_message", "junk")] * 2


@pytest.mark.parametrize("mode", ["table", "state"])
def test_equal_rejects_are_all_kept(spark, topic, mode):
    target = fresh_path(spark, "stream")
    run(spark, topic("1.json", ["junk"] * 5 + [message(1)]), target, fresh_path(spark, "checkpoint"), mode)
    assert ingest.stream_rejects(spark, target).count() == 5


def test_repeated_batch_replaces_itself(spark, topic):
    """A batch that was written but not committed is run again."""
    target = fresh_path(spark, "stream")
    topic_path = topic("1.json", [message(1), message(2), "junk"])
    batch = parse.parse_messages(
        spark.read.text(topic_path).select(
            "value", F.lit("f").alias("source_file"), F.lit(0).alias("source_block"), F.lit(None).cast("long").alias("source_row")
        )
    )
    sink = ingest.Ingest(spark, target, "run1")
    for _ in range(2):
        sink(batch, 0)
        assert set(values(spark, target)) == {uuid_of(1), uuid_of(2)}
        assert ingest.stream_rejects(spark, target).count() == 1
    sink(batch, 1)  # the next batch brings the same ids
    assert set(values(spark, target)) == {uuid_of(1), uuid_of(2)}


def test_dual_sink_keeps_both_copies_equal(spark, topic):
    target = fresh_path(spark, "stream")
    source = topic("1.json", [message(1), message(1), message(2, event_timestamp="2024-11-02")])
    topic("2.json", [message(2), message(3), "junk"])
    run(spark, source, target, fresh_path(spark, "checkpoint"), sink=aggregates.DualSink)
    copy = aggregates.analytical_events(spark, target)
    assert sorted(r.event_id for r in copy.collect()) == sorted(values(spark, target))
    assert {str(r.event_month) for r in copy.collect()} == {"2024-10-01", "2024-11-01"}


class Twice(aggregates.RevenueSink):
    def write(self, batch, batch_id):
        super().write(batch, batch_id)
        return super().write(batch, batch_id)


@pytest.mark.parametrize("sink", [aggregates.RevenueSink, Twice])
def test_windowed_revenue_over_several_batches(spark, topic, sink):
    """Also when every batch is written twice; the late event of the second batch counts too."""
    target, checkpoint = fresh_path(spark, "stream"), fresh_path(spark, "checkpoint")
    source = topic("1.json", [message(1), message(2, total_value="-5"), message(3, event_type="bulk")])
    run(spark, source, target, checkpoint, sink=sink)
    topic("2.json", [message(4, total_value="1.50"), message(5, event_timestamp="2024-10-02"), message(6, event_timestamp="2020-01-01"), message(1)])
    run(spark, source, target, checkpoint, sink=sink)
    got = {(str(r.window_start)[:10], r.event_type): (r.total_events, r.gross_revenue) for r in aggregates.revenue(spark, target).collect()}
    assert got == {
        ("2024-10-01", "standard"): (3, Decimal("12.50")),
        ("2024-10-01", "bulk"): (1, Decimal("11.00")),
        ("2024-10-02", "standard"): (1, Decimal("11.00")),
        ("2020-01-01", "standard"): (1, Decimal("11.00")),
    }


def test_files_of_a_batch_do_not_narrow_the_join_with_the_history(spark):
    new, history = (spark.range(100).select(F.col("id").cast("string").alias("event_id")) for _ in range(2))
    fresh = dedup.absent_rows(new, history, key_count=10_000_000)
    plan = ingest.Ingest.sized(fresh, 2 * ingest.ROWS_PER_FILE)._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce" not in plan
    assert plan.index("RoundRobinPartitioning(3)") < plan.index("Join")


def test_sinks_without_success_markers(spark, topic):
    """Both copies are written where no marker files are."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        target = fresh_path(spark, "stream")
        run(spark, topic("1.json", [message(1)]), target, fresh_path(spark, "checkpoint"), sink=aggregates.DualSink)
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert aggregates.analytical_events(spark, target).count() == 1


def test_freshness(spark):
    rows = [("a", 5.0), ("a", 30.9), ("b", 30.0)]
    events = spark.createDataFrame(rows, "g string, lag double").select(
        "g",
        F.timestamp_seconds(F.lit(1_000_000)).alias("event_timestamp"),
        F.timestamp_micros(F.lit(1_000_000_000_000) + (F.col("lag") * 1_000_000).cast("long")).alias("received_at"),
    )
    got = {r.g: (r.row_count, r.max_lag_seconds, r.within_target) for r in aggregates.freshness(events, ["g"]).collect()}
    assert got == {"a": (2, 30.9, 1), "b": (1, 30.0, 1)}


def test_unified_takes_the_batch_side_first(spark, raw_rows):
    fact = transform.fact_transform(raw_rows([row(1, value="1.00")])).select(*schemas.FACT_COLUMNS)
    stream = parse.parse_messages(
        messages.rows_to_json(raw_rows([row(1, value="9.00"), row(2, value="2.00", event_type="?")]))
    )
    got = {r.event_id: (float(r.value), r.event_type_id) for r in unify.unified_events(fact, stream).collect()}
    assert got == {uuid_of(1): (1.0, 1), uuid_of(2): (2.0, None)}


def test_lookup_of_names_is_a_broadcast(raw_rows):
    plan = lookup.fk_lookup(raw_rows([row(1)]))._jdf.queryExecution().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan


def test_kafka_is_only_an_option(spark):
    """The source is built by name; without its package Spark says so."""
    with pytest.raises(Exception, match="kafka"):
        messages.kafka_stream(spark, "events", "localhost:9092", max_offsets=200)

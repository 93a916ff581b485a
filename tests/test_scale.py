"""Tasks and files that follow the rows: no step leaves the work to a few of them."""

from __future__ import annotations

import time

import pytest
from conftest import SF_DIR, row, uuid_of
from pyspark.sql import functions as F

from eventmart.operators import storage
from eventmart.session import PROMPT_CLEANUP, fresh_path
from eventmart.sources import messages
from eventmart.streaming import compaction, ingest, keys, parse
from parity import fixture, queries


@pytest.fixture
def small_tasks(monkeypatch):
    monkeypatch.setattr(fixture, "ROWS_PER_TASK", 100)


def test_a_filter_on_the_reason_does_not_repeat_the_parse(spark, raw_rows):
    parsed = parse.parse_messages(messages.rows_to_json(raw_rows([row(1), row(2, entity_id="None")])))
    good = parsed.where(F.col("reject_reason").isNull())
    assert [r.event_id for r in good.collect()] == [uuid_of(1)]
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_raw_rows_are_spread_over_tasks(spark, small_tasks):
    rows = queries.raw(spark, SF_DIR)
    assert rows.select(F.spark_partition_id()).distinct().count() == fixture.tasks(spark, SF_DIR) > 5


def test_message_files_follow_the_rows(spark, small_tasks):
    found = storage.files(spark, queries.published(spark, SF_DIR))
    assert len(found) >= fixture.tasks(spark, SF_DIR)
    places = storage.files(spark, queries.copies_in_files(spark, SF_DIR))
    assert len([f for f in places if "/file=0/" in f]) > 1


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_message_files_are_compressed(spark):
    path = fresh_path(spark, "messages")
    messages.publish_files(queries.raw(spark, SF_DIR), path)
    text = spark.read.text(path)
    assert text.count() == queries.raw(spark, SF_DIR).count()
    chars = text.agg(F.sum(F.octet_length("value"))).first()[0]
    assert sum(storage._fs(spark, f)[0].getFileStatus(storage._fs(spark, f)[1]).getLen() for f in storage.files(spark, path)) < chars / 4


def test_shuffle_files_of_an_ingest_go_with_its_statements(spark):
    """They would lie on the executors' disks until the driver collects its garbage."""
    before, held = shuffle_files(spark), []

    class Sink(ingest.Ingest):
        def write(self, batch, batch_id):
            held.extend(s.conf.get(name) for s in (batch.sparkSession, self.spark) for name in PROMPT_CLEANUP)
            return super().write(batch, batch_id)

    source, target = queries.copies_in_files(spark, SF_DIR), fresh_path(spark, "stream")
    ingest.drain(ingest.start_ingest(messages.file_stream(spark, source), target, fresh_path(spark, "checkpoint"), sink=Sink))
    assert held == ["true", "true"]
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:  # they go in the background
        time.sleep(0.2)
    assert not left


def test_batches_of_a_run_do_not_follow_the_files(spark, small_tasks):
    target = queries.ingested(spark, SF_DIR)
    assert ingest.stream_metrics(spark, target).count() == 2


def test_a_large_bucket_of_ids_is_several_files(spark, monkeypatch):
    monkeypatch.setattr(keys, "ROWS_PER_FILE", 50)
    table = keys.KeyTable(spark, fresh_path(spark, "stream"), buckets=2, fan=2)
    numbers = range(600)
    for b in range(3):
        part = [(uuid_of(n),) for n in numbers if n % 3 == b]
        table.add(spark.createDataFrame(part, "event_id string"), len(part), "run", b)
    assert table.roll_up()
    made = table.versions.current().sets[0]
    sizes = table.bucketed([made]).groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in sizes) <= 100
    assert sorted(r.event_id for r in table.all().collect()) == sorted(uuid_of(n) for n in numbers)
    asked = spark.createDataFrame([(uuid_of(n),) for n in range(590, 610)], "event_id string")
    found = {r.event_id for r in table.candidates(asked, 20, "run", 3).collect()}
    assert {uuid_of(n) for n in range(590, 600)} <= found


def test_a_task_of_compaction_sorts_a_bounded_stretch():
    assert compaction.ROWS_PER_FILE <= 1_000_000


def test_the_text_of_a_message_is_kept_for_rejects_only(spark, raw_rows):
    held = []

    class Sink(ingest.Ingest):
        def write(self, batch, batch_id):
            held.extend((r.reject_reason, r.message is None) for r in batch.collect())
            return super().write(batch, batch_id)

    target = fresh_path(spark, "stream")
    rows = messages.rows_to_json(raw_rows([row(1), row(2, entity_id="None")])).withColumns(
        {"source_file": F.lit("f"), "source_block": F.lit(0), "source_row": F.monotonically_increasing_id()}
    )
    Sink(spark, target, "a")(parse.parse_messages(rows), 0)
    assert sorted(held, key=str) == [("bad_entity_id", False), (None, True)]
    assert '"entity_id":"None"' in ingest.stream_rejects(spark, target).first().message

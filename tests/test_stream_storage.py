"""The key table of the stream, compaction, reads by time, and the order in which copies win."""

from __future__ import annotations

import json

import pytest
from conftest import row, uuid_of
from pyspark.sql import functions as F

from eventmart import schemas
from eventmart.operators import storage, versions
from eventmart.session import fresh_path
from eventmart.sources import messages
from eventmart.streaming import compaction, ingest, keys, parse


def ids(spark, numbers):
    return spark.createDataFrame([(uuid_of(n),) for n in numbers], "event_id string")


def found(df) -> set[str]:
    return set() if df is None else {r.event_id for r in df.collect()}


def batch(spark, rows: list[dict]):
    """Parsed messages, in the order given."""
    lines = [(json.dumps({k: v or "" for k, v in r.items()}), "f", 0, i) for i, r in enumerate(rows)]
    return parse.parse_messages(spark.createDataFrame(lines, "value string, source_file string, source_block long, source_row long"))


def stored(spark, target: str) -> dict[str, float]:
    rows = ingest.stream_events(spark, target).collect()
    assert len(rows) == len({r.event_id for r in rows})
    return {r.event_id: float(r.value) for r in rows}


def test_bits_of_a_bitmap(spark):
    places = [0, 1, 7, 8, 13, 255, 32_766, 32_767]
    bits = spark.createDataFrame([(p,) for p in places], "p long").agg(F.bitmap_construct_agg("p").alias("m"))
    asked = spark.range(0, 32_768).select(F.col("id").cast("int").alias("at"))
    assert [r.at for r in asked.join(F.broadcast(bits)).where(keys.bit("m", F.col("at"))).orderBy("at").collect()] == places


def test_many_batches_become_few_sets_and_no_id_is_lost(spark):
    target = fresh_path(spark, "stream")
    table = keys.KeyTable(spark, target, buckets=8, fan=3)
    for b in range(14):
        table.add(ids(spark, range(b * 10, b * 10 + 10)), 10, "run", b)
        table.roll_up()
    state = table.versions.current()
    assert {s["level"] for s in state.sets} == {1, 2} and len(state.sets) <= 4
    assert len(versions.batches(spark, table.table)["run"]) <= 3  # the rest was merged and deleted
    assert sorted(r.event_id for r in table.all().collect()) == sorted(uuid_of(n) for n in range(140))
    asked = ids(spark, [*range(0, 140, 7), *range(1_000, 1_020)])
    assert {uuid_of(n) for n in range(0, 140, 7)} <= found(table.candidates(asked, 40, "run", 14))


def test_new_ids_open_no_bucket_and_no_event(spark):
    target = fresh_path(spark, "stream")
    table = keys.KeyTable(spark, target, buckets=16, fan=2)
    for b in range(3):
        table.add(ids(spark, range(b * 500, b * 500 + 500)), 500, "run", b)
    assert table.roll_up()
    sets = table.versions.current().sets
    new = ids(spark, range(10_000, 10_500))
    by_chance = sum(len(h) for _, h in table.hits(sets, new, 500))
    assert by_chance <= 6  # of 500 ids, each once in some 600
    assert len(table.hits(sets, ids(spark, [1]), 1)[0][1]) == 1  # a stored id opens its own bucket
    opened = table.candidates(ids(spark, [1]), 1, "run", 3).inputFiles()
    assert opened and all("/stream_keys/" in f or "/stream_key_sets/" in f for f in opened)
    assert sum("bucket=" in f for f in opened) == 1


def test_ids_of_the_batch_itself_do_not_count(spark):
    table = keys.KeyTable(spark, fresh_path(spark, "stream"))
    table.add(ids(spark, [1, 2]), 2, "run", 0)
    assert table.candidates(ids(spark, [1]), 1, "run", 0) is None
    assert found(table.candidates(ids(spark, [1]), 1, "run", 1)) == found(table.candidates(ids(spark, [1]), 1, "other", 0)) == {uuid_of(1), uuid_of(2)}


def test_ids_of_a_batch_that_died_are_added(spark):
    """Events were written, ids were not; another run comes first."""
    target = fresh_path(spark, "stream")
    ingest.Ingest(spark, target, "a")(batch(spark, [row(1), row(2)]), 0)
    storage.delete(spark, f"{target}/stream_keys/run_id=a/batch_id=0")
    ingest.Ingest(spark, target, "b")(batch(spark, [row(2, value="9"), row(3)]), 0)
    assert stored(spark, target) == {uuid_of(1): 10, uuid_of(2): 10, uuid_of(3): 10}


def test_long_history_in_small_sets(spark):
    """Replays, repeats and new ids while batches are merged underneath."""

    class Small(ingest.Ingest):
        fan, buckets = 2, 4

    target = fresh_path(spark, "stream")
    for run in ("a", "b"):
        sink = Small(spark, target, run)
        for b in range(5):
            rows = batch(spark, [row(n, value=str(b + 1)) for n in range(b, b + 4)])
            sink(rows, b)
            sink(rows, b)
    assert stored(spark, target) == {uuid_of(n): max(1, n - 2) for n in range(8)}


@pytest.fixture
def history(spark) -> str:
    """Five batches of three days and one hour each."""
    target = fresh_path(spark, "stream")
    sink = ingest.Ingest(spark, target, "a")
    for b in range(5):
        days = [f"2024-{10 + b // 2}-{1 + 7 * (b % 2) + d:02d} 0{b}:00:00" for d in range(3)]
        sink(batch(spark, [row(10 * b + i, event_timestamp=t) for i, t in enumerate(days)]), b)
    return target


def test_compaction_changes_no_row(spark, history):
    before, table = stored(spark, history), compaction.Compaction(spark, history, fan=2)
    assert table.compact() and len(table.versions.current().sets) == 1
    assert stored(spark, history) == before
    assert table.sweep() == 4  # four batches; the last one may be repeated
    assert stored(spark, history) == before and not table.compact()
    sink = ingest.Ingest(spark, history, "a")
    sink(batch(spark, [row(40), row(41), row(42)]), 4)  # repeated, and replaced
    for b in (5, 6):
        sink(batch(spark, [row(10 * b), row(1)]), b)
    assert table.compact() and [s["level"] for s in table.versions.current().sets] == [2]
    table.sweep()
    assert set(stored(spark, history)) == {uuid_of(10 * b + i) for b in range(5) for i in range(3)} | {uuid_of(50), uuid_of(60)}


def test_compaction_that_dies_leaves_the_old_rows(spark, history, monkeypatch):
    before, table = stored(spark, history), compaction.Compaction(spark, history)

    def dies(*_):
        raise RuntimeError("gone")

    with monkeypatch.context() as m:
        m.setattr(versions.Versions, "publish", dies)
        with pytest.raises(RuntimeError):
            table.compact()
    assert len(storage.children(spark, table.sets)) == 1 and stored(spark, history) == before
    assert table.compact()
    assert stored(spark, history) == before
    assert table.sweep() == 5 and stored(spark, history) == before  # four batches and the lost set


def test_a_reader_keeps_its_version_until_the_sweep(spark, history):
    table = compaction.Compaction(spark, history)
    old = ingest.stream_events(spark, history)
    table.compact()
    assert old.count() == 15 == ingest.stream_events(spark, history).count()


def test_a_second_writer_fails(spark, monkeypatch):
    one = versions.Versions(spark, f"{fresh_path(spark, 'list')}/v")
    monkeypatch.setattr(versions.Versions, "_numbers", lambda self: [])
    one.publish(versions.State())
    with pytest.raises(FileExistsError):
        one.publish(versions.State())


def test_reads_by_time_open_months_and_files_in_range(spark, history, monkeypatch):
    monkeypatch.setattr(compaction, "ROWS_PER_FILE", 2)
    table = compaction.Compaction(spark, history)
    table.compact()
    table.sweep()
    got = table.between("2024-10-08", "2024-10-09 02:00:00")
    assert sorted(r.event_id for r in got.collect()) == sorted(uuid_of(n) for n in (10, 11))
    sets = [f for f in got.inputFiles() if "/stream_sets/" in f]
    every = [f for f in ingest.stream_events(spark, history).inputFiles() if "/stream_sets/" in f]
    assert sets and len(sets) < len(every) and all("event_month=2024-10-01" in f for f in sets)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_month" in plan and "GreaterThanOrEqual(event_timestamp" in plan
    assert table.between("2030-01-01", "2031-01-01").count() == 0
    assert compaction.Compaction(spark, fresh_path(spark, "none")).between("2024-01-01", "2025-01-01").count() == 0


@pytest.mark.parametrize("mode", ["table", "state"])
def test_the_first_copy_in_order_wins(spark, tmp_path, mode):
    """Copies with other values within a file, in other files of the batch, and in later batches."""
    source, target, checkpoint = tmp_path / "topic", fresh_path(spark, "stream"), fresh_path(spark, "checkpoint")
    source.mkdir()

    def put(name: str, *pairs: tuple[int, str]) -> None:
        (source / name).write_text("\n".join(json.dumps({k: v or "" for k, v in row(n, value=v).items()}) for n, v in pairs) + "\n")

    put("b.json", (1, "4"), (2, "5"), (3, "6"), (3, "7"))
    put("a.json", (1, "1"), (1, "2"), *[(9, str(i)) for i in range(1, 200)])
    for name in ("c.json", "d.json"):
        put(name, (2, "8"), (4, "9"))
    stream = messages.file_stream(spark, str(source))
    ingest.drain(ingest.start_ingest(stream, target, checkpoint, mode))
    put("0.json", (1, "70"), (2, "80"), (5, "90"))
    ingest.drain(ingest.start_ingest(messages.file_stream(spark, str(source)), target, checkpoint, mode))
    assert stored(spark, target) == {uuid_of(1): 1, uuid_of(2): 5, uuid_of(3): 6, uuid_of(4): 9, uuid_of(9): 1, uuid_of(5): 90}
    totals = ingest.stream_metrics(spark, target).agg(F.sum("received"), F.sum("inserted"), F.sum("skipped"), F.sum("anomalies")).first()
    assert tuple(totals) == (4 + 201 + 4 + 3, 6, 0, 0)


def test_files_of_a_batch_are_stretches_of_time(spark, monkeypatch):
    monkeypatch.setattr(ingest, "ROWS_PER_FILE", 10)
    target = fresh_path(spark, "stream")
    rows = [row(n, event_timestamp=f"2024-10-{1 + n % 28:02d}") for n in range(60)]
    ingest.Ingest(spark, target, "a")(batch(spark, rows), 0)
    events = spark.read.schema(schemas.nullable(schemas.STORED_STREAM_SCHEMA)).parquet(f"{target}/streaming_events")
    times = events.groupBy(F.input_file_name()).agg(F.min("event_timestamp").alias("a"), F.max("event_timestamp").alias("b")).orderBy("a").collect()
    assert len(times) > 3 and all(x.b <= y.a for x, y in zip(times, times[1:], strict=False))

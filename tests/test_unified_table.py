"""The stored union of facts and stream: arrival in any order, merges that die, and what is written again."""

from __future__ import annotations

import json

import pytest
from conftest import row, uuid_of

from eventmart.operators import storage, versions
from eventmart.plans import unify
from eventmart.plans.mart import Mart
from eventmart.session import fresh_path
from eventmart.streaming import compaction, ingest, parse


@pytest.fixture
def mart(spark):
    return Mart(spark, fresh_path(spark, "mart"), buckets=4)


def messages(spark, numbers, value: str):
    lines = [(json.dumps({k: v or "" for k, v in row(n, value=value).items()}), "f", 0, n) for n in numbers]
    return parse.parse_messages(spark.createDataFrame(lines, "value string, source_file string, source_block long, source_row long"))


def values(table: unify.UnifiedTable) -> dict[str, float]:
    rows = table.events().collect()
    assert len(rows) == len({r.event_id for r in rows})
    return {r.event_id: float(r.value) for r in rows}


def want(batch, stream) -> dict[str, float]:
    return {uuid_of(n): 2.0 for n in stream} | {uuid_of(n): 1.0 for n in batch}


def test_nothing_yet(mart):
    table = unify.UnifiedTable(mart)
    assert table.merge() == [] and values(table) == {} and table.sweep() == 0


def test_a_batch_row_takes_a_stream_row_s_place_whenever_it_comes(spark, mart, raw_rows):
    table, sink = unify.UnifiedTable(mart), ingest.Ingest(spark, mart.root, "run")
    load = lambda numbers, name: mart.load_batch(raw_rows([row(n, value="1.00") for n in numbers], name))
    load(range(0, 10), "a")
    for b in range(4):
        sink(messages(spark, range(b * 10, b * 10 + 10), "2.00"), b)
        assert values(table) == want(range(10), range(b * 10 + 10))
    assert table.merge() == []  # batches 0 to 2; the last one may be repeated
    assert table.versions.current().covered["run"] == 2
    assert values(table) == want(range(10), range(40))
    load([12], "b")
    assert values(table) == want([*range(10), 12], range(40))
    kept = table._folders(table.versions.current())
    assert len(table.merge()) == 1  # only the bucket of the row that was replaced
    now = table._folders(table.versions.current())
    assert len(set(kept) - set(now)) == 1 and len(set(now) - set(kept)) == 1
    assert values(table) == want([*range(10), 12], range(40))
    assert table.merge() == [] and table.sweep() == 1
    sink(messages(spark, range(30, 40), "2.00"), 3)  # repeated, as after a failure
    sink(messages(spark, range(40, 50), "2.00"), 4)
    load(range(35, 60), "c")
    assert values(table) == want([*range(10), 12, *range(35, 60)], range(50))
    table.merge()
    assert values(table) == want([*range(10), 12, *range(35, 60)], range(50))


def test_a_merge_that_dies_changes_nothing_and_is_run_again(spark, mart, raw_rows, monkeypatch):
    table, sink = unify.UnifiedTable(mart), ingest.Ingest(spark, mart.root, "run")
    for b in range(3):
        sink(messages(spark, range(b * 10, b * 10 + 10), "2.00"), b)
    with monkeypatch.context() as m:
        m.setattr(versions.Versions, "publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.merge()
    assert table.versions.current().sets == [] and values(table) == want([], range(30))
    assert len(storage.children(spark, table.sets)) == 1
    table.merge()
    assert table.sweep() == 1 and values(table) == want([], range(30))


def test_many_merges_are_folded_and_compacted_batches_are_found(spark, mart):
    table, sink = unify.UnifiedTable(mart, fan=3), ingest.Ingest(spark, mart.root, "run")
    for b in range(6):
        sink(messages(spark, range(b * 10, b * 10 + 10), "2.00"), b)
        if b < 4:
            table.merge()
    compacted = compaction.Compaction(spark, mart.root)
    compacted.compact()
    compacted.sweep()
    table.merge()
    state = table.versions.current()
    assert state.covered["run"] == 4
    assert all(sum(b in s["buckets"] for s in state.sets) <= 3 for b in range(4))
    assert values(table) == want([], range(60))
    table.sweep()
    assert values(unify.UnifiedTable(mart)) == want([], range(60))

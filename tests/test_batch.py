"""Batch load: rejects, uniqueness, dimensions, months, and the plans behind them."""

from __future__ import annotations

import re

import pytest
from conftest import SF_DIR, row, uuid_of
from pyspark.sql import functions as F

from eventmart import schemas
from eventmart.operators import access, dedup, dims, lookup, transform
from eventmart.plans.mart import Mart
from eventmart.session import fresh_path
from eventmart.sources import files
from parity import fixture

REASONS = {
    "bad_event_id": {"event_id": "bad-1"},
    "bad_timestamp": {"event_timestamp": "noon"},
    "bad_entity_id": {"entity_id": None},
    "null_total_value": {"total_value": None},
    "check_rate_type": {"rate_type": "9"},
    "check_duration": {"duration": "-1"},
    "bad_zone_id": {"zone_id": "3.0"},
    "bad_destination_id": {"destination_id": ""},
    "bad_vendor_id": {"vendor_id": "A"},
    "bad_rate_type": {"rate_type": "x"},
    "bad_duration_seconds": {"duration": "1.5"},
    "bad_passenger_count": {"passenger_count": "two"},
    "bad_value": {"value": "NaN"},
    "bad_sub_value": {"sub_value": "1e12"},
    "bad_total_value": {"total_value": "free"},
}


@pytest.fixture
def mart(spark):
    return Mart(spark, fresh_path(spark, "mart"))


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def ids(df) -> list[str]:
    return sorted(r.event_id for r in df.select("event_id").collect())


def test_every_reject_reason(raw_rows):
    rows = [row(i, **change) for i, change in enumerate(REASONS.values())]
    got = transform.judge(raw_rows(rows + [row(99)])).orderBy("source_row").collect()
    assert [r.reject_reason for r in got] == [*REASONS, None]
    assert got[0].event_id == "bad-1"  # the text is untouched


def test_null_passes_the_checks(raw_rows):
    optional = ["zone_id", "destination_id", "vendor_id", "rate_type", "duration", "passenger_count", "payment_method"]
    facts = transform.fact_transform(raw_rows([row(1, **dict.fromkeys(optional))])).collect()
    assert len(facts) == 1 and facts[0].rate_type is None and facts[0].payment_method_id is None


def test_accepted_and_rejected_make_up_the_input(mart, raw_rows):
    rows = [row(i, **change) for i, change in enumerate(REASONS.values())] + [row(50), row(50), row(51)]
    mart.load_batch(raw_rows(rows))
    assert ids(mart.fact()) == sorted([uuid_of(50), uuid_of(51)])
    assert sorted(r.reject_reason for r in mart.rejects().collect()) == sorted(REASONS)


def test_refused_load_changes_nothing(mart, raw_rows):
    with pytest.raises(ValueError, match="check_rate_type"):
        mart.load_batch(raw_rows([row(1), row(2, rate_type="9")]), on_bad="fail")
    assert mart.fact().count() == 0
    mart.load_batch(raw_rows([row(1), row(2, event_id="bad")]), on_bad="fail")  # bad ids are skipped
    assert ids(mart.fact()) == [uuid_of(1)]


def test_foreign_keys_of_odd_spellings(mart, raw_rows):
    rows = [row(1, zone_id="5"), row(2, zone_id=" 5 "), row(3, zone_id="-5"), row(4, vendor_id=" 8 ")]
    mart.load_batch(raw_rows(rows))
    assert ids(mart.fact()) == [uuid_of(1), uuid_of(2)]
    assert {r.event_id: r.reject_reason for r in mart.rejects().collect()} == {
        uuid_of(3): "fk_zone_id",
        uuid_of(4): "fk_vendor_id",
    }


def test_loading_twice_and_overlapping_loads(mart, raw_rows):
    first = raw_rows([row(i, value="1.00") for i in range(5)])
    mart.load_batch(first)
    mart.load_batch(first)
    assert mart.fact().count() == 5
    mart.load_batch(raw_rows([row(i, value="2.00") for i in range(3, 8)], "b"))
    got = {r.event_id: float(r.value) for r in mart.fact().collect()}
    assert got == {uuid_of(i): 1.0 if i < 5 else 2.0 for i in range(8)}


def test_month_scope_reads_the_touched_months_only(mart, raw_rows):
    mart.load_batch(raw_rows([row(1), row(2, event_timestamp="2024-11-05")]))
    again = raw_rows([row(1), row(3)], "b")
    rows = mart.fact_rows(transform.fact_transform(again), scope="month")
    assert ids(rows) == [uuid_of(3)]
    assert re.search(r"PartitionFilters: \[[^\]]*event_month", plan_of(rows))
    mart.load_batch(again, scope="month")
    assert ids(mart.fact()) == [uuid_of(1), uuid_of(2), uuid_of(3)]


def test_insert_shuffles_rows_once(mart, raw_rows):
    mart.load_batch(raw_rows([row(1), row(2)]))
    staged = mart.raw()
    rows = mart.fact_rows(transform.fact_transform(staged), staged.select("event_id"), 10_000_000)
    plan = plan_of(rows)
    physical = plan[plan.index("== Physical Plan ==") :]
    assert physical.count("Exchange hashpartitioning(event_id") == 2  # the rows, and the new ids alone


@pytest.mark.parametrize("key_count", [10, 10_000_000, None])
def test_absent_rows_with_each_join(mart, spark, raw_rows, key_count):
    mart.load_batch(raw_rows([row(i) for i in range(20)]))
    new = transform.fact_transform(raw_rows([row(i) for i in range(10, 30)]))
    got = dedup.absent_rows(new, mart.fact(), key_count=key_count)
    assert ids(got) == sorted(uuid_of(i) for i in range(20, 30))


def test_first_wins_with_one_hot_key(raw_rows, spark):
    hot = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("string").alias("event_id"),
        F.lit("a").alias("source_file"),
        F.col("id").alias("source_block"),
        F.lit(0).alias("source_row"),
    )
    got = {r.event_id: r.source_block for r in dedup.dedup_first_wins(hot.repartition(8)).collect()}
    assert got == {("0" if i == 0 else str(i)): i for i in range(20_000) if i == 0 or i % 3}


def test_dedup_drops_copies_before_the_shuffle(raw_rows):
    plan = plan_of(dedup.dedup_first_wins(transform.fact_transform(raw_rows([row(1)]))))
    physical = plan[plan.index("== Physical Plan ==") :]
    assert physical.count("WindowGroupLimit") == 2
    assert physical.rindex("Partial") > physical.index("Exchange hashpartitioning")  # below the exchange


def test_stored_keys_are_not_shuffled(spark, raw_rows):
    mart = Mart(spark, fresh_path(spark, "mart"), buckets=4)
    mart.load_batch(raw_rows([row(i) for i in range(20)]))
    new = dedup.dedup_first_wins(transform.fact_transform(raw_rows([row(i) for i in range(10, 30)])))
    plan = plan_of(dedup.absent_rows(new, mart.fact(), key_count=5_000_000))
    physical = plan[plan.index("== Physical Plan ==") :]
    assert "Bucketed: true" in physical and "ShuffledHashJoin" in physical
    stored = [line for line in physical.splitlines() if "FileScan parquet" in line and "fact_events" in line]
    assert len(stored) == 1 and "fact_events[event_id#" in stored[0]  # one scan, key column only
    between = physical[physical.index("ShuffledHashJoin") : physical.index(stored[0])]
    assert "Exchange" not in between and "Sort" not in between


def test_dimensions(mart, raw_rows):
    mart.update_dimensions(raw_rows([row(1, zone_id="7", vendor_id="01"), row(2, zone_id="x", vendor_id="1")]))
    mart.update_dimensions(raw_rows([row(3, zone_id="007", vendor_id="3"), row(4, zone_id="8", vendor_id="03")]))
    assert sorted(r.zone_id for r in mart.dim("dim_zone").collect()) == [7, 8]
    assert {r.id: r.name for r in mart.dim("dim_vendor").collect()} == {1: "Vendor A", 2: "Vendor B", 3: "Vendor 03"}


def test_zone_names(spark):
    zones = spark.createDataFrame([(1, "old"), (2, "old"), (3, None)], schemas.ZONE_SCHEMA)
    names = spark.createDataFrame([(1, "new"), (1, "newer"), (3, "three")], schemas.ZONE_SCHEMA)
    got = {r.zone_id: r.zone_name for r in dims.zone_enrich(zones, names).collect()}
    assert got == {1: "new", 2: "old", 3: "three"}


def test_unknown_keys_count_rows(spark):
    keys = spark.createDataFrame([(1,), (2,), (2,), (None,)], "zone_id int")
    known = spark.createDataFrame([(1, "x")], schemas.ZONE_SCHEMA)
    assert [tuple(r) for r in lookup.unknown_keys(keys, "zone_id", known, "zone_id").collect()] == [(2, 2)]


def test_large_dimension_is_not_broadcast(spark):
    small, large = spark.range(10), spark.range(100)
    assert "strategy=broadcast" in plan_of(lookup.broadcast_if_small(small, 50))
    assert "strategy=broadcast" not in plan_of(lookup.broadcast_if_small(large, 50))


def test_mart_can_be_reopened_by_another_catalog(mart, spark, raw_rows):
    mart.load_batch(raw_rows([row(1), row(2, event_timestamp="2024-11-05")]))
    spark.sql(f"DROP TABLE {mart.fact_table}")  # an external table: files stay
    again = Mart(spark, mart.root, buckets=64)
    assert again.buckets == mart.buckets
    assert again.months() == ["2024-10-01", "2024-11-01"]
    again.load_batch(raw_rows([row(1, value="5"), row(3)]))
    assert ids(again.fact()) == sorted(uuid_of(i) for i in (1, 2, 3))


def test_new_mart_has_all_batch_tables(mart):
    absent = [name for name, there in mart.present_tables().items() if not there]
    assert absent == ["streaming_events"]
    assert mart.dim("dim_zone").count() == mart.raw().count() == mart.fact().count() == 0


def test_month_pruning(mart, raw_rows):
    mart.load_batch(raw_rows([row(1), row(2, event_timestamp="2024-11-05"), row(3, event_timestamp="2024-12-05")]))
    got = access.time_range(mart.fact(), "2024-11-01", "2024-12-01")
    assert ids(got) == [uuid_of(2)]
    assert re.search(r"PartitionFilters: \[[^\]]*event_month", plan_of(got))


def test_filters_reach_the_scan(mart, raw_rows):
    mart.load_batch(raw_rows([row(1), row(2, entity_id="8")]))
    assert "EqualTo(entity_id,8)" in plan_of(access.entity_lookup(mart.fact(), 8))
    assert "EqualTo(event_type_id,3)" in plan_of(access.type_lookup(mart.fact(), "premium"))
    assert access.type_lookup(mart.fact(), "unheard of").count() == 0
    assert "EqualTo(is_anomaly,true)" in plan_of(access.anomaly_scan(mart.fact()))


def test_retired_months_move_once(mart, spark, raw_rows):
    archive = fresh_path(spark, "archive")
    mart.load_batch(raw_rows([row(1), row(2, event_timestamp="2024-11-05")]))
    assert mart.retire_months("2024-11-01", archive) == ["2024-10-01"]
    assert mart.retire_months("2024-11-01", archive) == []
    mart.load_batch(raw_rows([row(3)]))  # a late row of the retired month
    mart.retire_months("2024-11-01", archive)
    assert ids(mart.fact()) == [uuid_of(2)]
    assert ids(spark.read.parquet(archive)) == [uuid_of(1), uuid_of(3)]


def test_interrupted_retirement_is_completed(mart, spark, raw_rows):
    archive = fresh_path(spark, "archive")
    mart.load_batch(raw_rows([row(1), row(2)]))
    copied = mart.fact().where(F.col("event_id") == uuid_of(1))
    copied.write.partitionBy("event_month").parquet(archive)  # as if cut short here
    mart.retire_months("2024-11-01", archive)
    assert ids(spark.read.parquet(archive)) == [uuid_of(1), uuid_of(2)]


def test_csv_fields(spark, tmp_path):
    header = ",".join(c.upper() for c in schemas.RAW_COLUMNS)  # positional: names do not matter
    line = f'{uuid_of(1)},2024-10-01 10:00:00,7,,4,1," Standard, ""x""",1,60,1.0,10,1,11,card'
    (tmp_path / "a.csv").write_text(f"{header}\n{line}\n")
    got = files.csv_scan_raw(spark, str(tmp_path)).collect()
    assert len(got) == 1 and got[0].zone_id is None and got[0].event_type == ' Standard, "x"'


def test_csv_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"value,extra,event_id\n10,x,{uuid_of(1)}\n")
    got = files.csv_scan_by_name(spark, str(tmp_path)).collect()
    assert [(r.event_id, r.value, r.zone_id) for r in got] == [(uuid_of(1), "10", None)]


def test_quoted_line_breaks(spark, tmp_path):
    line = f'{uuid_of(1)},2024-10-01,7,3,4,1,"stan\ndard",1,60,1.0,10,1,11,card'
    (tmp_path / "a.csv").write_text(",".join(schemas.RAW_COLUMNS) + f"\n{line}\n")
    got = files.csv_scan_raw(spark, str(tmp_path), multi_line=True).collect()
    assert [r.event_type for r in got] == ["stan\ndard"]


def test_arrival_order_across_splits_of_a_file(spark, tmp_path):
    lines = [",".join([uuid_of(i), *["1"] * 13]) for i in range(3_000)]
    (tmp_path / "a.csv").write_text("\n".join([",".join(schemas.RAW_COLUMNS), *lines]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 20_000)
    try:
        rows = files.csv_scan_raw(spark, str(tmp_path))
        assert rows.rdd.getNumPartitions() > 3
        got = [r.event_id for r in rows.orderBy(*schemas.ORDER_COLUMNS).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [uuid_of(i) for i in range(3_000)]


def test_fixture_counts(spark):
    raw = fixture.raw_events(spark, SF_DIR)
    facts = dedup.dedup_first_wins(transform.fact_transform(raw))
    assert (raw.count(), facts.count(), facts.where("is_anomaly").count()) == (1_020, 980, 3)


def test_tables_can_be_queried_in_sql(mart, spark, raw_rows):
    mart.load_batch(raw_rows([row(1), row(2, total_value="-1"), row(3, event_type="bulk")]))
    mart.register_views("t_")
    got = spark.sql(
        "SELECT d.name, date_trunc('month', f.event_timestamp)::date AS m, count(*) AS n,"
        " count(*) FILTER (WHERE f.is_anomaly) AS bad"
        " FROM t_fact_events f JOIN t_dim_event_type d ON d.id = f.event_type_id GROUP BY 1, 2 ORDER BY 1"
    ).collect()
    assert [(r.name, str(r.m), r.n, r.bad) for r in got] == [
        ("bulk", "2024-10-01", 1, 0),
        ("standard", "2024-10-01", 2, 1),
    ]
    assert spark.table("t_streaming_events").count() == 0 and spark.table("t_raw_events").count() == 3


def test_reopening_without_success_markers_keeps_all(spark, raw_rows):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        root = fresh_path(spark, "mart")
        mart = Mart(spark, root)
        mart.load_batch(raw_rows([row(1), row(2, vendor_id="9")]))
        before = [mart.dim(n).count() for n in ("dim_zone", "dim_vendor")] + [mart.raw().count()]
        again = Mart(spark, root)
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert [again.dim(n).count() for n in ("dim_zone", "dim_vendor")] + [again.raw().count()] == before


def test_a_lost_partition_entry_is_found_again(spark, raw_rows):
    mart = Mart(spark, fresh_path(spark, "mart"))
    rows = raw_rows([row(1), row(2)])
    mart.load_batch(rows)
    # drop the entry and keep the files: as an external table does
    spark.sql(f"ALTER TABLE {mart.fact_table} DROP PARTITION (event_month = DATE'2024-10-01')")
    mart.load_batch(rows)
    assert mart.fact().count() == 2


def test_rejects_of_other_files_stay(spark, raw_rows):
    mart = Mart(spark, fresh_path(spark, "mart"))
    for source, bad in (("a", "x"), ("b", "y"), ("a", "x")):
        mart.load_batch(raw_rows([row(1), row(2, event_id=bad)], source))
    assert sorted(r.event_id for r in mart.rejects().collect()) == ["x", "y"]


def test_ragged_lines_are_rejected_with_their_text(spark, tmp_path):
    good = ",".join(row(1)[c] for c in schemas.RAW_COLUMNS)
    short, long = good.rsplit(",", 1)[0], good.replace("00000001-", "00000003-") + ",more"
    path = tmp_path / "in.csv"
    path.write_text("\n".join([",".join(schemas.RAW_COLUMNS), good, short, long]) + "\n")
    mart = Mart(spark, fresh_path(spark, "mart"))
    mart.load_batch(files.csv_scan_raw(spark, str(path)))
    assert mart.fact().count() == 1
    assert sorted((r.reject_reason, r.malformed_line) for r in mart.rejects().collect()) == sorted([("malformed_row", short), ("malformed_row", long)])
    with pytest.raises(ValueError, match="malformed_row"):
        mart.load_batch(files.csv_scan_raw(spark, str(path)), on_bad="fail")


def test_offsets_and_the_end_of_a_time_range(spark, raw_rows):
    mart = Mart(spark, fresh_path(spark, "mart"))
    times = ["2024-09-30 23:30:00", "2024-10-01 00:30:00", "2024-10-31 23:59:59", "2024-11-01 00:00:00"]
    mart.load_batch(raw_rows([row(i, event_timestamp=t) for i, t in enumerate(times)]))
    assert access.time_range(mart.fact(), "2024-10-01 01:00:00+02:00", "2024-11-01").count() == 3
    assert access.time_range(mart.fact(), "2024-10-01", "2024-11-01").count() == 2

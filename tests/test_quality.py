"""Analytical queries and the health report on small hand-made tables."""

from __future__ import annotations

from decimal import Decimal

import pytest
from conftest import row, uuid_of
from pyspark.sql import functions as F

from eventmart import schemas
from eventmart.operators import dims, lookup, transform
from eventmart.plans import analytics, quality
from eventmart.plans.mart import Mart
from eventmart.session import fresh_path


def facts(raw):
    return transform.fact_transform(raw).select(*schemas.FACT_COLUMNS)


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def by_check(report) -> dict:
    return {r.check: (r.status, r.observed, r.is_issue) for r in report.collect()}


def test_mean_is_rounded_once(spark):
    # 100.00 over 20,001 rows is 0.0049997...: rounding to six digits first would give 0.01.
    amounts = spark.range(20_001).select(F.when(F.col("id") == 0, 100).otherwise(0).cast(schemas.MONEY).alias("x"))
    assert amounts.agg(analytics.mean("x").alias("m")).first().m == Decimal("0.00")
    assert amounts.agg(F.round(F.avg("x"), 2).alias("m")).first().m == Decimal("0.01")


def test_q1_excludes_anomalies_unless_asked(raw_rows):
    raw = raw_rows([row(1), row(2, total_value="-5"), row(3, event_type="mystery"), row(4, event_type="BULK ")])
    plain = analytics.q1_monthly_revenue(facts(raw)).collect()
    assert [(r.event_type, r.total_events, r.anomaly_count) for r in plain] == [("bulk", 1, 0), ("standard", 1, 0)]
    with_bad = {r.event_type: r for r in analytics.q1_monthly_revenue(facts(raw), include_anomalies=True).collect()}
    assert (with_bad["standard"].total_events, with_bad["standard"].anomaly_count) == (2, 1)


def test_q1_order(raw_rows):
    rows = [row(1, total_value="5"), row(2, event_type="bulk", total_value="9"), row(3, event_timestamp="2024-09-01")]
    got = analytics.q1_monthly_revenue(facts(raw_rows(rows))).collect()
    assert [(str(r.month), r.event_type) for r in got] == [
        ("2024-09-01", "standard"),
        ("2024-10-01", "bulk"),
        ("2024-10-01", "standard"),
    ]


def test_q1_joins_names_after_grouping(raw_rows):
    plan = plan_of(analytics.q1_monthly_revenue(facts(raw_rows([row(1)]))))
    physical = plan[plan.index("== Physical Plan ==") :]
    assert physical.index("BroadcastHashJoin") < physical.index("HashAggregate")  # join on top


def test_q2_ties_and_order(raw_rows):
    methods = ["voucher", "account", "cash", "card"]
    rows = [row(i, entity_id="1", payment_method=m) for i, m in enumerate(methods)]
    rows += [row(10 + i, entity_id="2", payment_method=m) for i, m in enumerate(methods[:3])]
    rows += [row(20, entity_id="3", total_value="33", payment_method="voucher", duration="90")]
    rows += [row(30, entity_id="4", total_value="9999", payment_method="barter")]
    got = analytics.q2_top_entities(facts(raw_rows(rows))).collect()
    assert [(r.entity_id, r.dominant_payment) for r in got] == [(1, "card"), (2, "cash"), (3, "voucher")]
    assert got[2].avg_duration_min == Decimal("1.5") and got[0].paid_card == 1


def test_q2_is_a_top_k(raw_rows):
    raw = raw_rows([row(i, entity_id=str(i)) for i in range(30)])
    top = analytics.q2_top_entities(facts(raw))
    assert [r.entity_id for r in top.collect()] == list(range(20))
    assert "TakeOrderedAndProject" in plan_of(top) and "BroadcastHashJoin" in plan_of(top)


def test_null_revenue_sorts_first(spark, raw_rows):
    null_money = facts(raw_rows([row(1, entity_id="5"), row(2, entity_id="6")])).withColumn(
        "total_value", F.when(F.col("entity_id") == 5, F.col("total_value"))
    )
    assert [r.entity_id for r in analytics.q2_top_entities(null_money).collect()] == [6, 5]


@pytest.fixture
def tables(spark, raw_rows):
    raw = raw_rows([row(1), row(1), row(2, total_value="-1"), row(3, event_type="?", payment_method=None)])
    vendors = lookup.vendors(spark)
    dim_tables = {
        "dim_event_type": lookup.event_types(spark),
        "dim_payment_method": lookup.payment_methods(spark),
        "dim_vendor": vendors.unionByName(dims.dim_vendor_register(raw_rows([row(1, vendor_id="3")]), vendors)),
    }
    return raw, facts(raw), dim_tables, dims.zone_candidates(raw)


def test_health_report(spark, tables):
    raw, fact, dim_tables, zones = tables
    present = dict.fromkeys(schemas.HEALTH_TABLES, True) | {"streaming_events": False, "dim_zone": False}
    report = quality.health_report(spark, present, raw, fact, dim_tables, zones, stream=fact.limit(0), minimum=5)
    got = by_check(report)
    assert got == {
        **{f"table {t}": ("ok", "true", False) for t in schemas.HEALTH_TABLES},
        "table streaming_events": ("warn", "false", False),
        "table dim_zone": ("fail", "false", True),
        "rows raw_events": ("warn", "4", True),
        "rows streaming_events": ("warn", "0", False),
        "rows fact_events": ("warn", "4", True),
        "anomalies": ("ok", "1", False),
        "duplicate event_ids": ("fail", "1", True),
        "null_event_type_id": ("warn", "1", True),
        "null_payment_method_id": ("warn", "1", True),
        "earliest event": ("ok", "2024-10-01 10:00:00", False),
        "latest event": ("ok", "2024-10-01 10:00:00", False),
        "months covered": ("ok", "1", False),
        "rows dim_event_type": ("ok", "5", False),
        "rows dim_payment_method": ("ok", "4", False),
        "rows dim_vendor": ("warn", "3", True),
        "rows dim_zone": ("ok", "1", False),
        "total_revenue": ("info", "33.00", False),
        "avg_per_event": ("info", "11.00", False),
        "min_value": ("info", "11.00", False),
        "max_value": ("info", "11.00", False),
    }
    assert tuple(quality.dq_summary(report).first()) == (25, 7, 1)


def test_empty_tables_do_not_break_the_report(spark, tables):
    raw, fact, dim_tables, zones = tables
    none = fact.where("false")
    got = by_check(quality.health_report(spark, {}, raw.where("false"), none, dim_tables, zones))
    assert got["rows fact_events"] == ("fail", "0", True)
    assert got["anomalies"] == ("warn", "0", False)
    assert got["earliest event"] == ("fail", None, True)
    assert got["total_revenue"] == ("info", None, False)
    assert got["rows streaming_events"] == ("warn", None, False)


def test_report_scans_the_facts_twice_at_most(spark, raw_rows):
    mart = Mart(spark, fresh_path(spark, "mart"))
    mart.load_batch(raw_rows([row(1), row(2)]))
    names = ["dim_event_type", "dim_payment_method", "dim_vendor"]
    report = quality.health_report(
        spark, {}, mart.raw(), mart.fact(), {n: mart.dim(n) for n in names}, mart.dim("dim_zone")
    )
    plan = plan_of(report)
    physical = plan[plan.index("== Physical Plan ==") :]
    scans = [line for line in physical.splitlines() if "FileScan" in line and f"{mart.fact_table}[" in line]
    assert len(scans) == 2
    duplicates = physical[physical.index("duplicate event_ids") :]
    assert "Bucketed: true" in duplicates  # and so no shuffle of the keys:
    assert "Exchange hashpartitioning(event_id" not in physical


def test_validation(spark, tables):
    raw, fact, *_ = tables
    got = {r.measure: (r.row_count, r.status) for r in quality.validate_load(raw, fact).collect()}
    assert got == {
        "raw_rows": (4, "info"),
        "fact_rows": (4, "ok"),
        "anomalies": (1, "info"),
        "null_event_type_id": (1, "warn"),
        "null_payment_method_id": (1, "warn"),
    }
    with pytest.raises(ValueError, match="empty"):
        quality.validate_load(raw, fact.where("false"))


def test_load_report(tables):
    raw, fact, *_ = tables
    got = {r.table_name: r.row_count for r in quality.load_report(raw, fact).collect()}
    assert got == {"raw_events": 4, "fact_events": 4, "anomalies (negative total_value)": 1}


def test_seed_usage_counts_members_without_rows(spark, raw_rows):
    raw = raw_rows([row(1, event_type=" BULK"), row(2, event_type="bulk"), row(3, event_type="?")])
    got = {r.name: r.row_count for r in dims.seed_usage(raw, "event_type", lookup.event_types(spark)).collect()}
    assert got == {"standard": 0, "express": 0, "premium": 0, "bulk": 2, "scheduled": 0}


def test_daily_and_entity_models(raw_rows):
    fact = facts(raw_rows([row(1), row(2, total_value="-4"), row(3, event_type="?", event_timestamp="2024-10-02")]))
    daily = {(str(r.day), r.event_type): r for r in analytics.daily_rollup(fact).collect()}
    assert daily["2024-10-01", "standard"].gross_revenue == Decimal("11.00")
    assert daily["2024-10-01", "standard"].anomaly_count == 1
    assert daily["2024-10-02", None].total_events == 1
    entity = analytics.entity_metrics(fact).collect()
    assert [(r.entity_id, r.total_events, r.total_revenue) for r in entity] == [(7, 3, Decimal("22.00"))]


def test_uuid_helper_is_valid():
    assert uuid_of(1) == "00000000-0000-4000-8000-000000000001"

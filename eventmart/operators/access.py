"""Filtered reads of the fact table: the access paths users need.

Filters are plain predicates on stored columns, so they reach the parquet scan.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart import schemas


def month_of(ts) -> F.Column:
    return F.to_date(F.date_trunc("month", ts))


def time_range(fact: DataFrame, start: str, end: str) -> DataFrame:
    """Rows with start <= event_timestamp < end (text, 'yyyy-MM-dd[ HH:mm:ss[+hh:mm]]').

    Without an offset the text is UTC. Both predicates come from the same instants. A predicate on the timestamp does not prune month folders by itself, so the
    matching predicate on the partition column is added when the table has one.
    """
    ts = F.col("event_timestamp")
    begin, stop = instant(start), instant(end)
    out = fact.where((ts >= F.lit(begin)) & (ts < F.lit(stop)))
    if "event_month" in fact.columns:
        first = begin.date().replace(day=1)
        last = (stop - timedelta(microseconds=1)).date().replace(day=1)
        out = out.where(F.col("event_month").between(F.lit(first), F.lit(last)))
    return out


def instant(text: str) -> datetime:
    """The instant of a text; without an offset it is UTC."""
    at = datetime.fromisoformat(text)
    return at.replace(tzinfo=timezone.utc) if at.tzinfo is None else at.astimezone(timezone.utc)


def entity_lookup(fact: DataFrame, entity_id: int) -> DataFrame:
    return fact.where(F.col("entity_id") == entity_id)


def zone_lookup(fact: DataFrame, zone_id: int) -> DataFrame:
    return fact.where(F.col("zone_id") == zone_id)


def type_lookup(fact: DataFrame, event_type: str, types: DataFrame | None = None) -> DataFrame:
    """Rows of one event type; its id is looked up first (names are unique), so the scan
    gets a predicate on the stored id and no join."""
    ids = [i for i, name in schemas.EVENT_TYPE_SEEDS if name == event_type]
    if types is not None:
        ids = [r.id for r in types.where(F.col("name") == event_type).select("id").limit(1).collect()]
    return fact.where(F.col("event_type_id").isin(ids))


def anomaly_scan(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("is_anomaly"))

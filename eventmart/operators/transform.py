"""Raw text rows -> judged rows -> typed fact rows.

Judging decides once, per row, whether a load accepts it; the verdict is stored
with the staged text. Typing then runs on accepted rows only, and the quarantine is
a plain filter. All of it is narrow: no shuffle, two broadcasts of fixed dimensions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart import schemas
from eventmart.functions import casts
from eventmart.operators import lookup

# Rejects that a load skips without complaint; all others are errors of the load.
SKIPPED_REASON = "bad_event_id"


def first_reason(*checks: tuple[Column, str]) -> Column:
    """The name of the first check that is true, NULL when none is."""
    return F.coalesce(*[F.when(cond, F.lit(name)) for cond, name in checks])


def uuid_filter(raw: DataFrame) -> DataFrame:
    """Keep rows whose event_id is a lower-case UUID."""
    return raw.where(casts.is_uuid(F.col("event_id")))


def check_rate_type(rate_type: Column) -> Column:
    """Violation of the rate_type range; NULL passes."""
    return ~rate_type.between(schemas.RATE_TYPE_MIN, schemas.RATE_TYPE_MAX)


def check_duration(duration: Column) -> Column:
    """Violation of the duration floor; NULL passes."""
    return duration < schemas.DURATION_MIN


def anomaly_flag(total_value: Column) -> Column:
    """Batch anomaly rule on raw text: the unrounded total is negative."""
    return casts.batch_negative(total_value)


def typed_columns() -> dict[str, Column]:
    """Batch casts of the text columns, by the name of the typed column."""
    c = F.col
    return {
        "event_timestamp": casts.batch_timestamp(c("event_timestamp")),
        "entity_id": casts.batch_int(c("entity_id")),
        "zone_id": casts.batch_int(c("zone_id")),
        "destination_id": casts.batch_int(c("destination_id")),
        "vendor_id": casts.batch_smallint(c("vendor_id")),
        "rate_type": casts.batch_smallint(c("rate_type")),
        "duration_seconds": casts.batch_int(c("duration")),
        "passenger_count": casts.batch_rounded_smallint(c("passenger_count")),
        "value": casts.batch_money(c("value")),
        "sub_value": casts.batch_money(c("sub_value")),
        "total_value": casts.batch_money(c("total_value")),
    }


def judge(raw: DataFrame) -> DataFrame:
    """``raw`` with ``reject_reason``: NULL for rows a load accepts, else the first reason.

    The casts sit in a projection of their own, so each is evaluated once per row.
    """
    c = F.col
    text_of = {"duration_seconds": "duration"}
    typed = {f"typed_{name}": col for name, col in typed_columns().items()}

    def t(name: str) -> Column:
        return c(f"typed_{name}")

    def unreadable(name: str) -> tuple[Column, str]:
        return c(text_of.get(name, name)).isNotNull() & t(name).isNull(), f"bad_{name}"

    malformed = c("malformed_line").isNotNull() if "malformed_line" in raw.columns else F.lit(False)
    reason = first_reason(
        (malformed, "malformed_row"),
        (~F.coalesce(casts.is_uuid(c("event_id")), F.lit(False)), SKIPPED_REASON),
        (t("event_timestamp").isNull(), "bad_timestamp"),
        (t("entity_id").isNull(), "bad_entity_id"),
        (c("total_value").isNull(), "null_total_value"),
        (check_rate_type(t("rate_type")), "check_rate_type"),
        (check_duration(t("duration_seconds")), "check_duration"),
        unreadable("zone_id"),
        unreadable("destination_id"),
        unreadable("vendor_id"),
        unreadable("rate_type"),
        unreadable("duration_seconds"),
        unreadable("passenger_count"),
        unreadable("value"),
        unreadable("sub_value"),
        unreadable("total_value"),
    )
    return raw.withColumns(typed).withColumn("reject_reason", reason).drop(*typed)


def mark_unknown(judged: DataFrame, key: str, unknown: DataFrame | None) -> DataFrame:
    """Reject rows whose ``key`` is one of the ``unknown`` keys (a foreign-key violation).

    ``unknown`` holds each key once, as a number. A load passes it only when there are
    such keys at all, so the usual load has no row-level foreign-key join.
    """
    if unknown is None:
        return judged
    number = typed_columns()[key]
    bad = unknown.select(F.col(key).alias("__key"), F.lit(f"fk_{key}").alias("__fk"))
    return (
        judged.join(lookup.broadcast_if_small(bad), number == F.col("__key"), "left")
        .withColumn("reject_reason", F.coalesce("reject_reason", "__fk"))
        .select(judged.columns)
    )


def accepted_rows(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("reject_reason").isNull())


def rejected_rows(judged: DataFrame) -> DataFrame:
    """Quarantine rows: the untouched text and the reason."""
    return judged.where(F.col("reject_reason").isNotNull())


def reject_counts(judged: DataFrame) -> DataFrame:
    """Rows per reject reason; accepted rows are counted under 'accepted'."""
    return judged.groupBy(F.coalesce("reject_reason", F.lit("accepted")).alias("reject_reason")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def fact_transform(raw: DataFrame, types: DataFrame | None = None, methods: DataFrame | None = None) -> DataFrame:
    """Typed rows with ids resolved, before duplicate elimination.

    Takes raw or judged rows; raw rows are judged first. Order columns are kept.
    Names are looked up in ``types`` and ``methods``, by default in the seeds.
    """
    judged = raw if "reject_reason" in raw.columns else judge(raw)
    rows = lookup.fk_lookup(accepted_rows(judged), types, methods)
    columns = typed_columns() | {
        "event_id": F.col("event_id"),
        "event_type_id": F.col("event_type_id"),
        "payment_method_id": F.col("payment_method_id"),
        "is_anomaly": anomaly_flag(F.col("total_value")),
    }
    carried = [x for x in schemas.ORDER_COLUMNS if x in raw.columns]
    return rows.select(*[columns[n].alias(n) for n in schemas.FACT_COLUMNS], *carried)

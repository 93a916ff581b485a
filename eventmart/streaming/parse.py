"""Decoded messages -> typed stream rows with a reject reason.

Column expressions only: the same code runs in a micro-batch and in a batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart import schemas
from eventmart.functions import casts
from eventmart.operators.transform import first_reason
from eventmart.sources.messages import json_decode

INTEGERS = {
    "entity_id": ("entity_id", "int"),
    "zone_id": ("zone_id", "int"),
    "destination_id": ("destination_id", "int"),
    "vendor_id": ("vendor_id", "smallint"),
    "rate_type": ("rate_type", "smallint"),
    "duration_seconds": ("duration", "int"),
    "passenger_count": ("passenger_count", "smallint"),
}
AMOUNTS = ["value", "sub_value", "total_value"]


def stream_parse(decoded: DataFrame) -> DataFrame:
    """Typed rows of decoded messages; ``reject_reason`` is NULL for good ones.

    Malformed messages, rows without a usable id, time or entity, and numbers the
    column types cannot hold are rejected. Unreadable optional values become NULL.
    The anomaly flag looks at the rounded total; a missing total is no anomaly.
    """
    c = F.col
    typed: dict[str, Column] = {
        "event_id": casts.stream_uuid(c("event_id")),
        "event_timestamp": casts.stream_timestamp(c("event_timestamp")),
        "event_type": casts.stream_text(c("event_type")),
        "payment_method": casts.stream_text(c("payment_method")),
    }
    for name, (text, to) in INTEGERS.items():
        typed[name] = casts.stream_int(c(text), to=to)
    for name in AMOUNTS:
        typed[name] = casts.stream_money(c(name))

    def t(name: str) -> Column:
        return c(f"typed_{name}")

    sources = {name: text for name, (text, _) in INTEGERS.items()} | {n: n for n in AMOUNTS}
    reason = first_reason(
        (F.coalesce(c("is_malformed"), F.lit(False)), "malformed_message"),
        (t("event_id").isNull(), "bad_event_id"),
        (t("event_timestamp").isNull(), "bad_timestamp"),
        (t("entity_id").isNull(), "bad_entity_id"),
        *[
            (casts.stream_out_of_range(c(text), t(name), name in INTEGERS), f"out_of_range_{name}")
            for name, text in sources.items()
        ],
    )
    anomaly = F.coalesce(t("total_value") < 0, F.lit(False))
    out = [anomaly if n == "is_anomaly" else t(n) for n in schemas.STREAM_COLUMNS]
    carried = [x for x in ["message", *schemas.ORDER_COLUMNS] if x in decoded.columns]
    parsed = decoded.select("*", *[v.alias(f"typed_{n}") for n, v in typed.items()]).select(
        *[v.alias(n) for n, v in zip(schemas.STREAM_COLUMNS, out)],
        reason.alias("reject_reason"),
        *carried,
    )
    # A filter on the reason stays above a generator. Pushed below the casts and the decoding, it would
    # repeat all of them for every check that mentions them.
    return parsed.select(F.inline(F.array(F.struct(*parsed.columns))))


def parse_messages(messages: DataFrame) -> DataFrame:
    """``value`` text to typed rows: decode, then parse."""
    return stream_parse(json_decode(messages))

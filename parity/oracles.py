"""DuckDB SQL for every query in ``queries.py``, over the same test tables."""

from __future__ import annotations

from eventmart import schemas
from eventmart.streaming import aggregates
from parity import fixture
from parity.queries import MIN_ROWS, SECOND_LOAD_FROM

UUID = "[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
UUID_ANY = UUID.replace("a-f", "a-fA-F")
DUCK_TIME = "strftime(ts + to_months(CAST(k % 3 AS INTEGER)), '%Y-%m-%d %H:%M:%S')"
NAMES = ", ".join(schemas.RAW_COLUMNS)


def raw_cte(name: str, dirty: bool = False) -> str:
    """CTE ``name`` with the raw rows and their key ``k``."""
    columns = []
    for c in schemas.RAW_COLUMNS:
        sql = DUCK_TIME if c == "event_timestamp" else fixture.SHARED[c]
        if dirty and c in fixture.DIRTY:
            cond, text = fixture.DIRTY[c]
            sql = f"CASE WHEN {cond} THEN {text} ELSE {sql} END"
        columns.append(f"{sql} AS {c}")
    return f"""{name}_base AS (
  SELECT event_id AS k, user_id, ts, CAST(value AS DECIMAL(10,2)) AS v, {fixture.MAPPED_TYPE} AS m FROM events),
{name}_once AS (SELECT {", ".join(columns)}, k FROM {name}_base),
{name} AS (SELECT o.* FROM {name}_once o, UNNEST(range({fixture.COPIES})) AS c(copy))"""


def values(rows: list[tuple[int, str]]) -> str:
    return ", ".join(f"({i}::SMALLINT, '{n}')" for i, n in rows)


DIMS = f"""dim_event_type(id, name) AS (VALUES {values(schemas.EVENT_TYPE_SEEDS)}),
dim_payment_method(id, name) AS (VALUES {values(schemas.PAYMENT_METHOD_SEEDS)}),
dim_vendor_seed(id, name) AS (VALUES {values(schemas.VENDOR_SEEDS)})"""

REASON = f"""CASE WHEN NOT regexp_full_match(event_id, '{UUID}') THEN 'bad_event_id'
 WHEN TRY_CAST(event_timestamp AS TIMESTAMP) IS NULL THEN 'bad_timestamp'
 WHEN TRY_CAST(entity_id AS INTEGER) IS NULL THEN 'bad_entity_id'
 WHEN total_value IS NULL THEN 'null_total_value'
 WHEN TRY_CAST(rate_type AS SMALLINT) NOT BETWEEN 1 AND 6 THEN 'check_rate_type'
 WHEN TRY_CAST(duration AS INTEGER) < 0 THEN 'check_duration' END"""

FACT_SELECT = """event_id, CAST(event_timestamp AS TIMESTAMP) AS event_timestamp,
 CAST(entity_id AS INTEGER) AS entity_id, CAST(zone_id AS INTEGER) AS zone_id,
 CAST(destination_id AS INTEGER) AS destination_id, CAST(vendor_id AS SMALLINT) AS vendor_id,
 et.id AS event_type_id, CAST(rate_type AS SMALLINT) AS rate_type,
 CAST(duration AS INTEGER) AS duration_seconds,
 CAST(round(CAST(passenger_count AS DECIMAL(28,10)), 0) AS SMALLINT) AS passenger_count,
 CAST(value AS DECIMAL(10,2)) AS value, CAST(sub_value AS DECIMAL(10,2)) AS sub_value,
 CAST(total_value AS DECIMAL(10,2)) AS total_value, pm.id AS payment_method_id,
 CAST(total_value AS DECIMAL(28,10)) < 0 AS is_anomaly"""


def fact_cte(name: str, source: str) -> str:
    """CTEs ``name``_rows (accepted rows) and ``name`` (unique) over a raw CTE."""
    return f"""{name}_ok AS MATERIALIZED (SELECT * FROM {source} WHERE ({REASON}) IS NULL),
{name}_rows AS (SELECT {FACT_SELECT} FROM {name}_ok r
  LEFT JOIN dim_event_type et ON lower(trim(r.event_type)) = et.name
  LEFT JOIN dim_payment_method pm ON lower(trim(r.payment_method)) = pm.name),
{name} AS (SELECT DISTINCT * FROM {name}_rows)"""


def output(select: list[str], money: tuple[str, ...] = ("value", "sub_value", "total_value")) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in money else c for c in select)


FACT_OUT = output(schemas.FACT_COLUMNS)
STREAM_OUT = output(schemas.STREAM_COLUMNS)

INT = "TRY_CAST(trunc(TRY_CAST({c} AS DECIMAL(28,10))) AS {t}) AS {n}"
STREAM_SELECT = ", ".join(
    [
        "lower(trim(event_id)) AS event_id",
        "TRY_CAST(event_timestamp AS TIMESTAMP) AS event_timestamp",
        *[
            INT.format(c=c, t=t, n=n)
            for c, t, n in (
                ("entity_id", "INTEGER", "entity_id"),
                ("zone_id", "INTEGER", "zone_id"),
                ("destination_id", "INTEGER", "destination_id"),
                ("vendor_id", "SMALLINT", "vendor_id"),
            )
        ],
        "nullif(lower(trim(event_type)), '') AS event_type",
        *[
            INT.format(c=c, t=t, n=n)
            for c, t, n in (
                ("rate_type", "SMALLINT", "rate_type"),
                ("duration", "INTEGER", "duration_seconds"),
                ("passenger_count", "SMALLINT", "passenger_count"),
            )
        ],
        "TRY_CAST(value AS DECIMAL(10,2)) AS value",
        "TRY_CAST(sub_value AS DECIMAL(10,2)) AS sub_value",
        "TRY_CAST(total_value AS DECIMAL(10,2)) AS total_value",
        "nullif(lower(trim(payment_method)), '') AS payment_method",
        "coalesce(TRY_CAST(total_value AS DECIMAL(10,2)) < 0, FALSE) AS is_anomaly",
    ]
)
STREAM_REASON = f"""CASE WHEN NOT regexp_full_match(event_id, '{UUID_ANY}') THEN 'bad_event_id'
 WHEN TRY_CAST(event_timestamp AS TIMESTAMP) IS NULL THEN 'bad_timestamp'
 WHEN TRY_CAST(entity_id AS DECIMAL(28,10)) IS NULL THEN 'bad_entity_id' END"""
STREAM_CTE = f"""stream_rows AS (SELECT {STREAM_SELECT} FROM dirty WHERE ({STREAM_REASON}) IS NULL),
stream AS (SELECT DISTINCT * FROM stream_rows)"""

CLEAN = "WITH " + raw_cte("raw") + ", " + DIMS + ", " + fact_cte("fact", "raw") + " "
DIRTY = "WITH " + raw_cte("dirty", True) + ", " + DIMS + ", " + fact_cte("fact", "dirty") + " "
STREAM = "WITH " + raw_cte("dirty", True) + ", " + STREAM_CTE + " "
RAW = "WITH " + raw_cte("raw") + ", " + DIMS + " "
RAW_DIRTY = "WITH " + raw_cte("dirty", True) + ", " + DIMS + " "


def mean(c: str) -> str:
    """Mean of a two-digit decimal rounded half up to two digits, for sums >= 0."""
    return f"CAST((2 * CAST(sum({c}) * 100 AS BIGINT) + count({c})) // (2 * count({c})) AS DOUBLE) / 100"


def q1(where: str, extra: str) -> str:
    return f"""SELECT CAST(date_trunc('month', event_timestamp) AS DATE) AS month, et.name AS event_type,
 count(*) AS total_events, CAST(sum(total_value) AS DOUBLE) AS gross_revenue, {extra}
 CAST(sum(sub_value) AS DOUBLE) AS total_surcharge, count(*) FILTER (WHERE is_anomaly) AS anomaly_count
 FROM fact JOIN dim_event_type et ON et.id = fact.event_type_id WHERE {where} GROUP BY 1, 2"""


Q2 = f"""SELECT entity_id, count(*) AS total_trips, CAST(sum(total_value) AS DOUBLE) AS total_revenue,
 {mean("total_value")} AS avg_revenue,
 CAST((sum(duration_seconds) * 20 + 60 * count(duration_seconds)) // (120 * count(duration_seconds)) AS DOUBLE) / 10
  AS avg_duration_min,
 count(*) FILTER (WHERE pm.name = 'card') AS paid_card, count(*) FILTER (WHERE pm.name = 'cash') AS paid_cash,
 count(*) FILTER (WHERE pm.name = 'account') AS paid_account,
 count(*) FILTER (WHERE pm.name = 'voucher') AS paid_voucher
 FROM fact JOIN dim_payment_method pm ON pm.id = fact.payment_method_id
 WHERE NOT is_anomaly GROUP BY entity_id"""

MONEY_IF_CLEAN = "CAST(sum(total_value) FILTER (WHERE NOT is_anomaly) AS DOUBLE)"


def json_text() -> str:
    parts = [f"'\"{c}\":\"' || coalesce({c}, '') || '\"'" for c in schemas.RAW_COLUMNS]
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


def check(name: str, status: str, observed: str, expected: str | None, issue: str, source: str) -> str:
    want = "CAST(NULL AS VARCHAR)" if expected is None else f"'{expected}'"
    return (
        f"SELECT '{name}' AS \"check\", {status} AS status, CAST({observed} AS VARCHAR) AS observed,"
        f" {want} AS expected, {issue} AS is_issue FROM {source}"
    )


def graded(name: str, source: str) -> str:
    return check(
        name,
        f"CASE WHEN count(*) >= {MIN_ROWS} THEN 'ok' WHEN count(*) > 0 THEN 'warn' ELSE 'fail' END",
        "count(*)",
        f">= {MIN_ROWS}",
        f"count(*) < {MIN_ROWS}",
        source,
    )


def null_check(c: str) -> str:
    n = f"count(*) FILTER (WHERE {c} IS NULL)"
    return check(f"null_{c}", f"CASE WHEN {n} = 0 THEN 'ok' ELSE 'warn' END", n, "0", f"{n} > 0", "fact")


def dim_check(name: str, expected: int, source: str) -> str:
    return check(
        f"rows {name}",
        f"CASE WHEN count(*) = {expected} THEN 'ok' ELSE 'warn' END",
        "count(*)",
        str(expected),
        f"count(*) <> {expected}",
        source,
    )


def time_text(e: str) -> str:
    return f"strftime({e}, '%Y-%m-%d %H:%M:%S')"


VENDORS = """(SELECT id, name FROM dim_vendor_seed UNION ALL
 SELECT DISTINCT CAST(vendor_id AS SMALLINT), 'Vendor ' || vendor_id FROM raw
 WHERE regexp_full_match(vendor_id, '[0-9]+') AND CAST(vendor_id AS SMALLINT) NOT IN (SELECT id FROM dim_vendor_seed))"""

DATE_ROWS = " UNION ALL ".join(
    check(name, "'ok'", observed, None, "FALSE", "fact")
    for name, observed in (
        ("earliest event", time_text("min(event_timestamp)")),
        ("latest event", time_text("max(event_timestamp)")),
        ("months covered", "count(DISTINCT date_trunc('month', event_timestamp))"),
    )
)
REVENUE_ROWS = " UNION ALL ".join(
    check(name, "'info'", observed, None, "FALSE", "fact WHERE NOT is_anomaly")
    for name, observed in (
        ("total_revenue", "sum(total_value)"),
        ("avg_per_event", f"CAST({mean('total_value')} AS DECIMAL(20,2))"),
        ("min_value", "min(total_value)"),
        ("max_value", "max(total_value)"),
    )
)
TABLE_ROWS = " UNION ALL ".join(
    check(
        f"table {t}",
        "'warn'" if t == "streaming_events" else "'ok'",
        "'false'" if t == "streaming_events" else "'true'",
        "true",
        "FALSE",
        "(SELECT 1)",
    )
    for t in schemas.HEALTH_TABLES
)
ANOMALY_N = "count(*) FILTER (WHERE is_anomaly)"
DUPE_N = "(SELECT event_id FROM fact_rows GROUP BY event_id HAVING count(*) > 1)"


def resent_rows(source: str) -> str:
    changed = "CAST(CAST(value AS DECIMAL(10,2)) + 1 AS VARCHAR)"
    return f"(SELECT * REPLACE ({changed} AS value) FROM {source})"


ORACLES = {
    # sources
    "csv_scan_raw": RAW + f"SELECT {NAMES} FROM raw",
    "csv_scan_by_name": RAW + f"SELECT {NAMES} FROM raw",
    "csv_malformed_rows": RAW
    + f"""SELECT coalesce({REASON}, 'accepted') AS reject_reason, count(*) AS row_count, 0::BIGINT AS lines_kept
 FROM raw GROUP BY 1 UNION ALL SELECT 'malformed_row', 2 * count(*), 2 * count(*) FROM raw""",
    "csv_by_name_mixed_headers": RAW + f"SELECT {NAMES} FROM raw, range(3)",
    "dim_extended": CLEAN.replace("(5::SMALLINT, 'scheduled')", "(5::SMALLINT, 'scheduled'), (6::SMALLINT, 'mystery')")
    + """, n AS (SELECT count(*) AS found FROM fact WHERE event_type_id = 6)
 SELECT et.name AS event_type, count(*) AS in_q1, any_value(n.found) AS found FROM fact
 JOIN dim_event_type et ON et.id = fact.event_type_id, n WHERE NOT is_anomaly GROUP BY 1""",
    "load_rejects_two_loads": "WITH "
    + raw_cte("raw")
    + ", "
    + raw_cte("dirty", True)
    + f""" SELECT 'clean' AS source_file, {REASON} AS reject_reason, count(*) AS row_count FROM raw
 WHERE {REASON} IS NOT NULL GROUP BY 2 UNION ALL SELECT 'dirty', {REASON}, count(*) FROM dirty
 WHERE {REASON} IS NOT NULL GROUP BY 2""",
    "zone_names_stored": CLEAN
    + """SELECT DISTINCT z AS zone_id, 'Zone ' || z AS zone_name FROM
 (SELECT CAST(zone_id AS INTEGER) AS z FROM raw UNION SELECT CAST(destination_id AS INTEGER) FROM raw)""",
    "stage_reload": RAW_DIRTY + f"SELECT {NAMES}, {REASON} AS reject_reason FROM dirty",
    "rows_to_json": RAW_DIRTY + f"SELECT event_id AS key, {json_text()} AS value FROM dirty",
    "json_decode": RAW
    + "SELECT "
    + ", ".join(f"coalesce({c}, '') AS {c}" for c in schemas.RAW_COLUMNS)
    + ", FALSE AS is_malformed FROM raw UNION ALL SELECT "
    + ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in schemas.RAW_COLUMNS)
    + ", TRUE AS is_malformed FROM raw",
    # batch transform
    "uuid_filter": RAW
    + f"SELECT event_id, entity_id, total_value FROM raw WHERE regexp_full_match(event_id, '{UUID}')",
    "fact_transform": CLEAN + f"SELECT {FACT_OUT} FROM fact_rows",
    "fk_lookup": RAW
    + """SELECT event_id, event_type, payment_method, et.id AS event_type_id, pm.id AS payment_method_id FROM raw r
 LEFT JOIN dim_event_type et ON lower(trim(r.event_type)) = et.name
 LEFT JOIN dim_payment_method pm ON lower(trim(r.payment_method)) = pm.name""",
    "anomaly_flag": RAW_DIRTY
    + "SELECT event_id, total_value, CAST(total_value AS DECIMAL(28,10)) < 0 AS is_anomaly FROM dirty",
    "check_constraints": RAW_DIRTY
    + f"SELECT coalesce({REASON}, 'accepted') AS reject_reason, count(*) AS row_count FROM dirty GROUP BY 1",
    "fk_violations": "WITH "
    + raw_cte("raw")
    + ", "
    + raw_cte("dirty", True)
    + ", "
    + DIMS
    + ", "
    + fact_cte("fact", "dirty")
    + """ SELECT 'zone_id' AS key_name, zone_id AS key_value, count(*) AS row_count FROM fact_rows
 WHERE zone_id NOT IN (SELECT CAST(zone_id AS INTEGER) FROM raw) GROUP BY 2 UNION ALL
 SELECT 'vendor_id', CAST(vendor_id AS INTEGER), count(*) FROM fact_rows
 WHERE vendor_id NOT IN (SELECT id FROM dim_vendor_seed) GROUP BY 2""",
    "dedup_first_wins": CLEAN
    + "SELECT event_id, CAST(value AS DOUBLE) AS value, CAST(total_value AS DOUBLE) AS total_value FROM fact",
    # tables
    "fact_upsert": "WITH "
    + raw_cte("raw")
    + f""", loaded AS (SELECT * FROM raw WHERE event_timestamp < '{SECOND_LOAD_FROM}'
  UNION ALL SELECT * FROM {resent_rows("raw")} WHERE event_timestamp >= '{SECOND_LOAD_FROM}'), """
    + DIMS
    + ", "
    + fact_cte("fact", "loaded")
    + f" SELECT {FACT_OUT} FROM fact",
    "load_batch": DIRTY + f"SELECT {FACT_OUT} FROM fact",
    "load_rejects": RAW_DIRTY
    + f"SELECT {NAMES}, {REASON} AS reject_reason FROM dirty WHERE ({REASON}) IS NOT NULL",
    "seed_dims": RAW
    + """SELECT 'dim_event_type' AS dim, d.id, d.name, count(r.k) AS row_count FROM dim_event_type d
 LEFT JOIN raw r ON lower(trim(r.event_type)) = d.name GROUP BY 2, 3 UNION ALL
 SELECT 'dim_payment_method', d.id, d.name, count(r.k) FROM dim_payment_method d
 LEFT JOIN raw r ON lower(trim(r.payment_method)) = d.name GROUP BY 2, 3""",
    "dim_zone_discover": RAW_DIRTY
    + """SELECT DISTINCT CAST(zone_id AS INTEGER) AS zone_id, CAST(NULL AS VARCHAR) AS zone_name FROM dirty
 WHERE regexp_full_match(zone_id, '[0-9]+')""",
    "dim_vendor_register": RAW + f"SELECT id, name FROM {VENDORS}",
    "zone_enrich": RAW
    + """SELECT z.zone_id, s.s_name AS zone_name FROM (SELECT DISTINCT CAST(zone_id AS INTEGER) AS zone_id FROM raw) z
 LEFT JOIN supplier s ON s.s_suppkey = z.zone_id""",
    "fact_by_month": CLEAN
    + """SELECT CAST(date_trunc('month', event_timestamp) AS DATE) AS event_month, event_id, event_timestamp,
 CAST(total_value AS DOUBLE) AS total_value FROM fact""",
    "retire_months": CLEAN
    + """SELECT CASE WHEN event_timestamp < TIMESTAMP '2024-02-01' THEN 'archive' ELSE 'fact' END AS place,
 CAST(date_trunc('month', event_timestamp) AS DATE) AS event_month, count(*) AS row_count FROM fact GROUP BY 1, 2""",
    # analytics
    "q1_monthly_revenue": CLEAN + q1("NOT is_anomaly", f"{mean('total_value')} AS avg_revenue_per_event,"),
    "q1_with_anomalies": CLEAN + q1("TRUE", ""),
    "q2_top_entities": CLEAN
    + f""", totals AS ({Q2}) SELECT *, CASE greatest(paid_card, paid_cash, paid_account, paid_voucher)
 WHEN paid_card THEN 'card' WHEN paid_cash THEN 'cash' WHEN paid_account THEN 'account' ELSE 'voucher' END
 AS dominant_payment FROM totals ORDER BY total_revenue DESC, entity_id LIMIT 20""",
    "daily_rollup": CLEAN
    + f"""SELECT CAST(event_timestamp AS DATE) AS day, et.name AS event_type, count(*) AS total_events,
 {MONEY_IF_CLEAN} AS gross_revenue, {ANOMALY_N} AS anomaly_count,
 CAST(sum(passenger_count) AS BIGINT) AS passengers
 FROM fact LEFT JOIN dim_event_type et ON et.id = fact.event_type_id GROUP BY 1, 2""",
    "entity_metrics": CLEAN
    + f"""SELECT entity_id, count(*) AS total_events, {ANOMALY_N} AS anomaly_count,
 {MONEY_IF_CLEAN} AS total_revenue, CAST(sum(duration_seconds) AS BIGINT) AS total_duration_seconds,
 min(event_timestamp) AS first_event, max(event_timestamp) AS last_event FROM fact GROUP BY entity_id""",
    "entity_lookup": CLEAN + f"SELECT {FACT_OUT} FROM fact WHERE entity_id = 11",
    "zone_lookup": CLEAN + f"SELECT {FACT_OUT} FROM fact WHERE zone_id = 42",
    "type_lookup": CLEAN
    + f"""SELECT {FACT_OUT} FROM fact WHERE event_type_id =
 (SELECT id FROM dim_event_type WHERE name = 'premium')""",
    "time_range": CLEAN
    + f"""SELECT {FACT_OUT} FROM fact
 WHERE event_timestamp >= TIMESTAMP '2024-02-01' AND event_timestamp < TIMESTAMP '2024-02-08'""",
    "anomaly_scan": CLEAN + f"SELECT {FACT_OUT} FROM fact WHERE is_anomaly",
    # quality
    "load_report": CLEAN
    + """SELECT 'raw_events' AS table_name, count(*) AS row_count FROM raw UNION ALL
 SELECT 'fact_events', count(*) FROM fact UNION ALL
 SELECT 'anomalies (negative total_value)', count(*) FROM fact WHERE is_anomaly""",
    "validate_load": DIRTY
    + """, n AS (SELECT (SELECT count(*) FROM dirty) AS raw_rows, count(*) AS fact_rows,
 count(*) FILTER (WHERE is_anomaly) AS anomalies, count(*) FILTER (WHERE event_type_id IS NULL) AS nt,
 count(*) FILTER (WHERE payment_method_id IS NULL) AS np FROM fact)
 SELECT 'raw_rows' AS measure, raw_rows AS row_count, 'info' AS status FROM n UNION ALL
 SELECT 'fact_rows', fact_rows, 'ok' FROM n UNION ALL SELECT 'anomalies', anomalies, 'info' FROM n UNION ALL
 SELECT 'null_event_type_id', nt, CASE WHEN nt > 0 THEN 'warn' ELSE 'ok' END FROM n UNION ALL
 SELECT 'null_payment_method_id', np, CASE WHEN np > 0 THEN 'warn' ELSE 'ok' END FROM n""",
    "dq_tables": TABLE_ROWS,
    "dq_row_counts": "WITH "
    + raw_cte("raw")
    + ", "
    + DIMS
    + ", "
    + fact_cte("fact", "raw")
    + f", s AS (SELECT * FROM raw WHERE regexp_full_match(event_id, '{UUID_ANY}')) "
    + graded("rows raw_events", "raw")
    + " UNION ALL "
    + graded("rows fact_events", "fact")
    + " UNION ALL "
    + check("rows streaming_events", "CASE WHEN count(*) > 0 THEN 'ok' ELSE 'warn' END", "count(*)", None, "FALSE", "s"),
    "dq_anomalies": CLEAN
    + check("anomalies", f"CASE WHEN {ANOMALY_N} > 0 THEN 'ok' ELSE 'warn' END", ANOMALY_N, "> 0", "FALSE", "fact"),
    "dq_duplicates": CLEAN
    + check(
        "duplicate event_ids",
        "CASE WHEN count(*) = 0 THEN 'ok' ELSE 'fail' END",
        "count(*)",
        "0",
        "count(*) > 0",
        DUPE_N,
    ),
    "dq_nulls": CLEAN + null_check("event_type_id") + " UNION ALL " + null_check("payment_method_id"),
    "dq_date_range": CLEAN + DATE_ROWS,
    "dq_dim_sizes": RAW
    + " UNION ALL ".join(
        [
            dim_check("dim_event_type", 5, "dim_event_type"),
            dim_check("dim_payment_method", 4, "dim_payment_method"),
            dim_check("dim_vendor", 2, VENDORS),
            check("rows dim_zone", "'ok'", "count(*)", None, "FALSE", "(SELECT DISTINCT zone_id FROM raw)"),
        ]
    ),
    "dq_revenue": CLEAN + REVENUE_ROWS,
    "dq_summary": CLEAN
    + f""", issues AS (SELECT CASE WHEN (SELECT count(*) FROM raw) < {MIN_ROWS} THEN 1 ELSE 0 END
 + CASE WHEN (SELECT count(*) FROM fact) < {MIN_ROWS} THEN 1 ELSE 0 END
 + CASE WHEN (SELECT count(*) FROM fact WHERE event_type_id IS NULL) > 0 THEN 1 ELSE 0 END
 + CASE WHEN (SELECT count(*) FROM fact WHERE payment_method_id IS NULL) > 0 THEN 1 ELSE 0 END
 + CASE WHEN (SELECT count(*) FROM {VENDORS}) <> 2 THEN 1 ELSE 0 END AS n)
 SELECT CAST(25 AS BIGINT) AS checks, CAST(n AS BIGINT) AS issues, CASE WHEN n > 0 THEN 1 ELSE 0 END AS exit_code
 FROM issues""",
    # streaming
    "stream_parse": STREAM + f"SELECT {STREAM_OUT} FROM stream_rows",
    "stream_ingest": STREAM + f"SELECT {STREAM_OUT} FROM stream",
    "stream_dedup_state": STREAM + f"SELECT {STREAM_OUT} FROM stream",
    "stream_replay": STREAM + f"SELECT {STREAM_OUT} FROM stream",
    "stream_compacted": STREAM + f"SELECT {STREAM_OUT} FROM stream",
    "stream_keys": STREAM + "SELECT event_id, CAST(1 AS BIGINT) AS row_count FROM stream",
    "stream_time_range": STREAM
    + f"SELECT {STREAM_OUT} FROM stream WHERE event_timestamp >= TIMESTAMP '2024-02-01' AND event_timestamp < TIMESTAMP '2024-02-08'",
    "stream_counters": STREAM
    + f"""SELECT mode, (SELECT count(*) FROM dirty) AS received, (SELECT count(*) FROM stream) AS inserted,
 (SELECT count(*) FROM dirty WHERE ({STREAM_REASON}) IS NOT NULL) AS skipped,
 (SELECT count(*) FROM stream_rows WHERE is_anomaly) AS anomalies FROM (VALUES ('table'), ('state')) AS m(mode)""",
    "stream_first_in_order": "WITH "
    + raw_cte("raw")
    + f"""SELECT DISTINCT mode, lower(event_id) AS event_id,
 CAST(CAST(value AS DECIMAL(10,2)) + CASE WHEN k % 4 < 2 THEN 0 ELSE 4 - k % 4 END AS DOUBLE) AS value
 FROM raw, (VALUES ('table'), ('state')) AS m(mode) WHERE regexp_full_match(event_id, '{UUID_ANY}')""",
    "stream_rejects": STREAM
    + f"""SELECT {STREAM_REASON} AS reject_reason, count(*) AS row_count FROM dirty
 WHERE ({STREAM_REASON}) IS NOT NULL GROUP BY 1""",
    "stream_metrics": STREAM
    + """SELECT (SELECT count(*) FROM stream) AS inserted,
 (SELECT count(*) FROM dirty) - count(*) AS skipped, count(*) FILTER (WHERE is_anomaly) AS anomalies
 FROM stream_rows""",
    "stream_revenue_agg": STREAM
    + f"""SELECT date_trunc('day', event_timestamp)::TIMESTAMP AS window_start, event_type,
 count(*) AS total_events, {MONEY_IF_CLEAN} AS gross_revenue FROM stream GROUP BY 1, 2""",
    "freshness": CLEAN
    + """SELECT event_type_id, count(*) AS row_count, CAST(max(zone_id * 7 % 45) AS DOUBLE) AS max_lag_seconds,
 count(*) FILTER (WHERE zone_id * 7 % 45 <= 30) AS within_target FROM fact GROUP BY 1""",
    "freshness_over_batches": CLEAN
    + f""", lags AS (SELECT coalesce(event_type_id, -1) AS t, CAST(zone_id * 7 % 45 AS BIGINT) * 1000000 + entity_id % 1000 AS x FROM fact),
ranked AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY x) AS r, count(*) OVER (PARTITION BY t) AS n FROM lags),
p95 AS (SELECT t, min(x) AS q, CAST(greatest(length(bin(min(x))) - {aggregates.LAG_BITS}, 0) AS BIGINT) AS s FROM ranked WHERE 100 * r >= 95 * n GROUP BY 1)
SELECT CAST(nullif(t, -1) AS SMALLINT) AS event_type_id, count(*) AS row_count, CAST(max(x) AS DOUBLE) / 1000000 AS max_lag_seconds,
 CAST(any_value((((q >> s) + 1) << s) - 1) AS DOUBLE) / 1000000 AS p95_lag_seconds,
 count(*) FILTER (WHERE x <= 30000000) AS within_target FROM lags JOIN p95 USING (t) GROUP BY t""",
    "dual_sink": STREAM
    + """SELECT copy, CAST(date_trunc('month', event_timestamp) AS DATE) AS month, count(*) AS row_count,
 CAST(sum(total_value) AS DOUBLE) AS total_value
 FROM stream, (VALUES ('operational'), ('analytical')) AS c(copy) GROUP BY 1, 2""",
    "unified_events": "WITH "
    + raw_cte("raw")
    + ", "
    + raw_cte("dirty", True)
    + ", "
    + DIMS
    + ", "
    + fact_cte("fact", "raw")
    + ", "
    + STREAM_CTE
    + f""" SELECT {FACT_OUT} FROM fact UNION ALL
 SELECT {output([{"event_type_id": "et.id AS event_type_id", "payment_method_id": "pm.id AS payment_method_id"}.get(c, c) for c in schemas.FACT_COLUMNS])}
 FROM stream s LEFT JOIN dim_event_type et ON s.event_type = et.name
 LEFT JOIN dim_payment_method pm ON s.payment_method = pm.name
 WHERE event_id NOT IN (SELECT event_id FROM fact)""",
}

KEPT = (
    "WITH "
    + raw_cte("raw")
    + f""", loaded AS (SELECT * FROM raw WHERE event_timestamp < '{SECOND_LOAD_FROM}'
  UNION ALL SELECT * FROM {resent_rows("raw")} WHERE event_timestamp >= '{SECOND_LOAD_FROM}'), """
    + DIMS
    + ", "
    + fact_cte("every", "loaded")
    + ", fact AS (SELECT * FROM every WHERE event_timestamp >= TIMESTAMP '2024-02-01') "
)
ORACLES["anomaly_table"] = KEPT + f"SELECT {FACT_OUT} FROM fact WHERE is_anomaly"
ORACLES["daily_rollup_kept"] = KEPT + ORACLES["daily_rollup"].removeprefix(CLEAN)
ORACLES["entity_metrics_kept"] = KEPT + ORACLES["entity_metrics"].removeprefix(CLEAN)
ORACLES["stream_revenue_repeated"] = ORACLES["stream_revenue_agg"]
ORACLES["unified_table"] = f"""SELECT a.arrival, u.* FROM ({ORACLES["unified_events"]}) u
 CROSS JOIN (VALUES ('stream first'), ('facts first')) a(arrival)"""

"""The workload's queries as SQL over the same tables."""

from __future__ import annotations

TS = "%Y-%m-%d %H:%M:%S.%f"

APP_EVENTS = """
app AS (
    SELECT CAST(event_id AS VARCHAR) AS event_id,
           CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'search'
                ELSE event_type END AS event_type,
           ts AS event_ts, CAST(ts AS DATE) AS event_date, user_id,
           CASE k % 5 WHEN 0 THEN 'US' WHEN 1 THEN 'CA' WHEN 2 THEN 'GB' WHEN 3 THEN 'DE'
                ELSE 'FR' END AS country,
           CASE WHEN event_type = 'view' THEN
                CASE k % 6 WHEN 0 THEN '/home' WHEN 1 THEN '/search' WHEN 2 THEN '/product'
                     WHEN 3 THEN '/checkout' WHEN 4 THEN '/pricing' ELSE '/account' END END AS page,
           CASE WHEN event_type = 'click' THEN 'query ' || CAST(k % 5 AS VARCHAR) END AS query,
           CASE WHEN event_type = 'purchase' THEN value END AS amount,
           CASE WHEN event_type = 'error' THEN
                CASE k % 4 WHEN 0 THEN 'TimeoutError' WHEN 1 THEN 'NullPointerException'
                     WHEN 2 THEN 'SchemaMismatchError' ELSE 'ConnectionRefused' END END AS error_message,
           ts + to_minutes(CASE WHEN event_id % 5 = 0 THEN 30 + event_id % 1411 ELSE 1 END) AS ingested_at,
           event_id % 10 = 0 AS sent_twice
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
),
app_events AS (
    SELECT * EXCLUDE (sent_twice) FROM app
    UNION ALL
    SELECT * EXCLUDE (sent_twice) REPLACE (ingested_at + to_minutes(2880) AS ingested_at)
    FROM app WHERE sent_twice
)"""

SILVER = APP_EVENTS + """,
silver AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ingested_at DESC) AS rn
        FROM app_events)
    WHERE rn = 1
)"""


def _ts(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '{TS}') AS {name or column}"


def _date(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d') AS {name or column}"


def _two_runs(lookback: int) -> str:
    """Silver after a run on the first batch and one on everything."""
    return APP_EVENTS + f""",
early AS (SELECT * FROM app_events WHERE ingested_at <= TIMESTAMP '2024-01-20 00:00:00'),
window_start AS (SELECT max(event_date) - {lookback} AS first_day FROM early),
eligible AS (
    SELECT * FROM early WHERE event_date < (SELECT first_day FROM window_start)
    UNION ALL
    SELECT * FROM app_events WHERE event_date >= (SELECT first_day FROM window_start)
),
silver AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ingested_at DESC) AS rn
        FROM eligible)
    WHERE rn = 1
)"""


def _history(source: str, prefix: str = "") -> str:
    """Versions over `source(user_id, country, event_ts, turn, ingested_at, event_id)`."""
    order = "PARTITION BY user_id ORDER BY turn, event_ts, ingested_at, event_id"
    return f"""
{prefix}marked AS (
    SELECT *, lag(country) OVER ({order}) AS before FROM {source}
),
{prefix}history AS (
    SELECT user_id, country, event_ts AS effective_start,
           lead(event_ts) OVER ({order}) AS effective_end
    FROM {prefix}marked WHERE before IS NULL OR before <> country
)"""


FULL_BUILD = SILVER + ", timeline AS (SELECT *, 1 AS turn FROM silver)," + _history("timeline")

DIM_SELECT = f"""
SELECT user_id, country, {_ts('effective_start')}, {_ts('effective_end')},
       effective_end IS NULL AS is_current
FROM history"""

INCREMENTAL = SILVER + """,
batch1 AS (SELECT *, 1 AS turn FROM silver WHERE ingested_at <= TIMESTAMP '2024-01-20 00:00:00'),
batch2 AS (SELECT *, 1 AS turn FROM silver WHERE ingested_at > TIMESTAMP '2024-01-20 00:00:00'),
""" + _history("batch1", "first_") + """,
timeline AS (
    SELECT user_id, country, effective_start AS event_ts, 0 AS turn,
           NULL AS ingested_at, NULL AS event_id
    FROM first_history
    WHERE effective_end IS NULL AND user_id IN (SELECT user_id FROM batch2)
    UNION ALL
    SELECT user_id, country, event_ts, turn, ingested_at, event_id FROM batch2
),
""" + _history("timeline", "second_") + """,
history AS (
    SELECT * FROM first_history
    WHERE effective_end IS NOT NULL OR user_id NOT IN (SELECT user_id FROM batch2)
    UNION ALL
    SELECT * FROM second_history
)"""

FUNNEL = """
funnel AS (
    SELECT user_id, event_date,
           count(*) FILTER (WHERE event_type = 'search') AS searches,
           count(*) FILTER (WHERE event_type = 'page_view') AS page_views,
           count(*) FILTER (WHERE event_type = 'purchase') AS purchases
    FROM silver WHERE event_type IN ('search', 'page_view', 'purchase')
    GROUP BY user_id, event_date
)"""

RECORDS = """
records AS (
    SELECT CAST(event_id AS VARCHAR) AS record, '{' || concat_ws(',',
        CASE WHEN t = 10 THEN NULL WHEN t = 11 THEN '"event_id":' || event_id
             ELSE '"event_id":"' || event_id || '"' END,
        '"event_type":"' || event_type || '"',
        '"event_ts":' || CASE WHEN t = 15 THEN '"not a time"'
                              ELSE '"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '"' END,
        CASE WHEN t <> 9 THEN '"user_id":' || CASE t
            WHEN 1 THEN '"' || user_id || '"' WHEN 2 THEN '" ' || user_id || ' "'
            WHEN 3 THEN user_id || '.0' WHEN 4 THEN '"' || user_id || '.0"'
            WHEN 5 THEN 'true' WHEN 6 THEN user_id || '.5'
            WHEN 7 THEN '"abc"' WHEN 8 THEN 'null' ELSE CAST(user_id AS VARCHAR) END END,
        '"country":' || CASE WHEN t = 12 THEN '""' ELSE '"US"' END,
        CASE WHEN t = 13 THEN '"context":' || props END
        ) || CASE WHEN t <> 14 THEN '}' ELSE '' END AS body
    FROM (SELECT *, event_id % 16 AS t FROM events)
),
parsed AS (SELECT record, CASE WHEN json_valid(body) THEN body END AS j FROM records),
fields AS (
    SELECT record, j,
           json_type(j, '$.event_id') AS id_type, json_type(j, '$.event_type') AS kind_type,
           json_type(j, '$.event_ts') AS ts_type, json_type(j, '$.country') AS country_type,
           json_extract_string(j, '$.event_id') AS event_id,
           try_cast(json_extract_string(j, '$.event_ts') AS TIMESTAMP) AS event_ts,
           json_type(j, '$.user_id') AS user_type, json_extract_string(j, '$.user_id') AS user_text
    FROM parsed
),
users AS (
    SELECT *, CASE
        WHEN user_type = 'BOOLEAN' THEN CASE user_text WHEN 'true' THEN 1 ELSE 0 END
        WHEN user_type = 'VARCHAR' AND NOT regexp_full_match(user_text, '\\s*[+-]?[0-9]+(\\.0+)?\\s*') THEN NULL
        WHEN try_cast(trim(user_text) AS DOUBLE) % 1 = 0
            THEN CAST(try_cast(trim(user_text) AS DOUBLE) AS BIGINT) END AS user_id
    FROM fields
),
judged AS (
    SELECT *, CASE WHEN j IS NULL THEN 'corrupt_json'
        WHEN id_type IS DISTINCT FROM 'VARCHAR' THEN 'bad_event_id'
        WHEN kind_type IS DISTINCT FROM 'VARCHAR' THEN 'bad_event_type'
        WHEN ts_type IS DISTINCT FROM 'VARCHAR' THEN 'bad_event_ts'
        WHEN user_id IS NULL THEN 'bad_user_id'
        WHEN country_type IS DISTINCT FROM 'VARCHAR' THEN 'bad_country'
        WHEN event_ts IS NULL THEN 'unparsable_event_ts' END AS reason
    FROM users
)"""


def _checks(kind: str) -> str:
    """One SELECT per declared check of a kind, over tables built from all deliveries."""
    tables = SILVER + """,
stg_events AS (SELECT * FROM app_events),
mart_dau AS (SELECT event_date, count(DISTINCT user_id) AS daily_active_users
             FROM stg_events GROUP BY event_date),
mart_revenue AS (SELECT event_date, sum(amount) AS daily_revenue FROM stg_events
                 WHERE event_type = 'purchase' GROUP BY event_date),
mart_event_mix AS (SELECT event_date, event_type, count(*) AS event_count
                   FROM stg_events GROUP BY event_date, event_type),
""" + FUNNEL.replace("FROM silver", "FROM stg_events").replace("funnel AS", "mart_funnel AS") + """,
timeline AS (SELECT *, 1 AS turn FROM silver),
""" + _history("timeline") + """,
dim_user_current AS (SELECT * FROM history WHERE effective_end IS NULL)"""
    declared = {
        "not_null": {
            "stg_events": ["event_id", "event_type", "user_id", "event_ts", "ingested_at", "country"],
            "mart_dau": ["event_date", "daily_active_users"],
            "mart_revenue": ["event_date", "daily_revenue"],
            "mart_event_mix": ["event_date", "event_type", "event_count"],
            "mart_funnel": ["user_id", "event_date", "searches", "page_views", "purchases"],
            "dim_user_current": ["user_id", "country"],
        },
        "unique": {
            "stg_events": ["event_id"],
            "mart_dau": ["event_date"],
            "mart_revenue": ["event_date"],
            "dim_user_current": ["user_id"],
        },
        "accepted_values": {"stg_events": ["event_type"], "mart_event_mix": ["event_type"]},
    }[kind]
    failing = {
        "not_null": "SELECT 1 FROM {t} WHERE {c} IS NULL",
        "unique": "SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1",
        "accepted_values": "SELECT DISTINCT {c} FROM {t} "
        "WHERE {c} NOT IN ('page_view', 'search', 'purchase', 'error')",
    }[kind]
    selects = [
        f"SELECT '{t}' AS \"table\", '{kind}' AS \"check\", '{c}' AS \"column\", "
        f"(SELECT count(*) FROM ({failing.format(t=t, c=c)}) x) AS failing_rows"
        for t, columns in declared.items()
        for c in columns
    ]
    return f"WITH {tables}\n" + "\nUNION ALL\n".join(selects)


SILVER_SELECT = f"""
SELECT event_id, event_type, {_ts('event_ts')}, {_date('event_date')}, user_id, country,
       page, query, amount, error_message, {_ts('ingested_at')}"""

MART_ROWS = """
SELECT 'mart_dau' AS mart, strftime(event_date, '%Y-%m-%d') AS event_date, '' AS item,
       CAST(count(DISTINCT user_id) AS DOUBLE) AS amount
FROM silver GROUP BY event_date
UNION ALL
SELECT 'mart_revenue', strftime(event_date, '%Y-%m-%d'), '', round(sum(amount), 2)
FROM silver WHERE event_type = 'purchase' GROUP BY event_date
UNION ALL
SELECT 'mart_event_mix', strftime(event_date, '%Y-%m-%d'), event_type, CAST(count(*) AS DOUBLE)
FROM silver GROUP BY event_date, event_type
UNION ALL
SELECT 'mart_funnel', strftime(event_date, '%Y-%m-%d'),
       CAST(user_id AS VARCHAR) || '/' || step, CAST(n AS DOUBLE)
FROM (SELECT user_id, event_date, 'searches' AS step, searches AS n FROM funnel
      UNION ALL SELECT user_id, event_date, 'page_views', page_views FROM funnel
      UNION ALL SELECT user_id, event_date, 'purchases', purchases FROM funnel)"""

ORACLE_SQL = {
    "raw_json_scan": f"WITH {APP_EVENTS}"
    f"SELECT event_id, event_type, {_ts('event_ts')}, user_id, country, page, query, amount, "
    f"error_message, {_ts('ingested_at')} FROM app_events",
    "bronze_enrich": f"WITH {APP_EVENTS}"
    "SELECT event_id, event_type, user_id, "
    f"{_ts('event_ts')}, {_ts('ingested_at')}, {_date('event_date')}, "
    "'2024-02-05 00:00:00.000000' AS ingested_processing_ts, event_type AS source_folder FROM app_events",
    "bronze_lookback_scan": f"WITH {APP_EVENTS}"
    f"SELECT event_id, event_type, {_date('event_date')}, {_ts('ingested_at')} FROM app_events "
    "WHERE event_date >= DATE '2024-01-30' - 2",
    "silver_dedup_latest": f"WITH {SILVER}"
    f"SELECT event_id, user_id, country, {_ts('ingested_at')} FROM silver",
    "silver_events": f"WITH {SILVER}" + SILVER_SELECT + ", '2024-02-05 00:00:00.000000' "
    "AS ingested_processing_ts, 'adapter' AS source_file FROM silver",
    "silver_incremental": f"WITH {_two_runs(2)}" + SILVER_SELECT + " FROM silver",
    **{
        name: f"WITH {APP_EVENTS} SELECT event_id, event_type, {_date('event_date')}, {_ts('ingested_at')} FROM app_events"
        for name in ("bronze_two_streams", "bronze_backfill_twice")
    },
    "late_not_promoted": f"WITH {_two_runs(1)}, newest AS (SELECT * EXCLUDE (rn) FROM ("
    "SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ingested_at DESC) AS rn FROM app_events) WHERE rn = 1) "
    f"SELECT event_id, event_type, {_date('event_date')}, country, {_ts('ingested_at')} FROM newest n "
    "WHERE NOT EXISTS (SELECT 1 FROM silver s WHERE s.event_id = n.event_id AND s.ingested_at = n.ingested_at)",
    "silver_snapshot_read": f"WITH {APP_EVENTS}, newest AS (SELECT *, row_number() OVER (PARTITION BY event_id "
    "ORDER BY ingested_at DESC) AS rn FROM app_events WHERE ingested_at <= TIMESTAMP '2024-01-20 00:00:00') "
    + SILVER_SELECT + " FROM newest WHERE rn = 1",
    "silver_idle_run": f"WITH {_two_runs(2)}" + SILVER_SELECT + " FROM silver",
    "silver_incremental_short_lookback": f"WITH {_two_runs(1)}" + SILVER_SELECT + " FROM silver",
    "silver_by_type": f"WITH {SILVER}"
    "SELECT CASE event_type WHEN 'page_view' THEN 'silver_page_views' WHEN 'search' THEN 'silver_searches' "
    "WHEN 'purchase' THEN 'silver_purchases' ELSE 'silver_errors' END AS table_name, "
    f"event_id, {_ts('event_ts')}, {_date('event_date')}, user_id, country, {_ts('ingested_at')}, "
    "page, query, amount, error_message FROM silver "
    "WHERE event_type IN ('page_view', 'search', 'purchase', 'error')",
    "checkpoint_max_date": f"WITH {SILVER}"
    "SELECT strftime(max(event_date), '%Y-%m-%d') AS last_processed_event_date FROM silver",
    "scd_watermark": f"WITH {SILVER}SELECT strftime(max(ingested_at), '{TS}') AS watermark FROM silver",
    "stg_events": f"WITH {SILVER}"
    f"SELECT event_id, event_type, {_ts('event_ts')}, {_ts('ingested_at')}, user_id, country, page, "
    f"query, amount, {_date('event_date')} FROM silver",
    "mart_dau": f"WITH {SILVER}SELECT {_date('event_date')}, count(DISTINCT user_id) AS daily_active_users "
    "FROM silver GROUP BY silver.event_date",
    "mart_revenue": f"WITH {SILVER}SELECT {_date('event_date')}, round(sum(amount), 2) AS daily_revenue "
    "FROM silver WHERE event_type = 'purchase' GROUP BY silver.event_date",
    "mart_event_mix": f"WITH {SILVER}SELECT {_date('event_date')}, event_type, count(*) AS event_count "
    "FROM silver GROUP BY silver.event_date, event_type",
    "mart_funnel": f"WITH {SILVER},{FUNNEL}"
    f"SELECT user_id, {_date('event_date')}, searches, page_views, purchases FROM funnel",
    "mart_incremental": f"WITH {_two_runs(2)},{FUNNEL}{MART_ROWS}",
    "scd_incremental_filter": f"WITH {SILVER}"
    f"SELECT user_id, country, {_ts('event_ts')}, {_ts('ingested_at')} FROM silver "
    "WHERE ingested_at > TIMESTAMP '2024-01-28 00:00:00' AND user_id IS NOT NULL AND country IS NOT NULL",
    "scd2_full_build": f"WITH {FULL_BUILD}{DIM_SELECT}",
    "scd2_full_build_pieces": f"WITH {FULL_BUILD}{DIM_SELECT}",
    "scd2_incremental_apply": f"WITH {INCREMENTAL}{DIM_SELECT}",
    "scd2_rebuild_touched": f"WITH {FULL_BUILD}{DIM_SELECT}",
    "scd2_replay": f"WITH {FULL_BUILD}{DIM_SELECT}",
    "dim_user_current": f"WITH {FULL_BUILD}{DIM_SELECT} WHERE effective_end IS NULL",
    "preview_current_users": f"WITH {FULL_BUILD}{DIM_SELECT} WHERE effective_end IS NULL "
    "ORDER BY user_id LIMIT 10",
    "preview_dau": f"WITH {SILVER}SELECT {_date('event_date')}, count(DISTINCT user_id) AS daily_active_users "
    "FROM silver GROUP BY silver.event_date ORDER BY silver.event_date LIMIT 10",
    "validate_events": f"WITH {RECORDS}"
    "SELECT record, CASE WHEN reason IS NULL THEN 'valid' ELSE 'quarantined' END AS verdict, "
    "coalesce(reason, '') AS reason, "
    "coalesce(CASE WHEN reason IS NULL THEN CAST(user_id AS VARCHAR) END, '') AS user_id FROM judged",
    "landing_stream": f"WITH {RECORDS}"
    "SELECT 'raw' AS sink, event_id AS item, 1 AS n FROM judged WHERE reason IS NULL "
    "UNION ALL SELECT 'log', event_id, 1 FROM judged WHERE reason IS NULL "
    "UNION ALL SELECT 'rejected', reason, count(*) FROM judged WHERE reason IS NOT NULL GROUP BY reason",
    "schema_evolution": "SELECT CAST(event_id AS VARCHAR) AS event_id, "
    "CASE WHEN ts >= TIMESTAMP '2024-01-16 00:00:00' "
    "THEN CAST(json_extract_string(props, '$.k') AS BIGINT) ELSE -1 END AS nested_k, "
    "CASE WHEN event_type = 'error' AND ts >= TIMESTAMP '2024-01-16 00:00:00' "
    "THEN event_type ELSE '' END AS error_message FROM events",
    "schema_registry": "WITH found AS (SELECT CASE WHEN ts >= TIMESTAMP '2024-01-16 00:00:00' THEN 2 ELSE 1 END AS version, "
    "bool_or(user_id IS NOT NULL) AS has_user, bool_or(json_extract(props, '$.k') IS NOT NULL) AS has_k "
    "FROM events GROUP BY ALL) "
    "SELECT version, 'generation ' || version AS load, path, type, change, type_before FROM found JOIN (VALUES "
    "(1, 'event_id', 'STRING', 'added', ''), (1, 'score', 'BIGINT', 'added', ''), (1, 'session', 'BIGINT', 'added', ''), "
    "(2, 'score', 'DOUBLE', 'widened', 'BIGINT'), (2, 'session', 'VARIANT', 'conflict', 'BIGINT'), "
    "(2, 'context.k', 'BIGINT', 'added', '')) t(v, path, type, change, type_before) ON version = v "
    "WHERE path = 'event_id' OR (path = 'context.k' AND has_k) OR (path IN ('score', 'session') AND has_user)",
    "ingestion_log": f"WITH {APP_EVENTS}"
    "SELECT 'event_ingested' AS type, md5(event_id) AS request_id, event_id, event_type, "
    f"{_ts('ingested_at')}, "
    "strftime(ingested_at, '%Y-%m-%d') AS log_date FROM app_events",
    "dq_not_null": _checks("not_null"),
    "dq_unique": _checks("unique"),
    "dq_accepted_values": _checks("accepted_values"),
    "dimension_lookback_change": f"WITH {FULL_BUILD}{DIM_SELECT}",
    "pipeline_dimension": f"WITH {FULL_BUILD}{DIM_SELECT}",
    "pipeline_marts": f"WITH {_two_runs(2)},{FUNNEL}{MART_ROWS}",
}
ORACLE_SQL["mart_funnel_join"] = ORACLE_SQL["mart_funnel"]

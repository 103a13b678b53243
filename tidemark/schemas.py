"""Column lists and fixed values of the data model."""

from __future__ import annotations

# The event types the quality checks accept.
EVENT_TYPES = ["page_view", "search", "purchase", "error"]

# Required fields of an event. All are text except user_id, a 64-bit integer.
REQUIRED_TEXT = ["event_id", "event_type", "event_ts", "country"]

# Optional fields, kept as received; the whole record stays in `payload`.
OPTIONAL_TEXT = [
    "page", "query", "amount", "currency", "error_message", "severity",
    "ingested_at", "request_id",
]

BRONZE_COLUMNS = [
    "event_id", "event_type", "event_ts", "user_id", "country", *OPTIONAL_TEXT,
    "payload", "raw_text", "reason",
    "ingested_processing_ts", "source_file", "verdict", "event_date",
]

# How the bronze table reads back (partition columns last; `load` names the load it came with).
# `type_folder` is the event type where it is a known one, so that clients can't make folders.
BRONZE_SCHEMA = """
    event_id string, event_type string, event_ts string, user_id bigint, country string,
    page string, query string, amount string, currency string,
    error_message string, severity string, ingested_at string, request_id string,
    payload variant, raw_text string, reason string,
    ingested_processing_ts timestamp_ntz, source_file string,
    verdict string, event_date date, type_folder string, load string
"""

SILVER_COLUMNS = [
    "event_id", "event_type", "event_ts", "event_date", "user_id", "country",
    "page", "query", "amount", "error_message", "ingested_at",
    "ingested_processing_ts", "source_file",
]

# `run` names the promotion that wrote a row.
SILVER_SCHEMA = """
    event_id string, event_type string, event_ts timestamp_ntz, user_id bigint, country string,
    page string, query string, amount double, error_message string, ingested_at string,
    ingested_processing_ts timestamp_ntz, source_file string, run string,
    event_date date, type_folder string
"""

STAGING_COLUMNS = [
    "event_id", "event_type", "event_ts", "ingested_at", "user_id", "country",
    "page", "query", "amount", "event_date",
]

DIM_COLUMNS = ["user_id", "country", "effective_start", "effective_end", "is_current"]

DIM_SCHEMA = """
    user_id bigint, country string, effective_start timestamp_ntz,
    effective_end timestamp_ntz, is_current boolean
"""

# Columns each per-type silver table adds to the common ones.
COMMON_COLUMNS = ["event_id", "event_ts", "event_date", "user_id", "country", "ingested_at"]
TYPE_TABLES = {
    "silver_page_views": ("page_view", ["page"]),
    "silver_searches": ("search", ["query"]),
    "silver_purchases": ("purchase", ["amount"]),
    "silver_errors": ("error", ["error_message"]),
}

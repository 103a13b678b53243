"""Ingestion stamp and ingestion log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import utc_now

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def stamp(events: DataFrame, at: Column | None = None) -> DataFrame:
    """Add `ingested_at` (UTC ISO text) and a `request_id`.

    The id is random: write the stamped rows once and read them back, do not
    evaluate them twice.
    """
    now = utc_now() if at is None else at
    return events.withColumns(
        {"ingested_at": F.date_format(now, ISO_MICROS), "request_id": F.uuid()}
    )


def ingestion_log(events: DataFrame) -> DataFrame:
    """One `event_ingested` record per landed event, with its UTC log date."""
    return events.select(
        F.lit("event_ingested").alias("type"),
        "request_id",
        "event_id",
        "event_type",
        "ingested_at",
        F.substring("ingested_at", 1, 10).alias("log_date"),
    )

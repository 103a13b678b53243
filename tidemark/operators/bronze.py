"""Bronze: validated raw records with load metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import utc_now, utc_timestamp
from tidemark.operators.validate import validate


def enrich(events: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Add `ingested_processing_ts` (one value per run) and `event_date`."""
    now = utc_now() if processed_at is None else processed_at
    return events.withColumns(
        {
            "ingested_processing_ts": now,
            "event_date": F.to_date(utc_timestamp(F.col("event_ts"))),
        }
    )


def bronze(raw: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Raw records to bronze rows, quarantined ones included.

    Fields of a rejected record are blanked so that garbage never becomes a
    partition directory; the record itself stays in `payload` / `raw_text`.
    """
    judged = enrich(validate(raw), processed_at)
    valid = F.col("verdict") == "valid"
    kept_as_is = {"payload", "raw_text", "reason", "verdict", "ingested_processing_ts", "source_file"}
    return judged.select(
        *[
            F.col(name) if name in kept_as_is else F.when(valid, F.col(name)).alias(name)
            for name in schemas.BRONZE_COLUMNS
        ]
    )


def lookback(events: DataFrame, checkpoint: str, days: int = 2) -> DataFrame:
    """Events dated no earlier than `days` before the checkpoint; prunes partitions."""
    return events.filter(F.col("event_date") >= F.date_sub(F.to_date(F.lit(checkpoint)), days))

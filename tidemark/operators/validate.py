"""Event validation: every record is either valid or quarantined with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import text_field, utc_timestamp, whole_number
from tidemark.functions.parse import field_kind


def _reason() -> Column:
    """First rule a record breaks, NULL for a valid one."""
    payload = F.col("payload")
    checks = F.when(payload.isNull(), F.lit("corrupt_json"))
    for name in schemas.REQUIRED_TEXT[:3]:
        checks = checks.when(~F.equal_null(field_kind(payload, name), F.lit("STRING")), f"bad_{name}")
    checks = checks.when(F.col("user_id").isNull(), "bad_user_id")
    checks = checks.when(
        ~F.equal_null(field_kind(payload, "country"), F.lit("STRING")), "bad_country"
    )
    # Text that is no timestamp has no event date and could never be promoted.
    return checks.when(utc_timestamp(F.col("event_ts")).isNull(), "unparsable_event_ts")


def extract_fields(raw: DataFrame) -> DataFrame:
    """Pull the known fields out of `payload`; what is absent is NULL, extras stay in `payload`."""
    payload = F.col("payload")
    texts = [*schemas.REQUIRED_TEXT, *schemas.OPTIONAL_TEXT]
    return raw.select(
        *[text_field(payload, name).alias(name) for name in texts],
        whole_number(payload, "user_id").alias("user_id"),
        *raw.columns,
    )


def validate(raw: DataFrame) -> DataFrame:
    """Add the known fields, `reason` and `verdict` ('valid' / 'quarantined') to raw records."""
    judged = extract_fields(raw).withColumn("reason", _reason())
    return judged.withColumn(
        "verdict", F.when(F.col("reason").isNull(), "valid").otherwise("quarantined")
    )


def valid_events(judged: DataFrame) -> DataFrame:
    return judged.filter("reason is null").drop("reason", "verdict", "raw_text")


def quarantined(judged: DataFrame) -> DataFrame:
    return judged.filter("reason is not null").select("reason", "payload", "raw_text", "source_file")

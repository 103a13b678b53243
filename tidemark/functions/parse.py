"""Parsing of loosely typed event fields with built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A letter or a sign after the minutes means the text carries its own zone.
_ZONED = r":\d{2}.*([A-Za-z]|[+-]\d)"
_WHOLE_TEXT = r"^\s*([+-]?\d+)(\.0+)?\s*$"
_EXACT = 2.0**53  # doubles above may stand for several integers


def utc_timestamp(text: Column) -> Column:
    """ISO text to a zone-free UTC timestamp, NULL when it does not parse.

    Text without a zone is taken as UTC whatever the session zone is; text with
    an offset is converted.
    """
    zoned = F.convert_timezone(
        None, F.lit("UTC"), F.try_to_timestamp(text).cast("timestamp_ntz")
    )
    return F.when(text.rlike(_ZONED), zoned).otherwise(text.try_cast("timestamp_ntz"))


def utc_now() -> Column:
    """Start time of the query as a zone-free UTC timestamp."""
    return F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())


def text_field(payload: Column, name: str) -> Column:
    """A top-level field of a variant as text, NULL when absent."""
    return F.try_variant_get(payload, f"$.{name}", "string")


def field_kind(payload: Column, name: str) -> Column:
    """JSON type of a top-level field ('STRING', 'BIGINT', ...), NULL when absent."""
    return F.schema_of_variant(F.try_variant_get(payload, f"$.{name}", "variant"))


def whole_number(payload: Column, name: str) -> Column:
    """A top-level field as bigint: integers, integral floats, booleans and text of those.

    Fractions, other text and NULL give NULL. Digits are judged as text, so nothing is rounded;
    a number with an exponent is a double, and counts as far as doubles are exact.
    """
    kind = field_kind(payload, name)
    digits = F.regexp_extract(text_field(payload, name), _WHOLE_TEXT, 1)
    double = F.try_variant_get(payload, f"$.{name}", "double")
    whole_double = F.when((double == F.floor(double)) & (F.abs(double) <= _EXACT), double.try_cast("bigint"))
    return (
        F.when(kind == "BOOLEAN", F.try_variant_get(payload, f"$.{name}", "bigint"))
        .when(kind == "DOUBLE", whole_double)
        .otherwise(F.when(digits != "", digits.try_cast("bigint")))
    )

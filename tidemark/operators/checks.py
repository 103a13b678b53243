"""Declared data-quality checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import EVENT_TYPES

# Which check applies to which column.
CHECKS = {
    "stg_events": {
        "not_null": ["event_id", "event_type", "user_id", "event_ts", "ingested_at", "country"],
        "unique": ["event_id"],
        "accepted_values": ["event_type"],
    },
    "mart_dau": {"not_null": ["event_date", "daily_active_users"], "unique": ["event_date"]},
    "mart_revenue": {"not_null": ["event_date", "daily_revenue"], "unique": ["event_date"]},
    "mart_event_mix": {
        "not_null": ["event_date", "event_type", "event_count"],
        "accepted_values": ["event_type"],
    },
    "mart_funnel": {
        "not_null": ["user_id", "event_date", "searches", "page_views", "purchases"],
    },
    "dim_user_current": {"not_null": ["user_id", "country"], "unique": ["user_id"]},
}


def nulls(table: DataFrame, column: str) -> DataFrame:
    """Rows without a value."""
    return table.filter(F.col(column).isNull())


def duplicates(table: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with how often; NULL is no value."""
    return (
        table.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n_rows"))
        .filter("n_rows > 1")
    )


def unaccepted(table: DataFrame, column: str, accepted: list[str]) -> DataFrame:
    """Values outside the accepted list, with how often; NULL passes."""
    return (
        table.filter(~F.col(column).isin(accepted))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n_rows"))
    )


def null_counts(table: DataFrame, columns: list[str]) -> DataFrame:
    """`(column, failing_rows)` for all columns in one pass."""
    counted = table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], columns, "column", "failing_rows")


def _labelled(result: DataFrame, table: str, check: str) -> DataFrame:
    return result.select(
        F.lit(table).alias("table"), F.lit(check).alias("check"), "column", "failing_rows"
    )


def run_checks(
    tables: dict[str, DataFrame], kinds: tuple[str, ...] = ("not_null", "unique", "accepted_values")
) -> DataFrame:
    """`(table, check, column, failing_rows)` for every declared check on the given tables.

    `failing_rows` counts rows for not_null and distinct values for the other two.
    """
    results = []
    for name, declared in CHECKS.items():
        if name not in tables:
            continue
        table = tables[name]
        for kind in kinds:
            columns = declared.get(kind, [])
            if kind == "not_null" and columns:
                results.append(_labelled(null_counts(table, columns), name, kind))
                continue
            for column in columns:
                bad = (
                    duplicates(table, column)
                    if kind == "unique"
                    else unaccepted(table, column, EVENT_TYPES)
                )
                count = bad.agg(F.count("*").alias("failing_rows")).withColumn("column", F.lit(column))
                results.append(_labelled(count, name, kind))
    return reduce(DataFrame.unionByName, results)


def failing_rows(tables: dict[str, DataFrame]) -> dict[tuple[str, str, str], DataFrame]:
    """The offending rows or values of every declared check, to look into a failure."""
    found = {}
    for name, declared in CHECKS.items():
        if name not in tables:
            continue
        for kind, columns in declared.items():
            for column in columns:
                if kind == "not_null":
                    bad = nulls(tables[name], column)
                elif kind == "unique":
                    bad = duplicates(tables[name], column)
                else:
                    bad = unaccepted(tables[name], column, EVENT_TYPES)
                found[(name, kind, column)] = bad
    return found

"""Staging view and marts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas


def stg_events(silver: DataFrame) -> DataFrame:
    """The staging columns, with the date taken from the event time."""
    return silver.withColumn("event_date", F.to_date("event_ts")).select(schemas.STAGING_COLUMNS)


def mart_dau(stg: DataFrame) -> DataFrame:
    """Distinct users per day; events without a user do not count."""
    return stg.groupBy("event_date").agg(F.count_distinct("user_id").alias("daily_active_users"))


def mart_revenue(stg: DataFrame) -> DataFrame:
    """Purchase amounts per day, all currencies together; NULL if no amount is known."""
    return (
        stg.filter(F.col("event_type") == "purchase")
        .groupBy("event_date")
        .agg(F.sum("amount").alias("daily_revenue"))
    )


def mart_event_mix(stg: DataFrame) -> DataFrame:
    return stg.groupBy("event_date", "event_type").agg(F.count("*").alias("event_count"))


# Event type counted by each funnel column.
FUNNEL_STEPS = {"searches": "search", "page_views": "page_view", "purchases": "purchase"}


def mart_funnel(stg: DataFrame) -> DataFrame:
    """Searches, page views and purchases per user and day, in one aggregation.

    A missing user or day matches nothing in the join form, so there each type
    keeps its own row; grouping such rows by type as well gives the same rows.
    """
    unmatched = F.when(
        F.col("user_id").isNull() | F.col("event_date").isNull(), F.col("event_type")
    )
    return (
        stg.filter(F.col("event_type").isin(list(FUNNEL_STEPS.values())))
        .groupBy("user_id", "event_date", unmatched.alias("unmatched_type"))
        .agg(
            *[
                F.count_if(F.col("event_type") == step).alias(name)
                for name, step in FUNNEL_STEPS.items()
            ]
        )
        .drop("unmatched_type")
    )


def mart_funnel_join(stg: DataFrame) -> DataFrame:
    """The funnel as two full outer joins of per-type counts."""
    keys = ["user_id", "event_date"]
    per_step = [
        stg.filter(F.col("event_type") == step).groupBy(*keys).agg(F.count("*").alias(name))
        for name, step in FUNNEL_STEPS.items()
    ]
    joined = reduce(lambda left, right: left.join(right, keys, "full_outer"), per_step)
    return joined.na.fill(0, list(FUNNEL_STEPS))


def preview(table: DataFrame, order_by: str, rows: int = 10) -> DataFrame:
    """First rows of a table for a look at it."""
    return table.orderBy(order_by).limit(rows)

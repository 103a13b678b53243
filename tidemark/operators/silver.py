"""Silver: typed events, one row per event_id."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import utc_timestamp

# Newest delivery first; later fields only settle ties.
NEWEST_FIRST = ["ingested_processing_ts", "ingested_at", "source_file"]


def normalize(bronze: DataFrame) -> DataFrame:
    """Parse `event_ts`, type `amount` and keep the silver columns."""
    return bronze.withColumns(
        {
            "event_ts": utc_timestamp(F.col("event_ts")),
            "amount": F.col("amount").try_cast("double"),
        }
    ).select(schemas.SILVER_COLUMNS)


def latest(events: DataFrame, key: str = "event_id", newest_first: list[str] | None = None) -> DataFrame:
    """Keep the newest row per key.

    Remaining columns break ties, so the choice does not depend on row order. The
    planner keeps each task's best row per key before the shuffle, so any number
    of copies of one key costs one row per task.
    """
    first = newest_first or NEWEST_FIRST
    rest = [c for c in events.columns if c not in {key, *first}]
    order = [F.col(c).desc_nulls_last() for c in [*first, *rest]]
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return events.withColumn("rn", rank).filter("rn = 1").drop("rn")


def silver(bronze: DataFrame) -> DataFrame:
    return latest(normalize(bronze))


def type_tables(silver: DataFrame) -> dict[str, DataFrame]:
    """Per-type silver tables: a pruned scan with the columns of that type."""
    return {
        table: silver.filter(F.col("event_type") == event_type).select(
            *schemas.COMMON_COLUMNS, *extra
        )
        for table, (event_type, extra) in schemas.TYPE_TABLES.items()
    }

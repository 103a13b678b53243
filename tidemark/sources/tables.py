"""Partitioned Parquet tables."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.sources.snapshots import Snapshot, Snapshots

SILVER_BY = ["event_date", "type_folder"]
BRONZE_BY = ["verdict", *SILVER_BY]
OTHER_TYPES = "other"  # the folder that unknown event types share


def dates_from(day: dt.date) -> str:
    """Path pattern for the ISO dates from `day` on."""
    text = day.isoformat()
    later = [
        f"{text[:i]}[{int(digit) + 1}-9]*"
        for i, digit in enumerate(text)
        if digit.isdigit() and digit < "9"
    ]
    return "{" + ",".join([text, *later]) + "}"


def read_table(
    spark: SparkSession, path: str, schema: str, since: dt.date | None = None, inside: str = ""
) -> DataFrame:
    """A Parquet table under a fixed schema; an empty DataFrame if it was never written.

    With `since` only the folders of later dates are listed, so that the cost of
    finding the files of a window does not grow with the history before it.
    """
    folder = path + inside
    if since is not None:
        folder += f"/event_date={dates_from(since)}"
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_bronze(
    spark: SparkSession, path: str, since: dt.date | None = None, with_load: bool = False
) -> DataFrame:
    """Accepted bronze events; `with_load` adds the name of the load that each came with."""
    table = read_table(spark, path, schemas.BRONZE_SCHEMA, since, "/verdict=valid")
    hidden = ["verdict", "type_folder", "raw_text", "reason"]
    return table.drop(*hidden) if with_load else table.drop(*hidden, "load")


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Rejected records with the reason and the record as received."""
    table = read_table(spark, path, schemas.BRONZE_SCHEMA, inside="/verdict=quarantined")
    return table.select(
        "reason", "payload", "raw_text", "ingested_processing_ts", "source_file"
    )


def read_silver(
    spark: SparkSession,
    path: str,
    since: dt.date | None = None,
    event_type: str | None = None,
    snapshot: int | None = None,
) -> DataFrame:
    """Silver events as last published, or of an earlier snapshot; of one type only its folders are read."""
    snapshots = Snapshots(spark, path)
    found = snapshots.begin() if snapshot is None else snapshots.at(snapshot)
    table = found.read("", schemas.SILVER_SCHEMA, since)
    if event_type is not None:
        table = table.filter((F.col("type_folder") == _folder_of(F.lit(event_type))) & (F.col("event_type") == event_type))
    return table.select(schemas.SILVER_COLUMNS)


def _folder_of(event_type: Column) -> Column:
    """The type itself if it is a known one, else the shared folder; null stays null."""
    return F.when(event_type.isin(schemas.EVENT_TYPES), event_type).when(event_type.isNotNull(), OTHER_TYPES)


def write_partitioned(df: DataFrame, path: str, by: list[str], mode: str = "append") -> None:
    """Write Parquet partitioned by `by`; "replace" swaps only the partitions present in `df`.

    REBALANCE gathers a partition's rows into few files and, with adaptive execution,
    splits a partition that is too big for one task.
    """
    writer = df.hint("rebalance", *by).write.partitionBy(*by)
    if mode == "replace":
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        writer.mode(mode).parquet(path)


def write_load(bronze: DataFrame, path: str, load: object) -> None:
    """Add the bronze rows of one load; repeating a load replaces what it wrote before.

    `load` must be the load's own among all writers of the table: a stream's id and batch, or
    a new name for every backfill.
    """
    rows = bronze.withColumns({"type_folder": _folder_of(F.col("event_type")), "load": F.lit(str(load))})
    write_partitioned(rows, path, [*BRONZE_BY, "load"], "replace")


def write_silver(
    silver: DataFrame,
    path: str,
    run: str,
    since: dt.date | None = None,
    dates: list[dt.date] | None = None,
    begun: Snapshot | None = None,
) -> Snapshot:
    """Publish `silver` in the place of the dates from `since` on (of these the given `dates`); returns the snapshot.

    Dates that lost all their events go with it. `run` must be new with every call. `begun` is the snapshot that
    `silver` was computed from; if another run has published since, ConflictingRunError is raised and
    readers see nothing of this one.
    """
    begun = begun or Snapshots(silver.sparkSession, path).begin()
    rows = silver.withColumn("type_folder", _folder_of(F.col("event_type")))
    write_partitioned(rows, f"{path}/run={run}", SILVER_BY, "overwrite")
    return begun.publish({"": run}, since, dates)

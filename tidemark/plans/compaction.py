"""Folding the many small loads of bronze's closed dates into few.

Every load has folders of its own, so that a retried load replaces itself. Once a date is before
the lookback window its loads are folded: as soon as a partition holds `fold` loads of
one level they become one load of the next level. A partition so keeps fewer than
`fold` loads a level, and a row is rewritten once per level, however many loads come.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.plans.paths import Paths
from tidemark.sources.scratch import remove_folder
from tidemark.sources.state import RunState
from tidemark.sources.tables import BRONZE_BY, read_table, write_partitioned

FOLD = 32
_LEVEL = r"^compact(\d+)-"
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # how Spark names the folder of a null


def _level() -> Column:
    found = F.regexp_extract("load", _LEVEL, 1)
    return F.when(found != "", found.cast("int")).otherwise(0)


def _full_groups(table: DataFrame, fold: int) -> list:
    """Partition, level and loads wherever `fold` loads or more share them.

    Only partition columns are read. As many rows reach the driver as there are folders to fold.
    """
    plain = table.filter(F.col("load").rlike(r"^[\w.-]+$"))  # names that a folder shows as they are
    loads = plain.select(*BRONZE_BY, "load", _level().alias("level")).distinct()
    groups = loads.groupBy(*BRONZE_BY, "level").agg(F.collect_list("load").alias("loads"))
    return groups.filter(F.size("loads") >= fold).collect()


def _folder(paths: Paths, group, load: str) -> str:
    parts = [f"{c}={_NO_VALUE if group[c] is None else group[c]}" for c in BRONZE_BY]
    return "/".join([paths.bronze, *parts, f"load={load}"])


def finish_compaction(spark: SparkSession, paths: Paths) -> None:
    """Bring a compaction that died to an end: the old folders go if the new ones were complete,
    else the new ones."""
    state = RunState(spark, paths.state)
    pending = json.loads(state.get("compaction", "null"))
    if pending:
        for folder in pending["old"] if pending["written"] else pending["new"]:
            remove_folder(spark, folder)
        state.put("compaction", "null")


def compact_bronze(
    spark: SparkSession, paths: Paths, before: dt.date, since: dt.date | None = None, fold: int = FOLD
) -> int:
    """Fold the loads of dates before `before` (and from `since` on), and those of the quarantine;
    returns the number of folders that went.

    Call it when the streams' batches are committed, one call at a time: a batch that is retried
    after its load was folded adds its rows again, which silver takes for copies of an event. A
    reader that comes while folders are exchanged can see rows twice.
    """
    finish_compaction(spark, paths)
    valid = read_table(spark, paths.bronze, schemas.BRONZE_SCHEMA, since, "/verdict=valid")
    rejected = read_table(spark, paths.bronze, schemas.BRONZE_SCHEMA, inside="/verdict=quarantined")
    closed = valid.filter(F.col("event_date") < F.lit(before))
    groups = _full_groups(closed, fold) + _full_groups(rejected, fold)
    if not groups:
        return 0
    old = [_folder(paths, g, load) for g in groups for load in g["loads"]]
    run = uuid.uuid4().hex
    new = [_folder(paths, g, f"compact{g['level'] + 1}-{run}") for g in groups]
    step = RunState(spark, paths.state).begin()
    step.commit({"compaction": json.dumps({"old": old, "new": new, "written": False})})
    rows = spark.read.schema(schemas.BRONZE_SCHEMA).option("basePath", paths.bronze).parquet(*old)
    folded = F.concat(F.lit("compact"), (_level() + 1).cast("string"), F.lit(f"-{run}"))
    write_partitioned(rows.withColumn("load", folded), paths.bronze, [*BRONZE_BY, "load"])
    step.commit({"compaction": json.dumps({"old": old, "new": new, "written": True})})
    finish_compaction(spark, paths)
    return len(old)

"""Raw -> bronze -> silver -> user dimension -> marts -> checks, one run after another."""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import bronze as bronze_ops
from tidemark.operators import silver as silver_ops
from tidemark.operators.checks import failing_rows, run_checks
from tidemark.operators.scd import user_bucket
from tidemark.plans.changes import USER_BUCKETS, with_run
from tidemark.plans.compaction import compact_bronze
from tidemark.plans.dimension import read_current_users, update_dimension
from tidemark.plans.marts import MARTS, read_mart, stage, update_marts
from tidemark.plans.paths import Paths
from tidemark.schemas import BRONZE_SCHEMA, SILVER_COLUMNS, SILVER_SCHEMA
from tidemark.sources.raw import read_raw, stream_raw
from tidemark.sources.scratch import scratch_dir
from tidemark.sources.snapshots import Snapshot, Snapshots
from tidemark.sources.state import EPOCH, RunState
from tidemark.sources.tables import (
    read_bronze,
    read_silver,
    read_table,
    write_load,
    write_silver,
)
from tidemark.streaming.jobs import land_events, load_bronze

LOOKBACK_DAYS = 2
COMPACT_DAYS = 30  # closed dates that a run looks at; `compact_bronze` by itself takes all


def backfill_bronze(spark: SparkSession, paths: Paths, modified_after: str | None = None) -> None:
    """Load the raw files that bronze has no record of, as a load of its own.

    For a first load without a stream, and for files that a stream passed over.
    """
    loaded = read_table(spark, paths.bronze, BRONZE_SCHEMA).select("source_file").distinct()
    raw = read_raw(spark, paths.raw, modified_after).join(loaded, "source_file", "left_anti")
    write_load(bronze_ops.bronze(raw), paths.bronze, f"backfill-{uuid.uuid4().hex}")


def promote(
    spark: SparkSession,
    paths: Paths,
    lookback_days: int = LOOKBACK_DAYS,
    today: dt.date | None = None,
) -> str | None:
    """Bring the silver partitions inside the lookback window up to date with bronze.

    Returns the new checkpoint, or None when the window holds no rows. Partitions
    before the window are not read and not touched.

    What the window holds is known per date and load. Loads that are new since the last run
    touch only the dates of their events and of those events' other copies; the rest of the window
    is left alone. If a load known before has changed, or the window reaches further back than
    before, the whole window is rebuilt. Without any change nothing is written, and the
    dimension and the marts find nothing to do. Raises ConflictingRunError if another run has saved
    its state meanwhile; run it again then.
    """
    step = RunState(spark, paths.state).begin()
    begun = Snapshots(spark, paths.silver).begin()
    checkpoint = step.get("silver_checkpoint", EPOCH)
    since = dt.date.fromisoformat(checkpoint) - dt.timedelta(days=lookback_days)
    bronze = read_bronze(spark, paths.bronze, since, with_load=True)
    window = bronze_ops.lookback(bronze, checkpoint, lookback_days)
    held = _held(window)
    seen = json.loads(step.get("silver_window", "null"))
    run = int(step.get("silver_run", "0")) + 1
    known = {k: v for k, v in seen["held"].items() if k >= since.isoformat()} if seen else {}
    if seen and since.isoformat() >= seen["since"] and known.items() <= held.items():
        if known == held:
            return checkpoint
        loads = sorted({k.split("/", 1)[1] for k in held.keys() - known.keys()})
        published, dates, users = _promote_loads(spark, begun, window, loads, since)
    else:
        rows = silver_ops.silver(window.drop("load"))
        published = write_silver(rows, paths.silver, uuid.uuid4().hex, since, begun=begun)
        dates = users = None
    held_dates = published.dates("", since)
    if not held_dates:
        return None
    # An event dated in the future must not push on-time events out of the window.
    limit = today or dt.datetime.now(dt.timezone.utc).date()
    moved = max(checkpoint, min(held_dates[-1], limit).isoformat())
    # Later runs look back from the new checkpoint, or further if the lookback grows.
    later = (dt.date.fromisoformat(moved) - dt.timedelta(days=lookback_days)).isoformat()
    kept = {k: v for k, v in held.items() if k >= later}
    step.commit({
        "silver_changes": with_run(step, run, since, dates, users),
        "silver_run": run,
        "silver_checkpoint": moved,
        "silver_window": json.dumps({"since": later, "held": kept}),
    })
    return moved


def _held(window: DataFrame) -> dict[str, list[int]]:
    """Rows and a hash of them per date and load, as "date/load": as many as bronze has folders
    for the window."""
    parts = window.groupBy("event_date", "load").agg(
        F.count("*").alias("rows"),
        F.bit_xor(F.xxhash64("event_id", "source_file", "ingested_at", "ingested_processing_ts")).alias("hash"),
    )
    return {f"{r['event_date'].isoformat()}/{r['load']}": [r["rows"], r["hash"]] for r in parts.collect()}


def _promote_loads(
    spark: SparkSession, begun: Snapshot, window: DataFrame, loads: list[str], since: dt.date
) -> tuple[Snapshot, list[dt.date], list[int]]:
    """Take the events of some loads into silver; returns the snapshot, the dates it has rewritten, and the
    buckets of the users of these events' copies.

    The newest copy of each such event is chosen among all its copies in the window. The dates
    of all these copies are rewritten, with their other events as they stand; that bronze alone
    names the dates makes a run that failed half-way name them all again.
    """
    fresh = window.filter(F.col("load").isin(loads)).select("event_id").distinct()
    copies = window.drop("load").join(fresh, "event_id", "left_semi")
    path = scratch_dir(spark, "newest")
    silver_ops.silver(copies).write.parquet(path)
    newest = spark.read.parquet(path)
    stored = begun.read("", SILVER_SCHEMA, since).select(SILVER_COLUMNS)
    ids = newest.select("event_id")
    touched = copies.select("event_date", user_bucket(USER_BUCKETS).alias("users")).distinct().collect()
    dates, users = sorted({r["event_date"] for r in touched}), sorted({r["users"] for r in touched})
    others = stored.filter(F.col("event_date").isin(dates)).join(ids, "event_id", "left_anti")
    path = begun.snapshots.path
    published = write_silver(others.unionByName(newest), path, uuid.uuid4().hex, since, dates, begun)
    return published, dates, users


def not_promoted(spark: SparkSession, paths: Paths) -> DataFrame:
    """The newest copy of every event that silver doesn't hold: it came too late for the
    lookback window, or a correction moved it to a date before the window.

    Reads both whole tables and joins them by event, so run it when the question comes up. An
    event no promotion has seen yet is listed too.
    """
    newest = silver_ops.silver(read_bronze(spark, paths.bronze))
    copy = ["event_id", "event_ts", "ingested_at", "ingested_processing_ts", "source_file"]
    held = read_silver(spark, paths.silver).select(*[F.col(c).alias(f"held_{c}") for c in copy])
    on = F.col("event_id") == F.col("held_event_id")
    for c in copy[1:]:
        on = on & F.col(c).eqNullSafe(F.col(f"held_{c}"))
    return newest.join(held, on, "left_anti")


def check_tables(
    spark: SparkSession, paths: Paths, since: dt.date | None = None
) -> dict[str, DataFrame]:
    """The tables the checks are declared on, whole or from a date on."""
    tables = {name: read_mart(spark, paths, name, since) for name in MARTS}
    tables["stg_events"] = stage(spark, paths, since)
    tables["dim_user_current"] = read_current_users(spark, paths)
    return tables


def run_pipeline(
    spark: SparkSession,
    paths: Paths,
    lookback_days: int = LOOKBACK_DAYS,
    today: dt.date | None = None,
    incoming: DataFrame | None = None,
    check_since: dt.date | None = None,
    files_per_batch: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """One pass over whatever is new; returns the check results it has written.

    `incoming` is a stream of records (`sources.raw.from_text`) to validate and land
    first; without it the raw folder is filled by others. The checks are the only step
    that reads whole tables; `check_since` limits them to later dates. `files_per_batch` and
    `archive` bound a batch and the listing of raw files (see `sources.raw.stream_raw`).
    """
    if incoming is not None:
        land_events(
            incoming, paths.raw, paths.logs, paths.rejected, paths.stream("landing")
        ).awaitTermination()
    raw = stream_raw(spark, paths.raw, files_per_batch, archive)
    load_bronze(raw, paths.bronze, paths.stream("bronze")).awaitTermination()
    if promote(spark, paths, lookback_days, today) is not None:
        update_dimension(spark, paths, lookback_days)
        update_marts(spark, paths, lookback_days)
        reached = RunState(spark, paths.state).get("silver_checkpoint")
        closed = dt.date.fromisoformat(reached) - dt.timedelta(days=lookback_days)
        compact_bronze(spark, paths, closed, closed - dt.timedelta(days=COMPACT_DAYS))
    return store_checks(spark, paths, check_since)


def store_checks(spark: SparkSession, paths: Paths, since: dt.date | None = None) -> DataFrame:
    """Run the checks, store their results, and next to them the rows that fail.

    Failing rows are in a folder of the run, which `read_failing` finds, so that those of an
    earlier run don't pass for this one's.
    """
    step = RunState(spark, paths.state).begin()
    run = int(step.get("checks_run", "0")) + 1
    tables = check_tables(spark, paths, since)
    run_checks(tables).write.mode("overwrite").parquet(f"{paths.checks}/results")
    results = spark.read.parquet(f"{paths.checks}/results")
    bad = failing_rows(tables)
    for row in results.filter("failing_rows > 0").collect():  # at most one row per check
        found = bad[(row["table"], row["check"], row["column"])]
        found.write.mode("overwrite").parquet(f"{_failing(paths, run)}/{row['table']}.{row['column']}.{row['check']}")
    step.commit({"checks_run": run})
    return results


def _failing(paths: Paths, run: int) -> str:
    return f"{paths.checks}/failing/run={run}"


def read_failing(spark: SparkSession, paths: Paths, table: str, column: str, check: str) -> DataFrame | None:
    """Rows that failed a check in the last run; None if none did."""
    run = int(RunState(spark, paths.state).get("checks_run", "0"))
    try:
        return spark.read.parquet(f"{_failing(paths, run)}/{table}.{column}.{check}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None

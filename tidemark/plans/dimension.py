"""The stored user dimension.

Users are dealt to a fixed number of buckets by hash. Each run writes one version folder, split in two and by
bucket: `settled` rows ended before the lookback window and can never change again, so later
runs neither read nor rewrite them; the rest is the live part of the buckets whose users changed, and is written
anew. The run's record names the version that holds the live part of each bucket, so a reader takes
these folders and the settled part of all versions since the last complete one (the base). Now and then a
run writes a complete version, and the ones before it are no longer used; they stay for readers
under way until the next complete one.

A version counts only once its record is saved, so a run that dies half-way is simply repeated
into the same folder.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.pieces import ROWS_PER_PIECE
from tidemark.operators.scd import (
    busy_timelines,
    current_users,
    dimension_events,
    replay,
    user_bucket,
)
from tidemark.plans.changes import USER_BUCKETS, changes_after
from tidemark.plans.paths import Paths
from tidemark.sources.scratch import partition_values, remove_folder
from tidemark.sources.state import EPOCH, RunState, Step
from tidemark.sources.tables import read_silver, write_partitioned

_STORED = schemas.DIM_SCHEMA + ", version int, settled boolean, bucket int"
_FIRST = {
    "version": 0, "base": 1, "kept_from": 1, "checkpoint": EPOCH, "watermark": EPOCH, "settled_before": EPOCH,
    "silver_run": None, "buckets": 0, "live": {}, "settled": [],
}
COMPLETE_EVERY = 100  # versions
BUCKETS = 32  # of a new dimension; the number stays with it


def last_run(state: RunState | Step) -> dict:
    """What the last completed run saved: version and base, the first version still stored, the
    silver checkpoint and run it saw, the ingestion watermark, the date before which rows count as settled,
    the number of buckets, the version of each bucket's live part, and the versions with settled rows."""
    saved = state.get("dim_user")
    return json.loads(saved) if saved else dict(_FIRST)


def _read_folders(spark: SparkSession, paths: Paths, folders: list[str]) -> DataFrame:
    """Rows of some folders, with their bucket."""
    columns = [*schemas.DIM_COLUMNS, "bucket"]
    if not folders:
        return spark.createDataFrame([], schemas.DIM_SCHEMA + ", bucket int")
    reader = spark.read.schema(_STORED).option("basePath", paths.dimension)
    return reader.parquet(*[f"{paths.dimension}/{folder}" for folder in folders]).select(columns)


def _read_settled(spark: SparkSession, paths: Paths, last: dict) -> DataFrame:
    return _read_folders(spark, paths, [f"version={v}/settled=true" for v in last["settled"]])


def _read_live(spark: SparkSession, paths: Paths, last: dict, buckets: list[int] | None = None) -> DataFrame:
    """The live part of some buckets or all: only their folders are listed and read."""
    chosen = {b: v for b, v in last["live"].items() if buckets is None or int(b) in buckets}
    return _read_folders(spark, paths, [f"version={v}/settled=false/bucket={b}" for b, v in chosen.items()])


def read_dimension(spark: SparkSession, paths: Paths) -> DataFrame:
    """The whole history as of the last completed run."""
    last = last_run(RunState(spark, paths.state))
    return _read_settled(spark, paths, last).unionByName(_read_live(spark, paths, last)).select(schemas.DIM_COLUMNS)


def read_current_users(spark: SparkSession, paths: Paths) -> DataFrame:
    """Current rows only; they are all in the live part."""
    return current_users(_read_live(spark, paths, last_run(RunState(spark, paths.state))))


def update_dimension(
    spark: SparkSession,
    paths: Paths,
    lookback_days: int = 2,
    rows_per_piece: int = ROWS_PER_PIECE,
    complete_every: int = COMPLETE_EVERY,
    buckets: int = BUCKETS,
) -> int | None:
    """Bring the dimension up to date with silver; None when silver has nothing new.

    The history is rewound to the first date that silver's runs have changed since, and replayed from
    there; however far back a promotion looked, its dates are known. Only where that isn't remembered
    the date is (checkpoint at the last run - lookback). Rows that were settled after
    that date are taken back first. Only the buckets of users whom silver's runs name are read and rewritten,
    all if these aren't remembered.

    Whether silver has something new is told by its run number, not by ingestion times: those
    come with the events and may be missing or lie in the future.
    """
    step = RunState(spark, paths.state).begin()
    last = last_run(step)
    reached = step.get("silver_checkpoint", EPOCH)
    silver_run = step.get("silver_run")
    if silver_run is not None and silver_run == last["silver_run"]:
        return None
    n = last["buckets"] or buckets
    if USER_BUCKETS % n:
        raise ValueError(f"buckets must divide {USER_BUCKETS}")
    usual = dt.date.fromisoformat(last["checkpoint"]) - dt.timedelta(days=lookback_days)
    changed = changes_after(step, last["silver_run"])
    since_date = changed.since if changed else usual
    version, base = last["version"] + 1, last["base"]
    reopened = since_date < dt.date.fromisoformat(last["settled_before"])
    complete = reopened or version - base >= complete_every
    touched = None if complete or not changed or changed.users is None else sorted({u % n for u in changed.users})

    events = read_silver(spark, paths.silver, since_date)
    if touched is not None:
        events = events.filter(user_bucket(n).isin(touched))
    events = dimension_events(events)
    newest = events.agg(F.max("ingested_at")).first()[0]
    watermark = max(last["watermark"], newest.isoformat()) if newest else last["watermark"]

    since = F.lit(since_date).cast("timestamp_ntz")
    live = _read_live(spark, paths, last, touched).select(schemas.DIM_COLUMNS)
    if reopened:
        settled = _read_settled(spark, paths, last).select(schemas.DIM_COLUMNS)
        ends = F.col("effective_end")
        live = live.unionByName(settled.filter(ends >= since))
        settled = settled.filter(ends < since)
    updated = replay(live, events, since, busy_timelines(events, rows_per_piece))
    if complete:
        if not reopened:
            settled = _read_settled(spark, paths, last).select(schemas.DIM_COLUMNS)
        updated, base = updated.unionByName(settled), version
    # What ended before the usual window stays as it is, unless a promotion looks further back.
    horizon = min(since_date, usual)
    ended = F.coalesce(F.col("effective_end") < F.lit(horizon).cast("timestamp_ntz"), F.lit(False))
    folder = f"{paths.dimension}/version={version}"
    write_partitioned(
        updated.withColumns({"settled": ended, "bucket": user_bucket(n)}), folder, ["settled", "bucket"], "overwrite"
    )
    written = {b: version for b in partition_values(spark, f"{folder}/settled=false", "bucket")}
    kept = {} if touched is None else {b: v for b, v in last["live"].items() if int(b) not in touched}
    has_settled = [version] if partition_values(spark, f"{folder}/settled=true", "bucket") else []
    kept_from = last["kept_from"]
    if base != last["base"]:
        for unused in range(kept_from, last["base"]):
            remove_folder(spark, f"{paths.dimension}/version={unused}")
        kept_from = last["base"]
    before = EPOCH if complete else last["settled_before"]
    # One value, so that version, checkpoint and watermark move together.
    run = {
        "version": version,
        "base": base,
        "kept_from": kept_from,
        "checkpoint": reached,
        "watermark": watermark,
        "settled_before": max(before, horizon.isoformat()),
        "silver_run": silver_run,
        "buckets": n,
        "live": kept | written,
        "settled": has_settled if complete else last["settled"] + has_settled,
    }
    step.commit({"dim_user": json.dumps(run)})
    return version

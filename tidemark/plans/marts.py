"""Stored marts and the named views over all tables."""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import marts
from tidemark.operators.silver import type_tables
from tidemark.plans.changes import changes_after
from tidemark.plans.dimension import read_current_users, read_dimension
from tidemark.plans.paths import Paths
from tidemark.schemas import TYPE_TABLES
from tidemark.sources.snapshots import Snapshot, Snapshots
from tidemark.sources.state import RunState
from tidemark.sources.tables import read_silver, write_partitioned

# Function, stored columns, and the event types the mart is made from (None: all).
# Every mart is keyed by date, so a run can replace just the dates it touched.
MARTS = {
    "mart_dau": (marts.mart_dau, "daily_active_users bigint, event_date date", None),
    "mart_revenue": (marts.mart_revenue, "daily_revenue double, event_date date", ["purchase"]),
    "mart_event_mix": (
        marts.mart_event_mix,
        "event_type string, event_count bigint, event_date date",
        None,
    ),
    "mart_funnel": (
        marts.mart_funnel,
        "user_id bigint, searches bigint, page_views bigint, purchases bigint, event_date date",
        list(marts.FUNNEL_STEPS.values()),
    ),
}


def stage(spark: SparkSession, paths: Paths, since: dt.date | None = None) -> DataFrame:
    """The staging view, over the silver partitions from `since` on."""
    return marts.stg_events(read_silver(spark, paths.silver, since))


def write_marts(
    spark: SparkSession,
    paths: Paths,
    since: dt.date | None = None,
    dates: list[dt.date] | None = None,
    begun: Snapshot | None = None,
) -> Snapshot:
    """Write all marts, in full, only the dates from `since` on, or of these the given `dates`, and publish them
    together: a reader never sees one mart ahead of another. Dates without events any more go with it."""
    begun = begun or Snapshots(spark, paths.marts).begin()
    stg = stage(spark, paths, since)
    if dates is not None:
        stg = stg.filter(F.col("event_date").isin(dates))
    run = uuid.uuid4().hex

    def write(name: str) -> None:
        write_partitioned(MARTS[name][0](stg), f"{paths.marts}/{name}/run={run}", ["event_date"], "overwrite")

    # The marts do not depend on each other, so their jobs may overlap.
    with ThreadPoolExecutor(len(MARTS)) as pool:
        list(pool.map(write, MARTS))
    return begun.publish(dict.fromkeys(MARTS, run), since, dates)


def update_marts(spark: SparkSession, paths: Paths, lookback_days: int = 2) -> None:
    """Recompute the dates silver has rewritten since the marts were last written.

    Silver's runs say which dates these are; where one rebuilt its whole window all dates of that window are
    recomputed, and where one is no longer remembered those of the lookback window.
    """
    step = RunState(spark, paths.state).begin()
    begun = Snapshots(spark, paths.marts).begin()
    run = step.get("silver_run")
    if run is not None and run == step.get("marts_run"):
        return
    reached = step.get("silver_checkpoint")
    last = step.get("marts_checkpoint")
    since = dt.date.fromisoformat(last) - dt.timedelta(days=lookback_days) if last else None
    changed = changes_after(step, step.get("marts_run")) if last else None
    dates = None
    if changed:
        since, dates = min(changed.since, since) if changed.dates is None else changed.since, changed.dates
    write_marts(spark, paths, since, dates, begun)
    saved = {"marts_checkpoint": reached, "marts_run": run}
    step.commit({name: value for name, value in saved.items() if value is not None})


def read_mart(
    spark: SparkSession, paths: Paths, name: str, since: dt.date | None = None, snapshot: int | None = None
) -> DataFrame:
    """A mart as last published, or of an earlier snapshot, its date first as when it was computed."""
    snapshots = Snapshots(spark, paths.marts)
    return _of_snapshot(snapshots.begin() if snapshot is None else snapshots.at(snapshot), name, since)


def _of_snapshot(snapshot: Snapshot, name: str, since: dt.date | None = None) -> DataFrame:
    table = snapshot.read(name, f"{MARTS[name][1]}, run string", since).drop("run")
    return table.select("event_date", *[c for c in table.columns if c != "event_date"])


def register_views(spark: SparkSession, paths: Paths) -> list[str]:
    """Register every table under its name for SQL; returns the names the catalog lists.

    The views of silver and its types are of one snapshot, and so are those of the marts.
    """
    number = Snapshots(spark, paths.silver).begin().number
    stored = Snapshots(spark, paths.marts).begin()
    silver = read_silver(spark, paths.silver, snapshot=number)
    views = {
        "silver_events": silver,
        "stg_events": marts.stg_events(silver),
        "dim_user_scd": read_dimension(spark, paths),
        "dim_user_current": read_current_users(spark, paths),
        **{
            name: type_tables(read_silver(spark, paths.silver, event_type=kind, snapshot=number))[name]
            for name, (kind, _) in TYPE_TABLES.items()
        },
        **{name: _of_snapshot(stored, name) for name in MARTS},
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return sorted(t.name for t in spark.catalog.listTables() if t.name in views)

"""Published versions of silver and the marts, and readers beside writers."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from test_silver import TODAY, deliver
from tidemark.plans import marts, pipeline
from tidemark.plans.marts import MARTS, read_mart, register_views, update_marts
from tidemark.plans.paths import Paths
from tidemark.plans.pipeline import promote
from tidemark.sources.snapshots import Snapshots
from tidemark.sources.state import ConflictingRunError, Step
from tidemark.sources.tables import read_silver, write_silver


def found(spark, paths, **options):
    return sorted((r.event_id, r.country, r.event_date.day) for r in read_silver(spark, paths.silver, **options).collect())


def two_batches(spark, paths):
    """The second one moves an event to another date, which leaves its old date empty."""
    deliver(spark, paths, 0, [("0", "2024-01-09T10:00:00", "US", "a"), ("1", "2024-01-10T10:00:00", "US", "a")])
    promote(spark, paths, today=TODAY)
    yield [("0", "US", 9), ("1", "US", 10)]
    deliver(spark, paths, 1, [("0", "2024-01-10T11:00:00", "CA", "b")], "2024-02-02 00:00:00")
    promote(spark, paths, today=TODAY)
    yield [("0", "CA", 10), ("1", "US", 10)]


def test_a_reader_stays_with_its_snapshot(spark, tmp_path):
    paths = Paths(str(tmp_path))
    batches = two_batches(spark, paths)
    first = next(batches)
    lazy, number = read_silver(spark, paths.silver), Snapshots(spark, paths.silver).begin().number
    second = next(batches)
    assert found(spark, paths) == second
    assert found(spark, paths, snapshot=number) == first
    # A DataFrame made before the run is not changed by it either.
    assert sorted((r.event_id, r.country, r.event_date.day) for r in lazy.collect()) == first
    assert found(spark, paths, snapshot=number, since=dt.date(2024, 1, 10)) == [("1", "US", 10)]
    assert found(spark, paths, snapshot=0) == []


def test_no_reader_sees_half_a_run(spark, tmp_path, monkeypatch):
    """Read after every file the run writes, before it publishes, and when it dies in between."""
    paths = Paths(str(tmp_path))
    batches = two_batches(spark, paths)
    first = next(batches)
    seen, write = [], pipeline.write_silver
    commit = Step.commit

    def read_then_commit(step, values):
        seen.append(found(spark, paths))
        if len(seen) == 1:
            raise OSError("lost")
        commit(step, values)
        seen.append(found(spark, paths))

    with monkeypatch.context() as patch:
        patch.setattr(Step, "commit", read_then_commit)
        with pytest.raises(OSError):
            next(batches)
        assert seen == [first] and found(spark, paths) == first
        promote(spark, paths, today=TODAY)
    second = [("0", "CA", 10), ("1", "US", 10)]
    assert seen == [first, first, second, second, second] and pipeline.write_silver is write


def test_the_later_of_two_writers_is_refused_unseen(spark, tmp_path):
    paths = Paths(str(tmp_path))
    next(two_batches(spark, paths))
    begun = Snapshots(spark, paths.silver).begin()
    rows = read_silver(spark, paths.silver)
    write_silver(rows.withColumn("country", F.lit("CA")), paths.silver, "x", begun=begun)
    with pytest.raises(ConflictingRunError):
        write_silver(rows.withColumn("country", F.lit("GB")), paths.silver, "y", begun=begun)
    assert found(spark, paths) == [("0", "CA", 9), ("1", "CA", 10)]


def test_marts_are_published_together(spark, tmp_path, monkeypatch):
    paths = Paths(str(tmp_path))
    batches = two_batches(spark, paths)
    next(batches)
    update_marts(spark, paths)

    def rows(**options):
        return {n: sorted(map(tuple, read_mart(spark, paths, n, **options).collect()), key=str) for n in MARTS}

    before, number = rows(), Snapshots(spark, paths.marts).begin().number
    next(batches)
    seen, write = [], marts.write_partitioned

    def written(*args):
        write(*args)
        seen.append(rows())

    monkeypatch.setattr(marts, "write_partitioned", written)
    update_marts(spark, paths)
    assert seen == [before] * len(MARTS)
    assert rows() != before and rows(snapshot=number) == before
    # The date that lost its events is gone from all marts.
    assert {str(row[0]) for n in MARTS for row in rows()[n]} == {"2024-01-10"}


def test_views_are_of_one_snapshot(spark, tmp_path):
    paths = Paths(str(tmp_path))
    batches = two_batches(spark, paths)
    first = next(batches)
    update_marts(spark, paths)
    register_views(spark, paths)
    next(batches)
    update_marts(spark, paths)
    for view in ("silver_events", "stg_events"):
        got = spark.sql(f"select event_id, country, day(event_date) from {view}").collect()
        assert sorted(map(tuple, got)) == first
    assert sorted(r.event_date.day for r in spark.table("mart_dau").collect()) == [9, 10]


def test_folders_go_with_the_last_snapshot_that_names_them(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(6):
        snapshot = Snapshots(spark, path, kept=2).begin()
        days = "sequence(date'2024-01-01', date'2024-01-03')" if i == 0 else "array(date'2024-01-02')"
        rows = spark.sql(f"select {i} as v, explode({days}) as event_date")
        rows.write.partitionBy("event_date").parquet(f"{path}/a/run=r{i}")
        dates = None if i == 0 else [dt.date(2024, 1, 2)]
        snapshot.publish({"a": f"r{i}"}, dates=dates)
    last = Snapshots(spark, path, kept=2)
    schema = "v int, run string, event_date date"
    assert [(r.event_date.day, r.v) for r in last.begin().read("a", schema).orderBy("event_date").collect()] == [(1, 0), (2, 5), (3, 0)]
    assert last.at(4).read("a", schema).filter("v = 3").count() == 1
    with pytest.raises(ValueError):
        last.at(3)
    # Of the first run only the dates that still hold are left; of the ones after it those three snapshots name.
    assert sorted(os.listdir(f"{path}/a")) == ["run=r0", "run=r3", "run=r4", "run=r5"]
    assert sorted(d for d in os.listdir(f"{path}/a/run=r0") if "=" in d) == ["event_date=2024-01-01", "event_date=2024-01-03"]


def test_abandoned_runs_are_dropped_on_request(spark, tmp_path):
    paths = Paths(str(tmp_path))
    first = next(two_batches(spark, paths))
    spark.range(1).write.parquet(f"{paths.silver}/run=dead")
    snapshots = Snapshots(spark, paths.silver)
    assert snapshots.drop_abandoned() == [] and os.path.exists(f"{paths.silver}/run=dead")
    os.utime(f"{paths.silver}/run=dead", (1e9, 1e9))
    assert snapshots.drop_abandoned() == ["dead"]
    assert found(spark, paths) == first


def test_many_dates_are_read_without_listing_the_others(spark, tmp_path):
    paths = Paths(str(tmp_path))
    deliver(spark, paths, 0, [(str(d), f"2024-01-{d:02d}T10:00:00", "US", "a") for d in range(1, 11)])
    promote(spark, paths, today=TODAY)
    assert len(read_silver(spark, paths.silver, dt.date(2024, 1, 8)).inputFiles()) == 3
    assert Snapshots(spark, paths.silver).begin().dates("", dt.date(2024, 1, 9)) == [dt.date(2024, 1, 9), dt.date(2024, 1, 10)]

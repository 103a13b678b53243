"""The dimension's buckets: what a run reads and rewrites."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import scd
from tidemark.operators.bronze import bronze
from tidemark.plans.dimension import last_run, read_current_users, read_dimension, update_dimension
from tidemark.plans.paths import Paths
from tidemark.plans.pipeline import promote
from tidemark.sources.raw import from_text
from tidemark.sources.state import RunState
from tidemark.sources.tables import read_silver, write_load

TODAY = dt.date(2024, 3, 1)
COLUMNS = "event_id string, event_ts string, country string, user_id int, ingested_at string"


def load(spark, paths, name, events):
    rows = events if not isinstance(events, list) else spark.createDataFrame(events, COLUMNS)
    raw = from_text(rows.withColumn("event_type", F.lit("search")).select(F.to_json(F.struct("*")).alias("value")))
    at = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(mins=F.lit(name))
    write_load(bronze(raw.withColumn("source_file", F.lit(f"f{name}")), at), paths.bronze, name)
    promote(spark, paths, 2, TODAY)


def thousand_users(spark):
    return spark.range(2000).select(
        F.concat(F.lit("e"), "id").alias("event_id"),
        F.when(F.col("id") < 1000, "2024-01-09T10:00:00").otherwise("2024-01-10T10:00:00").alias("event_ts"),
        F.when(F.col("id") < 1000, "US").otherwise("CA").alias("country"), (F.col("id") % 1000).cast("int").alias("user_id"),
        F.lit("2024-01-10T10:01:00").alias("ingested_at"),
    )


def same_as_full_build(spark, paths):
    full = scd.full_build(scd.dimension_events(read_silver(spark, paths.silver)))
    got = read_dimension(spark, paths)
    assert got.exceptAll(full).isEmpty() and full.exceptAll(got).isEmpty()


@pytest.fixture
def lake(spark, tmp_path):
    paths = Paths(str(tmp_path))
    load(spark, paths, 0, thousand_users(spark))
    update_dimension(spark, paths, buckets=16)
    return paths


def folders(paths, version):
    return sorted(f"{kind}/{b}" for kind in os.listdir(f"{paths.dimension}/version={version}") if "=" in kind
                  for b in os.listdir(f"{paths.dimension}/version={version}/{kind}") if "=" in b)


def test_one_user_of_a_thousand_rewrites_one_bucket(spark, lake):
    assert len(folders(lake, 1)) == 16
    load(spark, lake, 1, [("late", "2024-01-10T09:00:00", "GB", 7, "2024-01-10T12:00:00")])
    assert update_dimension(spark, lake) == 2
    own = spark.range(1).select(F.lit(7).cast("bigint").alias("user_id")).select(scd.user_bucket(16)).first()[0]
    assert folders(lake, 2) == [f"settled=false/bucket={own}"]
    last = last_run(RunState(spark, lake.state))
    assert [b for b, v in last["live"].items() if v == 2] == [str(own)] and len(last["live"]) == 16
    same_as_full_build(spark, lake)
    assert read_current_users(spark, lake).count() == 1000
    live = read_dimension(spark, lake).filter("user_id = 7").orderBy("effective_start").collect()
    assert [r.country for r in live] == ["US", "GB", "CA"]


def test_a_correction_to_another_user_rewrites_both(spark, lake):
    load(spark, lake, 1, [("e1007", "2024-01-10T10:00:00", "FR", 8, "2024-01-10T13:00:00")])
    update_dimension(spark, lake)
    same_as_full_build(spark, lake)
    found = {r.user_id: r.country for r in read_current_users(spark, lake).filter("user_id in (7, 8)").collect()}
    assert found[7] == "US"


def test_settled_rows_stay_apart_until_a_longer_lookback(spark, lake):
    """Versions ended long ago are settled in their bucket's run, and come back for a late event."""
    load(spark, lake, 1, [("n1", "2024-01-20T09:00:00", "GB", 7, "2024-01-20T09:01:00")])
    update_dimension(spark, lake)
    load(spark, lake, 2, [("n2", "2024-01-21T09:00:00", "DE", 7, "2024-01-21T09:01:00")])
    update_dimension(spark, lake)
    last = last_run(RunState(spark, lake.state))
    assert last["settled"] and last["base"] == 1
    same_as_full_build(spark, lake)
    raw = [("n3", "2024-01-09T12:00:00", "FR", 7, "2024-01-21T10:00:00")]
    rows = spark.createDataFrame(raw, COLUMNS).withColumn("event_type", F.lit("search"))
    text = from_text(rows.select(F.to_json(F.struct("*")).alias("value"))).withColumn("source_file", F.lit("late"))
    write_load(bronze(text, F.lit("2024-02-01 01:00:00").cast("timestamp_ntz")), lake.bronze, "late")
    promote(spark, lake, 30, TODAY)
    update_dimension(spark, lake)
    same_as_full_build(spark, lake)
    assert last_run(RunState(spark, lake.state))["base"] == 4


def test_complete_versions_hold_all_buckets(spark, lake):
    for i in range(1, 4):
        load(spark, lake, i, [(f"n{i}", f"2024-01-{10 + i}T09:00:00", "GB" if i % 2 else "DE", i, f"2024-01-{10 + i}T09:01:00")])
        update_dimension(spark, lake, complete_every=2)
        same_as_full_build(spark, lake)
    last = last_run(RunState(spark, lake.state))
    assert last["base"] == 3 and last["buckets"] == 16
    assert set(last["live"].values()) <= {3, 4}

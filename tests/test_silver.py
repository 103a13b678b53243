"""Deduplication and the incremental silver run."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import silver as silver_ops
from tidemark.operators.bronze import bronze
from tidemark.plans.marts import read_mart, update_marts
from tidemark.plans.paths import Paths
from tidemark.plans.pipeline import backfill_bronze, not_promoted, promote
from tidemark.sources.raw import from_text
from tidemark.sources.snapshots import Snapshots
from tidemark.sources.state import RunState, Step
from tidemark.sources.tables import read_bronze, read_quarantine, read_silver, write_load

TODAY = dt.date(2024, 3, 1)


def deliver(spark, paths, load, events, processed="2024-02-01 00:00:00"):
    """Add (event_id, event_ts, country, ingested_at) events to bronze as one load."""
    rows = spark.createDataFrame(events, "event_id string, event_ts string, country string, ingested_at string")
    text = rows.withColumn("event_type", F.lit("search")).withColumn("user_id", F.lit(1))
    raw = from_text(text.select(F.to_json(F.struct("*")).alias("value")))
    at = F.lit(processed).cast("timestamp_ntz")
    write_load(bronze(raw.withColumn("source_file", F.lit(f"f{load}")), at), paths.bronze, load)


def countries(spark, paths):
    return {r.event_id: r.country for r in read_silver(spark, paths.silver).collect()}


def test_latest_copy_wins_and_ties_are_settled(spark):
    schema = "event_id string, ingested_processing_ts string, ingested_at string, source_file string, v int"
    copies = [
        ("a", "2", "1", "f", 1), ("a", "1", "9", "f", 2),  # later processing wins
        ("b", "1", "2", "f", 3), ("b", "1", "1", "g", 4),  # then later ingestion
        ("c", "1", "1", "f", 5), ("c", "1", "1", "g", 6),  # then file name
        ("d", "1", "1", "f", 7), ("d", "1", "1", "f", 8),  # then the remaining columns
        ("e", "1", None, "f", 9), ("e", "1", "0", "f", 10),
        (None, "1", "1", "f", 11), (None, "2", "1", "f", 12),
    ]
    for seed in (1, 2):
        shuffled = spark.createDataFrame(copies, schema).orderBy(F.rand(seed))
        kept = silver_ops.latest(shuffled)
        assert {(r.event_id, r.v) for r in kept.collect()} == {
            ("a", 1), ("b", 3), ("c", 6), ("d", 8), ("e", 10), (None, 12)
        }
        assert silver_ops.latest(kept).count() == kept.count()


def test_a_much_copied_event_costs_one_row_per_task(spark):
    frame = spark.range(0, 9000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("event_id"),
        F.col("id").alias("version"),
    )
    kept = silver_ops.latest(frame, newest_first=["version"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange") == 1
    assert kept.count() == 6001
    assert kept.filter("event_id = 'hot'").first().version == 8997


def test_bad_amounts_become_null(spark):
    row = spark.createDataFrame(
        [("1", "x", "2024-01-01T00:00:00", dt.date(2024, 1, 1), 1, "US", "p", "q", "abc", "m", "i", "t", "f")],
        "event_id string, event_type string, event_ts string, event_date date, user_id long, country string,"
        "page string, query string, amount string, error_message string, ingested_at string,"
        "ingested_processing_ts string, source_file string",
    )
    silver = silver_ops.normalize(row)
    assert silver.schema["amount"].dataType.simpleString() == "double"
    assert silver.schema["event_ts"].dataType.simpleString() == "timestamp_ntz"
    assert silver.first().amount is None


def test_incremental_runs(spark, tmp_path):
    paths = Paths(str(tmp_path))
    days = [f"2024-01-{d:02d}T10:00:00" for d in (1, 8, 9, 10)]
    deliver(spark, paths, 0, [(str(i), day, "US", day) for i, day in enumerate(days)])
    assert promote(spark, paths, today=TODAY) == "2024-01-10"
    assert set(countries(spark, paths).values()) == {"US"}

    # Copies inside the window replace theirs; the one before it is not promoted, and
    # the untouched older partition survives the run.
    deliver(
        spark, paths, 1, [(str(i), day, "CA", "2024-01-11T00:00:00") for i, day in enumerate(days)],
        "2024-02-02 00:00:00",
    )
    assert promote(spark, paths, today=TODAY) == "2024-01-10"
    assert countries(spark, paths) == {"0": "US", "1": "CA", "2": "CA", "3": "CA"}

    # A run over the same bronze changes nothing.
    before = sorted(map(str, read_silver(spark, paths.silver).collect()))
    promote(spark, paths, today=TODAY)
    assert sorted(map(str, read_silver(spark, paths.silver).collect())) == before


def files_by_day(spark, paths):
    """The files that hold each day of the published silver."""
    found = {}
    for file in read_silver(spark, paths.silver).inputFiles():
        found.setdefault(int(file.split("/event_date=2024-01-")[1][:2]), set()).add(file)
    return found


def test_a_run_rewrites_the_dates_of_new_loads_only(spark, tmp_path):
    paths = Paths(str(tmp_path))
    days = [f"2024-01-{d:02d}T10:00:00" for d in (7, 8, 9, 10)]
    deliver(spark, paths, 0, [(f"{i}{k}", day, "US", day) for i, day in enumerate(days) for k in "ab"])
    promote(spark, paths, lookback_days=3, today=TODAY)
    before = files_by_day(spark, paths)

    # A new date: the ones before it stay as they are.
    deliver(spark, paths, 1, [("new", "2024-01-11T10:00:00", "US", "b")], "2024-02-02 00:00:00")
    promote(spark, paths, lookback_days=3, today=TODAY)
    now = files_by_day(spark, paths)
    assert {d: now[d] for d in before} == before and sorted(now) == [7, 8, 9, 10, 11]

    # An event that moves touches the date it leaves and the one it goes to.
    deliver(spark, paths, 2, [("1a", "2024-01-09T11:00:00", "CA", "c"), ("new", "2024-01-11T10:00:00", "GB", "a")],
            "2024-02-03 00:00:00")
    promote(spark, paths, lookback_days=3, today=TODAY)
    now = files_by_day(spark, paths)
    assert {d: now[d] == before[d] for d in before} == {7: True, 8: False, 9: False, 10: True}
    found = {(r.event_id, r.country, r.event_date.day) for r in read_silver(spark, paths.silver).collect()}
    assert found == {
        *((f"{i}{k}", "US", 7 + i) for i in range(4) for k in "ab" if (i, k) != (1, "a")), ("1a", "CA", 9), ("new", "GB", 11)
    }
    assert read_silver(spark, paths.silver).count() == 9


def test_a_run_that_failed_is_repeated_whole(spark, tmp_path, monkeypatch):
    paths = Paths(str(tmp_path))
    deliver(spark, paths, 0, [("0", "2024-01-09T10:00:00", "US", "a"), ("1", "2024-01-10T10:00:00", "US", "a")])
    promote(spark, paths, today=TODAY)
    update_marts(spark, paths)
    deliver(spark, paths, 1, [("0", "2024-01-10T11:00:00", "CA", "b")], "2024-02-02 00:00:00")

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Step, "commit", lost)
        with pytest.raises(OSError):
            promote(spark, paths, today=TODAY)
    promote(spark, paths, today=TODAY)
    update_marts(spark, paths)
    assert countries(spark, paths) == {"0": "CA", "1": "US"}
    counts = {(str(r.event_date), r.event_count) for r in read_mart(spark, paths, "mart_event_mix").collect()}
    assert counts == {("2024-01-10", 2)}


def test_a_load_that_changed_rebuilds_the_window(spark, tmp_path):
    paths = Paths(str(tmp_path))
    deliver(spark, paths, 0, [("0", "2024-01-10T10:00:00", "US", "a"), ("1", "2024-01-10T10:00:00", "US", "a")])
    promote(spark, paths, today=TODAY)
    deliver(spark, paths, 0, [("0", "2024-01-10T10:00:00", "CA", "b")], "2024-02-02 00:00:00")
    promote(spark, paths, today=TODAY)
    assert countries(spark, paths) == {"0": "CA"}


def test_wider_lookback_reaches_further(spark, tmp_path):
    paths = Paths(str(tmp_path))
    deliver(spark, paths, 0, [("0", "2024-01-01T10:00:00", "US", "a"), ("1", "2024-01-10T10:00:00", "US", "a")])
    promote(spark, paths, today=TODAY)
    deliver(spark, paths, 1, [("0", "2024-01-01T10:00:00", "CA", "b")], "2024-02-02 00:00:00")
    promote(spark, paths, lookback_days=9, today=TODAY)
    assert countries(spark, paths) == {"0": "CA", "1": "US"}


def test_future_event_does_not_move_the_checkpoint_past_today(spark, tmp_path):
    paths = Paths(str(tmp_path))
    deliver(spark, paths, 0, [("0", "2024-01-10T10:00:00", "US", "a"), ("1", "2031-01-01T10:00:00", "US", "a")])
    assert promote(spark, paths, today=dt.date(2024, 1, 11)) == "2024-01-11"
    assert set(countries(spark, paths)) == {"0", "1"}


def test_emptied_partitions_hold_no_rows(spark, tmp_path):
    paths = Paths(str(tmp_path))
    deliver(spark, paths, 0, [("0", "2024-01-09T10:00:00", "US", "a"), ("1", "2024-01-10T10:00:00", "US", "a")])
    promote(spark, paths, today=TODAY)
    deliver(spark, paths, 1, [("0", "2024-01-10T11:00:00", "CA", "b")], "2024-02-02 00:00:00")
    promote(spark, paths, today=TODAY)
    assert countries(spark, paths) == {"0": "CA", "1": "US"}
    assert Snapshots(spark, paths.silver).begin().dates("") == [dt.date(2024, 1, 10)]


def test_events_too_late_are_listed(spark, tmp_path):
    paths = Paths(str(tmp_path))
    deliver(spark, paths, 0, [("0", "2024-01-01T10:00:00", "US", "a"), ("1", "2024-01-10T10:00:00", "US", "a")])
    promote(spark, paths, today=TODAY)
    assert not_promoted(spark, paths).isEmpty()
    late = [("0", "2024-01-01T10:00:00", "CA", None), ("2", "2024-01-02T10:00:00", "CA", "b"), ("3", "2024-01-09T10:00:00", "CA", "b")]
    deliver(spark, paths, 1, late, "2024-02-02 00:00:00")
    promote(spark, paths, today=TODAY)
    assert sorted((r.event_id, r.country) for r in not_promoted(spark, paths).collect()) == [("0", "CA"), ("2", "CA")]
    assert countries(spark, paths) == {"0": "US", "1": "US", "3": "CA"}


def test_types_that_clients_make_up_share_a_folder(spark, tmp_path):
    paths = Paths(str(tmp_path))
    kinds = ["search", "", "a/b=c", *[f"made up {i}" for i in range(20)]]
    rows = spark.createDataFrame([(str(i), k) for i, k in enumerate(kinds)], "event_id string, event_type string")
    rows = rows.selectExpr("*", "'2024-01-10T10:00:00' AS event_ts", "1 AS user_id", "'US' AS country")
    write_load(bronze(from_text(rows.select(F.to_json(F.struct("*")).alias("value")))), paths.bronze, 0)
    promote(spark, paths, today=TODAY)
    (run,) = Snapshots(spark, paths.silver).begin().places[""].values()
    for folder in (f"{paths.bronze}/verdict=valid", f"{paths.silver}/run={run}"):
        assert sorted(os.listdir(f"{folder}/event_date=2024-01-10")) == ["type_folder=other", "type_folder=search"]
    assert sorted(r.event_type for r in read_silver(spark, paths.silver).collect()) == sorted(kinds)
    assert [r.event_id for r in read_silver(spark, paths.silver, event_type="a/b=c").collect()] == ["2"]
    searches = read_silver(spark, paths.silver, event_type="search")
    assert [r.event_id for r in searches.collect()] == ["0"]
    assert "type_folder" in searches._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]


def test_no_bronze_leaves_the_checkpoint(spark, tmp_path):
    paths = Paths(str(tmp_path))
    assert promote(spark, paths, today=TODAY) is None
    assert RunState(spark, paths.state).get("silver_checkpoint") is None


def test_repeated_load_is_not_added_twice(spark, tmp_path):
    paths = Paths(str(tmp_path))
    for _ in range(2):
        deliver(spark, paths, 0, [("0", "2024-01-01T10:00:00", "US", "a")])
    deliver(spark, paths, 1, [("0", "2024-01-01T10:00:00", "US", "a")])
    assert read_bronze(spark, paths.bronze).count() == 2


def test_backfill_and_quarantine(spark, tmp_path):
    paths = Paths(str(tmp_path))
    raw = tmp_path / "raw" / "events"
    raw.mkdir(parents=True)
    (raw / "a.json").write_text(
        '{"event_id":"1","event_type":"error","event_ts":"2024-01-01T00:00:00","user_id":1,"country":"US"}\n{"x":'
    )
    for _ in range(2):
        backfill_bronze(spark, paths)
    assert read_bronze(spark, paths.bronze).count() == 1
    assert [r.reason for r in read_quarantine(spark, paths.bronze).collect()] == ["corrupt_json"]


def test_state_keeps_the_last_value(spark, tmp_path):
    state = RunState(spark, str(tmp_path / "state"))
    assert state.get("a", "none") == "none"
    for value in ("2", "1"):
        state.put("a", value)
    state.put("b", "x")
    assert (state.get("a"), state.get("b"), state.get("c")) == ("1", "x", None)


def test_window_scan_prunes_partitions(spark, tmp_path):
    from tidemark.operators.bronze import lookback

    paths = Paths(str(tmp_path))
    deliver(spark, paths, 0, [(str(d), f"2024-01-{d:02d}T10:00:00", "US", "a") for d in range(1, 9)])
    scan = lookback(read_bronze(spark, paths.bronze), "2024-01-08").select("event_id")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "ReadSchema: struct<event_id:string>" in plan
    assert {r.event_id for r in scan.collect()} == {"6", "7", "8"}


def test_date_pattern_finds_the_window_only(spark, tmp_path):
    paths = Paths(str(tmp_path))
    days = ["1999-12-31", "2023-12-31", "2024-01-09", "2024-01-10", "2024-01-19", "2024-02-01", "2031-01-01"]
    deliver(spark, paths, 0, [(day, f"{day}T10:00:00", "US", "a") for day in days])
    for i, since in enumerate(days):
        window = read_bronze(spark, paths.bronze, dt.date.fromisoformat(since))
        assert sorted(r.event_id for r in window.collect()) == days[i:]
        assert len(window.inputFiles()) == len(days) - i
    assert read_bronze(spark, paths.bronze, dt.date(2040, 1, 1)).isEmpty()
    assert read_silver(spark, paths.silver, dt.date(2024, 1, 1)).isEmpty()


def test_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    from tidemark.sources.tables import write_partitioned

    rows = spark.range(0, 400_000, 1, 8).select(
        F.uuid().alias("text"), F.when(F.col("id") % 3 == 0, F.col("id") % 7).otherwise(99).alias("p")
    )
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "1m")
    try:
        write_partitioned(rows, str(tmp_path / "t"), ["p"])
    finally:
        spark.conf.set(setting, before)
    hot = [f for f in (tmp_path / "t" / "p=99").iterdir() if f.suffix == ".parquet"]
    assert len(hot) > 3

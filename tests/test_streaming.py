"""The streams, and the whole pipeline over several runs."""

import datetime as dt
import json
import os

import pytest

from tidemark.operators.scd import dimension_events, full_build
from tidemark.plans.dimension import last_run, read_dimension, update_dimension
from tidemark.plans.marts import MARTS, read_mart, register_views, stage, update_marts
from tidemark.plans.paths import Paths
from tidemark.plans.pipeline import backfill_bronze, promote, read_failing, run_pipeline, store_checks
from tidemark.sources.raw import from_text, stream_raw
from tidemark.sources.state import RunState, Step
from tidemark.sources.tables import read_bronze, read_quarantine, read_silver
from tidemark.streaming.jobs import land_events, load_bronze

TODAY = dt.date(2024, 3, 1)


def event(event_id, ts="2024-01-10T10:00:00", kind="search", user=1, country="US", ingested=None, **extra):
    return {
        "event_id": event_id, "event_type": kind, "event_ts": ts, "user_id": user,
        "country": country, "ingested_at": ingested or ts, **extra,
    }


def drop(paths, name, *events):
    os.makedirs(paths.raw, exist_ok=True)
    with open(f"{paths.raw}/{name}.json", "w") as file:
        file.write("\n".join(e if isinstance(e, str) else json.dumps(e) for e in events))


def load(spark, paths):
    load_bronze(stream_raw(spark, paths.raw), paths.bronze, paths.stream("bronze")).awaitTermination()


def test_files_are_loaded_once(spark, tmp_path):
    paths = Paths(str(tmp_path))
    drop(paths, "a", event("1"), event("2"), '{"event_id":')
    load(spark, paths)
    load(spark, paths)
    assert read_bronze(spark, paths.bronze).count() == 2
    assert read_quarantine(spark, paths.bronze).count() == 1
    # New files are picked up, a rewritten file is not read again.
    drop(paths, "b", event("3"))
    drop(paths, "a", event("1", country="CA"))
    load(spark, paths)
    assert {(r.event_id, r.country) for r in read_bronze(spark, paths.bronze).collect()} == {
        ("1", "US"), ("2", "US"), ("3", "US")
    }


def test_landing(spark, tmp_path):
    paths = Paths(str(tmp_path))
    incoming = tmp_path / "incoming"
    incoming.mkdir()
    (incoming / "a.txt").write_text(
        "\n".join([
            json.dumps(event("1", note={"a": [1, 2.5]}, request_id="sent by the client")),
            json.dumps(event("2", user="x")),
            "{",
        ])
    )
    for _ in range(2):  # the second run finds nothing new
        land_events(
            from_text(spark.readStream.text(str(incoming))),
            paths.raw, paths.logs, paths.rejected, paths.stream("landing"),
        ).awaitTermination()
    raw = [json.loads(r.value) for r in spark.read.text(paths.raw).collect()]
    assert len(raw) == 1
    assert raw[0]["note"] == {"a": [1, 2.5]}
    assert raw[0]["request_id"] != "sent by the client"
    assert raw[0]["ingested_at"][:10] >= "2024"
    log = spark.read.json(paths.logs).collect()
    assert [(r.type, r.event_id, r.request_id) for r in log] == [
        ("event_ingested", "1", raw[0]["request_id"])
    ]
    rejected = {r.reason for r in spark.read.json(paths.rejected).collect()}
    assert rejected == {"bad_user_id", "corrupt_json"}

    again = from_text(spark.readStream.text(str(incoming)))
    assert run_pipeline(spark, paths, today=TODAY, incoming=again).count() == 26
    bronze = read_bronze(spark, paths.bronze).first()
    assert (bronze.event_id, bronze.request_id) == ("1", raw[0]["request_id"])
    assert read_silver(spark, paths.silver).count() == 1


def test_silver_follows_the_bronze_stream(spark, tmp_path):
    paths = Paths(str(tmp_path))
    runs = []

    def refresh():
        load_bronze(
            stream_raw(spark, paths.raw), paths.bronze, paths.stream("bronze"),
            after=lambda: runs.append(promote(spark, paths, today=TODAY)),
        ).awaitTermination()

    drop(paths, "a", event("1"), event("2", "2024-01-09T10:00:00"))
    refresh()
    # The second copy of "2" says it happened on another day of the window.
    drop(paths, "b", event("1", country="CA", ingested="2024-01-11T00:00:00"), event("2"))
    refresh()
    refresh()
    assert len(runs) == 2
    found = {(r.event_id, r.country, str(r.event_date)) for r in read_silver(spark, paths.silver).collect()}
    assert found == {("1", "CA", "2024-01-10"), ("2", "US", "2024-01-10")}


def everything(df):
    return sorted(str(tuple(r)) for r in df.collect())


def same_as_from_scratch(spark, paths):
    silver = read_silver(spark, paths.silver)
    assert everything(read_dimension(spark, paths)) == everything(full_build(dimension_events(silver)))
    stg = stage(spark, paths)
    for name, (mart, _, _) in MARTS.items():
        want = mart(stg)
        assert everything(read_mart(spark, paths, name).select(want.columns)) == everything(want)


def test_pipeline_runs(spark, tmp_path):
    paths = Paths(str(tmp_path))
    drop(paths, "a", event("1", "2024-01-01T10:00:00"), event("2", "2024-01-05T10:00:00", country="CA"),
         event("3", "2024-01-10T10:00:00", kind="purchase", amount=5.5), event("9", user=2, kind="signup"))
    results = run_pipeline(spark, paths, today=TODAY)
    assert results.count() == 26
    failing = {(r.table, r.check) for r in results.filter("failing_rows > 0").collect()}
    assert failing == {("stg_events", "accepted_values"), ("mart_event_mix", "accepted_values")}
    same_as_from_scratch(spark, paths)
    bad = read_failing(spark, paths, "stg_events", "event_type", "accepted_values")
    assert [tuple(row) for row in bad.collect()] == [("signup", 1)]

    # A late event, a corrected copy, a new day and a new user.
    drop(paths, "b", event("4", "2024-01-09T10:00:00", country="GB", ingested="2024-01-12T00:00:00"),
         event("3", "2024-01-10T10:00:00", kind="purchase", amount=7.5, country="DE", ingested="2024-01-12T00:00:00"),
         event("5", "2024-01-12T10:00:00", user=3))
    run_pipeline(spark, paths, today=TODAY)
    same_as_from_scratch(spark, paths)
    assert read_mart(spark, paths, "mart_revenue").first().daily_revenue == 7.5

    # A correction empties a day and an event type.
    drop(paths, "c", event("4", "2024-01-12T11:00:00", country="GB", ingested="2024-01-13T00:00:00"),
         event("3", "2024-01-10T10:00:00", kind="search", country="DE", ingested="2024-01-13T00:00:00"),
         event("9", "2024-01-11T10:00:00", user=2, kind="signup", ingested="2024-01-13T00:00:00"))
    run_pipeline(spark, paths, lookback_days=4, today=TODAY)
    same_as_from_scratch(spark, paths)
    assert read_mart(spark, paths, "mart_revenue").isEmpty()
    assert read_mart(spark, paths, "mart_dau").filter("event_date = '2024-01-09'").isEmpty()

    # Nothing new: nothing changes.
    before = everything(read_dimension(spark, paths))
    run_pipeline(spark, paths, today=TODAY)
    assert everything(read_dimension(spark, paths)) == before

    recent = store_checks(spark, paths, dt.date(2024, 1, 12))
    assert recent.count() == 26 and recent.filter("failing_rows > 0").isEmpty()
    assert read_failing(spark, paths, "stg_events", "event_type", "accepted_values") is None
    names = register_views(spark, paths)
    assert {"dim_user_current", "dim_user_scd", "mart_funnel", "silver_searches", "stg_events"} <= set(names)
    assert spark.sql("select count(*) from dim_user_current").first()[0] == 3


def lost(*_):
    raise OSError("lost")


def test_dimension_survives_a_crash_before_the_version_is_saved(spark, tmp_path, monkeypatch):
    paths = Paths(str(tmp_path))
    drop(paths, "a", event("1", "2024-01-05T10:00:00"), event("2", "2024-01-06T10:00:00", country="CA"))
    run_pipeline(spark, paths, today=TODAY)
    before = everything(read_dimension(spark, paths))

    drop(paths, "b", event("3", "2024-01-07T10:00:00", country="GB"))
    load(spark, paths)
    promote(spark, paths, today=TODAY)
    with monkeypatch.context() as patch:
        patch.setattr(Step, "commit", lost)
        with pytest.raises(OSError):
            update_dimension(spark, paths)
    assert everything(read_dimension(spark, paths)) == before

    # More arrives before the next try; both are taken up.
    drop(paths, "c", event("4", "2024-01-09T10:00:00", country="DE"))
    load(spark, paths)
    promote(spark, paths, today=TODAY)
    assert update_dimension(spark, paths) == 2
    assert update_dimension(spark, paths) is None
    update_marts(spark, paths)
    same_as_from_scratch(spark, paths)


def test_settled_rows_are_not_rewritten(spark, tmp_path):
    paths = Paths(str(tmp_path))

    def run(day, country, **options):
        drop(paths, day, event(day, f"2024-01-{day}T10:00:00", country=country))
        load(spark, paths)
        promote(spark, paths, today=TODAY)
        update_dimension(spark, paths, **options)
        silver = read_silver(spark, paths.silver)
        assert everything(read_dimension(spark, paths)) == everything(full_build(dimension_events(silver)))

    def stored(version):
        return spark.read.parquet(f"{paths.dimension}/version={version}").count()

    for day, country in (("01", "A"), ("05", "B"), ("09", "C"), ("13", "D"), ("17", "E")):
        run(day, country)
    assert "settled=true" in os.listdir(f"{paths.dimension}/version=4")
    assert stored(5) < read_dimension(spark, paths).count()
    run("21", "F", complete_every=5)
    assert stored(6) == read_dimension(spark, paths).count()
    assert last_run(RunState(spark, paths.state))["base"] == 6
    run("25", "A", complete_every=5)
    assert stored(7) < read_dimension(spark, paths).count()


def ids(spark, paths):
    return sorted(r.event_id for r in read_bronze(spark, paths.bronze).collect())


def test_streams_into_one_bronze_keep_each_others_rows(spark, tmp_path):
    paths = Paths(str(tmp_path))
    drop(paths, "a", event("1"))
    load(spark, paths)
    queue = tmp_path / "queue"
    queue.mkdir()
    (queue / "q.txt").write_text(json.dumps(event("2")))
    load_bronze(from_text(spark.readStream.text(str(queue))), paths.bronze, paths.stream("queue")).awaitTermination()
    assert ids(spark, paths) == ["1", "2"]
    # A new checkpoint counts its batches from 0 again.
    load_bronze(stream_raw(spark, paths.raw), paths.bronze, paths.stream("again")).awaitTermination()
    assert ids(spark, paths) == ["1", "1", "2"]


def test_landing_streams_keep_each_others_raw_records(spark, tmp_path):
    paths = Paths(str(tmp_path))
    for name in ("1", "2"):
        folder = tmp_path / f"in{name}"
        folder.mkdir()
        (folder / "x.txt").write_text(json.dumps(event(name)))
        land_events(
            from_text(spark.readStream.text(str(folder))), paths.raw, paths.logs, paths.rejected, paths.stream(name)
        ).awaitTermination()
    raw = spark.read.option("recursiveFileLookup", "true").text(paths.raw).collect()
    assert sorted(json.loads(r.value)["event_id"] for r in raw) == ["1", "2"]


def test_backfills_add_what_is_not_loaded(spark, tmp_path):
    paths = Paths(str(tmp_path))
    drop(paths, "a", event("1"), event("2"))
    load(spark, paths)
    drop(paths, "b", event("3"), "{broken")
    os.utime(f"{paths.raw}/b.json", (0, 0))
    backfill_bronze(spark, paths)
    drop(paths, "c", event("4"))
    backfill_bronze(spark, paths, modified_after="2020-01-01T00:00:00")
    backfill_bronze(spark, paths)
    assert ids(spark, paths) == ["1", "2", "3", "4"]
    assert read_quarantine(spark, paths.bronze).count() == 1


def test_old_files_are_streamed(spark, tmp_path):
    paths = Paths(str(tmp_path))
    drop(paths, "a", event("1"))
    load(spark, paths)
    drop(paths, "b", event("2"))
    os.utime(f"{paths.raw}/b.json", (1_000_000_000, 1_000_000_000))
    load(spark, paths)
    assert ids(spark, paths) == ["1", "2"]


def test_longer_lookback_takes_settled_rows_back(spark, tmp_path):
    paths = Paths(str(tmp_path))

    def run(day, lookback, *events):
        drop(paths, day, *events)
        load(spark, paths)
        promote(spark, paths, lookback, TODAY)
        update_dimension(spark, paths, lookback)

    for day, country in (("01", "A"), ("05", "B"), ("09", "C"), ("13", "D"), ("17", "E")):
        run(day, 2, event(day, f"2024-01-{day}T10:00:00", country=country))
    run("20", 14, event("20", "2024-01-20T10:00:00", country="F"), event("07", "2024-01-07T10:00:00", country="G"))
    same = everything(full_build(dimension_events(read_silver(spark, paths.silver))))
    assert everything(read_dimension(spark, paths)) == same


def test_dimension_follows_silver_whatever_the_ingestion_times(spark, tmp_path):
    paths = Paths(str(tmp_path))
    events = [
        event("1", "2024-01-10T10:00:00", ingested="2999-01-01T00:00:00"), event("2", "2024-01-11T10:00:00", country="CA"),
        {k: v for k, v in event("3", "2024-01-11T12:00:00", user=5).items() if k != "ingested_at"},
    ]
    for i, e in enumerate(events):
        drop(paths, str(i), e)
        load(spark, paths)
        promote(spark, paths, today=TODAY)
        update_dimension(spark, paths)
    same = everything(full_build(dimension_events(read_silver(spark, paths.silver))))
    assert everything(read_dimension(spark, paths)) == same and len(same) == 3


def test_idle_run_writes_nothing(spark, tmp_path):
    paths = Paths(str(tmp_path))
    drop(paths, "a", event("1"), event("2", "2024-01-12T10:00:00"))
    for _ in range(2):
        run_pipeline(spark, paths, today=TODAY)
    tables = (paths.silver, paths.marts, paths.dimension)
    files = lambda: sorted((f, os.stat(f"{d}/{f}").st_mtime_ns) for t in tables for d, _, fs in os.walk(t) for f in fs)
    before = files()
    run_pipeline(spark, paths, today=TODAY)
    assert files() == before


def test_state_doesnt_depend_on_clocks(spark, tmp_path):
    state = RunState(spark, str(tmp_path))
    for value in ("c", "b", "a"):
        state.put("x", value)
        assert state.get("x") == value

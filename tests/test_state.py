"""Numbered records of run state, and two runs at once."""

import datetime as dt

import pytest

from test_silver import TODAY, countries, deliver
from tidemark.operators import scd
from tidemark.plans.dimension import read_dimension, update_dimension
from tidemark.plans.paths import Paths
from tidemark.plans.pipeline import promote
from tidemark.sources import state as state_module
from tidemark.sources.state import ConflictingRunError, RunState
from tidemark.sources.tables import read_silver


def test_values_stay_until_they_are_saved_anew(spark, tmp_path):
    state = RunState(spark, f"{tmp_path}/state")
    assert state.get("a") is None and state.get("a", "none") == "none"
    state.put("a", 1)
    state.put("b", "two words\né")
    step = state.begin()
    step.commit({"a": 3, "c": None})
    assert {name: state.get(name) for name in "abc"} == {"a": "3", "b": "two words\né", "c": "None"}


def test_of_two_steps_from_one_record_one_is_refused(spark, tmp_path):
    state = RunState(spark, f"{tmp_path}/state")
    state.put("a", 0)
    first, second = state.begin(), state.begin()
    second.commit({"b": 1})
    with pytest.raises(ConflictingRunError):
        first.commit({"a": 1})
    assert (state.get("a"), state.get("b")) == ("0", "1")
    second.commit({"b": 2})  # the other may go on
    assert state.get("b") == "2"


def test_a_record_half_written_is_no_record(spark, tmp_path):
    state = RunState(spark, f"{tmp_path}/state")
    state.put("a", 1)
    (tmp_path / "state" / "_fresh-0").write_text('{"a": ')
    assert state.get("a") == "1"


def test_old_records_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(state_module, "KEPT", 2)
    state = RunState(spark, f"{tmp_path}/state")
    for i in range(6):
        state.put("a", i)
    assert len(list((tmp_path / "state").glob("*.json"))) == 3 and state.get("a") == "5"


def test_no_spark_job_runs(spark, tmp_path):
    state = RunState(spark, f"{tmp_path}/state")
    spark.sparkContext.setJobGroup("state", "state")
    state.put("a", 1)
    state.get("a")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("state")
    spark.sparkContext.setJobGroup("", "")


def test_a_promotion_beside_another_is_refused(spark, tmp_path, monkeypatch):
    """The second promotion saves first; the first one says so, and running it again sees all events."""
    paths = Paths(str(tmp_path))
    deliver(spark, paths, 0, [("a", "2024-01-10T10:00:00", "US", "2024-01-10T10:01:00")])
    promote(spark, paths, 2, TODAY)
    deliver(spark, paths, 1, [("b", "2024-01-10T11:00:00", "CA", "2024-01-10T11:01:00")])
    from tidemark.plans import pipeline

    write, inner = pipeline.write_silver, []

    def beside(*args, **kwargs):
        published = write(*args, **kwargs)
        if not inner:
            inner.append(1)
            promote(spark, paths, 2, TODAY)
        return published

    monkeypatch.setattr(pipeline, "write_silver", beside)
    with pytest.raises(ConflictingRunError):
        promote(spark, paths, 2, TODAY)
    assert promote(spark, paths, 2, TODAY) == "2024-01-10"
    assert countries(spark, paths) == {"a": "US", "b": "CA"}


def test_dimension_follows_a_promotion_that_looked_further_back(spark, tmp_path):
    """A late event five days before the checkpoint, taken by a lookback of 10, reaches the dimension by default."""
    paths = Paths(str(tmp_path))
    deliver(spark, paths, 0, [
        ("a", "2024-01-01T10:00:00", "US", "2024-01-01T10:01:00"), ("b", "2024-01-10T10:00:00", "CA", "2024-01-10T10:01:00"),
    ])
    promote(spark, paths, 2, TODAY)
    update_dimension(spark, paths)
    deliver(spark, paths, 1, [("c", "2024-01-05T10:00:00", "GB", "2024-01-10T12:00:00")])
    promote(spark, paths, 10, TODAY)
    update_dimension(spark, paths)
    full = scd.full_build(scd.dimension_events(read_silver(spark, paths.silver)))
    assert sorted(map(tuple, read_dimension(spark, paths).collect()), key=str) == sorted(map(tuple, full.collect()), key=str)
    assert [r.country for r in full.orderBy("effective_start").collect()] == ["US", "GB", "CA"]
    assert dt.date(2024, 1, 5) in {r.event_date for r in read_silver(spark, paths.silver).collect()}

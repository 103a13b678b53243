"""Folding bronze loads, and dropping dimension versions."""

import datetime as dt
import os

import pytest
from test_silver import TODAY, deliver
from test_streaming import drop, event, run_pipeline

from tidemark.operators.bronze import bronze
from tidemark.operators.scd import dimension_events, full_build
from tidemark.plans import compaction
from tidemark.plans.compaction import compact_bronze
from tidemark.plans.dimension import read_dimension, update_dimension
from tidemark.plans.paths import Paths
from tidemark.plans.pipeline import promote
from tidemark.sources.raw import from_text
from tidemark.sources.tables import read_bronze, read_quarantine, read_silver, write_load

BEFORE = dt.date(2024, 1, 9)


def folders(paths):
    return sorted(d for d, subs, files in os.walk(paths.bronze) if os.path.basename(d).startswith("load="))


def rows(spark, paths):
    return sorted(map(str, read_bronze(spark, paths.bronze).collect()))


def loads(spark, paths, numbers):
    for i in numbers:
        deliver(spark, paths, i, [(f"{i}", "2024-01-01T10:00:00", "US", "a"), (f"{i}w", "2024-01-10T10:00:00", "US", "a")])


def test_closed_dates_keep_few_loads(spark, tmp_path):
    paths = Paths(str(tmp_path))
    counts = []
    for start in range(0, 10, 2):
        loads(spark, paths, range(start, start + 2))
        before = rows(spark, paths)
        compact_bronze(spark, paths, BEFORE, fold=2)
        assert rows(spark, paths) == before
        counts.append(len([f for f in folders(paths) if "2024-01-01" in f]))
    assert max(counts) <= 3
    assert len([f for f in folders(paths) if "2024-01-10" in f]) == 10  # still open
    assert compact_bronze(spark, paths, BEFORE, dt.date(2024, 1, 2), fold=2) == 0


def test_quarantine_is_folded(spark, tmp_path):
    paths = Paths(str(tmp_path))
    for i in range(4):
        broken = spark.createDataFrame([(f"{{{i}",)], "value string")
        write_load(bronze(from_text(broken)), paths.bronze, i)
    assert compact_bronze(spark, paths, BEFORE, fold=4) == 4
    assert len(folders(paths)) == 1
    assert sorted(r.raw_text for r in read_quarantine(spark, paths.bronze).collect()) == [f"{{{i}" for i in range(4)]


@pytest.mark.parametrize("dies_at", ["write_partitioned", "remove_folder"])
def test_a_compaction_that_died_is_finished(spark, tmp_path, monkeypatch, dies_at):
    paths = Paths(str(tmp_path))
    loads(spark, paths, range(4))
    before = rows(spark, paths)
    done = getattr(compaction, dies_at)

    def dies(*args):
        done(*args)
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(compaction, dies_at, dies)
        with pytest.raises(OSError):
            compact_bronze(spark, paths, BEFORE, fold=4)
    compact_bronze(spark, paths, BEFORE, fold=4)
    assert rows(spark, paths) == before
    assert len([f for f in folders(paths) if "2024-01-01" in f]) == 1


def test_pipeline_goes_on_after_folding(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(compaction.compact_bronze, "__defaults__", (None, 2))
    paths = Paths(str(tmp_path))
    for i, day in enumerate(("01", "01", "05", "05", "10", "10")):
        drop(paths, f"{i}", event(f"{i}", f"2024-01-{day}T10:00:00"), "{broken")
        run_pipeline(spark, paths, today=TODAY)
    assert "compact1-" in "".join(folders(paths))
    assert sorted(r.event_id for r in read_silver(spark, paths.silver).collect()) == [f"{i}" for i in range(6)]
    assert read_bronze(spark, paths.bronze).count() == 6
    assert read_quarantine(spark, paths.bronze).count() == 6


def test_unused_dimension_versions_are_dropped(spark, tmp_path):
    paths = Paths(str(tmp_path))
    for i in range(8):
        deliver(spark, paths, i, [(f"{i}", f"2024-01-{i + 1:02d}T10:00:00", f"C{i}", "a")], f"2024-02-0{i + 1} 00:00:00")
        promote(spark, paths, today=TODAY)
        update_dimension(spark, paths, complete_every=2)
    want = full_build(dimension_events(read_silver(spark, paths.silver)))
    assert sorted(map(str, read_dimension(spark, paths).collect())) == sorted(map(str, want.collect()))
    assert len([d for d in os.listdir(paths.dimension) if d.startswith("version=")]) <= 4

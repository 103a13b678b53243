"""The dimension operators against the row-by-row rule they must equal."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import scd

START = dt.datetime(2024, 1, 1)
EVENTS = "user_id bigint, country string, event_ts timestamp_ntz, ingested_at timestamp_ntz, event_id string"


def at(minutes):
    return START + dt.timedelta(minutes=minutes)


def events(spark, rows):
    return spark.createDataFrame(rows, EVENTS)


def empty_dim(spark):
    return spark.createDataFrame([], schemas.DIM_SCHEMA)


def stored(spark, df, tmp_path, name):
    path = str(tmp_path / name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def as_bag(dim):
    """The rows with their number; events at the same time give equal rows."""
    return Counter(tuple(row) for row in dim.select(schemas.DIM_COLUMNS).collect())


def one_by_one(dim, batch):
    """Apply events in time order, one at a time."""
    dim = [list(row) for row in Counter(dim).elements()]
    for user, country, ts, _, _ in sorted(batch, key=lambda e: (e[2], e[3], e[4])):
        current = next((row for row in dim if row[0] == user and row[4]), None)
        if current is not None and current[1] == country:
            continue
        if current is not None:
            current[3], current[4] = ts, False
        dim.append([user, country, ts, None, True])
    return Counter(tuple(row) for row in dim)


def random_events(rng, n, users, days):
    """Events of a few users; one user has a third of them, some arrive late."""
    rows = []
    for i in range(n):
        user = 1 if rng.random() < 0.33 else rng.randint(2, users)
        minute = rng.randrange(days * 1440)
        late = rng.choice([1, 1, 1, 600, 1400])
        rows.append((user, rng.choice("ABC"), at(minute), at(minute + late), f"e{i:05d}"))
    return rows


def batches(rows, days):
    """Split by arrival, two days per batch."""
    for first in range(0, days + 2, 2):
        low, high = at(first * 1440), at((first + 2) * 1440)
        yield [e for e in rows if low <= e[3] < high]


@pytest.mark.parametrize("rows_per_piece", [None, 10])
@pytest.mark.parametrize("seed", [1, 2])
def test_batches_equal_the_sequential_rule(spark, tmp_path, seed, rows_per_piece):
    rng = random.Random(seed)
    rows = random_events(rng, 300, 12, 8)
    dim, expected = empty_dim(spark), Counter()
    for i, batch in enumerate(batches(rows, 8)):
        if seed == 2:  # sparse batches: most users are absent
            batch = [e for e in batch if e[0] % 3 == i % 3 or e[0] == 1]
        frame = events(spark, batch)
        cuts = rows_per_piece and scd.busy_timelines(frame, rows_per_piece)
        dim = stored(spark, scd.apply_batch(dim, frame, cuts), tmp_path, f"dim{i}")
        expected = one_by_one(expected, batch)
        assert as_bag(dim) == expected
    late = dim.filter("effective_end < effective_start").count()
    assert late > 0, "the fixture should contain late events"


@pytest.mark.parametrize("rows_per_piece", [1, 7, 40])
def test_pieces_do_not_change_the_build(spark, rows_per_piece):
    rows = random_events(random.Random(3), 400, 6, 10)
    # Long stretches without a change, and ties, across piece borders.
    rows += [(7, "A", at(i), at(i + 1), f"s{i:05d}") for i in range(60)]
    rows += [(8, "AB"[i % 2], at(100), at(101), f"t{i:05d}") for i in range(40)]
    frame = events(spark, rows)
    cuts = scd.busy_timelines(frame, rows_per_piece)
    assert cuts is not None
    assert as_bag(scd.full_build(frame, cuts)) == one_by_one([], rows)
    assert as_bag(scd.full_build(frame)) == one_by_one([], rows)


@pytest.mark.parametrize("rows_per_piece", [None, 10])
def test_replay_and_rebuild_equal_a_full_build(spark, tmp_path, rows_per_piece):
    rows = random_events(random.Random(4), 300, 10, 8)
    known, dim, dim2 = [], empty_dim(spark), empty_dim(spark)
    for i, batch in enumerate(batches(rows, 8)):
        known += batch
        frame, all_events = events(spark, batch), events(spark, known)
        cuts = rows_per_piece and scd.busy_timelines(all_events, rows_per_piece)
        since = F.lit(at(i * 2 * 1440 - 1440)).cast("timestamp_ntz")  # events are up to a day late
        dim = stored(spark, scd.replay(dim, all_events, since, cuts), tmp_path, f"replay{i}")
        rebuilt = scd.rebuild_users(dim2, all_events, frame, cuts)
        dim2 = stored(spark, rebuilt, tmp_path, f"rebuild{i}")
        assert as_bag(dim) == as_bag(dim2) == one_by_one([], known)
    check_intervals(dim)


def check_intervals(dim):
    """Per user: no negative interval, no gap, exactly one current row."""
    by_user = {}
    for row in dim.collect():
        by_user.setdefault(row.user_id, []).append(row)
    for versions in by_user.values():
        assert sum(v.is_current for v in versions) == 1
        versions.sort(key=lambda v: (v.effective_start, v.effective_end or dt.datetime.max))
        for before, after in zip(versions, versions[1:]):
            assert before.effective_start <= before.effective_end == after.effective_start


def test_late_event(spark):
    first = [(1, "US", at(600), at(601), "a"), (1, "CA", at(720), at(721), "b")]
    late = [(1, "GB", at(660), at(800), "c")]
    dim = scd.full_build(events(spark, first))
    appended = scd.apply_batch(dim, events(spark, late))
    assert (1, "CA", at(720), at(660), False) in as_bag(appended)
    replayed = scd.replay(dim, events(spark, first + late), F.lit(at(600)).cast("timestamp_ntz"))
    assert set(as_bag(replayed)) == {
        (1, "US", at(600), at(660), False),
        (1, "GB", at(660), at(720), False),
        (1, "CA", at(720), None, True),
    }


def test_redelivered_event(spark):
    first = [(1, "US", at(10), at(11), "a"), (1, "CA", at(20), at(21), "b")]
    again = [(1, "US", at(10), at(90), "a")]
    dim = scd.full_build(events(spark, first))
    # Appending reapplies the old country; a replay over the deduplicated events does not.
    assert scd.apply_batch(dim, events(spark, again)).count() == 3
    deduplicated = events(spark, [again[0], first[1]])
    since = F.lit(at(0)).cast("timestamp_ntz")
    assert as_bag(scd.replay(dim, deduplicated, since)) == as_bag(dim)


def test_rewind_reopens_versions(spark):
    dim = scd.full_build(events(spark, [(1, c, at(t), at(t), c) for c, t in [("A", 1), ("B", 5), ("C", 9)]]))
    cases = {
        1: set(),
        2: {("A", None)},
        5: {("A", None)},
        6: {("A", at(5)), ("B", None)},
        10: {("A", at(5)), ("B", at(9)), ("C", None)},
    }
    for minute, expected in cases.items():
        back = scd.rewind(dim, F.lit(at(minute)).cast("timestamp_ntz"))
        assert {(r.country, r.effective_end) for r in back.collect()} == expected


def test_incomplete_events_are_left_out(spark):
    silver = spark.createDataFrame(
        [
            (1, "US", at(1), "2024-01-01T00:02:00", "a"),
            (None, "US", at(1), "2024-01-01T00:02:00", "b"),
            (1, None, at(1), "2024-01-01T00:02:00", "c"),
            (1, "US", None, "2024-01-01T00:02:00", "d"),
            (1, "US", at(2), None, "e"),
        ],
        "user_id bigint, country string, event_ts timestamp_ntz, ingested_at string, event_id string",
    )
    found = scd.dimension_events(silver)
    assert {r.event_id for r in found.collect()} == {"a", "e"}
    fresh = scd.newer_than(found, F.lit(at(0)).cast("timestamp_ntz"))
    assert [r.event_id for r in fresh.collect()] == ["a"]

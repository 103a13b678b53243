"""Cutting busy timelines."""

import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from tidemark.functions import pieces
from tidemark.functions.pieces import busy_keys, with_piece
from tidemark.operators import scd

ORDER = ["t", "i"]


def skewed(spark, n=3000):
    """A third of all rows belongs to key 0, half of those within one minute."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50 + 1)
    second = F.when(F.col("id") % 2 == 0, F.col("id") % 60).otherwise(F.col("id") * 60)
    return spark.range(n).select(
        key.alias("k"),
        F.timestamp_seconds(F.lit(1704067200) + second).cast("timestamp_ntz").alias("t"),
        F.col("id").cast("string").alias("i"),
    )


def test_nothing_is_cut_without_busy_keys(spark):
    assert busy_keys(skewed(spark), "k") is None
    assert busy_keys(skewed(spark), "k", 2000) is None
    assert busy_keys(skewed(spark).limit(0), "k", 1) is None
    assert busy_keys(skewed(spark).withColumn("k", F.lit(None).cast("int")), "k", 1) is None


def test_only_busy_keys_are_cut_evenly(spark):
    frame = skewed(spark)
    busy = busy_keys(frame, "k", 100)
    assert [row.k for row in busy.keys.collect()] == [0] and busy.pieces == 10
    sizes = [r["count"] for r in with_piece(busy.rows(frame), "k", ORDER, busy.pieces).groupBy("piece").count().collect()]
    assert sum(sizes) == 1000 and len(sizes) == 10 and max(sizes) <= 150
    assert busy.others(frame).filter("k = 0").isEmpty() and busy.others(frame).count() == 2000


def test_pieces_follow_time(spark):
    placed = with_piece(skewed(spark), "k", ORDER, 40)
    spans = placed.groupBy("piece").agg(
        F.min(F.struct("k", *ORDER)).alias("a"), F.max(F.struct("k", *ORDER)).alias("b")
    ).orderBy("piece")
    rows = spans.collect()
    assert len(rows) > 30 and all(before.b < after.a for before, after in zip(rows, rows[1:]))


def test_rows_of_one_moment_are_spread(spark):
    frame = spark.range(1000).select(
        F.lit(1).alias("k"), F.lit("2024-01-01").cast("timestamp_ntz").alias("t"), F.col("id").alias("i")
    )
    sizes = with_piece(frame, "k", ORDER, 100).groupBy("piece").count().collect()
    assert len(sizes) == 100 and max(row["count"] for row in sizes) <= 15


def test_small_pieces_share_partitions(spark):
    """Pieces of ten rows, 300 of them: no task each, yet all in order."""
    placed = with_piece(skewed(spark), "k", ORDER, 300, 10)
    assert placed.rdd.getNumPartitions() <= 4
    spans = placed.groupBy("piece").agg(
        F.min(F.struct("k", *ORDER)).alias("a"), F.max(F.struct("k", *ORDER)).alias("b"), F.count("*").alias("n")
    ).orderBy("piece")
    rows = spans.collect()
    assert len(rows) >= 300 and max(row.n for row in rows) == 10 and sum(row.n for row in rows) == 3000
    assert all(before.b < after.a for before, after in zip(rows, rows[1:]))


def test_small_pieces_build_the_same_history(spark):
    events = timeline(spark, 2000)
    busy = scd.busy_timelines(events, 7)
    assert busy.pieces == 286 and busy.rows_per_piece == 7
    got, want = scd.full_build(events, busy), scd.full_build(events)
    assert got.count() == 667 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_number_of_busy_keys_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(pieces, "MAX_PIECES", 20)
    busy = busy_keys(skewed(spark), "k", 1)
    assert busy.keys.count() < 20 and busy.pieces <= 20


def timeline(spark, n):
    """One user who changes country every third event."""
    countries = F.array(*[F.lit(c) for c in ("US", "CA", "GB")])
    return spark.range(n).select(
        F.when(F.col("id") >= 0, 1).cast("bigint").alias("user_id"),
        F.get(countries, (F.floor(F.col("id") / 3) % 3).cast("int")).alias("country"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id")).cast("timestamp_ntz").alias("event_ts"),
        F.lit(None).cast("timestamp_ntz").alias("ingested_at"),
        F.format_string("%08d", "id").alias("event_id"),
    )


def test_a_user_of_twenty_thousand_pieces(spark):
    """Pieces of two rows: versions run over many of them, and some pieces start none."""
    rows = timeline(spark, 40_000).withColumn("turn", F.lit(1))
    placed = rows.withColumn("piece", F.floor(F.unix_seconds(F.col("event_ts").cast("timestamp")) / 2).cast("int"))
    assert placed.select("piece").distinct().count() == 20_000
    columns = ["user_id", "country", "event_ts", "effective_end"]
    got = scd.stitch(placed).select(columns)
    want = scd._within(rows, ["user_id"]).select(columns)
    assert want.count() == 13_334
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_plan_holds_ranges_and_no_array_of_cuts(spark):
    events = timeline(spark, 300)
    busy = scd.busy_timelines(events, 50)
    text = io.StringIO()
    with redirect_stdout(text):
        with_piece(busy.rows(events), "user_id", scd.EVENT_ORDER, busy.pieces).explain()
        scd.full_build(events, busy).explain()
    plan = text.getvalue()
    assert "rangepartitioning(user_id" in plan and "event_id" in plan
    assert "array<struct" not in plan and "cuts" not in plan

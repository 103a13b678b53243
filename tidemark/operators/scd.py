"""Type-2 history of a user's country.

A version is opened by every event whose country differs from the one before it and
closed by the next version's start. Two ways to keep the history up to date:

* `apply_batch` appends a batch after whatever is current, in the batch's own time
  order. An event older than the current version is still applied as the newest
  one, so late events can leave a version that ends before it starts.
* `rewind` + `apply_batch` (or `rebuild_users`) replays the events the late ones
  belong between, and gives the same history as one build over all events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import utc_timestamp
from tidemark.functions.pieces import ROWS_PER_PIECE, Busy, busy_keys, with_piece
from tidemark.sources.scratch import scratch_dir

EVENT_ORDER = ["event_ts", "ingested_at", "event_id"]
# The current version (turn 0) goes before the events (turn 1) of its user.
TIMELINE = ["turn", *EVENT_ORDER]


def dimension_events(silver: DataFrame) -> DataFrame:
    """Fields the dimension needs, `ingested_at` parsed, rows without key, value or time dropped."""
    return silver.select(
        "user_id",
        "country",
        "event_ts",
        utc_timestamp(F.col("ingested_at")).alias("ingested_at"),
        "event_id",
    ).dropna(subset=["user_id", "country", "event_ts"])


def user_bucket(buckets: int) -> Column:
    """Which of a number of buckets a user belongs to. Of two numbers that divide each other,
    the bucket under the smaller is the other's remainder."""
    return F.pmod(F.xxhash64("user_id"), F.lit(buckets)).cast("int")


def newer_than(events: DataFrame, watermark: Column) -> DataFrame:
    """Events ingested after the watermark (a timestamp_ntz)."""
    return events.filter(F.col("ingested_at") > watermark)


def busy_timelines(events: DataFrame, rows_per_piece: int = ROWS_PER_PIECE) -> Busy | None:
    """The users whose timelines are too long for a task; None if there are none.

    Any events that contain the ones to build from will do, duplicates included.
    """
    return busy_keys(events, "user_id", rows_per_piece)


def _starts_version(previous: Column) -> Column:
    return previous.isNull() | (previous != F.col("country"))


def _versions(rows: DataFrame, busy: Busy | None) -> DataFrame:
    """Versions from `(user_id, country, event_ts, ingested_at, event_id, turn)`."""
    if busy is None:
        found = _within(rows, ["user_id"])
    else:
        columns = ["user_id", "country", "event_ts", "effective_end"]
        cut = stitch(with_piece(busy.rows(rows), "user_id", TIMELINE, busy.pieces, busy.rows_per_piece))
        found = cut.select(columns).unionByName(_within(busy.others(rows), ["user_id"]).select(columns))
    return found.select(
        "user_id",
        "country",
        F.col("event_ts").alias("effective_start"),
        "effective_end",
        F.col("effective_end").isNull().alias("is_current"),
    )


def _within(rows: DataFrame, group: list[str]) -> DataFrame:
    """Rows that start a version inside their group, with the next such start."""
    timeline = Window.partitionBy(*group).orderBy(*TIMELINE)
    return (
        rows.withColumn("previous", F.lag("country").over(timeline))
        .filter(_starts_version(F.col("previous")))
        .withColumn("effective_end", F.lead("event_ts").over(timeline))
    )


def stitch(placed: DataFrame) -> DataFrame:
    """As `_within(rows, ["user_id"])` over rows whose `piece` cuts every user's timeline in order.

    The window runs per piece, and its version starts are written; one row per user and piece then carries the country
    from piece to piece. A user may have any number of pieces.
    """
    spark = placed.sparkSession
    path = scratch_dir(spark, "pieces")
    starts = _within(placed, ["user_id", "piece"])
    starts.write.parquet(path)
    inside = spark.read.schema(starts.schema).parquet(path)

    # One row per piece: no more rows than there are cuts and busy users.
    opens = F.col("previous").isNull()
    closes = F.col("effective_end").isNull()
    edges = (
        inside.filter(opens | closes)
        .groupBy("user_id", "piece")
        .agg(
            F.max(F.when(opens, F.col("country"))).alias("country"),
            F.max(F.when(opens, F.col("event_ts"))).alias("first_ts"),
            F.max(F.when(opens, F.col("effective_end"))).alias("second_ts"),
            F.max(F.when(closes, F.col("country"))).alias("last_country"),
        )
    )
    forward = Window.partitionBy("user_id").orderBy("piece")
    backward = (
        Window.partitionBy("user_id")
        .orderBy(F.desc("piece"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = F.lag("last_country").over(forward)
    edges = (
        edges.withColumn("opens_version", _starts_version(carried))
        .withColumn(
            "first_start",
            F.when(F.col("opens_version"), F.col("first_ts")).otherwise(F.col("second_ts")),
        )
        .withColumn("next_start", F.last("first_start", ignorenulls=True).over(backward))
        .select("user_id", "piece", "opens_version", "next_start")
    )
    # A piece's first row starts a version only if the country before it differs.
    repeats = F.col("previous").isNull() & ~F.col("opens_version")
    return (
        inside.join(F.broadcast(edges), ["user_id", "piece"])
        .filter(~repeats)
        .withColumn("effective_end", F.coalesce("effective_end", "next_start"))
    )


def full_build(events: DataFrame, busy: Busy | None = None) -> DataFrame:
    """The whole history from `dimension_events`.

    `busy` (from `busy_timelines`) spreads very busy users over several tasks; it never
    changes the result.
    """
    return _versions(events.withColumn("turn", F.lit(1)), busy)


def apply_batch(dim: DataFrame, batch: DataFrame, busy: Busy | None = None) -> DataFrame:
    """The history after a batch of `dimension_events`.

    Current versions join their user's timeline as its first row, so untouched
    users come out as they went in and no join is needed.
    """
    current = dim.filter("is_current").select(
        "user_id",
        "country",
        F.col("effective_start").alias("event_ts"),
        F.lit(None).cast("timestamp_ntz").alias("ingested_at"),
        F.lit(None).cast("string").alias("event_id"),
        F.lit(0).alias("turn"),
    )
    rows = current.unionByName(batch.withColumn("turn", F.lit(1)))
    closed = dim.filter("not is_current").select(schemas.DIM_COLUMNS)
    return closed.unionByName(_versions(rows, busy))


def rewind(dim: DataFrame, since: Column) -> DataFrame:
    """The history as it stood before `since` (a timestamp_ntz)."""
    end = F.col("effective_end")
    return (
        dim.filter(F.col("effective_start") < since)
        .withColumn("effective_end", F.when(end < since, end))
        .withColumn("is_current", F.col("effective_end").isNull())
    )


def replay(
    dim: DataFrame, events: DataFrame, since: Column, busy: Busy | None = None
) -> DataFrame:
    """Late-safe update when nothing dated before `since` has changed.

    `events` are all events, not only new ones; those before `since` are not used,
    so pass a scan that prunes them.
    """
    window = events.filter(F.col("event_ts") >= since)
    return apply_batch(rewind(dim, since), window, busy)


def rebuild_users(
    dim: DataFrame, events: DataFrame, batch: DataFrame, busy: Busy | None = None
) -> DataFrame:
    """Late-safe update however old the batch's events are: rebuild its users from all events."""
    touched = batch.select("user_id").distinct()
    if busy is None:
        theirs = events.join(touched, "user_id", "left_semi")
    else:
        # Busy users are few, so their events meet a broadcast and not each other.
        hot = touched.join(F.broadcast(busy.keys), "user_id", "left_semi")
        theirs = busy.others(events).join(touched, "user_id", "left_semi").unionByName(
            busy.rows(events).join(F.broadcast(hot), "user_id", "left_semi")
        )
    untouched = dim.join(touched, "user_id", "left_anti")
    return untouched.select(schemas.DIM_COLUMNS).unionByName(full_build(theirs, busy))


def current_users(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current").select(schemas.DIM_COLUMNS)

"""Split the timelines of very busy keys into pieces that fit a task.

A window over one key runs in one task. When a key holds a large share of all rows, the rows of
such keys are range partitioned by the whole sort key, so a partition is a stretch of one timeline or of a
few neighbouring ones; its number is the piece. The window then runs per (key, piece) and the caller stitches
neighbouring pieces together. Pieces far smaller than a task share a partition, which is sorted and cut by row number.
Where pieces end only decides where rows are processed, never what the result is: every row is in
exactly one piece, and pieces follow the order.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.scratch import scratch_dir

MAX_PIECES = 100_000
ROWS_PER_PIECE = 5_000_000


@dataclass(frozen=True)
class Busy:
    """Keys with more rows than a piece: a stored table of fewer than MAX_PIECES rows, the pieces they make and the
    rows of a piece."""

    key: str
    keys: DataFrame
    pieces: int
    rows_per_piece: int

    def others(self, df: DataFrame) -> DataFrame:
        """Rows of keys that are not busy."""
        return df.join(F.broadcast(self.keys), self.key, "left_anti")

    def rows(self, df: DataFrame) -> DataFrame:
        """Rows of busy keys, without bringing a key's rows together."""
        return df.join(F.broadcast(self.keys), self.key, "left_semi")


def busy_keys(df: DataFrame, key: str, rows_per_piece: int = ROWS_PER_PIECE) -> Busy | None:
    """The keys of `df` that need cutting, or None when there are none.

    Counts the rows, then if one key could be busy the rows per key. With `target = max(rows_per_piece, rows /
    MAX_PIECES)` only keys with more than `target` rows are busy, so there are fewer than MAX_PIECES of
    them, which makes it safe to broadcast them.
    """
    total = df.count()
    target = max(rows_per_piece, math.ceil(total / MAX_PIECES))
    if total <= target:
        return None
    per_key = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    path = scratch_dir(df.sparkSession, "busy-keys")
    per_key.filter(F.col("n") > target).write.parquet(path)
    busy = df.sparkSession.read.schema(per_key.schema).parquet(path)
    rows = busy.agg(F.sum("n")).first()[0]
    return Busy(key, busy.select(key), math.ceil(rows / target), target) if rows else None


def with_piece(
    rows: DataFrame, key: str, order: list[str], pieces: int, rows_per_piece: int | None = None
) -> DataFrame:
    """Add `piece`: the range of (key, order) that a row is in, of about `pieces` even ones; nulls come first.

    With `rows_per_piece` there are no more partitions than the session shuffles into, or than hold `ROWS_PER_PIECE` rows
    each, and a partition is cut every so many rows; without it a piece is a partition. The ranges are
    drawn anew whenever the plan runs, so store what is made of it before reading it twice.
    """
    usual = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if rows_per_piece is not None:
        partitions = max(usual, math.ceil(pieces * rows_per_piece / ROWS_PER_PIECE))
        if partitions < pieces:
            placed = rows.repartitionByRange(partitions, key, *order).sortWithinPartitions(key, *order)
            # The number of a row holds its partition above bit 33, so no piece spans two of them.
            numbered = placed.withColumn("piece", F.monotonically_increasing_id())
            return numbered.withColumn("piece", F.expr(f"piece div {int(rows_per_piece)}"))
    return rows.repartitionByRange(pieces, key, *order).withColumn("piece", F.spark_partition_id())

"""What several operators of this subpackage share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.scratch import scratch_dir

WORD = r"[^\x20\x09-\x0D]+"

#: Rows of one long each that may be broadcast: about 16 MB, a few times that as a hash table.
BROADCAST_ROWS = 1_000_000


def store(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage: a lost executor costs a reread, not the steps before.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The same rows, marked for broadcast where a count proves that they are few.

    For stored tables of one or two numbers a row; beyond the bound the join shuffles.
    """
    few = df.limit(rows + 1).count() <= rows
    return F.broadcast(df) if few else df


def same(left: Column, right: Column) -> Column:
    """Equality under which nulls match, usable as a join key."""
    return left.eqNullSafe(right)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as no column of `df` has it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
        taken.add(name.lower())
    return out

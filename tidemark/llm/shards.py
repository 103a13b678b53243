"""Sharding by histogram sort: splitters found by counting, then one exchange."""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import store

KEY = ["_hs_1", "_hs_2", "_hs_3"]  # compared in turn, each as an unsigned number
PROBES = 15  # between the ends of an open interval, per round
#: What one task sorts, as far as `MOST_RANGES` a shard allow: the driver holds a key for each.
RANGE_BYTES = 128 << 20
MOST_RANGES = 1000
_SIGN = -(2**63)


def unsigned_order(number: Column) -> Column:
    """A signed long moved so that its unsigned order is its signed order; null comes first."""
    return F.coalesce(number.cast("bigint"), F.lit(_SIGN)).bitwiseXOR(F.lit(_SIGN))


def _packed(frame: pd.DataFrame, names: list[str]) -> np.ndarray:
    """The three parts as 24 bytes whose byte order is the key's order."""
    parts = np.stack([frame[n].to_numpy(np.int64).view(np.uint64) for n in names], axis=1)
    return np.ascontiguousarray(parts.astype(">u8")).view("S24").ravel()


def _numbers(keys: np.ndarray) -> list[int]:
    return [int.from_bytes(k.ljust(24, b"\0"), "big") for k in keys]


def _keys(numbers: list[int]) -> np.ndarray:
    return np.array([n.to_bytes(24, "big") for n in numbers], dtype="S24")


def histogram(keyed: DataFrame, probes: np.ndarray) -> pd.DataFrame:
    """Exact bytes and rows between neighbouring probes, with the first and last key there.

    Bucket i holds the keys k with probes[i - 1] <= k < probes[i]. Each task counts its rows;
    one row per task and bucket is shuffled and one row per bucket reaches the driver.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            keys = _packed(batch, KEY)
            order = np.argsort(keys)
            keys, sizes = keys[order], batch["size"].to_numpy()[order]
            edges = np.searchsorted(keys, probes)  # keys below each probe
            starts = np.concatenate([[0], edges])
            ends = np.concatenate([edges, [len(keys)]])
            sums = np.concatenate([[0], np.cumsum(sizes)])
            full = np.flatnonzero(ends > starts)
            yield pd.DataFrame({
                "bucket": full, "bytes": sums[ends[full]] - sums[starts[full]], "rows": (ends - starts)[full],
                "first": [k.ljust(24, b"\0") for k in keys[starts[full]]],
                "last": [k.ljust(24, b"\0") for k in keys[ends[full] - 1]],
            })

    counted = keyed.select(*KEY, "size").mapInPandas(
        count, "bucket int, bytes long, rows long, first binary, last binary"
    )
    return counted.groupBy("bucket").agg(
        F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"),
        F.min("first").alias("first"), F.max("last").alias("last"),
    ).toPandas().sort_values("bucket")


def splitters(keyed: DataFrame, n: int, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """n - 1 keys that cut the rows into n ranges of near equal bytes, and the rows below each.

    Every round counts the bytes below a set of probes. A splitter whose target lies between
    two counted keys gets `PROBES` new probes evenly between the first and last key that
    stand there, until one is within `tolerance` of a range's bytes or no key is left between.
    Intervals shrink to keys that exist, so a run of equal leading parts costs one round.
    """
    known: dict[int, tuple[int, int]] = {}  # key -> bytes and rows below it
    total = None
    gaps: dict[int, tuple[int, int]] = {}  # interval (by its lower key) -> first and last key in it
    probes: list[int] = []
    while True:
        table = histogram(keyed, _keys(probes))
        if total is None:
            total = int(table["bytes"].sum())
            if not total:
                return _keys([]), np.zeros(0, np.int64)
        below_bytes = below_rows = 0
        rows = {int(r.bucket): r for r in table.itertuples()}
        gaps = {}
        for i in range(len(probes) + 1):
            if i:
                known[probes[i - 1]] = (below_bytes, below_rows)
            if i in rows:
                r = rows[i]
                first, last = (int.from_bytes(bytes(k), "big") for k in (r.first, r.last))
                known[first] = (below_bytes, below_rows)  # nothing between the probe and it
                gaps[first] = (first, last)
                below_bytes += int(r.bytes)
                below_rows += int(r.rows)
        known[last + 1] = (below_bytes, below_rows)
        keys = sorted(known)
        under = np.array([known[k][0] for k in keys])
        chosen, wanted = [], set()
        for i in range(1, n):
            target = total * i / n
            at = int(np.searchsorted(under, target))
            near = min((j for j in (at - 1, at) if 0 <= j < len(keys)), key=lambda j: abs(under[j] - target))
            chosen.append(keys[near])
            low = keys[max(at - 1, 0)]
            if abs(under[near] - target) > tolerance * total / n and low in gaps and gaps[low][1] > low:
                wanted.add(low)
        fresh = set()
        for low in wanted:
            first, last = gaps[low]
            step = max((last - first) // (PROBES + 1), 1)
            fresh |= {k for k in (first + j * step for j in range(1, PROBES + 1)) if k <= last} | {last}
        fresh -= known.keys()
        if not fresh:
            chosen = np.array(chosen, dtype=object)
            return _keys(list(chosen)), np.array([known[k][1] for k in chosen], np.int64)
        # Known edges around open intervals are probed again, so that their keys stay apart.
        places = [bisect_left(keys, low) for low in wanted]
        edges = {keys[j] for place in places for j in (place, place + 1) if j < len(keys)}
        probes = sorted(fresh | edges)


def histogram_sort(
    docs: DataFrame,
    n_shards: int = 24,
    tolerance: float = 0.01,
    ranges_per_shard: int | None = None,
) -> DataFrame:
    """`docs` with size, shard and slot: shards are ranges of a key, of near equal bytes.

    Size is the UTF-8 bytes of the text (null: none) plus 8. The key is (hash of the text,
    doc_id, hash of the row), so equal texts stand together and yet any group of copies can be
    cut. Splitters come from `splitters` over a stored table of keys and sizes; then the rows
    are exchanged once, by range. A shard is made of several ranges, each sorted by a task of
    its own; the exact counts below their edges give the slots, gapless from 0 in a shard.

    A single document larger than the tolerance stays whole. Null texts and ids are keys like
    others; rows repeated whole are interchangeable; an empty table gives no rows; columns
    of `docs` are kept, but for ones named like the three added or starting with `_hs_`.
    """
    own = [c for c in docs.columns if c.lower() not in ("size", "shard", "slot") and not c.lower().startswith("_hs_")]
    rows = docs.select(
        *own,
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 8).alias("size"),
        F.xxhash64("text").alias(KEY[0]), unsigned_order(F.col("doc_id")).alias(KEY[1]),
        F.xxhash64(*own).alias(KEY[2]),
    )
    keyed = store(rows.select(*KEY, "size"), "keys")
    spark = docs.sparkSession
    total = keyed.agg(F.sum("size")).first()[0] or 0
    by_tasks = 2 * int(spark.conf.get("spark.sql.shuffle.partitions")) / n_shards
    per = ranges_per_shard or min(MOST_RANGES, math.ceil(max(4, by_tasks, total / n_shards / RANGE_BYTES)))
    cuts, below = splitters(keyed, n_shards * per, tolerance)
    return _exchange(rows, cuts, below, n_shards, per)


def _exchange(rows: DataFrame, cuts: np.ndarray, below: np.ndarray, n_shards: int, per: int) -> DataFrame:
    starts = np.concatenate([[0], below])
    names = [c for c in rows.columns if c not in KEY]

    # Rows before a range in its shard, from the counts.
    offsets = starts - starts[(np.arange(len(starts)) // per) * per]

    def place(k1: pd.Series, k2: pd.Series, k3: pd.Series) -> pd.DataFrame:
        keys = _packed(pd.DataFrame(dict(zip(KEY, (k1, k2, k3), strict=True))), KEY)
        at = np.searchsorted(cuts, keys, side="right")
        return pd.DataFrame({"range": at.astype(np.int32), "offset": offsets[at]})

    placed = rows.withColumn("_hs_place", F.pandas_udf(place, "range int, offset long")(*KEY))
    placed = placed.withColumn("_hs_range", F.col("_hs_place.range")).withColumn("_hs_offset", F.col("_hs_place.offset"))
    unsigned = [F.col(k).bitwiseXOR(F.lit(_SIGN)) for k in KEY]
    place_in = F.row_number().over(W.partitionBy("_hs_range").orderBy(*unsigned)) - 1
    return placed.select(
        *names, F.floor(F.col("_hs_range") / per).cast("int").alias("shard"),
        (F.col("_hs_offset") + place_in).cast("bigint").alias("slot"),
    )

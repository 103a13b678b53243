"""Whitening of embeddings along the leading principal components."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import store
from tidemark.llm.contour import leading_pairs

STEPS = 64  # whole numbers per unit of an entry
ORIGIN = 1_000_000
LARGEST = 2.0**46  # entries of this size and more, whose products with STEPS leave the exact doubles
SMALLEST_SHARE = 1e-12  # of the total variance; components below are rounding errors


@dataclass
class Whitening:
    """A fitted whitening: n distinct vectors, their exact sums, and components by falling eigenvalue."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    directions: np.ndarray  # one column a component, divided by the root of its eigenvalue
    explained: np.ndarray
    identity_error: float

    @property
    def centre(self) -> np.ndarray:
        """Per dimension the whole number next to the mean: subtracting it loses nothing."""
        return np.array([round(Fraction(s, self.n)) for s in self.sums], np.int64)

    @property
    def offset(self) -> np.ndarray:
        """Mean minus centre."""
        return np.array([float(Fraction(s, self.n) - int(c)) for s, c in zip(self.sums, self.centre, strict=True)])


def _whole(batch: pa.RecordBatch, at: int, dims: int | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and their x vectors, of the rows whose vector is whole, by vector length.

    With `dims` only vectors of that length.
    """
    column = batch.column(at)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.where(column.is_null().to_numpy(zero_copy_only=False), -1, column.value_lengths().fill_null(-1).to_numpy())
    flat = column.flatten()
    values = np.asarray(flat.cast(pa.float64()).to_numpy(zero_copy_only=False), np.float64)  # null entries become nan
    starts = np.concatenate([[0], np.cumsum(np.maximum(lengths, 0))])[:-1]
    for length in [dims] if dims is not None else np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == length)
        found = values[starts[rows][:, None] + np.arange(length)]
        good = (np.abs(found) < LARGEST).all(axis=1)  # false for nan, too
        yield rows[good], np.floor(found[good] * STEPS).astype(np.int64) + ORIGIN


def _packed(x: np.ndarray) -> list[bytes]:
    """Vectors as bytes: four a number where all numbers of the vector allow it, else eight."""
    narrow = (np.abs(x) < 2**31).all(axis=1)
    return [(row.astype("<i4") if small else row.astype("<i8")).tobytes() for row, small in zip(x, narrow, strict=True)]


def fit_list(embeddings: DataFrame, column: str = "embedding") -> DataFrame:
    """Each distinct x vector once, as bytes, with its number of dimensions.

    Copies meet within the tasks first, so any number of them costs a row a task.
    """

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in _whole(batch, 0, None):
                dims = pa.array(np.full(len(x), x.shape[1], np.int32))
                yield pa.RecordBatch.from_arrays([dims, pa.array(_packed(x), pa.binary())], ["dims", "x"])

    found = embeddings.select(column).mapInArrow(vectors, "dims int, x binary")
    return store(found.distinct(), "fit-list")


def _unpacked(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    out = np.empty((batch.num_rows, dims), np.int64)
    for i, raw in enumerate(batch.column(0).to_pylist()):
        out[i] = np.frombuffer(raw, "<i4" if len(raw) == 4 * dims else "<i8")
    return out


def _summed(vectors: DataFrame, dims: int, width: int, partial) -> np.ndarray:
    """Sum over all vectors of `partial(x)`, an array of `width` numbers of a batch of them.

    Each task sends one row a number; numbers are added up by Spark, and as many as `width` reach the driver.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = partial(_unpacked(batch, dims))
                total = own if total is None else total + own
        if total is not None:
            at = pa.array(np.arange(width, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([at, pa.array(total)], ["at", "value"])

    probe = partial(np.zeros((0, dims), np.int64))
    kind = "long" if probe.dtype.kind == "i" else "double"
    rows = vectors.select("x").mapInArrow(add, f"at int, value {kind}")
    found = rows.groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(width, probe.dtype)
    out[found["at"].to_numpy()] = found["value"].to_numpy()
    return out


def fit(embeddings: DataFrame, k: int = 16, column: str = "embedding") -> Whitening | None:
    """The k leading components of the distinct x vectors, None where there is no vector.

    An entry c becomes x = floor(STEPS * c) + ORIGIN. Rows whose vector is null or empty, or holds null, non-finite
    or too large entries (LARGEST) are left out; vectors of another length than most distinct ones have
    (the longer of equally many) are, too. Sums are exact, products are taken of numbers centred before,
    whose sum over all vectors is a matrix of dims x dims on the driver. There, and nothing of the
    rows, `contour.leading_pairs` finds the components; ones without variance are left out, so there may be fewer than k.
    """
    vectors = fit_list(embeddings, column)
    sizes = vectors.groupBy("dims").count().collect()  # as many rows as lengths occur
    if not sizes:
        return None
    n, dims = max((r["count"], r["dims"]) for r in sizes)
    vectors = vectors.filter(F.col("dims") == dims)

    # High and low halves, so that no sum leaves the longs.
    halves = _summed(vectors, dims, 2 * dims, lambda x: np.concatenate([(x >> 32).sum(0), (x & (2**32 - 1)).sum(0)]))
    sums = [(int(high) << 32) + int(low) for high, low in zip(halves[:dims], halves[dims:], strict=True)]
    model = Whitening(n, sums, np.zeros(0), np.zeros((dims, 0)), np.zeros(0), 0.0)
    centre, offset = model.centre, model.offset

    upper = np.triu_indices(dims)

    def products(x: np.ndarray) -> np.ndarray:
        d = (x - centre).astype(np.float64)
        return (d.T @ d)[upper]

    covariance = np.zeros((dims, dims))
    covariance[upper] = _summed(vectors, dims, len(upper[0]), products) / n
    covariance = covariance + np.triu(covariance, 1).T - np.outer(offset, offset)
    total = float(np.trace(covariance))
    values, directions = leading_pairs(covariance, min(k, dims))
    kept = np.flatnonzero(values > SMALLEST_SHARE * total)[:k]
    model.eigenvalues, model.explained = values[kept], values[kept] / total if total else values[kept]
    model.directions = directions[:, kept] / np.sqrt(values[kept])
    model.identity_error = _identity_error(vectors, model)
    return model


def _identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, measured."""
    dims, k = model.directions.shape
    centre, offset, directions = model.centre, model.offset, model.directions
    if not k:
        return 0.0

    def moments(x: np.ndarray) -> np.ndarray:
        white = (x - centre - offset) @ directions
        return np.concatenate([white.sum(0), (white.T @ white).ravel()])

    found = _summed(vectors, dims, k + k * k, moments) / model.n
    mean = found[:k]
    return float(np.abs(found[k:].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def _deviations(x: np.ndarray, model: Whitening) -> list[int | None]:
    """Sum over dimensions of (n * x - S)^2, exact; None where it is no long."""
    reach = model.n * float(np.abs(x - model.centre).max(initial=0) + 1)
    if x.shape[1] * reach**2 < 2**62:
        rest = np.array([model.n * int(c) - s for c, s in zip(model.centre, model.sums, strict=True)], np.int64)
        d = model.n * (x - model.centre) + rest
        return (d * d).sum(axis=1).tolist()
    exact = [sum((model.n * v - s) ** 2 for v, s in zip(row, model.sums, strict=True)) for row in x.tolist()]
    return [v if v < 2**63 else None for v in exact]


def whiten(embeddings: DataFrame, model: Whitening, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """`key`, deviation and whitened (one number a component) of every row with a whole vector.

    Keys may be null or repeated, each row gives one; rows that `fit` leaves out give none, other columns are
    left out. The deviation is null where it doesn't fit a long (from 10^16 or so vectors times squared spread).
    """
    dims, k = model.directions.shape
    centre, offset, directions = model.centre, model.offset, model.directions

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _whole(batch, 1, dims):
                white = (x - centre - offset) @ directions
                ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * k)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows)),
                        pa.array(_deviations(x, model), pa.int64()),
                        pa.ListArray.from_arrays(ends, pa.array(white.ravel())),
                    ],
                    [key, "deviation", "whitened"],
                )

    kind = embeddings.schema[key].dataType.simpleString()
    return embeddings.select(key, column).mapInArrow(project, f"{key} {kind}, deviation long, whitened array<double>")


def components(embeddings: DataFrame, k: int = 16, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """`fit` and `whiten` in one, a row per vector and component (numbered from 1)."""
    model = fit(embeddings, k, column)
    kind = embeddings.schema[key].dataType.simpleString()
    if model is None:
        schema = f"{key} {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return embeddings.sparkSession.createDataFrame([], schema)
    explained = F.array(*[F.lit(float(v)) for v in model.explained]).cast("array<double>")
    rows = whiten(embeddings, model, key, column).select(key, "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return rows.select(
        key, (F.col("place") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("place")).alias("explained"), F.lit(model.identity_error).alias("identity_error"),
    )

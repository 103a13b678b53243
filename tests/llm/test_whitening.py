"""Whitening against exact sums and numpy's own eigenvectors."""

from __future__ import annotations

import numpy as np
import pytest

from tidemark.llm import contour, whitening
from tidemark.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"
SPECTRA = {
    "spread": np.random.default_rng(0).uniform(0.1, 10, 40),
    "geometric": 2.0 ** -np.arange(40),
    "equal": np.ones(20),
    "groups": np.repeat([5.0, 3, 3, 1], 10),
    "one": np.array([2.0]),
    "rank five": np.r_[1.0, 2, 3, 4, 5, np.zeros(30)],
    "close": 1 + 1e-7 * np.arange(40),
    "spike": np.r_[1e6, np.random.default_rng(1).uniform(0.5, 1, 39)],
    "two close spikes": np.r_[1e6, 1e6 * (1 - 1e-13), np.linspace(0.5, 1, 38)],
}


@pytest.mark.parametrize("name", SPECTRA)
def test_leading_pairs(name):
    wanted = np.sort(SPECTRA[name])[::-1]
    n = len(wanted)
    q, _ = np.linalg.qr(np.random.default_rng(2).standard_normal((n, n)))
    matrix = (q * wanted) @ q.T
    matrix = (matrix + matrix.T) / 2
    values, vectors = contour.leading_pairs(matrix, 16)
    k = min(16, n)
    assert len(values) >= k and np.abs(values - wanted[: len(values)]).max() <= 1e-13 * wanted[0]
    assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-12 * wanted[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() <= 1e-13
    for shift in np.random.default_rng(3).uniform(wanted[-1] - 0.1, wanted[0] + 0.1, 30):
        if np.abs(wanted - shift).min() > 1e-9 * wanted[0]:
            assert contour.count_below(matrix, shift) == (wanted < shift).sum()


def test_nothing_varies():
    values, vectors = contour.leading_pairs(np.zeros((3, 3)), 2)
    assert (values == 0).all() and (vectors == np.eye(3)).all()


def rows(n=300, dims=20, shift=0.0):
    r = np.random.default_rng(4)
    mix = r.standard_normal((dims, dims))
    return [(int(2**53 + 1 + i), [float(np.float32(v)) for v in row], 1) for i, row in enumerate(r.standard_normal((n, dims)) @ mix + shift)]


def expected(vectors):
    x = np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    values, directions = np.linalg.eigh(np.cov((fit - 1_000_000).T, bias=True))
    return x, n, sums, values[::-1], directions[:, ::-1]


@pytest.mark.parametrize("shift", [0.0, 30_000.0])
def test_query(spark, tmp_path, shift):
    good = rows(shift=shift)
    bad = [(1, None, 0), (2, [], 0), (3, [1.0] * 19 + [None], 0), (4, [float("nan")] * 20, 0), (5, [float("inf")] + [0.0] * 19, 0), (6, [1.0] * 7, 0)]
    table = good + [good[0], (None, good[1][1], None)] + bad
    spark.createDataFrame(table, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = QUERIES["op12_contour_whitening"](spark, str(tmp_path)).collect()
    x, n, sums, values, directions = expected([v for _, v, _ in good])
    assert len(got) == 16 * (len(good) + 2)
    assert {r.n for r in got} == {n} and {r.component for r in got} == set(range(1, 17))
    place = {i: k for k, (i, _, _) in enumerate(good)} | {None: 1}
    white = (x - sums / n) @ directions / np.sqrt(values)
    signs = {}
    for r in got:
        own, c = place[r.vec_id], r.component - 1
        assert r.deviation == sum((n * int(v) - int(s)) ** 2 for v, s in zip(x[own], sums))
        sign = signs.setdefault(c, np.sign(r.whitened * white[own, c]))
        assert abs(r.whitened - sign * white[own, c]) < 1e-6
        assert abs(r.explained - values[c] / values.sum()) < 1e-10 and r.identity_error < 1e-9


def test_few_dimensions_and_no_variance(spark):
    frame = lambda data: spark.createDataFrame(data, SCHEMA)
    line = frame([(1, [0.0, 1.0], 0), (2, [1.0, 2.0], 0), (3, [2.0, 3.0], 0)])
    got = whitening.components(line).collect()
    assert sorted((r.vec_id, r.component) for r in got) == [(1, 1), (2, 1), (3, 1)]
    assert all(abs(r.explained - 1) < 1e-12 for r in got)
    assert whitening.components(frame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)])).collect() == []
    assert whitening.components(frame([])).collect() == []
    assert whitening.components(frame([(1, None, 0), (2, [float("nan")], 0)])).collect() == []


def test_deviation_beyond_a_long_is_null():
    model = whitening.Whitening(10**9, [0, 0], np.ones(1), np.ones((2, 1)), np.ones(1), 0.0)
    assert whitening._deviations(np.array([[1, 2], [10, 0]]), model) == [5 * 10**18, None]

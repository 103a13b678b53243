"""The leading eigenpairs of a symmetric matrix by contour integration (FEAST).

The matrix is a covariance, as large as a vector's length; nothing here grows with the rows.
"""

from __future__ import annotations

import numpy as np

NODES = 16  # quadrature nodes on the upper half of a contour
PER_INTERVAL = 8  # eigenvalues that one contour is meant to hold
TOLERANCE = 1e-14  # of a residual, against the matrix's norm
MOST_ROUNDS = 40
SPAN = 0.3  # by which an interval's upper end is brought down at a time; its lower end is at least SPAN^2 of it
FLOOR = 1e-13  # eigenvalues below this share of the norm are rounding errors, and make one interval


class NotConverged(ArithmeticError):
    pass


def count_below(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues below `shift`: the negative pivots of matrix - shift, by Sylvester's law of inertia.

    Symmetric elimination takes 1x1 or 2x2 pivots, whichever keeps the growth bounded (Bunch-Kaufman's rule).
    """
    a = matrix - shift * np.eye(len(matrix))
    tiny = np.finfo(float).eps * max(np.abs(matrix).max(), abs(shift), 1e-300)
    alpha, negative = (1 + 17**0.5) / 8, 0
    while len(a):
        column = np.abs(a[1:, 0])
        largest = column.max(initial=0.0)
        size = 1
        if abs(a[0, 0]) < alpha * largest:
            r = 1 + int(column.argmax())
            row = np.abs(a[r]).copy()
            row[r] = 0
            if abs(a[0, 0]) * row.max() < alpha * largest**2:
                size = 1 if abs(a[r, r]) >= alpha * row.max() else 2
                to = 0 if size == 1 else 1
                a[[to, r]] = a[[r, to]]
                a[:, [to, r]] = a[:, [r, to]]
        pivot = a[:size, :size]
        if size == 1:
            value = pivot[0, 0] if abs(pivot[0, 0]) > tiny else tiny
            negative += value < 0
            a = a[1:, 1:] - np.outer(a[1:, 0], a[1:, 0]) / value
        else:
            negative += 1  # a 2x2 pivot of this rule has one negative and one positive eigenvalue
            a = a[2:, 2:] - a[2:, :2] @ np.linalg.solve(pivot, a[:2, 2:])
    return int(negative)


def _edge(matrix: np.ndarray, below: int, low: float, high: float) -> tuple[float, int]:
    """A shift between `low` and `high` with `below` eigenvalues below it, and that number.

    Equal eigenvalues can't be parted: bisection then ends beneath them, with fewer below.
    """
    at = low
    while high - low > 1e-9:
        at = (low + high) / 2
        found = count_below(matrix, at)
        if found == below:
            break
        low, high = (at, high) if found < below else (low, at)
    else:
        at, below = low, count_below(matrix, low)

    def room(side: int) -> float:
        """How far the gap reaches on a side, to a factor of two."""
        step = 1e-12
        while step < 1 and count_below(matrix, at + side * 2 * step) == below:
            step *= 2
        return step

    # Well inside the gap, so that no eigenvalue stands next to the contour.
    return at + (room(1) - room(-1)) / 2, below


def interval_pairs(matrix: np.ndarray, low: float, high: float, expected: int) -> tuple[np.ndarray, np.ndarray]:
    """The `expected` eigenpairs with low <= eigenvalue < high, as inertia counted them.

    A block of vectors is projected onto the interval's eigenspace by Gauss-Legendre quadrature of the
    resolvent along a circle around it (by symmetry its upper half), one complex shifted solve a node.
    Rayleigh-Ritz on the projected block gives pairs; they serve as the next block until each pair
    inside has a residual of rounding size and none is missed.
    """
    n = len(matrix)
    centre, radius = (low + high) / 2, (high - low) / 2
    width = min(n, 2 * expected + 8)
    angles, weights = np.polynomial.legendre.leggauss(NODES)
    angles = np.pi / 2 * (1 - angles)
    nodes = centre + radius * np.exp(1j * angles)
    eye = np.eye(n)
    block = np.random.default_rng(1).standard_normal((n, width))
    norm = np.abs(matrix).sum(axis=1).max()
    best = np.inf
    for _ in range(MOST_ROUNDS):
        projected = np.zeros((n, width))
        for z, angle, weight in zip(nodes, angles, weights, strict=True):
            solved = np.linalg.solve(z * eye - matrix, block)
            projected += weight / 2 * np.real(radius * np.exp(1j * angle) * solved)
        basis, _ = np.linalg.qr(projected)
        basis, _ = np.linalg.qr(basis)  # once more, as the projected vectors can be nearly dependent
        small = basis.T @ matrix @ basis
        values, turns = np.linalg.eigh((small + small.T) / 2)
        vectors = basis @ turns
        inside = (values >= low) & (values < high)
        if inside.sum() >= expected:
            residuals = np.linalg.norm(matrix @ vectors - vectors * values, axis=0) / norm
            # Ritz values that stray into the interval without being eigenvalues have large residuals.
            chosen = np.flatnonzero(inside)[np.argsort(residuals[inside], kind="stable")[:expected]]
            worst = residuals[chosen].max()
            if worst <= TOLERANCE or best <= 100 * TOLERANCE and worst >= best / 2:
                return values[chosen], vectors[:, chosen]
            best = min(best, worst)
        block = vectors
    raise NotConverged(f"interval {low} to {high}: {int(inside.sum())} of {expected} eigenvalues, residual {best:.1e}")


def leading_pairs(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """At least the k largest eigenvalues of a symmetric positive semidefinite matrix, falling, with their vectors.

    The spectrum is cut from above into intervals of about PER_INTERVAL eigenvalues by counting inertia; each is solved
    by itself. Ends when the k largest are found; a group of equal ones at the end is found whole. Each interval's
    count has been checked, so no eigenvalue between the top and the last edge is missing.
    """
    n = len(matrix)
    scale = np.abs(matrix).sum(axis=1).max()
    if not scale:
        return np.zeros(n), np.eye(n)
    a = matrix / scale  # spectrum within [0, 1]
    top, values, vectors = 1.0 + 1e-9, [], []
    above = 0
    while above < min(k, n):
        # Come down to the next eigenvalue; an interval spans less than a factor of ten, as a contour that
        # is much wider than the gap at its end can't tell the eigenvalues there apart.
        while top > FLOOR and count_below(a, SPAN * top) == n - above:
            top *= SPAN
        wanted = min(above + PER_INTERVAL, n)
        low, below = _edge(a, n - wanted, -2 * FLOOR, top) if wanted < n else (-2 * FLOOR, 0)
        if top > FLOOR and low < SPAN**2 * top:
            low, below = _edge(a, count_below(a, SPAN**2 * top), -2 * FLOOR, top)
        found, own = interval_pairs(a, low, top, n - below - above)
        values.append(found)
        vectors.append(own)
        top, above = low, n - below
    # All together once more, so that vectors of neighbouring intervals are orthogonal to rounding.
    basis, _ = np.linalg.qr(np.concatenate(vectors, axis=1))
    small = basis.T @ a @ basis
    ritz, turns = np.linalg.eigh((small + small.T) / 2)
    return ritz[::-1] * scale, (basis @ turns)[:, ::-1]

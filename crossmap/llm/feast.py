"""Eigenpairs of a symmetric matrix from the top of its spectrum, by contour integration.

Inertia counts (signs of the pivots of T - s for the tridiagonal form T) say how many
eigenvalues lie above any s, and so where gaps are. An interval that begins in a gap
is enclosed by a circle; a quadrature of the solutions of (z - A) Q = Y along it
projects Y onto the eigenvectors inside; Rayleigh-Ritz on the projected space gives
the pairs, which are projected again until their residuals no longer shrink. The number of
pairs found has to equal the inertia count; if it does not, the space is widened.
"""

from __future__ import annotations

import numpy as np

#: Quadrature nodes on the upper half of a contour (the lower half follows by symmetry).
NODES = 8
#: Projections at most, and further eigenvalues among which a gap for the edge of an interval is looked for.
ROUNDS, LOOKED = 30, 8
#: Eigenvalues in one interval, unless more of them have no gap between them, and the least gap as a share of the spectrum.
INSIDE, GAP = 12, 1e-6


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and squared side diagonal of an orthogonally similar tridiagonal matrix."""
    a = a.copy()
    n = len(a)
    side = np.zeros(max(0, n - 1))
    for i in range(n - 1):
        x = a[i + 1:, i].copy()
        size = np.linalg.norm(x)
        side[i] = size
        if size == 0 or i == n - 2:
            continue
        x[0] += np.copysign(size, x[0])
        x /= np.linalg.norm(x)
        below = a[i + 1:, i + 1:]
        p = below @ x
        q = 2 * (p - x * (x @ p))
        below -= np.outer(x, q) + np.outer(q, x)
    return np.diagonal(a).copy(), side**2


def above(diagonal: np.ndarray, squares: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie above each shift: the positive pivots of the shifted matrix."""
    tiny = np.finfo(float).tiny * max(1.0, squares.max(initial=0.0)) / np.finfo(float).eps
    pivot = diagonal[0] - shifts
    count = np.zeros(len(shifts), np.int64)
    for i in range(len(diagonal)):
        if i:
            pivot = diagonal[i] - shifts - squares[i - 1] / pivot
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        count += pivot > 0
    return count


def brackets(diagonal: np.ndarray, squares: np.ndarray, k: int, low: float, high: float, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the k greatest eigenvalues, by bisection on inertia counts."""
    lower, upper = np.full(k, low), np.full(k, high)
    for _ in range(rounds):
        middle = (lower + upper) / 2
        inside = above(diagonal, squares, middle) > np.arange(k)
        lower, upper = np.where(inside, middle, lower), np.where(inside, upper, middle)
    return lower, upper


def intervals(lower: np.ndarray, upper: np.ndarray, k: int, bottom: float, top: float) -> list[tuple[float, float, int]]:
    """Intervals (low, high, eigenvalues inside) from the top down that begin in gaps and hold the k greatest.

    lower and upper bound all eigenvalues. The widest of the next gaps is taken, or the next one at all behind a cluster.
    """
    gaps = np.append(lower[:-1] - upper[1:], lower[-1] - bottom)
    found, start, high = [], 0, top
    while start < k:
        first = min(k, start + INSIDE)
        near = np.arange(first, min(len(lower), first + LOOKED) + 1)
        wide = np.flatnonzero(gaps[first - 1:] > GAP * top) + first
        choice = int(near[gaps[near - 1].argmax()]) if wide[0] in near else int(wide[0])
        low = bottom if choice == len(lower) else (lower[choice - 1] + upper[choice]) / 2
        found.append((low, high, choice - start))
        start, high = choice, low
    return found


def projected(a: np.ndarray, start: np.ndarray, low: float, high: float) -> np.ndarray:
    """The quadrature of the solutions of (z - a) q = start along a circle around [low, high]."""
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    centre, radius = (low + high) / 2, (high - low) / 2
    out = np.zeros_like(start)
    for node, weight in zip(nodes, weights):
        turn = np.exp(1j * np.pi / 2 * (1 - node))
        solved = np.linalg.solve((centre + radius * turn) * np.eye(len(a)) - a, start.astype(complex))
        out += weight / 2 * (radius * turn * solved).real
    return out


def eigenpairs(a: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The eigenpairs between low and high, which are `count` many, the greatest first."""
    n = len(a)
    size = np.linalg.norm(a, np.inf)
    width = min(n, 2 * count + 8)
    while True:
        space = np.random.default_rng(0).standard_normal((n, width))
        best, least = None, np.inf
        for _ in range(ROUNDS):
            basis, _ = np.linalg.qr(projected(a, space, low, high))
            reduced = basis.T @ a @ basis
            values, turned = np.linalg.eigh((reduced + reduced.T) / 2)
            space = basis @ turned
            within = np.flatnonzero((values > low) & (values <= high))[::-1]
            if len(within) != count:
                continue
            residual = np.linalg.norm(a @ space[:, within] - space[:, within] * values[within], axis=0).max()
            if residual >= least / 2:
                break
            best, least = (values[within], space[:, within]), residual
        if best is not None and least <= 1e-11 * size:
            return best
        if width == n:
            raise ArithmeticError(f"inertia counts {count} eigenvalues between {low} and {high}, which projection did not find")
        width = min(n, 2 * width)


def greatest(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k greatest eigenvalues of a positive semidefinite matrix, falling, and their unit eigenvectors as columns.

    The greatest entry of each vector is positive. Eigenvalues that are equal share any basis of their space.
    """
    n = len(a)
    k = min(k, n)
    size = float(np.linalg.norm(a, np.inf)) if n else 0.0
    if k == 0 or size == 0:
        return np.zeros(k), np.eye(n)[:, :k]
    diagonal, squares = tridiagonal(a)
    bottom, top = -size * 1e-3, size * (1 + 1e-3)
    lower, upper = brackets(diagonal, squares, n, bottom, top)
    pairs = [eigenpairs(a, *found) for found in intervals(lower, upper, k, bottom, top)]
    values, vectors = np.concatenate([x for x, _ in pairs])[:k], np.concatenate([x for _, x in pairs], axis=1)[:, :k]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(k)])
    return values, vectors * signs / np.linalg.norm(vectors, axis=0)

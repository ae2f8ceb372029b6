"""Leading eigenpairs of a symmetric matrix: Householder tridiagonalisation, Sturm counts, inverse iteration.

The matrix is as wide as a vector has entries, whatever the number of vectors,
so this small part runs on the driver; everything that grows with the input is
in :mod:`.whitening`.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)
TINY = float(np.finfo(float).tiny)


def tridiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, off-diagonal, Q) with ``matrix = Q T Q'``, by one reflection a column."""
    a = np.array(matrix, float)
    n = len(a)
    q = np.eye(n)
    for k in range(n - 2):
        v = a[k + 1:, k].copy()
        scale = np.abs(v).max()
        if scale == 0 or not np.abs(v[1:]).any():
            continue
        v /= scale
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        v /= np.linalg.norm(v)
        # the reflection H = I - 2vv' from both sides, kept symmetric
        below = a[k + 1:, k + 1:]
        p = below @ v
        w = 2 * (p - (v @ p) * v)
        below -= np.outer(v, w) + np.outer(w, v)
        column = a[k + 1:, k] - 2 * v * (v @ a[k + 1:, k])
        a[k + 1:, k] = a[k, k + 1:] = column
        q[:, k + 1:] -= 2 * np.outer(q[:, k + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), q


def below(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Sturm count: how many eigenvalues lie below each shift."""
    least = max(TINY, EPS * EPS * float(np.max(off * off, initial=0)))
    pivot = diagonal[0] - shifts
    count = (pivot < 0).astype(int)
    for d, e in zip(diagonal[1:], off):
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        pivot = d - shifts - e * e / pivot
        count += pivot < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, each bisected until its interval holds no further double."""
    n = len(diagonal)
    radius = np.abs(np.concatenate([off, [0]])) + np.abs(np.concatenate([[0], off]))
    span = EPS * n * float(np.max(np.abs(diagonal) + radius)) + TINY
    low, high = np.full(k, float((diagonal - radius).min()) - span), np.full(k, float((diagonal + radius).max()) + span)
    rank = n - np.arange(k)  # the j-th largest has n - j at or below it
    for _ in range(2200):
        mid = low + (high - low) / 2
        if ((mid <= low) | (mid >= high)).all():
            break
        under = below(diagonal, off, mid) >= rank
        high, low = np.where(under, mid, high), np.where(under, low, mid)
    return low + (high - low) / 2


def _solver(diagonal: np.ndarray, off: np.ndarray, value: float, least: float):
    """Solves (T - value) x = b: elimination with row exchanges; vanishing pivots become ``least``."""
    n = len(diagonal)
    u0, u1, u2 = np.empty(n), np.zeros(n), np.zeros(n)
    factor, swapped = np.empty(max(n - 1, 0)), np.zeros(max(n - 1, 0), bool)
    p0, p1 = diagonal[0] - value, off[0] if n > 1 else 0.0
    for i in range(n - 1):
        r0, r1, r2 = off[i], diagonal[i + 1] - value, off[i + 1] if i + 2 < n else 0.0
        if abs(r0) > abs(p0):
            swapped[i] = True
            factor[i] = p0 / r0
            u0[i], u1[i], u2[i] = r0, r1, r2
            p0, p1 = p1 - factor[i] * r1, -factor[i] * r2
        else:
            p0 = p0 if abs(p0) > least else least
            factor[i] = r0 / p0
            u0[i], u1[i], u2[i] = p0, p1, 0.0
            p0, p1 = r1 - factor[i] * p1, r2
    u0[n - 1] = p0 if abs(p0) > least else least

    def solve(b: np.ndarray) -> np.ndarray:
        x = b.copy()
        for i in range(n - 1):
            if swapped[i]:
                x[i], x[i + 1] = x[i + 1], x[i]
            x[i + 1] -= factor[i] * x[i]
        for i in range(n - 1, -1, -1):
            if i + 1 < n:
                x[i] -= u1[i] * x[i + 1]
            if i + 2 < n:
                x[i] -= u2[i] * x[i + 2]
            x[i] /= u0[i]
            if abs(x[i]) > 1e150:  # only the direction counts
                x /= abs(x[i])
        return x

    return solve


def leading_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of T as columns, by inverse iteration.

    Values closer than a thousandth of the norm form a cluster; each vector is
    made orthogonal to those before it in its cluster, in every iteration."""
    n = len(diagonal)
    norm = float(np.max(np.abs(diagonal))) + 2 * float(np.max(np.abs(off), initial=0)) or 1.0
    diagonal, off, values = diagonal / norm, off / norm, values / norm
    out, start, last = np.empty((n, len(values))), 0, None
    random = np.random.default_rng(n)
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3:
            start = j
        shift = value if last is None or last - value > 10 * EPS else last - 10 * EPS
        last = shift
        solve = _solver(diagonal, off, shift, EPS)
        x = random.uniform(-1, 1, n)
        near = out[:, start:j]
        for _ in range(5):
            x /= np.abs(x).max()
            x = solve(x)
            x /= np.abs(x).max()
            for _ in range(2):
                x -= near @ (near.T @ x)
            x /= np.linalg.norm(x)
        out[:, j] = x
    return out


def leading_pairs(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and unit eigenvectors as columns; each one's largest entry is positive."""
    diagonal, off, q = tridiagonalise(matrix)
    values = leading_values(diagonal, off, min(k, len(diagonal)))
    vectors = q @ leading_vectors(diagonal, off, values)
    vectors /= np.linalg.norm(vectors, axis=0)
    largest = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.where(vectors[largest, np.arange(len(values))] < 0, -1, 1)

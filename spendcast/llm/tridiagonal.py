"""Leading eigenvectors of a symmetric matrix: reflections to tridiagonal form, bisection, inverse iteration."""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)


def tridiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Householder reflections Q with Q^T A Q tridiagonal: (diagonal, off-diagonal, Q)."""
    a = np.array(matrix, float)
    n = len(a)
    q = np.eye(n)
    for k in range(n - 2):
        x = a[k + 1 :, k]
        scale = np.abs(x).max()
        if scale == 0 or not np.any(x[1:]):
            continue
        v = x / scale
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        v /= np.linalg.norm(v)
        part = a[k + 1 :, k + 1 :]
        p = part @ v
        w = 2 * (p - (v @ p) * v)
        part -= np.outer(v, w) + np.outer(w, v)
        column = a[k + 1 :, k] - 2 * v * (v @ a[k + 1 :, k])
        a[k + 1 :, k] = a[k, k + 1 :] = column
        q[:, k + 1 :] -= 2 * np.outer(q[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), q


def below(d: np.ndarray, e: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues of the tridiagonal matrix lie below each point."""
    square = e * e
    least = max(EPS * EPS * float(np.max(square, initial=0.0)), np.finfo(float).tiny)
    count = np.zeros(len(points), int)
    pivot = np.ones(len(points))
    for i in range(len(d)):
        pivot = d[i] - points - (square[i - 1] / pivot if i else 0.0)
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        count += pivot < 0
    return count


def leading_values(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, by bisection of all intervals at once."""
    n = len(d)
    reach = np.r_[0.0, np.abs(e)] + np.r_[np.abs(e), 0.0]
    low, high = float((d - reach).min()), float((d + reach).max())
    slack = 2 * EPS * n * max(abs(low), abs(high), np.finfo(float).tiny)
    lows, highs = np.full(k, low - slack), np.full(k, high + slack)
    order = n - 1 - np.arange(k)  # so many eigenvalues are smaller
    for _ in range(2100):  # from the widest interval of doubles to the narrowest
        middle = lows + (highs - lows) / 2
        if np.all((middle <= lows) | (middle >= highs)):
            break
        many = below(d, e, middle) > order
        lows, highs = np.where(many, lows, middle), np.where(many, middle, highs)
    return lows + (highs - lows) / 2


def solve_shifted(d: np.ndarray, e: np.ndarray, shift: float, rhs: np.ndarray, least: float) -> np.ndarray:
    """Solve (T - shift) x = rhs by elimination with row exchanges; tiny pivots are raised to ``least``."""
    n = len(d)
    main, upper, far, x = d - shift, np.r_[e, 0.0], np.zeros(n), rhs.copy()
    for i in range(n - 1):
        low, next_main, next_upper = e[i], main[i + 1], upper[i + 1]
        if abs(low) > abs(main[i]):
            factor = main[i] / low
            main[i], upper[i + 1], far[i] = low, -factor * next_upper, next_upper
            main[i + 1], upper[i] = upper[i] - factor * next_main, next_main
            x[i], x[i + 1] = x[i + 1], x[i] - factor * x[i + 1]
        else:
            if abs(main[i]) < least:
                main[i] = least
            factor = low / main[i]
            main[i + 1] = next_main - factor * upper[i]
            x[i + 1] -= factor * x[i]
    for i in range(n - 1, -1, -1):
        if abs(main[i]) < least:
            main[i] = least
        rest = (upper[i] * x[i + 1] if i + 1 < n else 0.0) + (far[i] * x[i + 2] if i + 2 < n else 0.0)
        x[i] = (x[i] - rest) / main[i]
    return x


def leading_vectors(d: np.ndarray, e: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) by inverse iteration; those of close eigenvalues are kept orthogonal."""
    n = len(d)
    size = float(np.max(np.abs(d) + np.r_[0.0, np.abs(e)] + np.r_[np.abs(e), 0.0]))
    least = max(EPS * size, np.finfo(float).tiny)
    close, same = 1e-3 * size, 10 * EPS * size
    out = np.zeros((n, len(values)))
    first, last = 0, np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > close:
            first = j
        # Equal eigenvalues are pulled apart by a few rounding errors, so that each has its own shift.
        shift = min(value, last - same) if j > first else value
        last = shift
        x = np.random.default_rng(j).uniform(-1, 1, n)
        for _ in range(8):
            x = solve_shifted(d, e, shift, x / np.abs(x).max(), least)
            x /= np.abs(x).max()
            for _ in range(2):
                x -= out[:, first:j] @ (out[:, first:j].T @ x)
            x /= np.linalg.norm(x)
            product = d * x + np.r_[0.0, e * x[:-1]] + np.r_[e * x[1:], 0.0]
            if np.linalg.norm(product - value * x) <= 4 * EPS * size and _ > 1:
                break
        out[:, j] = x
    return out


def leading_eigenpairs(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns."""
    size = float(np.abs(matrix).max(initial=0.0))
    if size == 0:
        return np.zeros(k), np.eye(len(matrix))[:, :k]
    d, e, q = tridiagonalise(matrix / size)
    e[np.abs(e) <= EPS * EPS * max(np.abs(d).max(), np.abs(e).max(initial=0.0))] = 0.0
    values = leading_values(d, e, k)
    return values * size, q @ leading_vectors(d, e, values)

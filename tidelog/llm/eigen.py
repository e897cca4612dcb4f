"""Leading eigenvalues and eigenvectors of a symmetric matrix: Householder, Sturm counts, inverse iteration."""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
CLUSTER = 1e-3  # eigenvalues nearer than that part of the matrix's norm share an orthogonal basis


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, off-diagonal, reflections) of a tridiagonal matrix with the eigenvalues of the symmetric ``a``.

    The k-th reflection is a unit vector over the entries from k + 1 on, or zero where nothing had to be reflected.
    """
    a = np.array(a, np.float64)
    n = len(a)
    off, reflections = np.zeros(max(n - 1, 0)), []
    for k in range(n - 2):
        column = a[k + 1 :, k].copy()
        length = np.linalg.norm(column)
        if length == 0 or not column[1:].any():
            off[k] = column[0]
            reflections.append(np.zeros(n - k - 1))
            continue
        off[k] = -np.copysign(length, column[0])
        column[0] -= off[k]
        column /= np.linalg.norm(column)
        rest = a[k + 1 :, k + 1 :]
        p = 2 * (rest @ column)
        w = p - (column @ p) * column
        rest -= np.outer(column, w) + np.outer(w, column)
        reflections.append(column)
    if n > 1:
        off[n - 2] = a[n - 1, n - 2]
    return np.diag(a).copy(), off, reflections


def below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each of the numbers ``at``: the negative terms of the Sturm sequence there."""
    tiny = EPS * max(np.abs(off).max(initial=0), np.abs(diagonal).max(initial=0), np.finfo(np.float64).tiny / EPS)
    squares = np.r_[0.0, off * off]
    count, q = np.zeros(len(at), np.int64), np.ones(len(at))
    for d, s in zip(diagonal, squares):
        q = (d - at) - s / q
        q = np.where(np.abs(q) < tiny, -tiny, q)
        count += q < 0
    return count


def largest(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, each found by halving until no number lies between the bounds."""
    n = len(diagonal)
    reach = np.abs(np.r_[0.0, off]) + np.abs(np.r_[off, 0.0])
    order = n - 1 - np.arange(min(k, n))
    spread = EPS * n * (np.abs(diagonal) + reach).max(initial=0)
    low = np.full(len(order), (diagonal - reach).min(initial=0) - spread)
    high = np.full(len(order), (diagonal + reach).max(initial=0) + spread)
    while True:
        middle = low + (high - low) / 2
        if not ((middle > low) & (middle < high)).any():
            return high
        beyond = below(diagonal, off, middle) > order
        high, low = np.where(beyond, middle, high), np.where(beyond, low, middle)


def _factored(diagonal: np.ndarray, off: np.ndarray, value: float, tiny: float) -> tuple:
    """Upper factor and row exchanges of the tridiagonal matrix less ``value``, with partial pivoting."""
    n = len(diagonal)
    first, second, third = (diagonal - value).tolist(), [*off.tolist(), 0.0], [0.0] * n
    factors, swaps = [0.0] * n, [False] * n
    for i in range(n - 1):
        under = float(off[i])
        if abs(under) > abs(first[i]):
            swaps[i] = True
            first[i], under = under, first[i]
            second[i], first[i + 1] = first[i + 1], second[i]
            third[i], second[i + 1] = second[i + 1], 0.0
        if first[i] == 0.0:
            first[i] = tiny
        factors[i] = under / first[i]
        first[i + 1] -= factors[i] * second[i]
        second[i + 1] -= factors[i] * third[i]
    first = [x if abs(x) >= tiny else tiny for x in first]
    return first, second, third, factors, swaps


def _solved(factored: tuple, x: np.ndarray) -> np.ndarray:
    first, second, third, factors, swaps = factored
    y, n = x.tolist(), len(first)
    for i in range(n - 1):
        if swaps[i]:
            y[i], y[i + 1] = y[i + 1], y[i]
        y[i + 1] -= factors[i] * y[i]
    for i in range(n - 1, -1, -1):
        if i + 1 < n:
            y[i] -= second[i] * y[i + 1]
        if i + 2 < n:
            y[i] -= third[i] * y[i + 2]
        y[i] /= first[i]
    return np.array(y)


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, rounds: int = 4) -> np.ndarray:
    """Unit eigenvectors (rows) for ``values``, falling; those of a cluster are made orthogonal to each other in every round."""
    n = len(diagonal)
    norm = float((np.abs(diagonal) + np.abs(np.r_[0.0, off]) + np.abs(np.r_[off, 0.0])).max(initial=0)) or 1.0
    draw = np.random.default_rng(11)
    out = np.zeros((len(values), n))
    start = 0
    used = np.inf
    for i, value in enumerate(values):
        if i and values[i - 1] - value > CLUSTER * norm:
            start = i
        used = min(float(value), used - 4 * EPS * norm)  # equal ones are told apart by a little
        factored = _factored(diagonal, off, used, EPS * norm)
        x = draw.standard_normal(n)
        for _ in range(rounds):
            x = _solved(factored, x / np.linalg.norm(x))
            x /= np.abs(x).max()
            for _ in range(2):
                x -= out[start:i].T @ (out[start:i] @ x)
        out[i] = x / np.linalg.norm(x)
    return out


def leading(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as rows) of the symmetric matrix ``a``: the ``k`` largest, falling.

    The largest entry of a vector is positive, so that equal matrices give equal signs.
    """
    a = np.asarray(a, np.float64)
    scale = float(np.abs(a).max(initial=0))
    if scale == 0:
        return np.zeros(min(k, len(a))), np.eye(len(a))[:k]
    diagonal, off, reflections = tridiagonal(a / scale)
    values = largest(diagonal, off, k)
    vectors = inverse_iteration(diagonal, off, values)
    for i in range(len(reflections) - 1, -1, -1):
        r = reflections[i]
        vectors[:, i + 1 :] -= 2 * np.outer(vectors[:, i + 1 :] @ r, r)
    most = np.argmax(np.abs(vectors), axis=1)
    vectors *= np.sign(vectors[np.arange(len(vectors)), most])[:, None]
    return values * scale, vectors / np.linalg.norm(vectors, axis=1)[:, None]

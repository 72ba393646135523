"""Eigenvectors of a small symmetric matrix by spectral divide and conquer.

The polar factor of ``A - s I`` has the eigenvalues +1 and -1 where A's lie
above and below the shift, so it gives the projector on the eigenvectors
above. The two invariant subspaces are split in turn until each has one
dimension, or one eigenvalue. Polar factors come from the dynamically weighted
Halley iteration, which needs no more than a few QR or Cholesky steps.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
#: Halley steps from a bound of one rounding unit take six.
MAX_STEPS = 12


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix. What ``a`` has
    within rounding of eigenvalue 0 may stay between -1 and 1."""
    n = len(a)
    scale = np.linalg.norm(a)
    x, low = a / scale, EPS / np.sqrt(n)
    for _ in range(MAX_STEPS):
        sq = low * low
        d = np.cbrt(4 * (1 - sq) / (sq * sq))
        root = np.sqrt(1 + d)
        wa = root + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - sq) / (sq * root))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:  # far from orthogonal: the stable form
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, np.eye(n)]))
            y = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        else:
            factor = np.linalg.cholesky(np.eye(n) + wc * (x.T @ x))
            y = (wb / wc) * x + (wa - wb / wc) * np.linalg.solve(factor.T, np.linalg.solve(factor, x.T)).T
        y = (y + y.T) / 2
        low = min(low * (wa + wb * sq) / (1 + wc * sq), 1.0)
        moved = np.linalg.norm(y - x)
        x = y
        if 1 - low < 10 * EPS and moved < (4 * EPS) ** (1 / 3):
            break
    return x


def halves(a: np.ndarray, shift: float, rng: np.random.Generator) -> tuple[np.ndarray, int, float]:
    """(orthonormal Q, k, error): the first k columns span the eigenvectors
    of ``a`` above ``shift``, the others the rest; error is what couples them."""
    n = len(a)
    p = (polar(a - shift * np.eye(n)) + np.eye(n)) / 2
    k = int(round(np.trace(p)))
    if not 0 < k < n:
        return np.eye(n), k, np.inf
    q, _ = np.linalg.qr(p @ rng.standard_normal((n, k)), mode="complete")
    q, _ = np.linalg.qr(p @ q[:, :k], mode="complete")
    return q, k, float(np.linalg.norm(q[:, k:].T @ a @ q[:, :k]))


def divide(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns), in no order, to about a
    rounding unit of the norm."""
    n, rng = len(a), np.random.default_rng(11)
    values, vectors = np.zeros(n), np.zeros((n, n))
    tiny = 4 * n * EPS * np.linalg.norm(a)
    done, todo = 0, [(a, np.eye(n))]
    while todo:
        b, basis = todo.pop()
        m = len(b)
        mean = np.trace(b) / m
        if m == 1 or np.linalg.norm(b - mean * np.eye(m)) <= tiny:
            values[done:done + m], vectors[:, done:done + m] = np.diag(b), basis
            done += m
            continue
        # the mean lies strictly between the extreme eigenvalues; if one sits on the shift, another shift is tried
        best = None
        spread = np.linalg.norm(b - mean * np.eye(m)) / np.sqrt(m)
        for shift in (float(np.median(np.diag(b))), mean, mean + spread / 16, mean - spread / 16, mean + spread / 7, mean - spread / 7):
            q, k, error = halves(b, shift, rng)
            if np.isfinite(error) and (best is None or error < best[2]):
                best = q, k, error
            if error <= tiny:
                break
        q, k, _ = best
        for part in (q[:, :k], q[:, k:]):
            c = part.T @ b @ part
            todo.append(((c + c.T) / 2, basis @ part))
    return values, vectors


def refine(a: np.ndarray, x: np.ndarray, steps: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvectors ``x`` of ``a`` brought to the precision of ``a``'s type:
    made orthonormal, then turned by first-order corrections, whose error
    squares in every step. Eigenvalues that the present error does not tell
    apart wait for a later step."""
    x, one = x.astype(a.dtype), np.eye(len(a), dtype=a.dtype)
    for _ in range(steps):
        x = x @ (3 * one - x.T @ x) / 2
        s = x.T @ a @ x
        value = np.diag(s)
        off = s - np.diag(value)
        gap = value[None, :] - value[:, None]
        apart = np.abs(gap) > 2 * np.sqrt((off * off).sum())
        e = np.where(apart, off / np.where(apart, gap, 1), 0)
        x = x + x @ e
        if np.abs(e).max() < EPS:  # its square is gone too
            break
    for _ in range(2):
        x = x @ (3 * one - x.T @ x) / 2
    return np.diag(x.T @ a @ x), x


def components(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of a symmetric matrix by
    falling eigenvalue; each vector's largest entry is positive. ``a`` may be
    of a longer type than double, whose precision the results then have."""
    if not np.any(a):
        return np.diag(a).copy(), np.eye(len(a), dtype=a.dtype)
    scale = np.abs(a).max()
    a = a / scale
    _, x = divide(a.astype(float))
    values, x = refine(a, x)
    order = np.argsort(-values, kind="stable")
    values, x = values[order], x[:, order]
    sign = np.sign(x[np.abs(x).argmax(axis=0), np.arange(len(x))])
    return values * scale, x * np.where(sign == 0, 1, sign)

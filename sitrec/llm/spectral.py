"""Eigenvectors of a symmetric matrix by spectral divide and conquer over polar decompositions (QDWH)."""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)


def _symmetric(a: np.ndarray) -> np.ndarray:
    return (a + a.T) / 2


def polar_factor(a: np.ndarray, steps: int = 40) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix: its matrix sign, by dynamically weighted Halley iterations.

    The weights come from a lower bound of the least singular value, which rises to 1 in about six steps from
    the resolution of doubles.  Far from 1 a step is taken through a QR decomposition, near it through a solve.
    """
    n = len(a)
    size = float(np.linalg.norm(a))
    if not size:
        return np.zeros_like(a)
    x, low, one = a / size, EPS / n, np.eye(n)
    for _ in range(steps):
        before = x
        square = min(low, 1.0) ** 2
        d = np.cbrt(4 * (1 - square) / square**2)
        wa = np.sqrt(1 + d) + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * np.sqrt(1 + d)))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, one]))
            x = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        else:
            x = (wb / wc) * x + (wa - wb / wc) * np.linalg.solve(one + wc * (x.T @ x), x.T).T
        x = _symmetric(x)
        low = min(1.0, low * (wa + wb * square) / (1 + wc * square))
        if 1 - low < 10 * EPS and np.linalg.norm(x - before) < EPS ** (1 / 3) * np.sqrt(n):
            break
    return x


def _split(a: np.ndarray, shift: float, rng: np.random.Generator) -> tuple[int, np.ndarray, float]:
    """Eigenvalues above ``shift``, an orthogonal basis whose first columns span their space, and what couples the two."""
    n = len(a)
    above = (polar_factor(a - shift * np.eye(n)) + np.eye(n)) / 2
    k = int(round(float(np.trace(above))))
    if k <= 0 or k >= n:
        return min(max(k, 0), n), np.eye(n), 0.0
    start = rng.standard_normal((n, n))
    for _ in range(2):  # once more, so that the basis is as exact as the projector
        parts = np.hstack([above @ start[:, :k], start[:, k:] - above @ start[:, k:]])
        start, _ = np.linalg.qr(parts)
    return k, start, float(np.linalg.norm(start[:, :k].T @ a @ start[:, k:]))


def spectrum(matrix: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues (all by default), falling, and their eigenvectors as columns.

    The polar factor of the matrix less a shift gives the projector on the eigenvectors above the shift; both
    invariant subspaces are divided again until they are lines, or numerically diagonal.  Shifts start at the
    median of the diagonal and are halved into the side that holds all eigenvalues; a shift that
    meets an eigenvalue leaves the subspaces coupled and is replaced.  Subspaces below the ones asked for are not divided.
    """
    matrix = _symmetric(np.asarray(matrix, float))
    most = len(matrix) if most is None else min(most, len(matrix))
    scale = float(np.linalg.norm(matrix))
    rng = np.random.default_rng(0)
    values: list[float] = []
    vectors: list[np.ndarray] = []
    stack = [(matrix, np.eye(len(matrix)))] if most else []
    while stack and len(values) < most:
        a, basis = stack.pop()
        n = len(a)
        off = float(np.linalg.norm(a - np.diag(np.diag(a))))
        if n == 1 or off <= EPS * scale:
            for i in np.argsort(-np.diag(a), kind="stable"):
                values.append(float(a[i, i]))
                vectors.append(basis[:, i])
            continue
        reach = np.abs(a).sum(axis=1) - np.abs(np.diag(a))
        low, high = float((np.diag(a) - reach).min()), float((np.diag(a) + reach).max())
        shift, best = float(np.median(np.diag(a))), None
        for _ in range(200):
            k, q, coupled = _split(a, shift, rng)
            if 0 < k < n:
                if best is None or coupled < best[2]:
                    best = (k, q, coupled)
                if coupled <= 4 * n * EPS * scale:
                    break
                shift += (high - low) * rng.uniform(-0.05, 0.05)  # it meets an eigenvalue
            else:
                low, high = (shift, high) if k else (low, shift)
                shift = (low + high) / 2
                if high - low <= EPS * scale:
                    break
        if best is None:  # one eigenvalue, as far as doubles tell
            stack.append((np.diag(np.diag(a)), basis))
            continue
        k, q, _ = best
        below, over = q[:, k:], q[:, :k]
        stack.append((_symmetric(below.T @ a @ below), basis @ below))
        stack.append((_symmetric(over.T @ a @ over), basis @ over))  # taken first
    order = np.argsort(-np.array(values), kind="stable")[:most]
    return np.array(values)[order], np.column_stack([vectors[i] for i in order]) if len(order) else np.empty((len(matrix), 0))

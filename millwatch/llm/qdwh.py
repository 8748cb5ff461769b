"""Eigenvectors of a symmetric matrix by spectral divide and conquer on polar decompositions.

The polar factor of A - s I has the eigenvectors of A and the sign of each eigenvalue less s, so half of it plus half
the identity projects onto the eigenvectors above s. The column space of that projector and the rest of the space split
A into two smaller matrices, which are split in the same way until they are numbers, or multiples of the identity. The
polar factor comes from dynamically weighted Halley steps in the form that needs QR factorisations only.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix that is not singular."""
    m = len(a)
    x = a / np.linalg.norm(a)  # no singular value over 1
    # a lower bound of the singular values; too small a bound only costs a step
    try:
        low = 1 / np.linalg.norm(np.linalg.inv(x))
    except np.linalg.LinAlgError:
        low = 0.0
    low = max(0.9 * low, EPS) if np.isfinite(low) else EPS
    eye = np.eye(m)
    for _ in range(20):
        square = low * low
        d = np.cbrt(4 * (1 - square) / (square * square)) if square < 1 else 0.0
        root = np.sqrt(1 + d)
        wa = root + np.sqrt(max(8 - 4 * d + 8 * (2 - square) / (square * root), 0.0)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
        y = (wb / wc) * x + ((wa - wb / wc) / np.sqrt(wc)) * (q[:m] @ q[m:].T)
        y = (y + y.T) / 2
        low = min(low * (wa + wb * square) / (1 + wc * square), 1.0)
        moved = np.linalg.norm(y - x)
        x = y
        if abs(1 - low) < 10 * EPS and moved < np.cbrt(EPS):
            break
    return x


def _split(a: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of two subspaces that `a` keeps, both not empty."""
    m = len(a)
    diagonal = np.sort(np.diag(a))
    mean = diagonal.mean()
    # the mean always parts the eigenvalues; others only where they lie clear of them
    shifts = [np.median(diagonal), mean, (mean + diagonal[0]) / 2, (mean + diagonal[-1]) / 2]
    start = np.random.default_rng(m).standard_normal((m, m))
    best = None
    for shift in shifts:
        moved = a - shift * np.eye(m)
        if not np.linalg.norm(moved):
            continue
        projector = (polar_factor(moved) + np.eye(m)) / 2
        k = int(round(np.trace(projector)))
        if not 0 < k < m:
            continue
        basis = np.linalg.qr(projector @ start[:, :k], mode="complete")[0]
        for _ in range(3):
            # a step of subspace iteration sharpens the basis
            basis = np.linalg.qr(projector @ basis[:, :k], mode="complete")[0]
            left = np.linalg.norm(basis[:, k:].T @ a @ basis[:, :k])
            if best is None or left < best[0]:
                best = (left, basis[:, :k], basis[:, k:])
            if left <= m * EPS * scale:
                return best[1:]
    if best is None:
        raise ArithmeticError("no shift parts the eigenvalues")
    return best[1:]


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of a symmetric matrix."""
    a = np.asarray(a, float)
    a = (a + a.T) / 2
    m, scale = len(a), np.linalg.norm(a)
    values, vectors = np.zeros(m), np.eye(m)
    waiting, done = [(a, np.eye(m))] if m else [], 0
    while waiting:
        block, basis = waiting.pop()
        k = len(block)
        mean = np.trace(block) / k
        if k == 1 or np.linalg.norm(block - mean * np.eye(k)) <= EPS * scale:
            values[done : done + k] = np.diag(block)
            vectors[:, done : done + k] = basis
            done += k
            continue
        for part in _split(block, scale):
            inner = part.T @ block @ part
            waiting.append(((inner + inner.T) / 2, basis @ part))
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]

"""Eigenvectors of a symmetric matrix by spectral divide and conquer on QDWH polar decompositions.

The polar factor of ``A - shift * I`` is a matrix sign: +1 on the eigenvectors above the shift, -1 below. Half of its sum
with the identity is the projector on the upper invariant subspace. Orthonormal bases of both subspaces cut the
matrix into two smaller ones, which are split in turn until single eigenvectors (or multiples of the identity) are left.
"""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(float).eps
#: Where a block is cut: its mean eigenvalue, moved by these shares of the eigenvalues' spread until a cut succeeds.
_MOVES = (0.0, 0.11, -0.13, 0.29, -0.31, 0.53, -0.59, 0.83, -0.89, 0.02, -0.03, 0.007, -0.005)


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by dynamically weighted Halley steps (QDWH).

    A step solves with a QR factorisation while its weight is large and with a Cholesky factorisation after that.
    """
    n = len(a)
    x, low = a / np.linalg.norm(a), _EPS
    identity = np.eye(n)
    for _ in range(20):
        g = np.cbrt(4 * (1 - low**2) / low**4) if low < 1 else 0.0
        wa = np.sqrt(1 + g) + 0.5 * np.sqrt(max(0.0, 8 - 4 * g + 8 * (2 - low**2) / (low**2 * np.sqrt(1 + g))))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, identity]))
            new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        else:
            lower = np.linalg.cholesky(identity + wc * (x.T @ x))
            solved = np.linalg.solve(lower.T, np.linalg.solve(lower, x.T)).T
            new = wb / wc * x + (wa - wb / wc) * solved
        new = (new + new.T) / 2
        moved, x = np.linalg.norm(new - x), new
        low = min(1.0, low * (wa + wb * low**2) / (1 + wc * low**2))
        if moved < _EPS ** (1 / 3) and low > 1 - 1e-8:
            break
    return x


def _basis(projector: np.ndarray, rank: int, draw: np.random.Generator) -> np.ndarray:
    """Orthonormal columns that span the projector's range."""
    q, _ = np.linalg.qr(projector @ draw.standard_normal((len(projector), rank)))
    return np.linalg.qr(projector @ q)[0]


def _split(a: np.ndarray, scale: float, draw: np.random.Generator) -> np.ndarray:
    """Orthonormal eigenvectors of ``a``; what is off the diagonal by less than rounding at ``scale`` counts as zero."""
    n = len(a)
    if n == 1:
        return np.eye(1)
    mean = np.trace(a) / n
    spread = np.linalg.norm(a - mean * np.eye(n)) / np.sqrt(n)
    if spread <= 4 * _EPS * scale:
        return np.eye(n)
    best = None
    for move in _MOVES:
        sign = polar(a - (mean + move * spread) * np.eye(n))
        rank = int(round((n + np.trace(sign)) / 2))
        if not 0 < rank < n:
            continue
        upper = _basis((np.eye(n) + sign) / 2, rank, draw)
        lower = _basis((np.eye(n) - sign) / 2, n - rank, draw)
        whole, _ = np.linalg.qr(np.hstack([upper, lower]))
        turned = whole.T @ a @ whole
        left = np.linalg.norm(turned[rank:, :rank])
        if best is None or left < best[0]:
            best = left, rank, whole, turned
        if left <= 8 * n * _EPS * scale:
            break
    if best is None:
        raise np.linalg.LinAlgError("no shift separates the eigenvalues")
    _, rank, whole, turned = best
    turned = (turned + turned.T) / 2
    return np.hstack([
        whole[:, :rank] @ _split(turned[:rank, :rank], scale, draw), whole[:, rank:] @ _split(turned[rank:, rank:], scale, draw),
    ])


def eigenvectors(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors): eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns.

    Within a repeated eigenvalue any orthonormal vectors of its subspace come out. The zero matrix gives the unit
    vectors; an empty matrix gives nothing. The same matrix always gives the same vectors.
    """
    n, size = len(a), np.abs(a).max(initial=0)
    if size == 0:
        return np.zeros(n), np.eye(n)
    a = (a + a.T) / (2 * size)
    vectors = np.linalg.qr(_split(a, np.linalg.norm(a), np.random.default_rng(0)))[0]
    values = np.einsum("ij,ij->j", vectors, a @ vectors) * size
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]

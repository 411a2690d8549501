"""Largest eigenpairs of a symmetric matrix that is only known by its products with blocks of vectors.

Block Jacobi-Davidson: a Rayleigh-Ritz step picks the wanted pairs out of a subspace; for
all of them that have not converged, the correction equation, projected off the locked and
the wanted vectors, is solved loosely by MINRES (all right-hand sides share each product);
the corrections extend the subspace. Leading pairs whose residuals have reached ``tol``
are locked. A subspace that has grown too large starts again from its best Ritz vectors.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

Product = Callable[[np.ndarray], np.ndarray]
#: Residual norms that count as converged, as a share of the largest eigenvalue.
TOLERANCE = 2.0**-46


def largest_pairs(product: Product, size: int, count: int, tol: float = TOLERANCE, inner: int = 5, seed: int = 12,
                  rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and their unit eigenvectors (columns)."""
    count = min(count, size)
    locked, values = np.zeros((size, 0)), np.zeros(0)
    room = size + count if size <= 8 * count else 4 * count + 8
    basis = _orthonormal(np.random.default_rng([seed, size]).standard_normal((size, min(size, count + 4))), locked)
    images = product(basis)
    for _ in range(rounds):
        inside = basis.T @ images
        theta, mix = np.linalg.eigh((inside + inside.T) / 2)
        theta, mix = theta[::-1], mix[:, ::-1]
        wanted = count - len(values)
        ritz, image = basis @ mix, images @ mix
        residual = image[:, :wanted] - ritz[:, :wanted] * theta[:wanted]
        scale = max(abs(theta[0]), values.max(initial=0.0))
        open_ = np.linalg.norm(residual, axis=0) > tol * scale
        full = basis.shape[1] + locked.shape[1] >= size
        done = wanted if full or not open_.any() else int(open_.argmax())
        if done:
            locked, values = np.hstack([locked, ritz[:, :done]]), np.append(values, theta[:done])
            if len(values) == count:
                return _polished(product, locked)
        found, residual, open_ = ritz[:, done:wanted], residual[:, done:], open_[done:]
        if ritz.shape[1] - done + open_.sum() > room:
            ritz, image = ritz[:, : done + count + 4], image[:, : done + count + 4]
        basis, images = ritz[:, done:], image[:, done:]
        away = np.hstack([locked, found])
        correction = minres(product, theta[done:wanted][open_], away, -residual[:, open_], inner)
        fresh = _orthonormal(correction, np.hstack([locked, basis]))
        if not fresh.shape[1]:
            fresh = _orthonormal(np.random.default_rng([seed, size, len(values)]).standard_normal((size, 1)), np.hstack([locked, basis]))
        basis, images = np.hstack([basis, fresh]), np.hstack([images, product(fresh)])
    raise RuntimeError("eigenpairs did not converge")


def minres(product: Product, shifts: np.ndarray, away: np.ndarray, rhs: np.ndarray, steps: int, enough: float = 1e-2) -> np.ndarray:
    """Approximate t with P (A - shift) P t = rhs for every column, P taking ``away`` off; at most ``steps`` products."""

    def off(block: np.ndarray) -> np.ndarray:
        return block - away @ (away.T @ block)

    def norm(block: np.ndarray) -> np.ndarray:
        return np.sqrt((block * block).sum(0))

    def over(top, bottom):
        return np.divide(top, bottom, out=np.zeros(np.broadcast(top, bottom).shape), where=bottom > tiny)

    y = older = newer = off(off(rhs))
    first = beta = norm(y)
    tiny = 1e-300 + 1e-15 * first
    x = w = w_old = np.zeros_like(rhs)
    beta_old = dbar = epsilon = sine = np.zeros_like(first)
    phi_bar, cosine = first, -np.ones_like(first)
    for step in range(steps):
        v = over(y, beta)
        y = off(product(v) - v * shifts)
        if step:
            y = y - over(beta, beta_old) * older
        alpha = (v * y).sum(0)
        y = off(y - over(alpha, beta) * newer)
        older, newer = newer, y
        beta_old, beta = beta, norm(y)
        epsilon_old = epsilon
        delta = cosine * dbar + sine * alpha
        gamma_bar = sine * dbar - cosine * alpha
        epsilon, dbar = sine * beta, -cosine * beta
        gamma = np.sqrt(gamma_bar**2 + beta**2)
        cosine, sine = over(gamma_bar, gamma), over(beta, gamma)
        phi, phi_bar = cosine * phi_bar, sine * phi_bar
        w_older, w_old = w_old, w
        w = over(v - epsilon_old * w_older - delta * w_old, gamma)
        x = x + phi * w
        if (phi_bar <= enough * first).all() or (beta <= tiny).all():
            break
    return off(x)


def _orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span ``block`` beyond ``against``; what vanishes there is left out."""
    sizes = np.linalg.norm(block, axis=0)
    block = block[:, sizes > 0] / sizes[sizes > 0]
    for _ in range(2):
        block = block - against @ (against.T @ block)
        if block.shape[1]:
            u, s, _ = np.linalg.svd(block, full_matrices=False)
            block = u[:, s > 1e-10]
    return block[:, : max(0, against.shape[0] - against.shape[1])]


def _polished(product: Product, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One last Rayleigh-Ritz step inside the locked vectors, with a fresh product."""
    vectors, _ = np.linalg.qr(vectors)
    inside = vectors.T @ product(vectors)
    theta, mix = np.linalg.eigh((inside + inside.T) / 2)
    return theta[::-1], (vectors @ mix)[:, ::-1]

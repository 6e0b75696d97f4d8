"""Leading eigenpairs of a symmetric operator that is only known by its products with blocks of vectors."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

Product = Callable[[np.ndarray], np.ndarray]
EPS = float(np.finfo(np.float64).eps)


def _new_directions(block: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span what the block adds to the basis."""
    out = basis
    for column in block.T:
        v, size = column, np.linalg.norm(column)
        if not size:
            continue
        for _ in range(3):
            before = np.linalg.norm(v)
            v = v - out @ (out.T @ v)
            if np.linalg.norm(v) > 0.7 * before:
                break
        left = np.linalg.norm(v)
        if left > 1e-10 * size:
            out = np.column_stack([out, v / left])
    return out[:, basis.shape[1] :]


def corrections(
    product: Product, values: np.ndarray, vectors: np.ndarray, residuals: np.ndarray, locked: np.ndarray, steps: int, least: float
) -> np.ndarray:
    """Solutions t of (I - QQ')(V - value I)(I - QQ') t = -residual for several Ritz pairs, by MINRES.

    Q holds the locked vectors and the pair's own. All pairs advance together, so one product serves all of them;
    each ends when its residual is `least` of the first.
    """

    def projected(z: np.ndarray) -> np.ndarray:
        z = z - vectors * np.sum(vectors * z, axis=0)
        z = z - locked @ (locked.T @ z)
        return z - vectors * np.sum(vectors * z, axis=0)

    count = vectors.shape[1]
    some = lambda x: np.where(x > 0, x, 1.0)
    v = projected(-residuals)
    beta = np.linalg.norm(v, axis=0)
    first, left = beta, beta
    v, older = v / some(beta), np.zeros_like(v)
    beta, done = np.zeros(count), first == 0
    cos, sin, cos_old, sin_old = np.ones(count), np.zeros(count), np.ones(count), np.zeros(count)
    step, step_old, out = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v)
    for _ in range(steps):
        z = projected(product(v) - v * values)
        alpha = np.sum(v * z, axis=0)
        z = projected(z - alpha * v - beta * older)
        grown = np.linalg.norm(z, axis=0)
        diagonal = cos * alpha - cos_old * sin * beta
        above, twice_above = sin * alpha + cos_old * cos * beta, sin_old * beta
        length = np.hypot(diagonal, grown)
        done = done | (length == 0)
        step, step_old = (v - twice_above * step_old - above * step) / some(length), step
        cos, cos_old = np.where(done, 1.0, diagonal / some(length)), cos
        sin, sin_old = np.where(done, 0.0, grown / some(length)), sin
        out = np.where(done, out, out + cos * left * step)
        left = np.where(done, left, -sin * left)
        older, v, beta = v, z / some(grown), grown
        done = done | (np.abs(left) <= least * first) | (grown <= EPS * first)
        if done.all():
            break
    return out


def leading_pairs(
    product: Product, size: int, k: int, guard: int = 8, steps: int = 4, most: int = 96, tolerance: float = 64 * EPS, seed: int = 0
) -> tuple[np.ndarray, np.ndarray, int]:
    """The k largest eigenvalues, falling, their unit vectors as columns, and the number of products taken.

    Jacobi-Davidson: the Ritz pairs of a subspace are improved by the solutions of their correction equations, the
    subspace grows by those, and the leading pairs are locked one after the other as soon as their residuals are
    at most `tolerance` times the largest eigenvalue. A subspace of `most` columns is cut back to its leading Ritz
    vectors. It ends for certain where the subspace has become the whole space.
    """
    rng = np.random.default_rng(seed)
    k = min(k, size)
    basis = np.linalg.qr(rng.normal(size=(size, min(size, k + guard))))[0]
    image, products = product(basis), 1
    vectors, values = np.empty((size, 0)), np.empty(0)

    def counted(block: np.ndarray) -> np.ndarray:
        nonlocal products
        products += 1
        return product(block)

    while True:
        small = basis.T @ image
        ritz, turn = np.linalg.eigh((small + small.T) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        left = image - basis * ritz
        left -= vectors @ (vectors.T @ left)
        errors = np.linalg.norm(left, axis=0)
        largest = max(0.0, *values, *ritz[:1])
        wanted = k - len(values)
        whole = basis.shape[1] + len(values) >= size
        settled = whole | (errors[:wanted] <= tolerance * largest)
        take = wanted if settled.all() else int(np.argmin(settled))
        vectors, values = np.hstack([vectors, basis[:, :take]]), np.append(values, ritz[:take])
        basis, image, ritz, left = basis[:, take:], image[:, take:], ritz[take:], left[:, take:]
        wanted -= take
        if not wanted:
            order = np.argsort(-values, kind="stable")
            return values[order], vectors[:, order], products
        if basis.shape[1] >= most:
            keep = wanted + guard
            basis, image, ritz, left = basis[:, :keep], image[:, :keep], ritz[:keep], left[:, :keep]
        active = min(wanted, basis.shape[1])
        solved = corrections(counted, ritz[:active], basis[:, :active], left[:, :active], vectors, steps, 1e-3)
        known = np.hstack([vectors, basis])
        more = _new_directions(solved, known)
        if not more.shape[1]:  # a subspace that no correction leaves
            more = _new_directions(rng.normal(size=(size, wanted)), known)
        basis, image = np.hstack([basis, more]), np.hstack([image, counted(more)])

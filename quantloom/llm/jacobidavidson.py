"""The largest eigenpairs of a symmetric operator that is known by its products alone.

``product`` takes a block of columns and is called as rarely as the method allows: corrections of all wanted pairs are
solved in step with each other, so that a step of the inner solver is one product, however many pairs are sought.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

Product = Callable[[np.ndarray], np.ndarray]
EPS = float(np.finfo(np.float64).eps)


def orthonormal(new: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns add to the spaces of ``against``."""
    sizes = np.linalg.norm(new, axis=0)
    new = new[:, sizes > 0] / sizes[sizes > 0]
    for _ in range(2):
        for q in against:
            new = new - q @ (q.T @ new)
        kept = np.linalg.norm(new, axis=0) > 1e-10
        new = new[:, kept] / np.linalg.norm(new[:, kept], axis=0)
    if not new.shape[1]:
        return new
    u, s, _ = np.linalg.svd(new, full_matrices=False)
    q = u[:, s > 1e-8 * s[0]]
    for other in against:
        q = q - other @ (other.T @ q)
    return np.linalg.qr(q)[0]


def minres(apply: Product, rhs: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    """Solves ``apply(x) = rhs`` for each column, in step: Lanczos vectors and Givens rotations of each, one product for all."""
    x, r = np.zeros_like(rhs), rhs.copy()
    beta = np.linalg.norm(r, axis=0)
    begun, v, v_old = beta.copy(), r / np.where(beta > 0, beta, 1), np.zeros_like(r)
    eta, w, w_old = beta.copy(), np.zeros_like(r), np.zeros_like(r)
    c, c_old, s, s_old = (np.full(rhs.shape[1], a) for a in (1.0, 1.0, 0.0, 0.0))
    last = np.zeros_like(beta)
    for _ in range(steps):
        live = (np.abs(eta) > tolerance * begun) & (beta > EPS * begun)
        if not live.any():
            break
        p = apply(v)
        alpha = np.sum(v * p, axis=0)
        p = p - alpha * v - last * v_old
        grown = np.linalg.norm(p, axis=0)
        delta = c * alpha - c_old * s * last
        one, two, three = np.hypot(delta, grown), s * alpha + c_old * c * last, s_old * last
        one = np.where(one > 0, one, 1)
        c_old, s_old, c, s = c, s, delta / one, grown / one
        w, w_old = (v - three * w_old - two * w) / one, w
        x = np.where(live, x + c * eta * w, x)
        eta = np.where(live, -s * eta, eta)
        v_old, v = v, p / np.where(grown > 0, grown, 1)
        last = beta = np.where(live, grown, 0)
    return x


def largest(product: Product, dims: int, wanted: int, seed: int = 7, basis: int = 40, inner: int = 12, rounds: int = 200) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eigenvalues from the largest down, unit eigenvectors as columns and the norms of their residuals.

    A pair is locked once its residual is at rounding: ``dims`` times the machine's epsilon times the largest eigenvalue. The next
    pair is followed too, until its interval (value and residual) lies under the last locked one; a value that comes out above a locked one
    takes its place. Where the basis reaches all dimensions the result is that of the full matrix.
    """
    wanted = min(wanted, dims)
    more = min(dims, wanted + 2)
    random = np.random.default_rng(seed)
    w = orthonormal(random.standard_normal((dims, min(dims, 2 * more))))
    aw = product(w)
    vectors, values, norms = np.zeros((dims, 0)), np.zeros(0), np.zeros(0)
    for _ in range(rounds):
        h = w.T @ aw
        theta, y = np.linalg.eigh((h + h.T) / 2)
        theta, y = theta[::-1], y[:, ::-1]
        scale = max(np.max(np.abs(values), initial=0), np.max(np.abs(theta), initial=0), np.finfo(float).tiny)
        exact = dims * EPS * scale
        ritz, image = w @ y[:, :more], aw @ y[:, :more]
        residual = image - ritz * theta[:more]
        residual -= vectors @ (vectors.T @ residual)
        size = np.linalg.norm(residual, axis=0)
        if len(values) and len(theta) and theta[0] > values[-1] + exact:  # a locked one was not among the largest
            w, aw = np.hstack([w, vectors[:, -1:]]), np.hstack([aw, product(vectors[:, -1:])])
            vectors, values, norms = vectors[:, :-1], values[:-1], norms[:-1]
            continue
        ready = 0
        while len(values) + ready < wanted and ready < len(size) and size[ready] <= exact:
            ready += 1
        if ready:
            vectors, values, norms = np.hstack([vectors, ritz[:, :ready]]), np.concatenate([values, theta[:ready]]), np.concatenate([norms, size[:ready]])
            w, aw, theta, ritz, image, residual, size = w @ y[:, ready:], aw @ y[:, ready:], theta[ready:], ritz[:, ready:], image[:, ready:], residual[:, ready:], size[ready:]
            y = np.eye(w.shape[1])
        if len(values) == wanted and (not len(theta) or not len(size) or theta[0] + size[0] <= values[-1] + exact):
            break
        if w.shape[1] + len(size) > min(basis, dims - len(values)) and w.shape[1] > 2 * more:
            w, aw = w @ y[:, : 2 * more], aw @ y[:, : 2 * more]
        go = np.flatnonzero(size > exact)[:more] if len(values) < wanted else np.arange(min(1, len(size)))
        if not len(go):
            go = np.arange(len(size))
        q = np.hstack([vectors, ritz])
        out = lambda t: t - q @ (q.T @ t)  # noqa: B023, E731
        shift = theta[go]
        t = minres(lambda v: out(product(out(v)) - shift * v), -out(residual[:, go]), inner, 0.02)  # noqa: B023
        new = orthonormal(np.hstack([t, residual[:, go]]) if not np.any(t) else t, vectors, w)
        if not new.shape[1]:  # the space is exhausted, or nothing can be added to rounding
            new = orthonormal(random.standard_normal((dims, 1)), vectors, w) if w.shape[1] + len(values) < dims else new
            if not new.shape[1]:
                extra = min(wanted - len(values), len(theta))
                vectors, values, norms = np.hstack([vectors, ritz[:, :extra]]), np.concatenate([values, theta[:extra]]), np.concatenate([norms, size[:extra]])
                break
        w, aw = np.hstack([w, new]), np.hstack([aw, product(new)])
    else:
        raise ArithmeticError(f"{wanted - len(values)} of {wanted} eigenpairs did not converge in {rounds} rounds")
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order], norms[order]

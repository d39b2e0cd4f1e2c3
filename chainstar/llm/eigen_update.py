"""Symmetric eigendecompositions under rank-one updates, for operator 13.

``rank_one`` turns the eigenvalues and eigenvectors of A into those of
A + rho v v^T (rho > 0): in A's eigenvectors this is diag(d) + rho z z^T.
Deflation first: poles that are equal to rounding are turned by a reflection
so that one of them carries their whole part of z, and places where z is zero
to rounding keep their pair.  Of what is left, the new eigenvalues are the
roots of the secular equation 1 + rho sum_j z_j^2 / (d_j - x) = 0, one right
of each pole.  Each root is held as its distance from the nearer pole, and z
is recomputed from the roots, so the eigenvectors stay orthogonal.

``Spectrum`` is a count, a mean and the eigenpairs of the centred scatter
matrix: rows are added one by one, spectra by one update for each eigenpair of
the smaller and one for the distance of the means.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
ROUNDS = 100   # bisection alone ends within these


def _secular_roots(d: np.ndarray, w: np.ndarray, total: float) -> tuple[np.ndarray, np.ndarray]:
    """(pole number, distance from it) of each root of 1 + sum w / (d - x) = 0; d ascending, w > 0."""
    k = len(d)
    gap = np.append(d[1:] - d[:-1], total)
    # Nearer pole by the sign in the middle of the interval.
    mid = 1.0 + np.sum(w / (d[None, :] - (d + gap / 2)[:, None]), axis=1)
    base = np.arange(k)
    far = (mid < 0) & (base < k - 1)
    base = base + far
    poles = d[None, :] - d[base][:, None]           # distances of all poles from each root's own
    lo, hi = np.where(far, -gap / 2, 0.0), np.where(far, 0.0, gap / 2)
    last = mid[-1] < 0                              # the last root may lie in the right half, with no pole there
    if last:
        lo[-1], hi[-1] = gap[-1] / 2, 2 * gap[-1]
    x = (lo + hi) / 2
    below = np.tri(k)                               # 1 for the poles left of a root
    live = np.arange(k)
    for step in range(ROUNDS):
        p, y = poles[live], x[live]
        away = p - y[:, None]
        t = w / away
        left = below[live]
        psi = np.einsum("ij,ij->i", t, left)
        phi = t.sum(axis=1) - psi
        f = 1.0 + psi + phi
        size = 1.0 + np.abs(psi) + np.abs(phi)
        lo[live] = np.where(f < 0, y, lo[live])
        hi[live] = np.where(f > 0, y, hi[live])
        done = (np.abs(f) <= 16 * EPS * size) | (hi[live] - lo[live] <= 2 * EPS * np.abs(y))
        if done.all():
            break
        # The left poles' part as a + b / (p_i - x), the right ones' as c + e / (p_i+1 - x): a quadratic.
        here = live
        row = np.arange(len(here))
        pl = away[row, here]
        pr = np.where(here < k - 1, away[row, np.minimum(here + 1, k - 1)], np.inf)
        t /= away
        dpsi = np.einsum("ij,ij->i", t, left)
        dphi = t.sum(axis=1) - dpsi
        with np.errstate(all="ignore"):
            b = dpsi * pl * pl
            a = psi - dpsi * pl
            end = np.isinf(pr)
            e = np.where(end, 0.0, dphi * pr * pr)
            g = 1.0 + a + np.where(end, 0.0, phi - dphi * pr)
            prf = np.where(end, 1.0, pr)
            # g + b / (pl - s) + e / (prf - s) = 0 for the step s
            qa, qb, qc = g, -(g * (pl + prf) + b + e), g * pl * prf + b * prf + e * pl
            root = np.sqrt(np.maximum(qb * qb - 4 * qa * qc, 0.0))
            q = -0.5 * (qb + np.where(qb >= 0, root, -root))
            s1, s2 = q / qa, qc / q
            s_end = pl + b / g
            steps = np.where(end[:, None], np.stack([s_end, s_end], 1), np.stack([s1, s2], 1))
            tries = y[:, None] + steps
            inside = (tries > lo[here][:, None]) & (tries < hi[here][:, None])
            new = np.where(inside[:, 0], tries[:, 0], np.where(inside[:, 1], tries[:, 1], (lo[here] + hi[here]) / 2))
        x[live] = np.where(done, y, new)
        live = live[~done]
    return base, x


def rank_one(d: np.ndarray, u: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors (columns) of u diag(d) u^T + rho v v^T, for rho > 0."""
    z = u.T @ v
    norm = float(np.sqrt(z @ z))
    if rho <= 0 or norm == 0.0:
        return d, u
    z, rho = z / norm, rho * norm * norm
    tol = 8 * EPS * max(abs(d[0]), abs(d[-1]), rho)
    u = u.copy()
    d = d.copy()
    # Equal poles: a reflection puts their part of z in the first of them.
    at, n = 0, len(d)
    while at < n:
        to = at + 1
        while to < n and d[to] - d[to - 1] <= tol:
            to += 1
        if to - at > 1:
            part = z[at:to]
            size = np.sqrt(part @ part)
            if size > 0:
                size = np.copysign(size, part[0])
                h = part.copy()
                h[0] += size
                hh = h @ h
                block = u[:, at:to]
                u[:, at:to] = block - np.outer(block @ h, (2.0 / hh) * h)
                z[at:to] = 0.0
                z[at] = -size
            d[at:to] = d[at:to].mean()
        at = to
    live = np.nonzero(rho * np.abs(z) > tol)[0]
    if len(live):
        dl, zl = d[live], z[live]
        w = rho * zl * zl
        base, x = _secular_roots(dl, w, float(w.sum()))
        # Root minus pole, for each (pole, root), without cancellation.
        diff = (dl[base][None, :] - dl[:, None]) + x[None, :]
        # z that has exactly these roots: a product over roots against other poles.
        k = len(dl)
        between = dl[None, :] - dl[:, None]
        np.fill_diagonal(between, 1.0)
        ratio = diff.copy()
        # Pair root j with pole j for j < i and with pole j + 1 for j >= i, so each factor is near 1.
        i = np.arange(k)[:, None]
        j = np.arange(k)[None, :]
        partner = np.where(j < i, j, np.minimum(j + 1, k - 1))
        below = np.take_along_axis(between, partner, axis=1)
        below = np.where((j == k - 1) & (j >= i), 1.0, below)
        zz = np.abs(np.prod(ratio / below, axis=1))
        zl = np.copysign(np.sqrt(zz), zl)
        q = zl[:, None] / diff
        q /= np.sqrt(np.sum(q * q, axis=0))
        d[live] = dl[base] + x
        u[:, live] = u[:, live] @ q
    order = np.argsort(d, kind="stable")
    return d[order], u[:, order]


class Spectrum:
    """Count, mean and eigenpairs of the centred scatter matrix of the rows added so far."""

    def __init__(self, dim: int):
        self.n, self.mean = 0, np.zeros(dim)
        self.values, self.vectors = np.zeros(dim), np.eye(dim)

    @classmethod
    def of(cls, n: int, mean, values, vectors) -> "Spectrum":
        out = cls(len(mean))
        out.n, out.mean, out.values = n, np.array(mean), np.array(values)
        out.vectors = np.array(vectors).reshape(len(mean), -1)
        return out

    def add(self, x: np.ndarray) -> None:
        gone = x - self.mean
        self.n += 1
        self.mean = self.mean + gone / self.n
        if self.n > 1:
            self.values, self.vectors = rank_one(self.values, self.vectors, gone, (self.n - 1) / self.n)

    def merge(self, other: "Spectrum") -> None:
        if other.n > self.n:
            big, small = other, self
        else:
            big, small = self, other
        n, values, vectors = big.n + small.n, big.values, big.vectors
        gone = small.mean - big.mean
        if big.n and small.n:
            for value, vector in zip(small.values, small.vectors.T):
                if value > 0:
                    values, vectors = rank_one(values, vectors, vector, value)
            values, vectors = rank_one(values, vectors, gone, big.n * small.n / n)
        mean = big.mean + gone * (small.n / n) if n else big.mean
        self.n, self.mean, self.values, self.vectors = n, mean, values, vectors

"""Singular values and right singular vectors of a small square matrix by the qd family.

Householder reflections make it upper bidiagonal, dqds finds all singular values to high relative
accuracy, and twisted factorisations of the tridiagonal B'B - t give a vector for each value wanted.
"""

from __future__ import annotations

import math

import numpy as np

EPS = float(np.finfo(float).eps)
#: Squared off-diagonals below this share of the eigenvalue beside them are taken as zero.
_NEGLIGIBLE = (4 * EPS) ** 2
#: Values closer than this share of their size get vectors that are orthogonalised against each other.
_CLUSTER = 1e-5


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, superdiagonal, right reflectors) of the bidiagonal B with r = U B V'."""
    a = np.array(r, dtype=float)
    n = len(a)
    right = []

    def reflector(x):
        v = x.copy()
        size = np.linalg.norm(x)
        if size == 0 or np.linalg.norm(x[1:]) == 0:
            return None
        v[0] += math.copysign(size, x[0])
        return v / np.linalg.norm(v)

    for k in range(n):
        v = reflector(a[k:, k])
        if v is not None:
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        w = reflector(a[k, k + 1:]) if k + 2 < n else None
        if w is not None:
            a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ w, w)
        right.append(w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def back_transform(vectors: np.ndarray, right: list[np.ndarray]) -> np.ndarray:
    """Right singular vectors of the matrix from those (columns) of its bidiagonal form."""
    out = vectors.copy()
    for k in range(len(right) - 1, -1, -1):
        w = right[k]
        if w is not None:
            out[k + 1:] -= 2 * np.outer(w, w @ out[k + 1:])
    return out


def _lowest_bounds(q: list[float], e: list[float]) -> tuple[float, float]:
    """Bounds of the smallest eigenvalue of B'B, from the pivots of a transform without a shift."""
    d = high = q[0]
    inverse = 1 / d if d else math.inf
    for i in range(len(e)):
        d *= q[i + 1] / (d + e[i])
        high = min(high, d)
        inverse += 1 / d if d else math.inf
    return (0.0 if inverse == math.inf else 1 / inverse), high


def _transform(q: list[float], e: list[float], t: float):
    """One dqds step with shift t: (new q, new e, index of the first negative pivot or None, that pivot)."""
    n = len(q)
    new_q, new_e = [0.0] * n, [0.0] * (n - 1)
    d = q[0] - t
    for i in range(n - 1):
        if d < 0:
            return None, None, i, d
        new_q[i] = d + e[i]
        if new_q[i] == 0:
            return None, None, i, -t
        share = q[i + 1] / new_q[i]
        new_e[i] = e[i] * share
        d = d * share - t
    new_q[-1] = d
    return (new_q, new_e, None, 0.0) if d >= 0 else (None, None, n - 1, d)


def dqds(diagonal: np.ndarray, upper: np.ndarray) -> list[float]:
    """All eigenvalues of B'B, falling: the squared singular values of a bidiagonal B."""
    found: list[float] = []
    stack = [([float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in upper], 0.0)]
    while stack:
        q, e, base = stack.pop()
        while q:
            if len(q) == 1:
                found.append(base + q[0])
                break
            cut = next((i for i in range(len(e) - 1, -1, -1)
                        if e[i] <= _NEGLIGIBLE * (base + min(q[i], q[i + 1])) or e[i] < 1e-290), None)
            if cut is not None:
                stack.append((q[:cut + 1], e[:cut], base))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            if len(q) == 2:
                big = (q[0] + e[0] + q[1] + math.sqrt((q[0] - q[1] + e[0]) ** 2 + 4 * e[0] * q[1])) / 2
                found += [base + big, base + q[0] * (q[1] / big)]
                break
            if q[0] < q[-1]:    # small values come out at the end
                q, e = q[::-1], e[::-1]
            low, high = _lowest_bounds(q, e)
            shift = high if low < high else low * (1 - 4 * EPS)
            while True:
                new_q, new_e, at, pivot = _transform(q, e, shift)
                if at is None:
                    break
                # only the last pivot negative: shift + pivot is a close lower bound of the smallest eigenvalue
                near = shift + pivot if at == len(q) - 1 else low + (shift - low) / 4
                if shift <= low:
                    shift = 0.0 if shift < low / 2 else shift / 4
                else:
                    shift = near if low < near < shift * (1 - 2 * EPS) else low * (1 - 8 * EPS)
            q, e, base = new_q, new_e, base + shift
    return sorted(found, reverse=True)


class Twisted:
    """L D L' - t of a bidiagonal B (B'B = L D L'), factored from both ends and joined at the best row."""

    def __init__(self, diagonal: np.ndarray, upper: np.ndarray, t: float):
        n = len(diagonal)
        d = [float(x) ** 2 for x in diagonal]
        low = [float(b) / float(a) for a, b in zip(diagonal, upper)]
        tiny = max(max(d), 1e-300) * EPS * EPS
        self.down, self.up = [0.0] * (n - 1), [0.0] * (n - 1)
        s, pivots = [-t] + [0.0] * (n - 1), [0.0] * n
        for i in range(n - 1):
            pivots[i] = s[i] + d[i] or tiny
            self.down[i] = low[i] * d[i] / pivots[i]
            s[i + 1] = self.down[i] * low[i] * s[i] - t
        p, ups = [0.0] * (n - 1) + [d[-1] - t], [0.0] * n
        for i in range(n - 2, -1, -1):
            ups[i + 1] = low[i] ** 2 * d[i] + p[i + 1] or tiny
            share = d[i] / ups[i + 1]
            self.up[i] = low[i] * share
            p[i] = p[i + 1] * share - t
        gamma = [a + b + t for a, b in zip(s, p)]
        self.at = min(range(n), key=lambda k: abs(gamma[k]))
        self.pivots = pivots[:self.at] + [gamma[self.at] or tiny] + ups[self.at + 1:]

    def vector(self) -> np.ndarray:
        """The vector with residual gamma at the joining row alone."""
        z = np.zeros(len(self.pivots))
        z[self.at] = 1.0
        return self._spread(z)

    def _spread(self, z: np.ndarray) -> np.ndarray:
        """Solve N' x = z for the twisted factor N."""
        for i in range(self.at - 1, -1, -1):
            z[i] -= self.down[i] * z[i + 1]
        for i in range(self.at, len(z) - 1):
            z[i + 1] -= self.up[i] * z[i]
        return z / np.linalg.norm(z)

    def solve(self, b: np.ndarray) -> np.ndarray:
        """A multiple of (L D L' - t)^-1 b."""
        y = b.copy()
        for i in range(self.at):
            y[i + 1] -= self.down[i] * y[i]
        for i in range(len(y) - 2, self.at - 1, -1):
            y[i] -= self.up[i] * y[i + 1]
        return self._spread(y / np.array(self.pivots))


def right_singular(r: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(squared singular values, right singular vectors as columns, sum of all squared values), largest first.

    At most k of them, and only those above the rounding error of the largest, so that their directions
    mean something. Equal values get any orthonormal vectors of their space.
    """
    n = len(r)
    scale = float(np.abs(r).max()) if n else 0.0
    if scale == 0:
        return np.zeros(0), np.zeros((n, 0)), 0.0
    diagonal, upper, right = bidiagonalise(r / scale)
    size = max(np.abs(diagonal).max(), np.abs(upper).max() if n > 1 else 0.0)
    small = np.abs(diagonal) < size * EPS * EPS
    diagonal[small] = size * EPS * EPS
    # blocks that no off-diagonal joins have their own values, and vectors that are zero elsewhere
    joins = np.abs(upper) > EPS * EPS * size
    edges = [0, *(np.flatnonzero(~joins) + 1).tolist(), n]
    values = []
    for a, b in zip(edges, edges[1:]):
        values += [(t, a, b) for t in dqds(diagonal[a:b], upper[a:b - 1])]
    values.sort(key=lambda v: (-v[0], v[1]))
    total = math.fsum(t for t, _, _ in values)
    floor = values[0][0] * (n * 8 * EPS) ** 2
    chosen = [v for v in values[:k] if v[0] > floor]
    vectors = np.zeros((n, len(chosen)))
    rng = np.random.default_rng(0)
    for j, (t, a, b) in enumerate(chosen):
        # a step of the solver away from the value itself, so that members of a cluster differ
        parts = Twisted(diagonal[a:b], upper[a:b - 1], t)
        near = [i for i in range(j) if chosen[i][1] == a and chosen[i][0] - t <= _CLUSTER * chosen[i][0]]
        z = _orthogonal(parts.vector(), vectors[a:b, near])
        if z is None:
            z = _orthogonal(rng.standard_normal(b - a), vectors[a:b, near])
            for _ in range(4):
                again = _orthogonal(parts.solve(z), vectors[a:b, near])
                z = z if again is None else again
        vectors[a:b, j] = z
    for j in range(len(chosen)):    # leaves vectors as they are but for rounding errors
        vectors[:, j] = _orthogonal(vectors[:, j], vectors[:, :j])
    return np.array([t for t, _, _ in chosen]) * scale ** 2, back_transform(vectors, right), total * scale ** 2


def _orthogonal(z: np.ndarray, others: np.ndarray) -> np.ndarray | None:
    """z without its parts along orthonormal columns, of length 1; None if little of it is left."""
    for _ in range(2):
        z = z - others @ (others.T @ z)
    size = np.linalg.norm(z)
    return z / size if size > 1e-3 else None

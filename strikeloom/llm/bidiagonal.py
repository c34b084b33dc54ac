"""Singular values and right singular vectors of a small square matrix by way of a bidiagonal one.

Householder reflections make the matrix upper bidiagonal, differential quotient-difference steps
with shifts find its singular values to high relative accuracy, and twisted factorisations of the
shifted tridiagonal give the vectors.
"""

import numpy as np

EPS = float(np.finfo(np.float64).eps)
TINY = float(np.finfo(np.float64).tiny)
# Singular values squared within this share of the largest are treated as one cluster.
CLUSTER = 1e-3


def bidiagonalised(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and V with ``U.T @ r @ V`` upper bidiagonal, by Householder reflections."""
    a = np.array(r, np.float64)
    n = len(a)
    v = np.eye(n)
    for k in range(n):
        left = _reflector(a[k:, k])
        a[k:, k:] -= np.outer(left, 2 * (left @ a[k:, k:]))
        if k < n - 2:
            right = _reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= np.outer(2 * (a[k:, k + 1 :] @ right), right)
            v[:, k + 1 :] -= np.outer(2 * (v[:, k + 1 :] @ right), right)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _reflector(x: np.ndarray) -> np.ndarray:
    """The unit vector whose reflection turns ``x`` into a multiple of the first axis."""
    scale = np.abs(x).max(initial=0.0)
    if scale == 0.0:
        return np.zeros_like(x)
    u = x / scale
    u[0] += np.copysign(np.linalg.norm(u), u[0])
    return u / np.linalg.norm(u)


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]] | None:
    """One differential step on squares ``q`` and ``e``: new ones and the pivots; None if the shift is too large."""
    new_q, new_e, pivots = [], [], []
    d = q[0] - shift
    for k in range(len(e)):
        if d < 0.0:
            return None
        pivots.append(d)
        total = d + e[k]
        new_q.append(total)
        if total > TINY:
            share = q[k + 1] / total
            new_e.append(e[k] * share)
            d = d * share - shift
        else:
            new_e.append(0.0)
            d = q[k + 1] - shift
    if d < 0.0:
        return None
    pivots.append(d)
    new_q.append(d)
    return new_q, new_e, pivots


def squared_singular_values(diagonal: np.ndarray, superdiagonal: np.ndarray) -> np.ndarray:
    """Squares of the singular values of an upper bidiagonal matrix, falling."""
    values: list[float] = []
    blocks = [((np.asarray(diagonal) ** 2).tolist(), (np.asarray(superdiagonal) ** 2).tolist(), 0.0)]
    while blocks:
        q, e, moved = blocks.pop()
        while q:
            small = [k for k in range(len(e)) if e[k] <= EPS * EPS * (moved + min(q[k], q[k + 1])) or e[k] < TINY]
            if small:
                cut = small[-1] + 1
                blocks.append((q[:cut], e[: cut - 1], moved))
                q, e = q[cut:], e[cut:]
            if len(q) == 1:
                values.append(moved + q[0])
                break
            # A step without shift gives the diagonal of the inverse, hence a lower bound to shift by.
            q, e, pivots = _step(q, e, 0.0)
            if min(pivots) <= TINY:
                continue
            shift = 1.0 / sum(1.0 / d for d in pivots)
            if shift <= EPS * moved:
                continue
            for portion in (1.0, 0.9, 0.5):
                stepped = _step(q, e, shift * portion)
                if stepped:
                    q, e, _ = stepped
                    moved += shift * portion
                    break
    return np.array(sorted(values, reverse=True))


class Twisted:
    """Factorisation of ``B.T @ B - value`` from both ends, joined where the pivot is smallest."""

    def __init__(self, diagonal: np.ndarray, superdiagonal: np.ndarray, value: float):
        n = len(diagonal)
        q, e = diagonal**2, superdiagonal**2
        off = diagonal[:-1] * superdiagonal
        least = max(EPS * EPS * max(abs(value), float(q.max())), TINY)

        def pivot(x: float) -> float:
            return x if abs(x) > least else (least if x >= 0 else -least)

        down, up, below, above = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
        self.lower, self.upper = np.zeros(n - 1), np.zeros(n - 1)
        below[0] = -value
        for k in range(n - 1):
            down[k] = pivot(below[k] + q[k])
            self.lower[k] = off[k] / down[k]
            below[k + 1] = e[k] * below[k] / down[k] - value
        above[n - 1] = q[n - 1] - value
        for k in range(n - 2, -1, -1):
            up[k + 1] = pivot(e[k] + above[k + 1])
            self.upper[k] = off[k] / up[k + 1]
            # Without a link to what lies beyond, nothing is taken off the square.
            above[k] = q[k] * (above[k + 1] / up[k + 1] if e[k] else 1.0) - value
        joined = below + above + value
        self.twist = r = int(np.abs(joined).argmin())
        self.pivots = np.concatenate([down[:r], [pivot(joined[r])], up[r + 1 :]])

    def vector(self) -> np.ndarray:
        """What the factorisation sends to the twist's axis: the eigenvector where the value is one."""
        start = np.zeros(len(self.pivots))
        start[self.twist] = 1.0
        return self._back(start)

    def solve(self, b: np.ndarray) -> np.ndarray:
        y, r, n = b.copy(), self.twist, len(b)
        for k in range(r):
            if k + 1 < r:
                y[k + 1] -= self.lower[k] * y[k]
        for k in range(n - 1, r + 1, -1):
            y[k - 1] -= self.upper[k - 1] * y[k]
        if r > 0:
            y[r] -= self.lower[r - 1] * y[r - 1]
        if r < n - 1:
            y[r] -= self.upper[r] * y[r + 1]
        return self._back(y / self.pivots)

    def _back(self, z: np.ndarray) -> np.ndarray:
        for k in range(self.twist - 1, -1, -1):
            z[k] -= self.lower[k] * z[k + 1]
        for k in range(self.twist, len(z) - 1):
            z[k + 1] -= self.upper[k] * z[k]
        return z


def right_vectors(diagonal: np.ndarray, superdiagonal: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Orthonormal eigenvectors of ``B.T @ B``, one column for each of the falling ``values``.

    A value apart from all others takes its vector from the twist; one in a cluster is also made
    orthogonal to the cluster's earlier vectors, by inverse iteration where little remains of it.
    """
    found = np.zeros((len(diagonal), len(values)))
    shuffled = np.random.default_rng(0)
    for j, value in enumerate(values):
        near = [i for i in range(j) if values[i] - value <= CLUSTER * values[0]]
        earlier = found[:, near]
        factors = Twisted(diagonal, superdiagonal, value)
        rest = _apart(_unit(factors.vector()), earlier)
        if np.linalg.norm(rest) < 0.5:
            rest = _apart(shuffled.standard_normal(len(diagonal)), earlier)
        z = rest / np.linalg.norm(rest)
        for _ in range(3 if near else 1):
            solved = factors.solve(z)
            if not np.all(np.isfinite(solved)):
                break
            rest = _apart(_unit(solved), earlier)
            if np.linalg.norm(rest) < EPS:
                break
            z = rest / np.linalg.norm(rest)
        found[:, j] = z
    return found


def _unit(z: np.ndarray) -> np.ndarray:
    z = z / max(np.abs(z).max(), TINY)
    return z / np.linalg.norm(z)


def _apart(z: np.ndarray, earlier: np.ndarray) -> np.ndarray:
    """``z`` without its share along orthonormal columns, taken off twice against rounding."""
    for _ in range(2):
        z = z - earlier @ (earlier.T @ z)
    return z


def top_singular(r: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest singular values squared, falling, and their right vectors as columns."""
    diagonal, superdiagonal, v = bidiagonalised(r)
    values = squared_singular_values(diagonal, superdiagonal)[:k]
    return values, v @ right_vectors(diagonal, superdiagonal, values)

"""Eigendecomposition of a scatter matrix, kept up to date by rank-one updates.

``Spectrum`` holds the number of vectors, their mean, and the eigenvalues and
eigenvectors of the sum of (x - mean)(x - mean)'. A further vector, or another
spectrum, changes that sum by rank-one terms, whose new eigenvalues are the
roots of a secular equation between the old ones.
"""

from __future__ import annotations

import io

import numpy as np

EPS = float(np.finfo(np.float64).eps)
#: Updates after which the eigenvectors are made orthonormal again.
FRESHEN = 512
ROOT_ROUNDS = 80


def secular_roots(poles: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Differences pole_j - root_i (row i) for the roots of 1 + sum_j weights_j / (pole_j - root) = 0.

    ``poles`` ascend strictly and ``weights`` are positive, so there is one root
    above each pole, the last within sum(weights) of its pole. A root is held as
    a distance from the nearer pole, so differences keep their relative
    precision. Each round fits one simple pole on either side of the root
    (values and slopes agree) and falls back to halving the bracket.
    """
    m = len(poles)
    gap = np.append(np.diff(poles), weights.sum())
    row = np.arange(m)
    below = np.tri(m)  # poles at or under root i
    above = 1.0 - below
    middle = poles[None, :] - (poles + gap / 2)[:, None]
    right = 1.0 + (weights / middle).sum(axis=1) < 0
    right[-1] = False
    origin = np.where(right, np.minimum(row + 1, m - 1), row)
    base = poles[None, :] - poles[origin][:, None]
    low, high = np.where(right, -gap / 2, 0.0), np.where(right, 0.0, gap / 2)
    high[-1] = gap[-1]
    tau = (low + high) / 2
    left_pole = base[row, row]
    right_pole = np.append(base[row[:-1], row[:-1] + 1], np.inf)
    with np.errstate(all="ignore"):
        for _ in range(ROOT_ROUNDS):
            away = base - tau[:, None]
            terms = weights / away
            slopes = terms / away
            psi, phi = np.einsum("ij,ij->i", terms, below), np.einsum("ij,ij->i", terms, above)
            value = 1.0 + psi + phi
            found = np.abs(value) <= 4 * EPS * m * (1.0 - psi + phi)
            if found.all():
                break
            low, high = np.where(value < 0, tau, low), np.where(value > 0, tau, high)
            dpsi, dphi = np.einsum("ij,ij->i", slopes, below), np.einsum("ij,ij->i", slopes, above)
            a, b = left_pole - tau, right_pole - tau
            rest = value - a * dpsi - b * dphi
            rest[-1] = value[-1] - a[-1] * dpsi[-1]
            linear = (a + b) * value - a * b * dpsi - a * b * dphi
            root = np.sqrt(np.maximum(linear * linear - 4 * a * b * value * rest, 0.0))
            step = np.where(linear <= 0, (linear - root) / (2 * rest), 2 * a * b * value / (linear + root))
            step[-1] = a[-1] + a[-1] ** 2 * dpsi[-1] / rest[-1]
            new = tau + step
            tau = np.where(found, tau, np.where((new >= low) & (new <= high) & (new != 0), new, (low + high) / 2))
    return base - tau[:, None]


class Spectrum:
    """n vectors, their mean, ascending eigenvalues and eigenvectors (columns) of their centred scatter."""

    def __init__(self, size: int):
        self.n = 0
        self.mean = np.zeros(size)
        self.values = np.zeros(size)
        self.vectors = np.eye(size)
        self._updates = 0

    def add(self, x: np.ndarray) -> None:
        """One more vector."""
        away = x - self.mean
        self.n += 1
        self.mean = self.mean + away / self.n
        if self.n > 1:
            self.update(away * np.sqrt((self.n - 1) / self.n))

    def merge(self, other: Spectrum) -> None:
        """All vectors of another spectrum: one update per eigenpair, one for the distance of the means."""
        if not other.n:
            return
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self.update(np.sqrt(value) * vector)
        away, n = other.mean - self.mean, self.n + other.n
        self.update(away * np.sqrt(self.n / n * other.n))
        self.mean = self.mean + away * (other.n / n)
        self.n = n

    def update(self, v: np.ndarray) -> None:
        """Eigenpairs after v v' has been added to the matrix."""
        z = self.vectors.T @ v
        size = float(z @ z)
        if size == 0.0:
            return
        values, vectors = self.values, self.vectors
        tolerance = 8 * EPS * max(abs(values[-1]), size)
        # deflation: equal eigenvalues share one direction that the update meets
        if np.any(np.diff(values) <= tolerance):
            vectors, start = vectors.copy(), 0
            while start < len(values):
                end = int(np.searchsorted(values, values[start] + tolerance, side="right"))
                if end - start > 1 and np.any(z[start : end - 1]):
                    part = z[start:end]
                    length = float(np.linalg.norm(part))
                    mirror = part.copy()
                    mirror[-1] += length if mirror[-1] >= 0 else -length
                    mirror /= np.linalg.norm(mirror)
                    block = vectors[:, start:end]
                    vectors[:, start:end] = block - 2 * np.outer(block @ mirror, mirror)
                    z[start : end - 1], z[end - 1] = 0.0, -length if part[-1] >= 0 else length
                start = end
        # and a direction that the update hardly meets stays as it is
        met = np.abs(z) * np.sqrt(size) > tolerance
        if not met.any():
            return
        poles, part = values[met], z[met]
        away = secular_roots(poles, part * part)  # pole_j - root_i
        roots = poles - np.diagonal(away)
        # weights for which these roots are exact: the vectors come out orthogonal
        spread = poles[None, :] - poles[:, None]
        np.fill_diagonal(spread, 1.0)
        ratio = -away / np.where(spread == 0, 1.0, spread).T
        np.fill_diagonal(ratio, -np.diagonal(away))
        exact = np.sqrt(np.abs(np.prod(ratio, axis=0)))
        turn = np.where(part < 0, -exact, exact) / away  # row i: direction of root i
        turn /= np.linalg.norm(turn, axis=1)[:, None]
        new_values, new_vectors = values.copy(), vectors.copy()
        new_values[met], new_vectors[:, met] = roots, vectors[:, met] @ turn.T
        order = np.argsort(new_values, kind="stable")
        self.values, self.vectors = np.maximum(new_values[order], 0.0), new_vectors[:, order]
        self._updates += 1
        if self._updates % FRESHEN == 0:
            self.vectors = orthonormal(self.vectors)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, n=np.int64(self.n), mean=self.mean, values=self.values, vectors=self.vectors)
        return out.getvalue()

    @staticmethod
    def from_bytes(data: bytes) -> Spectrum:
        stored = np.load(io.BytesIO(data))
        out = Spectrum(len(stored["mean"]))
        out.n, out.mean, out.values, out.vectors = int(stored["n"]), stored["mean"], stored["values"], stored["vectors"]
        return out


def orthonormal(columns: np.ndarray) -> np.ndarray:
    q, r = np.linalg.qr(columns)
    return q * np.where(np.diagonal(r) < 0, -1.0, 1.0)

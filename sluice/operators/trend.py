"""One series' seasonal-trend fit: level, slope, few slope changes, season.

Plain numpy over one series (a few hundred months at most); ``forecast.py``
runs it per group on Spark.

The fit is the most likely one under a Laplace prior on each slope change and a
normal prior on each season term, y scaled by its largest size: with noise
variance s2 it minimises

    ||y - Xb||^2 / 2 + sum_j l1_j |b_j| + sum_j l2_j b_j^2 / 2

where ``l1`` is s2 / scale for slope changes and ``l2`` is s2 / scale^2 for season
terms. Level and slope are free. Most slope changes come out exactly zero.
"""

from __future__ import annotations

import functools
import math
from statistics import NormalDist

import numpy as np

#: The noise is that of the fit before, until it stays; the scaled series has this much variance at least.
NOISE_ROUNDS = 25
LEAST_NOISE = 1e-4
#: Futures drawn for a band, in pairs of opposite sign.
FUTURES = 1000


def knots_of(t: np.ndarray, most: int, share: float) -> np.ndarray:
    """Places where the trend may change: spread over the first ``share`` of the training months ``t``, which end at 1."""
    early = int(len(t) * share)
    count = min(most, max(0, early - 1))
    return t[np.linspace(0, early - 1, count + 1).round().astype(int)][1:] if count else np.zeros(0)


def design(days: np.ndarray, span: float, knots: np.ndarray, period: float, order: int) -> np.ndarray:
    """Columns: level, slope, slope changes, sine and cosine pairs."""
    t = days / span
    angles = [2.0 * math.pi * k * days / period for k in range(1, order + 1)]
    columns = [np.ones_like(t), t, *[np.maximum(0.0, t - c) for c in knots]]
    return np.column_stack(columns + [f(a) for a in angles for f in (np.sin, np.cos)])


def weights(knots: int, order: int, change_scale: float, season_scale: float, noise: float) -> tuple[np.ndarray, np.ndarray]:
    """(l1, l2) of each column of the design."""
    l1 = np.array([0.0, 0.0] + [noise / change_scale] * knots + [0.0] * (2 * order))
    l2 = np.array([0.0, 0.0] + [0.0] * knots + [noise / season_scale**2] * (2 * order))
    return l1, l2


def sparse_solve(x: np.ndarray, y: np.ndarray, l1: np.ndarray, l2: np.ndarray) -> np.ndarray:
    """The minimum of ||y - xb||^2 / 2 + sum l1 |b| + sum l2 b^2 / 2, by active signs.

    Columns without an L1 weight are always active. The idle column that breaks
    its bound most joins with its sign; the active ones then move to the solution
    under their signs, stopping at the best point where one of them meets zero
    (it turns idle). Every move lowers the objective, so no state comes twice.
    """
    gram, c = x.T @ x + np.diag(l2), x.T @ y
    b, sign, active = np.zeros(len(c)), np.zeros(len(c)), l1 == 0
    bound = 1e-10 * (1.0 + np.abs(c).max(initial=0.0))

    def objective(v: np.ndarray) -> float:
        return float(v @ gram @ v / 2 - c @ v + l1 @ np.abs(v))

    def settle() -> None:
        nonlocal b, sign, active
        while active.any():
            at = np.flatnonzero(active)
            goal = np.zeros_like(b)
            goal[at] = np.linalg.lstsq(gram[np.ix_(at, at)], c[at] - l1[at] * sign[at], rcond=1e-14)[0]
            crossed = at[(l1[at] > 0) & (b[at] * goal[at] < 0)]
            points = [goal]
            for j, share in zip(crossed, b[crossed] / (b[crossed] - goal[crossed]), strict=True):
                point = b + share * (goal - b)
                point[j] = 0.0
                points.append(point)
            best = min(range(len(points)), key=lambda i: objective(points[i]))
            b = points[best]
            active &= (l1 == 0) | (b != 0)
            sign = np.where(active & (l1 > 0), np.sign(b), 0.0)
            if best == 0 and not len(crossed):
                return

    settle()
    for _ in range(40 * len(c) + 40):
        pull = c - gram @ b
        excess = np.where(active, -1.0, np.abs(pull) - l1)
        j = int(np.argmax(excess))
        if excess[j] <= bound:
            break
        active[j], sign[j] = True, np.sign(pull[j])
        settle()
    return b


def fit(x: np.ndarray, y: np.ndarray, knots: int, order: int, change_scale: float, season_scale: float, noise: float | None = None) -> tuple[np.ndarray, float]:
    """Coefficients and the noise variance that they were fitted with; a given ``noise`` stays as it is."""
    if noise is not None:
        return sparse_solve(x, y, *weights(knots, order, change_scale, season_scale, noise)), noise
    line = np.linalg.lstsq(x[:, :2], y, rcond=None)[0]
    noise = max(float(np.mean((y - x[:, :2] @ line) ** 2)), LEAST_NOISE)
    for _ in range(NOISE_ROUNDS):
        b = sparse_solve(x, y, *weights(knots, order, change_scale, season_scale, noise))
        used, noise = noise, max(float(np.mean((y - x @ b) ** 2)), LEAST_NOISE)
        if abs(noise - used) <= 1e-9 * used:
            break
    return b, used


def spread(x: np.ndarray, y: np.ndarray, b: np.ndarray, l2: np.ndarray) -> float:
    """Standard deviation around the fit, by the degrees of freedom that its active columns leave."""
    at = np.flatnonzero((b != 0) | (np.arange(len(b)) < 2))
    part = x[:, at]
    gram = part.T @ part
    taken = float(np.trace(np.linalg.lstsq(gram + np.diag(l2[at]), gram, rcond=1e-14)[0]))
    return math.sqrt(float(np.sum((y - x @ b) ** 2)) / max(len(y) - taken, 1.0))


@functools.cache
def _normal_steps(n: int) -> np.ndarray:
    """Normal values in equal steps of probability."""
    return np.array([NormalDist().inv_cdf((i + 0.5) / n) for i in range(n)])


def band(t: np.ndarray, changes: np.ndarray, sd: float, width: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of the band that holds a share ``width`` of simulated values, at times ``t`` (training ends at 1).

    Values differ from the fit by noise and, after 1, by future slope changes:
    as many per unit of time as the fit had places for, at random times, of
    Laplace size with the mean size of the fitted ones. Each drawn future is
    met by its mirror image, so the band is even around the fit.
    """
    random = np.random.default_rng(seed)
    half = FUTURES // 2
    noise = sd * random.permutation(_normal_steps(half))
    end = max(float(t.max(initial=1.0)), 1.0)
    counts = random.poisson(len(changes) * (end - 1.0), half)
    future = np.repeat(np.arange(half), counts)
    when = 1.0 + (end - 1.0) * random.random(len(future))
    size = random.laplace(0.0, float(np.abs(changes).mean()) if len(changes) else 0.0, len(future))
    off = np.zeros((half, len(t)))
    np.add.at(off, future, size[:, None] * np.maximum(0.0, t[None, :] - when[:, None]))
    off += noise[:, None]
    off = np.concatenate([off, -off])
    return np.quantile(off, 0.5 - width / 2, axis=0), np.quantile(off, 0.5 + width / 2, axis=0)

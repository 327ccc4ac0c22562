import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.operators import trend


def broken(x, y, b, l1, l2):
    """Largest violation of the conditions at the minimum."""
    pull = x.T @ (y - x @ b) - l2 * b
    return np.where(b != 0, np.abs(pull - l1 * np.sign(b)), np.maximum(np.abs(pull) - l1, 0)).max()


def by_coordinates(x, y, l1, l2, rounds=20_000):
    """The same minimum by plain coordinate descent."""
    b, size = np.zeros(x.shape[1]), (x * x).sum(axis=0)
    for _ in range(rounds):
        before = b.copy()
        for j in range(len(b)):
            if size[j] + l2[j] == 0:
                continue
            pull = x[:, j] @ (y - x @ b) + size[j] * b[j]
            b[j] = np.sign(pull) * max(abs(pull) - l1[j], 0) / (size[j] + l2[j])
        if np.abs(b - before).max() < 1e-14:
            break
    return b


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.integers(3, 12), st.integers(1, 6), st.floats(0.001, 3.0))
def test_sparse_solve_meets_the_conditions(seed, rows, columns, weight):
    r = np.random.default_rng(seed)
    x, y = r.normal(size=(rows, columns)), r.normal(size=rows)
    l1 = np.where(r.random(columns) < 0.6, weight, 0.0)
    l2 = np.where(l1 == 0, 0.05, 0.0)
    b = trend.sparse_solve(x, y, l1, l2)
    assert broken(x, y, b, l1, l2) < 1e-8
    other = by_coordinates(x, y, l1, l2)

    def value(v):
        return ((y - x @ v) ** 2).sum() / 2 + l1 @ np.abs(v) + (l2 * v * v).sum() / 2

    assert value(b) <= value(other) + 1e-9


@pytest.mark.parametrize("n", [4, 12, 33, 78, 240])
def test_fits_of_long_and_short_series_meet_the_conditions(n):
    r = np.random.default_rng(n)
    days = np.arange(n) * 30.4
    span = max(days[-1], 1.0)
    knots = trend.knots_of(days / span, 25, 0.8)
    x = trend.design(days, span, knots, 91.25, 3)
    y = 0.5 + 0.1 * r.normal(size=n).cumsum() / 3
    b, noise = trend.fit(x, y, len(knots), 3, 0.05, 10.0)
    l1, l2 = trend.weights(len(knots), 3, 0.05, 10.0, noise)
    assert broken(x, y, b, l1, l2) < 1e-8 and noise >= trend.LEAST_NOISE


def test_repeated_columns_and_a_constant_series():
    x = np.column_stack([np.ones(6), np.arange(6.0), np.arange(6.0), np.arange(6.0)])
    y = np.full(6, 0.7)
    l1 = np.array([0, 0, 0.1, 0.1])
    b = trend.sparse_solve(x, y, l1, np.zeros(4))
    assert broken(x, y, b, l1, np.zeros(4)) < 1e-9 and b[2:].tolist() == [0, 0]


def test_spread_uses_the_effective_parameters():
    r = np.random.default_rng(5)
    days = np.arange(200) * 30.4
    x = trend.design(days, days[-1], np.array([0.5]), 91.25, 1)
    y = 1 + 0.1 * r.standard_normal(200)
    b = np.array([1.0, 0.0, 0.0, 0.0, 0.0])
    sse = ((y - 1) ** 2).sum()
    # the bend that is zero takes no degree of freedom
    assert abs(trend.spread(x, y, b, np.zeros(5)) - np.sqrt(sse / 198)) < 1e-12


def test_a_band_without_bends_is_the_noise_and_with_bends_widens():
    t = np.array([0.2, 1.0, 1.1, 1.5, 2.0])
    low, high = trend.band(t, np.zeros(10), 2.0, 0.8, 1)
    np.testing.assert_allclose(high, 2.0 * 1.2816, rtol=0.1)
    np.testing.assert_allclose(low, -high)
    assert np.ptp(high) == 0
    low, high = trend.band(t, np.full(10, 3.0), 0.1, 0.8, 1)
    assert high[0] == high[1] and (np.diff(high[1:]) > 0).all()
    # simulated futures against their exact variance: rate * 2 size^2 * integral of (T - u)^2
    sd = np.sqrt(0.1**2 + 10 * 2 * 3.0**2 / 3)
    np.testing.assert_allclose(high[-1], 1.2816 * sd, rtol=0.12)

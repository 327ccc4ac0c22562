import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import whitening
from sluice.llm.spectrum import Spectrum, secular_roots

KINDS = {
    "normal": lambda r: r.normal(size=(300, 12)) * 300 + 1e5,
    "graded": lambda r: r.normal(size=(200, 9)) * 10.0 ** -np.arange(9),
    "repeats": lambda r: np.repeat(r.normal(size=(4, 10)), 30, 0),
    "integers": lambda r: r.integers(0, 2, (200, 7)).astype(float),
    "line": lambda r: np.outer(r.normal(size=80), np.ones(8)),
    "axes": lambda r: np.eye(11)[r.integers(0, 11, 150)],
    "one dimension": lambda r: r.normal(size=(60, 1)),
    "equal": lambda r: np.ones((20, 5)) * 7,
}


def scatter(x):
    y = x - x.mean(axis=0)
    return y.T @ y


def spectrum(x):
    out = Spectrum(x.shape[1])
    for row in x:
        out.add(row)
    return out


def close(kept, x):
    whole = scatter(x)
    size = max(np.abs(whole).max(), 1e-300)
    assert kept.n == len(x)
    np.testing.assert_allclose(kept.mean, x.mean(axis=0), rtol=1e-12, atol=1e-12)
    assert np.abs(kept.vectors.T @ kept.vectors - np.eye(x.shape[1])).max() < 1e-12
    assert np.abs(kept.vectors @ np.diag(kept.values) @ kept.vectors.T - whole).max() < 1e-11 * size


@pytest.mark.parametrize("kind", KINDS)
def test_rank_one_updates_keep_the_eigenpairs_of_the_scatter(kind):
    x = KINDS[kind](np.random.default_rng(3))
    close(spectrum(x), x)


@pytest.mark.parametrize("kind", KINDS)
def test_spectra_of_parts_combine_to_that_of_the_whole(kind):
    x = KINDS[kind](np.random.default_rng(4))
    first, *others = [spectrum(part) for part in np.array_split(x, [0, 1, 7, len(x) // 2])]
    for other in others:
        first.merge(Spectrum.from_bytes(other.to_bytes()))
    close(first, x)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 1e6), st.floats(1e-6, 1e3)), min_size=1, max_size=12, unique_by=lambda p: round(p[0], 2)))
def test_secular_roots_lie_between_their_poles_and_solve_the_equation(pairs):
    pairs.sort()
    poles, weights = map(np.array, zip(*pairs))
    away = secular_roots(poles, weights)
    roots = poles - np.diagonal(away)
    assert (np.diagonal(away) < 0).all()
    assert (roots[:-1] <= poles[1:]).all() and roots[-1] <= (poles[-1] + weights.sum()) * (1 + 1e-14)
    expected = np.linalg.eigvalsh(np.diag(poles) + np.sqrt(weights)[:, None] * np.sqrt(weights))
    np.testing.assert_allclose(roots, expected, rtol=1e-11, atol=1e-9)


def brute(rows, most=8):
    """Plain version over (vec_id, vector) rows."""
    ok = [(i, v) for i, v in rows if v and all(e is not None and math.isfinite(e) for e in v)]
    x = np.array([[math.floor(1024 * e) + 100000 for e in v] for _, v in ok], dtype=np.int64)
    n, sums = len(x), x.sum(axis=0)
    values, vectors = np.linalg.eigh(np.cov(x.T, bias=True))
    values, vectors = values[::-1], vectors[:, ::-1]
    white = ((x - sums / n) @ vectors[:, :most]) / np.sqrt(values[:most])
    return [i for i, _ in ok], n, ((n * x - sums) ** 2).sum(axis=1), white, values / values.sum()


@pytest.mark.parametrize("partitions", [1, 5])
def test_whitening_equals_the_plain_version(spark, partitions):
    r = np.random.default_rng(8)
    rows = [(i, (r.normal(size=12) * (1 + np.arange(12) / 3)).tolist()) for i in range(120)]
    rows += [(200, None), (201, []), (202, [None] * 12), (203, [math.nan] + [0.0] * 11), (204, [math.inf] + [0.0] * 11)]
    rows += [rows[3], rows[3]]
    frame = spark.createDataFrame([(i, v, "x", 9, 1) for i, v in rows], "vec_id long, embedding array<float>, whitened string, component int, n int")
    rows = [(r_.vec_id, r_.embedding) for r_ in frame.collect()]
    out = whitening.whiten_embeddings(frame.repartition(partitions)).toPandas()
    ids, n, deviation, white, explained = brute(rows)
    assert out.columns.tolist() == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert len(out) == 8 * len(ids) and set(out["n"]) == {n}
    assert out["identity_error"].nunique() == 1 and out["identity_error"].iloc[0] < 1e-9
    for k in range(8):
        part = out[out["component"] == k + 1].sort_values(["vec_id"])
        order = np.argsort(ids, kind="stable")
        assert part["vec_id"].tolist() == sorted(ids)
        assert part["deviation"].tolist() == deviation[order].tolist()
        np.testing.assert_allclose(part["explained"], explained[k], rtol=1e-9)
        got, want = part["whitened"].to_numpy(), white[order, k]
        np.testing.assert_allclose(got * np.sign(got[0]), want * np.sign(want[0]), rtol=1e-6, atol=1e-9)


def test_fewer_dimensions_than_components_and_repeated_rows(spark):
    frame = spark.createDataFrame([(1, [0.0, 1.0]), (1, [0.0, 1.0]), (None, [1.0, 5.0]), (2, [2.0, -1.0])], "vec_id long, embedding array<double>")
    out = whitening.whiten_embeddings(frame).toPandas()
    assert sorted(out["component"]) == [1] * 4 + [2] * 4 and set(out["n"]) == {4}
    assert out["vec_id"].isna().sum() == 2
    for _, part in out.groupby("component"):
        assert abs(part["whitened"].mean()) < 1e-9 and abs((part["whitened"] ** 2).mean() - 1) < 1e-9


@pytest.mark.parametrize(
    "rows",
    [[], [(1, None)], [(1, [0.5, 0.25])], [(1, [0.5, 0.25]), (2, [0.5, 0.25]), (3, [0.5, 0.25])]],
    ids=["no rows", "no vectors", "one vector", "equal vectors"],
)
def test_without_spread_there_are_no_components(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = whitening.whiten_embeddings(frame)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert out.count() == 0


def test_the_commonest_length_counts(spark):
    rows = [(i, [float(i), float(i * i % 7)]) for i in range(6)] + [(9, [1.0]), (10, [1.0, 2.0, 3.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted({r.vec_id for r in whitening.whiten_embeddings(frame).collect()}) == list(range(6))


def test_exact_deviations_beyond_64_bits():
    x = np.array([[1 << 45, 3], [-(1 << 45), 5]], np.int64)
    sums = tuple(int(s) for s in x.sum(axis=0))
    n = 1 << 20
    away = whitening._exact_deviations(x, n, sums)
    assert away.tolist() == [[n * int(a) - s for a, s in zip(row, sums)] for row in x]
    assert whitening._square_sums(away) == [None, None]
    near = np.array([[1 << 31, 1]], np.int64)
    assert whitening._square_sums(near) == [(1 << 62) + 1]

"""Whitening of embeddings by an incremental eigendecomposition.

Each task keeps the spectrum of its own vectors by centred rank-one updates
(``spectrum.py``); the spectra are combined by further rank-one updates, in two
rounds of groups. The combined eigenvectors are a basis near the true one: a
last distributed pass projects every centred vector on it, sums the products of
the projections, and the eigenvectors of that small matrix turn the basis to
its final place (Rayleigh-Ritz). Only matrices of dimension x dimension reach
the driver.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import Scratch
from sluice.llm.partials import gathered, partial_results
from sluice.llm.spectrum import EPS, Spectrum, orthonormal

#: Entries become floor(SCALE * entry) + SHIFT, so that sums are exact.
SCALE = 1024
SHIFT = 100_000
#: An entry must stay below this, so that its integer and sums over a batch fit in 64 bits.
LARGEST = float(1 << 37)
ROWS_AT_ONCE = 4096


@dataclass(frozen=True)
class Whitening:
    """n vectors with exact sums per dimension; unit eigenvectors (columns) of their covariance by falling eigenvalue."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def components(self, most: int) -> int:
        """Components of an eigenvalue above rounding, ``most`` at most."""
        floor = len(self.values) * EPS * max(float(self.values[0]), 0.0) if len(self.values) else 0.0
        return int(min(most, (self.values > floor).sum()))

    def projections(self, centred: np.ndarray, most: int) -> np.ndarray:
        """Whitened coordinates of centred vectors (rows)."""
        k = self.components(most)
        return (centred @ self.vectors[:, :k]) / np.sqrt(self.values[:k])


def integer_vectors(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    """(vec_id, x): usable vectors as long integers.

    Left out are null and empty vectors and those with an entry that is null, not
    finite or beyond ``LARGEST``. All others must have one length; of several the
    commonest counts (of equally common ones the largest) and the rest are left
    out as well. Repeated rows and ids stay; an id may be null.
    """
    entry = F.col("_entries")

    def usable(e: Column) -> Column:
        return F.coalesce(~F.isnan(e) & (F.abs(e) < F.lit(LARGEST)), F.lit(False))

    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("_entries"))
    rows = rows.where(entry.isNotNull() & (F.size(entry) > 0) & F.forall(entry, usable))
    return rows.select("vec_id", F.transform(entry, lambda e: F.floor(e * SCALE) + F.lit(SHIFT).cast("long")).alias("x"))


def of_one_length(rows: DataFrame) -> tuple[DataFrame, int]:
    """The rows of the commonest vector length, and that length (0 without rows)."""
    top = rows.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    size = int(top["length"]) if top else 0
    return rows.where(F.size("x") == size), size


def _matrices(batches: Iterator[pa.RecordBatch], size: int, column: str = "x") -> Iterator[np.ndarray]:
    for batch in batches:
        flat = batch.column(column).flatten().to_numpy(zero_copy_only=False)
        matrix = flat.reshape(-1, size)
        for at in range(0, len(matrix), ROWS_AT_ONCE):
            yield matrix[at : at + ROWS_AT_ONCE]


def _exact_deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n * x - S, as 64-bit integers where they fit, else as Python's."""
    far = int(np.abs(x).max(initial=0))
    if n * far < 1 << 62:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    return _exact_deviations(x, n, sums).astype(np.float64) / n


def _square_sums(deviations: np.ndarray) -> list[int | None]:
    """Sum of squares of each row, exactly; None beyond 64 bits."""
    far = int(np.abs(deviations).max(initial=0))
    if deviations.dtype != object and far * far * deviations.shape[1] < 1 << 62:
        return (deviations * deviations).sum(axis=1).tolist()
    exact = [sum(int(v) ** 2 for v in row) for row in deviations]
    return [v if v < 1 << 63 else None for v in exact]


def _matrix_sum(payloads: list[bytes]) -> bytes:
    return np.sum([np.frombuffer(p) for p in payloads], axis=0).tobytes()


def exact_sums(rows: DataFrame, size: int) -> tuple[int, tuple[int, ...]]:
    """Number of vectors and their exact sum in each dimension."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterable[tuple[int, bytes]]:
        n, sums = 0, [0] * size
        for x in _matrices(batches, size):
            n += len(x)
            sums = [a + int(b) for a, b in zip(sums, x.sum(axis=0), strict=True)]
        if n:
            yield 0, json.dumps([n, *sums]).encode()

    def combine(payloads: list[bytes]) -> bytes:
        return json.dumps([sum(c) for c in zip(*map(json.loads, payloads), strict=True)]).encode()

    found = gathered(partial_results(rows.select("x"), of_task), combine)
    n, *sums = json.loads(found[0]) if found else [0] * (size + 1)
    return n, tuple(sums)


def spectrum_of(rows: DataFrame, size: int) -> Spectrum:
    """Spectrum of all vectors by rank-one updates, task by task and then across tasks."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterable[tuple[int, bytes]]:
        kept = Spectrum(size)
        for x in _matrices(batches, size):
            for row in x.astype(np.float64):
                kept.add(row)
        if kept.n:
            yield 0, kept.to_bytes()

    def combine(payloads: list[bytes]) -> bytes:
        first, *others = map(Spectrum.from_bytes, payloads)
        for other in others:
            first.merge(other)
        return first.to_bytes()

    found = gathered(partial_results(rows.select("x"), of_task), combine)
    return Spectrum.from_bytes(found[0]) if found else Spectrum(size)


def fit(rows: DataFrame, size: int) -> Whitening:
    """Mean, covariance eigenpairs and trace of ``rows`` (x: arrays of ``size`` longs); divisor n."""
    n, sums = exact_sums(rows, size)
    if not n:
        return Whitening(0, (0,) * size, np.zeros(size), np.eye(size), 0.0)
    basis = orthonormal(spectrum_of(rows, size).vectors[:, ::-1])

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterable[tuple[int, bytes]]:
        products = np.zeros((size, size))
        for x in _matrices(batches, size):
            on_basis = _centred(x, n, sums) @ basis
            products += on_basis.T @ on_basis
        yield 0, products.tobytes()

    found = gathered(partial_results(rows.select("x"), of_task), _matrix_sum)
    projected = np.frombuffer(found[0]).reshape(size, size) / n
    values, turn = np.linalg.eigh((projected + projected.T) / 2)
    return Whitening(n, sums, values[::-1].copy(), basis @ turn[:, ::-1], float(np.trace(projected)))


def identity_error(rows: DataFrame, size: int, model: Whitening, most: int) -> float:
    """Largest absolute entry of the whitened vectors' covariance less the identity, measured over all rows."""
    k = model.components(most)
    if not k:
        return 0.0

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterable[tuple[int, bytes]]:
        sums = np.zeros((k + 1, k))
        for x in _matrices(batches, size):
            white = model.projections(_centred(x, model.n, model.sums), most)
            sums[:k] += white.T @ white
            sums[k] += white.sum(axis=0)
        yield 0, sums.tobytes()

    found = gathered(partial_results(rows.select("x"), of_task), _matrix_sum)
    found = np.frombuffer(found[0]).reshape(k + 1, k) / model.n
    return float(np.abs(found[:k] - np.outer(found[k], found[k]) - np.eye(k)).max())


def whitened(rows: DataFrame, size: int, model: Whitening, most: int) -> DataFrame:
    """(vec_id, deviation, whitened array): each vector's exact distance from the mean and its whitened coordinates."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
                away = _exact_deviations(x, model.n, model.sums)
                white = model.projections(away.astype(np.float64) / model.n, most)
                lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * white.shape[1], pa.array(white.ravel()))
                columns = [part.column("vec_id"), pa.array(_square_sums(away), pa.int64()), lists]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "deviation", "whitened"])

    return rows.select("vec_id", "x").mapInArrow(apply, "vec_id long, deviation long, whitened array<double>")


def whiten_embeddings(
    vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", most: int = 8, scratch: Scratch | None = None
) -> DataFrame:
    """One row per usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    ``integer_vectors`` states which vectors are usable. Components whose
    eigenvalue is zero up to rounding have no whitened form and are left out, so
    equal vectors, a single one or none give no rows. ``deviation`` is null where
    it exceeds a long. Other columns of ``vectors`` are not read.
    """
    scratch = scratch or Scratch(vectors.sparkSession, "whitening")
    rows, size = of_one_length(scratch.store(integer_vectors(vectors, id_column, column), "integers"))
    model = fit(rows, size)
    error = identity_error(rows, size, model, most)
    parts = [float(v) / model.trace if model.trace else 0.0 for v in model.values[: model.components(most)]]
    explained = F.array(*map(F.lit, parts)).cast("array<double>")
    wide = whitened(rows, size, model, most)
    long = wide.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return long.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )

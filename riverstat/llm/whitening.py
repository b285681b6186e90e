"""Whitened embeddings: principal components scaled to unit variance.

A vector's components c become whole numbers x = floor(1024 c) + 100000. Their sums are exact; the scatter is summed from
centred numbers, a matrix a task and then by rows of the matrix, and has the size of the dimension squared, whatever the
number of vectors. Its pivoted Cholesky factor L (the largest remaining diagonal entry first, until nothing but rounding is
left) has V = L L'. One-sided Jacobi rotates pairs of columns of L until all are orthogonal; then the squared norms of the
columns are the eigenvalues of V and the columns, normalised, its unit eigenvectors. V is never squared or diagonalised
itself, so small eigenvalues keep their digits. All vectors are then projected; the covariance of the result is measured
over all of them and its distance from the identity is returned with every row.

Defined cases: vectors that are null, empty or hold null or non-finite entries (or entries whose x needs more than 53 bits)
give no rows; where lengths differ, those of the most frequent length take part (of the greatest among equals); a null or
repeated vec_id is a vector like any other; components without variance beyond rounding are left out, so equal vectors
or an empty table give no rows; ties between eigenvalues are broken by the factor, alike for all rows; other columns are
ignored. `deviation` is exact; where it does not fit a long, the job fails instead of returning another number.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

SCALE, SHIFT = 1024, 100_000
_MOST = 2.0 ** 53 - SHIFT

# Partial matrices whose rows are added up in one place at first.
_FAN_IN = 256


def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """L, as many columns as the matrix has rank, with L L' = matrix; rows of L in the matrix's order."""
    rest = matrix.copy()
    n = len(rest)
    columns: list[np.ndarray] = []
    floor = n * np.finfo(float).eps * max(rest.diagonal().max(initial=0.0), 0.0)
    while len(columns) < n:
        pivot = int(rest.diagonal().argmax())
        if not rest[pivot, pivot] > floor:
            break
        column = rest[:, pivot] / np.sqrt(rest[pivot, pivot])
        rest -= np.outer(column, column)
        rest[pivot, :] = rest[:, pivot] = 0.0
        columns.append(column)
    return np.column_stack(columns) if columns else np.zeros((n, 0))


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and unit eigenvectors (columns) of factor factor', by rotating its columns.

    A sweep meets every pair of columns once, in rounds of disjoint pairs that are rotated together.
    """
    columns = factor.copy()
    r = columns.shape[1]
    ring = np.arange(r + r % 2)  # of an odd number, the last meets nobody
    for _ in range(sweeps):
        largest = 0.0
        for _ in range(len(ring) - 1):
            half = len(ring) // 2
            i, j = ring[:half], ring[half:][::-1]
            met = (i < r) & (j < r)
            i, j = i[met], j[met]
            a, b = columns[:, i], columns[:, j]
            alpha, beta, gamma = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            size = np.sqrt(alpha * beta)
            turn = np.abs(gamma) > np.finfo(float).eps * size
            if turn.any():
                largest = max(largest, float((np.abs(gamma[turn]) / size[turn]).max()))
                zeta = (beta[turn] - alpha[turn]) / (2 * gamma[turn])
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                c = 1 / np.hypot(1.0, t)
                a, b = a[:, turn], b[:, turn]
                columns[:, i[turn]], columns[:, j[turn]] = c * a - c * t * b, c * t * a + c * b
            ring = np.append(ring[0], np.roll(ring[1:], 1))
        if largest <= 1e-15 * max(r, 1):
            break
    values = (columns * columns).sum(0)
    order = np.argsort(-values, kind="stable")
    values, columns = values[order], columns[:, order]
    return values, columns / np.sqrt(values)


def _usable(embedding: str):
    real = F.transform(embedding, lambda x: x.cast("double"))
    fits = F.forall(real, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * SCALE < _MOST))
    return F.coalesce((F.size(embedding) > 0) & fits, F.lit(False))


def _numbers(column: pa.Array) -> np.ndarray:
    """x of the vectors of one batch, a row each."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    return np.floor(values * SCALE).astype(np.int64) + SHIFT


def _added_up(parts: DataFrame, key: str, value: str) -> dict[int, np.ndarray]:
    """Sum of the arrays of each key, in two steps, so no place adds up those of all tasks."""
    fold = f"{key} int, {value} array<double>"

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({key: [pdf[key].iloc[0]], value: [np.sum(np.stack(pdf[value].to_numpy()), axis=0)]})

    some = parts.groupBy(key, F.pmod(F.col("part"), F.lit(_FAN_IN))).applyInPandas(total, fold)
    return {r[key]: np.array(r[value]) for r in some.groupBy(key).applyInPandas(total, fold).collect()}


def _partial(vectors: DataFrame, measure, size: int) -> np.ndarray:
    """Sum over all vectors of a matrix with `size` rows that `measure` makes of a batch; one matrix a task is sent."""

    def run(batches):
        total = None
        for batch in batches:
            if len(batch):
                made = measure(_numbers(batch.column("embedding")))
                total = made if total is None else total + made
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(size), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["row", "sums"]
            )

    parts = vectors.select("embedding").mapInArrow(run, "row int, sums array<double>")
    rows = _added_up(parts.withColumn("part", F.spark_partition_id()), "row", "sums")
    return np.stack([rows[i] for i in range(size)])


def _moments(vectors: DataFrame) -> tuple[int, int, list[int]]:
    """Number, length and sums of the vectors of the most frequent length."""
    lengths = vectors.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return 0, 0, []

    def run(batches):
        total: list[int] | None = None
        for batch in batches:
            if len(batch):
                # Halves of the numbers, so that a batch's sums stay far below 2^63.
                x = _numbers(batch.column("embedding"))
                made = [(int(h) << 32) + int(l) for h, l in zip((x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0))]
                total = made if total is None else [a + b for a, b in zip(total, made)]
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array([str(x) for x in total])], ["i", "s"]
            )

    of_length = vectors.filter(F.size("embedding") == lengths["d"]).select("embedding")
    sums = (
        of_length.mapInArrow(run, "i int, s string").groupBy("i")
        .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("i").collect()
    )
    return lengths["count"], lengths["d"], [int(r["s"]) for r in sums]


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Exact sum over the dimensions of (n x - S)^2 of every row."""
    low, high = x.min(0).tolist(), x.max(0).tolist()
    most = [max(abs(n * a - s), abs(n * b - s)) for a, b, s in zip(low, high, sums)]
    if max(n * max(abs(a), abs(b)) for a, b in zip(low, high)) < 2 ** 63 and sum(m * m for m in most) < 2 ** 63:
        y = n * x - np.array(sums, dtype=np.int64)
        return (y * y).sum(1).tolist()
    y = n * x.astype(object) - np.array(sums, dtype=object)
    found = (y * y).sum(1).tolist()
    if max(found) >= 2 ** 63:
        raise OverflowError("the deviation of a vector does not fit a long")
    return found


def fit(vectors: DataFrame, components: int = 8) -> dict | None:
    """Mean, components and eigenvalues of the usable vectors; None where nothing varies. Its size is that of a d x d matrix."""
    n, d, sums = _moments(vectors)
    if not n:
        return None
    mean = np.array([s / n for s in sums])
    # The whole part is taken off first: x - S // n is exact, what is left of the mean is below 1.
    whole = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([(s % n) / n for s in sums])

    def scatter(x: np.ndarray) -> np.ndarray:
        y = (x - whole) - rest
        return y.T @ y

    of_length = vectors.filter(F.size("embedding") == d)
    covariance = _partial(of_length, scatter, d) / n
    values, axes = one_sided_jacobi(pivoted_cholesky(covariance))
    k = min(components, int((values > d * np.finfo(float).eps * max(values.max(initial=0.0), 0.0)).sum()))
    if not k:
        return None
    return {
        "n": n, "d": d, "sums": sums, "mean": mean, "whole": whole, "rest": rest, "values": values[:k], "axes": axes[:, :k],
        "explained": values[:k] / covariance.trace(),
    }


def project(x: np.ndarray, model: dict) -> np.ndarray:
    return ((x - model["whole"]) - model["rest"]) @ model["axes"] / np.sqrt(model["values"])


def whiten(vectors: DataFrame, components: int = 8) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error, from vec_id and embedding."""
    ship(vectors.sparkSession)
    schema = (
        "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter(_usable("embedding"))
    model = fit(vectors, components)
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    n, k = model["n"], len(model["values"])
    of_length = vectors.filter(F.size("embedding") == model["d"])

    def second(x: np.ndarray) -> np.ndarray:
        w = project(x, model)
        return np.vstack([w.T @ w, w.sum(0)])

    sums = _partial(of_length, second, k + 1)
    mean = sums[k] / n  # of centred numbers, so nothing but rounding
    error = float(np.abs(sums[:k] / n - np.outer(mean, mean) - np.eye(k)).max())

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            x = _numbers(batch.column("embedding"))
            m = len(x)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, n), pa.int64()),
                pa.array(np.repeat(np.array(deviations(x, n, model["sums"]), dtype=np.int64), k)),
                pa.array(project(x, model).ravel()), pa.array(np.tile(model["explained"], m)),
                pa.array(np.full(m * k, error)),
            ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return of_length.mapInArrow(run, schema)

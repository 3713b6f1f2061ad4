"""Whitening of embeddings by the leading components of their covariance.

Sums and centred products are added up where the vectors are; the driver gets one number per pair of
dimensions. There the covariance is brought to tridiagonal form by Householder reflections, its leading
eigenvalues are found by bisection on Sturm counts and their vectors by inverse iteration, which is
reorthogonalised within clusters of close eigenvalues. The components go out to the tasks as constants.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from logharbor.session import materialize

#: Components given, at most, and lattice steps to one.
COMPONENTS, SCALE = 4, 256
#: Eigenvalues closer than this share of the matrix's norm form a cluster.
CLUSTER = 1e-3
#: A component with less than this share of the variance is rounding and none.
LEAST_SHARE = 1e-12
LONG = 2**63


def lattice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Id, vector in whole steps (packed longs) and length of each usable vector."""
    for batch in batches:
        vectors = batch.column(1)
        sizes = pc.list_value_length(vectors).fill_null(0).to_numpy()
        values = vectors.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy() * SCALE
        bad = np.append(0, np.cumsum(~(np.abs(values) < LONG)))
        ends = np.cumsum(sizes)
        usable = np.flatnonzero((sizes > 0) & (bad[ends] == bad[ends - sizes]))
        steps = np.floor(np.where(np.abs(values) < LONG, values, 0)).astype("<i8")
        packed = [steps[ends[i] - sizes[i] : ends[i]].tobytes() for i in usable.tolist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(usable)), pa.array(packed, pa.binary()), pa.array(sizes[usable], pa.int32())], names=["id", "x", "size"])


def unpacked(column: pa.Array, size: int) -> np.ndarray:
    """One row per vector."""
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, size)


def sums(size: int):
    """Per task and dimension: number of vectors and sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(size, np.int64), 0
        for batch in batches:
            total += unpacked(batch.column(0), size).sum(axis=0)
            n += batch.num_rows
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(np.full(size, n)), pa.array(total)], names=["i", "n", "total"])

    return run


def products(mean: np.ndarray, components: np.ndarray):
    """Per task: summed products of all pairs of coordinates of the centred vectors on the components."""
    size, k = components.shape
    i, j = np.triu_indices(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((k, k)), 0
        for batch in batches:
            x = (unpacked(batch.column(0), size) - mean) @ components
            total += x.T @ x
            n += batch.num_rows
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], names=["i", "j", "total"])

    return run


def covariance(fit: DataFrame, mean: np.ndarray, components: np.ndarray, n: int) -> np.ndarray:
    """Centred covariance, divisor ``n``, of the vectors' coordinates on the components."""
    parts = fit.mapInArrow(products(mean, components), "i long, j long, total double")
    out = np.zeros((components.shape[1],) * 2)
    for row in parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        out[row["i"], row["j"]] = out[row["j"], row["i"]] = row["total"] / n
    return out


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, secondary diagonal, and the unit vectors of the Householder reflections, first one first."""
    a = matrix.astype(float).copy()
    size, mirrors = len(a), []
    for k in range(size - 2):
        x = a[k + 1 :, k].copy()
        norm = math.sqrt(float(x @ x))
        x[0] += math.copysign(norm, x[0])
        length = math.sqrt(float(x @ x))
        v = x / length if length else x
        mirrors.append(v)
        if not length:
            continue
        part = a[k + 1 :, k + 1 :]
        p = part @ v
        w = p - (v @ p) * v
        part -= 2 * (np.outer(v, w) + np.outer(w, v))
        column = a[k + 1 :, k]
        column -= 2 * (v @ column) * v
        a[k, k + 1 :] = column
    return a.diagonal().copy(), a.diagonal(1).copy(), mirrors


def count_below(diagonal: np.ndarray, beside: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sturm count: how many eigenvalues of the tridiagonal matrix lie below each point."""
    tiny = np.finfo(float).tiny
    q = diagonal[0] - at
    count = (q < 0).astype(int)
    for d, e in zip(diagonal[1:], beside):
        q = np.where(np.abs(q) < tiny, -tiny, q)
        with np.errstate(over="ignore"):
            q = d - at - e * e / q
        count += q < 0
    return count


def leading_values(diagonal: np.ndarray, beside: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, each to the last bit that bisection can tell."""
    around = np.append(0, np.abs(beside)) + np.append(np.abs(beside), 0)
    low, high = np.full(k, (diagonal - around).min()), np.full(k, (diagonal + around).max())
    high = high + np.abs(high) * 1e-15 + np.finfo(float).tiny
    above = len(diagonal) - np.arange(1, k + 1)  # eigenvalues below the sought one
    for _ in range(200):
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            break
        under = count_below(diagonal, beside, middle) <= above
        low, high = np.where(under, middle, low), np.where(under, high, middle)
    return low + (high - low) / 2


def solve_tridiagonal(diagonal: np.ndarray, beside: np.ndarray, right: np.ndarray, least: float) -> np.ndarray:
    """Elimination with row exchanges; pivots smaller than ``least`` are set to it."""
    d, x = [float(v) for v in diagonal], [float(v) for v in right]
    up, low = [float(v) for v in beside] + [0.0], [float(v) for v in beside]
    second = [0.0] * len(d)
    for i in range(len(d) - 1):
        if abs(low[i]) > abs(d[i]):
            d[i], low[i] = low[i], d[i]
            up[i], d[i + 1] = d[i + 1], up[i]
            second[i], up[i + 1] = up[i + 1], 0.0
            x[i], x[i + 1] = x[i + 1], x[i]
        if abs(d[i]) < least:
            d[i] = least
        factor = low[i] / d[i]
        d[i + 1] -= factor * up[i]
        up[i + 1] -= factor * second[i]
        x[i + 1] -= factor * x[i]
    for i in range(len(d) - 1, -1, -1):
        value = x[i]
        if i + 1 < len(d):
            value -= up[i] * x[i + 1]
        if i + 2 < len(d):
            value -= second[i] * x[i + 2]
        x[i] = value / (d[i] if abs(d[i]) >= least else least)
    return np.array(x)


def leading_components(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit vectors as columns."""
    diagonal, beside, mirrors = tridiagonal(matrix)
    values = leading_values(diagonal, beside, k)
    norm = float((np.abs(diagonal) + np.append(0, np.abs(beside)) + np.append(np.abs(beside), 0)).max()) or 1.0
    least = np.finfo(float).eps * norm
    vectors: list[np.ndarray] = []
    rng = np.random.default_rng(13)
    for j in range(k):
        first = j
        while first and values[first - 1] - values[first] <= CLUSTER * norm:
            first -= 1
        v = rng.standard_normal(len(diagonal))
        v /= np.linalg.norm(v)
        for _ in range(8):
            # Scaled first, as an exact eigenvalue makes the solution large.
            v = solve_tridiagonal(diagonal - values[j], beside, v, least)
            v /= np.abs(v).max()
            for _ in range(2):
                for other in vectors[first:j]:
                    v = v - (other @ v) * other
            v /= np.linalg.norm(v)
            rest = diagonal * v - values[j] * v
            rest[:-1] += beside * v[1:]
            rest[1:] += beside * v[:-1]
            if np.abs(rest).max() <= 4 * least:
                break
        vectors.append(v)
    out = np.array(vectors).T
    for step in range(len(mirrors) - 1, -1, -1):
        v = mirrors[step]
        out[step + 1 :] -= 2 * np.outer(v, v @ out[step + 1 :])
    return values, out


def projected(n: int, total: np.ndarray, components: np.ndarray, values: np.ndarray):
    """One row per vector and component."""
    size, k = components.shape
    exact = [int(x) for x in total]
    farthest = max(abs(x) for x in exact)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unpacked(batch.column(1), size)
            white = (x - total / n) @ components / np.sqrt(values)
            reach = n * int(np.abs(x).max(initial=0)) + farthest
            if reach * reach * size < LONG:
                far = ((n * x - total) ** 2).sum(axis=1).tolist()
            else:
                far = [sum((n * a - s) ** 2 for a, s in zip(row, exact)) for row in x.tolist()]
            rows = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                 pa.array([f if f < LONG else None for f in far], pa.int64()).take(pa.array(rows)), pa.array(white.ravel())],
                names=["id", "component", "deviation", "whitened"])

    return run


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per usable row and component: id, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    Vectors that are null or empty, hold null or non-finite entries, or entries whose steps don't fit a long,
    give no rows; nor do those whose length is not the commonest (the longest of several). The fit counts equal
    vectors once. Rows that repeat or lack an id are handled like others. Components whose eigenvalue is
    rounding are left out, so equal vectors only, like an empty table, give no rows. ``deviation`` is null where
    it doesn't fit a long. Other columns play no part. The driver holds the covariance: the square of the
    vectors' length in numbers.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    kind = rows.schema["id"].dataType.simpleString()
    steps = materialize(rows.mapInArrow(lattice, f"id {kind}, x binary, size int"), "lattice")
    common = steps.groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).select("size").head()
    schema = f"{id_col} {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if common is None:
        return spark.createDataFrame([], schema)
    size = common["size"]
    steps = steps.where(F.col("size") == size)
    fit = materialize(steps.select("x").distinct(), "fit")
    found = fit.mapInArrow(sums(size), "i long, n long, total long").groupBy("i").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("i").collect()
    n, total = found[0]["n"], np.array([r["total"] for r in found], np.int64)
    matrix = covariance(fit, total / n, np.eye(size), n)
    values, axes = leading_components(matrix, min(components, size))
    trace = float(np.trace(matrix))
    k = int((values > LEAST_SHARE * trace).sum())
    if not k:
        return spark.createDataFrame([], schema)
    values, axes = values[:k], axes[:, :k]
    error = float(np.abs(covariance(fit, total / n, axes / np.sqrt(values), n) - np.eye(k)).max())
    out = steps.select("id", "x").mapInArrow(projected(n, total, axes, values), f"id {kind}, component int, deviation long, whitened double")
    shares = F.array(*[F.lit(float(v / trace)) for v in values])
    return out.select(
        F.col("id").alias(id_col), "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("component") - 1).alias("explained"), F.lit(error).alias("identity_error"))

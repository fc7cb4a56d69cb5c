"""Embedding whitening: principal components of vectors, and the vectors in them with unit covariance.

Entries are brought to a grid of integers, so sums and the scatter are exact whatever the order in which tasks
finish. A first pass sums the entries; a second sums the products of entries less the rounded mean, one small
triangle for each task, added up by Spark per entry. Only the scatter's d x d entries reach the driver, however many
rows there are. There the centred scatter is factored by pivoted Cholesky, and one-sided Jacobi turns
the columns of the triangular factor until they are orthogonal: V = L L', L W = U S, so V = U S^2 U'. The norms of
the turned columns are the square roots of the eigenvalues, the normalised columns are the components, and V itself is
never diagonalised.

Edge cases: rows whose vector is null or holds a null or non-finite entry are dropped, and those with an entry past 2**52 on
the grid; shorter vectors end in zeros, the empty vector too. Null and repeated keys stay rows of their own. Directions
without variance have no component, so equal vectors, a single vector and the empty table give the empty table; equal
eigenvalues span the same space whichever basis is found. Further columns are left out.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from evgraph.llm.vectors import longest, matrix
from evgraph.session import written

SCALE, SHIFT = 1024, 100_000
LIMB = 17  # bits of the parts whose products BLAS sums without rounding
LEAST_SHARE = 1e-11  # of the largest residual; below it a direction has no variance


def grid(column: pa.Array, dim: int, scale: int, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, floor(scale * entry) + shift) of the usable vectors."""
    rows, values = matrix(column, dim)
    values = np.floor(scale * values)
    fits = (np.abs(values) <= 2.0**52).all(axis=1)
    return rows[fits], values[fits].astype(np.int64) + shift


def exact_sums(x: np.ndarray) -> np.ndarray:
    """Column sums as Python integers."""
    high = (x >> 26).sum(axis=0).astype(object)
    return high * (1 << 26) + (x & ((1 << 26) - 1)).sum(axis=0).astype(object)


def exact_gram(y: np.ndarray) -> np.ndarray:
    """y'y as Python integers: parts of 17 bits are multiplied in doubles, which hold their sums exactly."""
    parts, rest = [], y
    while True:
        low = ((rest + (1 << (LIMB - 1))) & ((1 << LIMB) - 1)) - (1 << (LIMB - 1))
        parts.append(low.astype(np.float64))
        rest = (rest - low) >> LIMB
        if not rest.any():
            break
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for i, a in enumerate(parts):
        for j, b in enumerate(parts):
            total += (a.T @ b).astype(np.int64).astype(object) * (1 << (LIMB * (i + j)))
    return total


def decimals(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def column_sums(vectors: DataFrame, dim: int, scale: int, shift: int) -> tuple[int, list[int]]:
    """Number of usable vectors and the exact sum of each entry."""

    def run(batches):
        n, sums = 0, np.zeros(dim, object)
        for batch in batches:
            _, x = grid(batch.column(0), dim, scale, shift)
            n, sums = n + len(x), sums + exact_sums(x)
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, dim), pa.int32()), decimals([n, *sums])], names=["i", "s"])

    rows = vectors.mapInArrow(run, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()
    found = {r["i"]: int(r["s"]) for r in rows}
    return found.get(-1, 0), [found.get(i, 0) for i in range(dim)]


def covariance(vectors: DataFrame, dim: int, n: int, sums: list[int], scale: int, shift: int) -> np.ndarray:
    """Covariance, divisor n, centred before multiplying; exact up to the last division."""
    centre = [(2 * s + n) // (2 * n) for s in sums]
    off = np.array(centre, np.int64)

    def run(batches):
        total = np.zeros((dim, dim), object)
        for batch in batches:
            _, x = grid(batch.column(0), dim, scale, shift)
            if len(x):
                total = total + exact_gram(x - off)
        i, j = np.triu_indices(dim)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), decimals(total[i, j])], names=["i", "j", "v"])

    parts = vectors.mapInArrow(run, "i int, j int, v decimal(38,0)").groupBy("i", "j").agg(F.sum("v").alias("v"))
    rest = [s - n * c for s, c in zip(sums, centre)]
    cov = np.zeros((dim, dim))
    for r in parts.collect():  # d x d entries
        cov[r["i"], r["j"]] = cov[r["j"], r["i"]] = (n * int(r["v"]) - rest[r["i"]] * rest[r["j"]]) / (n * n)
    return cov


def pivoted_cholesky(cov: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, L) with cov[order][:, order] = L L', as many columns as cov has rank."""
    work, d = cov.copy(), len(cov)
    order, low = np.arange(d), np.zeros((d, d))
    least = LEAST_SHARE * max(work.diagonal().max(initial=0.0), 0.0)
    for k in range(d):
        p = k + int(np.argmax(work.diagonal()[k:]))
        if not work[p, p] > least:
            return order, low[:, :k]
        for table in (work, low):
            table[[k, p]] = table[[p, k]]
        work[:, [k, p]] = work[:, [p, k]]
        order[[k, p]] = order[[p, k]]
        low[k, k] = np.sqrt(work[k, k])
        low[k + 1 :, k] = work[k + 1 :, k] / low[k, k]
        work[k + 1 :, k + 1 :] -= np.outer(low[k + 1 :, k], low[k + 1 :, k])
    return order, low


def orthogonal_columns(low: np.ndarray, sweeps: int = 40) -> np.ndarray:
    """One-sided Jacobi: the columns of ``low`` turned in pairs until all are orthogonal.

    Each sweep is a round robin in which every column meets every other once, half of them at a time."""
    a = low.copy()
    r = a.shape[1]
    seats = list(range(r + r % 2))
    for _ in range(sweeps):
        largest = 0.0
        for _ in range(len(seats) - 1):
            half = len(seats) // 2
            pairs = [(p, q) for p, q in zip(seats[:half], seats[:half - 1:-1]) if p < r and q < r]
            p, q = np.array(pairs).T
            x, y = a[:, p], a[:, q]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            size = np.abs(xy) / np.sqrt(xx * yy)
            largest = max(largest, size.max())
            turn = size > 1e-16
            zeta = (yy - xx) / (2.0 * np.where(turn, xy, 1.0))
            t = np.where(turn, np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
            c = 1.0 / np.sqrt(1.0 + t * t)
            s = c * t
            a[:, p], a[:, q] = c * x - s * y, s * x + c * y
            seats = [seats[0], seats[-1], *seats[1:-1]]
        if largest < 1e-15:
            break
    return a


def principal(cov: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit components as columns) of a covariance, as many as its rank."""
    order, low = pivoted_cholesky(cov)
    turned = orthogonal_columns(low) if low.shape[1] > 1 else low
    norms = np.sqrt((turned * turned).sum(0))
    falling = np.argsort(-norms, kind="stable")
    units = np.empty_like(turned)
    units[order] = turned / norms
    units = units[:, falling]
    largest = np.abs(units).argmax(0)
    return norms[falling] ** 2, units * np.where(units[largest, np.arange(units.shape[1])] < 0, -1.0, 1.0)


def whitened(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", most: int = 8, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """One row per usable vector and component: key, component (from 1 by falling variance), n, deviation
    (squared distance from the mean times n squared, exact; null past 64 bits), deviation_exact (the same
    as a decimal), whitened, explained, identity_error."""
    kind = vectors.schema[key].dataType.simpleString()
    names = [f"`{key}` {kind}", "component int", "n long", "deviation long", "whitened double", "explained double", "identity_error double", "deviation_exact decimal(38,0)"]
    spark, only = vectors.sparkSession, vectors.select(F.col(f"`{column}`").alias("v"))
    dim = longest(vectors, column)
    n, sums = column_sums(only, dim, scale, shift) if dim else (0, [])
    cov = covariance(only, dim, n, sums, scale, shift) if n else np.zeros((0, 0))
    values, units = principal(cov) if n else (np.zeros(0), np.zeros((0, 0)))
    k = min(most, len(values))
    if not k:
        return spark.createDataFrame([], ", ".join(names))
    off = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    rest = [s - n * int(c) for s, c in zip(sums, off)]
    mean = np.array([t / n for t in rest])
    axes = units[:, :k] / np.sqrt(values[:k])

    def run(batches):
        ends, squares = np.array(rest, object), sum(t * t for t in rest)
        small = max(map(abs, rest), default=0)
        for batch in batches:
            rows, x = grid(batch.column(1), dim, scale, shift)
            y = x - off
            top = int(np.abs(y).max(initial=0))
            yy = (y * y).sum(1) if top * top * dim < 2**62 else (y.astype(object) ** 2).sum(1)
            yt = y @ ends.astype(np.int64) if top * small * dim < 2**62 else y.astype(object) @ ends
            far = [n * n * int(a) - 2 * n * int(b) + squares for a, b in zip(yy, yt)]
            w = (y - mean) @ axes
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), decimals(far), pa.FixedSizeListArray.from_arrays(pa.array(w.ravel()), k).cast(pa.list_(pa.float64()))],
                names=["key", "far", "w"],
            )

    projected = vectors.select(F.col(f"`{key}`"), F.col(f"`{column}`").alias("v")).mapInArrow(run, f"key {kind}, far decimal(38,0), w array<double>")
    projected = written(projected, "whitened")
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    spread = [F.abs(F.covar_pop(F.col("w")[i], F.col("w")[j]) - (1.0 if i == j else 0.0)) for i, j in pairs]
    error = projected.agg(F.greatest(*spread) if len(spread) > 1 else spread[0]).first()[0]
    share = F.element_at(F.array(*[F.lit(float(v / cov.trace())) for v in values[:k]]), F.col("i") + 1)
    return projected.select("key", "far", F.posexplode("w").alias("i", "value")).select(
        F.col("key").alias(key), (F.col("i") + 1).alias("component"), F.lit(n).cast("long").alias("n"),
        F.expr("try_cast(far as bigint)").alias("deviation"), F.col("value").alias("whitened"), share.alias("explained"),
        F.lit(float(error)).alias("identity_error"), F.col("far").alias("deviation_exact"),
    )

"""Whitening of embeddings: principal components of a quantised table, and each vector in units of their spread.

The covariance is summed by tasks from centred rows, two passes over the data: means from exact sums of whole numbers first, then products of what is left. Only a
matrix of dimensions by dimensions reaches the driver, where a few eigenvectors are found: Householder reflections make it tridiagonal, the signs in Sturm's sequence
count the eigenvalues above a bound, so that bisection finds the leading ones one by one, and inverse iteration gives their vectors. Vectors of eigenvalues that lie close
together are made orthogonal to each other again in every step. The components are sent to every task, which projects its rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import no_rows, release, settle

EPS = float(np.finfo(np.float64).eps)
#: Eigenvalues whose distance is less than this share of the matrix's size belong together.
CLUSTER = 1e-3
WHITE = "id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, subdiagonal, and the reflections (unit vectors, or of zeros) that make a symmetric matrix tridiagonal."""
    a = np.array(matrix, np.float64)
    n = len(a)
    reflections = []
    for k in range(n - 2):
        v = np.zeros(n)
        x = a[k + 1 :, k]
        scale = np.abs(x).max()
        if scale > 0 and np.abs(x[1:]).max() > 0:
            v[k + 1 :] = x / scale
            v[k + 1] += np.copysign(np.linalg.norm(v), v[k + 1])
            v /= np.linalg.norm(v)
            p = a @ v
            w = 2 * (p - v * (v @ p))
            a -= np.outer(v, w) + np.outer(w, v)
        reflections.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def above(diagonal: np.ndarray, off: np.ndarray, bound: float) -> int:
    """How many eigenvalues of a tridiagonal matrix are greater than ``bound``: the positive terms of its Sturm sequence."""
    squares = off * off
    tiny = max(EPS * EPS, np.finfo(np.float64).tiny) * max(1.0, squares.max(initial=0.0))
    count, q = 0, 1.0
    for i, d in enumerate(diagonal.tolist()):
        q = d - bound - (squares[i - 1] / q if i else 0.0)
        if abs(q) < tiny:
            q = -tiny
        count += q > 0
    return count


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> list[float]:
    """The ``k`` largest eigenvalues, falling, each to the last bits of the matrix's size."""
    reach = np.concatenate([[0.0], np.abs(off)]) + np.concatenate([np.abs(off), [0.0]])
    low, high = float((diagonal - reach).min()), float((diagonal + reach).max())
    slack = 4 * EPS * max(abs(low), abs(high))
    out = []
    for i in range(k):
        a, b = low - slack, high + slack
        while True:
            middle = a + (b - a) / 2
            if not a < middle < b:
                break
            if above(diagonal, off, middle) > i:
                a = middle
            else:
                b = middle
        out.append(b)
        high = b
    return out


def _solve(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, least: float) -> np.ndarray:
    """(T - shift I) x = right by elimination with row exchanges; a pivot is ``least`` at least."""
    n = len(diagonal)
    d, x = (diagonal - shift).tolist(), right.tolist()
    up, up2, low = [*off.tolist(), 0.0], [0.0] * n, off.tolist()
    for i in range(n - 1):
        if abs(low[i]) > abs(d[i]):
            d[i], low[i], up[i], d[i + 1] = low[i], d[i], d[i + 1], up[i]
            up2[i], up[i + 1] = up[i + 1], 0.0
            x[i], x[i + 1] = x[i + 1], x[i]
        if abs(d[i]) < least:
            d[i] = least
        m = low[i] / d[i]
        d[i + 1] -= m * up[i]
        up[i + 1] -= m * up2[i]
        x[i + 1] -= m * x[i]
    if abs(d[-1]) < least:
        d[-1] = least
    for i in range(n - 1, -1, -1):
        x[i] = (x[i] - (up[i] * x[i + 1] if i + 1 < n else 0.0) - (up2[i] * x[i + 2] if i + 2 < n else 0.0)) / d[i]
    return np.array(x)


def leading_components(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and their unit vectors as rows; the largest entry of each is positive."""
    n = len(matrix)
    size = float(np.abs(matrix).max(initial=0.0))
    if n == 0 or size == 0:
        return np.zeros(min(k, n)), np.eye(n)[:k]
    # Scaled, so that squares of its entries neither overflow nor vanish.
    diagonal, off, reflections = tridiagonal(matrix / size)
    values = leading_eigenvalues(diagonal, off, min(k, n))
    norm = float(np.abs(diagonal).max() + (2 * np.abs(off).max() if n > 1 else 0.0))
    rng = np.random.default_rng(1)
    found: list[np.ndarray] = []
    for i, value in enumerate(values):
        start = i
        while start and values[start - 1] - values[start] < CLUSTER * norm:
            start -= 1
        # Equal values are told apart by a few of their last bits.
        shift = value - (i - start) * 4 * EPS * norm
        x = rng.standard_normal(n)
        for _ in range(6):
            for other in found[start:i]:
                x -= other * (other @ x)
            x = _solve(diagonal, off, shift, x / np.linalg.norm(x), EPS * norm)
            x /= np.abs(x).max()
        for _ in range(2):
            for other in found[start:i]:
                x -= other * (other @ x)
            x /= np.linalg.norm(x)
        found.append(x)
    vectors = np.array(found)
    for v in reversed(reflections):
        vectors -= 2 * np.outer(vectors @ v, v)
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    signs = np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)])
    return np.array(values) * size, vectors * signs[:, None]


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _dimension_sums(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Rows, and the exact sum of each dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dims
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch.column(0), dims)
            n += len(x)
            # High and low halves, so that a sum fits for any values.
            high, low = (x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist()
            total = [t + (h << 32) + b for t, h, b in zip(total, high, low)]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array([Decimal(t) for t in total], pa.decimal128(38, 0)), pa.array([n] * dims)], names=["dim", "total", "n"])

    found = fit.select("x").mapInArrow(add, "dim int, total decimal(38,0), n bigint").groupBy("dim").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()
    sums = {r["dim"]: r for r in found}
    return (int(sums[0]["n"]), [int(sums[i]["total"]) for i in range(dims)]) if found else (0, [0] * dims)


class Centre:
    """x - S / n, rounded once, and n x - S, exactly."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        whole = [s // n for s in sums]
        self.whole, self.rest = np.array(whole, np.int64), [s - n * w for s, w in zip(sums, whole)]
        self.part = np.array([r / n for r in self.rest])

    def near(self, x: np.ndarray) -> bool:
        """Whether x less the whole part of the mean fits a long."""
        return not len(x) or (abs(int(x.min())) < 1 << 61 and abs(int(x.max())) < 1 << 61 and np.abs(self.whole).max() < 1 << 61)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole if self.near(x) else x.astype(np.float64) - self.whole).astype(np.float64) - self.part

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2; null where it does not fit a long."""
        most = max((max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0) + int(np.abs(self.whole.astype(object)).max()) + 1, 1) * self.n
        if most * most * x.shape[1] < 1 << 63:
            d = self.n * (x - self.whole) - np.array(self.rest, np.int64)
            return (d * d).sum(axis=1).tolist()
        d = self.n * (x.astype(object) - self.whole.astype(object)) - np.array(self.rest, object)
        return [s if s < 1 << 63 else None for s in (d * d).sum(axis=1).tolist()]


def _covariance(fit: DataFrame, n: int, size: int, rows) -> np.ndarray:
    """Products of centred rows, summed by tasks and divided by ``n``; ``rows`` turns x into them. What the centre lacks by rounding is taken off."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, lack, some = np.zeros((size, size)), np.zeros(size), False
        for batch in batches:
            if len(batch):
                y = rows(batch.column(0))
                total += y.T @ y
                lack += y.sum(axis=0)
                some = True
        if some:
            both = np.vstack([total, lack])
            yield pa.RecordBatch.from_arrays([pa.array(range(size + 1), pa.int32()), pa.array(list(both))], names=["i", "row"])

    parts = fit.select("x").mapInArrow(add, "i int, row array<double>").select("i", F.posexplode("row").alias("j", "v"))
    out = np.zeros((size + 1, size))
    for i, j, v in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():  # dimensions by dimensions
        out[i, j] = v
    return (out[:size] - np.outer(out[size], out[size]) / n) / n


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """id, x: floor(scale * c) of each entry as a long. Without rows whose vector is null or empty, or holds null or non-finite entries."""
    vector = F.col(f"`{vector_col}`")
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    x: Column = F.transform(vector, lambda c: F.floor(c.cast("double") * scale).cast("bigint"))
    return vectors.where(vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True))).select(F.col(f"`{id_col}`").cast("bigint").alias("id"), x.alias("x"))


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 4, scale: float = 256.0) -> DataFrame:
    """One row per vector and component: id, component (from 1, by falling eigenvalue), n, deviation, whitened, explained, identity_error.

    x is the vector times ``scale``, rounded down. Means S / n and covariances are those of the n different x. ``deviation`` is the sum over dimensions of (n x - S)^2, exact, null if it
    does not fit a long; ``whitened`` is x - S / n projected on the component, over the root of its eigenvalue; ``explained`` is the eigenvalue's share in the trace;
    ``identity_error`` the greatest difference of an entry of whitened's covariance from the identity.

    Vectors that are null or empty or hold null or non-finite entries are left out; so are those of another length than most have (of two lengths, the longer). Entries beyond
    a long become its bounds. Vectors of equal or null id have rows each. Components without spread have no rows: there are none for a single vector, and an empty table gives none. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = quantised(vectors, id_col, vector_col, scale)
    lengths = rows.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    usual = lengths.orderBy(F.desc("n"), F.desc("dims")).limit(1).collect()
    if not usual:
        return no_rows(spark, _schema())
    dims = int(usual[0]["dims"])
    table = settle(rows.where(F.size("x") == dims), "quantised")
    fit = settle(table.select("x").distinct(), "fit")
    n, sums = _dimension_sums(fit, dims)
    centre = Centre(n, sums)
    covariance = _covariance(fit, n, dims, lambda column: centre.centred(_matrix(column, dims)))
    values, vectors_ = leading_components(covariance, components)
    trace = float(np.trace(covariance))
    real = values > dims * EPS * max(trace, 0.0)
    values, axes = values[real], vectors_[real]
    k = len(values)
    if not k:
        release(table, fit)
        return no_rows(spark, _schema())
    weights = (axes / np.sqrt(values)[:, None]).T
    white = _covariance(fit, n, k, lambda column: centre.centred(_matrix(column, dims)) @ weights)
    error = float(np.abs(white - np.eye(k)).max())
    release(fit)
    shares = values / trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = len(batch)
            if m:
                x = _matrix(batch.column(1), dims)
                white = centre.centred(x) @ weights
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                    pa.array(centre.deviation(x), pa.int64()).take(each), pa.array(white.reshape(-1)), pa.array(np.tile(shares, m)), pa.array(np.full(m * k, error)),
                ], names=[c.split()[0] for c in WHITE.split(", ")])

    return table.mapInArrow(project, WHITE)


def _schema():
    from pyspark.sql import types as T

    return T.StructType.fromDDL(WHITE)

"""Whitening: vectors centred, turned to the leading components of their covariance, and scaled to unit variance.

An entry c becomes the integer floor(64 c) + 1000000. Each distinct integer vector counts once in the fit: n vectors,
sums S per dimension. Sums and products are of integers less the integer next to the mean, so they are exact in double
precision, and do not depend on how the rows are spread, as long as they stay below 2**53; the driver then takes the
mean out exactly, in Python's integers: V = (n sum(y y') - R R') / n**2 with R = sum(y).

Spark adds up d x d numbers per task. The driver holds that one matrix (d is the number of dimensions of a vector, not
of rows): Householder reflections make it tridiagonal, Sturm counts bisect its leading eigenvalues, inverse iteration
gives their vectors, made orthogonal to those of the same cluster of eigenvalues, and the reflections turn them back.
Components and means are broadcast, and every row is projected.

Rows are left out whose vector is null or empty, holds a null or non-finite entry or one of 2**50 or more (whose integer
a double does not hold), or has another number of dimensions than most of the distinct vectors have (of several such
numbers, the largest). Rows with a null or repeated vec_id are kept. Components without variance (within rounding) do
not exist; a table without variance gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import partitions, ship, stage

#: Leading components that are returned.
COMPONENTS = 16
#: What turns an entry into an integer.
SCALE, SHIFT = 64, 1_000_000
#: Eigenvalues closer than this share of the norm form a cluster, whose vectors are made orthogonal to each other.
CLUSTER = 1e-3
_TINY = np.finfo(float).eps

_X = f"transform(vector, c -> CAST(floor({SCALE} * CAST(c AS DOUBLE)) AS BIGINT) + {SHIFT})"
_SOUND = f"size(vector) > 0 AND forall(vector, c -> c IS NOT NULL AND abs(CAST(c AS DOUBLE)) < {float(1 << 50)!r})"


def integers(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id and integer vector x of the rows whose vector is sound."""
    rows = vectors.select("vec_id", F.col(column).alias("vector")).where(_SOUND)
    return rows.select("vec_id", F.expr(_X).alias("x"))


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _sum(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    n, sums = 0, np.zeros(dims, np.int64)
    for batch in batches:
        x = _matrix(batch, dims)
        n, sums = n + len(x), sums + x.sum(0)
    yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([sums.tolist()], pa.list_(pa.int64()))], ["n", "sums"])


@dataclass
class Means:
    n: int
    sums: list[int]

    @property
    def near(self) -> np.ndarray:
        """Integer next to the mean of each dimension."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)

    @property
    def rest(self) -> list[int]:
        """n times the mean less that integer."""
        return [s - self.n * int(c) for s, c in zip(self.sums, self.near, strict=True)]


def means(fit: DataFrame, dims: int) -> Means:
    parts = fit.mapInArrow(lambda it: _sum(it, dims), "n long, sums array<long>")
    rows = parts.select("n", F.posexplode("sums").alias("at", "s")).groupBy("at").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    rows = sorted(rows.collect())  # one for each dimension
    return Means(rows[0]["n"], [int(r["s"]) for r in rows]) if rows else Means(0, [0] * dims)


def _products(batches: Iterator[pa.RecordBatch], dims: int, near: np.ndarray, onto: np.ndarray | None, rest: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sums of y y' of a task, y being x less ``near``, or that projected onto components, with y itself in a last row."""
    total = None
    for batch in batches:
        y = (_matrix(batch, dims) - near).astype(float)
        if onto is not None:
            y = (y - rest) @ onto
        y = np.hstack([y, np.ones((len(y), 1))])
        product = y.T @ y
        total = product if total is None else total + product
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total))), pa.array(total.tolist(), pa.list_(pa.float64()))], ["i", "row"])


def _summed(fit: DataFrame, dims: int, near: np.ndarray, onto: np.ndarray | None = None, rest: np.ndarray | None = None) -> np.ndarray:
    size = (dims if onto is None else onto.shape[1]) + 1
    few = fit.coalesce(2 * partitions(fit.sparkSession))  # each task sends a whole matrix
    rows = few.mapInArrow(lambda it: _products(it, dims, near, onto, rest), "i long, row array<double>")
    sums = rows.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()  # size x size rows
    out = np.zeros((size, size))
    out[sums["i"].to_numpy(), sums["j"].to_numpy()] = sums["v"].to_numpy()
    return out


def covariance(fit: DataFrame, m: Means) -> np.ndarray:
    """Covariance of the vectors, divisor n; each entry is rounded once if the sums are exact."""
    dims = len(m.sums)
    sums, rest, n = _summed(fit, dims, m.near), m.rest, m.n
    v = [[(n * int(sums[i, j]) - rest[i] * rest[j]) / (n * n) for j in range(i + 1)] for i in range(dims)]
    out = np.zeros((dims, dims))
    for i, row in enumerate(v):
        out[i, : i + 1] = out[: i + 1, i] = row
    return out


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, subdiagonal and the unit vectors of the Householder reflections that lead there."""
    a = v.copy()
    n, mirrors = len(a), []
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        x[0] += np.copysign(np.linalg.norm(x), x[0])
        length = np.linalg.norm(x)
        u = x / length if length else x
        rows = a[k + 1 :, k:]
        rows -= 2 * np.outer(u, u @ rows)
        columns = a[k:, k + 1 :]
        columns -= 2 * np.outer(columns @ u, u)
        mirrors.append(u)
    return np.diag(a).copy(), np.diag(a, -1).copy(), mirrors


def below(d: np.ndarray, e: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of a tridiagonal matrix lie below each value: the signs of its Sturm sequence."""
    least = max(np.finfo(float).tiny, _TINY * (np.abs(d).max(initial=0) + np.abs(e).max(initial=0)) * _TINY)
    q, count = d[0] - at, np.zeros(len(at), int)
    for k in range(len(d)):
        if k:
            q = d[k] - at - e[k - 1] ** 2 / q
        q = np.where(np.abs(q) < least, -least, q)
        count += q < 0
    return count


def leading(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, by bisection down to neighbouring doubles or rounding."""
    radius = np.append(np.abs(e), 0) + np.append(0, np.abs(e))
    low, high = np.full(k, (d - radius).min()), np.full(k, (d + radius).max())
    width = high[0] - low[0]
    low, high = low - _TINY * abs(width), high + _TINY * abs(width)
    rank = len(d) - 1 - np.arange(k)  # so many eigenvalues lie below the one sought
    for _ in range(200):
        middle = (low + high) / 2
        over = below(d, e, middle) > rank
        low, high = np.where(over, low, middle), np.where(over, middle, high)
        if (high - low <= 2 * _TINY * np.maximum(np.abs(low), np.abs(high))).all():
            break
    return (low + high) / 2


def _solve(d: np.ndarray, e: np.ndarray, at: float, b: np.ndarray, least: float) -> np.ndarray:
    """x of (T - at) x = b for a tridiagonal T, by elimination with row exchanges; zero pivots count as ``least``."""
    n = len(d)
    main, upper, second, lower, x = d - at, np.append(e, 0), np.zeros(n), e.copy(), b.copy()
    for k in range(n - 1):
        if abs(lower[k]) > abs(main[k]):
            main[k], lower[k] = lower[k], main[k]
            upper[k], main[k + 1] = main[k + 1], upper[k]
            second[k], upper[k + 1] = upper[k + 1], 0.0
            x[k], x[k + 1] = x[k + 1], x[k]
        if abs(main[k]) < least:
            main[k] = least
        f = lower[k] / main[k]
        main[k + 1] -= f * upper[k]
        upper[k + 1] -= f * second[k]
        x[k + 1] -= f * x[k]
    if abs(main[-1]) < least:
        main[-1] = least
    x[-1] /= main[-1]
    for k in range(n - 2, -1, -1):
        x[k] = (x[k] - upper[k] * x[k + 1] - (second[k] * x[k + 2] if k + 2 < n else 0.0)) / main[k]
    return x


def vectors_of(d: np.ndarray, e: np.ndarray, values: np.ndarray, cluster: float = CLUSTER) -> np.ndarray:
    """Unit eigenvectors (columns) of a tridiagonal matrix for some of its eigenvalues, which come falling."""
    norm = max(np.abs(d).max(), np.abs(e).max(initial=0)) or 1.0
    start = np.random.default_rng(len(d))
    out = np.zeros((len(d), len(values)))
    first, at = 0, values.copy()
    for k in range(len(values)):
        if k and values[k - 1] - values[k] > cluster * norm:
            first = k
        elif k:  # equal ones are pushed apart, or elimination would give one vector again
            at[k] = min(at[k], at[k - 1] - 10 * _TINY * norm)
        x = start.uniform(-1, 1, len(d))
        for _ in range(6):
            x = _solve(d, e, at[k], x / np.linalg.norm(x), _TINY * norm)
            for _ in range(2):
                x /= np.linalg.norm(x)
                x -= out[:, first:k] @ (out[:, first:k].T @ x)
        out[:, k] = x / np.linalg.norm(x)
    return out


def eigen(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns."""
    if len(v) == 1:
        return v[0][:k].copy(), np.ones((1, min(k, 1)))
    d, e, mirrors = tridiagonal(v)
    values = leading(d, e, min(k, len(v)))
    out = vectors_of(d, e, values)
    for at in range(len(mirrors) - 1, -1, -1):
        rows = out[at + 1 :]
        rows -= 2 * np.outer(mirrors[at], mirrors[at] @ rows)
    return values, out


@dataclass
class Whitener:
    """Means, components (columns, divided by the root of their eigenvalue) and what they explain."""

    means: Means
    onto: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    @property
    def dims(self) -> int:
        return len(self.means.sums)


def fit(x: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """Whitener of the distinct vectors ``x`` of a table; None if there are none or they do not vary."""
    distinct = stage(x.select("x").distinct(), "fit")
    sizes = distinct.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.desc("n"), F.desc("dims")).first()
    if most is None:
        return None
    dims = most["dims"]
    alike = distinct.where(F.size("x") == dims)
    m = means(alike, dims)
    v = covariance(alike, m)
    values, vectors = eigen(v, components)
    real = values > 10 * dims * _TINY * max(values[0], 0.0)
    values, vectors = values[real], vectors[:, real]
    if not len(values):
        return None
    out = Whitener(m, vectors / np.sqrt(values), values / np.trace(v))
    rest = np.array([r / m.n for r in m.rest])
    sums = _summed(alike, dims, m.near, out.onto, rest) / m.n
    mean = sums[-1, :-1]
    out.identity_error = float(np.abs(sums[:-1, :-1] - np.outer(mean, mean) - np.eye(len(values))).max())
    return out


_OUT = "vec_id {id}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _project(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    w: Whitener = sent.value
    near, rest, n, k = w.means.near, w.means.rest, w.means.n, w.onto.shape[1]
    exact = np.array(rest, object)
    fraction = np.array([r / n for r in rest])
    for batch in batches:
        for low in range(0, len(batch), 4096):
            part = batch.slice(low, 4096)
            y = _matrix(part, w.dims) - near
            bound = n * int(np.abs(y).max(initial=0)) + max(abs(r) for r in rest)
            away = y * np.int64(n) - np.array(rest, np.int64) if bound * bound * w.dims < 1 << 63 else y.astype(object) * n - exact
            deviation = (away * away).sum(1).tolist()
            z = (y - fraction) @ w.onto
            many = len(part)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("vec_id").take(pa.array(np.repeat(np.arange(many), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), many)),
                    pa.array(np.full(many * k, n)),
                    pa.array([x if x < 1 << 63 else None for x in deviation for _ in range(k)], pa.int64()),
                    pa.array(z.ravel()),
                    pa.array(np.tile(w.explained, many)),
                    pa.array(np.full(many * k, w.identity_error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )


def whiten(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per sound row and component: vec_id, component, n, deviation, whitened, explained and identity_error.

    ``deviation`` is the exact sum over dimensions of (n x - S)**2, null where 64 bits do not hold it. Components come numbered
    by falling eigenvalue, with either sign, the same for all rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    x = integers(vectors, column)
    schema = _OUT.format(id=x.schema["vec_id"].dataType.simpleString())
    w = fit(x, components)
    if w is None:
        return spark.createDataFrame([], schema)
    sent = spark.sparkContext.broadcast(w)
    return x.where(F.size("x") == w.dims).mapInArrow(lambda it: _project(it, sent), schema)

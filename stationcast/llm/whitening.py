"""Embedding whitening by principal components.

Every entry becomes the long floor(64 c) + 1000000.  The fit list holds each
distinct vector once: copies are folded in the tasks before they are shuffled,
so one vector that a third of the rows share costs a row per task.  Its sums
are exact; its covariance is the sum of what every task has accumulated over
its own vectors, which are centred first.  The covariance, dimension squared
numbers, comes to the driver.  There Householder reflections make it
tridiagonal, bisection on Sturm counts finds the leading eigenvalues, inverse
iteration with reorthogonalisation inside clusters finds their vectors.  The
projection goes out with the tasks that whiten the rows.

No matrix routine of a library is used for the eigenvectors; memory is the
square of the dimension in a task and on the driver, whatever the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationcast.llm.common import staged

#: Entries are counted in steps of 1 / SCALE from -SHIFT / SCALE on.
SCALE, SHIFT = 64, 1_000_000
#: Most components returned.
COMPONENTS = 16
#: Scaled entries are cut to +-2^60, far beyond what a double of an embedding holds.
_FAR = float(1 << 60)
#: Components with less than this share of the first one's variance are rounding noise.
NOISE = 1e-11
#: Eigenvalues nearer than this share of the matrix norm are one cluster.
CLUSTER = 1e-3


# -- eigenvectors of a symmetric matrix, on the driver ------------------------------------------

def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, off-diagonal, reflectors): H(n-3)...H(0) A H(0)...H(n-3) with
    H(k) = I - 2 v v' over the coordinates from k + 1 on, v a unit vector or empty."""
    a, n, reflectors = matrix.astype(float).copy(), len(matrix), []
    for k in range(n - 2):
        x = a[k + 1:, k]
        size = np.linalg.norm(x)
        if size == 0 or size == abs(x[0]):  # nothing below the off-diagonal
            reflectors.append(np.zeros(0))
            continue
        v = x.copy()
        v[0] += np.copysign(size, x[0])
        v /= np.linalg.norm(v)
        inner = a[k + 1:, k + 1:]
        p = 2 * inner @ v
        p -= (p @ v) * v
        inner -= np.outer(v, p) + np.outer(p, v)
        a[k + 1, k] = -np.copysign(size, x[0])
        reflectors.append(v)
    return np.diag(a).copy(), np.array([a[k + 1, k] for k in range(n - 1)]), reflectors


def sturm_counts(d: np.ndarray, e: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix are below each of ``at``."""
    tiny = np.finfo(float).tiny * max(1.0, float(np.max(e * e, initial=0.0))) / np.finfo(float).eps
    q = d[0] - at
    count = (q < 0).astype(int)
    for i in range(1, len(d)):
        q = np.where(np.abs(q) < tiny, -tiny, q)
        q = d[i] - at - e[i - 1] ** 2 / q
        count += q < 0
    return count


def leading_eigenvalues(d: np.ndarray, e: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` largest eigenvalues, falling, each halved in to neighbouring doubles."""
    n = len(d)
    most = min(most, n)
    radius = np.abs(np.concatenate([e, [0]])) + np.abs(np.concatenate([[0], e]))
    low = np.full(most, float(np.min(d - radius)))
    high = np.full(most, float(np.max(d + radius)))
    low -= np.spacing(np.abs(low)) * 8 + 1e-300
    high += np.spacing(np.abs(high)) * 8 + 1e-300
    wanted = n - 1 - np.arange(most)  # so many eigenvalues are below the wanted one
    for _ in range(1100):
        mid = low + (high - low) / 2
        moving = (mid > low) & (mid < high)
        if not moving.any():
            break
        above = sturm_counts(d, e, mid) <= wanted  # the wanted one is not below mid
        low, high = np.where(moving & above, mid, low), np.where(moving & ~above, mid, high)
    return low


def _solve(d: np.ndarray, e: np.ndarray, shift: float, b: np.ndarray, least: float) -> np.ndarray:
    """x with (T - shift) x = b, by elimination with row exchanges; no pivot is below ``least``."""
    n = len(d)
    diag, low, up, up2, x = (d - shift).tolist(), e.tolist(), [*e.tolist(), 0.0], [0.0] * n, b.tolist()
    pivot = lambda v: v if abs(v) >= least else (least if v >= 0 else -least)
    for i in range(n - 1):
        if abs(low[i]) <= abs(diag[i]) or low[i] == 0:
            diag[i] = pivot(diag[i])
            f = low[i] / diag[i]
            diag[i + 1] -= f * up[i]
            x[i + 1] -= f * x[i]
        else:
            f = diag[i] / low[i]
            diag[i], up[i], diag[i + 1], up2[i], up[i + 1] = low[i], diag[i + 1], up[i] - f * diag[i + 1], up[i + 1], -f * up[i + 1]
            x[i], x[i + 1] = x[i + 1], x[i] - f * x[i + 1]
    diag[n - 1] = pivot(diag[n - 1])
    for i in range(n - 1, -1, -1):
        rest = x[i] - (up[i] * x[i + 1] if i + 1 < n else 0.0) - (up2[i] * x[i + 2] if i + 2 < n else 0.0)
        x[i] = rest / diag[i]
    return np.array(x)


def eigenvectors(d: np.ndarray, e: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) of the tridiagonal matrix for falling ``values``.

    Each is found by inverse iteration from a fixed pseudo-random start.  Vectors
    of one cluster are kept orthogonal to those before them in every step, and
    equal values are moved apart by a few rounding errors first."""
    n, eps = len(d), np.finfo(float).eps
    norm = float(np.max(np.abs(d) + np.abs(np.concatenate([e, [0]])) + np.abs(np.concatenate([[0], e])))) or 1.0
    rng, vectors, first, shift = np.random.default_rng(13), np.zeros((n, len(values))), 0, np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * norm:
            first = k
        shift = min(value, shift - 10 * eps * norm) if k > first else value
        x = rng.uniform(-1, 1, n)
        for _ in range(6):
            x -= vectors[:, first:k] @ (vectors[:, first:k].T @ x)
            x /= np.linalg.norm(x)
            x = _solve(d, e, shift, x, eps * norm)
            x /= np.max(np.abs(x))
        for _ in range(2):
            x -= vectors[:, first:k] @ (vectors[:, first:k].T @ x)
            x /= np.linalg.norm(x)
        vectors[:, k] = x
    return vectors


def leading_components(matrix: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling; unit eigenvectors as columns) of a symmetric matrix,
    as far as their variance is not rounding noise, ``most`` at most."""
    if not len(matrix):
        return np.zeros(0), np.zeros((0, 0))
    d, e, reflectors = tridiagonal(matrix)
    values = leading_eigenvalues(d, e, most)
    values = values[values > max(0.0, NOISE * values[0])]
    vectors = eigenvectors(d, e, values)
    for k in range(len(reflectors) - 1, -1, -1):
        v = reflectors[k]
        if len(v):
            vectors[k + 1:] -= 2 * np.outer(v, v @ vectors[k + 1:])
    return values, vectors


# -- the table ----------------------------------------------------------------------------------

def entries(vector: Column) -> Column:
    """The longs x of a vector; null where the vector is null or has an entry that is null or not finite."""
    sound = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    scaled = F.transform(vector, lambda c: F.floor(F.least(F.greatest(c.cast("double") * SCALE, F.lit(-_FAR)), F.lit(_FAR))).cast("long") + F.lit(SHIFT).cast("long"))
    return F.when(sound, scaled)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """(vectors of the fit list, exact sums of their dimensions)."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total = 0, [0] * dim
        for b in batches:
            x = _matrix(b.column(0), dim)
            high, low = x >> 30, x & ((1 << 30) - 1)  # halves, so that no sum leaves a long
            total = [t + (int(h) << 30) + int(w) for t, h, w in zip(total, high.sum(axis=0), low.sum(axis=0))]
            rows += len(x)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array(np.full(dim, rows)), pa.array([str(t) for t in total])], ["j", "n", "s"])
    parts = fit.mapInArrow(add, "j int, n long, s string")
    rows = parts.groupBy("j").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()  # one row for each dimension
    return (rows[0]["n"] if rows else 0), [int(r["s"]) for r in sorted(rows, key=lambda r: r["j"])]


def _products(fit: DataFrame, dim: int, size: int, centred) -> tuple[np.ndarray, np.ndarray]:
    """(sum of y, sum of y y') over the rows y = centred(x) of the fit list, ``size`` wide:
    every task adds up its own rows, and the tasks' sums are added by entry."""
    upper = np.triu_indices(size)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, first, second = 0, np.zeros(size), np.zeros((size, size))
        for b in batches:
            y = centred(_matrix(b.column(0), dim))
            rows, first, second = rows + len(y), first + y.sum(axis=0), second + y.T @ y
        if rows:
            i, j, v = (np.concatenate(p) for p in ((np.full(size, -1), upper[0]), (np.arange(size), upper[1]), (first, second[upper])))
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(v)], ["i", "j", "v"])
    first, second = np.zeros(size), np.zeros((size, size))
    for r in fit.mapInArrow(add, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():  # dimension squared numbers
        if r["i"] < 0:
            first[r["j"]] = r["v"]
        else:
            second[r["i"], r["j"]] = second[r["j"], r["i"]] = r["v"]
    return first, second


def deviations(x: np.ndarray, n: int, base: np.ndarray, rest: np.ndarray) -> list[int | None]:
    """Sum over the dimensions of (n x - S)^2, exactly, with S = n base + rest; null beyond a long."""
    far = int(np.max(np.abs(x - base), initial=0)) + 1
    if x.shape[1] * (n * far) ** 2 < 1 << 63:
        y = n * (x - base) - rest
        return (y * y).sum(axis=1).tolist()
    y = n * (x - base).astype(object) - rest.astype(object)
    sums = (y * y).sum(axis=1)
    return [int(v) if v < 1 << 63 else None for v in sums]


def whiten(table: DataFrame, vector: str = "embedding", key: str = "vec_id", most: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for
    every row of ``table`` with a sound vector and every component, ``most`` at most.

    Rows whose vector is null, or holds an entry that is null or not finite, are
    left out.  Vectors must have one length: the one that most rows have (of
    equals the longest) is taken, and rows of another length, which no
    projection fits, are left out too.  Repeated rows, repeated and null keys
    keep their rows; each distinct vector counts once in the fit.  Components
    without variance do not exist: vectors that are all equal, or empty, give
    no rows, and neither does an empty table.  A deviation beyond a long is
    null.  Other columns are not read, so their names may clash."""
    own = table.select(F.col(f"`{key}`").alias("vec_id"), entries(F.col(f"`{vector}`")).alias("x")).where(F.col("x").isNotNull())
    kind = dict(own.dtypes)["vec_id"]
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    lengths = own.groupBy(F.size("x").alias("dim")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), F.desc("dim")).first()
    dim = lengths["dim"] if lengths else 0
    if not dim:
        return table.sparkSession.createDataFrame([], schema)
    rows = own.where(F.size("x") == dim)
    fit = staged(rows.select("x").distinct(), "whitening-fit")
    n, sums = _sums(fit, dim)
    base, rest = (np.array(v, np.int64) for v in zip(*[divmod(s, n) for s in sums]))
    mean = rest / n  # of x - base
    _, second = _products(fit, dim, dim, lambda x: (x - base) - mean)
    covariance = second / n
    values, vectors = leading_components(covariance, most)
    size = len(values)
    if not size:
        return table.sparkSession.createDataFrame([], schema)
    project, explained = vectors / np.sqrt(values), values / np.trace(covariance)
    first, second = _products(fit, dim, size, lambda x: ((x - base) - mean) @ project)
    whitened_mean = first / n  # zero but for rounding
    error = float(np.max(np.abs(second / n - np.outer(whitened_mean, whitened_mean) - np.eye(size))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column(1), dim)
            m, again = len(x), np.repeat(np.arange(len(x)), size)
            cols = [b.column(0).take(pa.array(again)), pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), m)), pa.array(np.full(m * size, n)),
                    pa.array(deviations(x, n, base, rest), pa.int64()).take(pa.array(again)), pa.array((((x - base) - mean) @ project).reshape(-1)),
                    pa.array(np.tile(explained, m)), pa.array(np.full(m * size, error))]
            yield pa.RecordBatch.from_arrays(cols, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return rows.mapInArrow(run, schema)

"""Whitened embeddings: principal components of a covariance that the tasks add up, by a symmetric eigensolver of their own.

1. Distinct vectors are stored once; one pass adds them up exactly, a second the products of what is left after
   the mean has been taken off, a matrix a task, which are added row by row in a fixed order.
2. The driver holds one matrix of dimension x dimension, whatever the number of vectors. Householder reflections make it tridiagonal,
   bisection over Sturm counts finds the leading eigenvalues, inverse iteration their vectors, which are made
   orthogonal to each other within a cluster of close eigenvalues, and the reflections take them back.
3. The components, a matrix of dimension x ``components``, are sent to the tasks, which project every row; a last pass over the
   distinct vectors measures how far the covariance of the result is from the identity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import frugal, stage

_EPS = np.finfo(float).eps
_LONGEST = (1 << 63) - 1
#: Numbers handled at once in a task.
_AT_ONCE = 1 << 20
#: Eigenvalues closer than this share of the largest are a cluster; those below the second share of the trace count as none.
_CLUSTER, _NONE = 1e-3, 1e-12


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and Householder vectors of a symmetric matrix; vector k acts on the places after k."""
    a, n = a.copy(), len(a)
    reflections = []
    for k in range(n - 2):
        v = a[k + 1:, k].copy()
        scale = np.abs(v).max(initial=0.0)
        if scale == 0 or not np.abs(v[1:]).any():
            reflections.append(np.zeros(len(v)))
            continue
        v /= scale
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        v /= np.linalg.norm(v)
        rest = a[k + 1:, k + 1:]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1:, k] -= 2 * (v @ a[k + 1:, k]) * v
        reflections.append(v)
    return np.diagonal(a).copy(), np.diagonal(a, -1).copy(), reflections


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix lie below each of some numbers."""
    tiny = _EPS * _EPS * max(np.abs(diagonal).max(initial=0.0), np.abs(off).max(initial=0.0), np.finfo(float).tiny)
    q = diagonal[0] - at
    below = (q < 0).astype(int)
    for d, e in zip(diagonal[1:], off * off):
        q = d - at - e / np.where(np.abs(q) < tiny, -tiny, q)
        below += q < 0
    return below


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest, falling, each bisected until no number lies between its bounds."""
    n = len(diagonal)
    around = np.abs(np.append(off, 0)) + np.abs(np.append(0, off))
    margin = _EPS * n * (np.abs(diagonal) + around).max() + np.finfo(float).tiny
    low, high = np.full(k, (diagonal - around).min() - margin), np.full(k, (diagonal + around).max() + margin)
    least = n - 1 - np.arange(k)  # so many eigenvalues are smaller
    while True:
        middle = low + (high - low) / 2
        open_ = (middle > low) & (middle < high)
        if not open_.any():
            return middle
        above = sturm_counts(diagonal, off, middle) <= least  # the eigenvalue is not below the middle
        low, high = np.where(open_ & above, middle, low), np.where(open_ & ~above, middle, high)


def _solve(diagonal: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray) -> np.ndarray:
    """(T - shift I)^-1 b by elimination with row exchanges; a pivot of nothing counts as very small."""
    n = len(diagonal)
    tiny = _EPS * max(np.abs(diagonal).max(), np.abs(off).max(initial=0.0), np.finfo(float).tiny)
    main, upper, second, x = (diagonal - shift).tolist(), [*off.tolist(), 0.0], [0.0] * n, b.tolist()
    for i, below in enumerate(off.tolist()):
        if abs(below) > abs(main[i]):
            factor = main[i] / below
            main[i], main[i + 1], upper[i] = below, upper[i] - factor * main[i + 1], main[i + 1]
            second[i], upper[i + 1] = upper[i + 1], -factor * upper[i + 1]
            x[i], x[i + 1] = x[i + 1], x[i] - factor * x[i + 1]
        else:
            factor = below / (main[i] if main[i] else tiny)
            main[i] = main[i] or tiny
            main[i + 1] -= factor * upper[i]
            x[i + 1] -= factor * x[i]
    for i in range(n - 1, -1, -1):
        total = x[i] - (upper[i] * x[i + 1] if i + 1 < n else 0.0) - (second[i] * x[i + 2] if i + 2 < n else 0.0)
        x[i] = total / (main[i] if abs(main[i]) > tiny * _EPS else tiny)
    return np.array(x)


def eigenvectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A column for each of ``values`` (falling), by inverse iteration; close ones are kept orthogonal."""
    n, draw = len(diagonal), np.random.default_rng(20250301)
    largest = max(np.abs(diagonal).max(), np.abs(off).max(initial=0.0))
    found, cluster, shift = [], 0, np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > _CLUSTER * largest:
            cluster = j
        shift = min(value, shift - 10 * _EPS * largest) if j > cluster else value  # equal ones need different shifts
        x = draw.standard_normal(n)
        for _ in range(6):
            x = _solve(diagonal, off, shift, x / np.abs(x).max())
            x /= np.abs(x).max()
            for _ in range(2):
                for other in found[cluster:]:
                    x -= (other @ x) * other
            x /= np.linalg.norm(x)
        found.append(x)
    return np.array(found).reshape(len(values), n).T


def leading_components(covariance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``k`` eigenvalues, falling, and unit eigenvectors as columns, the largest entry of each positive.

    Eigenvalues that are nothing beside the trace have no component.
    """
    if not len(covariance) or not np.trace(covariance) > 0:
        return np.zeros(0), np.zeros((len(covariance), 0))
    diagonal, off, reflections = tridiagonal(covariance)
    values = leading_eigenvalues(diagonal, off, min(k, len(covariance)))
    values = values[values > _NONE * np.trace(covariance)]
    vectors = eigenvectors(diagonal, off, values)
    for at in range(len(reflections) - 1, -1, -1):
        v = reflections[at]
        vectors[at + 1:] -= 2 * np.outer(v, v @ vectors[at + 1:])
    vectors /= np.linalg.norm(vectors, axis=0)
    return values, vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])


def _rows(vectors: pa.Array, dimension: int) -> Iterator[tuple[int, np.ndarray]]:
    """Some vectors at a time, as a matrix, with the place of the first."""
    step = max(1, _AT_ONCE // dimension)
    for start in range(0, len(vectors), step):
        yield start, vectors.slice(start, step).flatten().to_numpy().reshape(-1, dimension)


def _sums(fit: DataFrame, dimension: int) -> list[int]:
    """The exact total of each entry."""

    @frugal
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = np.zeros(dimension, np.int64), np.zeros(dimension, np.int64)  # halves of 32 bits, which cannot overflow
        for batch in batches:
            for _, x in _rows(batch.column(0), dimension):
                high += (x >> 32).sum(axis=0)
                low += (x & 0xFFFFFFFF).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"place": pa.array(np.arange(dimension), pa.int32()), "high": high, "low": low})

    parts = fit.select("x").mapInArrow(add, "place int, high bigint, low bigint")
    total = parts.groupBy("place").agg(*(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")))
    return [(int(r["high"]) << 32) + int(r["low"]) for r in sorted(total.collect())]


def _covariance(fit: DataFrame, mean: np.ndarray, n: int) -> np.ndarray:
    dimension = len(mean)

    @frugal
    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dimension, dimension))
        for batch in batches:
            for _, x in _rows(batch.column(0), dimension):
                centred = x - mean
                total += centred.T @ centred
        part = pa.array([TaskContext.get().partitionId()] * dimension, pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dimension), pa.int32()), part, pa.array(list(total), pa.list_(pa.float64()))], ["place", "part", "products"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for place, _, products in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                total[place] = total.get(place, 0) + products.values.to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.list_(pa.float64()))], ["place", "products"])

    parts = fit.select("x").mapInArrow(multiply, "place int, part int, products array<double>")
    whole = parts.repartition("place").sortWithinPartitions("place", "part").mapInArrow(add, "place int, products array<double>")
    return np.array([r["products"] for r in sorted(whole.collect())]) / n


def _identity_error(fit: DataFrame, mean: np.ndarray, onto: np.ndarray, n: int) -> float:
    """The largest entry of the whitened vectors' covariance minus the identity."""
    dimension, k = onto.shape

    @frugal
    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            for _, x in _rows(batch.column(0), dimension):
                white = (x - mean) @ onto
                total += np.vstack([white.T @ white, white.sum(axis=0)])
        yield pa.RecordBatch.from_pydict({"slot": pa.array(np.arange(total.size), pa.int32()), "total": total.ravel()})

    parts = fit.select("x").mapInArrow(multiply, "slot int, total double").groupBy("slot").agg(F.sum("total").alias("total"))
    total = np.array([r["total"] for r in sorted(parts.collect())]).reshape(k + 1, k) / n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max(initial=0.0))


def whiten(vectors: DataFrame, components: int = 4, id_col: str = "vec_id", vector_col: str = "vector") -> DataFrame:
    """``id_col, component, n, deviation, whitened, explained, identity_error``: a row for each vector and component.

    ``vectors`` has whole-number vectors without missing entries (see :func:`topk.scaled`). The covariance is over each distinct vector
    once, ``n`` of them; components are numbered from 1 by falling eigenvalue, ``explained`` is the eigenvalue's share of all variance.
    ``deviation`` is the exact sum of (n x - S)^2 over the entries, S being the sums over distinct vectors, or NULL beyond 64 bits.
    Rows that repeat an id, or have none, are projected one by one. NULL vectors take no part, nor do vectors of another length than
    that of the most distinct vectors (of two such, the longer). Where all variance lies in fewer directions, there are fewer
    components; without variance (one distinct vector, no entries, an empty table) no row is returned.
    """
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<bigint>").alias("x")).filter(F.size("x") > 0)
    fit = stage(rows.select("x").distinct(), "whiten-fit")
    lengths = fit.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    dimension, n = lengths or (1, 0)
    fit, rows = (df.filter(F.size("x") == dimension) for df in (fit, rows))
    sums = _sums(fit, dimension) if n else [0]
    mean = np.array([s / n for s in sums]) if n else np.zeros(1)
    covariance = _covariance(fit, mean, n) if n else np.zeros((1, 1))
    values, basis = leading_components(covariance, components)
    onto = basis / np.sqrt(values)
    error = _identity_error(fit, mean, onto, n) if len(values) else 0.0
    exact = np.array(sums, dtype=object)

    @frugal
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, x in _rows(batch.column(1), dimension):
                white = (x - mean) @ onto
                largest = n * (float(np.abs(x.astype(float)).max()) + float(np.abs(mean).max())) + 1
                if dimension * largest * largest < _LONGEST / 2:
                    away = n * x - exact.astype(np.int64)
                    deviation = pa.array((away * away).sum(axis=1))
                else:
                    away = n * x.astype(object) - exact
                    deviation = pa.array([d if d <= _LONGEST else None for d in (away * away).sum(axis=1)], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(x)), deviation, pa.array(list(white), pa.list_(pa.float64()))], ["id", "deviation", "white"])

    projected = rows.mapInArrow(project, f"id {kind}, deviation bigint, white array<double>")
    each = projected.select("id", "deviation", F.posexplode("white").alias("at", "whitened"))
    share = values / np.trace(covariance) if len(values) else [0.0]
    explained = F.element_at(F.array(*(F.lit(float(s)) for s in share)), F.col("at") + 1)
    return each.select(
        F.col("id").alias(id_col), (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
        explained.alias("explained"), F.lit(error).alias("identity_error"))

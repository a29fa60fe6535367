"""Whitening of embeddings by their leading principal components.

The rows are turned into whole numbers, so that equal vectors are equal and sums are exact; the fit
uses each distinct vector once. One pass sums them, the next adds up the products of what is left
of each after the mean is taken off; each task adds its own, and the rows of its matrix meet those
of other tasks by their number. Only the finished matrix reaches the driver, whose size is fixed by
the vectors' dimension (``MOST_DIMENSIONS`` at most). There Householder reflections make it
tridiagonal, Sturm counts bisect for the leading eigenvalues, and inverse iteration gives their
vectors, those of close eigenvalues made orthogonal to each other. The components are broadcast and
every row is projected where it is; a last pass over the distinct vectors measures the outcome.

Defined results: rows whose vector is null or empty, or has a null, infinite or not-a-number entry,
are left out; so are entries beyond ``LARGEST`` and vectors of another dimension than most rows have
(of dimensions that tie, the larger counts). Repeated rows are each projected. A null id stays null.
A matrix of lower rank than asked for has fewer components, and equal vectors alone have none, as an
empty table; then nothing is returned. ``deviation`` is null where it exceeds a long. Further
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runtrail.llm.common import written

SCALE, OFFSET = 64, 1_000_000
LARGEST = 2.0**56
MOST_DIMENSIONS = 4096
#: Rows of a block of vectors.
BLOCK = 4096
EPS = np.finfo(float).eps


def whole_numbers(vector: Column) -> Column:
    """The entries as whole numbers; null if the vector has none or one that does not count."""
    fine = F.size(vector) > 0
    fine = fine & F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) <= LARGEST, F.lit(False)))
    return F.when(fine, F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + OFFSET))


def usable_rows(embeddings: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id`` and ``x`` of the rows that count, of the dimension that most of them have."""
    rows = embeddings.select(
        embeddings[id_col].alias("vec_id"), whole_numbers(embeddings[vector_col]).alias("x")
    ).where("x IS NOT NULL")
    sizes = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("rows"))
    most = sizes.agg(F.max_by("d", F.struct("rows", "d"))).first()[0]
    return rows.where(F.size("x") == (most or 0))


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def blocks_of(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of at most ``BLOCK`` rows, each with its vectors as a matrix."""
    for batch in batches:
        for at in range(0, len(batch), BLOCK):
            part = batch.slice(at, BLOCK)
            yield part, _matrix(part.column("x"), dimensions)


@dataclass(frozen=True)
class Fit:
    """What is known of the distinct vectors: their number, the sums of their entries."""

    n: int
    sums: tuple[int, ...]

    def numerators(self, x: np.ndarray) -> np.ndarray:
        """``n*x - S``, exactly: as long numbers where they fit, else as Python's."""
        largest = int(np.abs(x).max(initial=0)) * self.n + max(map(abs, self.sums))
        kind = np.int64 if largest < 1 << 62 else object
        return x.astype(kind) * self.n - np.array(self.sums, kind)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.numerators(x) / self.n).astype(float)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        d = self.numerators(x)
        bound = int(np.abs(d).max(initial=0)) ** 2 * d.shape[1]
        total = ((d if bound < 1 << 62 else d.astype(object)) ** 2).sum(axis=1).tolist()
        return [int(t) if t < 1 << 63 else None for t in total]


def fit_sums(distinct: DataFrame, dimensions: int) -> Fit:
    """Number and exact sums of the vectors."""
    n = distinct.count()
    entries = distinct.select(F.posexplode("x").alias("i", "v"))
    sums = entries.groupBy("i").agg(F.sum(F.col("v").cast("decimal(28,0)")).alias("s")).collect()
    return Fit(n, tuple(int(r.s) for r in sorted(sums, key=lambda r: r.i)))


def added_rows(parts: DataFrame) -> np.ndarray:
    """The sum of many matrices, given row by row as ``i`` and ``row``."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, row in zip(batch.column("i").to_pylist(), batch.column("row")):
                own = row.values.to_numpy(zero_copy_only=False)
                total[i] = total[i] + own if i in total else own
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([list(r) for r in total.values()], pa.list_(pa.float64()))], ["i", "row"]
        )

    met = parts.repartition("i").mapInArrow(add, "i int, row array<double>")
    rows = sorted(met.collect(), key=lambda r: r.i)
    return np.array([r.row for r in rows])


def _rows_batch(matrix: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(len(matrix), dtype=np.int32)), pa.array(list(matrix), pa.list_(pa.float64()))], ["i", "row"]
    )


def covariance(distinct: DataFrame, fit: Fit) -> tuple[np.ndarray, np.ndarray]:
    """Covariance of the vectors, and the mean that rounding leaves after centring (nearly 0)."""
    d = len(fit.sums)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d + 1, d))
        for _, x in blocks_of(batches, d):
            c = fit.centred(x)
            total[:d] += c.T @ c
            total[d] += c.sum(axis=0)
        yield _rows_batch(total)

    total = added_rows(distinct.mapInArrow(products, "i int, row array<double>")) / fit.n
    mean = total[d]
    return total[:d] - np.outer(mean, mean), mean


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal and off-diagonal of a similar tridiagonal matrix, and the unit vectors of the
    Householder reflections that lead there, in turn.
    """
    a = matrix.copy()
    n = len(a)
    reflections = []
    for k in range(n - 2):
        x = a[k + 1:, k].copy()
        scale = np.abs(x).max()
        v = np.zeros(n - k - 1)
        if scale > 0:
            v = x / scale
            v[0] += np.copysign(np.linalg.norm(v), v[0])
            v /= np.linalg.norm(v)
            rest = a[k + 1:, k + 1:]
            p = rest @ v
            w = 2 * (p - (v @ p) * v)
            rest -= np.outer(v, w) + np.outer(w, v)
            x -= 2 * v * (v @ x)
            a[k + 1:, k] = a[k, k + 1:] = x
        reflections.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), reflections


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each of some numbers: negative pivots of the shifted matrix."""
    least = max(np.finfo(float).tiny / EPS, EPS**2 * float(np.max(off**2, initial=0.0)))
    squares = np.r_[0.0, off**2]
    pivot = np.ones(len(at))
    below = np.zeros(len(at), np.int64)
    for a, b2 in zip(diagonal, squares):
        pivot = a - at - b2 / pivot
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        below += pivot < 0
    return below


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, by bisection down to neighbouring numbers."""
    n = len(diagonal)
    radius = np.r_[0.0, np.abs(off)] + np.r_[np.abs(off), 0.0]
    low, high = float((diagonal - radius).min()), float((diagonal + radius).max())
    spread = max(abs(low), abs(high), np.finfo(float).tiny)
    lows, highs = np.full(k, low - 4 * EPS * spread), np.full(k, high + 4 * EPS * spread)
    wanted = n - 1 - np.arange(k)  # eigenvalues below the sought one
    for _ in range(128):
        middle = 0.5 * (lows + highs)
        open_ = (middle > lows) & (middle < highs) & (highs - lows > 2 * EPS * np.maximum(np.abs(lows), np.abs(highs)))
        if not open_.any():
            break
        above = sturm_counts(diagonal, off, middle) <= wanted
        lows, highs = np.where(above, middle, lows), np.where(above, highs, middle)
    return 0.5 * (lows + highs)


def _solve_shifted(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray) -> np.ndarray:
    """Solves with the shifted matrix by elimination with row exchanges; tiny pivots are lifted."""
    n = len(diagonal)
    norm = float(np.abs(diagonal).max() + 2 * np.abs(off).max(initial=0.0)) or 1.0
    least = EPS * norm
    # Three bands of the upper factor, eliminated in place.
    main, up, upper = [0.0] * n, [0.0] * n, [0.0] * n
    y = right.tolist()
    d, e = diagonal.tolist(), [*off.tolist(), 0.0]
    a, b = d[0] - shift, e[0]
    for i in range(n - 1):
        low, next_a, next_b = e[i], d[i + 1] - shift, e[i + 1]
        if abs(low) > abs(a):
            main[i], up[i], upper[i] = low, next_a, next_b
            factor = a / low
            a, b = b - factor * next_a, -factor * next_b
            y[i], y[i + 1] = y[i + 1], y[i] - factor * y[i + 1]
        else:
            if abs(a) < least:
                a = least
            main[i], up[i], upper[i] = a, b, 0.0
            factor = low / a
            a, b = next_a - factor * b, next_b
            y[i + 1] -= factor * y[i]
    main[n - 1] = a if abs(a) >= least else least
    for i in range(n - 1, -1, -1):
        rest = y[i]
        if i + 1 < n:
            rest -= up[i] * y[i + 1]
        if i + 2 < n:
            rest -= upper[i] * y[i + 2]
        y[i] = rest / main[i]
    out = np.array(y)
    return out / np.abs(out).max()


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, rounds: int = 5) -> np.ndarray:
    """Unit eigenvectors (as columns) of the tridiagonal matrix for its falling eigenvalues.

    A vector is made orthogonal to the ones before it in its cluster, the eigenvalues that follow
    one another at less than a thousandth of the matrix's norm, in every round.
    """
    n = len(diagonal)
    norm = float(np.abs(diagonal).max() + 2 * np.abs(off).max(initial=0.0))
    rng = np.random.default_rng(1)
    vectors = np.zeros((n, len(values)))
    first, shift = 0, np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * norm:
            first = j
        # Equal eigenvalues get shifts that differ, so that their solutions do.
        shift = min(value, shift - 10 * EPS * norm) if j > first else value
        v = rng.uniform(-1, 1, n)
        for _ in range(rounds):
            v = _solve_shifted(diagonal, off, shift, v)
            for _ in range(2):
                v -= vectors[:, first:j] @ (vectors[:, first:j].T @ v)
            v /= np.linalg.norm(v)
        vectors[:, j] = v
    return vectors


@dataclass(frozen=True)
class Components:
    """Unit eigenvectors as columns, their falling eigenvalues, and the trace of the covariance."""

    vectors: np.ndarray
    values: np.ndarray
    trace: float


def principal_components(matrix: np.ndarray, k: int) -> Components:
    """The leading components of a covariance, ``k`` of them or as many as its rank has."""
    n = len(matrix)
    trace = float(np.trace(matrix))
    none = Components(np.zeros((n, 0)), np.zeros(0), trace)
    if n == 0 or not trace > 0:
        return none
    matrix = (matrix + matrix.T) / 2
    scale = float(np.abs(matrix).max())
    diagonal, off, reflections = tridiagonal(matrix / scale)
    values = leading_eigenvalues(diagonal, off, min(k, n))
    values = values[values > 16 * n * EPS * values[0]]
    vectors = inverse_iteration(diagonal, off, values)
    for step in range(len(reflections) - 1, -1, -1):
        v = reflections[step][:, None]
        vectors[step + 1:] -= 2 * v @ (v.T @ vectors[step + 1:])
    vectors /= np.linalg.norm(vectors, axis=0)
    return Components(vectors, values * scale, trace)


def identity_error(distinct: DataFrame, fit: Fit, found: Components, mean: np.ndarray) -> float:
    """Largest entry of the whitened vectors' covariance minus the identity, as measured."""
    d, k = found.vectors.shape
    scaled = found.vectors / np.sqrt(found.values)
    shared = distinct.sparkSession.sparkContext.broadcast((fit, scaled, mean @ scaled))

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, axes, middle = shared.value
        total = np.zeros((k, k))
        for _, x in blocks_of(batches, d):
            w = own.centred(x) @ axes - middle
            total += w.T @ w
        yield _rows_batch(total)

    measured = added_rows(distinct.mapInArrow(products, "i int, row array<double>")) / fit.n
    return float(np.abs(measured - np.eye(k)).max())


def whiten(
    embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 16,
) -> DataFrame:
    """Per usable row and component: ``vec_id``, ``component`` (from 1), ``n``, ``deviation``,
    ``whitened``, ``explained`` and ``identity_error``.
    """
    rows = usable_rows(embeddings, id_col, vector_col)
    distinct = written(rows.select("x").distinct(), "whitening-vectors")
    schema = rows.select("vec_id").schema.add("component", "integer").add("n", "long").add("deviation", "long")
    schema = schema.add("whitened", "double").add("explained", "double").add("identity_error", "double")
    size = distinct.select(F.size("x")).first()
    if size is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    d = size[0]
    if d > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {d} dimensions; the matrix is held by the driver up to {MOST_DIMENSIONS}")
    fit = fit_sums(distinct, d)
    matrix, mean = covariance(distinct, fit)
    found = principal_components(matrix, k)
    count = len(found.values)
    if not count:
        return embeddings.sparkSession.createDataFrame([], schema)
    error = identity_error(distinct, fit, found, mean)
    shared = embeddings.sparkSession.sparkContext.broadcast((fit, found))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, parts = shared.value
        axes, explained = parts.vectors / np.sqrt(parts.values), parts.values / parts.trace
        for part, x in blocks_of(batches, d):
            m = len(part)
            w = own.centred(x) @ axes
            deviation = pa.array(own.deviations(x), pa.int64())
            each = pa.array(np.repeat(np.arange(m), count))
            yield pa.RecordBatch.from_arrays([
                part.column("vec_id").take(each), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), m)),
                pa.array(np.full(m * count, own.n)), deviation.take(each), pa.array(w.ravel()),
                pa.array(np.tile(explained, m)), pa.array(np.full(m * count, error)),
            ], schema.names)

    return rows.mapInArrow(project, schema)

"""Embedding whitening: float32 eigenvectors of an exact covariance, refined in higher precision.

Fit. Components become whole numbers, floor(scale * c) + offset. One pass takes count, sums
and ranges; a second one the products of values centred on the whole part of their mean.
Both are sums of whole numbers, so the covariance doesn't hang on how rows are dealt out,
and a task that is run again gives the same. What leaves a task is one sum for each cell
of the matrix; cells are added up by Spark, and the matrix alone reaches the driver.

Eigenvectors. A float32 solution is refined by Ogita and Aishima's iteration: with
R = I - X'X and S = X'AX, X gains X E, where E divides S + R diag(l) by the distances of the
eigenvalues. Eigenvalues nearer to each other than the residual says can be told apart form
a cluster; there E only restores orthogonality, and a solve of the cluster's own small
matrix, moved by its mean eigenvalue, turns its vectors. Sweeps run in double, then
in long double until corrections vanish.

Odd input. Rows whose vector is null, holds a null or non-finite entry, or one beyond 2^62
after scaling take no part. Vectors of unequal length can't share a covariance: those of
the commonest length (the longer of two) take part. Null ids and repeated rows are rows like
others. Components whose eigenvalue is 0 within rounding can't be whitened and are left out,
so an empty table, a single row or equal vectors give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Rows whose products are summed at once, at most.
BLOCK_ROWS = 8192
#: Whole numbers below this are exact in doubles.
EXACT_DOUBLE = 1 << 53
EXACT_LONG = 1 << 63
SWEEPS = 40

MOMENTS = "width int, cell int, n long, total decimal(38,0), low long, high long"
CELLS = "cell long, value decimal(38,0)"
CROSS = "cell int, value double"
WHITENED = "{id} long, component int, n long, deviation decimal(38,0), whitened double, explained double"


def integer_rows(column: pa.Array, scale: int, offset: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, whole numbers) of the usable vectors of a batch, for each length of vector."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy().astype(np.int64)
    entries = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.floor(scale * entries)
        bad = ~(np.abs(scaled) < float(1 << 62))
    before = np.concatenate([[0], np.cumsum(bad)])
    lengths = np.diff(offsets)
    good = (before[offsets[1:]] == before[offsets[:-1]]) & ~column.is_null().to_numpy(zero_copy_only=False)
    for width in np.unique(lengths[good]):
        rows = np.flatnonzero(good & (lengths == width))
        if width:
            at = offsets[rows][:, None] + np.arange(width)
            yield rows, scaled[at].astype(np.int64) + offset


def _total(x: np.ndarray) -> np.ndarray:
    """Exact column sums."""
    limit = max(abs(int(x.min())), abs(int(x.max())), 1)
    return (x if limit * len(x) < EXACT_LONG else x.astype(object)).sum(axis=0)


def products(y: np.ndarray) -> np.ndarray:
    """Exact y'y of whole numbers, as Python integers."""
    width = y.shape[1]
    largest = max(abs(int(y.min())), abs(int(y.max())), 1)
    out = np.zeros((width, width), object)
    step = min(BLOCK_ROWS, EXACT_DOUBLE // largest**2)
    if step < 1:
        y = y.astype(object)
        return out + y.T @ y
    for start in range(0, len(y), step):
        part = y[start : start + step].astype(np.float64)
        out += (part.T @ part).astype(np.int64)
    return out


def _decimals(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def moments(df: DataFrame, vector_col: str, scale: int, offset: int) -> DataFrame:
    """(width, cell, n, total, low, high): count, exact sum and range of each dimension, by length of vector."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {}
        for batch in batches:
            for _, x in integer_rows(batch.column(0), scale, offset):
                width = x.shape[1]
                n, total, low, high = found.get(width, (0, np.zeros(width, object), x.min(axis=0), x.max(axis=0)))
                found[width] = (n + len(x), total + _total(x).astype(object),
                                np.minimum(low, x.min(axis=0)), np.maximum(high, x.max(axis=0)))
        for width, (n, total, low, high) in found.items():
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(width, width, np.int32)), pa.array(np.arange(width, dtype=np.int32)),
                pa.array(np.full(width, n, np.int64)), _decimals(total), pa.array(low), pa.array(high),
            ], ["width", "cell", "n", "total", "low", "high"])

    return df.select(vector_col).mapInArrow(of, MOMENTS).groupBy("width", "cell").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"))


def product_cells(df: DataFrame, vector_col: str, scale: int, offset: int, centre: np.ndarray) -> DataFrame:
    """(cell, value): exact sums of products of the centred values; cell is row * width + column, column >= row."""
    width = len(centre)
    upper = np.triu_indices(width)
    cells = upper[0].astype(np.int64) * width + upper[1]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for _, x in integer_rows(batch.column(0), scale, offset):
                if x.shape[1] == width:
                    found = products(x - centre)[upper]
                    total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(cells), _decimals(total)], ["cell", "value"])

    return df.select(vector_col).mapInArrow(of, CELLS).groupBy("cell").agg(F.sum("value").alias("value"))


def quotient(numerator: int, denominator: int) -> np.longdouble:
    """A ratio of whole numbers to the full length of a long double."""
    high = numerator / denominator
    a, b = high.as_integer_ratio()
    return np.longdouble(high) + np.longdouble((numerator * b - a * denominator) / (denominator * b))


def _clusters(order: np.ndarray, values: np.ndarray, delta: float) -> list[np.ndarray]:
    """Runs of eigenvalues, in rising order, whose neighbours are no farther apart than delta."""
    cuts = np.flatnonzero(np.diff(values[order]) > delta) + 1
    return [run for run in np.split(order, cuts) if len(run) > 1]


def refine(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, float]:
    """One sweep: corrected eigenvectors of a, and the largest correction."""
    one = np.eye(len(a), dtype=x.dtype)
    r = one - x.T @ x
    s = x.T @ a @ x
    values = np.diag(s) / (1 - np.diag(r))
    size = lambda m: float(np.sqrt((m * m).sum()))
    delta = 2 * (size(s - np.diag(values)) + size(a) * size(r))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > delta
    e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
    x = x + x @ e
    for run in _clusters(np.argsort(values), values, delta):
        own = x[:, run]
        middle = values[run].mean()
        small = own.T @ (a @ own - middle * own)
        _, turn = np.linalg.eigh(((small + small.T) / 2).astype(np.float64))
        x[:, run] = own @ turn.astype(x.dtype)
    return x, float(np.abs(e).max())


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric matrix of long doubles."""
    scale = np.abs(a).max()
    if not scale:
        return np.zeros(len(a), a.dtype), np.eye(len(a), dtype=a.dtype)
    a = a / scale
    _, x = np.linalg.eigh(a.astype(np.float32))
    for kind in (np.float64, np.longdouble):
        work, x = a.astype(kind), x.astype(kind)
        last = np.inf
        for _ in range(SWEEPS):
            x, step = refine(work, x)
            if step <= 8 * np.finfo(kind).eps or (step >= last / 2 and step < 1e-9):
                break
            last = step
    for _ in range(4):
        # Vectors of nearly equal eigenvalues may still lean; the nearest orthogonal basis leaves the others.
        x = x + x @ (np.eye(len(a), dtype=x.dtype) - x.T @ x) / 2
    x = x / np.sqrt((x * x).sum(axis=0))
    values = np.einsum("ij,ij->j", x, a @ x)
    by = np.argsort(-values, kind="stable")
    x = x[:, by]
    x = x * np.where(x[np.abs(x).argmax(axis=0), np.arange(len(a))] < 0, -1, 1)
    return values[by] * scale, x


@dataclass
class Whitening:
    """A fit: rows, exact sums, eigenvalues (falling) with unit eigenvectors as columns, and the trace."""

    id_col: str
    vector_col: str
    scale: int
    offset: int
    n: int
    sums: list[int]
    reach: int
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def _projected(self) -> Callable:
        """Of a batch's vector column: (row numbers, n * x - sums, whitened values)."""
        scale, offset, n, width = self.scale, self.offset, self.n, len(self.sums)
        # n * x - sums is n times the distance from the mean; sums alone may leave 64 bits.
        exact = n * self.reach < EXACT_LONG and max(map(abs, self.sums), default=0) + n * self.reach < EXACT_LONG
        kind = np.int64 if exact else object
        sums = np.array(self.sums, kind)
        to = (self.vectors / np.sqrt(self.values)).astype(np.float64)

        def of(column):
            for rows, x in integer_rows(column, scale, offset):
                if x.shape[1] == width:
                    far = n * x.astype(kind) - sums
                    yield rows, far, (far.astype(np.float64) / n) @ to

        return of

    def identity_error(self, df: DataFrame) -> float:
        """Largest absolute entry of the whitened rows' covariance minus the identity, measured over all rows."""
        projected, count = self._projected(), len(self.values)

        def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((count, count))
            for batch in batches:
                for _, _, z in projected(batch.column(0)):
                    total += z.T @ z
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(count * count, dtype=np.int32)), pa.array(total.ravel())], ["cell", "value"])

        cells = df.select(self.vector_col).mapInArrow(of, CROSS).groupBy("cell").agg(F.sum("value").alias("value"))
        covariance = np.zeros(count * count)
        for r in cells.collect():
            covariance[r["cell"]] = r["value"] / self.n
        return float(np.abs(covariance.reshape(count, count) - np.eye(count)).max())

    def apply(self, df: DataFrame) -> DataFrame:
        """A row for each usable vector and component; deviation is the exact sum of (n * x - sums)^2."""
        projected, n, count = self._projected(), self.n, len(self.values)
        shares = (self.values / self.trace).astype(np.float64)
        exact = len(self.sums) * (n * self.reach) ** 2 < EXACT_LONG
        id_col, vector_col = self.id_col, self.vector_col

        def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0)
                for rows, far, z in projected(batch.column(1)):
                    far = far if exact else far.astype(object)
                    at = np.repeat(rows, count)
                    yield pa.RecordBatch.from_arrays([
                        ids.take(pa.array(at)),
                        pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(rows))),
                        pa.array(np.full(len(at), n, np.int64)),
                        _decimals(np.repeat((far * far).sum(axis=1), count)),
                        pa.array(z.ravel()),
                        pa.array(np.tile(shares, len(rows))),
                    ], [id_col, "component", "n", "deviation", "whitened", "explained"])

        return df.select(F.col(id_col).cast("long").alias(id_col), vector_col).mapInArrow(of, WHITENED.format(id=id_col))


def fit(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 8,
    scale: int = 1024, offset: int = 100_000,
) -> Whitening | None:
    """Whitening of a table's vectors; None if no component has any variance.

    The driver holds one matrix as wide as the vectors, whatever the number of rows.
    """
    found = moments(df, vector_col, scale, offset)
    sizes = found.where("cell = 0").orderBy(F.desc("n"), F.desc("width")).limit(1).collect()
    if not sizes:
        return None
    width, n = sizes[0]["width"], sizes[0]["n"]
    cells = sorted(found.where(F.col("width") == width).collect(), key=lambda r: r["cell"])
    sums = [int(r["total"]) for r in cells]
    centre = [s // n for s in sums]
    reach = max(max(r["high"] - c, c - r["low"]) for r, c in zip(cells, centre)) + 1
    # Sums of the values less their centre; what the centre leaves of the mean is below 1.
    rest = [s - n * c for s, c in zip(sums, centre)]
    covariance = np.zeros((width, width), np.longdouble)
    for r in product_cells(df, vector_col, scale, offset, np.array(centre, np.int64)).collect():
        i, j = divmod(r["cell"], width)
        covariance[i, j] = covariance[j, i] = quotient(n * int(r["value"]) - rest[i] * rest[j], n * n)
    values, vectors = eigen(covariance)
    floor = width * np.finfo(np.float64).eps * values[0]
    count = min(components, int((values > floor).sum()))
    if not count:
        return None
    return Whitening(id_col, vector_col, scale, offset, n, sums, reach, values[:count], vectors[:, :count],
                     np.trace(covariance))


def whitened(df: DataFrame, **options) -> DataFrame:
    """Fit on all usable rows, apply to the same rows, and add the fit's measured identity_error."""
    model = fit(df, **options)
    if model is None:
        id_col = options.get("id_col", "vec_id")
        return df.sparkSession.createDataFrame([], WHITENED.format(id=id_col) + ", identity_error double")
    return model.apply(df).withColumn("identity_error", F.lit(model.identity_error(df)))

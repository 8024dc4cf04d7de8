"""Many logistic regressions over shared scans: every candidate of every fold at once.

Training rows become blocks of numbers, kept for the whole search. One pass over the
blocks gives loss and gradient of all models that are still being fitted: a row counts for
the models whose fold it isn't in, and a block's part is two matrix products. Partial sums
meet in a tree, so the driver gets one array as wide as models times features. There L-BFGS
moves every model by itself and names the points the next pass evaluates. Passes grow with
the longest fit, not with candidates or folds.

The objective is that of `LogisticRegression` without weights or elastic net: mean log loss
plus reg/2 times the squared coefficients, of features divided by their sample deviation
over the fold's training rows when it standardises, the intercept free. Steps are taken on
centred features of unit deviation. A constant feature gets coefficient 0.

`treeAggregate` over an RDD of blocks is used here, as DataFrames have no aggregate of
arrays that combines below the driver without a shuffle of every cell.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from brightfold import config

BLOCKS = "x binary, y binary, fold binary"
BLOCKS_NAME = "training blocks"
#: Corrections that L-BFGS keeps, as the library's optimiser does.
MEMORY = 10
TOLERANCE = 1e-9
ARMIJO = 1e-4
FACTORS = 512


@dataclass(frozen=True)
class Task:
    """One model to fit: its key, the fold it leaves out (None: no fold), and its penalty."""

    key: tuple
    held_out: int | None
    reg: float
    standardise: bool = True
    max_iter: int = 200


@dataclass
class Fit:
    """Coefficients on the features as given, and how the fit ended."""

    task: Task
    coefficients: np.ndarray
    intercept: float
    loss: float
    gradient: float
    iterations: int
    seconds: float = 0.0


def blocks(df: DataFrame, features: str = "features", label: str = config.LABEL, fold: str | None = "fold") -> RDD:
    """Rows as (features, labels, folds) arrays in order of the fold, one block for each Arrow batch, kept in memory or on disk."""
    columns = df.select(
        vector_to_array(F.col(features)).alias("x"), F.col(label).cast("double").alias("y"),
        (F.col(fold) if fold else F.lit(0)).cast("int").alias("fold"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                y, f = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
                order = np.argsort(f, kind="stable")
                x, y, f = x.reshape(len(f), -1)[order], y[order], f[order]
                parts = [x.tobytes(), y.astype(np.float64).tobytes(), f.astype(np.int32).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in parts], ["x", "y", "fold"])

    rows = columns.mapInArrow(of, BLOCKS).rdd.map(lambda r: (bytes(r[0]), bytes(r[1]), bytes(r[2])))
    return rows.setName(BLOCKS_NAME).persist(StorageLevel.MEMORY_AND_DISK)


@dataclass
class FoldMoments:
    """Rows, mean and scaled sums of squares of the features, and positive rows, for each fold."""

    n: dict[int, int]
    positive: dict[int, float]
    mean: dict[int, np.ndarray]
    squares: dict[int, np.ndarray]

    def without(self, held_out: int | None):
        """(n, positive share, mean, sample deviation) over all folds but one."""
        total, positive, mean, squares = 0, 0.0, 0.0, 0.0
        for f, n in sorted(self.n.items()):
            if f != held_out:
                apart = self.mean[f] - mean
                both = total + n
                squares = squares + self.squares[f] + apart**2 * (total * n / both)
                mean = mean + apart * (n / both)
                total, positive = both, positive + self.positive[f]
        return total, positive / total, mean, np.sqrt(squares / max(1, total - 1))


def fold_moments(df: DataFrame, features: str = "features", label: str = config.LABEL, fold: str | None = "fold") -> FoldMoments:
    """One aggregate: map-side combined, one row for each fold."""
    summary = Summarizer.metrics("count", "mean", "variance").summary(F.col(features)).alias("s")
    by = (F.col(fold) if fold else F.lit(0)).cast("int").alias("fold")
    rows = df.groupBy(by).agg(summary, F.sum(F.col(label).cast("double")).alias("positive")).collect()
    n = {r["fold"]: r["s"]["count"] for r in rows}
    return FoldMoments(
        n, {r["fold"]: r["positive"] for r in rows}, {r["fold"]: r["s"]["mean"].toArray() for r in rows},
        {r["fold"]: r["s"]["variance"].toArray() * (r["s"]["count"] - 1) for r in rows})


def losses(data: RDD, held_out: np.ndarray, weights: np.ndarray, intercepts: np.ndarray):
    """(losses, gradients by weight, gradients by intercept), summed over each model's rows; one pass for all.

    `held_out` is each model's fold, -1 for none; weights are features x models.
    """
    width, models = weights.shape
    context = data.context
    sent = context.broadcast((held_out, weights, intercepts))

    def add(total: np.ndarray, block) -> np.ndarray:
        folds, w, b = sent.value
        x = np.frombuffer(block[0]).reshape(-1, width)
        y, f = np.frombuffer(block[1]), np.frombuffer(block[2], np.int32)
        heads = np.flatnonzero(np.append(True, f[1:] != f[:-1]))
        total = total.copy()
        for a, c in zip(heads, [*heads[1:], len(f)]):
            inside = folds != f[a]
            if not inside.any():
                continue
            # One exponential, of a number that isn't positive, serves the probability and the loss.
            part = x[a:c]
            margin = part @ w[:, inside] + b[inside]
            small = np.exp(-np.abs(margin))
            likely = np.where(margin > 0, 1.0, small) / (1 + small)
            rest = likely - y[a:c, None]
            # A product of factors up to 2, of few enough to stay finite, has the sum of their logarithms.
            products = np.multiply.reduceat(1 + small, np.arange(0, len(part), FACTORS), axis=0)
            loss = np.log(products).sum(axis=0) + np.maximum(margin, 0).sum(axis=0) - y[a:c] @ margin
            total[:, inside] += np.vstack([part.T @ rest, rest.sum(axis=0), loss])
        return total

    zero = np.zeros((width + 2, models))
    total = data.treeAggregate(zero, add, np.add)
    sent.unpersist()
    return total[-1], total[:-2], total[-2]


class Descent:
    """L-BFGS for one model, fed one evaluated point at a time.

    Coordinates are the weights of centred features of unit deviation, and the intercept.
    A step is halved until the loss falls enough; where rounding hides the fall,
    a smaller gradient will do.
    """

    def __init__(self, task: Task, n: int, share: float, mean: np.ndarray, deviation: np.ndarray):
        self.task, self.n, self.mean = task, n, mean
        self.live = deviation > 0
        self.scale = np.where(self.live, deviation, 1.0)
        unit = np.ones(len(mean)) if task.standardise else 1 / self.scale**2
        self.penalty = np.append(task.reg * unit * self.live, 0.0)
        self.point = np.zeros(len(mean) + 1)
        self.point[-1] = np.log(share / (1 - share)) if 0 < share < 1 else 0.0
        self.trial, self.step = self.point.copy(), None
        self.loss, self.gradient = np.inf, None
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []
        self.iterations, self.done = 0, False

    def model(self, point: np.ndarray) -> tuple[np.ndarray, float]:
        """Weights and intercept on the features as given."""
        weights = point[:-1] / self.scale * self.live
        return weights, point[-1] - weights @ self.mean

    def take(self, loss: float, by_weight: np.ndarray, by_intercept: float) -> None:
        """What the trial point evaluates to, as sums over the model's rows; sets the next trial or ends."""
        inner = (by_weight - self.mean * by_intercept) / self.scale * self.live / self.n
        gradient = np.append(inner, by_intercept / self.n) + self.penalty * self.trial
        loss = loss / self.n + 0.5 * float(self.penalty @ self.trial**2)
        if self.step is not None and not self._falls(loss, gradient):
            self.step /= 2
            self.done = self.step < 1e-10
            self.trial = self.point + self.step * self.direction
            return
        if self.gradient is not None:
            self.iterations += 1
            moved, turned = self.trial - self.point, gradient - self.gradient
            if moved @ turned > 1e-16 * (turned @ turned):
                self.pairs = [*self.pairs[1 - MEMORY :], (moved, turned)]
        self.point, self.loss, self.gradient = self.trial, loss, gradient
        self.done = np.abs(gradient).max() <= TOLERANCE or self.iterations >= self.task.max_iter
        self.direction, self.step = self._direction(), 1.0
        self.trial = self.point + self.direction

    def _falls(self, loss: float, gradient: np.ndarray) -> bool:
        if loss <= self.loss + ARMIJO * self.step * float(self.gradient @ self.direction):
            return True
        flat = abs(loss - self.loss) <= 1e-12 * abs(self.loss)
        return flat and np.abs(gradient).max() < np.abs(self.gradient).max()

    def _direction(self) -> np.ndarray:
        # A unit feature's curvature is a quarter at most, and that of its penalty.
        q, used, steep = self.gradient.copy(), [], 0.25 + self.penalty
        for moved, turned in reversed(self.pairs):
            a = (moved @ q) / (moved @ turned)
            q -= a * turned
            used.append(a)
        if self.pairs:
            moved, turned = self.pairs[-1]
            q *= (moved @ turned) / (turned @ (turned / steep))
        q /= steep
        for (moved, turned), a in zip(self.pairs, reversed(used)):
            q += (a - (turned @ q) / (moved @ turned)) * moved
        return -q

    def fit(self) -> Fit:
        weights, intercept = self.model(self.point)
        return Fit(self.task, weights, float(intercept), self.loss, float(np.abs(self.gradient).max()), self.iterations)


def gradient_at(data: RDD, moments: FoldMoments, task: Task, coefficients: np.ndarray, intercept: float) -> float:
    """Largest component of the objective's gradient at a model, on features of unit deviation; one pass.

    Small where a fit by any optimiser has converged.
    """
    descent = Descent(task, *moments.without(task.held_out))
    weights = np.where(descent.live, coefficients, 0.0)
    descent.trial = np.append(weights * descent.scale, intercept + weights @ descent.mean)
    held_out = np.array([-1 if task.held_out is None else task.held_out], np.int32)
    loss, by_weight, by_intercept = losses(data, held_out, weights[:, None], np.array([intercept]))
    descent.take(float(loss[0]), by_weight[:, 0], float(by_intercept[0]))
    return float(np.abs(descent.gradient).max())


@dataclass
class SharedFits:
    fits: list[Fit] = field(default_factory=list)
    passes: int = 0


def fit_together(data: RDD, moments: FoldMoments, tasks: Sequence[Task]) -> SharedFits:
    """Fit all tasks over the same blocks; each pass serves every model not yet done."""
    descents = [Descent(t, *moments.without(t.held_out)) for t in tasks]
    result = SharedFits()
    seconds = dict.fromkeys(map(id, descents), 0.0)
    while open_ := [d for d in descents if not d.done]:
        started = time.perf_counter()
        folds = np.array([-1 if d.task.held_out is None else d.task.held_out for d in open_], np.int32)
        models = [d.model(d.trial) for d in open_]
        loss, by_weight, by_intercept = losses(
            data, folds, np.column_stack([w for w, _ in models]), np.array([b for _, b in models]))
        for i, d in enumerate(open_):
            d.take(float(loss[i]), by_weight[:, i], float(by_intercept[i]))
            seconds[id(d)] += (time.perf_counter() - started) / len(open_)
        result.passes += 1
    result.fits = [replace(d.fit(), seconds=seconds[id(d)]) for d in descents]
    return result


SCORED = "model int, label int, score double"


def held_out_scores(
    df: DataFrame, fits: Sequence[Fit], features: str = "features", label: str = config.LABEL, fold: str = "fold"
) -> DataFrame:
    """(model, label, score) of every fold's rows under the fits that left the fold out; one scan for all.

    `model` is the fit's place in the list.
    """
    places = {}
    for i, fit in enumerate(fits):
        places.setdefault(fit.task.held_out, []).append(i)
    weights = {f: (np.array(at, np.int32), np.column_stack([fits[i].coefficients for i in at]),
                   np.array([fits[i].intercept for i in at])) for f, at in places.items()}

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            y, f = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            for held_out, (at, w, b) in weights.items():
                rows = f == held_out
                if rows.any():
                    score = 0.5 * (1 + np.tanh((x[rows] @ w + b) / 2))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.tile(at, len(score))), pa.array(np.repeat(y[rows], len(at)).astype(np.int32)), pa.array(score.ravel())],
                        ["model", "label", "score"])

    columns = df.select(vector_to_array(F.col(features)).alias("x"), F.col(label).cast("int").alias("y"), F.col(fold).cast("int").alias("fold"))
    return columns.mapInArrow(of, SCORED).withColumnRenamed("label", label)

"""Tree ensembles fitted on cells: rows that no split can tell apart, counted once.

A tree sees a feature as one of `maxBins` bins. Each feature gets as many representative
values as bins: all of its values if they are few, else equally spaced quantiles of all
rows. A row belongs to the nearest value, ties to the lower one, and the bins meet halfway
between the values, which is where the library puts the candidate splits of a column that
holds the values alone. So rows of one cell (one bin in each feature) take the same way
down every tree, and a cell with its rows counted as weight says all that they say.

There are at most as many cells as combinations of bins, whatever the rows: a fit's passes
stop growing with the table once it is longer than that. Shorter tables of more combinations
than a task can hold are fitted as they are.

Cells that one task can hold are given to tasks that grow whole trees (`grown`). There, rows are counted
singly, so early stopping and least rows a leaf work on cells too, and shorter tables gain as well.
More cells than that are fitted by the library's trainers.

Bagging stays by rows. Where each row is drawn Poisson(rate) times, a cell of n rows is
drawn Poisson(n * rate) times; without replacement, Binomial(n, rate) times. Every tree
gets its own draws as weights, is fitted by itself, and the trees are put together.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext, inheritable_thread_target
from pyspark.ml.classification import GBTClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from brightfold.operators import grown

ACCURACY = 10_000
#: Cells of a partition on average, and least partitions.
CELLS_A_PARTITION, LEAST_PARTITIONS = 250_000, 8
#: Trees fitted at a time.
PARALLELISM = 8
#: Combinations of bins that one task may hold, and as many rows as these make by label and held-back mark.
CELLS_A_TASK = 2_000_000
ROWS_A_TASK = 4 * CELLS_A_TASK


def _is_ensemble(estimator) -> bool:
    return isinstance(estimator, (RandomForestClassifier, GBTClassifier))


def kept_apart(estimator) -> list[str]:
    """The column that marks an ensemble's held-back rows, if it has one."""
    marks = isinstance(estimator, GBTClassifier) and estimator.isDefined(estimator.validationIndicatorCol)
    return [estimator.getValidationIndicatorCol()] if marks else []


def fits_on_cells(estimator) -> bool:
    """Whether the library's trainers see rows only through sums, so that weights can stand for rows."""
    if not _is_ensemble(estimator):
        return False
    if estimator.isDefined(estimator.weightCol) or estimator.getMinInstancesPerNode() > 1:
        return False
    if isinstance(estimator, GBTClassifier):
        return estimator.getSubsamplingRate() == 1 and not estimator.isDefined(estimator.validationIndicatorCol)
    return not estimator.isDefined(estimator.thresholds)


def representatives(df: DataFrame, bins: int, features: str = "features") -> list[list[float]]:
    """At most `bins` values of each feature: all of them if they are no more, else quantiles of all rows."""
    x = df.select(vector_to_array(F.col(features)).alias("x"))
    first = x.head()
    if first is None:
        return []
    shares = F.array(*[F.lit((k + 0.5) / bins) for k in range(bins)])
    width = len(first["x"])
    row = x.agg(*[
        part for i in range(width)
        for part in (F.percentile_approx(F.col("x")[i], shares, ACCURACY).alias(f"q{i}"),
                     F.approx_count_distinct(F.col("x")[i]).alias(f"n{i}"))
    ]).head()
    few = [i for i in range(width) if row[f"n{i}"] <= 2 * bins]
    values = x.agg(*[F.collect_set(F.col("x")[i]).alias(f"v{i}") for i in few]).head() if few else None
    found = []
    for i in range(width):
        listed = values[f"v{i}"] if i in few else []
        chosen = listed if 0 < len(listed) <= bins else row[f"q{i}"]
        found.append(np.unique(np.array(chosen, float) + 0.0).tolist())
    return found


@dataclass
class Cells:
    """Counted cells: `cell`, the label, further columns and `n`; and the values their bins stand for."""

    frame: DataFrame
    values: list[list[float]]
    label: str
    partitions: int

    def training(self, features: str = "features", where=None, by: Sequence[str] = ()) -> DataFrame:
        """(features, label, n) of each cell and label, and further columns kept apart, in an order that depends on the cells alone.

        Cells that `where` leaves without rows stay, with n = 0: their bins lie between the others'.
        """
        n = F.col("n") if where is None else F.when(where, F.col("n")).otherwise(0)
        rows = self.frame.groupBy("cell", self.label, *by).agg(F.sum(n).alias("n")).repartition(self.partitions, "cell")
        parts, stride = [], 1
        for listed in self.values:
            at = F.expr(f"CAST((cell DIV {stride}) % {len(listed)} AS INT)")
            parts.append(F.get(F.array(*map(F.lit, listed)), at))
            stride *= len(listed)
        return rows.sortWithinPartitions("cell", self.label, *by).select(
            array_to_vector(F.array(*parts)).alias(features), self.label, F.col("n").cast("double").alias("n"), *by)


def counted(
    df: DataFrame, bins: int, features: str, label: str, by: Sequence[str] = (), groups: int = 1, always: int = 0
) -> Cells | None:
    """The rows' cells, or None if there may be as many cells as rows, and more than `always` combinations of bins.

    `by` are further columns to keep apart, of at most `groups` combinations.
    """
    values = representatives(df, bins, features)
    if not values or not all(math.isfinite(v) for listed in values for v in listed):
        return None
    combinations = math.prod(map(len, values))
    bound = 2 * groups * combinations
    if combinations > always and bound > df.count():
        return None
    x = vector_to_array(F.col(features)).alias("x")
    edges = [np.add(v[1:], v[:-1]) / 2 for v in values]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(edges))
            cell, stride = np.zeros(batch.num_rows, np.int64), 1
            for i, edge in enumerate(edges):
                cell += np.searchsorted(edge, rows[:, i]) * stride
                stride *= len(edge) + 1
            yield pa.RecordBatch.from_arrays([pa.array(cell), *batch.columns[1:]], ["cell", *batch.schema.names[1:]])

    kept = df.select(x, label, *by)
    schema = ", ".join(["cell bigint", *(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[1:])])
    frame = kept.mapInArrow(of, schema).groupBy("cell", label, *by).agg(F.count("*").alias("n"))
    return Cells(frame, values, label, max(LEAST_PARTITIONS, -(-bound // groups // CELLS_A_PARTITION)))


@contextmanager
def _kept(df: DataFrame):
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


@contextmanager
def kept_cells(df: DataFrame, estimator, by: Sequence[str] = (), groups: int = 1):
    """The rows' cells for an estimator, kept while it is fitted; None where it is to be fitted on rows."""
    found, grows = None, _is_ensemble(estimator) and grown.grows(estimator)
    if grows or fits_on_cells(estimator):
        by = [*by, *kept_apart(estimator)]
        groups *= 2 ** len(kept_apart(estimator))
        found = counted(
            df, estimator.getMaxBins(), estimator.getFeaturesCol(), estimator.getLabelCol(), by, groups,
            CELLS_A_TASK if grows else 0)
        if found is not None and not fits_on_cells(estimator) and math.prod(map(len, found.values)) > CELLS_A_TASK:
            found = None
    if found is None:
        yield None
    else:
        with _kept(found.frame) as frame:
            yield Cells(frame, found.values, found.label, found.partitions)


def bagged(rows: DataFrame, trees: int, rate: float, replaced: bool, seed: int) -> DataFrame:
    """The rows with `bag`: how often each tree draws from a cell of n rows, every row being drawn by itself."""
    draw = grown.drawn

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random = np.random.default_rng([seed & 0xFFFFFFFF, TaskContext.get().partitionId()])
        for batch in batches:
            n = batch.column(2).to_numpy()[:, None]
            drawn = draw(random, n, rate, replaced, (batch.num_rows, trees))
            bag = pa.ListArray.from_arrays(
                np.arange(0, drawn.size + 1, trees, dtype=np.int32), pa.array(drawn.ravel().astype(np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns, bag], ["x", "label", "n", "bag"])

    features, label, _ = rows.columns
    plain = rows.select(vector_to_array(F.col(features)).alias("x"), F.col(label).cast("double").alias("label"), "n")
    drawn = plain.mapInArrow(of, "x array<double>, label double, n double, bag array<bigint>")
    return drawn.select(array_to_vector("x").alias(features), F.col("label").alias(label), "n", "bag")


def fit_on_cells(estimator, rows: DataFrame):
    """The ensemble of weighted cells (features, label, n, and the mark of held-back rows if the estimator has one)."""
    label = estimator.getLabelCol()
    if grown.grows(estimator):
        with _kept(rows) as kept:
            known = F.col(label).isNotNull() & F.col(label).isin(0, 1)
            x = vector_to_array(F.col(estimator.getFeaturesCol()))
            n, binary, width = kept.agg(F.count("*"), F.bool_and(known), F.max(F.size(x))).head()
            if binary and n <= ROWS_A_TASK:
                return grown.fit_grown(estimator, kept, width)
    if not fits_on_cells(estimator):
        raise ValueError("labels are 0 or 1")
    rows = rows.where("n > 0")
    if isinstance(estimator, GBTClassifier):
        weighted = estimator.copy().setWeightCol("n")
        with _kept(rows) as rows:
            model = weighted.fit(rows)
        model.clear(model.weightCol)
        return model
    trees = estimator.getNumTrees()
    one = estimator.copy().setNumTrees(1).setBootstrap(False).setSubsamplingRate(1.0).setWeightCol("n")
    if trees > 1 and estimator.getFeatureSubsetStrategy() == "auto":
        one.setFeatureSubsetStrategy("sqrt")
    with _kept(bagged(rows, trees, estimator.getSubsamplingRate(), estimator.getBootstrap(), estimator.getSeed())) as rows:
        classes = int(rows.agg(F.max(label)).head()[0]) + 1
        nominal = {"ml_attr": {"type": "nominal", "vals": [str(c) for c in range(classes)]}}

        def tree(t: int):
            drawn = rows.where(F.col("bag")[t] > 0).select(
                estimator.getFeaturesCol(), F.col(label).alias(label, metadata=nominal), F.col("bag")[t].cast("double").alias("n"))
            return one.copy().setSeed((estimator.getSeed() + 1_000_003 * t) & 0x7FFFFFFF).fit(drawn)

        with ThreadPool(min(PARALLELISM, trees)) as pool:
            fitted = pool.map(inheritable_thread_target(rows.sparkSession)(tree), range(trees), chunksize=1)
    return joined(estimator, fitted, rows.sparkSession)


def joined(
    estimator: RandomForestClassifier, forests: Sequence[RandomForestClassificationModel], spark: SparkSession
) -> RandomForestClassificationModel:
    """One forest of the trees of several."""
    context = spark.sparkContext
    classes = context._jvm.org.apache.spark.ml.classification
    trees = [t for f in forests for t in f._java_obj.trees()]
    array = context._gateway.new_array(classes.DecisionTreeClassificationModel, len(trees))
    for i, t in enumerate(trees):
        array[i] = t
    java = classes.RandomForestClassificationModel(
        estimator.uid, array, forests[0].numFeatures, forests[0].numClasses)
    return estimator._copyValues(RandomForestClassificationModel(java))


def fit(estimator, df: DataFrame):
    """As `estimator.fit(df)`; on counted cells where these are fewer than the rows and say as much."""
    with kept_cells(df, estimator) as found:
        if found is None:
            return estimator.fit(df)
        return fit_on_cells(estimator, found.training(estimator.getFeaturesCol(), by=kept_apart(estimator)))

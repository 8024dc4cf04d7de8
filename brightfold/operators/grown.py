"""Ensembles grown by tasks of their own from counted cells.

Once a table has become its cells (`cells`), all that a tree learns from fits in one task. The
library's trainers make several jobs for each level of each tree, some thousand for one ensemble,
whose length is that of scheduling. Here a task takes the cells and grows whole trees level by
level, by the library's rules: the candidate splits lie halfway between neighbouring values,
the split of highest gain wins (the first of equal ones), a node of no impurity or no gain ends, and
in a classification tree leaves that agree are merged. Boosting ends by the library's rule where rows are held
back. A forest's trees are dealt to tasks; each has its own draws, by its number, so that neither tasks nor
partitions change it.

The nodes are written by the tasks in the library's model format, so the model can be loaded from there.
Scoring needs no loaded model: a worker takes the nodes as arrays and walks each combination of
intervals between thresholds once.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from brightfold.session import workspace

# Tasks get these functions themselves: their workers need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A forest's trees of one task.
TREES_A_TASK = 12
SUBSETS = {
    "all": lambda n: n,
    "sqrt": lambda n: int(np.ceil(np.sqrt(n))),
    "log2": lambda n: max(1, int(np.ceil(np.log2(n)))),
    "onethird": lambda n: int(np.ceil(n / 3)),
}
PLAIN_NODES = (
    "treeID int, id int, prediction double, impurity double, s0 double, s1 double, s2 double, rawCount bigint, gain double,"
    " leftChild int, rightChild int, feature int, threshold double"
)
#: The library's form of nodes.
NODES = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>,"
    " rawCount: bigint, gain: double, leftChild: int, rightChild: int,"
    " split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)


def grows(estimator) -> bool:
    """Whether an ensemble's settings are among those whose rules are written out here."""
    if estimator.isDefined(estimator.weightCol) or estimator.isDefined(estimator.thresholds):
        return False
    if estimator.getMinWeightFractionPerNode() > 0:
        return False
    if isinstance(estimator, GBTClassifier):
        return estimator.getSubsamplingRate() == 1 and estimator.getFeatureSubsetStrategy() == "all"
    if not isinstance(estimator, RandomForestClassifier):
        return False
    return estimator.getImpurity() == "gini" and estimator.getFeatureSubsetStrategy() in ("auto", *SUBSETS)


@dataclass
class Table:
    """Cells in the order of their values: `bins` by feature, the values between them, and rows by label."""

    bins: list[np.ndarray]
    edges: list[np.ndarray]
    #: Rows of label 0 and 1: those trained on, and those held back.
    rows: tuple[np.ndarray, np.ndarray]
    held: tuple[np.ndarray, np.ndarray]


def table(x: np.ndarray, label: np.ndarray, n: np.ndarray, held: np.ndarray) -> Table:
    """Cells of (values, label, rows, whether held back), in any order; a value of no rows keeps its bin."""
    code, stride, values, sizes = np.zeros(len(x), np.int64), 1, [], []
    for i in range(x.shape[1]):
        found, at = np.unique(x[:, i] + 0.0, return_inverse=True)
        code += at * stride
        stride *= len(found)
        values.append(found)
        sizes.append(len(found))
    cells, at = np.unique(code, return_inverse=True)
    bins, stride = [], 1
    for size in sizes:
        bins.append((cells // stride) % size)
        stride *= size

    def counts(positive: bool, back: bool) -> np.ndarray:
        return np.bincount(at, np.where((label == positive) & (held == back), n, 0.0), len(cells))

    edges = [(v[1:] + v[:-1]) / 2 for v in values]
    return Table(bins, edges, (counts(False, False), counts(True, False)), (counts(False, True), counts(True, True)))


@dataclass
class Tree:
    """Nodes by level; a leaf has no feature and no left child, a right child follows the left one."""

    a: np.ndarray
    b: np.ndarray
    feature: np.ndarray
    edge: np.ndarray
    gain: np.ndarray
    left: np.ndarray


@dataclass
class Rules:
    """What a tree is grown by. `a` and `b` are the two sums a node has."""

    #: Rows of the sums, and the part of the impurity that splits lower, times the rows.
    weight: Callable[[np.ndarray, np.ndarray], np.ndarray]
    worth: Callable[[np.ndarray, np.ndarray], np.ndarray]
    depth: int
    least_rows: int
    least_gain: float
    #: Features that a node may split by.
    subset: int
    #: Whether the sums are whole numbers, so that differences of running totals are exact.
    whole: bool


#: Rows and the sum of what is to be predicted, and rows of either label.
VARIANCE = (lambda n, s: n, lambda n, s: np.divide(s * s, n, out=np.zeros_like(s), where=n > 0))
GINI = (lambda n0, n1: n0 + n1,
        lambda n0, n1: np.divide(n0 * n0 + n1 * n1, n0 + n1, out=np.zeros_like(n0), where=n0 + n1 > 0))


def _gains(rules: Rules, left, total) -> np.ndarray:
    """Gain of splitting nodes of given sums so that the left child has these; -inf where a child is too small."""
    right = total[0] - left[0], total[1] - left[1]
    fits = (rules.weight(*left) >= rules.least_rows) & (rules.weight(*right) >= rules.least_rows)
    rows = rules.weight(*total)
    gain = (rules.worth(*left) + rules.worth(*right) - rules.worth(*total)) / np.where(rows > 0, rows, 1)
    return np.where(fits, gain, -np.inf)


def _dense_best(rules: Rules, node, bins, size, a, b, total) -> tuple[np.ndarray, np.ndarray]:
    """Best gain of each node by one feature, and the bin it splits after, from histograms."""
    nodes, at = len(total[0]), node * size + bins
    left = [np.cumsum(np.bincount(at, v, nodes * size).reshape(nodes, size), axis=1)[:, :-1] for v in (a, b)]
    gain = _gains(rules, left, (total[0][:, None], total[1][:, None]))
    best = gain.argmax(axis=1)
    return gain[np.arange(nodes), best], best


def _sparse_best(rules: Rules, node, bins, size, a, b, total) -> tuple[np.ndarray, np.ndarray]:
    """As `_dense_best`, from sorted cells: for whole sums, and more nodes than cells would fill with bins."""
    nodes, at = len(total[0]), node * size + bins
    order = np.argsort(at, kind="stable")
    at = at[order]
    gain, best = np.full(nodes, -np.inf), np.zeros(nodes, np.int64)
    if not len(at):
        return gain, best
    last = np.flatnonzero(np.append(at[1:] != at[:-1], True))
    owner = at[last] // size
    first = np.append(True, owner[1:] != owner[:-1])
    left = []
    for v in (a, b):
        running = np.cumsum(v[order])[last]
        before = np.append(0.0, running[:-1])[first]
        left.append(running - before[np.cumsum(first) - 1])
    found = _gains(rules, left, (total[0][owner], total[1][owner]))
    starts = np.flatnonzero(first)
    highest = np.maximum.reduceat(found, starts)
    candidates = np.where(found == np.repeat(highest, np.diff(np.append(starts, len(found)))), np.arange(len(found)), len(found))
    chosen = np.minimum.reduceat(candidates, starts)
    gain[owner[starts]], best[owner[starts]] = highest, at[last][chosen] % size
    return gain, best


def grow(cells: Table, a: np.ndarray, b: np.ndarray, rules: Rules, random=None) -> tuple[Tree, np.ndarray]:
    """A tree of cells that each have the sums `a` and `b`, and the leaf that every cell ends in."""
    sizes = [len(e) + 1 for e in cells.edges]
    bins, at = np.stack(cells.bins), np.arange(len(a))
    here, node, leaf = at, np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    levels, offset, nodes = [], 0, 1
    for level in range(rules.depth + 1):
        total = np.bincount(node, a, nodes), np.bincount(node, b, nodes)
        gain, feature, edge = np.full(nodes, -np.inf), np.full(nodes, -1), np.zeros(nodes, np.int64)
        if level < rules.depth:
            allowed = np.ones((nodes, len(sizes)), bool)
            if rules.subset < len(sizes):
                allowed = random.random(allowed.shape).argsort(axis=1) < rules.subset
            for i, size in enumerate(sizes):
                if size < 2:
                    continue
                if rules.whole and nodes * size > len(node):
                    part = allowed[node, i]
                    found, best = _sparse_best(rules, node[part], bins[i][part], size, a[part], b[part], total)
                else:
                    found, best = _dense_best(rules, node, bins[i], size, a, b, total)
                better = allowed[:, i] & (found > gain)
                gain, feature, edge = np.where(better, found, gain), np.where(better, i, feature), np.where(better, best, edge)
        split = (gain > 0) & (gain >= rules.least_gain)
        left = np.where(split, offset + nodes + 2 * (np.cumsum(split) - 1), -1)
        levels.append(Tree(*total, np.where(split, feature, -1), edge, np.where(split, gain, -1.0), left))
        if not split.all():
            stays = split[node]
            leaf[here[~stays]] = offset + node[~stays]
            if not split.any():
                break
            here, node, a, b, bins = here[stays], node[stays], a[stays], b[stays], bins[:, stays]
        node = left[node] - offset - nodes + (bins[feature[node], at[:len(node)]] > edge[node])
        offset, nodes = offset + nodes, 2 * int(split.sum())
    return Tree(*(np.concatenate([getattr(t, f) for t in levels]) for f in Tree.__dataclass_fields__)), leaf


def merged(tree: Tree, prediction: np.ndarray) -> Tree:
    """The tree with leaves of one parent merged where they predict the same."""
    left = tree.left.copy()
    # Children follow their parents, so a pass over the levels from below sees every pair after its own children.
    depth = np.zeros(len(left), np.int64)
    inner, level = np.array([0] if left[0] >= 0 else [], np.int64), 0
    by_level = []
    while len(inner):
        by_level.append(inner)
        below = np.concatenate([left[inner], left[inner] + 1])
        level += 1
        depth[below] = level
        inner = np.sort(below[left[below] >= 0])
    for inner in reversed(by_level):
        one = left[inner]
        same = (left[one] < 0) & (left[one + 1] < 0) & (prediction[one] == prediction[one + 1])
        left[inner[same]] = -1
    kept = np.zeros(len(left), bool)
    kept[0] = True
    for inner in by_level:
        live = inner[kept[inner] & (left[inner] >= 0)]
        kept[left[live]] = kept[left[live] + 1] = True
    number = np.cumsum(kept) - 1
    inside = left >= 0
    return Tree(
        tree.a[kept], tree.b[kept], np.where(inside, tree.feature, -1)[kept], tree.edge[kept],
        np.where(inside, tree.gain, -1.0)[kept], np.where(inside, number[left], -1)[kept])


def _batch(cells: Table, number: int, tree: Tree, prediction, impurity, stats, rows) -> pa.RecordBatch:
    """A tree's nodes as plain rows."""
    count, inside = len(tree.left), tree.left >= 0
    threshold = np.zeros(count)
    for i, edges in enumerate(cells.edges):
        mine = tree.feature == i
        threshold[mine] = edges[tree.edge[mine]]
    columns = {
        "treeID": np.full(count, number, np.int32), "id": np.arange(count, dtype=np.int32), "prediction": prediction.astype(float),
        "impurity": impurity, "s0": stats[0], "s1": stats[1], "s2": stats[-1], "rawCount": rows.astype(np.int64),
        "gain": tree.gain, "leftChild": tree.left.astype(np.int32), "rightChild": np.where(inside, tree.left + 1, -1).astype(np.int32),
        "feature": tree.feature.astype(np.int32), "threshold": threshold}
    return pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], [*columns])


def _as_written(plain: DataFrame, stats: int) -> DataFrame:
    """Plain nodes in the library's form, which a task would hand over far slower."""
    none = F.array().cast("array<double>")
    split = F.struct(
        F.col("feature").alias("featureIndex"),
        F.when(F.col("feature") >= 0, F.array("threshold")).otherwise(none).alias("leftCategoriesOrThreshold"),
        F.lit(-1).alias("numCategories"))
    return plain.select("treeID", F.struct(
        "id", "prediction", "impurity", F.array(*[f"s{i}" for i in range(stats)]).alias("impurityStats"), "rawCount", "gain",
        "leftChild", "rightChild", split.alias("split")).alias("nodeData"))


def forest(cells: Table, trees, rate: float, replaced: bool, seed: int, rules: Rules) -> Iterator[pa.RecordBatch]:
    """Trees of the given numbers, each grown on its own draws of the rows."""
    for number in trees:
        random = np.random.default_rng([seed & 0xFFFFFFFF, number])
        bag = [drawn(random, n, rate, replaced, n.shape).astype(float) for n in cells.rows]
        used = bag[0] + bag[1] > 0
        some = Table([v[used] for v in cells.bins], cells.edges, (bag[0][used], bag[1][used]), cells.held)
        tree, _ = grow(some, *some.rows, rules, random)
        tree = merged(tree, tree.b > tree.a)
        rows = tree.a + tree.b
        impurity = 1 - rules.worth(tree.a, tree.b) / np.where(rows > 0, rows, 1)
        yield _batch(cells, number, tree, tree.b > tree.a, impurity, (tree.a, tree.b), rows)


def drawn(random, n: np.ndarray, rate: float, replaced: bool, shape) -> np.ndarray:
    """How many of a cell's n rows are drawn, every row by itself."""
    return random.poisson(n * rate, shape) if replaced else random.binomial(n.astype(np.int64), rate, shape)


def boosted(cells: Table, rounds: int, step: float, tolerance: float | None, rules: Rules) -> Iterator[pa.RecordBatch]:
    """Rounds of boosting; with a tolerance, those that the loss of the held-back rows keeps."""
    (n0, n1), (v0, v1) = cells.rows, cells.held
    rows, margin = n0 + n1, np.zeros(len(n0))
    found, best, kept = [], np.inf, rounds if tolerance is None else 1
    for m in range(rounds):
        with np.errstate(over="ignore"):
            up, down = (1.0, -1.0) if m == 0 else (4 / (1 + np.exp(2 * margin)), -4 / (1 + np.exp(-2 * margin)))
        tree, leaf = grow(cells, rows, n1 * up + n0 * down, rules)
        squares = np.bincount(leaf, n1 * up * up + n0 * down * down, len(tree.left))
        for level in _parents_last(tree):
            squares[level] = squares[tree.left[level]] + squares[tree.left[level] + 1]
        count = np.where(tree.a > 0, tree.a, 1)
        prediction = tree.b / count
        impurity = np.maximum(0.0, (squares - tree.b * prediction) / count)
        found.append(_batch(cells, m, tree, prediction, impurity, (tree.a, tree.b, squares), tree.a))
        margin = margin + (1.0 if m == 0 else step) * prediction[leaf]
        if tolerance is None:
            continue
        held = (v1 * np.logaddexp(0, -2 * margin) + v0 * np.logaddexp(0, 2 * margin)).sum() * 2
        loss = held / (v0 + v1).sum() if (v0 + v1).any() else np.nan
        if m == 0:
            best = loss
        elif best - loss < tolerance * max(loss, 0.01):
            break
        elif loss < best:
            best, kept = loss, m + 1
    yield from found[:kept]


def _parents_last(tree: Tree) -> list[np.ndarray]:
    """Inner nodes by level, the deepest first."""
    levels, inner = [], np.array([0] if tree.left[0] >= 0 else [], np.int64)
    while len(inner):
        levels.append(inner)
        below = np.concatenate([tree.left[inner], tree.left[inner] + 1])
        inner = below[tree.left[below] >= 0]
    return levels[::-1]


def fit_grown(estimator, rows: DataFrame, width: int) -> Grown:
    """The ensemble of cells (features, label, n, and where rows are held back their mark), grown by tasks of its own."""
    boosts = isinstance(estimator, GBTClassifier)
    mark = F.lit(False)
    if boosts and estimator.isDefined(estimator.validationIndicatorCol):
        mark = F.col(estimator.getValidationIndicatorCol())
    plain = rows.select(
        vector_to_array(F.col(estimator.getFeaturesCol())).alias("x"), F.col(estimator.getLabelCol()).cast("double").alias("label"),
        F.col("n").cast("double").alias("n"), mark.alias("held")).where("held IS NOT NULL")
    trees = 1 if boosts else estimator.getNumTrees()
    depth, least, gain = estimator.getMaxDepth(), estimator.getMinInstancesPerNode(), estimator.getMinInfoGain()
    seed = estimator.getSeed()
    if boosts:
        rules = Rules(*VARIANCE, depth, least, gain, width, False)
        rounds, step = estimator.getMaxIter(), estimator.getStepSize()
        tolerance = estimator.getValidationTol() if estimator.isDefined(estimator.validationIndicatorCol) else None
    else:
        strategy = estimator.getFeatureSubsetStrategy()
        strategy = ("all" if trees == 1 else "sqrt") if strategy == "auto" else strategy
        rules = Rules(*GINI, depth, least, gain, SUBSETS[strategy](width), True)
        rate, replaced = estimator.getSubsamplingRate(), estimator.getBootstrap()

    parts = -(-trees // TREES_A_TASK)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = [
            (b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, width),
             *(b.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3, 4))) for b in batches if b.num_rows]
        if not read:
            return
        x, y, n, held, part = (np.concatenate(p) for p in zip(*read))
        cells = table(x, y, n, held.astype(bool))
        yield from boosted(cells, rounds, step, tolerance, rules) if boosts else forest(
            cells, range(int(part[0]), trees, parts), rate, replaced, seed, rules)

    # Every task that grows trees gets all cells; a union of such tasks would run in one.
    sent = plain.withColumn("part", F.explode(F.array(*map(F.lit, range(parts))))).repartitionById(parts, "part")
    nodes = sent.mapInArrow(of, PLAIN_NODES)
    root = workspace(rows.sparkSession, "grown")
    _as_written(nodes, 3 if boosts else 2).write.parquet(f"{root}/data")
    return Grown(estimator.copy(), root, width)


class Grown:
    """A grown ensemble by its written nodes; all else is the library's model, loaded once it is asked for.

    Scoring needs the nodes alone (`scorer`). `save` gives a folder that the library loads.
    """

    def __init__(self, estimator, root: str, width: int):
        self._estimator, self._root, self._width = estimator, root, width
        self._model = self._scorer = None
        self._described = False

    def __getattr__(self, name: str):
        if name.startswith("__"):
            raise AttributeError(name)
        return getattr(self.loaded(), name)

    @property
    def boosts(self) -> bool:
        return isinstance(self._estimator, GBTClassifier)

    @property
    def treeWeights(self) -> list[float]:
        rest = len(self.scorer()["roots"]) - 1
        return [1.0] + rest * [self._estimator.getStepSize() if self.boosts else 1.0]

    def _describe(self) -> None:
        """Write the metadata beside the nodes, in the library's form."""
        if self._described:
            return
        spark, estimator = SparkSession.getActiveSession(), self._estimator
        roots = spark.read.schema(NODES).parquet(f"{self._root}/data").where("nodeData.id = 0").select("treeID").collect()
        numbers = sorted(r["treeID"] for r in roots)

        def metadata(of: str, uid: str, given: dict, defaults: dict, **more) -> str:
            return json.dumps({
                "class": f"org.apache.spark.ml.{of}", "timestamp": 0, "sparkVersion": spark.version, "uid": uid,
                "paramMap": given, "defaultParamMap": defaults, **more})

        of_tree = "regression.DecisionTreeRegressionModel" if self.boosts else "classification.DecisionTreeClassificationModel"
        set_in = {"maxDepth": estimator.getMaxDepth(), "seed": estimator.getSeed()}
        trees = [
            (t, metadata(of_tree, f"{'dtr' if self.boosts else 'dtc'}_{t}_{estimator.uid}", set_in, {"impurity": estimator.getImpurity()}),
             estimator.getStepSize() if self.boosts and t else 1.0) for t in numbers]
        spark.createDataFrame(trees, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{self._root}/treesMetadata")
        given, defaults = ({p.name: v for p, v in m.items()} for m in (estimator._paramMap, estimator._defaultParamMap))
        about = {"numFeatures": self._width, "numTrees": len(numbers), **({} if self.boosts else {"numClasses": 2})}
        text = metadata(f"classification.{self._kind().__name__}", estimator.uid, given, defaults, **about)
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{self._root}/metadata")
        self._described = True

    def _kind(self):
        return GBTClassificationModel if self.boosts else RandomForestClassificationModel

    def loaded(self):
        """The library's model."""
        if self._model is None:
            self._describe()
            self._model = self._kind().load(self._root)
        return self._model

    def scorer(self) -> dict:
        if self._scorer is None:
            self._scorer = read_scorer(self._root, [1.0, self._estimator.getStepSize()] if self.boosts else None)
        return self._scorer

    def save(self, path: str) -> None:
        """Write the model to a path, in place of what is there."""
        self._describe()
        context = SparkSession.getActiveSession().sparkContext
        hadoop, conf = context._jvm.org.apache.hadoop.fs, context._jsc.hadoopConfiguration()
        source, target = hadoop.Path(self._root), hadoop.Path(path)
        files = target.getFileSystem(conf)
        files.delete(target, True)
        hadoop.FileUtil.copy(source.getFileSystem(conf), source, files, target, False, conf)


#: Nodes from which on a loaded forest is scored by its nodes: the library sends a model with every task.
LARGE = 100_000
#: Combinations of the intervals between thresholds whose scores a worker keeps.
KEPT_SCORES = 4_000_000
#: Rows that go down the trees together.
WALKED = 65_536


def read_scorer(path: str, weights: list[float] | None) -> dict:
    """What scoring needs of a written ensemble, as arrays: for boosting with the weights of the first and of later trees."""
    spark = SparkSession.getActiveSession()
    node = F.col("nodeData")
    stats = node["impurityStats"]
    value = F.get(stats, F.lit(1)) / (F.get(stats, F.lit(0)) + F.get(stats, F.lit(1))) if weights is None else node["prediction"]
    read = spark.read.schema(NODES).parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), node["id"].alias("id"), node["split"]["featureIndex"].alias("feature"),
        F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"), node["leftChild"].alias("left"),
        node["rightChild"].alias("right"), value.alias("value")).toArrow()
    found = {c: read.column(c).to_numpy() for c in read.column_names}
    order = np.lexsort((found["id"], found["tree"]))
    tree, feature, threshold, left, right, value = (found[c][order] for c in ("tree", "feature", "threshold", "left", "right", "value"))
    first = np.flatnonzero(np.append(True, tree[1:] != tree[:-1]))
    start = np.repeat(first, np.diff(np.append(first, len(tree))))
    inside = feature >= 0
    used, thresholds, edge = [], [], np.zeros(len(tree), np.int32)
    for i in np.unique(feature[inside]):
        mine = feature == i
        used.append(int(i))
        thresholds.append(np.unique(threshold[mine]))
        edge[mine] = np.searchsorted(thresholds[-1], threshold[mine])
    value = value.astype(float)
    if weights is not None:
        value = value * np.where(tree == tree[0], weights[0], weights[1])
    return {
        "boosts": weights is not None, "used": used, "thresholds": thresholds, "roots": first,
        "feature": np.where(inside, np.searchsorted(used, feature) if used else 0, -1).astype(np.int16), "edge": edge,
        "left": (start + left).astype(np.int32), "right": (start + right).astype(np.int32), "value": value}


def _walked(scorer: dict, bins: np.ndarray) -> np.ndarray:
    """Scores of rows given by the interval each used feature lies in."""
    out = np.zeros(bins.shape[1])
    feature, edge, left, right, value = (scorer[k] for k in ("feature", "edge", "left", "right", "value"))
    for begin in range(0, len(out), WALKED):
        part = bins[:, begin:begin + WALKED]
        total = np.zeros(part.shape[1])
        for root in scorer["roots"]:
            row, at = np.arange(part.shape[1]), np.full(part.shape[1], root)
            while len(row):
                by = feature[at]
                ended = by < 0
                if ended.any():
                    total[row[ended]] += value[at[ended]]
                    row, at, by = row[~ended], at[~ended], by[~ended]
                at = np.where(part[by, row] > edge[at], right[at], left[at])
        out[begin:begin + WALKED] = total
    return 1 - 1 / (1 + np.exp(2 * out)) if scorer["boosts"] else out / len(scorer["roots"])


def scored(scorer: dict, columns: list[np.ndarray]) -> np.ndarray:
    """Scores of rows by the columns of the used features. Rows between the same thresholds have one score, found once."""
    bins = [np.searchsorted(t, c) for t, c in zip(scorer["thresholds"], columns)]
    sizes = [len(t) + 1 for t in scorer["thresholds"]]
    if float(np.prod(np.array(sizes, float))) > KEPT_SCORES:
        return _walked(scorer, np.stack(bins))
    kept = scorer.setdefault("kept", np.full(int(np.prod(sizes, dtype=np.int64)), np.nan))
    code = np.ravel_multi_index(bins, sizes)
    score = kept[code]
    if np.isnan(score).any():
        new = np.unique(code[np.isnan(score)])
        kept[new] = _walked(scorer, np.stack(np.unravel_index(new, sizes)))
        score = kept[code]
    return score


def score_column(scorer: dict, features: str):
    """The score of a vector column's rows as a column; tasks get the nodes once, as arrays."""
    if not scorer["used"]:
        return F.lit(float(_walked(scorer, np.zeros((1, 1), np.int64))[0]))
    sent = SparkSession.getActiveSession().sparkContext.broadcast(scorer)

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        return pd.Series(scored(sent.value, [c.to_numpy() for c in columns]))

    x = vector_to_array(F.col(features))
    return score(*[x[i] for i in scorer["used"]])


def scorer_of(model) -> dict | None:
    """Arrays to score a model by, if it is better scored so: a grown one, or a large forest that was loaded."""
    if isinstance(model, Grown):
        return model.scorer()
    return getattr(model, "read_nodes", None)


def remember_nodes(model, path: str):
    """A model just loaded from a path; a large forest of two classes keeps its nodes as arrays beside."""
    if isinstance(model, RandomForestClassificationModel) and model.numClasses == 2 and not model.isDefined(model.thresholds):
        if model.totalNumNodes > LARGE:
            model.read_nodes = read_scorer(path, None)
    return model


def features_of(model) -> str:
    """The model's vector column, without loading a grown one."""
    return model._estimator.getFeaturesCol() if isinstance(model, Grown) else model.getFeaturesCol()

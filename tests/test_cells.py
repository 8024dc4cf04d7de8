"""Ensembles on counted cells: the same splits as on rows, bagging by rows, and fits that stop growing with the table."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import functions as F

from brightfold.operators import cells, tuning
from brightfold.operators.estimators import make_estimator, param_map
from brightfold.operators.features import assemble
from brightfold.operators.scoring import positive_probability, predict


def _rows(spark, n, seed=5):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 9, n), rng.integers(0, 7, n) / 4
    c = np.round(rng.exponential(size=n), 1)
    y = (a / 9 + b - c / 2 + rng.normal(size=n) * 0.6 > 0.8).astype(int)
    rows = [(i % 3, int(t), float(p), float(q), float(r)) for i, (t, p, q, r) in enumerate(zip(y, a, b, c))]
    df = spark.createDataFrame(rows, "fold int, label int, a double, b double, c double").repartition(3)
    return df


@pytest.fixture(scope="module")
def few(spark):
    return assemble(_rows(spark, 6000), ["a", "b"], "features").cache()


@pytest.fixture(scope="module")
def many(spark):
    return assemble(_rows(spark, 40_000), ["a", "b", "c"], "features").cache()


def _scores(model, df):
    kept = positive_probability(predict(df.select("label", "a", "b", "features").distinct(), model))
    return {(r["a"], r["b"]): r["score"] for r in kept.collect()}


def test_boosting_on_cells_is_boosting_on_rows(few):
    estimator = make_estimator("gbt", maxIter=4, maxDepth=3)
    on_rows, on_cells = _scores(estimator.fit(few), few), _scores(cells.fit(estimator, few), few)
    assert len(on_rows) == 63
    for at, score in on_rows.items():
        assert abs(on_cells[at] - score) < 1e-9


def test_cells_count_every_row_once(many):
    found = cells.counted(many, 32, "features", "label", ["fold"], 3)
    by = {(r["fold"], r["label"]): r["n"] for r in found.frame.groupBy("fold", "label").agg(F.sum("n").alias("n")).collect()}
    assert by == {(r["fold"], r["label"]): r["count"] for r in many.groupBy("fold", "label").count().collect()}
    assert found.frame.count() < many.count() and [len(v) for v in found.values][:2] == [9, 7]
    assert 16 < len(found.values[2]) <= 32


def test_rows_and_their_cells_take_the_same_way(many):
    """Thresholds lie where the bins meet, values on an edge included."""
    found = cells.counted(many, 32, "features", "label")
    model = cells.fit_on_cells(make_estimator("gbt", maxIter=2), found.training())
    edges = [{(x + y) / 2 for x, y in zip(v, v[1:])} for v in found.values]

    def walk(node):
        if node.numDescendants():
            split = node.split()
            assert split.threshold() in edges[split.featureIndex()]
            walk(node.leftChild())
            walk(node.rightChild())

    for tree in model.trees:
        walk(tree._java_obj.rootNode())


def test_bags_draw_rows(spark, few):
    found = cells.counted(few, 32, "features", "label")
    rows = found.training()
    for replaced, rate in ((True, 1.0), (False, 0.5)):
        bags = np.array([[r["n"], *r["bag"]] for r in cells.bagged(rows, 40, rate, replaced, 3).collect()])
        n, bag = bags[:, 0], bags[:, 1:]
        assert n.sum() == 6000 and abs(bag.sum(axis=0).mean() - 6000 * rate) < 60
        # By rows, a cell's draws vary like n * rate; by whole cells they would like n * n * rate.
        spread = ((bag - n[:, None] * rate) ** 2).mean(axis=1) / (n * rate * (1 if replaced else 1 - rate))
        assert 0.8 < spread.mean() < 1.2
        assert replaced or (bag <= n[:, None]).all()
    again = [[*r["bag"]] for r in cells.bagged(found.training(), 40, 0.5, False, 3).collect()]
    assert again == bag.tolist()


def test_forest_on_cells(many, tmp_path):
    estimator = make_estimator("rf", numTrees=6, maxDepth=4)
    model = cells.fit(estimator, many)
    assert len(model.treeWeights) == 6 and len({t.toDebugString for t in model.trees}) == 6
    model.write().overwrite().save(str(tmp_path / "rf"))
    loaded = RandomForestClassificationModel.load(str(tmp_path / "rf"))
    quality = []
    for m in (model, loaded, estimator.fit(many)):
        hits = predict(many, m).select(F.avg((F.col("label") == F.col("prediction")).cast("int"))).head()[0]
        quality.append(hits)
    assert quality[0] == quality[1] and abs(quality[0] - quality[2]) < 0.02


def test_search_fits_on_cells(many, monkeypatch):
    """A search hands no fit more rows than there are cells."""
    seen = []
    fit_on_cells = cells.fit_on_cells
    monkeypatch.setattr(cells, "fit_on_cells", lambda e, rows: seen.append(rows.count()) or fit_on_cells(e, rows))
    estimator = make_estimator("rf", numTrees=2, maxDepth=3)
    found = tuning.cross_validate(
        many, estimator, lambda n: [param_map(estimator, {"maxDepth": d}) for d in (2, 3)], [0, 1], 3)
    assert len(seen) == len(found) == 6 and max(seen) <= 9 * 7 * 32 * 2
    assert all(0.6 < auc < 1 and seconds > 0 for _, _, auc, seconds in found)


def test_what_stays_on_rows(spark, few, many):
    for estimator in (make_estimator("gbt", "exact"), make_estimator("lr"), make_estimator("gbt", subsamplingRate=0.5)):
        assert not cells.fits_on_cells(estimator)
    assert cells.counted(few.limit(100), 32, "features", "label") is None
    assert cells.counted(few.where("a < 0"), 32, "features", "label") is None

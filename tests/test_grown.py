"""Ensembles grown in tasks: the library's trees on the same rows, scores by nodes, and whole work in the queries."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel

from brightfold import config
from brightfold.operators import cells, grown, metrics
from brightfold.operators.estimators import make_estimator
from brightfold.operators.features import assemble
from brightfold.operators.scoring import append_scores, positive_probability, predict
from brightfold.plans import model_queries
from brightfold.sources import models as model_files


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(8)
    n = 5000
    a, b, c = rng.integers(0, 9, n), rng.integers(0, 7, n) / 4, rng.integers(0, 12, n) / 8 - 0.3
    y = (a / 9 + b - c / 2 + rng.normal(size=n) * 0.6 > 0.8).astype(int)
    made = [(int(t), float(p), float(q), float(r), i % 7 == 0) for i, (t, p, q, r) in enumerate(zip(y, a, b, c))]
    df = spark.createDataFrame(made, "label int, a double, b double, c double, is_val boolean").repartition(3)
    return assemble(df, ["a", "b", "c"], "features").cache()


def _scores(model, df):
    kept = positive_probability(predict(df.select("a", "b", "c", "features").distinct(), model))
    return {(r["a"], r["b"], r["c"]): r["score"] for r in kept.collect()}


def _same(one, other):
    assert one.keys() == other.keys()
    return max(abs(one[at] - other[at]) for at in one) < 1e-9


def test_early_stopped_boosting_is_the_librarys(rows):
    """Held-back rows and least rows of a leaf are counted by rows."""
    estimator = make_estimator("gbt", "exact", maxIter=40, maxDepth=4)
    on_cells, on_rows = cells.fit(estimator, rows), estimator.fit(rows)
    assert isinstance(on_cells, grown.Grown)
    assert 1 < len(on_cells.treeWeights) == len(on_rows.treeWeights) < 40
    assert _same(_scores(on_cells, rows), _scores(on_rows, rows))


def test_deep_tree_is_the_librarys(rows):
    """One tree of all rows and features, deeper than there are cells to part, leaves that agree merged."""
    settings = {"numTrees": 1, "bootstrap": False, "featureSubsetStrategy": "all", "maxDepth": 30}
    estimator = make_estimator("rf", **settings)
    on_cells, on_rows = cells.fit(estimator, rows), estimator.fit(rows)
    assert _same(_scores(on_cells, rows), _scores(on_rows, rows))
    assert on_cells.trees[0].numNodes == on_rows.trees[0].numNodes > 100


def test_trees_do_not_depend_on_tasks(rows, monkeypatch):
    estimator = make_estimator("rf", numTrees=5, maxDepth=6)
    one = _scores(cells.fit(estimator, rows), rows)
    monkeypatch.setattr(grown, "TREES_A_TASK", 2)
    assert _same(one, _scores(cells.fit(estimator, rows.repartition(5)), rows))


@pytest.mark.parametrize("family, settings", [("rf", {"numTrees": 7, "maxDepth": 9}), ("gbt", {"maxIter": 6, "maxDepth": 4})])
def test_scores_by_nodes_are_the_models(rows, tmp_path, monkeypatch, family, settings):
    model = cells.fit(make_estimator(family, **settings), rows)
    monkeypatch.setattr(grown, "LARGE", 10)
    model_files.save_overwriting(model, str(tmp_path / "m"))
    model_files.save_overwriting(model, str(tmp_path / "m"))
    reloaded = model_files.load_model(family, str(tmp_path / "m"))
    assert reloaded.getOrDefault("maxDepth") == settings["maxDepth"]
    assert (grown.scorer_of(reloaded) is not None) == (family == "rf")
    for kept in (4_000_000, 1):
        monkeypatch.setattr(grown, "KEPT_SCORES", kept)
        found = append_scores(rows, [model, PipelineModel([reloaded]), model.loaded()]).collect()
        for r in found:
            assert abs(r["score_0"] - r["score_2"]) < 1e-12 and abs(r["score_1"] - r["score_2"]) < 1e-12
            assert r["prediction_0"] == r["prediction_1"] == r["prediction_2"]


def test_weighted_rows_count_as_often(spark):
    rows = [("m", i % 2, (i * 7 % 10) / 10, float((i * 7 % 10) > 4), i % 4) for i in range(60)]
    df = spark.createDataFrame(rows, "model string, label int, score double, prediction double, n int")
    repeated = spark.createDataFrame([r for r in rows for _ in range(r[4])], df.schema)
    weighted = metrics.classification_metrics(df, ["model"], weight="n").collect()
    assert weighted == metrics.classification_metrics(repeated, ["model"]).collect()


class Stop(Exception):
    pass


def test_searches_take_the_configured_grids(spark, sf_dir, monkeypatch):
    """What the queries hand to training is what `config` lists: boosting's grid and space, and all grids of the summary."""
    seen = {}

    def catch(train, features, *args, **options):
        seen.update(options)
        raise Stop

    monkeypatch.setattr(model_queries, "train_all", catch)
    for query, name, configured in (
        (model_queries.grid_search_gbt, "grids", config.PARAM_GRIDS), (model_queries.search_gbt, "spaces", config.SEARCH_SPACES),
        (model_queries.training_summary_table, "grids", config.PARAM_GRIDS),
    ):
        seen.clear()
        with pytest.raises(Stop):
            query(spark, sf_dir)
        assert seen.get(name, configured) == configured


def test_ensembles_have_the_registered_sizes(spark, sf_dir, monkeypatch):
    """The leaderboard and the exact forest fit ensembles as registered, in both profiles."""
    seen = []

    def small(estimator, data):
        seen.append((type(estimator).__name__, *(estimator.getOrDefault(n) for n in (
            ("numTrees", "maxDepth") if estimator.hasParam("numTrees") else ("maxIter", "maxDepth")))))
        return estimator.copy({estimator.maxDepth: 2, **(
            {estimator.numTrees: 2} if estimator.hasParam("numTrees") else {estimator.maxIter: 2})}).fit(data)

    monkeypatch.setattr(cells, "fit", small)
    assert model_queries.leaderboard_scores(spark, sf_dir).count() == 6
    model_queries.fit_rf_exact(spark, sf_dir)
    forest, boosting = "RandomForestClassifier", "GBTClassifier"
    assert seen == [(forest, 20, 5), (boosting, 20, 5), (forest, 100, 30), (boosting, 100, 5), (forest, 100, 30)]

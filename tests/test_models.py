import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.sql import functions as F

from brightfold import config
from brightfold.functions.expressions import row_hash
from brightfold.operators import features, timing, tuning
from brightfold.operators.estimators import make_estimator, param_map, spark_params, with_validation_flag
from brightfold.operators.split import kfold


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 2)) * [1.0, 30.0] + [0.0, 100.0]
    y = (x[:, 0] + (x[:, 1] - 100) / 30 + rng.normal(size=1500) > 0).astype(int)
    rows = [(i, int(t), float(a), float(b), 5.0) for i, (t, (a, b)) in enumerate(zip(y, x))]
    return spark.createDataFrame(rows, "id int, label int, a double, b double, k double").repartition(2).cache()


COLUMNS = ["a", "b", "k"]


@pytest.mark.parametrize("profile, ddof", [("native", 1), ("exact", 0)])
def test_scaling(spark, table, profile, ddof):
    fitted = features.feature_stages(COLUMNS, profile).fit(table)
    out = features.unpack(fitted.transform(table), "features", ["za", "zb", "zk"]).toPandas()
    for z, c in (("za", "a"), ("zb", "b")):
        expected = (out[c] - out[c].mean()) / out[c].std(ddof=ddof)
        np.testing.assert_allclose(out[z], expected, atol=1e-9)
    assert (out.zk == 0.0).all()
    shifted = fitted.transform(table.withColumn("k", F.lit(7.0)))
    first = features.unpack(shifted, "features", ["za", "zb", "zk"]).head()
    assert first["zk"] == (0.0 if profile == "native" else 2.0)


def test_missing_values_fail_the_assembly(spark):
    for bad in (None, float("nan")):
        df = spark.createDataFrame([(1.0,), (bad,)], "a double")
        with pytest.raises(Exception, match="handleInvalid"):
            features.assemble(df, ["a"]).collect()
    with pytest.raises(ValueError):
        features.feature_stages(COLUMNS, "other")


def test_registry():
    assert isinstance(make_estimator("lr"), LogisticRegression)
    assert isinstance(make_estimator("rf", "exact"), RandomForestClassifier)
    assert isinstance(make_estimator("gbt", "benchmark"), GBTClassifier)
    assert make_estimator("lr").getMaxIter() == 200
    assert make_estimator("rf", "benchmark").getNumTrees() == 100
    assert make_estimator("rf", "exact").getSubsamplingRate() == 0.5
    assert make_estimator("gbt", "benchmark").getMaxIter() == 100
    assert make_estimator("gbt").getSeed() == 42
    for family, profile in (("svm", "native"), ("lr", "other")):
        with pytest.raises(ValueError):
            make_estimator(family, profile)


def test_parameter_mapping():
    assert spark_params("lr", {"C": 0.01, "max_iter": 200.0}) == {"regParam": 100.0, "maxIter": 200}
    assert spark_params("lr", {"C": 2.0}, "exact", 1000) == {"regParam": 1 / 2000}
    assert spark_params("rf", {"n_estimators": 50.0, "max_depth": 8.0}) == {"numTrees": 50, "maxDepth": 8}
    gbt = spark_params("gbt", {"max_iter": 100.0, "max_depth": 3.0, "learning_rate": 0.05})
    assert gbt == {"maxIter": 100, "maxDepth": 3, "stepSize": 0.05}
    estimator = make_estimator("gbt")
    assert estimator.copy(param_map(estimator, gbt)).getStepSize() == 0.05
    for family, params, profile in (
        ("gbt", {"n_estimators": 5}, "native"), ("svm", {}, "native"), ("lr", {"C": 1.0}, "exact"),
    ):
        with pytest.raises(ValueError):
            spark_params(family, params, profile)


def test_grids(spark):
    sizes = {f: tuning.param_grid(spark, config.PARAM_GRIDS[f]).count() for f in config.FAMILIES}
    assert sizes == {"lr": 4, "rf": 4, "gbt": 8}
    rf = tuning.candidate_dicts(tuning.param_grid(spark, config.PARAM_GRIDS["rf"]))
    assert rf[1] == {"n_estimators": 50.0, "max_depth": 12.0}


def test_search_candidates_stay_in_range(spark):
    for family, space in config.SEARCH_SPACES.items():
        for candidate in tuning.candidate_dicts(tuning.search_candidates(spark, space, 200)):
            for name, (kind, low, high) in space.items():
                assert low <= candidate[name] <= high
                assert kind != "int" or candidate[name] == int(candidate[name])
    uniform = tuning.candidate_dicts(tuning.search_candidates(spark, {"x": ("float", 0, 10)}, 100))
    assert len({int(c["x"]) for c in uniform}) == 10
    with pytest.raises(ValueError):
        tuning.search_candidates(spark, {"x": ("bool", 0, 1)})


@pytest.fixture(scope="module")
def folded(table):
    fitted = features.feature_stages(COLUMNS).fit(table)
    return fitted.transform(kfold(table, row_hash(["id"]), 3)).cache()


def test_search_scores_every_candidate_on_every_fold(spark, folded):
    candidates = tuning.param_grid(spark, {"C": [0.001, 1.0], "max_iter": [50]})
    result = tuning.search(folded, "lr", make_estimator("lr"), candidates, folds=3, parallelism=3)
    table = {r["candidate"]: r for r in result.cv_results.collect()}
    assert set(table) == {0, 1} and all(r["n_folds"] == 3 for r in table.values())
    assert result.cv_score == max(r["mean_auc"] for r in table.values()) > 0.8
    assert result.model.getOrDefault("regParam") == 1 / result.best_params["C"]
    framework, model, params, score, search_s, refit_s, total = tuning.summary_row(result)
    assert (framework, model, params) == ("native", "Logistic Regression", result.best_params)
    assert score == round(result.cv_score, 5) and abs(total - search_s - refit_s) < 0.02


def test_spent_budget_stops_after_the_first_candidate(spark, folded):
    candidates = tuning.search_candidates(spark, {"C": ("log_float", 0.1, 1.0)}, 5)
    result = tuning.search(folded, "lr", make_estimator("lr"), candidates, folds=3, time_budget_s=0.0)
    assert [r["candidate"] for r in result.cv_results.collect()] == [0]


def test_empty_fold_is_refused(spark, folded):
    candidates = tuning.param_grid(spark, {"C": [1.0]})
    with pytest.raises(ValueError, match="fold 3"):
        tuning.search(folded, "lr", make_estimator("lr"), candidates, folds=4)


def test_early_stopping_keeps_fewer_trees(spark, folded):
    flagged = with_validation_flag(folded, row_hash(["id"], 1))
    share = flagged.where("is_val").count() / flagged.count()
    assert 0.06 < share < 0.14
    model = make_estimator("gbt", "exact", maxIter=30, maxDepth=3).fit(flagged)
    assert len(model.trees) < 30


def test_timed_prediction_runs_the_model(folded):
    model, seconds = timing.timed_fit(make_estimator("lr"), folded)
    assert seconds > 0 and timing.timed_predict(model, folded) > 0

import pytest
from pyspark.sql import functions as F

from brightfold import config
from brightfold.operators.split import kfold
from brightfold.functions.expressions import row_hash
from brightfold.plans.evaluate import evaluate_saved
from brightfold.plans.explore import explore
from brightfold.plans.inputs import FEATURES, GROUPS, base
from brightfold.plans.train import train_all
from brightfold.plans.workflow import run_all
from brightfold.sources import results, tables

GRIDS = {
    "lr": {"C": [0.1, 10.0], "max_iter": [50]},
    "rf": {"n_estimators": [3], "max_depth": [3]},
    "gbt": {"max_iter": [2], "max_depth": [2], "learning_rate": [0.1]},
}


@pytest.fixture(scope="module")
def sides(spark, sf_dir):
    rows = base(spark, sf_dir)
    wanted = [*FEATURES, "label"]
    return tables.choose_split(rows, "train").select(*wanted), tables.choose_split(rows, "test").select(*wanted)


def test_whole_workflow(spark, sides, tmp_path, monkeypatch):
    from brightfold.operators import estimators

    for family, small in (("rf", {"numTrees": 3}), ("gbt", {"maxIter": 2})):
        monkeypatch.setitem(estimators.SETTINGS, (family, "benchmark"), {"seed": 42, **small})
    out = str(tmp_path)
    found = run_all(*sides, out, GROUPS, grids=GRIDS, folds=2)
    board = {(r["framework"], r["model"]): r for r in found["evaluation"].collect()}
    assert set(board) == {(p, m) for p in config.PROFILES for m in config.DISPLAY_NAMES.values()}
    assert all(r["roc_auc"] > 0.65 for r in board.values())
    assert [r["n_cores"] for r in found["benchmark"].collect()] == [8] * 6
    summary = results.read_json(spark, f"{out}/models/native/training_summary", results.SUMMARY_SCHEMA)
    assert summary.where("cv_score > 0.6").count() == 3
    saved = results.read_csv(spark, f"{out}/evaluation/evaluation_results", results.EVALUATION_SCHEMA)
    assert sorted(saved.collect()) == sorted(found["evaluation"].collect())
    # Models of one family only, and of a profile that was never trained.
    some = evaluate_saved(sides[1], f"{out}/models", ["native", "absent"], ["lr", "rf"])
    assert {r["model"] for r in some.collect()} == {"Logistic Regression", "Random Forest"}


@pytest.mark.parametrize("profile", config.PROFILES)
def test_search_with_scaling_inside_the_folds(sides, tmp_path, profile):
    result = train_all(
        sides[0], FEATURES, profile, method="search", families=["lr"], out=str(tmp_path), folds=2,
        trials=2, search_rows=2000, refit_rows=3000, leak_free=True,
    )["lr"]
    assert result.cv_score > 0.7 and result.cv_results.count() == 2
    board = evaluate_saved(sides[1], str(tmp_path), [profile]).collect()
    assert len(board) == 1 and board[0]["roc_auc"] > 0.7
    with pytest.raises(ValueError):
        train_all(sides[0], FEATURES, method="guess")


def test_default_columns(spark, sf_dir, tmp_path):
    """The 28 named features, from headerless CSV to the profile tables."""
    source = base(spark, sf_dir)
    columns = [
        (F.col(FEATURES[i % 4]) * (1 + i) + F.col(FEATURES[(i + 1) % 4]) / (1 + i)).alias(name)
        for i, name in enumerate(config.FEATURES)
    ]
    path = str(tmp_path / "events")
    results.write_csv(source.select(F.col("label").cast("double"), *columns), path, header=False)
    df = tables.read_labelled_csv(spark, path)
    found = explore(df)
    assert found["summary_statistics"].where("count = 6000 and missing_pct = 0").count() == 28
    assert found["distributions"].groupBy("feature_group").count().collect() is not None
    assert found["distributions"].count() == 28 * 2 * 50
    assert found["correlation"].count() == 28 * 28
    holes = explore(df.withColumn("m_jj", F.when(F.col("m_jj") > 30, F.col("m_jj"))))
    assert holes["correlation"].count() == 28 * 28
    folded = kfold(df, row_hash(df.columns))
    assert folded.select("fold").distinct().count() == 5

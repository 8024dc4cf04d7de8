import random

import pytest
from pyspark.sql import functions as F

from brightfold.operators import metrics, report, timing
from brightfold.operators.tuning import best_candidate, mean_scores
from brightfold.sources.results import BENCHMARK_SCHEMA


def brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    if not pos or not neg:
        return None
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def groups():
    r = random.Random(11)
    return {
        "continuous": [(r.randint(0, 1), r.random()) for _ in range(300)],
        "ties": [(r.randint(0, 1), r.randint(0, 4) / 4) for _ in range(300)],
        "third is one score": [(i % 2, 0.5) for i in range(100)] + [(r.randint(0, 1), r.random()) for _ in range(200)],
        "one class": [(1, r.random()) for _ in range(20)],
        "perfect": [(0, 0.1), (1, 0.9)],
        "inverted": [(0, 0.9), (1, 0.1)],
    }


@pytest.fixture(scope="module")
def scores(spark):
    rows = [(g, y, s, float(s > 0.5)) for g, found in groups().items() for y, s in found]
    rows += [("ties", None, 0.3, 0.0), ("ties", 1, None, 0.0), ("ties", 1, float("nan"), 0.0)]
    return spark.createDataFrame(rows, "g string, label int, score double, prediction double").repartition(5)


@pytest.mark.parametrize("options", [
    {}, {"buckets": 1}, {"buckets": 3}, {"buckets": 1000}, {"bounds": [0.01, 0.02]}, {"bounds": []},
])
def test_metrics_equal_brute_force(scores, options):
    ours = {r["g"]: r for r in metrics.classification_metrics(scores, ["g"], **options).collect()}
    for name, rows in groups().items():
        assert ours[name]["n_rows"] == len(rows)
        assert ours[name]["accuracy"] == pytest.approx(sum((s > 0.5) == (y == 1) for y, s in rows) / len(rows))
        expected = brute_auc(rows)
        assert ours[name]["roc_auc"] == (None if expected is None else pytest.approx(expected, abs=1e-12))


def test_ungrouped_and_built_in_agree(scores):
    clean = scores.where("label is not null and score is not null and not isnan(score)")
    ours = metrics.roc_auc(clean).head()["roc_auc"]
    assert ours == pytest.approx(brute_auc([p for rows in groups().values() for p in rows]), abs=1e-12)
    assert metrics.auc_evaluator(raw="score", bins=0).evaluate(clean) == pytest.approx(ours, abs=1e-9)


def test_no_rows(scores):
    assert metrics.roc_auc(scores.where("false")).collect() == []


def test_no_task_sorts_everything(scores):
    plan = metrics.roc_auc(scores, buckets=8)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window" in line and "_score" in line]
    assert windows and all("_range" in line for line in windows)


def test_leaderboard_and_pivot(spark):
    rows = [("native", "m", 1, 0.9, 1.0), ("native", "m", 0, 0.2, 0.0), ("exact", "m", 1, 0.1, 0.0),
            ("exact", "m", 0, 0.3, 0.0), ("native", "only native", 1, 0.5, 1.0)]
    scores = spark.createDataFrame(rows, "framework string, model string, label int, score double, prediction double")
    board = report.leaderboard(scores)
    found = {(r["framework"], r["model"]): (r["accuracy"], r["roc_auc"]) for r in board.collect()}
    assert found == {("native", "m"): (1.0, 1.0), ("exact", "m"): (0.5, 0.0), ("native", "only native"): (1.0, None)}
    wide = {r["model"]: r for r in report.framework_pivot(board, "accuracy", ["native", "exact"]).collect()}
    assert wide["m"]["difference"] == 0.5 and wide["only native"]["exact"] is None
    assert report.append_results(board, board).count() == 6


def test_mean_scores_and_best_candidate(spark):
    folds = [(0, 0, 0.7), (0, 1, 0.9), (1, 0, 0.8), (1, 1, 0.8), (2, 0, None), (2, 1, None), (3, 0, None), (3, 1, 0.6)]
    means = mean_scores(spark.createDataFrame(folds, "candidate int, fold int, auc double"))
    found = {r["candidate"]: (r["mean_auc"], r["n_folds"]) for r in means.collect()}
    assert found[0] == (pytest.approx(0.8), 2) and found[3] == (0.6, 1) and found[2] == (None, 0)
    tied = spark.createDataFrame([(0, None), (1, 0.8), (2, 0.8), (3, 0.1)], "candidate int, mean_auc double")
    assert best_candidate(tied).head() == (1, 0.8)


def test_speedup(spark):
    rows = [("native", "lr", 1, 8.0, 4.0), ("native", "lr", 4, 2.0, 0.0), ("native", "rf", 2, 3.0, 1.0)]
    table = timing.speedup(spark.createDataFrame(rows, BENCHMARK_SCHEMA))
    found = {(r["model"], r["n_cores"]): r for r in table.collect()}
    assert found["lr", 4]["train_speedup"] == 4.0 and found["lr", 4]["train_efficiency"] == 1.0
    assert found["lr", 4]["predict_speedup"] is None
    assert found["lr", 1]["predict_efficiency"] == 1.0
    assert found["rf", 2]["train_speedup"] is None
    ordered = timing.series(spark.createDataFrame(rows[::-1], BENCHMARK_SCHEMA), "native").collect()
    assert [(r["model"], r["n_cores"]) for r in ordered] == [("lr", 1), ("lr", 4), ("rf", 2)]


def test_bounds_from_a_share_of_the_rows_change_no_result(spark, monkeypatch):
    rows = spark.range(20_000, numPartitions=7).selectExpr(
        "cast(id % 3 as int) g", "cast(id * 7 % 5 < 2 as int) label", "(id * 7919 % 9973) / 9973 as score")
    exact = {r["g"]: r["roc_auc"] for r in metrics.roc_auc(rows, ["g"], bounds=[]).collect()}
    monkeypatch.setattr(metrics, "BOUNDED_ROWS", 2_000)
    monkeypatch.setattr(metrics, "SCORES_A_BOUND", 50)
    monkeypatch.setattr(metrics, "ROWS_A_RANGE", 200)
    assert metrics.bounding_share(20_000, metrics.range_count(spark, 20_000)) < 0.5
    bounds = metrics.score_bounds(rows)
    assert len(bounds) == metrics.range_count(spark, 20_000) - 1 == 100
    found = metrics.roc_auc(rows, ["g"], bounds=bounds)
    assert {r["g"]: r["roc_auc"] for r in found.collect()} == pytest.approx(exact, abs=1e-12)
    sizes = rows.groupBy(sum((F.col("score") >= b).cast("int") for b in bounds)).count().toPandas()["count"]
    assert len(sizes) == 101 and sizes.max() < 4 * 200


def test_many_ranges_are_ranked_in_as_many_partitions(spark):
    rows = spark.range(5_000).selectExpr("cast(id % 2 as int) label", "id / 5000 as score")
    bounds = [i / 300 for i in range(1, 300)]
    plan = metrics.roc_auc(rows, bounds=bounds)._jdf.queryExecution().executedPlan().toString()
    assert any("Exchange" in line and "300)" in line and "_range" in line for line in plan.splitlines())
    assert metrics.roc_auc(rows, bounds=bounds).head()["roc_auc"] == metrics.roc_auc(rows, bounds=[]).head()["roc_auc"]


def test_many_ranges_are_dealt_before_rows_collapse(spark):
    """No aggregate of distinct scores is left to the session's shuffle partitions."""
    rows = spark.range(4_000).selectExpr("cast(id % 3 = 0 as int) label", "id % 1000 / 1000 as score")
    bounds = [i / 200 for i in range(1, 200)]
    plan = metrics.roc_auc(rows, bounds=bounds)._jdf.queryExecution().executedPlan().toString()
    assert not any("Exchange" in line and "_score" in line for line in plan.splitlines())


@pytest.mark.parametrize("share", [0.0, 0.6, 1.0])
def test_scores_that_fill_ranges_collapse_apart(spark, share):
    rows = spark.range(6_000, numPartitions=5).selectExpr(
        "cast(id % 2 as int) g", "cast(id * 7 % 5 < 2 as int) label",
        f"case when id % 10 < {10 * share} then 0.25 else (id * 7919 % 5003) / 5003 end as score")
    bounds = metrics.score_bounds(rows, buckets=100)
    assert len(bounds) == 99 and (len(set(bounds)) < 99) == (share > 0)
    want = {r["g"]: r["roc_auc"] for r in metrics.roc_auc(rows, ["g"], bounds=[]).collect()}
    got = metrics.classification_metrics(rows.withColumn("prediction", F.lit(1.0)), ["g"], bounds=bounds).collect()
    assert {r["g"]: r["roc_auc"] for r in got} == pytest.approx(want, abs=1e-12)
    assert [r["n_rows"] for r in got] == [3000, 3000]

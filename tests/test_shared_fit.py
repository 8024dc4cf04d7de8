"""Shared passes: the same optimum as one fit at a time, and scans that don't grow with candidates."""

import json
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from brightfold.functions.expressions import row_hash
from brightfold.operators import features, shared_fit, tuning
from brightfold.operators.estimators import make_estimator, param_map, spark_params
from brightfold.operators.split import kfold

COLUMNS = ["a", "b", "c", "k"]


@pytest.fixture(scope="module")
def folded(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1200, 3)) * [1.0, 30.0, 1e-3] + [0.0, 500.0, 4.0]
    x[:, 2] += x[:, 0] * 2e-3
    y = (x[:, 0] + (x[:, 1] - 500) / 30 + rng.normal(size=1200) > 0.6).astype(int)
    rows = [(i, int(t), *map(float, r), 5.0) for i, (t, r) in enumerate(zip(y, x))]
    df = spark.createDataFrame(rows, "id int, label int, a double, b double, c double, k double").repartition(3)
    return features.assemble(kfold(df, row_hash(["id"]), 3), COLUMNS, "features").cache()


@pytest.mark.parametrize("profile", ["native", "exact"])
def test_same_optimum_as_one_fit_at_a_time(folded, profile):
    estimator = make_estimator("lr", profile, tol=1e-8)
    settings = lambda n: [spark_params("lr", {"C": c}, profile, n) for c in (0.05, 3.0)]
    scored, fits, passes = tuning.cross_validate_together(folded, estimator, settings, [0, 1], 3)
    assert len(fits) == 6 and passes < 40 and all(f.gradient <= shared_fit.TOLERANCE and f.seconds > 0 for f in fits)
    single = tuning.cross_validate(
        folded, estimator, lambda n: [param_map(estimator, s) for s in settings(n)], [0, 1], 3)
    for got, want in zip(sorted(scored), sorted(single)):
        assert got[:2] == want[:2] and abs(got[2] - want[2]) < 1e-4
    for fit in (fits[0], fits[-1]):
        candidate, held_out = fit.task.key
        train = folded.where(F.col("fold") != held_out)
        n = train.count()
        model = estimator.fit(train, param_map(estimator, settings(n)[candidate]))
        deviation = np.array([r for r in train.agg(*map(F.stddev, COLUMNS)).head()])
        np.testing.assert_allclose(fit.coefficients * deviation, model.coefficients.toArray() * deviation, atol=2e-4)
        assert fit.coefficients[3] == 0.0


def test_gradient_vanishes_at_the_optimum(folded):
    data, moments = shared_fit.blocks(folded), shared_fit.fold_moments(folded)
    task = shared_fit.Task(("all",), None, 0.1, standardise=False)
    fit = shared_fit.fit_together(data, moments, [task]).fits[0]
    rows = folded.select("label", *COLUMNS[:3]).toPandas()
    x, y = rows[COLUMNS[:3]].to_numpy(), rows["label"].to_numpy()
    rest = 1 / (1 + np.exp(-(x @ fit.coefficients[:3] + fit.intercept))) - y
    by_weight = (x * rest[:, None]).mean(axis=0) + 0.1 * fit.coefficients[:3]
    assert abs(rest.mean()) < 1e-8 and np.abs(by_weight / x.std(axis=0) ** 0).max() < 1e-5
    n, share, mean, deviation = moments.without(None)
    np.testing.assert_allclose(mean[:3], x.mean(axis=0))
    np.testing.assert_allclose(deviation, np.append(x.std(axis=0, ddof=1), 0.0), rtol=1e-9)
    data.unpersist()


def test_other_estimators_are_fitted_one_by_one():
    assert tuning.shares_passes(make_estimator("lr")) and not tuning.shares_passes(make_estimator("rf"))
    assert not tuning.shares_passes(make_estimator("lr", elasticNetParam=0.5))
    assert not tuning.shares_passes(make_estimator("lr", weightCol="w")) and not tuning.shares_passes(make_estimator("lr", fitIntercept=False))


def test_one_class_and_separable_folds(spark):
    rows = [(1, [float(i)], i % 2) for i in range(20)]
    df = spark.createDataFrame(rows, "label int, x array<double>, fold int").select(
        "label", "fold", F.expr("x[0]").alias("a"))
    found, _, _ = tuning.cross_validate_together(
        features.assemble(df, ["a"], "features"), make_estimator("lr"), lambda n: [{"regParam": 0.1}], [0], 2)
    assert [r[2] for r in found] == [None, None]


def test_candidate_ranks_share_ties(spark):
    scores = spark.createDataFrame(
        [(0, 0, 0.7, 1.0), (1, 0, 0.9, 1.0), (2, 0, 0.7, 3.0), (3, 0, None, 1.0)], tuning.FOLD_SCORE_SCHEMA)
    table = tuning.candidate_results(tuning.param_grid(spark, {"C": [1.0, 2.0, 3.0, 4.0, 5.0]}), scores)
    assert {r["candidate"]: (r["rank"], r["mean_fit_s"]) for r in table.collect()} == {0: (2, 1.0), 1: (1, 1.0), 2: (2, 3.0), 3: (4, 1.0)}


def test_searches_over_many_parameters(spark):
    space = {f"p{i}": ("float", 0, 1) for i in range(9)}
    rows = tuning.candidate_dicts(tuning.search_candidates(spark, space, 64))
    for name in space:
        assert len({int(r[name] * 8) for r in rows}) == 8
    assert len(set(tuning.steps(30))) == 30


SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession, functions as F
from brightfold.functions.expressions import row_hash
from brightfold.operators import features, tuning
from brightfold.operators.estimators import make_estimator
from brightfold.operators.split import kfold

candidates, folds = int(sys.argv[3]), int(sys.argv[4])
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.eventLog.enabled", "true")
         .config("spark.eventLog.dir", sys.argv[2]).config("spark.eventLog.compress", "false").config("spark.sql.shuffle.partitions", "2")
         .getOrCreate())
df = spark.range(2000).select("id", (F.rand(1) * 3).alias("a"), F.randn(2).alias("b"))
df = df.withColumn("label", (F.col("a") + F.col("b") + F.randn(3) > 1.5).cast("int"))
data = features.assemble(kfold(df, row_hash(["id"]), folds), ["a", "b"], "features").persist()
grid = tuning.param_grid(spark, {"C": [0.3 * (i + 1) for i in range(candidates)]})
result = tuning.search(data, "lr", make_estimator("lr"), grid, folds=folds)
print("PASSES", result.passes)
spark.stop()
"""


def _scans(tmp_path, candidates, folds):
    """Passes reported, and stages of the event log that read the training blocks."""
    logs = tmp_path / f"log-{candidates}-{folds}"
    logs.mkdir()
    root = str(Path(__file__).resolve().parent.parent)
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, root, f"file://{logs}", str(candidates), str(folds)],
        capture_output=True, text=True, timeout=240, check=True)
    passes = int(done.stdout.split("PASSES")[1].split()[0])
    scans = 0
    for path in logs.rglob("*"):
        if path.is_file() and not path.name.endswith(".crc"):
            for line in path.read_text().splitlines():
                event = json.loads(line)
                if event["Event"] == "SparkListenerStageCompleted":
                    rdds = event["Stage Info"]["RDD Info"]
                    scans += any(r["Name"] == shared_fit.BLOCKS_NAME for r in rdds)
    return passes, scans


def test_scans_grow_with_iterations_not_with_candidates_or_folds(tmp_path):
    few, few_scans = _scans(tmp_path, 1, 2)
    many, many_scans = _scans(tmp_path, 12, 5)
    # One stage reads the blocks in each pass, for 2 fits as for 60.
    assert few_scans == few and many_scans == many
    assert many <= few + 10 and many < 40


def test_pass_equals_the_plain_formulas():
    """Loss and gradients of one pass, over blocks of mixed folds, far margins and several products."""
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(1500, 3)), rng.integers(0, 2, 1500).astype(float)
    f = np.sort(rng.integers(0, 3, 1500)).astype(np.int32)
    x[:4] = [[800, 0, 0], [-800, 0, 0], [0, 40, 0], [0, -40, 0]]
    folds, w, b = np.array([0, 1, -1, 0], np.int32), rng.normal(size=(3, 4)), rng.normal(size=4)

    class Sent:
        value = folds, w, b

        def unpersist(self):
            pass

    class Blocks:
        context = type("Context", (), {"broadcast": lambda self, value: Sent()})()

        def treeAggregate(self, zero, add, _):
            total = add(zero, (x[:900].tobytes(), y[:900].tobytes(), f[:900].tobytes()))
            return add(total, (x[900:].tobytes(), y[900:].tobytes(), f[900:].tobytes()))

    loss, by_weight, by_intercept = shared_fit.losses(Blocks(), folds, w, b)
    margin = x @ w + b
    inside = f[:, None] != folds
    rest = np.where(inside, 0.5 * (1 + np.tanh(margin / 2)) - y[:, None], 0.0)
    plain = np.where(inside, np.logaddexp(0.0, margin) - y[:, None] * margin, 0.0).sum(axis=0)
    np.testing.assert_allclose(loss, plain, rtol=1e-12)
    np.testing.assert_allclose(by_weight, x.T @ rest, rtol=1e-9, atol=1e-9)
    np.testing.assert_allclose(by_intercept, rest.sum(axis=0), rtol=1e-9, atol=1e-9)


def test_unequal_scales_take_few_passes():
    """Per-row penalties on features of deviations from 0.001 to 30, straight on arrays."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1200, 3)) * [1.0, 30.0, 1e-3] + [0.0, 500.0, 4.0]
    y = (x[:, 0] + (x[:, 1] - 500) / 30 + rng.normal(size=1200) > 0.6).astype(float)
    for c in (0.05, 3.0):
        task = shared_fit.Task((), None, 1 / (c * len(y)), standardise=False)
        descent = shared_fit.Descent(task, len(y), y.mean(), x.mean(axis=0), x.std(axis=0, ddof=1))
        passes = 0
        while not descent.done and passes < 100:
            weights, intercept = descent.model(descent.trial)
            margin = x @ weights + intercept
            rest = 1 / (1 + np.exp(-margin)) - y
            descent.take(float((np.logaddexp(0, margin) - y * margin).sum()), x.T @ rest, float(rest.sum()))
            passes += 1
        assert passes <= 20 and descent.fit().gradient <= shared_fit.TOLERANCE

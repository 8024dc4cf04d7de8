"""Boosting by round: losses, the early-stopping rule, and shorter ensembles."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from brightfold.functions.expressions import row_hash
from brightfold.operators import boosting, features
from brightfold.operators.estimators import make_estimator, with_validation_flag
from brightfold.operators.scoring import positive_probability


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(1500, 2))
    y = (x[:, 0] * x[:, 1] + 0.7 * rng.normal(size=1500) > 0).astype(int)
    df = spark.createDataFrame([(i, int(t), *map(float, r)) for i, (t, r) in enumerate(zip(y, x))], "id int, label int, a double, b double")
    flagged = with_validation_flag(df.repartition(2), row_hash(["id"], 1), 0.3)
    return features.assemble(flagged, ["a", "b"], "features").cache()


@pytest.fixture(scope="module")
def model(rows):
    return make_estimator("gbt", maxIter=6, maxDepth=3).fit(rows)


def test_losses_are_those_of_the_probabilities(rows, model):
    losses = boosting.round_losses(model, rows)
    assert len(losses) == 6 and all(a > b for a, b in zip(losses, losses[1:]))
    scored = positive_probability(model.transform(rows))
    right = F.when(F.col("label") == 1, F.col("score")).otherwise(1 - F.col("score"))
    assert abs(scored.agg(F.avg(-2 * F.ln(right))).head()[0] - losses[-1]) < 1e-9
    table = boosting.loss_table(model, {"all": rows}).collect()
    assert [(r["side"], r["round"], r["loss"]) for r in table] == [("all", i + 1, v) for i, v in enumerate(losses)]
    assert boosting.best_round(model, rows) == 6


def test_cut_ensembles(rows, model):
    for n in (1, 4, 6):
        shorter = boosting.cut(model, n)
        assert len(shorter.treeWeights) == n and list(shorter.treeWeights) == list(model.treeWeights)[:n]
        assert boosting.round_losses(shorter, rows) == pytest.approx(boosting.round_losses(model, rows)[:n])
        again = make_estimator("gbt", maxIter=n, maxDepth=3).fit(rows)
        ours, theirs = (m.transform(rows).select("id", "prediction").orderBy("id").collect() for m in (shorter, again))
        assert ours == theirs
    for n in (0, 7):
        with pytest.raises(ValueError):
            boosting.cut(model, n)


@pytest.mark.parametrize("losses,kept", [
    ([1.0], 1), ([1.0, 0.9, 0.8], 3), ([1.0, 0.995, 0.5], 1), ([1.0, 0.9, 0.95, 0.1], 2), ([0.005, 0.00495], 1), ([0.5, 0.4, 0.399], 2),
])
def test_stopping_rule(losses, kept):
    assert boosting.kept_rounds(losses, 0.01) == kept


def test_early_stopping_ends_where_the_losses_say(rows):
    for tolerance in (0.01, 0.002):
        estimator = make_estimator("gbt", "exact", maxIter=30, maxDepth=3, validationTol=tolerance)
        model = estimator.fit(rows)
        assert 1 < len(model.treeWeights) < 30 and boosting.stops_by_losses(estimator, model, rows)
        assert not boosting.stops_by_losses(estimator, boosting.cut(model, len(model.treeWeights) - 1), rows)

"""Boosting seen round by round: losses after each tree, the round that early stopping keeps, and shorter ensembles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import DataFrame, SparkSession, functions as F


def round_losses(model: GBTClassificationModel, df: DataFrame) -> list[float]:
    """Mean logistic loss 2 log(1 + exp(-2 y F)) over the rows after each round, y being -1 or 1."""
    return list(model.evaluateEachIteration(df))


def kept_rounds(losses: Sequence[float], tolerance: float) -> int:
    """Rounds that early stopping keeps, given the held-back losses of an unstopped run.

    Training ends at the first round that lowers the best loss by less than the tolerance,
    taken relative to the round's loss or to 0.01 if that is more; the best round before stays.
    """
    best, kept = losses[0], 1
    for i, loss in enumerate(losses):
        if best - loss < tolerance * max(loss, 0.01) and i:
            break
        if loss < best:
            best, kept = loss, i + 1
    return kept


def cut(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The ensemble after its first rounds."""
    java = model._java_obj
    if not 1 <= rounds <= len(model.treeWeights):
        raise ValueError(f"{rounds} of {len(model.treeWeights)} rounds")
    context = SparkSession.getActiveSession().sparkContext
    trees = context._gateway.new_array(context._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = context._gateway.new_array(context._jvm.double, rounds)
    for i in range(rounds):
        trees[i], weights[i] = java.trees()[i], java.treeWeights()[i]
    shorter = GBTClassificationModel(context._jvm.org.apache.spark.ml.classification.GBTClassificationModel(model.uid, trees, weights))
    for name in ("featuresCol", "labelCol", "predictionCol", "rawPredictionCol", "probabilityCol"):
        shorter._set(**{name: model.getOrDefault(name)})
    return shorter


def stops_by_losses(estimator: GBTClassifier, model: GBTClassificationModel, df: DataFrame) -> bool:
    """Whether a stopped model has the rounds that the losses of its held-back rows say.

    The same training rows are boosted one round beyond the stop, without stopping; the
    rule, applied to the losses of that run on the held-back rows, must end at the model.
    """
    mark = F.col(estimator.getValidationIndicatorCol())
    kept = len(model.treeWeights)
    plain = estimator.copy()
    plain.clear(plain.validationIndicatorCol)
    plain.setMaxIter(min(kept + 1, estimator.getMaxIter()))
    losses = round_losses(plain.fit(df.where(~mark)), df.where(mark))
    return kept_rounds(losses, estimator.getValidationTol()) == kept


def best_round(model: GBTClassificationModel, df: DataFrame) -> int:
    """The round of least loss on the rows; of equal ones the first."""
    losses = round_losses(model, df)
    return 1 + min(range(len(losses)), key=losses.__getitem__)


def loss_table(model: GBTClassificationModel, sides: dict[str, DataFrame]) -> DataFrame:
    """(side, round, loss) of every round on every side."""
    rows = [(side, i + 1, loss) for side, df in sides.items() for i, loss in enumerate(round_losses(model, df))]
    spark = next(iter(sides.values())).sparkSession
    return spark.createDataFrame(rows, "side string, round int, loss double")

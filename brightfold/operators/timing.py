"""Fit and predict times, and the speedup table built from them."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Window, functions as F


def timed_fit(estimator, train: DataFrame):
    started = time.perf_counter()
    model = estimator.fit(train)
    return model, time.perf_counter() - started


def timed_predict(model, test: DataFrame) -> float:
    """Seconds to compute every prediction and probability.

    The rows go to a sink that discards them: a bare count would let the
    optimizer drop the model's columns, and with them the inference.
    """
    started = time.perf_counter()
    scored = model.transform(test).select("prediction", "probability")
    scored.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def series(timings: DataFrame, framework: str) -> DataFrame:
    """The timings of one framework, by model and cores."""
    return timings.where(F.col("framework") == framework).orderBy("model", "n_cores")


def speedup(timings: DataFrame) -> DataFrame:
    """t1/tk and t1/(k tk) per model, against the model's own one-core time.

    NULL where the one-core row is missing or a time is zero.
    """
    own = Window.partitionBy("framework", "model")

    def ratio(column):
        base = F.max(F.when(F.col("n_cores") == 1, F.col(column))).over(own)
        return F.when(F.col(column) > 0, base / F.col(column))

    train, predict = ratio("train_time"), ratio("predict_time")
    return timings.select(
        "*",
        F.round(train, 3).alias("train_speedup"),
        F.round(train / F.col("n_cores"), 3).alias("train_efficiency"),
        F.round(predict, 3).alias("predict_speedup"),
        F.round(predict / F.col("n_cores"), 3).alias("predict_efficiency"),
    )

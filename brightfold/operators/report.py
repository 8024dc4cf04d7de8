"""Leaderboard and comparison tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from brightfold.operators.metrics import classification_metrics


def leaderboard(scores: DataFrame, label: str = "label") -> DataFrame:
    """Accuracy and ROC-AUC to 5 places per (framework, model), from one score table."""
    metrics = classification_metrics(scores, ["framework", "model"], label)
    return metrics.select(
        "framework",
        "model",
        F.round("accuracy", 5).alias("accuracy"),
        F.round("roc_auc", 5).alias("roc_auc"),
    )


def append_results(first: DataFrame, *others: DataFrame) -> DataFrame:
    for other in others:
        first = first.unionByName(other)
    return first


def framework_pivot(
    results: DataFrame, metric: str, frameworks: Sequence[str]
) -> DataFrame:
    """Model rows, one column per framework, and the difference of the first two."""
    wide = results.groupBy("model").pivot("framework", list(frameworks)).agg(F.first(metric))
    a, b = frameworks[:2]
    return wide.withColumn("difference", F.col(a) - F.col(b))

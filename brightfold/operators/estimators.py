"""Classifier registry and the mapping from neutral to Spark parameters.

Profiles: "native" takes Spark's settings, "exact" follows the objective of a
per-row penalty C with half-row forests and early-stopped boosting, and
"benchmark" fixes the sizes used for timing.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.sql import Column, DataFrame, functions as F

from brightfold import config
from brightfold.functions.expressions import HASH_MODULUS

# Settings of each (family, profile) before tuning.
SETTINGS = {
    ("lr", "native"): {"maxIter": 200, "family": "binomial"},
    ("lr", "exact"): {"maxIter": 200, "family": "binomial", "standardization": False},
    ("lr", "benchmark"): {"maxIter": 200, "family": "binomial"},
    ("rf", "native"): {"seed": config.SEED},
    ("rf", "exact"): {"seed": config.SEED, "numTrees": 100, "subsamplingRate": 0.5, "maxDepth": 30},
    ("rf", "benchmark"): {"seed": config.SEED, "numTrees": 100},
    ("gbt", "native"): {"seed": config.SEED},
    ("gbt", "exact"): {
        "seed": config.SEED, "maxIter": 100, "stepSize": 0.1, "maxBins": 255,
        "minInstancesPerNode": 20, "validationIndicatorCol": "is_val", "validationTol": 0.01,
    },
    ("gbt", "benchmark"): {"seed": config.SEED, "maxIter": 100},
}
CLASSES = {"lr": LogisticRegression, "rf": RandomForestClassifier, "gbt": GBTClassifier}

# Neutral parameter names and the Spark parameters they set.
SPARK_NAMES = {
    "lr": {"C": "regParam", "max_iter": "maxIter"},
    "rf": {"n_estimators": "numTrees", "max_depth": "maxDepth"},
    "gbt": {"max_iter": "maxIter", "max_depth": "maxDepth", "learning_rate": "stepSize"},
}
INTEGER_PARAMS = {"maxIter", "numTrees", "maxDepth"}
VALIDATION_SHARE = 0.1


def make_estimator(family: str, profile: str = "native", features: str = "features", **settings):
    """Fresh estimator on the label and feature columns; `settings` override the registry."""
    if (family, profile) not in SETTINGS:
        raise ValueError(f"no estimator for family {family!r} in profile {profile!r}")
    chosen = {**SETTINGS[family, profile], **settings}
    return CLASSES[family](labelCol=config.LABEL, featuresCol=features, **chosen)


def spark_params(
    family: str, params: Mapping[str, float], profile: str = "native", n_rows: int | None = None
) -> dict:
    """Neutral names to Spark names and values; an unknown name raises.

    C weighs the loss against the penalty. Natively regParam is 1/C; the exact
    profile divides by the rows as well, since Spark averages the loss.
    """
    if family not in SPARK_NAMES:
        raise ValueError(f"unknown model family {family!r}")
    mapped = {}
    for name, value in params.items():
        if name not in SPARK_NAMES[family]:
            raise ValueError(f"unknown parameter {name!r} of family {family!r}")
        target = SPARK_NAMES[family][name]
        if name == "C":
            if profile == "exact" and not n_rows:
                raise ValueError("the exact profile maps C with the number of training rows")
            value = 1.0 / (value * n_rows) if profile == "exact" else 1.0 / value
        mapped[target] = int(value) if target in INTEGER_PARAMS else float(value)
    return mapped


def param_map(estimator, mapped: Mapping[str, float]) -> dict:
    return {estimator.getParam(name): value for name, value in mapped.items()}


def with_validation_flag(df: DataFrame, key: Column, share: float = VALIDATION_SHARE) -> DataFrame:
    """Mark a share of the rows by hash key as the early-stopping set."""
    return df.withColumn("is_val", key < F.lit(int(share * HASH_MODULUS)))

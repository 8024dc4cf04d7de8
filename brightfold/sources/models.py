"""Fitted transforms and models on shared storage."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel,
    LogisticRegressionModel,
    RandomForestClassificationModel,
)

from brightfold.operators import grown

MODEL_CLASSES = {
    "lr": LogisticRegressionModel,
    "rf": RandomForestClassificationModel,
    "gbt": GBTClassificationModel,
}


def is_missing_path(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def feature_path(root: str, profile: str) -> str:
    return f"{root}/{profile}/features"


def model_path(root: str, profile: str, family: str) -> str:
    return f"{root}/{profile}/{family}"


def save_overwriting(fitted, path: str) -> None:
    if isinstance(fitted, grown.Grown):
        fitted.save(path)
    else:
        fitted.write().overwrite().save(path)


def load_features(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_model(family: str, path: str):
    if family not in MODEL_CLASSES:
        raise ValueError(f"unknown model family {family!r}")
    return grown.remember_nodes(MODEL_CLASSES[family].load(path), path)

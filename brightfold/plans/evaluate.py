"""Score every saved model on the test table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from brightfold import config
from brightfold.operators.report import framework_pivot, leaderboard
from brightfold.operators.scoring import score_models
from brightfold.sources import models as model_files
from brightfold.sources.results import EVALUATION_SCHEMA, write_csv


def load_saved(
    root: str,
    profiles: Sequence[str] = config.PROFILES,
    families: Sequence[str] = config.FAMILIES,
) -> dict[tuple[str, str], PipelineModel]:
    """Saved models by (profile, display name).

    A missing model is skipped; a missing transform skips its whole profile.
    Any other failure to load is an error.
    """
    found = {}
    for profile in profiles:
        transform = _load_or_none(model_files.load_features, model_files.feature_path(root, profile))
        if transform is None:
            continue
        for family in families:
            path = model_files.model_path(root, profile, family)
            model = _load_or_none(lambda p: model_files.load_model(family, p), path)
            if model is not None:
                found[profile, config.DISPLAY_NAMES[family]] = PipelineModel([transform, model])
    return found


def _load_or_none(load, path):
    try:
        return load(path)
    except AnalysisException as error:
        if model_files.is_missing_path(error):
            return None
        raise


def evaluate_models(test: DataFrame, models: Mapping[tuple[str, str], PipelineModel]) -> DataFrame:
    """Accuracy and ROC-AUC per (framework, model); no models give an empty table.

    One scan scores all models. The scores are kept for the two passes of the
    metrics and released; the result is as long as the list of models.
    """
    spark = test.sparkSession
    if not models:
        return spark.createDataFrame([], EVALUATION_SCHEMA)
    scores = score_models(test, models, ["framework", "model"]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = leaderboard(scores).collect()
    finally:
        scores.unpersist()
    return spark.createDataFrame(rows, EVALUATION_SCHEMA)


def evaluate_saved(
    test: DataFrame,
    root: str,
    profiles: Sequence[str] = config.PROFILES,
    families: Sequence[str] = config.FAMILIES,
    out: str | None = None,
) -> DataFrame:
    results = evaluate_models(test, load_saved(root, profiles, families))
    if out is not None:
        write_csv(results, f"{out}/evaluation_results")
        for metric in ("accuracy", "roc_auc"):
            write_csv(framework_pivot(results, metric, list(config.PROFILES)), f"{out}/comparison_{metric}")
    return results

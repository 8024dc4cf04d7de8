"""Train, tune and save the models of one profile."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.sql import Column, DataFrame, functions as F

from brightfold import config
from brightfold.functions.expressions import row_hash
from brightfold.operators import tuning
from brightfold.operators.estimators import make_estimator, with_validation_flag
from brightfold.operators.features import feature_stages
from brightfold.operators.split import kfold, nested_samples, stratified_kfold
from brightfold.session import checkpoint_root, spread
from brightfold.sources import models as model_files
from brightfold.sources.results import SUMMARY_SCHEMA, write_csv, write_json

METHODS = ("grid", "search")


def train_all(
    train: DataFrame,
    features: Sequence[str] = config.FEATURES,
    profile: str = "native",
    method: str = "grid",
    families: Sequence[str] = config.FAMILIES,
    out: str | None = None,
    key: Callable[[int], Column] | None = None,
    ties: Sequence[str] = (),
    grids: Mapping[str, Mapping] = config.PARAM_GRIDS,
    spaces: Mapping[str, Mapping] = config.SEARCH_SPACES,
    settings: Mapping[str, Mapping] | None = None,
    folds: int | None = None,
    trials: int = config.TRIALS,
    time_budget_s: float | None = None,
    search_rows: int | None = config.SEARCH_ROWS,
    refit_rows: int | None = config.REFIT_ROWS,
    parallelism: int = 2,
    seed: int = config.SEED,
    leak_free: bool = False,
    partitions: int | None = None,
) -> dict[str, tuning.SearchResult]:
    """Tuned models by family; with `out`, the transform, models and tables are saved there.

    The native profile assigns folds by key and searches on all rows. The exact
    profile stratifies its folds, and its search scores candidates on a
    stratified sample and refits on a larger one. `key(seed)` is an integer row
    hash, of all columns when not given. With a time budget the candidates
    scored depend on the machine, so there is none unless asked for
    (`config.TIME_BUDGET_S`). `leak_free` fits the scaling inside
    each fold instead of once on all training rows. `partitions` deals the training
    rows out anew.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}, got {method!r}")
    spark = train.sparkSession
    checkpoint_root(spark)
    train = train.select(*ties, *[c for c in train.columns if c not in ties])
    columns = train.columns
    key = key or (lambda s: row_hash(columns, s))
    sampled = profile == "exact" and method == "search"
    folds = folds or (config.SEARCH_FOLDS if sampled else config.FOLDS)

    transform = feature_stages(features, profile).fit(train)
    if out is not None:
        model_files.save_overwriting(transform, model_files.feature_path(out, profile))

    if sampled:
        rows = nested_samples(train, search_rows, refit_rows, folds, key(seed), ties)
        rows = rows.where(F.col("fold").isNotNull() | F.col("in_refit"))
    elif profile == "exact":
        rows = stratified_kfold(train, key(seed + 1), ties, folds)
    else:
        rows = kfold(train, key(seed), folds)

    # One persisted frame serves search and refit: both are filters of it.
    flagged = with_validation_flag(transform.transform(spread(rows, partitions)), key(seed + 2))
    kept = ["label", "is_val", "fold", *(["in_refit"] if sampled else []), *(features if leak_free else []), "features"]
    held = flagged.select(*kept).persist(StorageLevel.MEMORY_AND_DISK)
    data = held.where(F.col("fold").isNotNull()) if sampled else held
    refit_data = held.where("in_refit") if sampled else held if leak_free else None
    if leak_free:
        data = data.drop("features")
    results = {}
    try:
        for family in families:
            plain = make_estimator(family, profile, **(settings or {}).get(family, {}))
            estimator = plain
            if leak_free:
                estimator = Pipeline(stages=[*feature_stages(features, profile).getStages(), plain])
            if method == "grid":
                candidates = tuning.param_grid(spark, grids[family])
            else:
                candidates = tuning.search_candidates(spark, spaces[family], trials)
            results[family] = tuning.search(
                data, family, estimator, candidates, profile, folds,
                parallelism=parallelism, time_budget_s=time_budget_s,
                refit_df=refit_data, refit_estimator=plain,
            )
            if out is not None:
                path = model_files.model_path(out, profile, family)
                model_files.save_overwriting(results[family].model, path)
                write_csv(results[family].cv_results, f"{path}_cv_results")
                write_csv(results[family].fold_scores, f"{path}_fold_scores")
    finally:
        held.unpersist()
    if out is not None:
        write_json(training_summary(spark, results), f"{out}/{profile}/training_summary")
    return results


def training_summary(spark, results: Mapping[str, tuning.SearchResult]) -> DataFrame:
    """One row per model: parameters, CV score, search and refit seconds."""
    return spark.createDataFrame([tuning.summary_row(r) for r in results.values()], SUMMARY_SCHEMA)

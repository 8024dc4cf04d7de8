"""Fit and predict times on the running cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from brightfold import config
from brightfold.operators import timing
from brightfold.functions.expressions import row_hash
from brightfold.operators.estimators import make_estimator, with_validation_flag
from brightfold.operators.features import feature_stages
from brightfold.session import checkpoint_root, cores_in_use, spread
from brightfold.sources.results import BENCHMARK_SCHEMA, write_csv


def benchmark(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str] = config.FEATURES,
    families: Sequence[str] = config.FAMILIES,
    profiles: Sequence[str] = config.PROFILES,
    out: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """One timing row per profile and model, at the cores the session has.

    Each profile has its own scaling; `native` times the fixed benchmark settings, `exact`
    its estimators as they are.

    Inputs are materialized first, so the times hold no reading. Rows from
    sessions of other sizes can be appended and compared with `timing.speedup`.
    """
    spark = train.sparkSession
    checkpoint_root(spark)
    rows = []
    for profile in profiles:
        rows += _times(train, test, features, families, profile, partitions)
    results = spark.createDataFrame(rows, BENCHMARK_SCHEMA)
    if out is not None:
        write_csv(results, f"{out}/benchmark_results")
    return results


def _times(train, test, features, families, profile, partitions) -> list[tuple]:
    transform = feature_stages(features, profile).fit(train)
    settings = "benchmark" if profile == "native" else profile
    sides = [
        with_validation_flag(transform.transform(spread(df, partitions)), row_hash(features, 1))
        .select("label", "is_val", "features").persist(StorageLevel.MEMORY_AND_DISK)
        for df in (train, test)
    ]
    rows = []
    try:
        for df in sides:
            df.count()
        for family in families:
            model, train_s = timing.timed_fit(make_estimator(family, settings), sides[0])
            predict_s = timing.timed_predict(model, sides[1])
            rows.append((
                profile, config.DISPLAY_NAMES[family], cores_in_use(train.sparkSession),
                round(train_s, 3), round(predict_s, 3),
            ))
    finally:
        for df in sides:
            df.unpersist()
    return rows

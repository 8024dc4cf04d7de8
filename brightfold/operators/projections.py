"""Feature selection, long form and class filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from brightfold import config


def project(
    df: DataFrame,
    features: Sequence[str] = config.FEATURES,
    label: str = config.LABEL,
    keys: Sequence[str] = (),
) -> DataFrame:
    return df.select(*keys, *features, label)


def feature_group(
    df: DataFrame,
    name: str,
    groups: Mapping[str, Sequence[str]] = config.FEATURE_GROUPS,
    override: Sequence[str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The columns of one named group, or of an explicit list instead."""
    if override is None and name not in groups:
        raise ValueError(f"unknown feature group {name!r}")
    return df.select(*keep, *(override or groups[name]))


def to_long(df: DataFrame, features: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """One row per (row, feature); a narrow expansion, nothing is shuffled."""
    doubles = [F.col(c).cast("double").alias(c) for c in features]
    return df.select(*keys, *doubles).unpivot(list(keys), list(features), "feature", "value")


def grouped_long(
    df: DataFrame,
    groups: Mapping[str, Sequence[str]] = config.FEATURE_GROUPS,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Long form with the group of each feature."""
    members = [name for columns in groups.values() for name in columns]
    group = F.coalesce(*[
        F.when(F.col("feature").isin(*columns), F.lit(name)) for name, columns in groups.items()
    ])
    return to_long(df, members, keys).withColumn("feature_group", group)


def one_class(df: DataFrame, value: int, label: str = config.LABEL) -> DataFrame:
    return df.where(F.col(label) == value)

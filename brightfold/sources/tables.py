"""Labelled wide tables: headerless CSV or Parquet in, one DataFrame out."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from brightfold import config
from brightfold.functions.expressions import as_label, is_missing
from brightfold.session import workspace

NULL_POLICIES = ("error", "skip", "keep")


def labelled_schema(
    features: Sequence[str] = config.FEATURES, label: str = config.LABEL
) -> T.StructType:
    """Label first, then the features, all double: the layout of the files."""
    return T.StructType([T.StructField(c, T.DoubleType(), False) for c in [label, *features]])


def apply_null_policy(df: DataFrame, columns: Sequence[str], on_null: str) -> DataFrame:
    """NULL and NaN cells: fail the job, drop the row, or leave them."""
    if on_null not in NULL_POLICIES:
        raise ValueError(f"on_null must be one of {NULL_POLICIES}, got {on_null!r}")
    if on_null == "keep":
        return df
    missing = F.lit(False)
    for name in columns:
        column = F.col(name)
        floating = df.schema[name].dataType in (T.DoubleType(), T.FloatType())
        missing = missing | (is_missing(column) if floating else column.isNull())
    if on_null == "skip":
        return df.where(~missing)
    failure = F.raise_error(F.lit("missing value in " + ", ".join(columns))).cast("boolean")
    return df.where(F.when(missing, failure).otherwise(F.lit(True)))


def check_labels(df: DataFrame, label: str = config.LABEL, on_bad: str = "error") -> DataFrame:
    """Labels other than 0, 1 and NULL: fail the job, drop the row, or leave them."""
    if on_bad not in NULL_POLICIES:
        raise ValueError(f"on_bad must be one of {NULL_POLICIES}, got {on_bad!r}")
    if on_bad == "keep":
        return df
    valid = F.col(label).isNull() | F.col(label).isin(0, 1)
    if on_bad == "skip":
        return df.where(valid)
    failure = F.raise_error(F.lit(f"{label} other than 0 and 1")).cast("boolean")
    return df.where(F.when(valid, F.lit(True)).otherwise(failure))


def cast_label(df: DataFrame, label: str = config.LABEL) -> DataFrame:
    return df.withColumn(label, as_label(F.col(label)))


def label_rejects(df: DataFrame, label: str = config.LABEL) -> DataFrame:
    """One row from one scan: the rows, and the labels that are missing or neither 0 nor 1."""
    valid = F.coalesce(F.col(label).isin(0, 1), F.lit(False))
    return df.agg(F.count("*").alias("n_rows"), F.count_if(~valid).alias("n_rejected"))


def load_counted(
    spark: SparkSession, read: Callable[[SparkSession], DataFrame], label: str = config.LABEL, path: str | None = None
) -> tuple[DataFrame, dict[str, int]]:
    """Store a table as Parquet and count it in the same pass: the stored table, and n_rows and n_rejected.

    `read` builds the table in the session it is given. That is one of its own, over the same
    application: a session that has observed metrics can't be sent to tasks, which the
    training summary of a fitted logistic regression would try. The counts are those of the
    write that succeeded; tasks run again don't count twice.
    """
    path = path or workspace(spark, "loaded")
    counted, df = Observation(), read(spark.newSession())
    valid = F.coalesce(F.col(label).isin(0, 1), F.lit(False))
    df.observe(counted, F.count(F.lit(1)).alias("n_rows"), F.count_if(~valid).alias("n_rejected")).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), counted.get


def read_labelled_csv(
    spark: SparkSession,
    path: str,
    features: Sequence[str] = config.FEATURES,
    label: str = config.LABEL,
    on_null: str = "error",
) -> DataFrame:
    """Headerless CSV under the fixed schema, label cast to int: no inference pass."""
    raw = spark.read.schema(labelled_schema(features, label)).csv(path, header=False)
    return check_labels(apply_null_policy(cast_label(raw, label), [label, *features], on_null), label, on_null)


def read_labelled_parquet(
    spark: SparkSession,
    path: str,
    features: Sequence[str] = config.FEATURES,
    label: str = config.LABEL,
    on_null: str = "error",
) -> DataFrame:
    raw = spark.read.parquet(path).select(label, *features)
    return check_labels(apply_null_policy(cast_label(raw, label), [label, *features], on_null), label, on_null)


def choose_split(df: DataFrame, split: str = "train", fold: str = "fold") -> DataFrame:
    """Fold 0 is the test side; any name but "train" means test."""
    held_out = F.col(fold) == 0
    return df.where(~held_out if split == "train" else held_out)

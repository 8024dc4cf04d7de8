"""Inputs of the registered queries, derived from the given tables."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from brightfold.functions.expressions import key_hash, sigmoid
from brightfold.operators.features import feature_stages
from brightfold.session import partitions_for, spread
from brightfold.sources.tables import choose_split

KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
#: Least partitions of the registered queries' training input; larger inputs get more (`training_partitions`).
INPUT_PARTITIONS = 8
HASH_KEYS = ["l_orderkey", "l_partkey", "l_linenumber"]
FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
GROUPS = {"low_level": FEATURES[:2], "high_level": FEATURES[2:]}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with a label that mixes an interaction, a trend and key noise."""
    noise = (
        F.col("l_orderkey") * 7919 + F.col("l_partkey") * 104729 + F.col("l_linenumber") * 1299709
    ) % 1000
    margin = (
        (F.col("l_quantity") - 25.5) / 14.43 * (F.col("l_discount") - 0.05) / 0.029
        + (F.col("l_extendedprice") - 53000.0) / 30000.0
        + (noise / F.lit(500.0) - 1.0) * 1.5
    )
    fold = (F.col("l_orderkey") * 31 + F.col("l_partkey") * 17 + F.col("l_linenumber") * 7) % 5
    return table(spark, sf_dir, "lineitem").select(
        *KEYS,
        *FEATURES,
        F.when(margin > 0.0, 1).otherwise(0).cast("int").alias("label"),
        fold.cast("int").alias("fold"),
    )


def training_partitions(rows: DataFrame) -> int:
    """Partitions for a frame's rows, found by a count that reads only what its filters need."""
    return partitions_for(rows.count(), INPUT_PARTITIONS)


def line_hash(seed: int = 0):
    return key_hash(HASH_KEYS, seed)


def fixed_margin(quantity_weight=0.02):
    return (F.col("l_extendedprice") - 53000.0) / 30000.0 + (
        F.col("l_quantity") - 25.5
    ) * F.lit(quantity_weight)


def fixed_scores(df: DataFrame) -> DataFrame:
    """Scores from given weights: metrics can be checked without any training."""
    scored = df.withColumn("score", sigmoid(fixed_margin()))
    return scored.withColumn("prediction", F.when(F.col("score") > 0.5, 1.0).otherwise(0.0))


# Weights of the fixed scorers that stand for tuned models.
FIXED_MODELS = [
    ("native", "Logistic Regression", 0.02),
    ("native", "Random Forest", 0.0),
    ("native", "Gradient Boosted Trees", 0.05),
    ("exact", "Logistic Regression", 0.03),
    ("exact", "Random Forest", -0.02),
    ("exact", "Gradient Boosted Trees", 0.08),
]


def fixed_model_scores(df: DataFrame, models=FIXED_MODELS) -> DataFrame:
    entries = F.array(*[
        F.struct(
            F.lit(framework).alias("framework"),
            F.lit(model).alias("model"),
            sigmoid(fixed_margin(weight)).alias("score"),
        )
        for framework, model, weight in models
    ])
    scored = df.select("label", F.inline(entries))
    return scored.withColumn("prediction", F.when(F.col("score") > 0.5, 1.0).otherwise(0.0))


def timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark rows from the event stream: mean event values per type and user class."""
    cores = F.element_at(F.array(*map(F.lit, (1, 2, 4, 8))), (F.col("user_id") % 4 + 1).cast("int"))
    framework = F.when(F.col("user_id") % 3 == 0, "native").otherwise("exact")
    return (
        table(spark, sf_dir, "events")
        .groupBy(framework.alias("framework"), F.col("event_type").alias("model"), cores.alias("n_cores"))
        .agg(
            F.round(F.avg("value"), 3).alias("train_time"),
            F.round(F.avg(F.col("value") / 10.0), 3).alias("predict_time"),
        )
    )


@contextmanager
def persisted(df: DataFrame):
    """Keep a frame that several passes read; lost blocks recompute from its plan."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def scaled(spark: SparkSession, sf_dir: str, profile: str = "native"):
    """Base table with the scaled vector of the training statistics, and the fitted transform."""
    rows = base(spark, sf_dir)
    rows = spread(rows, training_partitions(rows))
    fitted = feature_stages(FEATURES, profile).fit(choose_split(base(spark, sf_dir), "train"))
    return fitted.transform(rows), fitted

"""Result tables as CSV and JSON, written by the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

BENCHMARK_SCHEMA = T.StructType([
    T.StructField("framework", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("n_cores", T.IntegerType()),
    T.StructField("train_time", T.DoubleType()),
    T.StructField("predict_time", T.DoubleType()),
])
EVALUATION_SCHEMA = T.StructType([
    T.StructField("framework", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("roc_auc", T.DoubleType()),
])
SUMMARY_SCHEMA = T.StructType([
    T.StructField("framework", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("best_params", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("cv_score", T.DoubleType()),
    T.StructField("search_s", T.DoubleType()),
    T.StructField("refit_s", T.DoubleType()),
    T.StructField("train_time", T.DoubleType()),
])


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.mode("overwrite").csv(path, header=header)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=header)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)

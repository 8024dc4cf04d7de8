"""Feature vectors and standard scaling.

Two scalings: "native" divides by the sample deviation and maps constant
columns to 0; "exact" divides by the population deviation and leaves constant
columns centred. Both fit in one aggregation and apply as narrow projections.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasInputCols, HasOutputCol
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from brightfold import config


def assemble(
    df: DataFrame,
    features: Sequence[str] = config.FEATURES,
    out: str = "raw_features",
    handle_invalid: str = "error",
) -> DataFrame:
    return VectorAssembler(
        inputCols=list(features), outputCol=out, handleInvalid=handle_invalid
    ).transform(df)


def assemble_array(df: DataFrame, array: str, out: str = "raw_features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(array).cast("array<double>")))


def unpack(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """Vector elements as columns, the vector dropped."""
    values = vector_to_array(F.col(vector))
    return df.withColumns({n: values[i] for i, n in enumerate(names)}).drop(vector)


class PopulationScaler(Estimator, HasInputCols, HasOutputCol):
    """Standard scaling by population deviation, fitted to a model of built-in stages."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset):
        columns, out = self.getInputCols(), self.getOutputCol()
        vectors = VectorAssembler(inputCols=columns, outputCol="_raw").transform(dataset)
        row = vectors.select(
            Summarizer.metrics("mean", "std", "count").summary(F.col("_raw")).alias("s")
        ).head()["s"]
        n = row["count"]
        if not n:
            raise ValueError("no rows to fit the scaling on")
        shrink = ((n - 1) / n) ** 0.5
        scaled = []
        for c, mean, std in zip(columns, row["mean"], row["std"]):
            divisor = float(std) * shrink or 1.0
            scaled.append(f"(`{c}` - ({float(mean)!r}D)) / ({divisor!r}D) AS `{c}__{out}`")
        names = [f"{c}__{out}" for c in columns]
        quoted = ", ".join(f"`{n}`" for n in names)
        return PipelineModel([
            SQLTransformer(statement=f"SELECT *, {', '.join(scaled)} FROM __THIS__"),
            VectorAssembler(inputCols=names, outputCol=out),
            SQLTransformer(statement=f"SELECT * EXCEPT ({quoted}) FROM __THIS__"),
        ])


def feature_stages(
    features: Sequence[str] = config.FEATURES, profile: str = "native", out: str = "features"
) -> Pipeline:
    """Unfitted two-step transform: assemble, then scale."""
    if profile == "native":
        raw = f"raw_{out}"
        return Pipeline(stages=[
            VectorAssembler(inputCols=list(features), outputCol=raw),
            StandardScaler(inputCol=raw, outputCol=out, withMean=True, withStd=True),
        ])
    if profile == "exact":
        return Pipeline(stages=[PopulationScaler(inputCols=list(features), outputCol=out)])
    raise ValueError(f"unknown profile {profile!r}")

"""Batch prediction with one or many fitted models in a single scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from brightfold import config
from brightfold.operators import grown


def _made_columns(stages: Sequence) -> list[str]:
    """Columns that stages add."""
    made = []
    for stage in stages:
        if isinstance(stage, PipelineModel):
            made += _made_columns(stage.stages)
        elif stage.hasParam("outputCol"):
            made.append(stage.getOrDefault("outputCol"))
    return made


def predict(df: DataFrame, model) -> DataFrame:
    """The model's prediction, raw score and probability columns, appended."""
    return model.transform(df)


def positive_probability(df: DataFrame, probability: str = "probability", out: str = "score") -> DataFrame:
    return df.withColumn(out, vector_to_array(F.col(probability))[1])


def append_scores(df: DataFrame, models: Sequence) -> DataFrame:
    """`prediction_i` and `score_i` of every model, appended in one projection.

    Models that hold the same stages before the classifier have them applied once. A stage
    saved and loaded again keeps its uid, but is one of its own and is applied as such.
    Ensembles known by their nodes are scored by these (`grown`).
    """
    columns, scored = df.columns, df
    groups: dict[tuple, list] = {}
    for i, model in enumerate(models):
        stages = model.stages if isinstance(model, PipelineModel) else [model]
        groups.setdefault(tuple(map(id, stages[:-1])), []).append((i, stages))
    for members in groups.values():
        before = members[0][1][:-1]
        for stage in before:
            scored = stage.transform(scored)
        for i, stages in members:
            last = stages[-1]
            if (nodes := grown.scorer_of(last)) is not None:
                scored = scored.withColumn(f"score_{i}", grown.score_column(nodes, grown.features_of(last)))
                scored = scored.withColumn(f"prediction_{i}", (F.col(f"score_{i}") > 0.5).cast("double"))
                continue
            scored = last.transform(scored, {
                last.predictionCol: f"prediction_{i}",
                last.probabilityCol: f"_probability_{i}",
                last.rawPredictionCol: f"_raw_{i}",
            })
            scored = positive_probability(scored, f"_probability_{i}", f"score_{i}")
        if before:
            scored = scored.drop(*_made_columns(before))
    made = [f"{name}_{i}" for i in range(len(models)) for name in ("prediction", "score")]
    return scored.select(*columns, *made)


def score_models(
    df: DataFrame,
    models: Mapping[tuple, object],
    names: Sequence[str],
    keep: Sequence[str] = (config.LABEL,),
) -> DataFrame:
    """One row per (row, model): `names` identify the model, with prediction and score.

    All models are applied over one scan of the input, then the columns are
    turned into rows; nothing is shuffled. The width is the number of models,
    which the caller chose.
    """
    entries = F.array(*[
        F.struct(
            *[F.lit(part).alias(name) for part, name in zip(key, names)],
            F.col(f"prediction_{i}").alias("prediction"),
            F.col(f"score_{i}").alias("score"),
        )
        for i, key in enumerate(models)
    ])
    return append_scores(df, list(models.values())).select(*keep, F.inline(entries))

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from brightfold.operators.features import feature_stages
from brightfold.operators.scoring import append_scores


def test_stages_of_one_uid_are_applied_each_by_itself(spark):
    """A reloaded transform has its original's uid; a model behind it must be given what that transform makes."""
    df = spark.createDataFrame([(i % 2, float(i), float(i * i % 7)) for i in range(40)], "label int, a double, b double")
    pipeline = feature_stages(["a", "b"])
    first, other = pipeline.fit(df), pipeline.fit(df.withColumn("a", F.col("a") * 3 + 5))
    assert [s.uid for s in first.stages] == [s.uid for s in other.stages]
    model = LogisticRegression().fit(first.transform(df))
    models = [PipelineModel([*t.stages, model]) for t in (first, other, first)]
    rows = append_scores(df, models).collect()
    assert rows[0].asDict().keys() == {"label", "a", "b", *(f"{c}_{i}" for i in range(3) for c in ("prediction", "score"))}
    assert all(r["score_0"] == r["score_2"] for r in rows)
    alone = {r["a"]: r["score_0"] for r in append_scores(df, models[1:2]).collect()}
    assert all(r["score_1"] == alone[r["a"]] for r in rows) and any(r["score_1"] != r["score_0"] for r in rows)

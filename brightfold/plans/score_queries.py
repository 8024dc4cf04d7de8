"""Registered queries: metrics, comparison tables, timing tables and candidates.

Scores here come from given weights, so every value can be recomputed in SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from brightfold import config
from brightfold.functions.expressions import sigmoid
from brightfold.operators import metrics, report, timing, tuning
from brightfold.operators.estimators import SPARK_NAMES, make_estimator, param_map, spark_params
from brightfold.plans.inputs import (
    KEYS,
    base,
    fixed_margin,
    fixed_model_scores,
    fixed_scores,
    timings,
)
from brightfold.session import workspace
from brightfold.sources import results
from brightfold.sources.tables import choose_split


def _test_scores(spark, sf_dir):
    return fixed_scores(choose_split(base(spark, sf_dir), "test"))


def score_fixed_lr(spark, sf_dir):
    return _test_scores(spark, sf_dir).select(*KEYS, F.round("score", 8).alias("score"), "prediction")


def accuracy(spark, sf_dir):
    scores = fixed_scores(base(spark, sf_dir))
    return metrics.accuracy(scores, ["fold"]).withColumn("accuracy", F.round("accuracy", 6))


def roc_auc(spark, sf_dir):
    scores = fixed_scores(base(spark, sf_dir))
    return metrics.roc_auc(scores, ["fold"]).withColumn("roc_auc", F.round("roc_auc", 6))


def roc_auc_tied(spark, sf_dir):
    """Scores rounded to two places: heavy ties, each counted half."""
    scores = fixed_scores(base(spark, sf_dir)).withColumn("score", F.round("score", 2))
    return metrics.roc_auc(scores).withColumn("roc_auc", F.round("roc_auc", 6))


def roc_auc_builtin(spark, sf_dir):
    """The library evaluator with every distinct score ranked."""
    scores = _test_scores(spark, sf_dir)
    value = metrics.auc_evaluator(raw="score", bins=0).evaluate(scores)
    return scores.agg(
        F.count("*").alias("n_rows"), F.round(F.lit(float(value)), 6).alias("roc_auc")
    )


def leaderboard_fixed(spark, sf_dir):
    return report.leaderboard(fixed_model_scores(choose_split(base(spark, sf_dir), "test")))


def leaderboard_union(spark, sf_dir):
    test = choose_split(base(spark, sf_dir), "test")
    halves = []
    for framework in config.PROFILES:
        scores = fixed_model_scores(test).where(F.col("framework") == framework)
        halves.append(report.leaderboard(scores))
    return report.append_results(*halves)


def _pivot(spark, sf_dir, metric):
    wide = report.framework_pivot(leaderboard_fixed(spark, sf_dir), metric, config.PROFILES)
    return wide.withColumn("difference", F.round("difference", 5))


def framework_pivot(spark, sf_dir):
    return report.append_results(*[
        _pivot(spark, sf_dir, metric).withColumn("metric", F.lit(metric))
        for metric in ("accuracy", "roc_auc")
    ])


def benchmark_series(spark, sf_dir):
    return timing.series(timings(spark, sf_dir), "native")


def speedup_table(spark, sf_dir):
    return timing.speedup(timings(spark, sf_dir))


def _candidate_weights(spark):
    """The grid of C values, each read as a weight of the fixed scorer."""
    return tuning.candidate_dicts(tuning.param_grid(spark, config.PARAM_GRIDS["lr"]))


def _fold_scores(spark, sf_dir):
    entries = F.array(*[
        F.struct(F.lit(i).alias("candidate"), sigmoid(fixed_margin(c["C"] / 50.0)).alias("score"))
        for i, c in enumerate(_candidate_weights(spark))
    ])
    scores = base(spark, sf_dir).select("label", "fold", F.inline(entries))
    return metrics.roc_auc(scores, ["candidate", "fold"]).withColumnRenamed("roc_auc", "auc")


def cv_mean_score(spark, sf_dir):
    means = tuning.mean_scores(_fold_scores(spark, sf_dir))
    return means.withColumns({c: F.round(c, 6) for c in ("mean_auc", "std_auc")})


def best_candidate(spark, sf_dir):
    best = tuning.best_candidate(tuning.mean_scores(_fold_scores(spark, sf_dir)))
    return best.withColumn("mean_auc", F.round("mean_auc", 6))


def _mapped(spark, sf_dir, candidates_of):
    """Candidates of every family with the penalty the training rows give them."""
    n_rows = choose_split(base(spark, sf_dir), "train").agg(F.count("*").alias("n_train"))
    names = ["C", "max_iter", "n_estimators", "max_depth", "learning_rate"]
    tables = []
    for family in config.FAMILIES:
        candidates = candidates_of(family)
        tables.append(candidates.select(
            F.lit(family).alias("family"),
            "candidate",
            *[
                (F.col(n) if n in candidates.columns else F.lit(None)).cast("double").alias(n)
                for n in names
            ],
        ))
    n_train = n_rows.head()["n_train"]
    reg = F.lit(1.0) / (F.col("C") * F.lit(float(n_train)))
    return report.append_results(*tables).withColumn("reg_param_exact", reg)


def param_grid(spark, sf_dir):
    rows = _mapped(spark, sf_dir, lambda f: tuning.param_grid(spark, config.PARAM_GRIDS[f]))
    return rows.withColumn("reg_param_exact", F.round("reg_param_exact", 12))


def search_candidates(spark, sf_dir):
    rows = _mapped(spark, sf_dir, lambda f: tuning.search_candidates(spark, config.SEARCH_SPACES[f]))
    return rows.withColumns({
        c: F.round(c, d) for c, d in (("C", 8), ("learning_rate", 8), ("reg_param_exact", 12))
    })


def param_mapping(spark, sf_dir):
    """Spark parameters of the first grid candidate, per family and profile."""
    n_train = choose_split(base(spark, sf_dir), "train").count()
    rows = []
    for family in config.FAMILIES:
        first = tuning.candidate_dicts(tuning.param_grid(spark, config.PARAM_GRIDS[family]))[0]
        for profile in config.PROFILES:
            estimator = make_estimator(family, profile)
            configured = estimator.copy(
                param_map(estimator, spark_params(family, first, profile, n_train))
            )
            for name in sorted(SPARK_NAMES[family].values()):
                rows.append((family, profile, name, float(configured.getOrDefault(name))))
    frame = spark.createDataFrame(rows, "family string, profile string, param string, value double")
    return frame.withColumn("value", F.round("value", 12))


def result_csv_roundtrip(spark, sf_dir):
    path = workspace(spark, "evaluation_results")
    results.write_csv(leaderboard_fixed(spark, sf_dir), path)
    return results.read_csv(spark, path, results.EVALUATION_SCHEMA)


QUERIES = {
    f.__name__: f
    for f in (
        score_fixed_lr, accuracy, roc_auc, roc_auc_tied, roc_auc_builtin, leaderboard_fixed,
        leaderboard_union, framework_pivot, benchmark_series, speedup_table, cv_mean_score,
        best_candidate, param_grid, search_candidates, param_mapping, result_csv_roundtrip,
    )
}

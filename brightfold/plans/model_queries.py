"""Registered queries: fitted models, tuning, scoring and timing.

Logistic regressions have one optimum, so their coefficients and scores are
compared by value. Tree ensembles are random by design: their queries report
exact row counts and the invariants every fitted ensemble must meet.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from brightfold import config
from brightfold.operators import boosting, cells, metrics, shared_fit, split, timing, tuning
from brightfold.operators.estimators import (
    make_estimator,
    param_map,
    spark_params,
    with_validation_flag,
)
from brightfold.operators.features import assemble, feature_stages
from brightfold.operators.scoring import append_scores, positive_probability, predict, score_models
from brightfold.plans.evaluate import evaluate_models, evaluate_saved
from brightfold.plans.inputs import FEATURES, KEYS, base, line_hash, persisted, training_partitions
from brightfold.plans.train import train_all
from brightfold.session import checkpoint_root, cores_in_use, spread, workspace
from brightfold.sources import models as model_files
from brightfold.sources.results import SUMMARY_SCHEMA
from brightfold.sources.tables import choose_split

# Tight enough that a fit and its recomputed optimum agree to four places, and within reach of the line search.
TOLERANCE = 1e-9
#: Gradient component below which a fit counts as converged.
CONVERGED = 1e-6


@contextmanager
def _training_data(spark, sf_dir, profile="native"):
    """Scaled training rows, kept while a query fits on them; and the fitted transform."""
    checkpoint_root(spark)
    train = choose_split(base(spark, sf_dir), "train")
    transform = feature_stages(FEATURES, profile).fit(train)
    rows = with_validation_flag(transform.transform(spread(train, training_partitions(train))), line_hash(44))
    with persisted(rows.select("label", "fold", "is_val", "features")) as data:
        yield data, transform


def _test(spark, sf_dir, transform=None):
    test = choose_split(base(spark, sf_dir), "test")
    return test if transform is None else transform.transform(test)


def _lr(profile, n_rows=None, **settings):
    estimator = make_estimator("lr", profile, tol=TOLERANCE, **settings)
    if profile == "exact":
        mapped = spark_params("lr", {"C": 1.0}, profile, n_rows)
        return estimator.copy(param_map(estimator, mapped))
    return estimator


def _coefficients(spark, model):
    rows = [("intercept", model.intercept), *zip(FEATURES, model.coefficients.toArray().tolist())]
    frame = spark.createDataFrame([(t, float(v)) for t, v in rows], "term string, coefficient double")
    return frame.withColumn("coefficient", F.round("coefficient", 4))


def _fitted_lr(spark, sf_dir, profile="native"):
    with _training_data(spark, sf_dir, profile) as (data, transform):
        n_rows = data.count() if profile == "exact" else None
        return _lr(profile, n_rows).fit(data), transform


def _converged_lr(spark, sf_dir, profile):
    """Coefficients of a fit on all training rows, and whether its gradient vanishes there."""
    with _training_data(spark, sf_dir, profile) as (data, _):
        n_rows = data.count()
        estimator = _lr(profile, n_rows)
        model = estimator.fit(data)
        blocks = shared_fit.blocks(data)
        task = shared_fit.Task((), None, estimator.getRegParam(), estimator.getStandardization())
        gradient = shared_fit.gradient_at(
            blocks, shared_fit.fold_moments(data), task, model.coefficients.toArray(), model.intercept)
        blocks.unpersist()
    return _coefficients(spark, model).withColumn("gradient_vanishes", F.lit(gradient < CONVERGED))


def fit_lr(spark, sf_dir):
    """Coefficients by value, and the first-order condition of the objective at them."""
    return _converged_lr(spark, sf_dir, "native")


def fit_lr_exact(spark, sf_dir):
    return _converged_lr(spark, sf_dir, "exact")


def predict_batch(spark, sf_dir):
    """Predictions of a fitted logistic regression on the test rows, by label."""
    model, transform = _fitted_lr(spark, sf_dir)
    scored = predict(_test(spark, sf_dir, transform), model)
    return scored.groupBy("label", "prediction").agg(F.count("*").alias("n_rows"))


def predict_proba(spark, sf_dir):
    model, transform = _fitted_lr(spark, sf_dir)
    scored = positive_probability(predict(_test(spark, sf_dir, transform), model))
    return scored.groupBy("label").agg(
        F.count("*").alias("n_rows"),
        F.round(F.avg("score"), 4).alias("mean_score"),
        F.round(F.stddev_samp("score"), 4).alias("std_score"),
    )


def _ensemble_checks(spark, sf_dir, entries):
    """Fit each (family, profile, settings); count rows and check what every ensemble must meet."""
    models, sizes, trees, rounds, by_losses = {}, {}, {}, {}, {}
    for scaling in dict.fromkeys("exact" if profile == "exact" else "native" for _, profile, _ in entries):
        with _training_data(spark, sf_dir, scaling) as (data, transform):
            n_train = data.count()
            for family, profile, settings in entries:
                if (profile == "exact") != (scaling == "exact"):
                    continue
                estimator = make_estimator(family, profile, **settings)
                stops = family == "gbt" and estimator.isDefined("validationIndicatorCol")
                # The stop is checked against a run on the same rows.
                model = estimator.fit(data) if stops else cells.fit(estimator, data)
                models[family, profile] = PipelineModel([transform, model])
                sizes[family, profile] = n_train
                trees[family, profile] = None if family == "lr" else len(model.treeWeights)
                if stops:
                    rounds[family, profile] = estimator.getMaxIter()
                    by_losses[family, profile] = boosting.stops_by_losses(estimator, model, data)
    scores = score_models(_test(spark, sf_dir), models, ["family", "profile"])
    with persisted(scores) as scores:
        quality = metrics.classification_metrics(scores, ["family", "profile"]).collect()
        bounds = scores.groupBy("family", "profile").agg(
            F.bool_and(F.col("score").between(0.0, 1.0)).alias("valid"),
            F.bool_and((F.col("score") > 0.5) == (F.col("prediction") == 1.0)).alias("consistent"),
        ).collect()
    checks = {(r["family"], r["profile"]): r for r in bounds}
    rows = []
    for r in quality:
        at = r["family"], r["profile"]
        stops = at in rounds
        rows.append((
            *at, sizes[at], r["n_rows"], None if stops else trees[at],
            trees[at] < rounds[at] if stops else None, by_losses.get(at),
            checks[at]["valid"], checks[at]["consistent"], r["roc_auc"] > 0.75,
        ))
    return spark.createDataFrame(
        rows,
        "family string, profile string, n_train bigint, n_scored bigint,"
        " n_trees bigint, stopped_early boolean, stops_by_losses boolean, probabilities_valid boolean, predictions_consistent boolean, separates_classes boolean",
    )


def fit_rf(spark, sf_dir):
    return _ensemble_checks(spark, sf_dir, [("rf", "native", {})])


def fit_gbt(spark, sf_dir):
    return _ensemble_checks(spark, sf_dir, [("gbt", "native", {})])


def fit_rf_exact(spark, sf_dir):
    """Half-row forest of all its trees, grown to Spark's limit of depth."""
    return _ensemble_checks(spark, sf_dir, [("rf", "exact", {})])


def fit_gbt_exact(spark, sf_dir):
    """Boosting of up to 100 rounds, stopped early; one round more, unstopped, must lose where the rule says."""
    return _ensemble_checks(spark, sf_dir, [("gbt", "exact", {})])


def fit_benchmark_profile(spark, sf_dir):
    return _ensemble_checks(
        spark, sf_dir, [(family, "benchmark", {}) for family in config.FAMILIES]
    )


TREE_FEATURES = ["l_quantity", "l_discount", "l_tax"]


def fit_tree(spark, sf_dir):
    """One tree of two levels on all rows and features: test rows and positives for each leaf probability.

    Its features have few values, so every split is tried and the tree is the only answer.
    """
    rows = assemble(base(spark, sf_dir), TREE_FEATURES, "features")
    tree = make_estimator(
        "rf", numTrees=1, featureSubsetStrategy="all", bootstrap=False, maxBins=64, maxDepth=2
    ).fit(choose_split(rows, "train"))
    scored = positive_probability(predict(choose_split(rows, "test"), tree))
    return scored.groupBy(F.round("score", 6).alias("probability")).agg(
        F.count("*").alias("n_rows"), F.sum("label").alias("n_positive")
    )


def _small_boosting(spark, sf_dir):
    """Three rounds of two levels over columns of few values, where boosting has one answer; and both sides."""
    rows = assemble(base(spark, sf_dir), TREE_FEATURES, "features")
    checkpoint_root(spark)
    train, test = choose_split(rows, "train"), choose_split(rows, "test")
    return make_estimator("gbt", maxIter=3, maxDepth=2, maxBins=64, stepSize=0.3).fit(train), train, test


def fit_gbt_small(spark, sf_dir):
    """Test rows and positives for each probability of a small boosted ensemble, after each of its rounds."""
    model, _, test = _small_boosting(spark, sf_dir)
    parts = [
        positive_probability(predict(test, boosting.cut(model, n))).select(F.lit(n).alias("rounds"), "score", "label")
        for n in (1, 2, 3)
    ]
    scored = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return scored.groupBy("rounds", F.round("score", 6).alias("probability")).agg(
        F.count("*").alias("n_rows"), F.sum("label").alias("n_positive"))


def gbt_rounds(spark, sf_dir):
    """Loss of a small boosted ensemble after each round, on the rows it was trained on and on the others."""
    model, train, test = _small_boosting(spark, sf_dir)
    return boosting.loss_table(model, {"train": train, "test": test}).withColumn("loss", F.round("loss", 6))


def _cv_rows(result, digits=4):
    """Candidate results with scores rounded for comparison; the time itself depends on the machine."""
    rows = result.cv_results.withColumn("fit_timed", F.col("mean_fit_s") > 0).drop("mean_fit_s")
    return rows.withColumns({c: F.round(c, digits) for c in ("mean_auc", "std_auc")})


def _grid_search_lr(spark, sf_dir, profile):
    checkpoint_root(spark)
    train = choose_split(base(spark, sf_dir), "train").select(*KEYS, *FEATURES, "label")
    estimator = make_estimator("lr", profile, tol=TOLERANCE)
    if profile == "exact":
        folded = split.stratified_kfold(train, line_hash(43), KEYS)
    else:
        folded = split.kfold(train, line_hash(42))
    transform = feature_stages(FEATURES, profile).fit(train)
    data = transform.transform(spread(folded, training_partitions(train))).select("label", "fold", "features")
    with persisted(data) as data:
        candidates = tuning.param_grid(spark, config.PARAM_GRIDS["lr"])
        return tuning.search(data, "lr", estimator, candidates, profile)


def cv_results(spark, sf_dir):
    """Mean and deviation of the fold scores per grid candidate."""
    return _cv_rows(_grid_search_lr(spark, sf_dir, "native"))


def cv_fold_results(spark, sf_dir):
    """Every fold's score of every grid candidate."""
    result = _grid_search_lr(spark, sf_dir, "native")
    rank = result.cv_results.select("candidate", "rank")
    scores = result.fold_scores.withColumn("auc", F.round("auc", 4)).withColumn("fit_timed", F.col("fit_s") > 0).drop("fit_s")
    return scores.join(F.broadcast(rank), "candidate")


def grid_search_lr(spark, sf_dir):
    """Grid search over C and the coefficients of the refitted best model."""
    result = _grid_search_lr(spark, sf_dir, "native")
    return _coefficients(spark, result.model).select(
        "*",
        F.lit(float(result.best_params["C"])).alias("best_C"),
        F.lit(round(result.cv_score, 4)).alias("cv_score"),
    )


def grid_search_stratified(spark, sf_dir):
    """The exact profile: stratified folds and a per-row penalty."""
    return _cv_rows(_grid_search_lr(spark, sf_dir, "exact"))


# Candidates, folds and trials as in `config`, over smaller forests: every candidate is fitted once per fold.
RF_GRID = {"rf": {"n_estimators": [5, 10], "max_depth": [3, 6]}}
RF_SPACE = {"rf": {"n_estimators": ("int", 3, 8), "max_depth": ("int", 3, 6)}}


def _tree_search(spark, sf_dir, family, **options):
    """What a tree search must meet: all candidates scored on all folds, the best one chosen."""
    train = choose_split(base(spark, sf_dir), "train").select(*KEYS, *FEATURES, "label")
    result = train_all(
        train, FEATURES, families=[family], key=line_hash, ties=KEYS,
        partitions=training_partitions(train), **options
    )[family]
    table = result.cv_results
    best = F.max("mean_auc")
    return table.agg(
        F.count("*").alias("n_candidates"),
        F.sum("n_folds").alias("n_scores"),
        F.bool_and((F.col("mean_auc") > 0.6) & (F.col("mean_auc") < 1.0)).alias("scores_plausible"),
        (best == F.lit(result.cv_score)).alias("best_is_highest"),
    ).select(F.lit(family).alias("family"), F.lit(train.count()).cast("bigint").alias("n_train"), "*")


def grid_search_rf(spark, sf_dir):
    return _tree_search(spark, sf_dir, "rf", method="grid", grids=RF_GRID)


def grid_search_gbt(spark, sf_dir):
    return _tree_search(spark, sf_dir, "gbt", method="grid")


def search_rf(spark, sf_dir):
    return _tree_search(spark, sf_dir, "rf", method="search", spaces=RF_SPACE)


def search_gbt(spark, sf_dir):
    return _tree_search(spark, sf_dir, "gbt", method="search")


def _search_lr(spark, sf_dir, profile, **options):
    train = choose_split(base(spark, sf_dir), "train").select(*KEYS, *FEATURES, "label")
    result = train_all(
        train, FEATURES, profile, method="search", families=["lr"], key=line_hash, ties=KEYS,
        settings={"lr": {"tol": TOLERANCE}}, partitions=training_partitions(train), **options
    )["lr"]
    refitted = [result.model.intercept, *result.model.coefficients.toArray().tolist()]
    return _cv_rows(result).withColumn("C", F.round("C", 8)).select(
        "*", *[F.lit(round(float(w), 4) + 0.0).alias(f"refit_{t}") for t, w in zip(["intercept", *FEATURES], refitted)])


def search_lr(spark, sf_dir):
    """Ten trials over the range of C, five folds by key, all rows; the refitted best beside them."""
    return _search_lr(spark, sf_dir, "native")


def search_subsampled(spark, sf_dir):
    """Ten trials on half the rows in three stratified folds; the best refitted on three quarters that hold them."""
    n_train = choose_split(base(spark, sf_dir), "train").count()
    return _search_lr(spark, sf_dir, "exact", search_rows=n_train // 2, refit_rows=n_train * 3 // 4)


def training_summary_table(spark, sf_dir):
    """All three families trained and saved; the summary's JSON read back and checked."""
    out = workspace(spark, "training_summary")
    train = choose_split(base(spark, sf_dir), "train").select(*KEYS, *FEATURES, "label")
    train_all(
        train, FEATURES, out=out, key=line_hash, ties=KEYS, partitions=training_partitions(train),
    )
    summary = spark.read.schema(SUMMARY_SCHEMA).json(f"{out}/native/training_summary")
    return summary.select(
        "framework",
        "model",
        F.size("best_params").cast("int").alias("n_params"),
        F.col("cv_score").between(0.6, 1.0).alias("score_plausible"),
        (F.col("train_time") >= F.col("search_s")).alias("times_add_up"),
        F.lit(train.count()).cast("bigint").alias("n_train"),
    )


def model_roundtrip(spark, sf_dir):
    """Predictions of saved and reloaded models against those of the originals."""
    root = workspace(spark, "models")
    with _training_data(spark, sf_dir) as (data, transform):
        fitted = {
            "lr": make_estimator("lr").fit(data),
            "rf": make_estimator("rf", numTrees=5).fit(data),
            "gbt": make_estimator("gbt", maxIter=3).fit(data),
        }
    model_files.save_overwriting(transform, model_files.feature_path(root, "native"))
    reloaded = model_files.load_features(model_files.feature_path(root, "native"))
    models = []
    for family, model in fitted.items():
        path = model_files.model_path(root, "native", family)
        model_files.save_overwriting(model, path)
        models.append(PipelineModel([transform, model]))
        models.append(PipelineModel([reloaded, model_files.load_model(family, path)]))
    scored = append_scores(_test(spark, sf_dir), models)
    same = [
        (F.col(f"score_{i}") == F.col(f"score_{i + 1}"))
        & (F.col(f"prediction_{i}") == F.col(f"prediction_{i + 1}"))
        for i in range(0, len(models), 2)
    ]
    sides = F.array(*[
        F.struct(F.lit(family).alias("family"), equal.alias("same"))
        for family, equal in zip(fitted, same)
    ])
    return scored.select(F.inline(sides)).groupBy("family").agg(
        F.count("*").alias("n_rows"), F.count_if(~F.col("same")).alias("n_different")
    )


def leaderboard_lr(spark, sf_dir):
    """Both profiles of logistic regression on the test rows."""
    models = {}
    for profile in config.PROFILES:
        model, transform = _fitted_lr(spark, sf_dir, profile)
        models[profile, config.DISPLAY_NAMES["lr"]] = PipelineModel([transform, model])
    board = evaluate_models(_test(spark, sf_dir), models)
    return board.withColumns({c: F.round(c, 4) for c in ("accuracy", "roc_auc")})


def leaderboard_scores(spark, sf_dir):
    """Flagship: three families in both profiles, saved, reloaded and scored in one scan."""
    root = workspace(spark, "leaderboard")
    for profile in config.PROFILES:
        with _training_data(spark, sf_dir, profile) as (data, transform):
            n_rows = data.count()
            fitted = {
                "lr": _lr(profile, n_rows).fit(data),
                "rf": cells.fit(make_estimator("rf", profile), data),
                "gbt": cells.fit(make_estimator("gbt", profile), data),
            }
        model_files.save_overwriting(transform, model_files.feature_path(root, profile))
        for family, model in fitted.items():
            model_files.save_overwriting(model, model_files.model_path(root, profile, family))
    return evaluate_saved(_test(spark, sf_dir), root)


def leaderboard(spark, sf_dir):
    """The flagship's rows; ensembles are random by design, so only what must hold for them is given."""
    linear = F.col("model") == config.DISPLAY_NAMES["lr"]
    return leaderboard_scores(spark, sf_dir).select(
        "framework", "model",
        *[F.when(linear, F.round(c, 4)).alias(c) for c in ("accuracy", "roc_auc")],
        (F.col("roc_auc").between(0.6, 1.0) & F.col("accuracy").between(0.6, 1.0)).alias("plausible"),
    )


def timing_row(spark, sf_dir):
    """A timed fit and a timed prediction; the times themselves depend on the machine."""
    with _training_data(spark, sf_dir) as (data, transform):
        n_train = data.count()
        model, train_s = timing.timed_fit(make_estimator("lr", "benchmark"), data)
    with persisted(_test(spark, sf_dir, transform).select("label", "features")) as test:
        n_test = test.count()
        predict_s = timing.timed_predict(model, test)
    return spark.range(1).select(
        F.lit("native").alias("framework"),
        F.lit(config.DISPLAY_NAMES["lr"]).alias("model"),
        F.lit(n_train).cast("bigint").alias("n_train"),
        F.lit(n_test).cast("bigint").alias("n_test"),
        F.lit(train_s > 0).alias("train_timed"),
        F.lit(predict_s > 0).alias("predict_timed"),
        F.lit(cores_in_use(spark) > 0).alias("cores_known"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        fit_lr, fit_lr_exact, fit_rf, fit_gbt, fit_rf_exact, fit_gbt_exact, fit_benchmark_profile,
        fit_tree, fit_gbt_small, gbt_rounds,
        predict_batch, predict_proba, cv_results, cv_fold_results, grid_search_lr, grid_search_rf, grid_search_gbt,
        grid_search_stratified, search_lr, search_rf, search_gbt, search_subsampled,
        model_roundtrip, leaderboard, leaderboard_lr, timing_row,
    )
} | {"training_summary": training_summary_table}

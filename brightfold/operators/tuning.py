"""Candidate generation, cross-validation and search."""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from brightfold import config
from brightfold.operators import cells
from brightfold.operators.estimators import param_map, spark_params
from brightfold.operators.metrics import bounding_share, range_count, roc_auc, score_bounds
from brightfold.operators.scoring import score_models
from brightfold.operators.shared_fit import Fit, Task, blocks, fit_together, fold_moments, held_out_scores
from brightfold.session import cores_in_use

# Irrational steps of the candidate sequence for the first parameters; more are made by `steps`.
STEPS = (0.6180339887498949, 0.41421356237309515, 0.7320508075688772)
FOLD_SCORE_SCHEMA = "candidate int, fold int, auc double, fit_s double"


def param_grid(spark: SparkSession, grid: Mapping[str, Sequence[float]]) -> DataFrame:
    """One row per combination of the value lists, numbered in list order."""
    size = 1
    for values in grid.values():
        size *= len(values)
    candidates = spark.range(size, numPartitions=1).select(F.col("id").cast("int").alias("candidate"))
    repeat = size
    for name, values in grid.items():
        repeat //= len(values)
        index = (F.floor(F.col("candidate") / repeat) % len(values)).cast("int")
        listed = F.array(*[F.lit(float(v)) for v in values])
        candidates = candidates.withColumn(name, F.get(listed, index))
    return candidates


def steps(count: int) -> list[float]:
    """Irrational steps, one per parameter: beyond the given ones, fractions of square roots of further primes."""
    found, number = list(STEPS), 3
    while len(found) < count:
        number += 2
        if all(number % d for d in range(3, math.isqrt(number) + 1, 2)):
            found.append(math.sqrt(number) % 1.0)
    return found[:count]


def search_candidates(
    spark: SparkSession, space: Mapping[str, tuple], trials: int = config.TRIALS
) -> DataFrame:
    """Candidates spread evenly over typed ranges by an additive sequence."""
    candidates = spark.range(trials, numPartitions=1).select(F.col("id").cast("int").alias("candidate"))
    for (name, (kind, low, high)), step in zip(space.items(), steps(len(space))):
        position = (F.col("candidate") + 1).cast("double") * F.lit(step)
        u = position - F.floor(position)
        if kind == "int":
            value = F.lit(float(low)) + F.floor(u * F.lit(float(high - low + 1)))
        elif kind == "float":
            value = F.lit(float(low)) + u * F.lit(float(high - low))
        elif kind == "log_float":
            value = F.exp(F.ln(F.lit(float(low))) + u * F.ln(F.lit(float(high) / float(low))))
        else:
            raise ValueError(f"unknown range kind {kind!r}")
        candidates = candidates.withColumn(name, value.cast("double"))
    return candidates


def candidate_dicts(candidates: DataFrame) -> list[dict]:
    """Neutral parameters per candidate; the table is as small as the search."""
    rows = candidates.orderBy("candidate").collect()
    return [{k: v for k, v in row.asDict().items() if k != "candidate"} for row in rows]


def mean_scores(fold_scores: DataFrame) -> DataFrame:
    """Mean and deviation of the defined fold scores per candidate."""
    return fold_scores.groupBy("candidate").agg(
        F.avg("auc").alias("mean_auc"),
        F.stddev_pop("auc").alias("std_auc"),
        F.count("auc").alias("n_folds"),
    )


def candidate_results(candidates: DataFrame, fold_scores: DataFrame) -> DataFrame:
    """One row per scored candidate: parameters, mean score and its deviation, rank (1 is best, ties share), mean fit time.

    As many rows as candidates, so the rank's window is as small as the search.
    """
    means = mean_scores(fold_scores).join(
        fold_scores.groupBy("candidate").agg(F.avg("fit_s").alias("mean_fit_s")), "candidate")
    best_first = Window.partitionBy(F.lit(0)).orderBy(F.col("mean_auc").desc_nulls_last())
    ranked = means.withColumn("rank", F.rank().over(best_first))
    return candidates.join(F.broadcast(ranked), "candidate")


def best_candidate(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Highest mean score; ties go to the lowest candidate, NULL never wins over a score."""
    rank = F.struct(F.col("mean_auc"), (-F.col("candidate")).alias("order"))
    return scores.groupBy(*by).agg(
        F.max_by("candidate", rank).alias("candidate"), F.max("mean_auc").alias("mean_auc")
    )


def fold_sizes(df: DataFrame, folds: int, fold: str = "fold", label: str = config.LABEL) -> dict[int, int]:
    """Labelled rows of each fold; a row without one, or a fold that leaves nothing to train or to score, is refused."""
    known = F.when(F.col(fold).between(0, folds - 1), F.col(fold)).alias(fold)
    found = df.where(F.col(label).isNotNull()).groupBy(known).count().collect()
    sizes = {r[fold]: r["count"] for r in found}
    if None in sizes:
        raise ValueError(f"{sizes[None]} labelled rows have no fold from 0 to {folds - 1}")
    for held_out in range(folds):
        if not sizes.get(held_out) or len(sizes) < 2:
            raise ValueError(f"fold {held_out} leaves no training or no validation rows")
    return sizes


def cross_validate(
    df: DataFrame,
    estimator,
    maps_for: Callable[[int], list[dict]],
    candidates: Sequence[int],
    folds: int = config.FOLDS,
    fold: str = "fold",
    label: str = config.LABEL,
    parallelism: int = 2,
) -> list[tuple]:
    """(candidate, fold, auc, fit seconds) for each candidate on each held-out fold.

    Folds are predicates on a column of the (persisted) input, so no fold is
    copied; tree ensembles are fitted on counted cells (`cells`) where they can be.
    Fits run `parallelism` at a time across candidates and folds, and on cells, where a fit
    may be one task, as many as there are task slots; once
    the candidates of a fold are fitted, one scan of its held-out rows scores
    them all while the next fits run. Where fits are on cells, rows of one cell and label have
    one score, so the fold's cells are scored and count as many times as they have rows.
    `maps_for` gets the training rows of the fold and gives the parameter maps of the candidates.
    """
    inside = df.where(F.col(fold).between(0, folds - 1))
    sizes = fold_sizes(df, folds, fold, label)
    maps = [maps_for(sum(n for f, n in sizes.items() if f != held_out)) for held_out in range(folds)]
    turns = [(held_out, index) for held_out in range(folds) for index in range(len(candidates))]
    results, bounds = [], None
    with cells.kept_cells(inside, estimator, [fold], folds) as counted:

        def fit_one(turn):
            held_out, index = turn
            started, kept = time.perf_counter(), F.col(fold) != held_out
            chosen = estimator.copy(maps[held_out][index])
            if counted is None:
                model = chosen.fit(inside.where(kept))
            else:
                model = cells.fit_on_cells(
                    chosen, counted.training(chosen.getFeaturesCol(), kept, cells.kept_apart(chosen)))
            return index, model, time.perf_counter() - started

        at_once = parallelism if counted is None else max(parallelism, cores_in_use(df.sparkSession))
        with ThreadPool(max(1, min(at_once, len(turns)))) as pool:
            fitted = pool.imap(inheritable_thread_target(df.sparkSession)(fit_one), turns)
            for held_out in range(folds):
                done = {index: (model, seconds) for index, model, seconds in (next(fitted) for _ in candidates)}
                models = {(candidate,): done[i][0] for i, candidate in enumerate(candidates)}
                seconds = {candidate: done[i][1] for i, candidate in enumerate(candidates)}
                held, weight, kept = F.col(fold) == held_out, None, [label]
                if counted is None:
                    validation, n_rows = df.where(held), sizes[held_out]
                else:
                    validation = counted.training(estimator.getFeaturesCol(), held).where("n > 0")
                    n_rows, weight, kept = validation.count(), "n", [label, "n"]
                scores = score_models(validation, models, ["candidate"], kept)
                if bounds is None:
                    n_scores = n_rows * len(candidates)
                    buckets = range_count(df.sparkSession, n_scores)
                    looked_at = _share(validation, bounding_share(n_scores, buckets))
                    bounds = score_bounds(score_models(looked_at, models, ["candidate"], [label]), buckets=buckets)
                for row in roc_auc(scores, ["candidate"], label, bounds=bounds, weight=weight).collect():
                    results.append((row["candidate"], held_out, row["roc_auc"], seconds[row["candidate"]]))
    return results


def _share(df: DataFrame, share: float) -> DataFrame:
    """A share of the rows, to find bounds from before anything is scored."""
    return df if share == 1 else df.sample(share, config.SEED)


def shares_passes(estimator) -> bool:
    """Whether all candidates of an estimator can be fitted together: a binary, unweighted, L2 logistic regression."""
    if not isinstance(estimator, LogisticRegression):
        return False
    plain = estimator.getElasticNetParam() == 0 and estimator.getFitIntercept() and estimator.getFamily() in ("auto", "binomial")
    bounded = any(estimator.isSet(getattr(estimator, f"{side}BoundsOn{what}"))
                  for side in ("lower", "upper") for what in ("Coefficients", "Intercepts"))
    return plain and not estimator.isDefined(estimator.weightCol) and not bounded


def cross_validate_together(
    df: DataFrame,
    estimator: LogisticRegression,
    settings_for: Callable[[int], list[dict]],
    candidates: Sequence[int],
    folds: int = config.FOLDS,
    fold: str = "fold",
    label: str = config.LABEL,
) -> tuple[list[tuple], list[Fit], int]:
    """As `cross_validate`, with every candidate of every fold fitted in the same passes and scored in the same scan.

    `settings_for` gives the Spark parameters of the candidates. Also returns the fits,
    keyed (candidate, fold), and the number of passes over the training rows. A fit's
    seconds are its share of the passes it took part in.
    """
    sizes = fold_sizes(df, folds, fold, label)
    features = estimator.getFeaturesCol()
    rows = df.where(F.col(fold).between(0, folds - 1) & F.col(label).isNotNull()).select(features, label, fold)
    tasks = []
    for held_out in range(folds):
        settings = settings_for(sum(n for f, n in sizes.items() if f != held_out))
        for candidate, chosen in zip(candidates, settings):
            tasks.append(Task(
                (candidate, held_out), held_out, chosen.get("regParam", estimator.getRegParam()),
                estimator.getStandardization(), chosen.get("maxIter", estimator.getMaxIter()),
            ))
    data = blocks(rows, features, label, fold)
    try:
        found = fit_together(data, fold_moments(rows, features, label, fold), tasks)
    finally:
        data.unpersist()
    scores = held_out_scores(rows, found.fits, features, label, fold)
    n_scores = sum(sizes.values()) * len(candidates)
    buckets = range_count(df.sparkSession, n_scores)
    looked_at = _share(rows, bounding_share(n_scores, buckets))
    bounds = score_bounds(held_out_scores(looked_at, found.fits, features, label, fold), buckets=buckets)
    aucs = {r["model"]: r["roc_auc"] for r in roc_auc(scores, ["model"], label, bounds=bounds).collect()}
    results = [(*fit.task.key, aucs[i], fit.seconds) for i, fit in enumerate(found.fits)]
    return results, found.fits, found.passes


@dataclass
class SearchResult:
    family: str
    profile: str
    best_params: dict
    cv_score: float
    search_s: float
    refit_s: float
    model: object
    cv_results: DataFrame
    fold_scores: DataFrame
    #: Passes over the training rows that all fits of the search shared; None where every fit made its own.
    passes: int | None = None


def search(
    df: DataFrame,
    family: str,
    estimator,
    candidates: DataFrame,
    profile: str = "native",
    folds: int = config.FOLDS,
    fold: str = "fold",
    label: str = config.LABEL,
    parallelism: int = 2,
    time_budget_s: float | None = None,
    refit_df: DataFrame | None = None,
    refit_estimator=None,
) -> SearchResult:
    """Score every candidate by cross-validated ROC-AUC and refit the best on all rows.

    Logistic regressions on ready features share their passes (`shared_fit`); other
    estimators, and pipelines fitted inside the folds, are fitted one by one.

    With a time budget, candidates are scored one after the other and no new
    one starts once it is spent; the first always runs. `refit_df` refits on
    other rows than the search used, `refit_estimator` without the stages that
    only belong inside the folds.
    """
    spark = df.sparkSession
    params = candidate_dicts(candidates)
    stage = estimator.getStages()[-1] if hasattr(estimator, "getStages") else estimator
    started = time.perf_counter()
    chunks = [list(range(len(params)))] if time_budget_s is None else [[i] for i in range(len(params))]
    scored, passes = [], None
    for chunk in chunks:
        if scored and time_budget_s is not None and time.perf_counter() - started >= time_budget_s:
            break

        def settings_for(n_rows):
            return [spark_params(family, params[i], profile, n_rows) for i in chunk]

        if shares_passes(estimator):
            found, _, taken = cross_validate_together(df, estimator, settings_for, chunk, folds, fold, label)
            passes = taken + (passes or 0)
        else:
            found = cross_validate(
                df, estimator, lambda n: [param_map(stage, s) for s in settings_for(n)], chunk, folds, fold, label, parallelism)
        scored += found
    fold_scores = spark.createDataFrame(scored, FOLD_SCORE_SCHEMA)
    best = best_candidate(mean_scores(fold_scores)).head()
    search_s = time.perf_counter() - started

    started = time.perf_counter()
    rows = refit_df if refit_df is not None else df
    n_rows = rows.count() if family == "lr" and profile == "exact" else None
    chosen = params[best["candidate"]]
    final = refit_estimator or estimator
    model = cells.fit(final.copy(param_map(stage, spark_params(family, chosen, profile, n_rows))), rows)
    refit_s = time.perf_counter() - started
    return SearchResult(
        family, profile, chosen, best["mean_auc"], search_s, refit_s, model,
        candidate_results(candidates, fold_scores), fold_scores, passes,
    )


def summary_row(result: SearchResult) -> tuple:
    """Training summary row: score to 5 places, times to 2."""
    score = None if result.cv_score is None else round(result.cv_score, 5)
    return (
        result.profile,
        config.DISPLAY_NAMES[result.family],
        {k: float(v) for k, v in result.best_params.items()},
        score,
        round(result.search_s, 2),
        round(result.refit_s, 2),
        round(result.search_s + result.refit_s, 2),
    )

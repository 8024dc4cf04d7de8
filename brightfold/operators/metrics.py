"""Accuracy and exact ROC-AUC for many models, folds or candidates in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from brightfold import config

ROWS_A_RANGE = 500_000
#: Scores that a range's bounds are found from, for each range: enough to keep ranges within some percent of each other.
SCORES_A_BOUND = 5_000
#: Scores of up to so many rows are all looked at.
BOUNDED_ROWS = 1_000_000


def range_count(spark: SparkSession, n_rows: int) -> int:
    """Four ranges per shuffle partition, or as many as keep a range at half a million rows."""
    return max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), n_rows // ROWS_A_RANGE + 1)


def bounding_share(n_rows: int, buckets: int) -> float:
    """Share of so many rows whose scores suffice to cut all of them into about equal ranges."""
    return min(1.0, max(BOUNDED_ROWS, SCORES_A_BOUND * buckets) / max(1, n_rows))


def score_bounds(scores: DataFrame, score: str = "score", buckets: int | None = None) -> list[float]:
    """Scores that cut all rows into `buckets` about equal ranges (`range_count` of the rows by default).

    A score that fills ranges by itself is listed for each.

    Found from a share of the rows if there are many. Every row is ranked, wherever the
    bounds lie: they only say which task does it.
    """
    if buckets is None:
        n_rows = scores.count()
        buckets = range_count(scores.sparkSession, n_rows)
        share = bounding_share(n_rows, buckets)
        scores = scores if share == 1 else scores.sample(share, config.SEED)
    if buckets < 2:
        return []
    shares = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    accuracy = max(1_000, 4 * buckets)
    row = scores.agg(F.percentile_approx(score, shares, accuracy).alias("bounds")).head()
    return sorted(b for b in row["bounds"] or [] if abs(b) != float("inf"))


def classification_metrics(
    scores: DataFrame,
    by: Sequence[str] = (),
    label: str = config.LABEL,
    score: str = "score",
    prediction: str | None = "prediction",
    buckets: int | None = None,
    bounds: Sequence[float] | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Rows, accuracy and ROC-AUC (ties count half) per group.

    Rows collapse to one per distinct score before they are ranked, so tied
    scores never pile up. Ranking runs inside score ranges of about equal size,
    cut at literal bounds, and the ranges are joined up by their totals: no task
    sees more than some ranges of one group. Many ranges make as many partitions,
    dealt before rows collapse, so that neither counts nor a sort grow with the rows;
    scores that fill whole ranges, told by repeated bounds, collapse once by the partition
    that read them and then by range. AUC is NULL where a class is absent.
    Rows without a label or score are left out, and so are NaN scores (`dropped_rows`
    counts them). A label other than 0 and 1 fails the job.

    The bounds only balance the work. Those of similar scores (`score_bounds`)
    can be passed in, which saves the pass that finds them. A row counts as many times
    as `weight` says.
    """
    times = F.lit(1).cast("long") if weight is None else F.col(weight).cast("long")
    correct = F.lit(None).cast("long")
    if prediction is not None:
        correct = F.when(F.col(prediction) == F.col(label), times).otherwise(0).cast("long")
    rows = scores.where(
        F.col(label).isNotNull() & F.col(score).isNotNull() & ~F.isnan(score)
    ).select(
        *by,
        F.col(score).cast("double").alias("_score"),
        F.when(F.col(label) == 1, times).when(F.col(label) == 0, 0).otherwise(
            F.raise_error(F.lit("labels are 0 or 1")).cast("int")).cast("long").alias("_pos"),
        correct.alias("_correct"),
        times.alias("_times"),
    )
    if bounds is None:
        bounds = score_bounds(rows, "_score", buckets)
    ranged = rows.withColumn("_range", F.lit(0))
    if bounds:
        splits = [-float("inf"), *sorted(set(bounds)), float("inf")]
        found = Bucketizer(splits=splits, inputCol="_score", outputCol="_found").transform(rows)
        # As an integer key the range stays the partitioning of window and aggregate alike.
        ranged = found.withColumn("_range", F.col("_found").cast("int"))
    ones = [F.sum("_pos").alias("pos"), (F.sum("_times") - F.sum("_pos")).alias("neg"), F.sum("_correct").alias("correct")]
    keys = [*by, "_range"]
    if len(bounds) < range_count(scores.sparkSession, 0):
        per_score = ranged.groupBy(*keys, "_score").agg(*ones)
    elif not (tied := sorted({b for b, after in zip(bounds, bounds[1:]) if b == after})):
        per_score = ranged.repartition(len(bounds) + 1, *keys).groupBy(*keys, "_score").agg(*ones)
    else:
        salt = F.when(F.col("_score").isin(tied), F.spark_partition_id()).otherwise(-1)
        apart = ranged.withColumn("_salt", salt).repartition(len(bounds) + 1, *keys, "_salt")
        collapsed = apart.groupBy(*keys, "_salt", "_score").agg(*ones).repartition(len(bounds) + 1, *keys)
        per_score = collapsed.groupBy(*keys, "_score").agg(*[F.sum(c).alias(c) for c in ("pos", "neg", "correct")])
    up_to_here = (Window.unboundedPreceding, Window.currentRow)
    inside = Window.partitionBy(*by, "_range").orderBy("_score").rowsBetween(*up_to_here)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    neg_below = F.sum("neg").over(inside).cast("double") - neg
    per_range = (
        per_score.withColumn("_won", pos * (neg_below + neg / 2))
        .groupBy(*by, "_range")
        .agg(
            F.sum("pos").alias("pos"),
            F.sum("neg").alias("neg"),
            F.sum("_won").alias("_won"),
            F.sum("correct").alias("correct"),
        )
    )
    # One row per range from here on: at most `buckets` rows a group.
    across = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_range").rowsBetween(*up_to_here)
    below = F.sum("neg").over(across).cast("double") - neg
    totals = per_range.withColumn("_won", F.col("_won") + pos * below).groupBy(*by).agg(
        F.sum("_won").alias("_won"),
        F.sum("pos").alias("pos"),
        F.sum("neg").alias("neg"),
        F.sum("correct").alias("correct"),
    )
    n = F.col("pos") + F.col("neg")
    return totals.where(n > 0).select(
        *by,
        n.alias("n_rows"),
        (F.col("correct") / n).alias("accuracy"),
        F.when((pos > 0) & (neg > 0), F.col("_won") / (pos * neg)).alias("roc_auc"),
    )


def dropped_rows(
    scores: DataFrame, by: Sequence[str] = (), label: str = config.LABEL, score: str = "score"
) -> DataFrame:
    """Rows per group that the metrics leave out: no label, no score, or a NaN score."""
    missing = F.col(label).isNull() | F.col(score).isNull() | F.isnan(score)
    return scores.groupBy(*by).agg(F.count_if(missing).alias("n_dropped"))


def roc_auc(
    scores: DataFrame,
    by: Sequence[str] = (),
    label: str = config.LABEL,
    score: str = "score",
    buckets: int | None = None,
    bounds: Sequence[float] | None = None,
    weight: str | None = None,
) -> DataFrame:
    found = classification_metrics(scores, by, label, score, None, buckets, bounds, weight)
    return found.drop("n_rows", "accuracy")


def accuracy(
    scores: DataFrame,
    by: Sequence[str] = (),
    label: str = config.LABEL,
    prediction: str = "prediction",
) -> DataFrame:
    """Share of rows whose prediction equals the label."""
    hit = F.when(F.col(prediction) == F.col(label), 1.0).otherwise(0.0)
    return scores.where(F.col(label).isNotNull()).groupBy(*by).agg(F.avg(hit).alias("accuracy"))


def auc_evaluator(
    label: str = config.LABEL, raw: str = "rawPrediction", bins: int = 1000
) -> BinaryClassificationEvaluator:
    """Built-in evaluator; `bins=0` ranks every distinct score, 1000 approximates."""
    return BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=raw, metricName="areaUnderROC", numBins=bins
    )

"""Profiling: statistics, missing share, class balance, histograms, correlations."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import DataFrame, Window, functions as F, types as T

from brightfold import config
from brightfold.functions.expressions import is_missing, nan_to_null
from brightfold.operators.ranks import BRACKET_ROWS, RankHit, exact_quantiles, quantile_ranks
from brightfold.operators.wide_profile import Measured, WideProfile, first_scan

QUARTILES = (0.25, 0.5, 0.75)
#: Share of a sum of squares that rounding may leave of a variance of 0.
ROUNDING = 1e-12


STATISTICS = ["feature", "count", "mean", "std", "min", "q25", "q50", "q75", "max", "missing_pct"]


def summary_statistics(
    df: DataFrame,
    features: Sequence[str] = config.FEATURES,
    exact: bool = True,
    bracket_rows: int = BRACKET_ROWS,
) -> DataFrame:
    """One row per feature: count, mean, sample std, min, quartiles, max, missing share.

    Two scans without expanding a row: a profile of every column, then the values
    around the quartiles. Quartiles that aren't `exact` are approximate percentiles, in one scan.
    """
    if not exact:
        return _approximate_statistics(df, features)
    profile = first_scan(df, features)
    measured = profile.measure(quartile_ranks(profile), bracket_rows=bracket_rows)
    return statistics_table(profile, measured)


def quartile_ranks(profile: WideProfile) -> dict[int, list[int]]:
    """The ranks around the quartiles of every feature that has values."""
    sizes = {i: profile.total(i).n for i in range(len(profile.features))}
    return {i: [rank for p in QUARTILES for rank in quantile_ranks(n, p)] for i, n in sizes.items() if n}


def statistics_table(profile: WideProfile, measured: Measured) -> DataFrame:
    rows = []
    for i, name in enumerate(profile.features):
        m = profile.total(i)
        hits = {rank: RankHit(value, 0, 0) for (feature, rank), value in measured.values.items() if feature == i}
        quartiles = exact_quantiles(hits, m.n, QUARTILES) if m.n else [None] * len(QUARTILES)
        std = math.sqrt(m.m2 / (m.n - 1)) if m.n > 1 else None
        known = (m.mean, std, m.low) if m.n else (None, None, None)
        rows.append((name, m.n, *known, *quartiles, m.high if m.n else None, profile.missing_pct(i)))
    schema = T.StructType([
        T.StructField("feature", T.StringType()),
        T.StructField("count", T.LongType()),
        *[T.StructField(c, T.DoubleType()) for c in STATISTICS[2:]],
    ])
    return profile.df.sparkSession.createDataFrame(rows, schema)


def _approximate_statistics(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """One wide aggregate; its single row is turned into one per feature."""
    columns = []
    for i, c in enumerate(features):
        x = nan_to_null(F.col(c).cast("double"))
        columns.append(F.struct(
            F.lit(c).alias("feature"), F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
            F.min(x).alias("min"), F.percentile_approx(x, F.array(*map(F.lit, QUARTILES)), 10_000).alias("q"), F.max(x).alias("max"),
            (F.lit(100.0) * F.avg(F.when(x.isNull(), 1.0).otherwise(0.0))).alias("missing_pct"),
        ).alias(f"_{i}"))
    wide = df.agg(*columns)
    rows = wide.select(F.inline(F.array(*wide.columns)))
    quartiles = {name: F.get("q", F.lit(i)) for i, name in enumerate(STATISTICS[5:8])}
    return rows.withColumns(quartiles).select(*STATISTICS)


def missing_pct(df: DataFrame, features: Sequence[str] = config.FEATURES) -> DataFrame:
    """Share of NULL or NaN cells per feature, in percent: one aggregate, no expansion."""
    shares = df.agg(*[
        (F.lit(100.0) * F.avg(F.when(is_missing(F.col(c).cast("double")), 1.0).otherwise(0.0))).alias(c)
        for c in features
    ])
    return shares.unpivot([], list(features), "feature", "missing_pct")


def class_balance(df: DataFrame, label: str = config.LABEL) -> DataFrame:
    """Rows and share per label, in label order."""
    counts = df.groupBy(label).agg(F.count("*").alias("n_rows"))
    total = F.sum("n_rows").over(Window.partitionBy(F.lit(0)))
    return counts.withColumn("share", F.col("n_rows") / total).orderBy(label)


def class_histogram(
    df: DataFrame,
    features: Sequence[str] = config.FEATURES,
    label: str = config.LABEL,
    bins: int = 50,
    shared_edges: bool = False,
) -> DataFrame:
    """Density histogram per (feature, class), empty bins included.

    Edges run over each class's own range, or over the range of both with
    `shared_edges`. Infinite values have no bin and count as missing. Labels other than
    0 and 1 are left out. Two scans without expanding a row: ranges, then counts.
    """
    profile = first_scan(df, features, label)
    ranges = histogram_ranges(profile, shared_edges)
    measured = profile.measure(bins=bins, ranges=ranges)
    return histogram_table(profile, measured, ranges, bins)


def histogram_ranges(profile: WideProfile, shared_edges: bool = False) -> dict[tuple[int, int], tuple[float, float]]:
    """Finite range of each (feature, class) that has finite values."""
    own = {at: (m.finite_low, m.finite_high) for at, m in profile.moments.items() if at[1] in (0, 1) and m.finite}
    if not shared_edges:
        return own
    return {(i, c): (min(own[s][0] for s in ((i, 0), (i, 1)) if s in own), max(own[s][1] for s in ((i, 0), (i, 1)) if s in own))
            for i, c in own}


def histogram_table(profile: WideProfile, measured: Measured, ranges: Mapping, bins: int) -> DataFrame:
    label = profile.label
    rows = []
    for (i, c), (low, high) in sorted(ranges.items()):
        # A constant range is widened by half a unit on either side.
        start, width = (low - 0.5, 1.0 / bins) if low == high else (low, (high - low) / bins)
        n = profile.moments[i, c].finite
        for b in range(bins):
            inside = measured.bins.get((i, c, b), 0)
            rows.append((profile.features[i], c, b, start + b * width, start + (b + 1) * width, inside, inside / (n * width)))
    kind = profile.df.schema[label].dataType.simpleString()
    schema = f"feature string, {label} int, bin int, left_edge double, right_edge double, n_rows long, density double"
    table = profile.df.sparkSession.createDataFrame(rows, schema)
    return table.withColumn(label, F.col(label).cast(kind))


def correlation_matrix(df: DataFrame, features: Sequence[str] = config.FEATURES) -> DataFrame:
    """Pearson correlations in long form, for inputs without missing values.

    The matrix comes from one distributed product over assembled vectors; only
    its features x features result reaches the driver. A constant feature
    correlates as NULL.
    """
    vectors = VectorAssembler(inputCols=list(features), outputCol="_vector").transform(df)
    vectors = vectors.select("_vector")
    matrix = Correlation.corr(vectors, "_vector", "pearson").head()[0].toArray()
    if np.isnan(matrix).any():
        variance = vectors.select(Summarizer.variance(F.col("_vector"))).head()[0].toArray()
        matrix[np.diag(variance == 0.0)] = np.nan
    rows = [
        (a, b, None if np.isnan(matrix[i, j]) else float(matrix[i, j]))
        for i, a in enumerate(features)
        for j, b in enumerate(features)
    ]
    return df.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, r double")


def correlation_pairwise(df: DataFrame, features: Sequence[str] = config.FEATURES) -> DataFrame:
    """Pearson correlations over the rows where both values are present.

    Two scans: the column means, then one distributed product of the centred values,
    their squares and the marks of present cells, missing ones being 0. It holds count,
    sums, squares and cross sums of every pair of columns; only that matrix, three times
    the features wide, reaches the driver. A column constant over a pair's rows (within
    rounding) correlates as NULL.
    """
    profile = first_scan(df, features)
    return correlation_table(profile, profile.measure(correlate=True))


def correlation_table(profile: WideProfile, measured: Measured) -> DataFrame:
    gram, features, p = measured.gram, profile.features, len(profile.features)
    cross, sums, squares, n = gram[:p, :p], gram[:p, 2 * p:], gram[p:2 * p, 2 * p:], gram[2 * p:, 2 * p:]
    with np.errstate(divide="ignore", invalid="ignore"):
        mean = sums / n
        variance = squares / n - mean * mean
        r = (cross / n - mean * mean.T) / np.sqrt(variance * variance.T)
        constant = ~(variance > ROUNDING * squares / n) & ~np.isnan(variance) | (n == 0)
    r[np.diag_indices(p)] = np.where(np.isnan(np.diag(variance)), np.nan, 1.0)
    undefined = constant | constant.T
    found = [
        (a, b, None if undefined[i, j] else float(r[i, j]))
        for i, a in enumerate(features)
        for j, b in enumerate(features)
    ]
    return profile.df.sparkSession.createDataFrame(found, "feature_a string, feature_b string, r double")

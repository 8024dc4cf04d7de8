"""Exploratory profile of a labelled table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from brightfold import config
from brightfold.operators import profile
from brightfold.operators.wide_profile import first_scan
from brightfold.sources.results import write_csv


def explore(
    df: DataFrame,
    groups: Mapping[str, Sequence[str]] = config.FEATURE_GROUPS,
    label: str = config.LABEL,
    out: str | None = None,
    exact: bool = True,
    bins: int = 50,
    bracket_rows: int = profile.BRACKET_ROWS,
) -> dict[str, DataFrame]:
    """Statistics, class balance, class histograms per feature group, correlations.

    Three scans of the input for all four tables: classes, a profile of every column, and
    all that builds on it (`wide_profile`). Each table is small whatever the size of the
    input. Columns with missing values correlate over the complete pairs. Statistics that
    aren't `exact` come from a scan of their own. With `out`, tables are written there as CSV.
    """
    features = [c for columns in groups.values() for c in columns]
    group = F.coalesce(*[
        F.when(F.col("feature").isin(*columns), F.lit(name)) for name, columns in groups.items()
    ])
    found = first_scan(df, features, label)
    ranges = profile.histogram_ranges(found)
    measured = found.measure(
        profile.quartile_ranks(found) if exact else None, bins, ranges, correlate=True, bracket_rows=bracket_rows)
    tables = {
        "summary_statistics": profile.statistics_table(found, measured) if exact
        else profile.summary_statistics(df, features, exact=False),
        "class_balance": profile.class_balance(df, label),
        "distributions": profile.histogram_table(found, measured, ranges, bins).withColumn("feature_group", group),
        "correlation": profile.correlation_table(found, measured),
    }
    if out is not None:
        for name, frame in tables.items():
            write_csv(frame, f"{out}/{name}")
    return tables

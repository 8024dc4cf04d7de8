import math

import numpy as np
import pandas as pd
import pytest

from brightfold.operators import profile, projections

NAN = math.nan


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(7)
    n = 400
    return pd.DataFrame({
        "label": (np.arange(n) % 3 == 0).astype(int),
        "a": rng.normal(size=n),
        "b": rng.integers(0, 4, n).astype(float),
        "c": np.where(np.arange(n) % 5 == 0, NAN, rng.exponential(size=n)),
        "k": np.full(n, 2.5),
    })


@pytest.fixture(scope="module")
def df(spark, data):
    """The NaN cells arrive as NaN in even rows and as NULL in odd ones."""
    rows = [
        tuple(None if isinstance(v, float) and math.isnan(v) and i % 2 else v for v in row)
        for i, row in enumerate(data.itertuples(index=False))
    ]
    return spark.createDataFrame(rows, "label int, a double, b double, c double, k double").repartition(3)


FEATURES = ["a", "b", "c", "k"]


@pytest.mark.parametrize("limit", [5, 1_000_000])
def test_summary_equals_pandas(df, data, limit):
    ours = profile.summary_statistics(df, FEATURES, bracket_rows=limit).toPandas().set_index("feature")
    theirs = data[FEATURES].describe().T
    renamed = {"25%": "q25", "50%": "q50", "75%": "q75"}
    for column in theirs.columns:
        np.testing.assert_allclose(
            ours.loc[FEATURES, renamed.get(column, column)], theirs[column], rtol=1e-9, atol=1e-12)
    np.testing.assert_allclose(ours.loc[FEATURES, "missing_pct"], data[FEATURES].isnull().mean() * 100)


def test_approximate_summary_has_the_same_columns(df):
    exact = profile.summary_statistics(df, FEATURES)
    quick = profile.summary_statistics(df, FEATURES, exact=False)
    assert quick.columns == exact.columns and quick.count() == 4


def test_feature_without_values(spark):
    df = spark.createDataFrame([(None, 1.0), (NAN, 2.0)], "x double, y double")
    row = profile.summary_statistics(df, ["x", "y"]).where("feature = 'x'").head()
    assert row["count"] == 0 and row["mean"] is None and row["q50"] is None and row["missing_pct"] == 100.0
    assert dict(profile.missing_pct(df, ["x", "y"]).collect()) == {"x": 100.0, "y": 0.0}


def test_class_balance(df):
    assert [tuple(r)[:2] for r in profile.class_balance(df).collect()] == [(0, 266), (1, 134)]


@pytest.mark.parametrize("shared", [False, True])
def test_histogram_equals_numpy(df, data, shared):
    ours = profile.class_histogram(df, FEATURES, shared_edges=shared).toPandas()
    assert len(ours) == 4 * 2 * 50
    for feature in FEATURES:
        for label in (0, 1):
            values = data.loc[data.label == label, feature].dropna()
            both = data[feature].dropna()
            span = (both.min(), both.max()) if shared else None
            density, edges = np.histogram(values, bins=50, density=True, range=span)
            found = ours[(ours.feature == feature) & (ours.label == label)].sort_values("bin")
            np.testing.assert_allclose(found.density, density, atol=1e-9)
            np.testing.assert_allclose(found.left_edge, edges[:-1], atol=1e-9)
            np.testing.assert_allclose(found.right_edge, edges[1:], atol=1e-9)


def square(frame):
    return frame.toPandas().pivot(index="feature_a", columns="feature_b", values="r")


def test_pairwise_correlation_equals_pandas(df, data):
    ours = square(profile.correlation_pairwise(df, FEATURES)).loc[FEATURES, FEATURES]
    np.testing.assert_allclose(ours.astype(float), data[FEATURES].corr(), atol=1e-9)


def test_vector_correlation(df, data):
    complete = ["a", "b", "k"]
    ours = square(profile.correlation_matrix(df, complete)).loc[complete, complete]
    np.testing.assert_allclose(ours.astype(float), data[complete].corr(), atol=1e-9)


def test_pair_without_common_rows(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (None, 3.0), (None, 4.0)], "x double, y double")
    ours = square(profile.correlation_pairwise(df, ["x", "y"]))
    assert ours.loc["x", "x"] == 1.0 and math.isnan(ours.loc["x", "y"])


def test_groups_and_long_form(df):
    groups = {"low_level": ["a", "b"], "high_level": ["c"]}
    assert projections.feature_group(df, "low_level", groups).columns == ["a", "b"]
    assert projections.feature_group(df, "low_level", groups, ["k"]).columns == ["k"]
    with pytest.raises(ValueError):
        projections.feature_group(df, "middle", groups)
    counts = projections.grouped_long(df, groups).groupBy("feature_group").count().collect()
    assert {tuple(r) for r in counts} == {("low_level", 800), ("high_level", 400)}
    assert projections.one_class(df, 1).count() == 134

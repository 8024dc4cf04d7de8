import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from brightfold.operators import ranks
from brightfold.operators.ranks import RankHit, RankResult, order_statistics


def frame(spark, groups, partitions=3):
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    random.Random(5).shuffle(rows)
    return spark.createDataFrame(rows, "g string, v double").repartition(partitions)


def per_group(wanted):
    return lambda sizes: {g: wanted(g, n) for g, n in sizes.items()}


def check(found, groups, wanted):
    for g, values in groups.items():
        ordered = sorted(values)
        assert found.sizes[g] == len(ordered)
        for rank in wanted(g, len(ordered)):
            v = ordered[rank]
            assert found.hits[g][rank] == RankHit(v, ordered.index(v), ordered.count(v)), (g, rank)


def spaced(_, n):
    return sorted({0, n // 4, n // 3, n // 2, n - 1})


GROUPS = {
    "continuous": [random.Random(1).gauss(0, 1) for _ in range(5000)],
    "third is one value": [7.0] * 2000 + [random.Random(2).uniform(0, 20) for _ in range(4000)],
    "two heavy values": [1.0] * 3000 + [2.0] * 3000 + [1 + i / 200 for i in range(200)],
    "heavy tail": [random.Random(3).paretovariate(0.3) for _ in range(5000)],
    "constant": [4.0] * 50,
    "single": [9.5],
    "negative": [-float(i) for i in range(1000)],
}


@pytest.mark.parametrize("limit", [10, 200, 1_000_000])
def test_ranks_equal_sorting(spark, limit):
    found = order_statistics(frame(spark, GROUPS), "g", "v", per_group(spaced), bracket_rows=limit)
    check(found, GROUPS, spaced)


def test_probing_elsewhere_still_finds_the_rank(spark):
    found = order_statistics(frame(spark, GROUPS), "g", "v", per_group(spaced), near=[0.99], bracket_rows=50)
    check(found, GROUPS, spaced)


def test_brackets_that_miss_are_widened(spark):
    values = [float(i) for i in range(500)]
    df = frame(spark, {"a": values})
    for limit in (5, 1000):
        result = RankResult({"a": 500}, {"a": {}}, {"a": {}})
        brackets = {("a", 400): (3.0, 9.0), ("a", 10): (100.0, 120.0)}
        inside = {key: 7 for key in brackets}
        spans = {"a": (0.0, 499.0)}
        ranks._resolve(df, "g", ranks.F.col("v"), brackets, inside, spans, result, limit)
        assert result.hits["a"] == {400: RankHit(400.0, 400, 1), 10: RankHit(10.0, 10, 1)}


def test_nulls_left_out_and_bad_rank_refused(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), (None, 3.0), ("b", None)], "g string, v double")
    found = order_statistics(df, "g", "v", per_group(lambda g, n: [n - 1]))
    assert found.sizes == {"a": 1, "b": 0} and found.hits["a"][0].value == 1.0
    with pytest.raises(ValueError):
        order_statistics(df, "g", "v", per_group(lambda g, n: [n]))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-5, 5) | st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=60))
def test_any_values(spark, values):
    groups = {"a": [float(v) + 0.0 for v in values]}
    every = lambda _, n: range(n)
    check(order_statistics(frame(spark, groups, 2), "g", "v", per_group(every), bracket_rows=3), groups, every)

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from brightfold.functions.expressions import HASH_MODULUS, key_hash, row_hash
from brightfold.operators import split


def rows(spark, n=600, copies=300, partitions=5):
    data = [(i, i % 7, int(i % 3 == 0)) for i in range(n)] + [(1_000, 1, 1)] * copies
    random.Random(4).shuffle(data)
    return spark.createDataFrame(data, "k int, x int, label int").repartition(partitions)


def assigned(df, out):
    return Counter(tuple(r) for r in df.select("k", "x", "label", out).collect())


def sizes(df, out):
    found = Counter((r["label"], r[out]) for r in df.collect())
    return {label: sorted(n for (l, _), n in found.items() if l == label) for label in (0, 1)}


def test_hash_range_and_repeatability(spark):
    df = spark.range(1000).select(key_hash(["id"], 3).alias("h"), row_hash(["id"], 3).alias("r"))
    low, high = df.agg(F.min(F.least("h", "r")), F.max(F.greatest("h", "r"))).head()
    assert low >= 0 and high < HASH_MODULUS
    assert df.collect() == df.collect()
    with pytest.raises(ValueError):
        key_hash([])


KEYS = {
    "hash": lambda: key_hash(["k"], 1),
    "colliding": lambda: key_hash(["k"], 1) % 10,
    "constant": lambda: F.lit(0),
    "row hash": lambda: row_hash(["k", "x"]),
}


@pytest.mark.parametrize("key", list(KEYS))
def test_stratified_folds_are_balanced_and_whole(spark, key):
    """Also with colliding hashes, a constant hash, and a third of the rows equal."""
    df = rows(spark)
    folded = split.stratified_kfold(df, KEYS[key](), ["k"], 5)
    assert sum(assigned(folded, "fold").values()) == 900
    assert Counter(tuple(r) for r in folded.select(*df.columns).collect()) == Counter(
        tuple(r) for r in df.collect()
    )
    for per_fold in sizes(folded, "fold").values():
        assert len(per_fold) == 5 and per_fold[-1] - per_fold[0] <= 1


def test_assignment_does_not_depend_on_partitioning(spark):
    a = split.stratified_kfold(rows(spark, partitions=2), key_hash(["k"]) % 50, ["k"], 3)
    b = split.stratified_kfold(rows(spark, partitions=7), key_hash(["k"]) % 50, ["k"], 3)
    assert assigned(a, "fold") == assigned(b, "fold")


def test_folds_follow_hash_then_tie_order(spark):
    df = rows(spark, copies=0)
    folded = split.stratified_kfold(df, key_hash(["k"], 9) % 13, ["k"], 4)
    for label in (0, 1):
        found = folded.where(F.col("label") == label).select(
            (key_hash(["k"], 9) % 13).alias("h"), "k", "fold").orderBy("h", "k").collect()
        n = len(found)
        expected = [f for f in range(4) for _ in range(n // 4 + (f < n % 4))]
        assert [r["fold"] for r in found] == expected


def test_more_folds_than_rows(spark):
    df = spark.createDataFrame([(1, 1, 1), (2, 1, 1), (3, 1, 0)], "k int, x int, label int")
    assert sizes(split.stratified_kfold(df, key_hash(["k"]), ["k"], 5), "fold") == {0: [1], 1: [1, 1]}


@pytest.mark.parametrize("n", [0, 7, 450, 899, 5000])
def test_sample_has_exactly_the_rows_asked_for(spark, n):
    df = rows(spark)
    sample = split.stratified_sample(df, n, key_hash(["k"]), ["k"]).collect()
    assert len(sample) == min(n, 900)
    all_rows = Counter(tuple(r) for r in df.collect())
    assert not Counter(tuple(r) for r in sample) - all_rows
    positives = sum(r["label"] for r in sample)
    assert abs(positives - min(n, 900) * 500 / 900) < 1


def test_quotas_by_largest_remainder():
    assert split.sample_quotas({0: 5, 1: 5}, 3) == {0: 2, 1: 1}
    assert split.sample_quotas({0: 10, 1: 1}, 5) == {0: 5, 1: 0}
    assert split.sample_quotas({0: 2, 1: 1}, 10) == {0: 2, 1: 1}


def test_random_split_is_disjoint_complete_and_weighted(spark):
    df = spark.range(20000)
    parts = split.random_split(df, key_hash(["id"], 42), [3, 1, 1])
    counts = {r["part"]: r["count"] for r in parts.groupBy("part").count().collect()}
    assert sum(counts.values()) == 20000 and sorted(counts) == [0, 1, 2]
    assert abs(counts[0] - 12000) < 600
    other = split.random_split(df, key_hash(["id"], 43), [3, 1, 1])
    assert parts.exceptAll(other).count() > 0


def test_complements(spark):
    df = spark.createDataFrame(
        [(1, 0), (1, 0), (2, 1), (2, 0), (3, 1), (None, 0), (None, 1), (4, 2)], "x int, fold int")
    keep = split.fold_complement(df, 1)
    assert sorted(r["x"] or 0 for r in keep.collect()) == [0, 1, 1, 2, 4]
    distinct = split.fold_complement_distinct(df, 1, ["x"])
    expected = df.where("fold <> 1").select("x").subtract(df.where("fold = 1").select("x"))
    assert sorted(distinct.collect()) == sorted(expected.collect()) == [(1,), (4,)]
    again = split.except_distinct(df.select("x"), df.where("fold = 1").select("x"))
    assert sorted(again.collect()) == [(1,), (4,)]


def test_hash_sample_is_a_filter(spark):
    df = rows(spark, n=9000, copies=0)
    sample = split.stratified_sample_hash(df, {0: 0.5, 1: 0.1}, key_hash(["k"]))
    counts = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    assert abs(counts[0] - 3000) < 200 and abs(counts[1] - 300) < 80
    lazy = split.stratified_sample_hash(
        spark.range(100).withColumn("label", (F.col("id") % 2).cast("int")), {0: 0.5, 1: 0.1}, key_hash(["id"])
    )
    assert "Exchange" not in lazy._jdf.queryExecution().executedPlan().toString()


def test_unorderable_columns_are_refused_only_where_rows_tie(spark):
    df = spark.createDataFrame([(i, i % 2, [float(i)]) for i in range(40)], "k int, label int, v array<double>")
    assert split.stratified_kfold(df, F.col("k"), ["k"], 4).count() == 40
    with pytest.raises(ValueError, match="cannot be ordered"):
        split.stratified_kfold(df, F.lit(1), ["k"], 4)


def odd_keys(spark):
    """Negative, NULL and 64-bit keys, in both classes."""
    key = F.when(F.col("id") % 5 == 0, F.lit(None)).when(F.col("id") % 2 == 0, -F.col("id")).otherwise(
        F.col("id") * 4_000_000_000_000_000 % 9_000_000_000_000_000_000)
    return spark.range(100).select(key.cast("long").alias("k"), "id", (F.col("id") % 4 == 0).cast("int").alias("label"))


def test_any_key_has_a_fold_and_a_part(spark):
    df = odd_keys(spark)
    for made in (split.kfold(df, F.col("k"), 5), split.kfold(df, key_hash(["k"]), 5)):
        assert made.where("fold is null or fold not between 0 and 4").count() == 0
    parts = split.random_split(df, -key_hash(["k", "id"]), [1, 1])
    assert {r["part"] for r in parts.collect()} == {0, 1}
    assert key_hash(["k"] * 8) is not None


@pytest.mark.parametrize("make", [lambda: key_hash(["k"]), lambda: F.col("k") % 1000], ids=["hash", "raw"])
def test_samples_and_strata_keep_their_sizes_with_odd_keys(spark, make):
    df, key = odd_keys(spark), make()
    assert split.stratified_sample(df, 20, key, ["id"]).count() == 20
    folded = split.stratified_kfold(df, key, ["id"], 5)
    assert sizes(folded, "fold") == {0: [15] * 5, 1: [5] * 5}


@pytest.mark.parametrize("search_rows,refit_rows", [(40, 90), (90, 40), (None, 30), (30, None), (500, 500), (1, 2)])
def test_nested_samples_are_ranges_of_one_order(spark, search_rows, refit_rows):
    rows = [(i % 3 % 2, (i * 7919) % 101 % 13, i) for i in range(200)]
    df = spark.createDataFrame(rows, "label int, h int, id int").repartition(3)
    got = split.nested_samples(df, search_rows, refit_rows, 3, F.col("h"), ["id"], bracket_rows=7).collect()
    for c in (0, 1):
        side = sorted((r for r in got if r["label"] == c), key=lambda r: (r["h"], r["id"]))
        sizes = {0: sum(r[0] == 0 for r in rows), 1: sum(r[0] == 1 for r in rows)}
        searched, refitted = (split.sample_quotas(sizes, 200 if n is None else n)[c] for n in (search_rows, refit_rows))
        assert [r["in_refit"] for r in side] == [i < refitted for i in range(len(side))]
        folds = [r["fold"] for r in side]
        assert folds[searched:] == [None] * (len(side) - searched) and folds[:searched] == sorted(folds[:searched])
        counts = [folds.count(f) for f in range(3)]
        assert sum(counts) == searched and max(counts) - min(counts) <= 1

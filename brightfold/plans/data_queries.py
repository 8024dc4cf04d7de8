"""Registered queries: scans, projections, profiling, splits and scaling."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from brightfold.functions.expressions import as_label
from brightfold.operators import features as feat, profile, projections, split
from brightfold.plans.inputs import (
    FEATURES,
    GROUPS,
    KEYS,
    base,
    line_hash,
    table,
)
from brightfold.session import workspace
from brightfold.sources import results, tables


def scan_labelled(spark, sf_dir):
    return tables.apply_null_policy(base(spark, sf_dir), [*FEATURES, "label"], "error")


def label_cast(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", as_label(F.col("value")).alias("label"))


def row_count(spark, sf_dir):
    """Rows of the base table, counted while it is stored: the count costs no scan of its own."""
    _, counted = tables.load_counted(spark, lambda session: base(session, sf_dir))
    return spark.range(1).select(F.lit(counted["n_rows"]).cast("bigint").alias("n_rows"))


def split_train_test(spark, sf_dir):
    rows = base(spark, sf_dir)
    sides = [
        tables.choose_split(rows, side).select(F.lit(side).alias("side"), *KEYS, "label")
        for side in ("train", "test")
    ]
    return sides[0].unionByName(sides[1])


def project_features(spark, sf_dir):
    return projections.project(base(spark, sf_dir), FEATURES, keys=KEYS)


def feature_groups(spark, sf_dir):
    return projections.grouped_long(base(spark, sf_dir), GROUPS, KEYS)


def class_filter(spark, sf_dir):
    rows = base(spark, sf_dir)
    signal = projections.one_class(rows, 1).select(F.lit("signal").alias("kind"), *KEYS)
    background = projections.one_class(rows, 0).select(F.lit("background").alias("kind"), *KEYS)
    return signal.unionByName(background)


def _rounded(df, digits, *columns):
    return df.withColumns({c: F.round(c, digits) for c in columns})


STATISTICS = ["mean", "std", "min", "q25", "q50", "q75", "max", "missing_pct"]


def summary_statistics(spark, sf_dir):
    rows = base(spark, sf_dir).withColumn("l_tax", F.nullif("l_tax", F.lit(0.0)))
    return _rounded(profile.summary_statistics(rows, FEATURES), 4, *STATISTICS)


def missing_pct(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("l_tax", F.nullif("l_tax", F.lit(0.0)))
    return _rounded(profile.missing_pct(rows, FEATURES), 4, "missing_pct")


def missing_pct_left_join(spark, sf_dir):
    joined = table(spark, sf_dir, "documents").select("doc_id").join(
        table(spark, sf_dir, "labels"), "doc_id", "left"
    )
    return _rounded(profile.missing_pct(joined, ["quality", "toxic"]), 4, "missing_pct")


def class_balance(spark, sf_dir):
    return _rounded(profile.class_balance(base(spark, sf_dir)), 6, "share")


def _histogram(spark, sf_dir, shared_edges):
    rows = profile.class_histogram(base(spark, sf_dir), FEATURES, shared_edges=shared_edges)
    return _rounded(_rounded(rows, 6, "left_edge", "right_edge"), 8, "density")


def histogram_by_class(spark, sf_dir):
    return _histogram(spark, sf_dir, False)


def histogram_shared_edges(spark, sf_dir):
    return _histogram(spark, sf_dir, True)


def correlation_matrix(spark, sf_dir):
    return _rounded(profile.correlation_matrix(base(spark, sf_dir), FEATURES), 6, "r")


def correlation_pairwise(spark, sf_dir):
    rows = base(spark, sf_dir).withColumn("l_tax", F.nullif("l_tax", F.lit(0.0)))
    return _rounded(profile.correlation_pairwise(rows, FEATURES), 6, "r")


def kfold_assign(spark, sf_dir):
    return split.kfold(base(spark, sf_dir).drop("fold"), line_hash(42)).select(*KEYS, "label", "fold")


def stratified_kfold_assign(spark, sf_dir):
    rows = base(spark, sf_dir).select(*KEYS, *FEATURES, "label")
    return split.stratified_kfold(rows, line_hash(42), KEYS).select(*KEYS, "label", "fold")


def stratified_sample(spark, sf_dir):
    rows = base(spark, sf_dir).select(*KEYS, *FEATURES, "label")
    n_rows = rows.count() * 3 // 10
    return split.stratified_sample(rows, n_rows, line_hash(42), KEYS).select(*KEYS, "label")


def stratified_sample_hash(spark, sf_dir):
    rows = base(spark, sf_dir).select(*KEYS, "label")
    return split.stratified_sample_hash(rows, {0: 0.25, 1: 0.5}, line_hash(7))


def random_split(spark, sf_dir):
    return split.random_split(base(spark, sf_dir).select(*KEYS), line_hash(42), [3.0, 1.0, 1.0])


def fold_complement(spark, sf_dir):
    return split.fold_complement(base(spark, sf_dir), 1).select(*KEYS, "fold")


def fold_complement_distinct(spark, sf_dir):
    """Distinct whole rows outside a fold."""
    return split.fold_complement_distinct(base(spark, sf_dir), 1, [*KEYS, *FEATURES, "label"])


COARSE = ["l_quantity", "l_discount", "l_tax", "label"]


def except_distinct(spark, sf_dir):
    """Columns of few values, so that most rows of the fold occur outside it as well."""
    rows = base(spark, sf_dir)
    held_out = rows.where(F.col("fold") == 1).select(*COARSE)
    return split.except_distinct(rows.select(*COARSE), held_out)


def vector_assemble(spark, sf_dir):
    vectors = feat.assemble(base(spark, sf_dir), FEATURES, "vector").select(*KEYS, "vector")
    return feat.unpack(vectors, "vector", [f"v{i}" for i in range(len(FEATURES))])


def vector_from_array(spark, sf_dir):
    vectors = feat.assemble_array(table(spark, sf_dir, "embeddings"), "embedding", "vector")
    values = vector_to_array("vector")
    total = F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v * v)
    return vectors.select(
        "vec_id",
        F.size(values).alias("n_dims"),
        F.round(F.sqrt(total), 5).alias("norm"),
        F.round(values[0], 6).alias("first_value"),
    )


def _scaled(spark, sf_dir, profile_name, fit_on, apply_to):
    fitted = feat.feature_stages(FEATURES, profile_name).fit(fit_on)
    names = [f"z_{c}" for c in FEATURES]
    vectors = fitted.transform(apply_to).select(*KEYS, "features")
    return _rounded(feat.unpack(vectors, "features", names), 6, *names)


def standard_scale_sample(spark, sf_dir):
    rows = base(spark, sf_dir)
    return _scaled(spark, sf_dir, "native", rows, rows)


def standard_scale_population(spark, sf_dir):
    rows = base(spark, sf_dir)
    return _scaled(spark, sf_dir, "exact", rows, rows)


def scale_train_to_test(spark, sf_dir):
    rows = base(spark, sf_dir)
    return _scaled(
        spark, sf_dir, "native", tables.choose_split(rows, "train"), tables.choose_split(rows, "test")
    )


def csv_sink_roundtrip(spark, sf_dir):
    """The labelled table as headerless CSV, written and read back under the fixed schema."""
    path = workspace(spark, "labelled_csv")
    results.write_csv(base(spark, sf_dir).select("label", *FEATURES), path, header=False)
    return tables.read_labelled_csv(spark, path, FEATURES)


QUERIES = {
    f.__name__: f
    for f in (
        scan_labelled, label_cast, row_count, split_train_test, project_features, feature_groups,
        class_filter, summary_statistics, missing_pct, missing_pct_left_join, class_balance,
        histogram_by_class, histogram_shared_edges, correlation_matrix, correlation_pairwise,
        kfold_assign, stratified_kfold_assign, stratified_sample, stratified_sample_hash,
        random_split, fold_complement, fold_complement_distinct, except_distinct, vector_assemble,
        vector_from_array, standard_scale_sample, standard_scale_population, scale_train_to_test,
        csv_sink_roundtrip,
    )
}

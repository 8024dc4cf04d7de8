import math

import pytest
from pyspark.errors import PySparkException

from brightfold import config
from brightfold.functions.expressions import as_label
from brightfold.plans.evaluate import evaluate_saved, load_saved
from brightfold.sources import results, tables
from pyspark.sql import functions as F


def write(path, text):
    path.write_text(text)
    return str(path)


def test_schema_is_label_then_28_doubles_in_file_order():
    schema = tables.labelled_schema()
    assert schema.names[0] == "label" and len(schema.names) == 29
    assert schema.names[1] == "lepton_pT" and schema.names[-1] == "m_wwbb"
    assert len(config.LOW_LEVEL) == 21 and len(config.HIGH_LEVEL) == 7
    assert {f.dataType.simpleString() for f in schema} == {"double"}


def test_csv_null_policies(spark, tmp_path):
    path = write(tmp_path / "a.csv", "1.0,2.5\n0.0,\n1.0,oops\n0.0,NaN\n0.0,4.0\n")
    kept = tables.read_labelled_csv(spark, path, ["x"], on_null="keep")
    assert kept.dtypes == [("label", "int"), ("x", "double")]
    assert kept.count() == 5 and kept.where("x is null").count() == 2
    skipped = tables.read_labelled_csv(spark, path, ["x"], on_null="skip")
    assert sorted(skipped.collect()) == [(0, 4.0), (1, 2.5)]
    with pytest.raises(PySparkException, match="missing value"):
        tables.read_labelled_csv(spark, path, ["x"]).collect()
    with pytest.raises(ValueError):
        tables.read_labelled_csv(spark, path, ["x"], on_null="guess")


def test_parquet_reader_casts_and_orders(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(3.0, 1.0)], "b double, label double").write.parquet(path)
    assert tables.read_labelled_parquet(spark, path, ["b"]).collect() == [(1, 3.0)]


def test_label_cast_truncates_and_never_fails(spark):
    values = [(1.9,), (-0.5,), (None,), (math.nan,), (1e300,)]
    df = spark.createDataFrame(values, "v double").select(as_label(F.col("v")).alias("label"))
    assert [r[0] for r in df.collect()] == [1, 0, None, None, None]
    assert tables.label_rejects(df).collect() == [(5, 3)]


def test_any_name_but_train_is_the_test_side(spark):
    df = spark.createDataFrame([(i % 5,) for i in range(20)], "fold int")
    assert tables.choose_split(df, "train").count() == 16
    assert tables.choose_split(df, "holdout").count() == 4


def test_result_tables_round_trip(spark, tmp_path):
    rows = [("native", "Random Forest", {"n_estimators": 50.0}, 0.81234, 1.5, 0.5, 2.0)]
    df = spark.createDataFrame(rows, results.SUMMARY_SCHEMA)
    results.write_json(df, str(tmp_path / "s"))
    assert results.read_json(spark, str(tmp_path / "s"), results.SUMMARY_SCHEMA).collect() == df.collect()
    board = spark.createDataFrame([("native", "x", 0.5, None)], results.EVALUATION_SCHEMA)
    results.write_csv(board, str(tmp_path / "b"))
    results.write_csv(board, str(tmp_path / "b"))
    assert results.read_csv(spark, str(tmp_path / "b"), results.EVALUATION_SCHEMA).collect() == board.collect()


def test_no_saved_models_give_an_empty_typed_table(spark, tmp_path):
    assert load_saved(str(tmp_path / "none")) == {}
    empty = evaluate_saved(spark.createDataFrame([(0,)], "label int"), str(tmp_path / "none"))
    assert empty.schema == results.EVALUATION_SCHEMA and empty.count() == 0


def test_rows_are_counted_while_they_are_stored(spark, sf_dir, tmp_path):
    from brightfold.operators.features import assemble
    from brightfold.operators.estimators import make_estimator
    from brightfold.plans.inputs import FEATURES, base

    table, counted = tables.load_counted(spark, lambda session: base(session, sf_dir))
    assert counted == {"n_rows": 6000, "n_rejected": 0} and table.dtypes == base(spark, sf_dir).dtypes
    assert table.exceptAll(base(spark, sf_dir)).isEmpty() and table.sparkSession is spark
    # Nothing observed stays with the session: a fitted regression can still be sent to tasks.
    rows = assemble(table, FEATURES, "features")
    assert make_estimator("lr", maxIter=3).fit(rows).transform(rows).where("prediction = 1").count() > 0
    odd = [(1, 0.5), (2, 0.5), (None, 0.5)]
    _, counted = tables.load_counted(
        spark, lambda session: session.createDataFrame(odd, "label int, x double"), path=str(tmp_path / "odd"))
    assert counted == {"n_rows": 3, "n_rejected": 2}

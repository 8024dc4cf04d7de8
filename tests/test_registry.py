import pytest

import __spark_entry__ as registered
from brightfold.plans import data_queries, score_queries
from checks.compare import difference, duck, type_difference


def test_every_query_has_an_oracle():
    without = set(registered.queries()) - set(registered.oracle_sql())
    assert without <= set(registered.LLM_QUERIES)
    assert set(registered.oracle_sql()) <= set(registered.queries())


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize(
    "name", [*data_queries.QUERIES, *score_queries.QUERIES, "fit_lr", "fit_lr_exact", "predict_proba", "leaderboard"])
def test_query_equals_sql(spark, con, sf_dir, name):
    df = registered.queries()[name](spark, sf_dir)
    relation = con.sql(registered.oracle_sql()[name])
    assert type_difference(df, relation) is None
    assert difference(df.toPandas(), relation.df()) is None

"""Every query with a SQL twin gives the twin's rows; every other query gives rows."""

import pytest
from compare import connect, difference
from conftest import SMALL

from __spark_entry__ import entry, oracle_sql, queries

QUERIES, ORACLES = queries(), oracle_sql()
FITTED = {
    "train_forecast", "rolling_backtest", "final_candidate", "recursive_forecast", "recursive_shadow", "kmeans_elbow",
    "kmeans_profile", "fare_models", "tip_models", "model_comparison", "feature_importance", "forest_grid_search",
}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_twin(spark, duck, name):
    assert difference(QUERIES[name](spark, SMALL).toPandas(), duck.execute(ORACLES[name]).fetchdf()) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - FITTED))
def test_query_without_twin_has_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    assert entry(spark).count() > 0


def test_lineage_query_reports_the_two_tampered_files(spark):
    got = {(r.file, r.status) for r in QUERIES["lineage_verify"](spark, SMALL).collect()}
    assert got == {("orders.parquet", "changed"), ("part.parquet.old", "missing")}

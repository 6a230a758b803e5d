import pytest

import __spark_entry__ as driver
from compare import check, duck

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = driver.queries(), driver.oracle_sql()
# The corpus queries have tests of their own.
QUERIES = {name: QUERIES[name] for name in driver.QUERIES}
SQL = {name: SQL[name] for name in SQL if name in QUERIES}

# Trained models have no SQL; their behaviour is tested in test_models.
ROWS_ONLY = {
    "rf_forecast", "gbt_forecast", "lr_direction", "feature_importance", "model_comparison",
    "forecast_24h_rf",
}


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_every_query_has_sql_but_the_trained_models():
    assert set(QUERIES) - set(SQL) == ROWS_ONLY and set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert driver.entry(spark).count() == 868


@pytest.mark.parametrize("name", sorted(set(QUERIES) - ROWS_ONLY))
def test_query_equals_sql(spark, connection, name):
    assert check(spark, connection, name, QUERIES[name], SQL[name], FOLDER) == ""


def test_forest_forecast(spark):
    rows = QUERIES["forecast_24h_rf"](spark, FOLDER).collect()
    assert len(rows) == 5 * 24 and all(r.predicted_close > 0 for r in rows)

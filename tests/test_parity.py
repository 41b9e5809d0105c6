"""Every SQL-backed driver query equals its DuckDB oracle on sf0.001."""

import pytest

import __spark_entry__ as entry
from hourcast.plans.driver import QUERIES
from hourcast.plans.oracle import ORACLE
from tests.parity import compare, duck_connection

from tests.conftest import SF_MID, SF_SMALL

# Facts about fitted models need rows to fit on: at the smallest scale a series
# is shorter than the longest lag.
FITTED = ("gbt_facts", "recursive_gbt_facts", "search_facts")


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF_SMALL)


@pytest.mark.parametrize("name", sorted(set(ORACLE) - set(FITTED)))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert r["ok"], r


@pytest.mark.parametrize("name", FITTED)
def test_fitted_models_match_their_facts(spark, name):
    r = compare(spark, duck_connection(SF_MID), name, QUERIES[name], ORACLE[name], SF_MID)
    assert r["ok"], r


def test_models_of_an_empty_training_frame(spark):
    """No training row: null predictions, written as 0 for every row to predict."""
    rows = QUERIES["gbt_predict"](spark, SF_SMALL).collect()
    assert rows and all(r["target"] == 0 for r in rows)
    table = QUERIES["param_search"](spark, SF_SMALL).collect()
    assert len(table) == 4 and all(r["mean_mae"] != r["mean_mae"] for r in table)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and len(df.columns) == 62


def test_every_query_has_oracle_or_is_model():
    assert set(QUERIES) - set(ORACLE) == {"gbt_predict", "param_search", "recursive_gbt"}

"""Smoke run of the registered queries that have no SQL oracle (fitted
models, seasonal fits, random splits, file listings, hashes)."""

import pytest

from conftest import SMALL

import __spark_entry__ as E

HEAVY = {"ml_time_cv", "ml_grid_search", "ml_oof_predictions", "modelling_table"}  # covered elsewhere / slow
ROWS_ONLY = sorted(set(E.queries()) - set(E.oracle_sql()) - HEAVY)


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_query_runs(spark, name):
    df = E.queries()[name](spark, SMALL)
    n = df.count()
    assert n > 0
    assert len(df.columns) == len(set(df.columns))

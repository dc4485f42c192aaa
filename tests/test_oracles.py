"""Every registered query with an oracle matches DuckDB on the smallest
scale (same columns, same multiset of rows after rounding)."""

import math

import duckdb
import pytest

from conftest import SMALL

import __spark_entry__ as E

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
ORACLES = E.oracle_sql()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5) + 0.0
    if isinstance(v, bool):
        return int(v)
    if hasattr(v, "isoformat"):
        return str(v)[:26]
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(repr(_norm(r[i])) for i in order) for r in recs)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SMALL)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, got) == _rows(dcols, res.fetchall())


def test_every_query_has_callable():
    qs = E.queries()
    assert set(ORACLES) <= set(qs)
    assert "flagship_asof_disruption" in qs


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "disrupted_share" in df.columns

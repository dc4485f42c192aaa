"""Plan-shape checks: the headline operators keep their intended physical
plans (shuffle count, no Python evaluation, pushed filters, pruned scans)."""

import io
import re
from contextlib import redirect_stdout

import pytest

from conftest import SMALL

import __spark_entry__ as E


def _plan(spark, name):
    df = E.queries()[name](spark, SMALL)
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _tree(txt):
    return txt.split("\n\n")[0]


@pytest.mark.parametrize("name,max_shuffles", [
    ("asof_join", 1), ("flagship_asof_disruption", 2), ("lagged_stat", 1), ("ffill_range", 1),
    ("range_mean_if", 1), ("dedup_least_null", 1), ("null_profile", 1), ("group_means", 1),
])
def test_shuffle_budget(spark, name, max_shuffles):
    tree = _tree(_plan(spark, name))
    shuffles = len(re.findall(r"Exchange \(", tree)) - len(re.findall(r"BroadcastExchange \(", tree))
    assert shuffles <= max_shuffles, tree


@pytest.mark.parametrize("name", ["flagship_asof_disruption", "prior_event_features", "lagged_stat",
                                  "impute_spatial_temporal", "enrich_events", "geohash", "metar_wind_gust"])
def test_no_python_in_hot_path(spark, name):
    txt = _plan(spark, name)
    assert not re.search(r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas)", txt)


def test_scan_prunes_and_pushes(spark):
    txt = _plan(spark, "parquet_scan")
    assert "PushedFilters: [IsNotNull(l_shipdate), LessThan(l_shipdate" in txt
    schema = re.search(r"ReadSchema: struct<([^>]*)>", txt).group(1)
    assert set(f.split(":")[0] for f in schema.split(",")) == {"l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"}


def test_event_scans_push_type_filter(spark):
    txt = _plan(spark, "asof_join")
    assert txt.count("PushedFilters: [In(event_type") == 2
    assert "props" not in re.findall(r"ReadSchema: [^\n]*", txt)[0]

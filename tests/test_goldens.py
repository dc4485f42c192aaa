"""Golden values from the reference and from FIXTURES.md."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import MID
from leadtime.operators import graph, joins
from leadtime.operators import sampling as sm
from leadtime.plans import features as ft
from leadtime.plans.fixtures import Fixtures

# The 5-node toy graph and its steady state (no teleport).
TOY_EDGES = [("A", "B"), ("A", "D"), ("B", "C"), ("B", "E"), ("C", "D"), ("D", "E"), ("E", "A"), ("E", "B"), ("E", "C")]
TOY_STEADY = {"A": 0.10526316, "B": 0.15789474, "C": 0.18421053, "D": 0.23684211, "E": 0.31578947}


def test_toy_graph_steady_state(spark):
    e = spark.createDataFrame(TOY_EDGES, "src string, dst string")
    v, e = graph.build_graph(e, "src", "dst")
    pr = {r["id"]: r["pagerank"] for r in graph.pagerank(v, e, reset=0.0, iters=80).collect()}
    for k, want in TOY_STEADY.items():
        assert pr[k] == pytest.approx(want, abs=1e-6)


def test_rank_mass_is_one_with_dangling(spark):
    fx = Fixtures(spark, MID)
    v, e = graph.build_graph(fx.edges_sparse(), "src", "dst")
    for it in (1, 4, 7):
        m = graph.rank_mass(graph.pagerank(v, e, 0.15, it)).first()["mass"]
        assert m == pytest.approx(1.0, abs=1e-9)


def test_published_fold_dates(spark):
    df = spark.createDataFrame([(datetime(2014, 12, 31),), (datetime(2018, 12, 31),)], "t timestamp")
    folds = sm.cv_bounds(df, "t", k=5, blocking=True, overlap=0.2, method="cumulative")
    got = [(f.train_lo.date().isoformat(), f.train_hi.date().isoformat(), f.val_lo.date().isoformat(),
            f.val_hi.date().isoformat()) for f in folds]
    assert got == sm.FOLDS


def test_fixture_counts(spark):
    fx = Fixtures(spark, MID)
    t = fx.trips()
    assert t.count() == 6001
    assert t.filter("cancelled = 1").count() == 203
    j = joins.asof_join(t, fx.readings().select("reading_id", "site", "read_ts"), "origin", "site", "sched",
                        "read_ts", 7200, 14400, "trip_id", tie="reading_id")
    m = j.agg(F.count("reading_id").alias("n"), F.sum("reading_id").alias("s")).first()
    assert (m["n"], m["s"]) == (5578, 27654016)


def test_prior_event_valid_count(spark):
    t = ft.trip_times(Fixtures(spark, MID).trips())
    o = ft.prior_event_features(t)
    assert o.filter("prior_dest = origin").count() == 1232
    assert o.filter("prior_valid = 1").count() == 927


def test_inner_asof_keeps_only_matches(spark):
    fx = Fixtures(spark, MID)
    j = joins.asof_join(fx.trips(), fx.readings().select("reading_id", "site", "read_ts", "wind"), "origin", "site",
                        "sched", "read_ts", 7200, 14400, "trip_id", tie="reading_id", how="inner")
    assert j.count() == 5578
    assert "__matched" not in j.columns

"""Seasonal fits recover a known pattern; trend features skip short series."""

import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import MID
from leadtime.plans import seasonality as ss
from leadtime.plans.fixtures import Fixtures


def test_weekly_fit_recovers_pattern(spark):
    start = datetime(2024, 1, 7)  # a Sunday
    rows = []
    for h in range(4 * 168):
        t = start + timedelta(hours=h)
        how = ((t.isoweekday() % 7) * 24 + t.hour)
        rows.append(("S", t, 10.0 + 3.0 * math.sin(2 * math.pi * how / 168) + 1.0 * math.cos(2 * math.pi * t.hour / 24)))
    df = spark.createDataFrame(rows, "site string, ts timestamp, y double")
    fit = ss.fit_seasonality_week(df, "site", "ts", "y", lam=1e-6).collect()
    assert len(fit) == 168
    for r in fit:
        how = (r["dow"] - 1) * 24 + r["hour"]
        assert r["weekly"] == pytest.approx(3.0 * math.sin(2 * math.pi * how / 168), abs=1e-3)
        assert r["daily"] == pytest.approx(math.cos(2 * math.pi * r["hour"] / 24), abs=1e-3)


def test_year_fit_shape_and_short_site(spark):
    o = Fixtures(spark, MID).table("orders")
    yr = ss.fit_seasonality_year(o, "o_orderpriority", "o_orderdate", "o_totalprice", ["2024-01-01"])
    n = yr.groupBy("o_orderpriority").count().collect()
    assert all(r["count"] == 366 for r in n)
    one = spark.createDataFrame([("Z", datetime(2024, 3, 1), 5.0)], "s string, t timestamp, y double")
    z = ss.fit_seasonality_year(one, "s", "t", "y").agg(F.max(F.abs("yearly")), F.max(F.abs("holidays"))).first()
    assert z[0] == 0.0 and z[1] == 0.0


def test_trend_features_skip_short_sites(spark):
    t = Fixtures(spark, MID).trips()  # 30 days per site: below the 90-day minimum
    out = ss.trend_features(t, "origin", "sched", "delay_min")
    assert out.count() == t.count()
    assert out.filter(F.col("trend").isNotNull()).count() == 0

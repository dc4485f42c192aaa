"""Property checks: plan variants agree, enrichments keep rows, features
do not look past their cutoff, halo windows equal plain windows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import MID
from leadtime.operators import aggregates as ag
from leadtime.operators import joins, windows
from leadtime.plans import features as ft
from leadtime.plans.fixtures import Fixtures


def _eq(a, b, key, cols):
    x = a.select(key, *cols).alias("x").join(b.select(key, *cols).alias("y"), key, "full")
    bad = x.filter(" OR ".join(f"NOT (x.{c} <=> y.{c})" for c in cols))
    return bad.count() == 0 and a.count() == b.count()


def test_asof_sort_equals_join(spark):
    fx = Fixtures(spark, MID)
    t, r = fx.trips(), fx.readings().select("reading_id", "site", "read_ts", "wind")
    a = joins.asof_join(t, r, "origin", "site", "sched", "read_ts", 7200, 14400, "trip_id", tie="reading_id")
    b = joins.asof_join(t, r, "origin", "site", "sched", "read_ts", 7200, 14400, "trip_id", tie="reading_id",
                        method="join")
    assert _eq(a, b, "trip_id", ["reading_id", "wind"])


def test_nearest_in_time_sort_equals_join(spark):
    fx = Fixtures(spark, MID)
    r = fx.readings()
    left = r.filter("wind IS NULL").select("reading_id", F.col("site").alias("s"), F.col("read_ts").alias("t"))
    right = r.filter("wind IS NOT NULL").select(F.col("reading_id").alias("rid"), "site", "read_ts")
    a = joins.nearest_in_time(left, right, "s", "site", "t", "read_ts", 3 * 3600, "reading_id", tie="rid")
    b = joins.nearest_in_time(left, right, "s", "site", "t", "read_ts", 3 * 3600, "reading_id", tie="rid", method="join")
    assert _eq(a, b, "reading_id", ["rid"])


def test_halo_windows_equal_plain_windows_small_buckets(spark):
    """Ten-minute buckets force most frames across bucket borders."""
    fx = Fixtures(spark, MID)
    r = fx.readings()
    w = Window.partitionBy("site").orderBy("read_ts", "reading_id")
    plain = r.select("reading_id",
                     F.coalesce("wind", F.last("wind", ignorenulls=True).over(w.rowsBetween(-10, -1))).alias("a"),
                     F.lag("wind").over(w).alias("b"))
    h1 = windows.ffill_rows(r, ["site"], "read_ts", "reading_id", "wind", 10, out="a", width_s=600)
    h2 = windows.prior_event(r, "site", "read_ts", "reading_id", ["wind"], width_s=600).withColumnRenamed("prior_wind", "b")
    assert _eq(plain.select("reading_id", "a"), h1.select("reading_id", "a"), "reading_id", ["a"])
    assert _eq(plain.select("reading_id", "b"), h2.select("reading_id", "b"), "reading_id", ["b"])
    rng = (Window.partitionBy("site").orderBy(F.unix_micros("read_ts")).rangeBetween(-7200 * 10**6, 0))
    plain_r = r.select("reading_id", F.coalesce("wind", F.last("wind", ignorenulls=True).over(rng)).alias("c"))
    h3 = windows.ffill_range(r, ["site"], "read_ts", "wind", 7200, out="c", width_s=900)
    assert _eq(plain_r, h3.select("reading_id", "c"), "reading_id", ["c"])


def test_ema_nonnull_small_buckets(spark):
    fx = Fixtures(spark, MID)
    r = fx.readings()
    a = windows.ema_fill(r, "site", "read_ts", "reading_id", "wind", 6, 0.5, count_nonnull=True, out="e")
    b = windows.ema_fill(r, "site", "read_ts", "reading_id", "wind", 6, 0.5, count_nonnull=True, out="e", width_s=300)
    assert _eq(a.select("reading_id", F.round("e", 9).alias("e")), b.select("reading_id", F.round("e", 9).alias("e")),
               "reading_id", ["e"])


def test_left_enrichment_keeps_rows(spark):
    fx = Fixtures(spark, MID)
    t = fx.trips()
    out = ft.enrich_events(t, fx.sites(), fx.stations(), fx.readings().select("reading_id", "site", "read_ts"))
    assert out.count() == t.count()
    assert out.select("trip_id").distinct().count() == t.count()
    assert out.filter("origin_zone IS NULL").count() == 0


def test_dedup_leaves_no_duplicates(spark):
    w = Fixtures(spark, MID).wide_nulls()
    d = windows.dedup_least_null(w, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_tax"], ["l_suppkey", "l_shipdate"])
    assert ag.duplicate_report(w, ["l_orderkey", "l_linenumber"]).first()["dup_groups"] > 0
    assert ag.duplicate_report(d, ["l_orderkey", "l_linenumber"]).first()["dup_groups"] == 0


def test_fill_never_adds_nulls(spark):
    r = Fixtures(spark, MID).readings()
    before = r.filter("wind IS NULL").count()
    after = windows.ema_fill(r, "site", "read_ts", "reading_id", "wind", 8, 0.5).filter("wind IS NULL").count()
    assert after <= before


def test_features_do_not_look_past_cutoff(spark):
    """Removing every row scheduled after a date leaves the features of the
    earlier rows unchanged."""
    fx = Fixtures(spark, MID)
    t = ft.trip_times(fx.trips()).withColumn("label", F.when(F.col("delay_min") >= 15, 1.0).otherwise(0.0))
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp")
    full = ft.recency_features(t, "origin", "sched", "actual_dep", "delay_min", "label")
    part = ft.recency_features(t.filter(F.col("sched") < cut), "origin", "sched", "actual_dep", "delay_min", "label")
    full = full.filter(F.col("sched") < cut)
    assert _eq(full, part, "trip_id", ["mean_dep_delay", "prop_delayed"])
    pf = ft.prior_event_features(t)
    pp = ft.prior_event_features(t.filter(F.col("sched") < cut))
    assert _eq(pf.filter(F.col("sched") < cut), pp, "trip_id", ["prior_turnaround", "prior_depdelay_calc"])


def test_nearest_matches_brute_force(spark):
    fx = Fixtures(spark, MID)
    from leadtime.functions.geo import haversine
    s, st = fx.sites(), fx.stations()
    brute = (s.select("site_id", F.col("lat").alias("a"), F.col("lon").alias("b"))
             .crossJoin(st.select("station_id", "lat", "lon"))
             .withColumn("d", haversine("a", "b", "lat", "lon"))
             .groupBy("site_id").agg(F.min_by("station_id", F.struct("d", "station_id")).alias("station_id")))
    for cell in (0.5, 2.0, None):
        got = joins.nearest(s, st, "site_id", "lat", "lon", "station_id", "lat", "lon", cell_deg=cell)
        assert _eq(brute, got.select("site_id", "station_id"), "site_id", ["station_id"])


def test_lagged_stat_interval_equals_frames(spark):
    """The interval-stabbing form (any bucket width) equals the collected-frame form."""
    from leadtime.functions.timeops import hours_before
    fx = Fixtures(spark, MID)
    t = ft.trip_times(fx.trips()).withColumn("label", F.when(F.col("delay_min") >= 15, 1.0).otherwise(0.0))
    cols = {"m": "delay_min", "p": "label"}
    frames = windows.lagged_stat(t.withColumn("cut", hours_before("sched", 2)), ["origin"], "sched", "actual_dep",
                                 "cut", cols, span_s=4 * 3600)
    for width in (None, 1800.0):
        iv = windows.lagged_stat(t, ["origin"], "sched", "actual_dep", None, cols, span_s=4 * 3600,
                                 cutoff_s=2 * 3600, width_s=width)
        a = frames.select("trip_id", F.round("m", 9).alias("m"), F.round("p", 9).alias("p"))
        b = iv.select("trip_id", F.round("m", 9).alias("m"), F.round("p", 9).alias("p"))
        assert _eq(a, b, "trip_id", ["m", "p"])


def test_modelling_table_one_row_per_trip(spark):
    import __spark_entry__ as E
    out = E.queries()["modelling_table"](spark, MID)
    n = Fixtures(spark, MID).trips().count()
    assert out.count() == n
    assert out.select("trip_id").distinct().count() == n
    assert out.filter(F.col("label").isNull()).count() == 0


def test_asof_string_tie(spark):
    fx = Fixtures(spark, MID)
    t = fx.trips()
    r = fx.readings().select("reading_id", "site", "read_ts")
    rs = r.withColumn("rid_s", F.lpad(F.col("reading_id").cast("string"), 12, "0"))
    a = joins.asof_join(t, r, "origin", "site", "sched", "read_ts", 7200, 14400, tie="reading_id")
    b = joins.asof_join(t, rs, "origin", "site", "sched", "read_ts", 7200, 14400, tie="rid_s")
    assert _eq(a, b, "trip_id", ["reading_id"])

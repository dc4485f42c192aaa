"""Registered queries: window operators (W1-W18) and window-based
features (D1-D4, D10-D12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadtime.operators import clean, windows
from leadtime.plans import features as ft
from leadtime.plans.fixtures import Fixtures, with_views
from leadtime.plans.registry import query


def r6(c):
    return F.round(c, 6)


def _area(c):
    return (F.col(c) % 2).cast("string")


@query("dedup_least_null", with_views(["wide_nulls"], """
SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
     (CASE WHEN l_quantity IS NULL THEN 1 ELSE 0 END + CASE WHEN l_extendedprice IS NULL THEN 1 ELSE 0 END
      + CASE WHEN l_discount IS NULL THEN 1 ELSE 0 END + CASE WHEN l_tax IS NULL THEN 1 ELSE 0 END) ASC,
     l_suppkey ASC NULLS LAST, l_shipdate ASC NULLS LAST, l_quantity ASC NULLS LAST, l_extendedprice ASC NULLS LAST,
     l_discount ASC NULLS LAST, l_tax ASC NULLS LAST) AS rn
  FROM wide_nulls) WHERE rn = 1"""))
def q_dedup(spark, d):
    w = Fixtures(spark, d).wide_nulls()
    feats = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    out = windows.dedup_least_null(w, ["l_orderkey", "l_linenumber"], feats,
                                   ["l_suppkey", "l_shipdate", *feats])
    return out.select("l_orderkey", "l_linenumber", "l_suppkey", *feats)


@query("first_per_key", with_views(["readings"], """
SELECT site, CAST(CAST(read_ts AS DATE) AS VARCHAR) AS day, reading_id FROM (
  SELECT *, row_number() OVER (PARTITION BY site, CAST(read_ts AS DATE) ORDER BY read_ts, reading_id) AS rn FROM readings)
WHERE rn = 1"""))
def q_first(spark, d):
    r = Fixtures(spark, d).readings().withColumn("day", F.to_date("read_ts").cast("string"))
    out = windows.first_per_key(r, ["site", "day"], [F.col("read_ts"), F.col("reading_id")])
    return out.select("site", "day", "reading_id")


@query("prior_event", with_views(["trips"], """
SELECT trip_id,
  lag(origin) OVER w AS prior_origin, lag(dest) OVER w AS prior_dest, round(lag(delay_min) OVER w, 6) AS prior_delay_min,
  lag(trip_id) OVER w AS prior_trip_id
FROM trips WINDOW w AS (PARTITION BY entity ORDER BY sched, trip_id)"""))
def q_prior(spark, d):
    t = Fixtures(spark, d).trips()
    out = windows.prior_event(t, "entity", "sched", "trip_id", ["origin", "dest", "delay_min", "trip_id"])
    return out.select("trip_id", "prior_origin", "prior_dest", r6(F.col("prior_delay_min")).alias("prior_delay_min"),
                      "prior_trip_id")


@query("interpolate_midpoint", with_views(["readings"], """
SELECT reading_id, round(CASE WHEN wind IS NULL AND lag(wind) OVER w IS NOT NULL AND lead(wind) OVER w IS NOT NULL
       THEN (lag(wind) OVER w + lead(wind) OVER w) / 2 ELSE wind END, 6) AS wind
FROM readings WINDOW w AS (PARTITION BY site ORDER BY read_ts, reading_id)"""))
def q_interp(spark, d):
    r = Fixtures(spark, d).readings()
    out = windows.interpolate_midpoint(r, "site", "read_ts", "reading_id", "wind")
    return out.select("reading_id", r6(F.col("wind")).alias("wind"))


@query("rolling_mean", with_views(["daily"], """
SELECT site, CAST(day AS VARCHAR) AS day,
  round(avg(y) OVER (PARTITION BY site ORDER BY day ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING), 6) AS y_roll
FROM daily"""))
def q_rolling(spark, d):
    dl = Fixtures(spark, d).daily()
    out = windows.rolling_mean(dl, ["site"], "day", "y", -30, -1)
    return out.select("site", F.col("day").cast("string").alias("day"), r6(F.col("y_roll")).alias("y_roll"))


@query("ffill_rows", with_views(["readings"], """
SELECT reading_id, round(coalesce(wind, last_value(wind IGNORE NULLS) OVER (PARTITION BY site ORDER BY read_ts, reading_id
       ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)), 6) AS wind_ffill
FROM readings"""))
def q_ffill_rows(spark, d):
    r = Fixtures(spark, d).readings()
    out = windows.ffill_rows(r, ["site"], "read_ts", "reading_id", "wind", 10, out="wind_ffill")
    return out.select("reading_id", r6(F.col("wind_ffill")).alias("wind_ffill"))


@query("ffill_range", with_views(["readings"], """
SELECT reading_id, round(coalesce(wind, last_value(wind IGNORE NULLS) OVER (PARTITION BY site ORDER BY read_ts
       RANGE BETWEEN INTERVAL 2 HOUR PRECEDING AND CURRENT ROW)), 6) AS wind_2h
FROM readings"""))
def q_ffill_range(spark, d):
    r = Fixtures(spark, d).readings()
    out = windows.ffill_range(r, ["site"], "read_ts", "wind", 7200, out="wind_2h")
    return out.select("reading_id", r6(F.col("wind_2h")).alias("wind_2h"))


@query("range_mean_if", with_views(["trips"], """
SELECT trip_id, round(avg(CASE WHEN cancelled = 0 THEN delay_min END) OVER (PARTITION BY origin, dest ORDER BY sched
       RANGE BETWEEN INTERVAL 72 HOUR PRECEDING AND CURRENT ROW EXCLUDE GROUP), 6) AS route_mean_72h
FROM trips"""))
def q_range_mean(spark, d):
    t = Fixtures(spark, d).trips()
    out = windows.range_mean_if(t, ["origin", "dest"], "sched", "delay_min", F.col("cancelled") == 0, 72 * 3600,
                                out="route_mean_72h")
    return out.select("trip_id", r6(F.col("route_mean_72h")).alias("route_mean_72h"))


_TT = """tt AS (
  SELECT *, epoch_us(sched) AS s_us,
    epoch_us(sched) + CAST(round(coalesce(delay_min, 0.0) * 60000000) AS BIGINT) AS dep_us,
    CAST(duration_min AS DOUBLE) AS sel,
    CASE WHEN delay_min >= 15 OR cancelled = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label
  FROM trips)"""


@query("lagged_stat", with_views(["trips"], "," + _TT + """
SELECT t.trip_id, round(avg(u.delay_min), 6) + 0.0 AS mean_dep_delay, round(avg(u.label), 6) + 0.0 AS prop_delayed
FROM tt t LEFT JOIN tt u ON u.origin = t.origin AND u.s_us >= t.s_us - 14400000000 AND u.s_us <= t.s_us
  AND u.dep_us < t.s_us - 7200000000
GROUP BY t.trip_id"""))
def q_lagged_stat(spark, d):
    t = ft.trip_times(Fixtures(spark, d).trips())
    t = t.withColumn("label", clean.label("delay_min", "cancelled"))
    out = ft.recency_features(t, "origin", "sched", "actual_dep", "delay_min", "label")
    return out.select("trip_id", r6(F.col("mean_dep_delay")).alias("mean_dep_delay"),
                      r6(F.col("prop_delayed")).alias("prop_delayed"))


@query("lagged_stat_cutoff", with_views(["trips"], "," + _TT + """,
ct AS (SELECT *, s_us - CAST((trip_id % 7) * 1800000000 AS BIGINT) AS c_us FROM tt)
SELECT t.trip_id, round(avg(u.delay_min), 6) + 0.0 AS known_delay, count(u.delay_min) > 0 AS known
FROM ct t LEFT JOIN tt u ON u.origin = t.origin AND u.s_us >= t.s_us - 21600000000 AND u.s_us <= t.s_us AND u.dep_us < t.c_us
GROUP BY t.trip_id"""))
def q_lagged_cutoff(spark, d):
    """Each trip has a cutoff of its own, 0 to 3 hours before it is due."""
    t = ft.trip_times(Fixtures(spark, d).trips())
    t = t.withColumn("cut", F.timestamp_micros(F.unix_micros("sched") - F.col("trip_id") % 7 * F.lit(1_800_000_000)))
    out = windows.lagged_stat(t, ["origin"], "sched", "actual_dep", "cut", {"known_delay": "delay_min"}, span_s=6 * 3600)
    return out.select("trip_id", r6(F.col("known_delay")).alias("known_delay"), F.col("known_delay").isNotNull().alias("known"))


def _ema_sql(list_expr):
    return (f"CASE WHEN len({list_expr}) > 0 THEN list_sum(list_transform({list_expr}, lambda x, i: x * pow(0.5, i - 1))) "
            f"/ list_sum(list_transform({list_expr}, lambda x, i: pow(0.5, i - 1))) END")


@query("ema_fill", with_views(["readings"], f""",
l AS (SELECT reading_id, wind, list_reverse(list_filter(list(wind) OVER (PARTITION BY site ORDER BY read_ts, reading_id
        ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING), lambda x: x IS NOT NULL)) AS lst FROM readings)
SELECT reading_id, round(coalesce(wind, {_ema_sql('lst')}), 6) AS wind_ema FROM l"""))
def q_ema(spark, d):
    r = Fixtures(spark, d).readings()
    out = windows.ema_fill(r, "site", "read_ts", "reading_id", "wind", 8, 0.5, out="wind_ema")
    return out.select("reading_id", r6(F.col("wind_ema")).alias("wind_ema"))


@query("ema_fill_nonnull", with_views(["readings"], f""",
l AS (SELECT reading_id, wind, list_reverse(list_slice(list_filter(list(wind) OVER (PARTITION BY site ORDER BY read_ts, reading_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), lambda x: x IS NOT NULL), -6, -1)) AS lst FROM readings)
SELECT reading_id, round(coalesce(wind, {_ema_sql('lst')}), 6) AS wind_ema6 FROM l"""))
def q_ema_nn(spark, d):
    r = Fixtures(spark, d).readings()
    out = windows.ema_fill(r, "site", "read_ts", "reading_id", "wind", 6, 0.5, count_nonnull=True, out="wind_ema6")
    return out.select("reading_id", r6(F.col("wind_ema6")).alias("wind_ema6"))


@query("rolling_fill", with_views(["readings"], """
SELECT reading_id, round(coalesce(wind, avg(wind) OVER (PARTITION BY site ORDER BY read_ts, reading_id
       ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING)), 6) AS wind FROM readings"""))
def q_rolling_fill(spark, d):
    r = Fixtures(spark, d).readings()
    out = windows.rolling_fill(r, "site", "read_ts", "reading_id", "wind", 8)
    return out.select("reading_id", r6(F.col("wind")).alias("wind"))


@query("row_index", with_views(["trips"], """
SELECT trip_id, row_number() OVER (ORDER BY sched, trip_id) AS row_idx FROM trips"""))
def q_row_index(spark, d):
    return windows.row_index(Fixtures(spark, d).trips(), ["sched", "trip_id"]).select("trip_id", "row_idx")


@query("index_ids", with_views(["trips"], """
SELECT entity, row_number() OVER (ORDER BY entity) - 1 AS idx FROM (SELECT DISTINCT entity FROM trips)"""))
def q_index_ids(spark, d):
    return windows.index_ids(Fixtures(spark, d).trips(), "entity")


@query("occurrence", with_views(["trips"], """
SELECT trip_id, CAST(row_number() OVER (PARTITION BY entity, origin ORDER BY sched, trip_id) AS INTEGER) AS occurrence FROM trips"""))
def q_occurrence(spark, d):
    return windows.occurrence(Fixtures(spark, d).trips(), ["entity", "origin"], ["sched", "trip_id"]).select(
        "trip_id", "occurrence")


# ---------------------------------------------------------------------------
# Window-based features

_PRIOR_SQL = "," + _TT + """,
t2 AS (SELECT *, dep_us + CAST(round(sel * 60000000) AS BIGINT) AS aarr_us FROM tt),
lg AS (SELECT *, lag(cancelled) OVER w AS p_canc, lag(dest) OVER w AS p_dest, lag(s_us) OVER w AS p_s,
         lag(dep_us) OVER w AS p_dep, lag(sel) OVER w AS p_sel, lag(delay_min) OVER w AS p_delay,
         lag(aarr_us) OVER w AS p_arr
       FROM t2 WINDOW w AS (PARTITION BY entity ORDER BY s_us, trip_id)),
f AS (SELECT *, s_us - 7200000000 AS cut,
         coalesce(origin = p_dest AND p_s >= s_us - 7200000000 - 86400000000 AND p_canc = 0, false) AS valid FROM lg),
g AS (SELECT *, coalesce(p_dep <= cut, false) AND valid AS departed,
         coalesce(p_s <= cut AND p_dep > cut, false) AND valid AS late FROM f),
h AS (SELECT *, CASE WHEN departed THEN p_delay WHEN late THEN (cut - p_s) / 60000000.0 ELSE 0.0 END AS dd,
         CASE WHEN valid THEN p_sel END AS sel_v FROM g),
k AS (SELECT *, p_s + CAST(round(dd * 60000000) AS BIGINT) AS dept,
         coalesce(p_arr <= cut, false) AND valid AS arrived FROM h),
m AS (SELECT *, CASE WHEN arrived THEN p_arr
                     WHEN coalesce(p_dep <= cut, false) THEN p_dep + CAST(round(sel_v * 60000000) AS BIGINT)
                     ELSE dept + CAST(round(sel_v * 60000000) AS BIGINT) END AS arr_calc FROM k)
SELECT trip_id, CAST(valid AS INTEGER) AS valid, CAST(departed AS INTEGER) AS isdeparted,
  round(dd, 6) AS depdelay_calc, dept AS deptime_us,
  CASE WHEN dd >= 15 OR coalesce(p_canc = 1, false) THEN 1 ELSE 0 END AS isdelayed_calc,
  CAST(arrived AS INTEGER) AS isarrived_calc, arr_calc AS arr_time_us,
  round(CASE WHEN valid THEN (s_us - arr_calc) / 60000000.0 END, 6) AS turnaround
FROM m"""


@query("prior_event_features", with_views(["trips"], _PRIOR_SQL))
def q_prior_features(spark, d):
    t = ft.trip_times(Fixtures(spark, d).trips())
    o = ft.prior_event_features(t)
    return o.select("trip_id", F.col("prior_valid").alias("valid"), F.col("prior_isdeparted").alias("isdeparted"),
                    r6(F.col("prior_depdelay_calc")).alias("depdelay_calc"),
                    F.unix_micros("prior_deptime_calc").alias("deptime_us"),
                    F.col("prior_isdelayed_calc").alias("isdelayed_calc"),
                    F.col("prior_isarrived_calc").alias("isarrived_calc"),
                    F.unix_micros("prior_arr_time_calc").alias("arr_time_us"),
                    r6(F.col("prior_turnaround")).alias("turnaround"))


@query("prior_event_cancelled_first", with_views(["trips"], _PRIOR_SQL.replace(
    "PARTITION BY entity ORDER BY s_us, trip_id", "PARTITION BY entity ORDER BY s_us, cancelled DESC, trip_id")))
def q_prior_cf(spark, d):
    t = ft.trip_times(Fixtures(spark, d).trips())
    o = ft.prior_event_features(t, cancelled_first=True)
    return o.select("trip_id", F.col("prior_valid").alias("valid"), F.col("prior_isdeparted").alias("isdeparted"),
                    r6(F.col("prior_depdelay_calc")).alias("depdelay_calc"),
                    F.unix_micros("prior_deptime_calc").alias("deptime_us"),
                    F.col("prior_isdelayed_calc").alias("isdelayed_calc"),
                    F.col("prior_isarrived_calc").alias("isarrived_calc"),
                    F.unix_micros("prior_arr_time_calc").alias("arr_time_us"),
                    r6(F.col("prior_turnaround")).alias("turnaround"))


@query("lagged_daily", with_views(["trips"], "," + _TT + """,
dly AS (SELECT origin, CAST(sched AS DATE) AS day, avg(delay_min) AS md, avg(label) AS pl FROM tt GROUP BY 1, 2),
lw AS (SELECT origin, day,
   avg(md) OVER (PARTITION BY origin ORDER BY day ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS lag_mean_delay,
   avg(pl) OVER (PARTITION BY origin ORDER BY day ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS lag_prop_delayed FROM dly)
SELECT t.trip_id, round(lw.lag_mean_delay, 6) AS lag_mean_delay, round(lw.lag_prop_delayed, 6) AS lag_prop_delayed
FROM tt t LEFT JOIN lw ON lw.origin = t.origin AND lw.day = CAST(t.sched AS DATE)"""))
def q_lagged_daily(spark, d):
    t = Fixtures(spark, d).trips().withColumn("label", clean.label("delay_min", "cancelled"))
    out = ft.lagged_daily(t, "origin", "sched", "delay_min", "label")
    return out.select("trip_id", r6(F.col("lag_mean_delay")).alias("lag_mean_delay"),
                      r6(F.col("lag_prop_delayed")).alias("lag_prop_delayed"))


@query("impute_spatial_temporal", with_views(["readings"], f""",
s1 AS (SELECT reading_id, site, read_ts, coalesce(wind, last_value(wind IGNORE NULLS) OVER (PARTITION BY CAST(site % 2 AS VARCHAR)
         ORDER BY read_ts RANGE BETWEEN INTERVAL 2 HOUR PRECEDING AND CURRENT ROW)) AS wind FROM readings),
l AS (SELECT reading_id, wind, list_reverse(list_filter(list(wind) OVER (PARTITION BY site ORDER BY read_ts, reading_id
        ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING), lambda x: x IS NOT NULL)) AS lst FROM s1)
SELECT reading_id, round(coalesce(wind, {_ema_sql('lst')}), 6) AS wind FROM l"""))
def q_impute(spark, d):
    r = Fixtures(spark, d).readings().withColumn("area", _area("site"))
    out = ft.impute_spatial_temporal(r, ["wind"], "area", "site", "read_ts", "reading_id")
    return out.select("reading_id", r6(F.col("wind")).alias("wind"))


_TWO = ("wind", "gust")


@query("impute_many", with_views(["readings"], """,
r2 AS (SELECT *, CASE WHEN reading_id % 3 = 0 THEN NULL ELSE wind * 2 END AS gust FROM readings),
s1 AS (SELECT reading_id, site, read_ts, """ + ", ".join(f"""coalesce({c}, last_value({c} IGNORE NULLS) OVER (PARTITION BY CAST(site % 2 AS VARCHAR)
         ORDER BY read_ts RANGE BETWEEN INTERVAL 30 MINUTE PRECEDING AND CURRENT ROW)) AS {c}""" for c in _TWO) + """ FROM r2),
l AS (SELECT reading_id, wind, gust, """ + ", ".join(f"""list_reverse(list_filter(list({c}) OVER (PARTITION BY site ORDER BY read_ts, reading_id
        ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING), lambda x: x IS NOT NULL)) AS l_{c}""" for c in _TWO) + f""" FROM s1)
SELECT reading_id, {", ".join(f"round(coalesce({c}, {_ema_sql('l_' + c)}), 6) AS {c}" for c in _TWO)} FROM l"""))
def q_impute_many(spark, d):
    """D10 for two measures, one window a step."""
    r = Fixtures(spark, d).readings().withColumn("area", _area("site")).withColumn("gust", F.when(F.col("reading_id") % 3 != 0, F.col("wind") * 2))
    out = ft.impute_spatial_temporal(r, list(_TWO), "area", "site", "read_ts", "reading_id", secs=1800.0)
    return out.select("reading_id", *[r6(F.col(c)).alias(c) for c in _TWO])


@query("overwrite_from_area", with_views(["readings"], """
SELECT reading_id, round(last_value(wind IGNORE NULLS) OVER (PARTITION BY CAST(site % 2 AS VARCHAR) ORDER BY read_ts, reading_id
       ROWS BETWEEN 5 PRECEDING AND CURRENT ROW), 6) AS wind FROM readings"""))
def q_overwrite(spark, d):
    r = Fixtures(spark, d).readings().withColumn("area", _area("site"))
    out = ft.overwrite_from_area(r, "wind", "area", "read_ts", "reading_id", 6)
    return out.select("reading_id", r6(F.col("wind")).alias("wind"))


@query("impute_from_route", with_views(["trips"], """,
v AS (SELECT *, CASE WHEN delay_min < 100 THEN delay_min END AS vv FROM trips),
w AS (SELECT *, coalesce(vv, last_value(vv IGNORE NULLS) OVER (PARTITION BY origin, dest ORDER BY sched, trip_id
         ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)) AS lst,
       avg(vv) OVER (PARTITION BY origin, dest ORDER BY sched RANGE BETWEEN INTERVAL 72 HOUR PRECEDING AND CURRENT ROW
         EXCLUDE GROUP) AS mn FROM v)
SELECT trip_id, round(CASE WHEN coalesce(delay_min < 100, false) THEN delay_min ELSE coalesce(lst, mn) END, 6) AS delay_filled
FROM w"""))
def q_impute_route(spark, d):
    t = Fixtures(spark, d).trips().withColumn("ok", F.col("delay_min") < 100)
    out = ft.impute_from_route(t, ["origin", "dest"], "sched", "trip_id", "delay_min", "ok", out="delay_filled")
    return out.select("trip_id", r6(F.col("delay_filled")).alias("delay_filled"))

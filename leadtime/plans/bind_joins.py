"""Registered queries: joins (J1-J26) and the enrichment flows."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadtime.operators import joins
from leadtime.plans import features as ft
from leadtime.plans import seasonality as ss
from leadtime.plans.bind_funcs import utc_sql
from leadtime.plans.fixtures import Fixtures, with_views
from leadtime.plans.registry import query


def r6(c):
    return F.round(c, 6)


@query("lookup_two_roles", with_views(["trips", "sites"], """
SELECT t.trip_id, o.zone AS origin_zone, o.region AS origin_region, d.zone AS dest_zone, d.region AS dest_region
FROM trips t LEFT JOIN sites o ON o.site_id = t.origin LEFT JOIN sites d ON d.site_id = t.dest"""))
def q_two_roles(spark, d):
    fx = Fixtures(spark, d)
    out = joins.lookup_two_roles(fx.trips(), fx.sites(), "site_id", {"origin": "origin_", "dest": "dest_"}, ["zone", "region"])
    return out.select("trip_id", "origin_zone", "origin_region", "dest_zone", "dest_region")


@query("lookup_sql_cte", with_views(["trips", "sites"], """
SELECT t.trip_id, o.zone AS origin_zone, d.zone AS dest_zone
FROM trips t LEFT JOIN sites o ON o.site_id = t.origin LEFT JOIN sites d ON d.site_id = t.dest"""))
def q_lookup_sql(spark, d):
    """The same lookup written as SQL with a CTE chain."""
    fx = Fixtures(spark, d)
    fx.trips().createOrReplaceTempView("lt_trips")
    fx.sites().createOrReplaceTempView("lt_sites")
    return spark.sql("""
        WITH o AS (SELECT site_id, zone FROM lt_sites), d AS (SELECT site_id, zone FROM lt_sites),
             t AS (SELECT trip_id, origin, dest FROM lt_trips)
        SELECT t.trip_id, o.zone AS origin_zone, d.zone AS dest_zone
        FROM t LEFT JOIN o ON o.site_id = t.origin LEFT JOIN d ON d.site_id = t.dest""")


@query("missing_keys", with_views(["trips"], """
SELECT DISTINCT entity AS key FROM trips WHERE entity NOT IN (SELECT user_id FROM events WHERE event_type = 'signup' AND value > 40)"""))
def q_missing(spark, d):
    fx = Fixtures(spark, d)
    return joins.missing_keys(fx.trips(), fx.table("events").filter("event_type = 'signup' AND value > 40"), "entity", "user_id")


@query("unmatched_codes", """
SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'missing' ELSE 'incomplete' END AS reason
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE l.doc_id IS NULL OR l.quality IS NULL""")
def q_unmatched(spark, d):
    """Documents with no label row, or a label row without quality."""
    fx = Fixtures(spark, d)
    out = joins.unmatched(fx.table("documents").select("doc_id"), fx.table("labels"), "doc_id", "doc_id", ["quality"])
    return out.select("doc_id", "reason")


@query("match_rate", with_views(["trips", "readings"], """,
pick AS (SELECT trip_id, reading_id, wind FROM (
    SELECT t.trip_id, r.reading_id, r.wind,
           row_number() OVER (PARTITION BY t.trip_id ORDER BY r.read_ts DESC, r.reading_id DESC) AS rn
    FROM trips t JOIN readings r
      ON r.site = t.origin AND r.read_ts >= t.sched - INTERVAL 4 HOUR AND r.read_ts <= t.sched - INTERVAL 2 HOUR
  ) WHERE rn = 1),
j AS (SELECT t.trip_id, p.reading_id, p.wind FROM trips t LEFT JOIN pick p ON p.trip_id = t.trip_id)
SELECT count(*) AS n_rows, count(reading_id) AS n_reading_id, count(wind) AS n_wind,
       round(count(reading_id) / count(*), 6) AS rate_reading_id, round(count(wind) / count(*), 6) AS rate_wind FROM j"""))
def q_match_rate(spark, d):
    fx = Fixtures(spark, d)
    j = joins.asof_join(fx.trips(), fx.readings().select("reading_id", "site", "read_ts", "wind"), "origin", "site",
                        "sched", "read_ts", 7200, 14400, "trip_id", tie="reading_id")
    m = joins.match_rate(j, ["reading_id", "wind"])
    return m.select("n_rows", "n_reading_id", "n_wind", r6(F.col("rate_reading_id")).alias("rate_reading_id"),
                    r6(F.col("rate_wind")).alias("rate_wind"))


_NEAREST_SQL = """
SELECT site_id, station_id, round(distance, 6) AS distance FROM (
  SELECT si.site_id, st.station_id,
    2 * 6371.0 * asin(sqrt(pow(sin(radians(st.lat - si.lat) / 2), 2) + cos(radians(si.lat)) * cos(radians(st.lat)) * pow(sin(radians(st.lon - si.lon) / 2), 2))) AS distance,
    row_number() OVER (PARTITION BY si.site_id ORDER BY round(2 * 6371.0 * asin(sqrt(pow(sin(radians(st.lat - si.lat) / 2), 2) + cos(radians(si.lat)) * cos(radians(st.lat)) * pow(sin(radians(st.lon - si.lon) / 2), 2))), 6), st.station_id) AS rn
  FROM sites si, stations st) WHERE rn = 1"""


@query("nearest_site", with_views(["sites", "stations"], _NEAREST_SQL))
def q_nearest(spark, d):
    fx = Fixtures(spark, d)
    n = joins.nearest(fx.sites(), fx.stations(), "site_id", "lat", "lon", "station_id", "lat", "lon")
    return n.select("site_id", "station_id", r6(F.col("distance")).alias("distance"))


@query("nearest_k", with_views(["sites", "stations"], _NEAREST_SQL.replace("SELECT site_id, station_id, round(distance, 6) AS distance FROM", "SELECT site_id, station_id, round(distance, 6) AS distance, CAST(rn AS INTEGER) AS rank FROM").replace("rn = 1", "rn <= 3")))
def q_nearest_k(spark, d):
    """The three nearest stations of each site."""
    fx = Fixtures(spark, d)
    n = joins.nearest(fx.sites(), fx.stations(), "site_id", "lat", "lon", "station_id", "lat", "lon", k=3)
    return n.select("site_id", "station_id", r6(F.col("distance")).alias("distance"), "rank")


@query("augment_pairs", with_views(["sites", "stations"], _NEAREST_SQL))
def q_augment(spark, d):
    fx = Fixtures(spark, d)
    first = joins.nearest(fx.sites().filter("site_id < 10"), fx.stations(), "site_id", "lat", "lon", "station_id", "lat", "lon")
    out = joins.augment_pairs(first, fx.sites(), fx.stations(), "site_id", "lat", "lon", "station_id", "lat", "lon")
    return out.select("site_id", "station_id", r6(F.col("distance")).alias("distance"))


_RANK1 = """
SELECT t.trip_id, r.reading_id FROM {trips} t LEFT JOIN (
  SELECT site, day, reading_id FROM (
    SELECT site, CAST(read_ts AS DATE) AS day, reading_id,
           row_number() OVER (PARTITION BY site, CAST(read_ts AS DATE) ORDER BY read_ts DESC, reading_id DESC) AS rn
    FROM {readings}) WHERE rn = 1) r
ON r.site = t.origin AND r.day = CAST(t.sched AS DATE)"""


@query("rank1_sql", with_views(["trips", "readings"], _RANK1.format(trips="trips", readings="readings")))
def q_rank1(spark, d):
    """Rank-1 subquery join as SQL (day's last reading at the origin)."""
    fx = Fixtures(spark, d)
    fx.trips().createOrReplaceTempView("lt_trips")
    fx.readings().createOrReplaceTempView("lt_readings")
    return spark.sql(_RANK1.format(trips="lt_trips", readings="lt_readings"))


@query("semi_reduce", with_views(["trips", "readings"], """
SELECT reading_id FROM readings r WHERE EXISTS (
  SELECT 1 FROM trips t WHERE t.origin = r.site AND CAST(r.read_ts AS DATE) BETWEEN CAST(t.sched - INTERVAL 4 HOUR AS DATE)
    AND CAST(t.sched - INTERVAL 2 HOUR AS DATE)
    AND (CAST(r.read_ts AS DATE) = CAST(t.sched - INTERVAL 4 HOUR AS DATE) OR CAST(r.read_ts AS DATE) = CAST(t.sched - INTERVAL 2 HOUR AS DATE)))"""))
def q_semi(spark, d):
    from leadtime.functions.timeops import hours_before
    fx = Fixtures(spark, d)
    t = fx.trips().select("origin", hours_before("sched", 4).alias("lo"), hours_before("sched", 2).alias("hi"))
    keys = joins.day_keys(t, "origin", "lo", "hi")
    r = fx.readings().withColumn("day", F.to_date("read_ts")).withColumnRenamed("site", "site")
    return joins.semi_reduce(r, keys, ["site", "day"]).select("reading_id")


@query("asof_dest_role", with_views(["trips", "readings"], """
SELECT t.trip_id, p.reading_id FROM trips t LEFT JOIN (
  SELECT trip_id, reading_id FROM (
    SELECT t.trip_id, r.reading_id,
           row_number() OVER (PARTITION BY t.trip_id ORDER BY r.read_ts DESC, r.reading_id DESC) AS rn
    FROM trips t JOIN readings r
      ON r.site = t.dest AND r.read_ts >= t.sched - INTERVAL 4 HOUR AND r.read_ts <= t.sched - INTERVAL 2 HOUR) WHERE rn = 1) p
ON p.trip_id = t.trip_id"""))
def q_asof_dest(spark, d):
    fx = Fixtures(spark, d)
    j = joins.asof_join(fx.trips(), fx.readings().select("reading_id", "site", "read_ts"), "dest", "site",
                        "sched", "read_ts", 7200, 14400, "trip_id", tie="reading_id", bucket_s=3600)
    return j.select("trip_id", "reading_id")


def _nbrs(fx):
    return fx.readings().select("site").distinct().select("site", ((F.col("site") + 1) % 5).alias("neighbor"))


_NBR_BASE = """,
src AS (SELECT site AS nk, read_ts AS nt, reading_id AS nid, wind AS nv FROM readings WHERE wind IS NOT NULL),
cand AS (SELECT r.reading_id, s.nv, row_number() OVER (PARTITION BY r.reading_id ORDER BY {order}) AS rn
         FROM readings r JOIN src s ON s.nk = (r.site + 1) % 5 AND {cond})
SELECT r.reading_id, round(coalesce(r.wind, c.nv), 6) AS wind
FROM readings r LEFT JOIN (SELECT * FROM cand WHERE rn = 1) c ON c.reading_id = r.reading_id"""


@query("fill_from_neighbor", with_views(["readings"], _NBR_BASE.format(
    order="abs(epoch_us(s.nt) - epoch_us(r.read_ts)), s.nt DESC, s.nid DESC",
    cond="s.nt BETWEEN r.read_ts - INTERVAL 24 HOUR AND r.read_ts + INTERVAL 24 HOUR")))
def q_fill_nbr(spark, d):
    fx = Fixtures(spark, d)
    out = joins.fill_from_neighbor(fx.readings(), _nbrs(fx), "site", "read_ts", ["wind"], "reading_id")
    return out.select("reading_id", r6(F.col("wind")).alias("wind"))


@query("fill_from_neighbor_aged", with_views(["readings"], _NBR_BASE.format(
    order="s.nt DESC, s.nid DESC",
    cond="s.nt BETWEEN r.read_ts - INTERVAL 4 HOUR AND r.read_ts - INTERVAL 2 HOUR")))
def q_fill_nbr_aged(spark, d):
    fx = Fixtures(spark, d)
    out = joins.fill_from_neighbor(fx.readings(), _nbrs(fx), "site", "read_ts", ["wind"], "reading_id",
                                   min_age_s=7200, max_age_s=14400)
    return out.select("reading_id", r6(F.col("wind")).alias("wind"))


_MANY = ["wind", "gust", "temp"]
_MANY_VIEW = """,
rm AS (SELECT *, CASE WHEN reading_id % 3 = 0 THEN NULL ELSE wind * 2 END AS gust, CASE WHEN reading_id % 13 < 9 THEN reading_id % 40 + 0.0::DOUBLE END AS temp FROM readings)"""


def _many(fx):
    i = F.col("reading_id")
    return fx.readings().withColumns({"gust": F.when(i % 3 != 0, F.col("wind") * 2), "temp": F.when(i % 13 < 9, (i % 40).cast("double"))})


def _many_sql(order, cond):
    parts = [f"""c{i} AS (SELECT r.reading_id, s.{c} AS v, row_number() OVER (PARTITION BY r.reading_id ORDER BY {order}) AS rn
  FROM rm r JOIN rm s ON s.site = (r.site + 1) % 5 AND s.{c} IS NOT NULL AND {cond} WHERE r.{c} IS NULL)""" for i, c in enumerate(_MANY)]
    cols = ", ".join(f"round(coalesce(r.{c}, c{i}.v), 6) AS {c}" for i, c in enumerate(_MANY))
    joined = " ".join(f"LEFT JOIN c{i} ON c{i}.reading_id = r.reading_id AND c{i}.rn = 1" for i in range(len(_MANY)))
    return _MANY_VIEW + ",\n" + ",\n".join(parts) + f"\nSELECT r.reading_id, {cols} FROM rm r {joined}"


@query("fill_from_neighbor_many", with_views(["readings"], _many_sql(
    "abs(epoch_us(s.read_ts) - epoch_us(r.read_ts)), s.read_ts DESC, s.reading_id DESC",
    "s.read_ts BETWEEN r.read_ts - INTERVAL 6 HOUR AND r.read_ts + INTERVAL 6 HOUR")))
def q_fill_nbr_many(spark, d):
    """J12 for three measures in one scan."""
    fx = Fixtures(spark, d)
    out = joins.fill_from_neighbor(_many(fx), _nbrs(fx), "site", "read_ts", _MANY, "reading_id", tolerance_s=6 * 3600)
    return out.select("reading_id", *[r6(F.col(c)).alias(c) for c in _MANY])


@query("fill_from_neighbor_same_hour", with_views(["readings"], """,
rr AS (SELECT *, date_trunc('hour', read_ts) AS hr FROM readings),
src AS (SELECT site AS nk, hr AS nt, reading_id AS nid, wind AS nv FROM rr WHERE wind IS NOT NULL),
cand AS (SELECT r.reading_id, s.nv, row_number() OVER (PARTITION BY r.reading_id ORDER BY s.nid DESC) AS rn
         FROM rr r JOIN src s ON s.nk = (r.site + 1) % 5 AND s.nt = r.hr)
SELECT r.reading_id, round(coalesce(r.wind, c.nv), 6) AS wind
FROM rr r LEFT JOIN (SELECT * FROM cand WHERE rn = 1) c ON c.reading_id = r.reading_id"""))
def q_fill_nbr_hour(spark, d):
    fx = Fixtures(spark, d)
    r = fx.readings().withColumn("hr", F.date_trunc("hour", "read_ts"))
    out = joins.fill_from_neighbor(r, _nbrs(fx), "site", "hr", ["wind"], "reading_id", tolerance_s=None)
    return out.select("reading_id", r6(F.col("wind")).alias("wind"))


@query("match_any", with_views(["trips"], """
SELECT t.trip_id, b.c_custkey FROM trips t LEFT JOIN (
  SELECT trip_id, c_custkey FROM (
    SELECT t.trip_id, c.c_custkey, row_number() OVER (PARTITION BY t.trip_id ORDER BY c.c_acctbal DESC, c.c_custkey, c.c_nationkey) AS rn
    FROM trips t JOIN customer c ON c.c_custkey = t.entity OR c.c_nationkey = t.entity % 7) WHERE rn = 1) b
ON b.trip_id = t.trip_id"""))
def q_match_any(spark, d):
    fx = Fixtures(spark, d)
    t = fx.trips().select("trip_id", "entity", (F.col("entity") % 7).alias("ent7"))
    c = fx.table("customer").select("c_custkey", "c_nationkey", "c_acctbal")
    out = joins.match_any(t, c, [("entity", "c_custkey"), ("ent7", "c_nationkey")], "trip_id", "c_acctbal")
    return out.select("trip_id", "c_custkey")


@query("match_any_dated", with_views(["trips"], """,
h AS (SELECT o_orderkey, o_custkey, o_custkey % 7 AS cust7, TIMESTAMP '2024-01-01' + to_days(CAST(o_orderkey % 28 AS INTEGER)) AS begin_ts,
      TIMESTAMP '2024-01-01' + to_days(CAST(o_orderkey % 28 + o_custkey % 5 AS INTEGER)) + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS end_ts FROM orders)
SELECT t.trip_id, b.o_orderkey, b.begin_ts FROM trips t LEFT JOIN (
  SELECT trip_id, o_orderkey, begin_ts FROM (
    SELECT t.trip_id, h.*, row_number() OVER (PARTITION BY t.trip_id ORDER BY h.begin_ts DESC, h.o_orderkey) AS rn
    FROM trips t JOIN h ON (h.o_custkey = t.entity OR h.cust7 = t.entity % 9) AND t.sched BETWEEN h.begin_ts AND h.end_ts) WHERE rn = 1) b
ON b.trip_id = t.trip_id"""))
def q_match_any_dated(spark, d):
    """Station history valid at the time of the trip, by either key."""
    fx = Fixtures(spark, d)
    t = fx.trips().select("trip_id", "sched", "entity", (F.col("entity") % 9).alias("ent9"))
    day = F.lit("2024-01-01").cast("timestamp")
    begin = day + F.make_dt_interval((F.col("o_orderkey") % 28).cast("int"))
    end = begin + F.make_dt_interval((F.col("o_custkey") % 5).cast("int"), (F.col("o_orderkey") % 24).cast("int"))
    h = fx.table("orders").select("o_orderkey", "o_custkey", (F.col("o_custkey") % 7).alias("cust7"), begin.alias("begin_ts"), end.alias("end_ts"))
    out = joins.match_any(t, h, [("entity", "o_custkey"), ("ent9", "cust7")], None, "begin_ts", "begin_ts", "end_ts", "sched")
    return out.select("trip_id", "o_orderkey", "begin_ts")


@query("assign_intervals", with_views(["trips", "folds"], """
SELECT t.trip_id, f.fold FROM trips t JOIN folds f ON t.sched >= f.lo AND t.sched < f.hi"""))
def q_assign(spark, d):
    fx = Fixtures(spark, d)
    return joins.assign_intervals(fx.trips(), fx.folds(), "sched").select("trip_id", "fold")


@query("apply_seasonality", with_views(["trips"], """,
base AS (SELECT origin, avg(delay_min) AS b FROM trips GROUP BY origin),
wk AS (SELECT t.origin, dayofweek(sched) + 1 AS dow, avg(delay_min) - any_value(b.b) AS weekly FROM trips t JOIN base b USING (origin) GROUP BY 1, 2),
dy AS (SELECT t.origin, hour(sched) AS hour, avg(delay_min) - any_value(b.b) AS daily FROM trips t JOIN base b USING (origin) GROUP BY 1, 2),
yr AS (SELECT t.origin, month(sched) AS month, avg(delay_min) - any_value(b.b) AS yearly FROM trips t JOIN base b USING (origin) GROUP BY 1, 2),
hd AS (SELECT t.origin, month(sched) AS month, day(sched) AS dom, avg(delay_min) AS m FROM trips t GROUP BY 1, 2, 3)
SELECT t.trip_id, round(wk.weekly, 6) + 0.0 AS weekly, round(dy.daily, 6) + 0.0 AS daily, round(yr.yearly, 6) + 0.0 AS yearly,
       round(hd.m - b.b - yr.yearly, 6) + 0.0 AS holidays
FROM trips t JOIN base b ON b.origin = t.origin
LEFT JOIN wk ON wk.origin = t.origin AND wk.dow = dayofweek(t.sched) + 1
LEFT JOIN dy ON dy.origin = t.origin AND dy.hour = hour(t.sched)
LEFT JOIN yr ON yr.origin = t.origin AND yr.month = month(t.sched)
LEFT JOIN hd ON hd.origin = t.origin AND hd.month = month(t.sched) AND hd.dom = day(t.sched)"""))
def q_apply_season(spark, d):
    t = Fixtures(spark, d).trips()
    weekly, yearly = ss.seasonal_means(t, "origin", "sched", "delay_min")
    out = joins.apply_seasonality(t, weekly, yearly, "origin", "sched")
    return out.select("trip_id", *[(r6(F.col(c)) + 0.0).alias(c) for c in ["weekly", "daily", "yearly", "holidays"]])


@query("join_back", with_views(["trips"], """,
a AS (SELECT origin, CAST(sched AS DATE) AS day, count(*) AS day_n FROM trips GROUP BY 1, 2)
SELECT t.trip_id, a.day_n FROM trips t LEFT JOIN a ON a.origin = t.origin AND a.day = CAST(t.sched AS DATE)"""))
def q_join_back(spark, d):
    t = Fixtures(spark, d).trips().withColumn("day", F.to_date("sched"))
    a = t.groupBy("origin", "day").agg(F.count(F.lit(1)).alias("day_n"))
    return joins.join_back(t, a, ["origin", "day"]).select("trip_id", "day_n")


@query("merge_counts", with_views(["trips"], """
SELECT origin, count(*) FILTER (WHERE cancelled = 0) AS n_0, count(*) FILTER (WHERE cancelled = 1) AS n_1
FROM trips GROUP BY origin"""))
def q_merge_counts(spark, d):
    return joins.merge_counts(Fixtures(spark, d).trips(), "origin", "cancelled", [0, 1])


@query("history_avg_selfjoin", with_views(["trips"], """
SELECT trip_id, round(avg(CASE WHEN cancelled = 0 THEN delay_min END) OVER (PARTITION BY origin, dest ORDER BY sched
       RANGE BETWEEN INTERVAL 72 HOUR PRECEDING AND CURRENT ROW EXCLUDE GROUP), 6) AS hist_avg
FROM trips"""))
def q_hist_selfjoin(spark, d):
    t = Fixtures(spark, d).trips()
    out = joins.history_avg_selfjoin(t, ["origin", "dest"], "sched", "delay_min", F.col("cancelled") == 0, 72 * 3600, "trip_id")
    return out.select("trip_id", r6(F.col("hist_avg")).alias("hist_avg"))


@query("attach_wide", with_views(["trips", "folds"], """,
lng AS (SELECT f.fold, t.entity, count(*) AS n FROM trips t JOIN folds f ON t.sched >= f.lo AND t.sched < f.hi GROUP BY 1, 2)
SELECT t.trip_id, l0.n AS cnt_0, l1.n AS cnt_1, l2.n AS cnt_2, l3.n AS cnt_3 FROM trips t
LEFT JOIN lng l0 ON l0.entity = t.entity AND l0.fold = 0 LEFT JOIN lng l1 ON l1.entity = t.entity AND l1.fold = 1
LEFT JOIN lng l2 ON l2.entity = t.entity AND l2.fold = 2 LEFT JOIN lng l3 ON l3.entity = t.entity AND l3.fold = 3"""))
def q_attach_wide(spark, d):
    fx = Fixtures(spark, d)
    t = fx.trips()
    lng = joins.assign_intervals(t, fx.folds(), "sched").groupBy("fold", "entity").agg(F.count(F.lit(1)).alias("n"))
    return joins.attach_wide(t, lng, "entity", "fold", "n", [0, 1, 2, 3], "cnt_").select(
        "trip_id", "cnt_0", "cnt_1", "cnt_2", "cnt_3")


@query("align_predictions", with_views(["scored"], """
SELECT a.event_id, a.pred1, b.pred2, b.user_id FROM scored a JOIN scored b ON a.event_id = b.event_id AND a.ts = b.ts"""))
def q_align(spark, d):
    s = Fixtures(spark, d).scored()
    a = s.select("event_id", "ts", "pred1")
    b = s.select("event_id", "ts", "pred2", "user_id")
    return joins.align_predictions(a, b, ["event_id", "ts"]).select("event_id", "pred1", "pred2", "user_id")


@query("expand_neighbors", with_views(["sites"], """
SELECT s.site_id, p.s_suppkey AS station_id FROM sites s LEFT JOIN supplier p ON p.s_nationkey = s.site_id"""))
def q_expand(spark, d):
    fx = Fixtures(spark, d)
    nb = fx.table("supplier").select(F.col("s_nationkey").alias("site_id"), F.col("s_suppkey").alias("station_id"))
    return joins.expand_neighbors(fx.sites(), nb, "site_id").select("site_id", "station_id")


@query("dedup_keep_non", with_views(["wide_nulls"], """
SELECT l_orderkey, l_linenumber, l_suppkey, l_returnflag FROM (
  SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM wide_nulls)
WHERE n = 1 OR NOT coalesce(l_returnflag = 'R', false)"""))
def q_dedup_keep(spark, d):
    w = Fixtures(spark, d).wide_nulls()
    out = joins.dedup_keep_non(w, ["l_orderkey", "l_linenumber"], "l_returnflag", "R")
    return out.select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag")


@query("overlap", with_views(["trips", "readings"], """
SELECT trip_id FROM trips t WHERE EXISTS (SELECT 1 FROM readings r WHERE r.site = t.origin
  AND CAST(r.read_ts AS DATE) = CAST(t.sched AS DATE) AND r.wind > 300)"""))
def q_overlap(spark, d):
    fx = Fixtures(spark, d)
    t = fx.trips().withColumn("day", F.to_date("sched")).withColumnRenamed("origin", "site")
    r = fx.readings().filter("wind > 300").withColumn("day", F.to_date("read_ts"))
    return joins.overlap(t, r, ["site", "day"]).select("trip_id")


@query("enrich_events", with_views(["trips", "sites", "stations", "readings"], """,
nn AS (""" + _NEAREST_SQL + """),
tu AS (SELECT t.trip_id, t.origin, t.dest, s.zone AS origin_zone, nn.station_id AS origin_station_id,
         """ + utc_sql('s.zone', 't.sched') + """ AT TIME ZONE 'UTC' AS sched_utc
       FROM trips t LEFT JOIN sites s ON s.site_id = t.origin LEFT JOIN nn ON nn.site_id = t.origin),
pick AS (SELECT trip_id, reading_id FROM (
    SELECT t.trip_id, r.reading_id, row_number() OVER (PARTITION BY t.trip_id ORDER BY r.read_ts DESC, r.reading_id DESC) AS rn
    FROM tu t JOIN readings r ON r.site = t.origin AND r.read_ts >= t.sched_utc - INTERVAL 4 HOUR
      AND r.read_ts <= t.sched_utc - INTERVAL 2 HOUR) WHERE rn = 1)
SELECT tu.trip_id, tu.origin_zone, tu.origin_station_id, epoch_us(tu.sched_utc) AS sched_utc_us, p.reading_id AS w_reading_id
FROM tu LEFT JOIN pick p ON p.trip_id = tu.trip_id"""))
def q_enrich(spark, d):
    fx = Fixtures(spark, d)
    out = ft.enrich_events(fx.trips(), fx.sites(), fx.stations(), fx.readings().select("reading_id", "site", "read_ts", "wind"))
    return out.select("trip_id", "origin_zone", "origin_station_id", F.unix_micros("sched_utc").alias("sched_utc_us"),
                      "w_reading_id")


@query("clean_readings", with_views(["readings", "sites"], """
SELECT reading_id, zone, epoch_us(""" + utc_sql('zone', 'read_ts') + """) AS utc_us FROM (
  SELECT r.*, s.zone, row_number() OVER (PARTITION BY r.site, r.read_ts ORDER BY
      CASE WHEN r.wind IS NULL THEN 1 ELSE 0 END, r.reading_id) AS rn
  FROM readings r LEFT JOIN sites s ON s.site_id = r.site) WHERE rn = 1"""))
def q_clean_readings(spark, d):
    fx = Fixtures(spark, d)
    out = ft.clean_readings(fx.readings(), fx.sites(), "site", "read_ts", ["wind"], "reading_id", "site_id", "zone")
    return out.select("reading_id", "zone", F.unix_micros("read_ts_utc").alias("utc_us"))


@query("attach_zone", with_views(["sites", "stations"], """
SELECT st.station_id, coalesce(s.zone, 'Unknown') AS zone
FROM stations st
LEFT JOIN (SELECT station_id AS sid, site_id FROM (
   SELECT st.station_id, si.site_id, row_number() OVER (PARTITION BY st.station_id ORDER BY
     round(2 * 6371.0 * asin(sqrt(pow(sin(radians(si.lat - st.lat) / 2), 2) + cos(radians(st.lat)) * cos(radians(si.lat)) * pow(sin(radians(si.lon - st.lon) / 2), 2))), 6), si.site_id) AS rn
   FROM stations st, sites si) WHERE rn = 1) p ON p.sid = st.station_id
LEFT JOIN sites s ON s.site_id = p.site_id"""))
def q_attach_zone(spark, d):
    """zone of the nearest zone point (sites carry the zone names)."""
    fx = Fixtures(spark, d)
    out = ft.attach_zone(fx.stations(), "station_id", "lat", "lon", fx.sites(), "site_id", "lat", "lon", "zone")
    return out.select("station_id", "zone")


@query("modelling_table")
def q_modelling_table(spark, d):
    """The whole feature flow end to end (rows-only: each stage has its own
    oracle-checked query)."""
    fx = Fixtures(spark, d)
    t = fx.trips().withColumn("period", F.floor(F.datediff(F.to_date("sched"), F.lit("2024-01-01").cast("date")) / 7).cast("long"))
    out = ft.feature_table(t, fx.sites(), fx.stations(), fx.readings().select("reading_id", "site", "read_ts", "wind"),
                           fx.holidays(), period="period")
    keep = ["trip_id", "label", "origin_zone", "w_reading_id", "w_wind", "prior_valid", "prior_turnaround",
            "prior_depdelay_calc", "mean_dep_delay", "prop_delayed", "lag_mean_delay", "days_to_holiday",
            "hour_sin", "dow_cos", "prev_rank"]
    return out.select(*keep)

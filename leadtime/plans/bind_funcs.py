"""Registered queries: scalar functions (F1-F32)."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadtime.functions import geo, text, timeops as tm
from leadtime.operators.sets import top_k_per_group
from leadtime.plans.fixtures import Fixtures, with_views
from leadtime.plans.registry import query


def r6(c):
    return F.round(c, 6)


@query("station_code", "SELECT s_suppkey, right(s_name, 5) AS code FROM supplier")
def q_station_code(spark, d):
    s = Fixtures(spark, d).table("supplier")
    return s.select("s_suppkey", text.station_code("s_name").alias("code"))


_WIND = r"\b(\d{3})(\d{2,3})(?:G(\d{2,3}))?KT\b"


@query("metar_wind_gust", with_views(["readings"], r"""
SELECT reading_id,
  coalesce(wind, TRY_CAST(NULLIF(regexp_extract(remark, '\b(\d{3})(\d{2,3})(?:G(\d{2,3}))?KT\b', 2), '') AS DOUBLE)) AS wind_filled,
  TRY_CAST(NULLIF(regexp_extract(remark, '\b(\d{3})(\d{2,3})(?:G(\d{2,3}))?KT\b', 2), '') AS DOUBLE) AS wind_parsed,
  greatest(TRY_CAST(NULLIF(regexp_extract(remark, '\b(\d{3})(\d{2,3})(?:G(\d{2,3}))?KT\b', 3), '') AS DOUBLE),
           TRY_CAST(NULLIF(regexp_extract(remark, 'PK WND (\d{3})(\d{2,3})/(\d{4})', 2), '') AS DOUBLE)) AS gust
FROM readings"""))
def q_metar_wind(spark, d):
    r = Fixtures(spark, d).readings()
    return r.select("reading_id", text.metar_wind_speed("remark", "wind").alias("wind_filled"),
                    text.metar_wind_speed("remark").alias("wind_parsed"), text.metar_gust("remark").alias("gust"))


def _raw_precip(rid):
    m = rid % 6
    return (F.when(m == 0, F.lit(None).cast("string")).when(m == 1, "*").when(m == 2, "T")
            .when(m == 3, "0.05T").when(m == 4, F.format_string("%d.%02d", rid % 3, rid % 100)).otherwise("x"))


@query("metar_precip", with_views(["readings"], r"""
SELECT reading_id, round(CASE WHEN raw IS NULL OR raw = '*'
            THEN TRY_CAST(NULLIF(regexp_extract(remark, ' P(\d+)', 1), '') AS DOUBLE) * 0.01
            ELSE TRY_CAST(NULLIF(regexp_extract(replace(raw, 'T', '0.01'), '(\d+\.?\d*)', 1), '') AS DOUBLE) END, 6) AS precip
FROM (SELECT reading_id, remark,
        CASE reading_id % 6 WHEN 0 THEN NULL WHEN 1 THEN '*' WHEN 2 THEN 'T' WHEN 3 THEN '0.05T'
             WHEN 4 THEN printf('%d.%02d', reading_id % 3, reading_id % 100) ELSE 'x' END AS raw
      FROM readings)"""))
def q_metar_precip(spark, d):
    r = Fixtures(spark, d).readings().withColumn("raw", _raw_precip(F.col("reading_id")))
    return r.select("reading_id", r6(text.metar_precip("raw", "remark")).alias("precip"))


@query("metar_station", with_views(["readings"], r"""
SELECT reading_id, NULLIF(regexp_extract(CASE WHEN reading_id % 5 = 0 THEN 'AUTO ' || remark ELSE replace(remark, 'METAR', 'SPECI') END,
                       '(?:METAR|SPECI)\s(\S+)', 1), '') AS station FROM readings"""))
def q_metar_station(spark, d):
    r = Fixtures(spark, d).readings()
    rem = F.when(F.col("reading_id") % 5 == 0, F.concat(F.lit("AUTO "), "remark")).otherwise(
        F.regexp_replace("remark", "METAR", "SPECI"))
    return r.select("reading_id", text.metar_station(rem).alias("station"))


@query("split_pair", with_views(["sites"], """
SELECT site_id, TRY_CAST(split_part(coordinates, ',', 1) AS DOUBLE) AS lat,
       TRY_CAST(split_part(coordinates, ',', 2) AS DOUBLE) AS lon,
       TRY_CAST(split_part(coordinates, ',', 1) AS DOUBLE) AS lon_first_order,
       split_part(region, '-', 2) AS region_code FROM sites"""))
def q_split_pair(spark, d):
    s = Fixtures(spark, d).sites()
    lat, lon = text.split_pair("coordinates", "lat,lon")
    lat2, lon2 = text.split_pair("coordinates", "lon,lat")
    return s.select("site_id", lat.alias("lat"), lon.alias("lon"), lon2.alias("lon_first_order"),
                    text.region_part("region").alias("region_code"))


_LOCAL_SQL = """(CAST(day AS TIMESTAMP) + to_hours(CAST(hhmm // 100 AS BIGINT)) + to_minutes(CAST(hhmm % 100 AS BIGINT)))"""


@query("hhmm_timestamp", with_views(["hhmm"], f"""
SELECT order_id, epoch_us({_LOCAL_SQL}) AS local_us, CAST(hhmm // 100 AS INTEGER) AS hour FROM hhmm"""))
def q_hhmm(spark, d):
    h = Fixtures(spark, d).hhmm()
    return h.select("order_id", F.unix_micros(tm.hhmm_timestamp("day", "hhmm")).alias("local_us"),
                    tm.hhmm_hour("hhmm").alias("hour"))


def utc_sql(zone: str, local: str) -> str:
    """Local wall-clock -> UTC in DuckDB with the JVM rule for repeated
    (fall-back) hours: the earlier instant."""
    u = f"timezone({zone}, {local})"
    return (f"(CASE WHEN ({u} - INTERVAL 1 HOUR) AT TIME ZONE {zone} = {local} "
            f"THEN {u} - INTERVAL 1 HOUR ELSE {u} END)")


@query("to_utc", with_views(["hhmm", "sites"], f"""
SELECT h.order_id, epoch_us({utc_sql('s.zone', _LOCAL_SQL.replace('day', 'h.day').replace('hhmm', 'h.hhmm'))}) AS utc_us
FROM hhmm h LEFT JOIN sites s ON s.site_id = h.site"""))
def q_to_utc(spark, d):
    fx = Fixtures(spark, d)
    h = fx.hhmm().join(fx.sites().select(F.col("site_id").alias("site"), "zone"), "site", "left")
    return h.select("order_id", F.unix_micros(tm.to_utc(tm.hhmm_timestamp("day", "hhmm"), "zone")).alias("utc_us"))


@query("roll_arrival", with_views(["hhmm"], f"""
SELECT order_id, epoch_us(CASE WHEN dep > arr THEN arr + INTERVAL 1 DAY ELSE arr END) AS arr_us FROM (
  SELECT order_id, {_LOCAL_SQL} AS dep,
         CAST(day AS TIMESTAMP) + to_hours(CAST((order_id * 7) % 24 AS BIGINT)) + to_minutes(CAST(order_id % 53 AS BIGINT)) AS arr
  FROM hhmm)"""))
def q_roll(spark, d):
    h = Fixtures(spark, d).hhmm().withColumn("arr_hhmm", ((F.col("order_id") * 7) % 24 * 100 + F.col("order_id") % 53).cast("int"))
    h = h.select("order_id", tm.hhmm_timestamp("day", "hhmm").alias("dep"), tm.hhmm_timestamp("day", "arr_hhmm").alias("arr"))
    return h.select("order_id", F.unix_micros(tm.roll_arrival("dep", "arr")).alias("arr_us"))


@query("time_arith", with_views(["trips"], """
SELECT trip_id, epoch_us(sched - INTERVAL 2 HOUR) AS t2_us, epoch_us(sched - INTERVAL 4 HOUR) AS t4_us,
       epoch_us(sched - INTERVAL 26 HOUR) AS t26_us,
       epoch_us(sched) + CAST(coalesce(delay_min, 0) * 60000000 AS BIGINT) AS actual_us,
       round((CAST(coalesce(delay_min, 0) * 60000000 AS BIGINT)) / 60000000.0, 6) AS elapsed_min,
       round(delay_min, 6) AS interval_min
FROM trips"""))
def q_time_arith(spark, d):
    t = Fixtures(spark, d).trips()
    t = t.withColumn("actual", tm.actual_time("sched", "delay_min"))
    return t.select("trip_id", F.unix_micros(tm.hours_before("sched", 2)).alias("t2_us"),
                    F.unix_micros(tm.hours_before("sched", 4)).alias("t4_us"),
                    F.unix_micros(tm.hours_before("sched", 26)).alias("t26_us"),
                    F.unix_micros("actual").alias("actual_us"),
                    r6(tm.elapsed_minutes("sched", "actual")).alias("elapsed_min"),
                    r6(tm.interval_minutes(tm.minutes_interval("delay_min"))).alias("interval_min"))


@query("time_parts", with_views(["trips"], """
SELECT trip_id, CAST(hour(sched) AS INTEGER) AS hour, CAST(dayofweek(sched) + 1 AS INTEGER) AS dow, CAST(month(sched) AS INTEGER) AS month,
       CAST(CAST(sched AS DATE) AS VARCHAR) AS day,
       round(sin(hour(sched) * 2 * pi() / 24), 6) + 0.0 AS hour_sin, round(cos(hour(sched) * 2 * pi() / 24), 6) + 0.0 AS hour_cos,
       round(sin((dayofweek(sched) + 1) * 2 * pi() / 7), 6) + 0.0 AS dow_sin, round(cos((dayofweek(sched) + 1) * 2 * pi() / 7), 6) + 0.0 AS dow_cos
FROM trips"""))
def q_time_parts(spark, d):
    t = Fixtures(spark, d).trips()
    p = tm.time_parts("sched")
    hs, hc = tm.cyclic(p["hour"], 24)
    ds, dc = tm.cyclic(p["dow"], 7)
    return t.select("trip_id", p["hour"].alias("hour"), p["dow"].alias("dow"), p["month"].alias("month"),
                    p["date"].cast("string").alias("day"), (r6(hs) + 0.0).alias("hour_sin"), (r6(hc) + 0.0).alias("hour_cos"),
                    (r6(ds) + 0.0).alias("dow_sin"), (r6(dc) + 0.0).alias("dow_cos"))


@query("time_bucket", with_views(["trips"], """
SELECT trip_id, epoch_us(date_trunc('day', sched)) AS day_us, epoch_us(date_trunc('week', sched)) AS week_us,
       epoch_us(date_trunc('month', sched)) AS month_us, (epoch_us(sched) // 7200000000) * 7200 AS b2h
FROM trips"""))
def q_time_bucket(spark, d):
    t = Fixtures(spark, d).trips()
    return t.select("trip_id", F.unix_micros(tm.time_bucket("sched", "day")).alias("day_us"),
                    F.unix_micros(tm.time_bucket("sched", "week")).alias("week_us"),
                    F.unix_micros(tm.time_bucket("sched", "month")).alias("month_us"),
                    F.unix_seconds(tm.time_bucket("sched", 7200)).alias("b2h"))


@query("distance", with_views(["stations", "sites"], """
SELECT st.station_id,
  round(2 * 6371.0 * asin(sqrt(pow(sin(radians(si.lat - st.lat) / 2), 2) + cos(radians(st.lat)) * cos(radians(si.lat)) * pow(sin(radians(si.lon - st.lon) / 2), 2))), 6) AS km,
  round(2 * 3956.0 * asin(sqrt(pow(sin(radians(si.lat - st.lat) / 2), 2) + cos(radians(st.lat)) * cos(radians(si.lat)) * pow(sin(radians(si.lon - st.lon) / 2), 2))), 6) AS mi,
  round(sqrt(pow(st.lat - si.lat, 2) + pow(st.lon - si.lon, 2)), 6) AS deg
FROM stations st JOIN supplier s ON s.s_suppkey = st.station_id JOIN sites si ON si.site_id = s.s_nationkey"""))
def q_distance(spark, d):
    fx = Fixtures(spark, d)
    st = fx.stations().join(fx.table("supplier").select(F.col("s_suppkey").alias("station_id"), "s_nationkey"), "station_id")
    si = fx.sites().select(F.col("site_id").alias("s_nationkey"), F.col("lat").alias("slat"), F.col("lon").alias("slon"))
    j = st.join(si, "s_nationkey")
    return j.select("station_id", r6(geo.haversine("lat", "lon", "slat", "slon", "km")).alias("km"),
                    r6(geo.haversine("lat", "lon", "slat", "slon", "mi")).alias("mi"),
                    r6(geo.euclidean("lat", "lon", "slat", "slon")).alias("deg"))


def _geohash_sql(lat, lon, n):
    nbits = 5 * n
    nlon, nlat = (nbits + 1) // 2, nbits // 2
    qlat = f"least(CAST(floor(({lat} + 90.0) / 180.0 * {float(1 << nlat)}) AS BIGINT), {(1 << nlat) - 1})"
    qlon = f"least(CAST(floor(({lon} + 180.0) / 360.0 * {float(1 << nlon)}) AS BIGINT), {(1 << nlon) - 1})"
    chars = []
    for ci in range(n):
        terms = []
        for k in range(5):
            i = ci * 5 + k
            q, nb = (qlon, nlon) if i % 2 == 0 else (qlat, nlat)
            terms.append(f"((({q} >> {nb - 1 - i // 2}) & 1) << {4 - k})")
        chars.append(f"substr('{geo.GEOHASH_ALPHABET}', CAST({' + '.join(terms)} + 1 AS INTEGER), 1)")
    return " || ".join(chars)


@query("geohash", with_views(["stations"], f"""
SELECT station_id, {_geohash_sql('lat', 'lon', 5)} AS gh5, {_geohash_sql('lat', 'lon', 2)} AS gh2 FROM stations"""))
def q_geohash(spark, d):
    s = Fixtures(spark, d).stations()
    return s.select("station_id", geo.geohash("lat", "lon", 5).alias("gh5"), geo.geohash("lat", "lon", 2).alias("gh2"))


@query("geohash_bbox", with_views(["stations"], """
SELECT station_id, lat, lon FROM stations"""))
def q_geohash_bbox(spark, d):
    """Decode of a point's own geohash must contain the point: returns the
    point for every station whose box holds it (all of them)."""
    s = Fixtures(spark, d).stations().withColumn("gh", geo.geohash("lat", "lon", 6))
    return s.filter(geo.in_bbox("lat", "lon", geo.geohash_bbox("gh"))).select("station_id", "lat", "lon")


@query("null_count_coalesce", with_views(["wide_nulls"], """
SELECT l_orderkey, l_linenumber,
  (CASE WHEN l_quantity IS NULL THEN 1 ELSE 0 END + CASE WHEN l_extendedprice IS NULL THEN 1 ELSE 0 END
   + CASE WHEN l_discount IS NULL THEN 1 ELSE 0 END + CASE WHEN l_tax IS NULL THEN 1 ELSE 0 END) AS n_null,
  coalesce(l_quantity, l_extendedprice, l_tax) AS first_value FROM wide_nulls"""))
def q_null_count(spark, d):
    w = Fixtures(spark, d).wide_nulls()
    return w.select("l_orderkey", "l_linenumber",
                    text.null_count(["l_quantity", "l_extendedprice", "l_discount", "l_tax"]).alias("n_null"),
                    text.first_non_null(["l_quantity", "l_extendedprice", "l_tax"]).alias("first_value"))


@query("dms_to_decimal", with_views(["stations"], """
SELECT station_id, round(floor(lat) + floor((lat - floor(lat)) * 60) / 60.0
  + round(((lat - floor(lat)) * 60 - floor((lat - floor(lat)) * 60)) * 60) / 3600.0, 6) AS lat_dec FROM stations"""))
def q_dms(spark, d):
    s = Fixtures(spark, d).stations()
    deg = F.floor("lat")
    mins = F.floor((F.col("lat") - deg) * 60)
    secs = F.round(((F.col("lat") - deg) * 60 - mins) * 60)
    return s.select("station_id", r6(geo.dms_to_decimal(deg, mins, secs)).alias("lat_dec"))


@query("holiday_distance", with_views(["trips", "holidays"], """
SELECT t.trip_id, CAST(min(abs(date_diff('day', h.day, CAST(t.sched AS DATE)))) AS INTEGER) AS days_to_holiday,
       CAST(max(CASE WHEN abs(date_diff('day', h.day, CAST(t.sched AS DATE))) <= 3 THEN 1 ELSE 0 END) AS INTEGER) AS in_holiday_week,
       string_agg(CAST(abs(date_diff('day', h.day, CAST(t.sched AS DATE))) AS VARCHAR), ',' ORDER BY h.day) AS days_each
FROM trips t, holidays h GROUP BY t.trip_id"""))
def q_holidays(spark, d):
    from leadtime.plans.features import holiday_distance
    fx = Fixtures(spark, d)
    out = holiday_distance(fx.trips(), F.to_date("sched"), fx.holidays())
    return out.select("trip_id", "days_to_holiday", "in_holiday_week",
                      F.array_join(F.transform("days_each", lambda x: x.cast("string")), ",").alias("days_each"))


@query("last_non_null", with_views(["readings"], """
SELECT site, CAST(CAST(read_ts AS DATE) AS VARCHAR) AS day,
  array_to_string(list_slice(list_filter(list(wind ORDER BY read_ts, reading_id), lambda x: x IS NOT NULL), -3, -1), ',') AS last3
FROM readings GROUP BY 1, 2"""))
def q_last_non_null(spark, d):
    r = Fixtures(spark, d).readings().withColumn("day", F.to_date("read_ts").cast("string"))
    # the last three of a site-day are picked before they are gathered
    top = top_k_per_group(r.filter(F.col("wind").isNotNull()).withColumn("site_day", F.struct("site", "day"))
                          .withColumn("t", F.struct("read_ts", "reading_id")), "site_day", "t", 3, "reading_id")
    last = top.groupBy("site", "day").agg(F.array_sort(F.collect_list(F.struct("read_ts", "reading_id", "wind"))).alias("l"))
    g = r.select("site", "day").distinct().join(last, ["site", "day"], "left")
    last3 = text.last_non_null(F.transform("l", lambda s: s["wind"]), 3)
    return g.select("site", "day", F.coalesce(F.array_join(F.transform(last3, lambda x: x.cast("string")), ","), F.lit("")).alias("last3"))


@query("entries_to_map", with_views(["trips"], """
SELECT origin, dest, count(*) AS n FROM trips GROUP BY origin, dest"""))
def q_entries_map(spark, d):
    t = Fixtures(spark, d).trips()
    g = t.groupBy("origin", "dest").agg(F.count(F.lit(1)).alias("n"))
    m = g.groupBy("origin").agg(F.collect_list(F.struct(F.col("dest").cast("string").alias("k"), F.col("n").alias("v"))).alias("e"))
    m = m.select("origin", text.entries_to_map("e", "k", "v").alias("m"))
    ex = m.select("origin", F.explode(F.map_keys("m")).alias("k"), "m")
    return ex.select("origin", F.col("k").cast("long").alias("dest"), F.col("m")[F.col("k")].alias("n"))


@query("path_residual", with_views(["trips", "scored"], """
SELECT 'p' AS kind, CAST(trip_id AS BIGINT) AS id, CAST(origin AS VARCHAR) || '-' || CAST(dest AS VARCHAR) AS route, NULL::DOUBLE AS resid FROM trips
UNION ALL SELECT 'r', event_id, NULL, round(outcome - p1, 6) FROM scored"""))
def q_path_residual(spark, d):
    fx = Fixtures(spark, d)
    a = fx.trips().select(F.lit("p").alias("kind"), F.col("trip_id").alias("id"),
                          text.path_label(["origin", "dest"]).alias("route"), F.lit(None).cast("double").alias("resid"))
    b = fx.scored().select(F.lit("r").alias("kind"), F.col("event_id").alias("id"), F.lit(None).cast("string").alias("route"),
                           r6(text.residual("outcome", "p1")).alias("resid"))
    return a.unionByName(b)


@query("iso_timestamp", with_views(["readings"], """
SELECT reading_id, epoch_us(date_trunc('second', read_ts)) AS ts_us FROM readings"""))
def q_iso(spark, d):
    r = Fixtures(spark, d).readings()
    s = r.select("reading_id", F.date_format("read_ts", "yyyy-MM-dd'T'HH:mm:ss").alias("iso"))
    return s.select("reading_id", F.unix_micros(tm.iso_timestamp("iso")).alias("ts_us"))

"""Registered queries: flagship, sources, projections/filters, scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadtime.operators import clean, joins
from leadtime.plans.fixtures import Fixtures, with_views
from leadtime.plans.registry import query


def r6(c):
    return F.round(c, 6)


# ---------------------------------------------------------------------------
# Flagship (entry): trips -> t-2h -> as-of reading in [t-4h, t-2h] -> label
# -> disruption share, match rate and mean wind per origin site.

_ASOF_PICK = """
pick AS (
  SELECT trip_id, reading_id, wind, read_ts FROM (
    SELECT t.trip_id, r.reading_id, r.wind, r.read_ts,
           row_number() OVER (PARTITION BY t.trip_id ORDER BY r.read_ts DESC, r.reading_id DESC) AS rn
    FROM trips t JOIN readings r
      ON r.site = t.origin AND r.read_ts >= t.sched - INTERVAL 4 HOUR AND r.read_ts <= t.sched - INTERVAL 2 HOUR
  ) WHERE rn = 1)"""


def _trips_asof(fx: Fixtures):
    trips = fx.trips()
    rd = fx.readings().select("reading_id", "site", "read_ts", "wind")
    return joins.asof_join(trips, rd, "origin", "site", "sched", "read_ts",
                           min_age_s=2 * 3600, max_age_s=4 * 3600, row_id="trip_id", tie="reading_id")


@query("flagship_asof_disruption", with_views(["trips", "readings"], "," + _ASOF_PICK + """
SELECT t.origin, count(*) AS n_trips,
       round(avg(CASE WHEN t.delay_min >= 15 OR t.cancelled = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS disrupted_share,
       count(p.reading_id) AS n_matched, round(avg(p.wind), 6) AS mean_wind
FROM trips t LEFT JOIN pick p ON p.trip_id = t.trip_id GROUP BY t.origin"""))
def flagship(spark, d):
    j = _trips_asof(Fixtures(spark, d))
    j = j.withColumn("label", clean.label("delay_min", "cancelled", 15))
    return j.groupBy("origin").agg(
        F.count(F.lit(1)).alias("n_trips"), r6(F.avg("label")).alias("disrupted_share"),
        F.count("reading_id").alias("n_matched"), r6(F.avg("wind")).alias("mean_wind"))


@query("asof_join", with_views(["trips", "readings"], "," + _ASOF_PICK + """
SELECT t.trip_id, p.reading_id, epoch_us(p.read_ts) AS read_us, p.wind
FROM trips t LEFT JOIN pick p ON p.trip_id = t.trip_id"""))
def q_asof(spark, d):
    j = _trips_asof(Fixtures(spark, d))
    return j.select("trip_id", "reading_id", F.unix_micros("read_ts").alias("read_us"), "wind")


# ---------------------------------------------------------------------------
# Sources (S1, S2, S3, S4, S6-S10, S12)

def _scratch(spark, tag):
    """Fresh folder under the shared checkpoint folder of the session."""
    import os
    import uuid
    from leadtime.session import checkpoint_dir
    return os.path.join(checkpoint_dir(spark), f"{tag}-{uuid.uuid4().hex}")


@query("parquet_scan", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_shipdate < TIMESTAMP '1996-07-01 00:00:00'""")
def q_parquet_scan(spark, d):
    from leadtime.sources.io import load
    li = load(spark, d, "lineitem")
    return li.filter(F.col("l_shipdate") < F.lit("1996-07-01 00:00:00").cast("timestamp_ntz")).select(
        "l_orderkey", "l_linenumber", "l_quantity")


@query("csv_scan", with_views(["trips"], """
SELECT trip_id, carrier, TRY_CAST(CAST(delay_min AS VARCHAR) AS DOUBLE) AS delay_min FROM trips"""))
def q_csv_scan(spark, d):
    from leadtime.sources.io import load_csv
    t = Fixtures(spark, d).trips().select("trip_id", "carrier", "delay_min")
    path = _scratch(spark, "csv")
    t.write.option("header", True).option("compression", "gzip").csv(path)
    raw = load_csv(spark, path)  # all strings, as the reference reads it
    return raw.select(F.col("trip_id").cast("long").alias("trip_id"), "carrier",
                      F.col("delay_min").try_cast("double").alias("delay_min"))


@query("adjacency_scan", with_views(["edges_sparse"], """
SELECT src AS node, count(DISTINCT dst) AS n_nbrs, count(*) AS n_links FROM edges_sparse GROUP BY src"""))
def q_adjacency_scan(spark, d):
    from leadtime.sources.io import load_adjacency
    path = _scratch(spark, "adj")
    Fixtures(spark, d).adjacency().write.text(path)
    a = load_adjacency(spark, path)
    return a.select("node", F.size("nbrs").cast("long").alias("n_nbrs"),
                    F.aggregate(F.map_values("nbrs"), F.lit(0).cast("long"), lambda acc, x: acc + x).alias("n_links"))


STATION_LAYOUT = [("station_id", 1, 6, "long"), ("name", 7, 20, "string"), ("country", 27, 2, "string"),
                  ("lat_deg", 29, 4, "int"), ("lat_min", 33, 3, "int"), ("lat_sec", 36, 3, "int"),
                  ("lon_deg", 39, 5, "int"), ("lon_min", 44, 3, "int"), ("lon_sec", 47, 3, "int"),
                  ("end_date", 50, 8, "date:yyyyMMdd")]


@query("fixed_width_scan", """
SELECT s_suppkey AS station_id, round(24 + s_suppkey % 27 + (s_suppkey % 60) / 60.0 + (s_suppkey % 37) / 3600.0, 6) AS lat,
       round(-((121 - (s_suppkey * 7) % 53) + (s_suppkey % 50) / 60.0 + (s_suppkey % 41) / 3600.0), 6) AS lon
FROM supplier WHERE s_suppkey % 4 <> 0 AND s_suppkey % 9 <> 0""")
def q_fixed_width_scan(spark, d):
    """Write supplier-derived station history as fixed-width text, parse it
    back: DMS -> decimal, country filter (every 4th is 'CA') and an
    active-date filter (every 9th ended in 1999)."""
    from leadtime.sources.io import station_history
    s = Fixtures(spark, d).table("supplier")
    k = F.col("s_suppkey")
    line = F.concat(
        F.lpad(k.cast("string"), 6, " "), F.rpad(F.substring("s_name", 1, 20), 20, " "),
        F.when(k % 4 == 0, "CA").otherwise("US"),
        F.lpad((F.lit(24) + k % 27).cast("string"), 4, " "), F.lpad((k % 60).cast("string"), 3, " "),
        F.lpad((k % 37).cast("string"), 3, " "),
        F.lpad((-(F.lit(121) - (k * 7) % 53)).cast("string"), 5, " "), F.lpad((k % 50).cast("string"), 3, " "),
        F.lpad((k % 41).cast("string"), 3, " "),
        F.when(k % 9 == 0, "19991231").otherwise("20251231"))
    path = _scratch(spark, "fw")
    s.select(line.alias("value")).write.text(path)
    st = station_history(spark.read.text(path), STATION_LAYOUT, active_after="2020-01-01")
    return st.select("station_id", r6(F.col("lat")).alias("lat"), r6(F.col("lon")).alias("lon"))


@query("parquet_sink", with_views(["trips"], "SELECT origin, count(*) AS n FROM trips GROUP BY origin"))
def q_parquet_sink(spark, d):
    from leadtime.sources.io import save
    path = _scratch(spark, "sink")
    save(Fixtures(spark, d).trips(), path, mode="overwrite", partition_by=["origin"])
    back = spark.read.parquet(path)
    return back.groupBy(F.col("origin").cast("long").alias("origin")).agg(F.count(F.lit(1)).alias("n"))


@query("stage_checkpoint", with_views(["trips"], "SELECT carrier, count(*) AS n, round(sum(delay_min), 6) AS s FROM trips GROUP BY carrier"))
def q_stage(spark, d):
    from leadtime.sources.io import stage, stage_to
    t = stage(Fixtures(spark, d).trips())
    t = stage_to(t)
    return t.groupBy("carrier").agg(F.count(F.lit(1)).alias("n"), r6(F.sum("delay_min")).alias("s"))


@query("load_or_compute", with_views(["readings"], "SELECT site, count(*) AS n FROM readings GROUP BY site"))
def q_load_or_compute(spark, d):
    from leadtime.sources.io import load_or_compute
    path = _scratch(spark, "loc")
    fx = Fixtures(spark, d)
    load_or_compute(spark, path, lambda: fx.readings())
    again = load_or_compute(spark, path, lambda: fx.readings().limit(0))  # reused, not recomputed
    return again.groupBy("site").agg(F.count(F.lit(1)).alias("n"))


@query("sql_register", with_views(["trips"], """
SELECT carrier, origin, count(*) AS n FROM trips WHERE cancelled = 0 GROUP BY carrier, origin"""))
def q_sql_register(spark, d):
    from leadtime.sources.io import register
    register(Fixtures(spark, d).trips(), "lt_trips")
    return spark.sql("SELECT carrier, origin, count(*) AS n FROM lt_trips WHERE cancelled = 0 GROUP BY carrier, origin")


@query("dataset_size")
def q_dataset_size(spark, d):
    from leadtime.sources.io import dataset_size
    return dataset_size(spark, d)


@query("profile_stage_counts", with_views(["trips"], """
SELECT 'trips' AS stage, count(*) AS n_rows, CAST(9 AS BIGINT) AS n_cols FROM trips"""))
def q_profile_counts(spark, d):
    from leadtime.sources.io import profile_stage
    return profile_stage(Fixtures(spark, d).trips(), "trips").select("stage", "n_rows", "n_cols")


@query("profile_stage")
def q_profile_stage(spark, d):
    from leadtime.sources.io import profile_stage
    return profile_stage(Fixtures(spark, d).trips(), "trips")


# ---------------------------------------------------------------------------
# Projections and filters

@query("keep_columns", with_views(["trips"], "SELECT trip_id, dest, delay_min, duration_min FROM trips"))
def q_keep(spark, d):
    return clean.keep_columns(Fixtures(spark, d).trips(), ["trip_id"], ["^dest", "_min$"])


@query("drop_columns", with_views(["trips"], "SELECT trip_id, entity, origin, dest, cancelled, delay_min, duration_min FROM trips"))
def q_drop(spark, d):
    return clean.drop_columns(Fixtures(spark, d).trips(), ["carrier", "sched"])


@query("filter_has_outcome", with_views(["trips"], """
SELECT trip_id, delay_min, cancelled FROM trips WHERE delay_min IS NOT NULL OR cancelled = 1"""))
def q_has_outcome(spark, d):
    t = Fixtures(spark, d).trips()
    return clean.filter_has_outcome(t, "delay_min", "cancelled").select("trip_id", "delay_min", "cancelled")


@query("filter_complete", with_views(["readings"], "SELECT reading_id, wind FROM readings WHERE wind IS NOT NULL"))
def q_complete(spark, d):
    return clean.filter_complete(Fixtures(spark, d).readings(), ["wind"]).select("reading_id", "wind")


@query("label", with_views(["trips"], """
SELECT trip_id, CASE WHEN delay_min >= 15 OR cancelled = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label,
       CASE WHEN delay_min IS NULL THEN NULL WHEN delay_min >= 15 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label_nullable
FROM trips"""))
def q_label(spark, d):
    t = Fixtures(spark, d).trips()
    return t.select("trip_id", clean.label("delay_min", "cancelled").alias("label"),
                    clean.label_nullable("delay_min").alias("label_nullable"))


@query("remap_codes", with_views(["trips"], """
SELECT trip_id, CASE WHEN origin = 2 AND carrier = 'C3' THEN 'K3' WHEN carrier = 'C1' THEN 'X1' ELSE carrier END AS carrier
FROM trips"""))
def q_remap(spark, d):
    t = Fixtures(spark, d).trips()
    t = clean.remap(t, "carrier", {"C3": "K3"}, when=F.col("origin") == 2)
    t = clean.remap(t, "carrier", {"C1": "X1"})
    return t.select("trip_id", "carrier")


@query("repair_sentinel", with_views(["trips"], """
SELECT trip_id, CASE WHEN dest = 4 THEN 0 ELSE dest END AS dest FROM trips"""))
def q_repair(spark, d):
    return clean.repair(Fixtures(spark, d).trips(), "dest", 4, 0).select("trip_id", "dest")


@query("outlier_probe", with_views(["readings"], "SELECT reading_id, wind FROM readings WHERE wind > 300"))
def q_outliers(spark, d):
    return clean.outliers(Fixtures(spark, d).readings(), "wind", 300).select("reading_id", "wind")


@query("filter_in", with_views(["trips"], """
SELECT trip_id FROM trips WHERE entity IN (SELECT user_id FROM events WHERE event_type = 'signup' AND value > 100)"""))
def q_filter_in(spark, d):
    fx = Fixtures(spark, d)
    keys = fx.table("events").filter("event_type = 'signup' AND value > 100").select("user_id")
    return clean.filter_in(fx.trips(), keys, "entity", "user_id").select("trip_id")


@query("filter_matches", with_views(["readings"], """
SELECT reading_id FROM readings WHERE contains(remark, 'PK WND') AND regexp_matches(remark, 'G[0-9]{2}KT')"""))
def q_matches(spark, d):
    return clean.filter_matches(Fixtures(spark, d).readings(), "remark", "PK WND", "G[0-9]{2}KT").select("reading_id")


@query("filter_country", "SELECT n_nationkey, n_name FROM nation WHERE right(n_name, 2) = '_1'")
def q_country(spark, d):
    return clean.filter_country(Fixtures(spark, d).table("nation"), "n_name", "_1").select("n_nationkey", "n_name")


@query("select_except", with_views(["sites"], "SELECT site_id, site_name, lat, lon, region FROM sites"))
def q_except(spark, d):
    return clean.select_except(Fixtures(spark, d).sites(), ["coordinates", "zone"])


@query("prefix_columns", with_views(["stations"], """
SELECT station_id AS st_station_id, station_name AS st_station_name, lat AS st_lat, lon AS st_lon FROM stations"""))
def q_prefix(spark, d):
    return clean.prefix(Fixtures(spark, d).stations(), "st_")


@query("rename_columns", with_views(["sites"], """
SELECT site_id AS id, site_name, lat AS latitude, lon AS longitude, zone, coordinates, region FROM sites"""))
def q_rename(spark, d):
    s = Fixtures(spark, d).sites()
    j = s.join(s.select("site_id", "zone"), "site_id")  # duplicate 'zone'
    j = clean.drop_duplicate_names(j)
    return clean.rename(j, {"site_id": "id", "lat": "latitude", "lon": "longitude"})


@query("cast_all", with_views(["trips"], """
SELECT trip_id, TRY_CAST(CAST(origin AS VARCHAR) AS INTEGER) AS o, TRY_CAST(carrier AS INTEGER) AS carrier FROM trips"""))
def q_cast(spark, d):
    t = Fixtures(spark, d).trips().select("trip_id", F.col("origin").cast("string").alias("o"), "carrier")
    return clean.cast_all(t, ["o", "carrier"], "int")


@query("fill_nulls", with_views(["wide_nulls"], """
SELECT l_orderkey, l_linenumber, coalesce(l_quantity, 0.0) AS l_quantity, coalesce(l_tax, -1.0) AS l_tax,
       coalesce(l_discount, 0.0) AS l_discount FROM wide_nulls"""))
def q_fill(spark, d):
    w = Fixtures(spark, d).wide_nulls().select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_discount")
    w = clean.fill(w, {"l_quantity": 0.0, "l_tax": -1.0})
    return clean.fill(w, numeric_value=0.0)


@query("between_range", with_views(["trips"], """
SELECT trip_id FROM trips WHERE sched >= TIMESTAMP '2024-01-05' AND sched < TIMESTAMP '2024-01-10'"""))
def q_between(spark, d):
    t = Fixtures(spark, d).trips()
    return clean.between(t, "sched", F.lit("2024-01-05").cast("timestamp"), F.lit("2024-01-10").cast("timestamp")).select("trip_id")


@query("only_correct", with_views(["scored"], """
SELECT event_id FROM scored WHERE pred1 = outcome AND pred2 <> outcome AND pred3 <> outcome"""))
def q_only_correct(spark, d):
    return clean.only_correct(Fixtures(spark, d).scored(), "outcome", "pred1", ["pred2", "pred3"]).select("event_id")


@query("select_features", """
SELECT l.doc_id, l.quality AS label, d.lang, d.source, d.n_chars FROM labels l JOIN documents d ON d.doc_id = l.doc_id""")
def q_select_features(spark, d):
    """Numeric and categorical feature families picked from the schema."""
    fx = Fixtures(spark, d)
    x = fx.table("labels").select("doc_id", F.col("quality").alias("label")).join(
        fx.table("documents").select("doc_id", "lang", "source", "n_chars", F.col("text").alias("body_text")), "doc_id")
    num, cat = clean.select_features(x, "label", exclude=["doc_id", "body_text"])
    return x.select("doc_id", "label", *cat, *num)

"""Registered queries: aggregations (A1-A28), sets (U1-U5), sort/limit."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadtime.operators import aggregates as ag
from leadtime.operators import clean, sets, windows
from leadtime.plans.fixtures import Fixtures, with_views
from leadtime.plans.registry import query


def r6(c):
    return F.round(c, 6)


_LABEL = "CASE WHEN delay_min >= 15 OR cancelled = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"


def _trips_l(fx):
    return fx.trips().withColumn("label", clean.label("delay_min", "cancelled"))


@query("group_means", """
SELECT l_returnflag, l_linestatus, round(avg(l_quantity), 6) AS mean_l_quantity,
       round(avg(l_extendedprice), 6) AS mean_l_extendedprice FROM lineitem GROUP BY 1, 2""")
def q_group_means(spark, d):
    g = ag.group_means(Fixtures(spark, d).table("lineitem"), ["l_returnflag", "l_linestatus"], ["l_quantity", "l_extendedprice"])
    return g.select("l_returnflag", "l_linestatus", *[r6(F.col(c)).alias(c) for c in ["mean_l_quantity", "mean_l_extendedprice"]])


@query("daily_stats", with_views(["trips"], f"""
SELECT CAST(CAST(sched AS DATE) AS VARCHAR) AS day, round(avg(delay_min), 6) AS mean_delay,
       round(avg({_LABEL}), 6) AS share_disrupted, count(*) AS n FROM trips GROUP BY 1"""))
def q_daily_stats(spark, d):
    g = ag.daily_stats(_trips_l(Fixtures(spark, d)), F.to_date("sched").cast("string"), "delay_min", "label")
    return g.select("day", r6(F.col("mean_delay")).alias("mean_delay"), r6(F.col("share_disrupted")).alias("share_disrupted"), "n")


@query("daily_site_stats", with_views(["trips"], f"""
SELECT origin, CAST(CAST(sched AS DATE) AS VARCHAR) AS day, round(avg(delay_min), 6) AS mean_delay,
       round(avg({_LABEL}), 6) AS share_disrupted, count(*) AS n FROM trips GROUP BY 1, 2"""))
def q_daily_site(spark, d):
    t = _trips_l(Fixtures(spark, d))
    g = t.groupBy("origin", F.to_date("sched").cast("string").alias("day")).agg(
        r6(F.avg("delay_min")).alias("mean_delay"), r6(F.avg("label")).alias("share_disrupted"), F.count(F.lit(1)).alias("n"))
    return g


@query("duplicate_report", """
SELECT count(*) AS dup_groups, CAST(coalesce(sum(n), 0) AS BIGINT) AS dup_rows FROM (
  SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)""")
def q_dups(spark, d):
    return ag.duplicate_report(Fixtures(spark, d).table("lineitem"), ["l_orderkey", "l_linenumber"])


_PROF_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_suppkey"]


def _profile_sql(cols, where=""):
    parts = [f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS n_null, count(*) AS n_rows FROM wide_nulls {where}"
             for c in cols]
    return "\nUNION ALL ".join(parts)


@query("null_profile", with_views(["wide_nulls"], _profile_sql(_PROF_COLS)))
def q_null_profile(spark, d):
    return ag.null_profile(Fixtures(spark, d).wide_nulls(), _PROF_COLS)


@query("null_by_group", with_views(["wide_nulls"], """
SELECT l_returnflag, count(*) FILTER (WHERE l_tax IS NULL) AS n_null, count(l_tax) AS n_present
FROM wide_nulls GROUP BY 1 HAVING count(*) FILTER (WHERE l_tax IS NULL) >= 1"""))
def q_null_by_group(spark, d):
    return ag.null_by_group(Fixtures(spark, d).wide_nulls(), "l_returnflag", "l_tax")


@query("null_cooccurrence", with_views(["wide_nulls"], _profile_sql(["l_extendedprice", "l_discount", "l_tax"],
                                                                     "WHERE l_quantity IS NULL")))
def q_null_cooc(spark, d):
    return ag.null_cooccurrence(Fixtures(spark, d).wide_nulls(), "l_quantity", ["l_extendedprice", "l_discount", "l_tax"])


@query("null_rate", with_views(["readings"], """
SELECT site, round(avg(CASE WHEN wind IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100, 6) AS pct_null FROM readings GROUP BY site"""))
def q_null_rate(spark, d):
    g = ag.null_rate(Fixtures(spark, d).readings(), "site", "wind")
    return g.select("site", r6(F.col("pct_null")).alias("pct_null"))


@query("compare_profiles", with_views(["readings"], """
SELECT 'wind' AS column, count(*) FILTER (WHERE wind IS NULL) AS null_before, count(*) AS rows_before,
  count(*) FILTER (WHERE wf IS NULL) AS null_after, count(*) AS rows_after FROM (
  SELECT wind, coalesce(wind, last_value(wind IGNORE NULLS) OVER (PARTITION BY site ORDER BY read_ts, reading_id
         ROWS BETWEEN 1 PRECEDING AND 1 PRECEDING)) AS wf FROM readings)"""))
def q_compare_profiles(spark, d):
    r = Fixtures(spark, d).readings()
    after = windows.ffill_rows(r, ["site"], "read_ts", "reading_id", "wind", 1)
    return ag.compare_profiles(r.select("wind"), after.select("wind"))


@query("distinct_rows", """
SELECT 'whole' AS kind, count(*) AS n FROM (SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem)
UNION ALL SELECT 'subset', count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)""")
def q_distinct(spark, d):
    li = Fixtures(spark, d).table("lineitem")
    a = ag.distinct_rows(li.select("l_returnflag", "l_linestatus", "l_linenumber")).agg(F.count(F.lit(1)).alias("n"))
    b = ag.distinct_rows(li, ["l_orderkey", "l_linenumber"]).agg(F.count(F.lit(1)).alias("n"))
    return a.select(F.lit("whole").alias("kind"), "n").unionByName(b.select(F.lit("subset").alias("kind"), "n"))


@query("distinct_counts", with_views(["trips"], """
SELECT origin, count(DISTINCT entity) AS n_distinct_entity FROM trips GROUP BY origin"""))
def q_distinct_counts(spark, d):
    return ag.distinct_counts(Fixtures(spark, d).trips(), "origin", "entity")


@query("collect_sets", with_views(["trips"], """
SELECT origin, string_agg(DISTINCT CAST(dest AS VARCHAR), ',' ORDER BY CAST(dest AS VARCHAR)) AS dest_set,
  (SELECT string_agg(x, ',' ORDER BY x) FROM (SELECT DISTINCT CAST(t2.dest AS VARCHAR) || ':' || t2.carrier AS x FROM trips t2 WHERE t2.origin = t.origin AND t2.cancelled = 1)) AS items
FROM trips t GROUP BY origin"""))
def q_collect_sets(spark, d):
    t = Fixtures(spark, d).trips()
    a = ag.collect_sets(t.withColumn("dest", F.col("dest").cast("string")), "origin", "dest")
    b = ag.collect_sets(t.filter("cancelled = 1").withColumn("dest", F.col("dest").cast("string")), "origin", "dest",
                        ["dest", "carrier"])
    b = b.select("origin", F.array_join(F.array_distinct(F.transform("items", lambda s: F.concat(s["dest"], F.lit(":"), s["carrier"]))), ",").alias("items"))
    return a.select("origin", F.array_join("dest_set", ",").alias("dest_set")).join(b, "origin", "left")


@query("pair_counts", with_views(["trips"], """,
k AS (SELECT DISTINCT origin, CAST(sched AS DATE) AS day, carrier FROM trips)
SELECT a.carrier AS item_a, b.carrier AS item_b, count(*) AS n_keys FROM k a JOIN k b
  ON a.origin = b.origin AND a.day = b.day AND a.carrier < b.carrier GROUP BY 1, 2"""))
def q_pairs(spark, d):
    t = Fixtures(spark, d).trips().withColumn("k", F.concat_ws("|", F.col("origin").cast("string"), F.to_date("sched").cast("string")))
    return ag.pair_counts(t, "k", "carrier")


@query("bounds", with_views(["trips"], """
SELECT epoch_us(min(sched)) AS t_min_us, epoch_us(max(sched)) AS t_max_us,
       CAST(date_diff('day', CAST(min(sched) AS DATE), CAST(max(sched) AS DATE)) + 1 AS INTEGER) AS span_days FROM trips"""))
def q_bounds(spark, d):
    b = ag.bounds(Fixtures(spark, d).trips(), "sched")
    return b.select(F.unix_micros("t_min").alias("t_min_us"), F.unix_micros("t_max").alias("t_max_us"), "span_days")


@query("confusion", with_views(["scored"], """
SELECT outcome AS label, pred1 AS prediction, count(*) AS n,
       round(count(*) / sum(count(*)) OVER (PARTITION BY outcome), 6) AS rate FROM scored GROUP BY 1, 2"""))
def q_confusion(spark, d):
    c = ag.confusion_rates(Fixtures(spark, d).scored(), "outcome", "pred1")
    return c.select("label", "prediction", "n", r6(F.col("rate")).alias("rate"))


@query("confusion_by", with_views(["scored"], """
SELECT event_type, count(*) FILTER (WHERE outcome = 1 AND pred1 = 1) AS TP, count(*) FILTER (WHERE outcome = 0 AND pred1 = 0) AS TN,
  count(*) FILTER (WHERE outcome = 0 AND pred1 = 1) AS FP, count(*) FILTER (WHERE outcome = 1 AND pred1 = 0) AS FN,
  count(*) FILTER (WHERE outcome <> pred1) AS errors FROM scored GROUP BY 1"""))
def q_confusion_by(spark, d):
    return ag.confusion_by(Fixtures(spark, d).scored(), "event_type", "outcome", "pred1")


@query("error_rates", with_views(["scored"], """
SELECT user_id % 10 AS grp, count(*) AS n, round(avg(CASE WHEN outcome = 0 AND pred2 = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS fp_rate,
  round(avg(CASE WHEN outcome = 1 AND pred2 = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS fn_rate, round(avg(outcome), 6) AS true_rate
FROM scored GROUP BY 1 HAVING count(*) >= 900"""))
def q_error_rates(spark, d):
    s = Fixtures(spark, d).scored().withColumn("grp", F.col("user_id") % 10)
    e = ag.error_rates(s, "grp", "outcome", "pred2", min_n=900)
    return e.select("grp", "n", *[r6(F.col(c)).alias(c) for c in ["fp_rate", "fn_rate", "true_rate"]])


@query("class_balance", with_views(["trips", "causes"], f"""
SELECT 'label' AS kind, label AS cls, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM (SELECT {_LABEL} AS label FROM trips) GROUP BY label
UNION ALL SELECT 'cause', NULL, NULL, round(avg(CASE WHEN cause_b > 5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) FROM causes WHERE l_returnflag = 'R'"""))
def q_class_balance(spark, d):
    fx = Fixtures(spark, d)
    b = ag.class_balance(_trips_l(fx), "label")
    c = ag.cause_share(fx.causes().withColumn("lab", (F.col("l_returnflag") == "R").cast("int")).withColumn(
        "cb", F.col("cause_b") - 5), "lab", "cb")
    return b.select(F.lit("label").alias("kind"), F.col("label").alias("cls"), "n", r6(F.col("share")).alias("share")).unionByName(
        c.select(F.lit("cause").alias("kind"), F.lit(None).cast("double").alias("cls"), F.lit(None).cast("long").alias("n"),
                 r6(F.col("cause_share")).alias("share")))


@query("cause_breakdown", with_views(["causes"], """
SELECT cause, round(s / tot, 6) AS minute_share, round(n / rows, 6) AS row_share FROM (
  SELECT 'cause_a' AS cause, sum(cause_a) AS s, count(*) FILTER (WHERE cause_a > 0) AS n FROM causes
  UNION ALL SELECT 'cause_b', sum(cause_b), count(*) FILTER (WHERE cause_b > 0) FROM causes
  UNION ALL SELECT 'cause_c', sum(cause_c), count(*) FILTER (WHERE cause_c > 0) FROM causes
  UNION ALL SELECT 'cause_d', sum(cause_d), count(*) FILTER (WHERE cause_d > 0) FROM causes),
  (SELECT sum(cause_a) + sum(cause_b) + sum(cause_c) + sum(cause_d) AS tot, count(*) AS rows FROM causes)"""))
def q_causes(spark, d):
    c = ag.cause_breakdown(Fixtures(spark, d).causes(), ["cause_a", "cause_b", "cause_c", "cause_d"])
    return c.select("cause", r6(F.col("minute_share")).alias("minute_share"), r6(F.col("row_share")).alias("row_share"))


@query("route_means", with_views(["trips"], """
SELECT CAST(origin AS VARCHAR) || '-' || CAST(dest AS VARCHAR) AS route, round(avg(delay_min), 6) AS mean_delay_min, count(*) AS n
FROM trips GROUP BY 1"""))
def q_route_means(spark, d):
    r = ag.route_means(Fixtures(spark, d).trips(), "origin", "dest", "delay_min")
    return r.select("route", r6(F.col("mean_delay_min")).alias("mean_delay_min"), "n")


@query("site_summary", with_views(["trips", "sites"], """
SELECT t.origin, round(avg(t.delay_min), 6) AS mean_delay_min, count(*) AS n, any_value(s.lat) AS lat, any_value(s.lon) AS lon
FROM trips t JOIN sites s ON s.site_id = t.origin GROUP BY t.origin"""))
def q_site_summary(spark, d):
    fx = Fixtures(spark, d)
    t = fx.trips().join(fx.sites().select(F.col("site_id").alias("origin"), "lat", "lon"), "origin")
    s = ag.site_summary(t, "origin", "delay_min", "lat", "lon")
    return s.select("origin", r6(F.col("mean_delay_min")).alias("mean_delay_min"), "n", "lat", "lon")


@query("summary", with_views(["trips"], """
SELECT 'delay_min' AS column, count(delay_min) AS count, round(avg(delay_min), 6) AS mean, round(stddev_samp(delay_min), 6) AS stddev,
  round(min(delay_min), 6) AS min, round(quantile_cont(delay_min, 0.25), 6) AS p25, round(quantile_cont(delay_min, 0.5), 6) AS p50,
  round(quantile_cont(delay_min, 0.75), 6) AS p75, round(max(delay_min), 6) AS max FROM trips
UNION ALL SELECT 'duration_min', count(duration_min), round(avg(duration_min), 6), round(stddev_samp(duration_min), 6),
  round(min(duration_min), 6), round(quantile_cont(duration_min, 0.25), 6), round(quantile_cont(duration_min, 0.5), 6),
  round(quantile_cont(duration_min, 0.75), 6), round(max(duration_min), 6) FROM trips"""))
def q_summary(spark, d):
    s = ag.summary(Fixtures(spark, d).trips(), ["delay_min", "duration_min"])
    return s.select("column", "count", *[r6(F.col(c)).alias(c) for c in ["mean", "stddev", "min", "p25", "p50", "p75", "max"]])


_TEN = {"l_orderkey": "l_orderkey", "l_partkey": "l_partkey", "l_suppkey": "l_suppkey", "l_linenumber": "l_linenumber", "l_quantity": "l_quantity",
        "l_extendedprice": "l_extendedprice", "l_discount": "l_discount", "l_tax": "l_tax",
        "net": "l_extendedprice * (1 - l_discount)", "rare": "CASE WHEN l_orderkey % 97 = 0 THEN l_quantity END"}


@query("summary_ten", "WITH x AS (SELECT " + ", ".join(f"CAST({e} AS DOUBLE) AS {c}" for c, e in _TEN.items()) + " FROM lineitem)\n" + "\nUNION ALL ".join(
    f"""SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev, round(min({c}), 6) AS min,
  round(quantile_cont({c}, 0.01), 6) AS p1, round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.99), 6) AS p99, round(max({c}), 6) AS max FROM x""" for c in _TEN))
def q_summary_ten(spark, d):
    """A22 over ten columns, two scans."""
    x = Fixtures(spark, d).table("lineitem").select(*[F.expr(e).cast("double").alias(c) for c, e in _TEN.items()])
    s = ag.summary(x, list(_TEN), (0.01, 0.5, 0.99))
    return s.select("column", "count", F.round("mean", 4).alias("mean"), F.round("stddev", 4).alias("stddev"),
                    *[r6(F.col(c)).alias(c) for c in ["min", "p1", "p50", "p99", "max"]])


def _avg_rank(c):
    return f"CASE WHEN {c} IS NULL THEN NULL ELSE rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 END"


@query("spearman", with_views(["scored"], f""",
r AS (SELECT {_avg_rank('p1')} AS r1, {_avg_rank('p2')} AS r2, {_avg_rank('p3')} AS r3 FROM scored)
SELECT 'p1' AS a, 'p1' AS b, round(corr(r1, r1), 6) AS rho FROM r UNION ALL SELECT 'p1', 'p2', round(corr(r1, r2), 6) FROM r
UNION ALL SELECT 'p1', 'p3', round(corr(r1, r3), 6) FROM r UNION ALL SELECT 'p2', 'p2', round(corr(r2, r2), 6) FROM r
UNION ALL SELECT 'p2', 'p3', round(corr(r2, r3), 6) FROM r UNION ALL SELECT 'p3', 'p3', round(corr(r3, r3), 6) FROM r"""))
def q_spearman(spark, d):
    s = ag.spearman(Fixtures(spark, d).scored(), ["p1", "p2", "p3"])
    return s.select("a", "b", r6(F.col("rho")).alias("rho"))


@query("histogram", with_views(["trips"], f"""
SELECT CASE WHEN delay_min < -30 THEN 0 WHEN delay_min >= 300 THEN 11 ELSE CAST(floor((delay_min + 30) / 330.0 * 10) AS BIGINT) + 1 END AS bin,
       {_LABEL} AS label, count(*) AS n FROM trips WHERE delay_min IS NOT NULL GROUP BY 1, 2"""))
def q_hist(spark, d):
    h = ag.histogram(_trips_l(Fixtures(spark, d)), "delay_min", -30.0, 300.0, 10, by="label")
    return h.select(F.col("bin").cast("long").alias("bin"), "label", "n")


@query("box_stats", with_views(["trips"], """
SELECT carrier, round(min(delay_min), 6) AS min, round(quantile_cont(delay_min, 0.25), 6) AS q1, round(quantile_cont(delay_min, 0.5), 6) AS median,
  round(quantile_cont(delay_min, 0.75), 6) AS q3, round(max(delay_min), 6) AS max,
  round(quantile_cont(delay_min, 0.25) - 1.5 * (quantile_cont(delay_min, 0.75) - quantile_cont(delay_min, 0.25)), 6) AS lower_whisker,
  round(quantile_cont(delay_min, 0.75) + 1.5 * (quantile_cont(delay_min, 0.75) - quantile_cont(delay_min, 0.25)), 6) AS upper_whisker
FROM trips GROUP BY carrier"""))
def q_box(spark, d):
    b = ag.box_stats(Fixtures(spark, d).trips(), "delay_min", "carrier")
    return b.select("carrier", *[r6(F.col(c)).alias(c) for c in ["min", "q1", "median", "q3", "max", "lower_whisker", "upper_whisker"]])


@query("agg_dict", with_views(["trips"], """
SELECT origin, round(avg(delay_min), 6) AS avg_delay_min, max(duration_min) AS max_duration_min FROM trips GROUP BY origin"""))
def q_agg_dict(spark, d):
    a = ag.agg_dict(Fixtures(spark, d).trips(), "origin", {"delay_min": "avg", "duration_min": "max"})
    return a.select("origin", r6(F.col("avg_delay_min")).alias("avg_delay_min"), "max_duration_min")


@query("value_counts", with_views(["trips"], "SELECT carrier, count(*) AS n FROM trips GROUP BY carrier"))
def q_value_counts(spark, d):
    return ag.value_counts(Fixtures(spark, d).trips(), "carrier")


# ---------------------------------------------------------------------------
# Sets

@query("distinct_values", with_views(["trips"], """
SELECT 'union' AS how, value FROM (SELECT origin AS value FROM trips UNION SELECT dest FROM trips)
UNION ALL SELECT 'explode', value FROM (SELECT DISTINCT unnest([origin, dest]) AS value FROM trips)"""))
def q_distinct_values(spark, d):
    t = Fixtures(spark, d).trips()
    a = sets.distinct_values(t, ["origin", "dest"]).select(F.lit("union").alias("how"), "value")
    b = sets.distinct_exploded(t, ["origin", "dest"]).select(F.lit("explode").alias("how"), "value")
    return a.unionByName(b)


@query("union_all", with_views(["trips"], "SELECT origin, count(*) AS n FROM trips GROUP BY origin"))
def q_union_all(spark, d):
    t = Fixtures(spark, d).trips()
    parts = [t.filter(F.col("origin") % 3 == i) for i in range(3)]
    return sets.union_all(parts).groupBy("origin").agg(F.count(F.lit(1)).alias("n"))


@query("union_aligned", with_views(["stations", "sites"], """
SELECT station_id, station_name, lat, lon FROM stations
UNION ALL SELECT site_id, NULL, lat, lon FROM sites"""))
def q_union_aligned(spark, d):
    fx = Fixtures(spark, d)
    b = fx.sites().select(F.col("site_id").cast("long").alias("station_id"), "lat", "lon")
    return sets.union_aligned(fx.stations(), b)


@query("split_apply_union", with_views(["trips"], """,
a AS (SELECT trip_id, cancelled, lag(trip_id) OVER (PARTITION BY entity ORDER BY sched, trip_id) AS prior_all FROM trips),
f AS (SELECT trip_id, lag(trip_id) OVER (PARTITION BY entity ORDER BY sched, trip_id) AS prior_flown FROM trips WHERE cancelled = 0)
SELECT a.trip_id, CASE WHEN a.cancelled = 1 THEN a.prior_all ELSE f.prior_flown END AS prior_trip_id
FROM a LEFT JOIN f ON f.trip_id = a.trip_id"""))
def q_split_apply(spark, d):
    t = Fixtures(spark, d).trips()
    all_prior = windows.prior_event(t, "entity", "sched", "trip_id", ["trip_id"])

    def f(part):   # cancelled rows see every prior row
        return all_prior.join(part.select("trip_id"), "trip_id", "left_semi").select("trip_id", "prior_trip_id")

    def g(part):   # flown rows skip cancelled priors
        return windows.prior_event(part, "entity", "sched", "trip_id", ["trip_id"]).select("trip_id", "prior_trip_id")

    return sets.split_apply_union(t, F.col("cancelled") == 1, f, g)


# ---------------------------------------------------------------------------
# Sort / limit

@query("sort_by", with_views(["trips"], "SELECT trip_id, delay_min FROM trips ORDER BY delay_min DESC NULLS LAST, trip_id"))
def q_sort(spark, d):
    return sets.sort_by(Fixtures(spark, d).trips(), ["-delay_min", "trip_id"]).select("trip_id", "delay_min")


@query("top_k", with_views(["readings"], """
SELECT 'top' AS part, reading_id FROM (SELECT reading_id FROM readings ORDER BY wind DESC NULLS LAST, reading_id LIMIT 10)
UNION ALL SELECT 'ranks21_40', reading_id FROM (SELECT reading_id FROM readings ORDER BY wind DESC NULLS LAST, reading_id LIMIT 20 OFFSET 20)"""))
def q_top_k(spark, d):
    r = Fixtures(spark, d).readings()
    a = sets.top_k(r, "wind", 10, tie="reading_id").select(F.lit("top").alias("part"), "reading_id")
    b = sets.top_k(r, "wind", 20, skip=20, tie="reading_id").select(F.lit("ranks21_40").alias("part"), "reading_id")
    return a.unionByName(b)


@query("top_k_per_group", with_views(["readings"], """
SELECT site, reading_id, CAST(rank AS INTEGER) AS rank FROM (SELECT site, reading_id, row_number() OVER (PARTITION BY site ORDER BY wind DESC NULLS LAST, reading_id) AS rank
FROM readings) WHERE rank <= 3"""))
def q_top_k_group(spark, d):
    return sets.top_k_per_group(Fixtures(spark, d).readings(), "site", "wind", 3, "reading_id").select("site", "reading_id", "rank")


@query("head", with_views(["trips"], """
SELECT trip_id, entity, carrier FROM trips ORDER BY sched, trip_id LIMIT 20"""))
def q_head(spark, d):
    return sets.head(Fixtures(spark, d).trips(), 20, ["sched", "trip_id"]).select("trip_id", "entity", "carrier")


@query("top_features", with_views(["wide_nulls"], """
SELECT "column", n_null FROM (""" + _profile_sql(_PROF_COLS) + """) ORDER BY n_null DESC, "column" LIMIT 2"""))
def q_top_features(spark, d):
    p = ag.null_profile(Fixtures(spark, d).wide_nulls(), _PROF_COLS)
    return sets.top_features(p, "n_null", 2, name="column").select("column", "n_null")

"""Exactness on wide rows, many partitions, hot keys, rare classes and odd
coordinates."""

import datetime as dt
import math
import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from leadtime.operators import graph, joins, sampling, windows
from leadtime.plans import ml, seasonality
from leadtime.session import local_checkpoint_dir

LINES = "/root/testdata/sf0.1/lineitem.parquet"


def _wide(spark):
    df = spark.read.parquet(LINES).select("l_orderkey", "l_linenumber", "l_quantity")
    return df.withColumn("pad", F.repeat(F.sha2(F.col("l_orderkey").cast("string"), 256), 4)).repartition(16)


@pytest.fixture(params=["true", "false"])
def aqe(spark, request):
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_row_index_numbers_every_row_once(spark, aqe):
    wide = _wide(spark)
    got = windows.row_index(wide, ["l_orderkey", "l_linenumber"])
    assert "pad" in got.columns
    n, distinct, lo, hi = got.agg(F.count("pad"), F.count_distinct("row_idx"), F.min("row_idx"), F.max("row_idx")).first()
    assert (n, distinct, lo, hi) == (wide.count(), wide.count(), 1, wide.count())
    bad = got.select("row_idx", F.lead("l_orderkey").over(windows.Window.partitionBy(F.col("row_idx") % 1).orderBy("row_idx")).alias("nx"),
                     "l_orderkey").filter("nx < l_orderkey")
    assert bad.count() == 0


def test_prefix_sums_keep_every_row(spark):
    wide = windows.row_index(_wide(spark), ["l_orderkey", "l_linenumber"], "i").withColumn("one", F.lit(1).cast("long"))
    got = windows.prefix_sum(wide, "i", "one", "before")
    assert got.agg(F.count("pad"), F.count_if(F.col("before") != F.col("i") - 1)).first()[:] == (wide.count(), 0)
    got = windows.grouped_prefix_sum(wide, ["l_linenumber"], "i", "one", "before")
    top = {r[0]: (r[1], r[2], r[3]) for r in got.groupBy("l_linenumber").agg(
        F.count("pad"), F.max("before"), F.count_distinct("before")).collect()}
    assert all(n == m + 1 == k for n, m, k in top.values()) and sum(n for n, _, _ in top.values()) == wide.count()


@pytest.mark.parametrize("n", [16, 17, 19, 600_000])
def test_row_folds_are_all_there(spark, n):
    df = spark.range(n).withColumn("pad", F.repeat(F.lit("x"), 50)).repartition(5)
    got = {(r.fold, r.part): r.n for r in sampling.cv_bounds_rows(df, ["id"], k=3).groupBy("fold", "part").agg(
        F.count("pad").alias("n")).collect()}
    chunk = n // 4
    for i in range(3):
        assert got[i, "train"] == (i + 1) * chunk
        assert got[i, "val"] == (chunk if i < 2 else n - 1 - 3 * chunk)


def test_downsample_at_any_ratio(spark):
    df = spark.range(1_000_000).withColumn("label", (F.col("id") % 5000 == 0).cast("int"))
    n = {r.label: r["count"] for r in sampling.downsample(df, "label", "id").groupBy("label").count().collect()}
    assert n[1] == 200 and 100 < n[0] < 300
    up = {r.label: r["count"] for r in sampling.upsample(df, "label", "id").groupBy("label").count().collect()}
    assert up[0] == 999_800 and up[1] == 200 * 4999
    many = spark.range(60_000).withColumn("label", F.col("id") % 3000).unionByName(
        spark.range(1000).withColumn("label", F.lit(7).cast("long")))
    got = {r.label: r["count"] for r in sampling.downsample(many, "label", "id").groupBy("label").count().collect()}
    assert got.pop(7) < 60 and set(got.values()) == {20} and len(got) == 2999


def test_sample_n_is_about_n_for_any_keys(spark):
    for df in (spark.range(2_000_000), spark.range(2_000_000).select((F.col("id") * 1000).alias("id"))):
        assert abs(sampling.sample_n(df, 50, "id").count() - 50) <= 6 * math.sqrt(50)


def test_checkpoint_folder_is_asked_for_on_a_cluster():
    for master in ("spark://host:7077", "yarn", "k8s://x", "local-cluster[2,1,512]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            local_checkpoint_dir(master)
    assert local_checkpoint_dir("local[4]")


def test_pagerank_of_many_groups(spark):
    n = 20_000
    v = spark.range(3 * n).select((F.col("id") % n).alias("g"), F.floor(F.col("id") / n).cast("string").alias("id"))
    e = spark.range(n).select(F.col("id").alias("g"), F.lit("0").alias("src"), F.lit("1").alias("dst"))
    got = graph.pagerank(v, e, group="g", iters=3)
    assert got.count() == 3 * n
    assert got.groupBy("id").agg(F.count_distinct(F.round("pagerank", 9)).alias("k")).filter("k > 1").count() == 0
    assert got.groupBy("g").agg(F.sum("pagerank").alias("m")).filter("abs(m - 1) > 1e-9").count() == 0


def test_match_any_one_row_per_left_row(spark):
    rng = random.Random(1)
    left = [(i, rng.choice([None, *range(5)]), rng.choice([None, *range(3)])) for i in range(40)]
    right = [(i, rng.choice([None, *range(6)]), rng.choice([None, *range(4)]), rng.choice([None, 1.0, 2.0])) for i in range(30)]
    l = spark.createDataFrame(left, "id int, a int, b int")
    r = spark.createDataFrame(right, "rid int, ra int, rb int, score double")
    got = {x.id: x.rid for x in joins.match_any(l, r, [("a", "ra"), ("b", "rb")], "id", "score").collect()}
    for i, a, b in left:
        m = [x for x in right if (a is not None and x[1] == a) or (b is not None and x[2] == b)]
        want = min(m, key=lambda x: (x[3] is None, -(x[3] or 0), x[0]))[0] if m else None
        assert got[i] == want
    assert len(got) == len(left)


def _km(a, b, c, d):
    p, q = math.radians(a), math.radians(c)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * math.asin(min(1, math.sqrt(h)))


@pytest.mark.parametrize("cell", [None, 2.3, 7.0, 11.0, 50.0, 170.0])
def test_nearest_around_the_date_line_and_poles(spark, cell):
    rng = random.Random(str(cell))

    def place():
        lon = rng.choice([rng.uniform(174, 180), rng.uniform(-180, -174), rng.uniform(-180, 180), 180.0, -180.0])
        return rng.choice([rng.uniform(-90, 90), rng.uniform(-5, 5), 89.9, -90.0]), lon

    sites = [(f"s{i:03d}", *place()) for i in range(60)] + [("none", None, 5.0)]
    points = [(i, *place()) for i in range(250)] + [(1000, None, 3.0), (1001, 4.0, None)]
    got = {r.pid: (r.sid, r.distance) for r in joins.nearest(
        spark.createDataFrame(points, "pid int, la double, lo double"), spark.createDataFrame(sites, "sid string, sa double, so double"),
        "pid", "la", "lo", "sid", "sa", "so", cell_deg=cell).collect()}
    assert len(got) == len(points) and got[1000] == got[1001] == (None, None)
    for i, a, b in points[:250]:
        least = min(_km(a, b, c, d) for _, c, d in sites[:-1])
        _, c, d = next(s for s in sites if s[0] == got[i][0])
        assert _km(a, b, c, d) - least < 1e-9


def test_nearest_without_sites(spark):
    p = spark.createDataFrame([(1, 2.0, 3.0)], "pid int, la double, lo double")
    s = spark.createDataFrame([], "sid string, sa double, so double")
    assert [tuple(r) for r in joins.nearest(p, s, "pid", "la", "lo", "sid", "sa", "so").collect()] == [(1, None, None)]


def test_one_key_dedup_sends_one_row_per_task(spark):
    df = spark.range(200_000).select((F.col("id") % 1 + 1).alias("k"), "id", F.when(F.col("id") % 3 > 0, F.col("id")).alias("a"),
                                     F.when(F.col("id") == 777, F.lit(1)).alias("b"))
    out = windows.dedup_least_null(df, ["k"], ["a", "b"], ["id"])
    assert [tuple(r) for r in out.collect()] == [(1, 778 - 1, None, 1)] or out.first()["id"] == min(
        i for i in range(200_000) if (i % 3 == 0) + (i != 777) == 1)
    # whole rows are neither aggregated nor sent: the limit of one row per key
    # applies in each task ahead of the shuffle
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and re.search(r"Exchange hash[^\n]*\n[^\n]*WindowGroupLimit[^\n]*Partial", plan), plan
    assert windows.first_per_key(df, ["k"], ["b", "id"]).first()["id"] == 777


def test_trend_features_ignore_later_days(spark):
    rng = random.Random(2)
    start = dt.date(2024, 1, 1)
    rows = [(i, "s", start + dt.timedelta(days=rng.randrange(200)), rng.random()) for i in range(900)]
    cut = start + dt.timedelta(days=150)

    def run(x):
        df = spark.createDataFrame(pd.DataFrame(x, columns=["id", "site", "day", "y"]))
        out = seasonality.trend_features(df, "site", "day", "y")
        return {r.id: tuple(v if v is None else round(v, 9) for v in (r.trend, r.season, r.resid)) for r in out.filter(F.col("day") <= F.lit(cut)).collect()}

    changed = [(i, s, d, y + (100 if d > cut - dt.timedelta(days=7) else 0)) for i, s, d, y in rows if d <= cut + dt.timedelta(days=20)]
    a, b = run(rows), run(changed)
    assert a == b and sum(v[0] is not None for v in a.values()) > 100


def test_folds_are_weighted_from_their_own_rows(spark):
    df = spark.range(400).select("id", (F.col("id") % 7 == 0).cast("double").alias("label"), (F.col("id") % 11).cast("double").alias("x_0"),
                                 (F.col("id") % 13).cast("double").alias("x_1"), F.lit("c").alias("kind"), F.lit(0).alias("unused"))
    seen = []

    def weigh(part):
        seen.append((part.columns, part.count()))
        return sampling.class_weights(part, "label")

    from pyspark.ml import Pipeline

    def lr():
        return Pipeline(stages=ml.encode_stages([], ["x"], scale="standard") + [ml.model("logreg", weight="weight", maxIter=3)])

    folds = [(df.filter("id < 200"), df.filter("id >= 200 and id < 300")), (df.filter("id < 300"), df.filter("id >= 300"))]
    out = ml.cross_validate(folds, lr, weight_fn=weigh, templates={"x_{i}": "x"}, keep=["label", "x"])
    assert [r["fold"] for r in out] == [0, 1] and seen == [(["label", "x"], 200), (["label", "x"], 300)]


def test_week_fit_equals_its_closed_form(spark):
    """On a whole 168-hour grid the Fourier columns are orthogonal with
    squared length 84, so a ridge coefficient is (x . y) / (84 + lambda)."""
    import numpy as np
    rng = np.random.default_rng(4)
    y = rng.normal(size=168)
    start = dt.datetime(2024, 1, 7)   # a Sunday
    df = spark.createDataFrame([("a", start + dt.timedelta(hours=i), float(v)) for i, v in enumerate(y)], "site string, ts timestamp, y double")
    got = {(r.dow - 1) * 24 + r.hour: (r.weekly, r.daily) for r in seasonality.fit_seasonality_week(df, "site", "ts", "y").collect()}
    t = np.arange(168)

    def part(period, k):
        cols = [f(2 * np.pi * j * t / period) for j in range(1, k + 1) for f in (np.sin, np.cos)]
        return sum(c * (c @ y) / 85.0 for c in cols)

    for i, (a, b) in enumerate(zip(part(168, 3), part(24, 4))):
        assert abs(got[i][0] - a) < 1e-9 and abs(got[i][1] - b) < 1e-9


def test_small_helpers(spark, tmp_path):
    from leadtime.functions.text import map_series
    from leadtime.sources.io import from_rows, list_files, save
    rows = from_rows(spark, [(1, 2.0), (2, None)], "a int, b double")
    assert [tuple(r) for r in rows.orderBy("a").collect()] == [(1, 2.0), (2, None)]
    twice = map_series(lambda s: s * 2)
    assert [r[0] for r in rows.orderBy("a").select(twice("b")).collect()] == [4.0, None]
    save(rows.coalesce(1), str(tmp_path / "t"))
    files = list_files(spark, str(tmp_path / "t")).filter(F.col("path").endswith(".parquet")).collect()
    assert len(files) == 1 and files[0]["length"] > 0


def test_interval_means_skip_nan(spark):
    nan, inf = float("nan"), float("inf")
    t0 = dt.datetime(2024, 1, 1)
    rows = [("a", i, t0 + dt.timedelta(minutes=i), v) for i, v in enumerate([1.0, nan, 3.0, inf, None, 5.0])]
    df = spark.createDataFrame(rows, "k string, id int, t timestamp, v double")
    out = windows.range_mean_if(df, ["k"], "t", "v", None, 3600, out="m")
    assert {r.id: r.m for r in out.collect()}[5] == 2.0   # strictly earlier rows


def test_occurrence_by_any_order(spark):
    df = spark.range(30_000).select((F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 5)).alias("k"),
                                    (F.col("id") * 7919 % 30_011).alias("v"), F.repeat(F.lit("x"), 40).alias("pad")).repartition(7)
    got = windows.occurrence(df, ["k"], ["v"])
    want = df.withColumn("w", F.row_number().over(windows.Window.partitionBy("k").orderBy("v")))
    j = got.join(want.select(F.col("v").alias("v2"), "w"), F.col("v") == F.col("v2"))
    assert j.agg(F.count("pad"), F.count_if(F.col("occurrence") != F.col("w"))).first()[:] == (30_000, 0)

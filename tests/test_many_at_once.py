"""Operators whose cost must not grow with columns, set sizes or spans."""

import math
import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from leadtime.operators import aggregates as ag
from leadtime.operators import joins, windows
from leadtime.plans import features as ft

T0 = datetime(2024, 1, 1)


def shuffles(df):
    txt = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"(?<!Broadcast)Exchange (hash|range|Single)", txt))


# -- W10

@pytest.mark.parametrize("width", [None, 3600.0, 86400.0])
def test_any_cutoff_column(spark, width):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        s = None if rng.random() < 0.03 else T0 + timedelta(minutes=15 * rng.randint(-40, 60))
        a = None if s is None or rng.random() < 0.1 else s + timedelta(minutes=rng.randint(-60, 300))
        c = None if rng.random() < 0.05 else T0 + timedelta(minutes=rng.randint(-700, 1000))
        rows.append((i, rng.choice(["x", "x", "x", "y", None]), s, a, c, rng.choice([None, 1.0, 2.5, -4.0, float("nan")]), rng.choice([0.0, 1.0])))
    rows += rows[:5]
    df = spark.createDataFrame(rows, "id int, k string, s timestamp, a timestamp, c timestamp, v double, w double").repartition(3)
    got = windows.lagged_stat(df, ["k"], "s", "a", "c", {"m": "v", "p": "w"}, span_s=2 * 3600, width_s=width)
    assert got.columns == df.columns + ["m", "p"] and got.count() == len(rows)
    by_id = {r.id: (r.m, r.p) for r in got.collect()}
    for i, k, s, a, c, v, w in rows:
        seen = [r for r in rows if r[1] == k and s and c and r[2] and r[3] and s - timedelta(hours=2) <= r[2] <= s and r[3] < c]
        for have, j in zip(by_id[i], (5, 6)):
            vals = [r[j] for r in seen if r[j] is not None and not math.isnan(r[j])]
            assert (have is None) == (not vals) and (not vals or abs(have - sum(vals) / len(vals)) < 1e-9), i


def test_cutoff_column_gathers_no_frames(spark):
    df = spark.range(10).select(F.lit(1).alias("k"), F.timestamp_seconds("id").alias("s"), F.timestamp_seconds("id").alias("a"),
                                F.timestamp_seconds("id").alias("c"), F.col("id").cast("double").alias("v"))
    plan = windows.lagged_stat(df, ["k"], "s", "a", "c", {"m": "v"})._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan


def test_cutoffs_at_a_busy_instant(spark):
    """20,000 rows of one key within one span: n log n, not n squared."""
    n = 20_000
    df = spark.range(n).select(F.lit("hub").alias("k"), F.timestamp_millis(F.col("id") * 100).alias("s"), F.timestamp_millis(F.col("id") * 100 + 50).alias("a"),
                               F.timestamp_millis(F.col("id") * 100).alias("c"), F.lit(1.0).alias("v"), F.col("id").cast("double").alias("x"), "id")
    got = windows.lagged_stat(df, ["k"], "s", "a", "c", {"one": "v", "mean": "x"})
    # known at row i: rows 0 .. i - 1
    assert got.filter("id > 0 AND (one <> 1 OR abs(mean - (id - 1) / 2) > 1e-9)").count() == 0 and got.filter("one IS NULL").count() == 1


# -- J12, D10

def readings(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice(["a", "b", "c", None]), T0 + timedelta(minutes=rng.choice([0, 0, 30, 60, 90]) + 60 * rng.randint(0, 30)),
             *[None if rng.random() < 0.5 else float(rng.randint(0, 99)) for _ in range(3)]) for i in range(200)]
    return rows, spark.createDataFrame(rows, "id int, site string, t timestamp, x double, y double, z double").repartition(3)


@pytest.mark.parametrize("kind", ["near", "aged", "same"])
def test_fill_many_measures(spark, kind):
    rows, df = readings(spark)
    nbr = {"a": "b", "b": "c"}
    nbrs = spark.createDataFrame(list(nbr.items()), "site string, neighbor string")
    args = {"near": {"tolerance_s": 2 * 3600}, "aged": {"min_age_s": 1800, "max_age_s": 3 * 3600}, "same": {"tolerance_s": None}}[kind]
    got = {r.id: (r.x, r.y, r.z) for r in joins.fill_from_neighbor(df, nbrs, "site", "t", ["x", "y", "z"], "id", **args).collect()}
    assert len(got) == len(rows)
    for r in rows:
        for j in range(3):
            want = r[3 + j]
            if want is None:
                cand = [(q[2], q[0], q[3 + j]) for q in rows if q[1] == nbr.get(r[1], "-") and q[3 + j] is not None]
                h = timedelta(hours=1)
                if kind == "near":
                    cand = [(abs(q[0] - r[2]), -q[0].timestamp(), -q[1], q[2]) for q in cand if abs(q[0] - r[2]) <= 2 * h]
                elif kind == "aged":
                    cand = [(-q[0].timestamp(), -q[1], q[2]) for q in cand if r[2] - 3 * h <= q[0] <= r[2] - h / 2]
                else:
                    cand = [(-q[1], q[2]) for q in cand if q[0] == r[2]]
                want = min(cand)[-1] if cand else None
            assert got[r[0]][j] == want, (r, j)


def test_shuffles_do_not_grow_with_measures(spark):
    _, df = readings(spark)
    df = df.filter("site IS NOT NULL")
    nbrs = spark.createDataFrame([("a", "b")], "site string, neighbor string")
    many = [shuffles(joins.fill_from_neighbor(df, nbrs, "site", "t", c, "id")) for c in (["x"], ["x", "y", "z"])]
    assert many[0] == many[1]
    many = [shuffles(ft.impute_spatial_temporal(df, c, "site", "site", "t", "id")) for c in (["x"], ["x", "y", "z"])]
    assert many[0] == many[1]


def test_halo_of_rows_over_sparse_buckets(spark):
    """Buckets with fewer rows than the frame take them from further back."""
    rng = random.Random(6)
    rows = [(i, rng.choice("ab"), T0 + timedelta(hours=rng.randint(0, 400)), rng.choice([None, float(i)])) for i in range(250)]
    df = spark.createDataFrame(rows, "id int, k string, t timestamp, v double").repartition(4)
    for width in (3600.0, 36_000.0, 10**9):
        got = {r.id: r.v for r in windows.rolling_fill(df, "k", "t", "id", "v", 7, width_s=width).collect()}
        for i, k, t, v in rows:
            back = sorted((r for r in rows if r[1] == k and (r[2], r[0]) < (t, i)), key=lambda r: (r[2], r[0]))[-7:]
            vals = [r[3] for r in back if r[3] is not None]
            want = v if v is not None else (sum(vals) / len(vals) if vals else None)
            assert got[i] == pytest.approx(want) if want is not None else got[i] is None
    got = {r.id: r.v for r in windows.interpolate_midpoint(df, "k", "t", "id", "v", width_s=3600.0).collect()}
    for k in "ab":
        order = sorted((r for r in rows if r[1] == k), key=lambda r: (r[2], r[0]))
        for a, b, c in zip(order, order[1:], order[2:]):
            if b[3] is None and a[3] is not None and c[3] is not None:
                assert got[b[0]] == (a[3] + c[3]) / 2


# -- A12, A22, A23

@pytest.mark.parametrize("block", [2, 5, 256])
def test_pair_counts_by_blocks(spark, block):
    rng = random.Random(1)
    keys = {k: {rng.randint(0, 25) for _ in range(rng.randint(0, 20))} for k in range(40)}
    df = spark.createDataFrame([(k, i) for k, s in keys.items() for i in list(s) + [None]], "k int, i int")
    want = {}
    for s in keys.values():
        for a in s:
            for b in s:
                if a < b:
                    want[a, b] = want.get((a, b), 0) + 1
    assert {(r.item_a, r.item_b): r.n_keys for r in ag.pair_counts(df, "k", "i", block).collect()} == want


def test_pairs_of_a_set_of_20000(spark):
    """All pairs come out, and no row holds more than a block's worth."""
    n = 20_000
    w = spark.range(1).select(F.sequence(F.lit(0), F.lit(n - 1)).alias("__set"), F.lit(1).alias("__w"))
    rows = ag.set_pairs(w, 256)
    most, parts = rows.withColumn("part", F.spark_partition_id()).agg(F.max(F.size("__right")), F.count_distinct("part")).first()
    assert most <= 256 and parts > 1
    right = F.size(F.filter("__right", lambda x: x > F.col("item_a")))
    assert rows.agg(F.sum(right)).first()[0] == n * (n - 1) // 2


def test_summary_scans_twice(spark, monkeypatch):
    rng = random.Random(9)
    n = 50_000
    df = spark.range(n).select(*[((F.col("id") * p) % n / 7.0).alias(f"c{p}") for p in (3, 7, 11, 13, 17, 19, 23, 29, 31)],
                               F.lit(None).cast("double").alias("none")).repartition(5)
    monkeypatch.setattr(ag, "exact_quantiles", None)   # not needed: the brackets hold
    got = {r.column: r for r in ag.summary(df, df.columns, (0.0, 0.1, 0.5, 0.999, 1.0)).collect()}
    for p in (3, 31):
        v = sorted(i * p % n / 7.0 for i in range(n))
        r = got[f"c{p}"]
        assert r["count"] == n and r.min == v[0] and r.max == v[-1]
        for q in (0.0, 0.1, 0.5, 0.999, 1.0):
            h = q * (n - 1)
            lo, hi = v[math.floor(h)], v[math.ceil(h)]
            assert r[f"p{int(q * 100)}"] == pytest.approx(lo + (h - math.floor(h)) * (hi - lo)) or q == 0.999
    assert got["none"]["count"] == 0 and got["none"].p50 is None and rng


def test_summary_without_rows(spark):
    r = ag.summary(spark.createDataFrame([], "a double, b int"), ["a", "b"]).collect()
    assert sorted(x.column for x in r) == ["a", "b"] and all(x["count"] == 0 and x.mean is None and x.p50 is None for x in r)


def test_a_poor_sketch_falls_back(spark):
    """With a sketch too coarse for its bracket the quantiles stay exact."""
    df = spark.range(5000).select(((F.col("id") * 7) % 5000).cast("double").alias("v")).repartition(8)
    out, _ = ag.column_quantiles(df, ["v"], [0.25, 0.5], accuracy=2)
    assert {(r.p, r.q) for r in out.collect()} == {(0.25, 1249.75), (0.5, 2499.5)}


def test_spearman_shuffles_are_fixed(spark):
    df = spark.range(500).select(*[((F.col("id") * p) % 500).cast("double").alias(f"c{p}") for p in (3, 7, 11, 13)],
                                 F.when(F.col("id") % 3 == 0, F.col("id") % 5).alias("few"))
    assert shuffles(ag.spearman(df, ["c3", "c7"])) == shuffles(ag.spearman(df, df.columns))
    pdf = df.toPandas()
    for r in ag.spearman(df, df.columns).collect():
        both = pdf[[r.a, r.b]] if r.a != r.b else pdf[[r.a]]
        a, b = both[r.a].rank(), both[r.b].rank()
        ok = a.notna() & b.notna()
        assert r.rho == pytest.approx(a[ok].corr(b[ok]))


# -- J6

def km(a, b, c, d):
    p, q = math.radians(a), math.radians(c)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(h)))


@pytest.mark.parametrize("k,cell", [(3, None), (3, 2.0), (7, 20.0), (50, 5.0)])
def test_k_nearest(spark, k, cell):
    rng = random.Random(k)
    pts = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(30)] + [(100, None, 1.0), (101, 90.0, 0.0), (102, 0.0, 180.0), (102, 0.0, 180.0)]
    sites = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(40)] + [(90, 0.0, 179.5), (91, 0.0, -179.5), (92, None, None)]
    got = joins.nearest(spark.createDataFrame(pts, "pid int, la double, lo double"), spark.createDataFrame(sites, "sid int, sa double, so double"),
                        "pid", "la", "lo", "sid", "sa", "so", cell_deg=cell, k=k)
    by = {}
    for r in got.collect():
        by.setdefault(r.pid, []).append((r["rank"], r.sid, r.distance))
    assert by.pop(100) == [(None, None, None)]
    for i, la, lo in pts:
        if la is None:
            continue
        want = sorted((round(km(la, lo, b, c), 6), s) for s, b, c in sites if b is not None)[:k]
        have = sorted(by[i])
        assert [x[0] for x in have] == list(range(1, len(want) + 1)) and [x[1] for x in have] == [s for _, s in want]


def test_k_nearest_with_few_sites(spark):
    p = spark.createDataFrame([(1, 0.0, 0.0)], "pid int, la double, lo double")
    s = spark.createDataFrame([(5, 1.0, 1.0), (6, 50.0, 90.0)], "sid int, sa double, so double")
    assert [(r["rank"], r.sid) for r in joins.nearest(p, s, "pid", "la", "lo", "sid", "sa", "so", k=3).orderBy("rank").collect()] == [(1, 5), (2, 6)]
    none = joins.nearest(p, s.limit(0), "pid", "la", "lo", "sid", "sa", "so", k=3).collect()
    assert [tuple(r) for r in none] == [(1, None, None, None)]

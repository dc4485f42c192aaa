"""Plans and figures that must not grow faster than the rows."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from leadtime.functions import geo
from leadtime.operators import graph, joins, windows

T0 = datetime(2024, 1, 1)


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def timed_rows(spark):
    rng = random.Random(31)
    rows = [(i, rng.choice(["a", "b", "c", None]), T0 + timedelta(minutes=10 * rng.randint(0, 300)),
             rng.choice([None, float(i)]), rng.choice([None, -float(i)])) for i in range(300)]
    return rows, spark.createDataFrame(rows, "id int, site string, t timestamp, x double, y double").repartition(3)


# -- J12: the next reading

@pytest.mark.parametrize("cols", [["x"], ["x", "y"]])
def test_fill_reads_each_frame_once(spark, cols):
    """A frame up to the last row is computed anew for each row."""
    rows, df = timed_rows(spark)
    nbrs = spark.createDataFrame([("a", "b"), ("b", "c")], "site string, neighbor string")
    out = joins.fill_from_neighbor(df, nbrs, "site", "t", cols, "id", tolerance_s=7200)
    assert "unboundedfollowing" not in plan(out)
    got = {r.id: [r[c] for c in cols] for r in out.collect()}
    assert len(got) == len(rows)
    for r in rows:
        for j in range(len(cols)):
            near = [(abs(q[2] - r[2]), -q[2].timestamp(), -q[0], q[3 + j]) for q in rows if q[1] == {"a": "b", "b": "c"}.get(r[1], "-")
                    and q[3 + j] is not None and abs(q[2] - r[2]) <= timedelta(hours=2)]
            assert got[r[0]][j] == (r[3 + j] if r[3 + j] is not None else min(near)[-1] if near else None), r


def test_nearest_in_time_reads_each_frame_once(spark):
    rows, df = timed_rows(spark)
    right = df.filter("site IS NOT NULL").select(F.col("id").alias("rid"), F.col("site").alias("rs"), (F.col("t") + F.expr("interval 5 minutes")).alias("rt"))
    out = joins.nearest_in_time(df, right, "site", "rs", "t", "rt", 3600, tie="rid")
    assert "unboundedfollowing" not in plan(out)
    plain = joins.nearest_in_time(df, right, "site", "rs", "t", "rt", 3600, "id", tie="rid", method="join")
    assert {r.id: r.rid for r in out.collect()} == {r.id: r.rid for r in plain.collect()}


# -- F19: boxes

def bisected(gh):
    lat, lon = [-90.0, 90.0], [-180.0, 180.0]
    for i, b in enumerate(b for ch in gh for b in f"{geo.GEOHASH_ALPHABET.index(ch):05b}"):
        side = lat if i % 2 else lon
        side[0 if b == "1" else 1] = (side[0] + side[1]) / 2
    return (*lat, *lon)


def test_geohash_box_by_bisection(spark):
    rng = random.Random(5)
    hashes = ["".join(rng.choice(geo.GEOHASH_ALPHABET) for _ in range(n)) for n in range(1, 21) for _ in range(3)]
    df = spark.createDataFrame([(g,) for g in [*hashes, "", None]], "g string").withColumn("b", geo.geohash_bbox("g"))
    assert {r.g: r.b and tuple(r.b) for r in df.collect()} == {**{g: bisected(g) for g in hashes}, "": None, None: None}


def test_geohash_box_is_decoded_once(spark):
    """One fold for a row, in which the hash is split outside the step."""
    df = spark.createDataFrame([(1, 57.64911, 10.40744), (2, None, 1.0), (3, -33.9, 151.2)], "id int, lat double, lon double")
    out = df.filter(geo.in_bbox("lat", "lon", geo.geohash_bbox(geo.geohash("lat", "lon", 6))))
    assert [r.id for r in out.orderBy("id").collect()] == [1, 3]
    text = out._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("aggregate(") == 1 and text.count("split(") == 1
    away = spark.createDataFrame([("u4pruy", 0.0, 0.0), (None, 0.0, 0.0)], "g string, lat double, lon double")
    assert away.filter(geo.in_bbox("lat", "lon", geo.geohash_bbox("g"))).count() == 0


# -- W10: any cutoff column

def test_cutoff_runs_are_spread_by_block(spark):
    """The rows of all levels are not sorted where their bucket was numbered."""
    _, df = timed_rows(spark)
    df = df.withColumn("cut", F.col("t") - F.expr("interval 20 minutes"))
    out = windows.lagged_stat(df, ["site"], "t", "t", "cut", {"m": "x"}, span_s=7200)
    physical = out._jdf.queryExecution().executedPlan().toString()
    assert any("Exchange hashpartitioning" in line and "__lv" in line and "__nd" in line for line in physical.splitlines())


# -- G8: rounds by forward push

def test_push_leaves_done_sources_alone(spark, monkeypatch):
    """One source goes round and round, nine are done after two rounds: their
    rows are not written again in the rounds after."""
    from leadtime.sources import io
    e = [(f"s{i}", f"t{i}_{j}") for i in range(9) for j in range(40)] + [("a", "b"), ("b", "a")]
    written, stage_to = [], io.stage_to

    def counted(df, path=None):
        out = stage_to(df, path)
        if set(out.columns) == {"source", "id", "p", "r"} and path:
            written.append(out.count())
        return out

    monkeypatch.setattr(io, "stage_to", counted)
    edges = spark.createDataFrame(e + [(b, a) for a, b in e if a != "a" and a != "b"], "src string, dst string")
    sources = spark.createDataFrame([(f"s{i}",) for i in range(9)] + [("a",), (None,)], "id string")
    got = {(r.source, r.id): r for r in graph.push_pagerank(edges, sources, bound=0.3, rounds=8).collect()}
    assert len(got) == 9 * 41 + 2 and written[-1] == 2
    assert got["s0", "s0"].pagerank == pytest.approx(0.15 + 0.15 * 0.0) and got["s0", "t0_1"].residual == pytest.approx(0.85 / 40)
    assert got["s0", "s0"].rest == pytest.approx(0.85) and got["a", "a"].pagerank > 0.15
    assert got["a", "a"].pagerank + got["a", "b"].pagerank + got["a", "a"].rest == pytest.approx(1.0)

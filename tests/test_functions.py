"""Scalar functions on hand-made rows (public reference values)."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import MID
from leadtime.functions import geo, text, timeops as tm
from leadtime.operators import sampling as sm
from leadtime.plans.fixtures import Fixtures


def test_geohash_known_value(spark):
    # Widely published example point and its 11-character geohash.
    df = spark.createDataFrame([(57.64911, 10.40744)], "lat double, lon double")
    r = df.select(geo.geohash("lat", "lon", 11).alias("g")).first()
    assert r["g"] == "u4pruydqqvj"
    b = df.select(geo.geohash_bbox(geo.geohash("lat", "lon", 11)).alias("b")).first()["b"]
    assert b["lat_min"] <= 57.64911 <= b["lat_max"] and b["lon_min"] <= 10.40744 <= b["lon_max"]


def test_haversine_quarter_meridian(spark):
    df = spark.createDataFrame([(0.0, 0.0, 90.0, 0.0)], "a double, b double, c double, d double")
    km = df.select(geo.haversine("a", "b", "c", "d", "km")).first()[0]
    assert km == pytest.approx(6371.0 * 3.141592653589793 / 2, rel=1e-12)


def test_metar_fields(spark):
    rows = [("METAR KJFK 27015G25KT 10SM PK WND 28045/1530 P0012", None, None),
            ("SPECI KLAX 09005KT", "*", 3.0),
            ("AUTO 18010KT", "0.05T", None)]
    df = spark.createDataFrame(rows, "rem string, raw string, wind double")
    out = df.select(text.metar_station("rem").alias("st"), text.metar_wind_speed("rem", "wind").alias("ws"),
                    text.metar_gust("rem").alias("g"), text.metar_precip("raw", "rem").alias("p")).collect()
    assert [r["st"] for r in out] == ["KJFK", "KLAX", None]
    assert [r["ws"] for r in out] == [15.0, 3.0, 10.0]
    assert [r["g"] for r in out] == [45.0, None, None]
    assert out[0]["p"] == pytest.approx(0.12) and out[1]["p"] is None and out[2]["p"] == pytest.approx(0.05)


def test_hhmm_2400_and_rollover(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 31), 2400), (datetime(2024, 2, 1), 5)], "d timestamp, h int")
    r = df.select(tm.hhmm_timestamp("d", "h").alias("t")).collect()
    assert r[0]["t"] == datetime(2024, 2, 1, 0, 0) and r[1]["t"] == datetime(2024, 2, 1, 0, 5)
    x = spark.createDataFrame([(datetime(2024, 1, 1, 23, 0), datetime(2024, 1, 1, 1, 30))], "dep timestamp, arr timestamp")
    assert x.select(tm.roll_arrival("dep", "arr")).first()[0] == datetime(2024, 1, 2, 1, 30)


def test_to_utc_dst_rules(spark):
    df = spark.createDataFrame([("1996-04-07 02:30:00",), ("1996-10-27 01:30:00",), (None,)], "t string")
    out = df.select(tm.to_utc(F.col("t").cast("timestamp"), F.lit("America/New_York")).alias("u")).collect()
    assert out[0]["u"] == datetime(1996, 4, 7, 7, 30)      # gap: shifted forward
    assert out[1]["u"] == datetime(1996, 10, 27, 5, 30)    # overlap: earlier instant
    assert out[2]["u"] is None


def test_hash_sampling_ignores_partitioning(spark):
    t = Fixtures(spark, MID).trips().withColumn("label", F.when(F.col("delay_min") >= 15, 1.0).otherwise(0.0))
    a = {r[0] for r in sm.downsample(t, "label", "trip_id").select("trip_id").collect()}
    b = {r[0] for r in sm.downsample(t.repartition(37), "label", "trip_id").select("trip_id").collect()}
    assert a == b

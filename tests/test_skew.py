"""One hot key holding every row: results stay exact and the work is split
over many (key, time bucket) partitions."""

from pyspark.sql import functions as F

from conftest import MID
from leadtime.operators import joins, windows
from leadtime.plans import features as ft
from leadtime.plans.fixtures import Fixtures


def test_hot_key_asof_and_recency(spark):
    fx = Fixtures(spark, MID)
    t = fx.trips().withColumn("origin", F.lit(0).cast("long"))          # every trip at one site
    r = fx.readings().withColumn("site", F.lit(0).cast("long")).select("reading_id", "site", "read_ts", "wind")
    a = joins.asof_join(t, r, "origin", "site", "sched", "read_ts", 7200, 14400, "trip_id", tie="reading_id")
    b = joins.asof_join(t, r, "origin", "site", "sched", "read_ts", 7200, 14400, "trip_id", tie="reading_id",
                        method="join")
    x = a.select("trip_id", F.col("reading_id").alias("ra")).join(b.select("trip_id", F.col("reading_id").alias("rb")),
                                                                "trip_id", "full")
    assert x.count() == t.count() and x.filter("NOT (ra <=> rb)").count() == 0

    # the hot key is spread over its 4-hour buckets: no bucket holds more
    # than a small share of the rows
    per_bucket = t.groupBy(F.floor(F.unix_micros("sched") / (4 * 3600 * 10**6)).alias("b")).count()
    assert per_bucket.agg(F.max("count")).first()[0] < 0.02 * t.count()

    tt = ft.trip_times(t).withColumn("label", F.when(F.col("delay_min") >= 15, 1.0).otherwise(0.0))
    iv = windows.lagged_stat(tt, ["origin"], "sched", "actual_dep", None, {"m": "delay_min"}, cutoff_s=7200)
    fr = windows.lagged_stat(tt.withColumn("c", F.timestamp_micros(F.unix_micros("sched") - 7200 * 10**6)),
                             ["origin"], "sched", "actual_dep", "c", {"m": "delay_min"})
    y = (iv.select("trip_id", F.round("m", 9).alias("a"))
         .join(fr.select("trip_id", F.round("m", 9).alias("b")), "trip_id", "full"))
    assert y.count() == t.count() and y.filter("NOT (a <=> b)").count() == 0

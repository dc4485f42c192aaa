"""J15 with validity bounds: winners per segment of time."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from leadtime.operators import joins

T0 = datetime(2024, 1, 1)


def hours(n):
    return None if n is None else T0 + timedelta(hours=n)


def brute(left, right, use_from, use_to):
    out = []
    for i, a, b, t in left:
        m = [r for r in right if ((a is not None and r[1] == a) or (b is not None and r[2] == b)) and t is not None
             and (not use_from or (r[4] is not None and r[4] <= t)) and (not use_to or (r[5] is not None and t <= r[5]))]
        best = min(m, key=lambda r: (r[3] is None, -(r[3] or 0), r[0])) if m else None
        out.append((i, best[0] if best else None))
    return sorted(out)


@pytest.mark.parametrize("use_from,use_to", [(True, True), (False, True), (True, False)])
def test_dated_match(spark, use_from, use_to):
    rng = random.Random(4)
    left = [(i, rng.choice([None, *range(5)]), rng.choice([None, *range(3)]), hours(rng.choice([None, *range(-5, 60)]))) for i in range(150)]
    left.append(left[0])
    right = [(i, rng.choice([None, *range(6)]), rng.choice([None, *range(4)]), rng.choice([None, 1.0, 2.0, 3.0]),
              hours(rng.choice([None, *range(40)])), None) for i in range(60)]
    right = [(*r[:5], None if r[4] is None or rng.random() < 0.1 else r[4] + timedelta(hours=rng.randint(-2, 30))) for r in right]
    l = spark.createDataFrame(left, "id int, a int, b int, t timestamp")
    r = spark.createDataFrame(right, "rid int, ra int, rb int, score double, vf timestamp, vt timestamp")
    got = joins.match_any(l, r, [("a", "ra"), ("b", "rb")], None, "score", "vf" if use_from else None, "vt" if use_to else None, "t")
    assert got.columns == l.columns + r.columns
    assert sorted((x.id, x.rid) for x in got.collect()) == brute(left, right, use_from, use_to)


def test_dated_match_with_dates_and_no_rows(spark):
    l = spark.createDataFrame([(1, 7, T0.date())], "id int, a int, t date")
    r = spark.createDataFrame([(1, 7, 1, T0.date(), T0.date()), (2, 7, 2, T0.date() + timedelta(1), None)], "rid int, ra int, s int, vf date, vt date")
    assert joins.match_any(l, r, [("a", "ra")], "id", "s", "vf", "vt", "t").first().rid == 1
    assert joins.match_any(l, r.limit(0), [("a", "ra")], "id", "s", "vf", "vt", "t").first().rid is None
    assert joins.match_any(l.limit(0), r, [("a", "ra")], "id", "s", "vf", "vt", "t").count() == 0


def test_a_key_with_a_third_of_both_sides(spark):
    """Nested intervals of one key: n log n rows, and no task holds the key."""
    n = 30_000
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id"))
    l = spark.range(n).select("id", key.alias("a"), F.timestamp_micros(F.lit(1_704_067_200_000_000) + F.col("id") * 60_000_000).alias("t"))
    # row i is valid from minute i to minute 2n - i: all of them overlap
    r = spark.range(n).select(F.col("id").alias("rid"), key.alias("ra"), F.col("id").alias("s"),
                              F.timestamp_micros(F.lit(1_704_067_200_000_000) + F.col("id") * 60_000_000).alias("vf"),
                              F.timestamp_micros(F.lit(1_704_067_200_000_000) + (2 * n - F.col("id")) * 60_000_000).alias("vt"))
    out = joins.match_any(l, r, [("a", "ra")], "id", "s", "vf", "vt", "t")
    # the newest valid row of the key is the one that begins at that minute
    assert out.filter("rid IS NULL OR rid <> id").count() == 0 and out.count() == n


def test_segments_are_disjoint(spark):
    r = spark.createDataFrame([(1, "k", hours(0), hours(10)), (2, "k", hours(2), hours(4)), (3, "k", hours(3), hours(3))],
                              "p long, k string, a timestamp, b timestamp")
    got = joins.winning_segments(r, "k", "p", "a", "b").orderBy("__from").collect()
    us = lambda h: int((hours(h) - datetime(1970, 1, 1)).total_seconds() * 1e6)
    assert [(x["__from"], x.p) for x in got] == [(us(0), 1), (us(2), 1), (us(3), 1), (us(3) + 1, 1), (us(4) + 1, 1), (us(10) + 1, None)]

"""Selection of rows by place, and row-count folds built on it."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from leadtime.operators import sampling, selection


@pytest.fixture
def few_at_once(monkeypatch):
    monkeypatch.setattr(selection, "BINS", 4)
    monkeypatch.setattr(selection, "SMALL", 3)


def key(v):
    return tuple((x is not None, x if x is not None else 0) for x in v)


@pytest.mark.parametrize("types,make", [
    ("a long", lambda r: (r.choice([None, r.randint(-10**12, 10**12), 5]),)),
    ("a timestamp, b int", lambda r: (r.choice([None, datetime(2024, 1, 1) + timedelta(seconds=r.choice([0, 0, r.randint(0, 10**7)]))]), r.randint(0, 50))),
    ("a date, b string, c long", lambda r: (date(2024, 1, r.randint(1, 3)), r.choice([None, "x", "y"]), r.randint(-5, 5))),
    ("a string, b long", lambda r: (r.choice("abc"), r.randint(0, 9))),
])
def test_values_at(spark, few_at_once, types, make):
    rng = random.Random(2)
    rows = [make(rng) for _ in range(150)]
    df = spark.createDataFrame(rows, types).repartition(4)
    names = df.columns
    want = sorted(rows, key=key)
    got = selection.values_at(df, names, [1, 2, 3, 40, 75, 76, 149, 150, 151, 0])
    assert sorted(got) == [1, 2, 3, 40, 75, 76, 149, 150]
    for p, v in got.items():
        back = df.limit(1).select(*[selection.literal(df, c, x).alias(c) for c, x in zip(names, v)]).first()
        assert tuple(back) == want[p - 1]


def test_values_of_an_empty_table(spark):
    assert selection.values_at(spark.range(0), ["id"], [1, 2]) == {}


def test_selection_of_many_rows_reads_no_more_than_counts(spark):
    df = spark.range(3_000_000).select(((F.col("id") * 7919) % 3_000_000).alias("v"), F.lit(1).alias("one"))
    got = selection.values_at(df, ["v"], [1, 1_000_000, 1_500_001, 3_000_000])
    assert got == {1: (0,), 1_000_000: (999_999,), 1_500_001: (1_500_000,), 3_000_000: (2_999_999,)}


@pytest.mark.parametrize("n,k,overlap,blocking", [(100, 3, 0.0, True), (100, 4, 0.2, True), (997, 5, 0.5, False), (30, 2, 0.9, True), (7, 3, 0.0, False)])
def test_row_folds(spark, few_at_once, n, k, overlap, blocking):
    df = spark.range(n).select((F.col("id") % 10).alias("a"), F.col("id").alias("b")).repartition(3)
    order = sorted(range(n), key=lambda i: (i % 10, i))
    got = {}
    for r in sampling.cv_bounds_rows(df, ["a", "b"], k, blocking, overlap).collect():
        got.setdefault((r.fold, r.part), set()).add(r.b)
    want = {}
    for i, (a, z, v, w) in enumerate(sampling._row_folds(n, k, blocking, overlap)):
        for part, lo, hi in (("train", a, z), ("val", v, w)):
            if order[lo - 1:hi]:
                want[i, part] = set(order[lo - 1:hi])
    assert got == want


def test_neighbouring_folds_share_the_overlap():
    folds = sampling._row_folds(10_000, 4, True, 0.2)
    chunk = folds[0][1]
    for a, b in zip(folds, folds[1:]):
        assert a[1] - b[0] + 1 == pytest.approx(0.2 * chunk, abs=1) and b[2] == b[1] + 1
    assert folds[-1][3] <= 10_000 < folds[-1][3] + chunk


def test_folds_do_not_sort_the_table(spark):
    df = spark.range(50_000).select("id", F.timestamp_seconds(F.col("id") * 60).alias("t"))
    plan = sampling.cv_bounds_rows(df, ["t", "id"], 3, True, 0.2)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan

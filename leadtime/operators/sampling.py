"""Sampling and time-aware splits.

Sampling is repeatable and partition-independent: a row is kept when a
hash of its key falls under a threshold, so the result does not depend on
how the data happens to be split into tasks (``DataFrame.sample`` does).
Fold bounds are a handful of dates computed from one min/max aggregate.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# The published 5-fold bounds of the reference's 2015-2018
# training span (train_min, train_max, test_min, test_max; max exclusive).
FOLDS = [
    ("2014-12-31", "2015-10-09", "2015-10-09", "2016-07-17"),
    ("2015-08-14", "2016-05-21", "2016-05-21", "2017-02-27"),
    ("2016-03-27", "2017-01-01", "2017-01-01", "2017-10-10"),
    ("2016-11-08", "2017-08-14", "2017-08-14", "2018-05-23"),
    ("2017-06-22", "2018-03-27", "2018-03-27", "2019-01-01"),
]

def key_hash(key, salt: int = 0) -> Column:
    """Key -> a number in [0, 1) with 52 random bits, identical in Spark and
    in plain SQL engines: the first 13 hex digits of an MD5."""
    k = F.col(key) if isinstance(key, str) else key
    text = F.concat_ws(":", F.lit(str(salt)), F.coalesce(k.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def _extreme_classes(df: DataFrame, label: str):
    """(smallest, largest) class as (value, rows), whatever the number of
    classes; None with fewer than two."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    name = F.col(label).cast("string")
    r = counts.agg(F.min_by(F.struct(label, "n"), F.struct("n", name)).alias("lo"),
                   F.max_by(F.struct(label, "n"), F.struct("n", name)).alias("hi"), F.count(F.lit(1)).alias("k")).first()
    return ((r.lo[0], r.lo[1]), (r.hi[0], r.hi[1])) if r.k > 1 else None


def downsample(df: DataFrame, label: str, key: str, salt: int = 42) -> DataFrame:
    """M1: keep every minority row and a hash-chosen share
    minority / majority of the majority."""
    c = _extreme_classes(df, label)
    if c is None:
        return df
    (_, n_min), (majority, n_max) = c
    return df.filter(~F.col(label).eqNullSafe(F.lit(majority)) | (key_hash(key, salt) < n_min / n_max))


def upsample(df: DataFrame, label: str, key: str, salt: int = 42) -> DataFrame:
    """M2: replicate minority rows to the majority size: floor(r) copies
    each plus one more for a hash-chosen share of the fraction."""
    c = _extreme_classes(df, label)
    if c is None:
        return df
    (minority, n_min), (_, n_max) = c
    r = n_max / n_min
    whole = int(math.floor(r))
    copies = F.when(F.col(label).eqNullSafe(F.lit(minority)),
                    F.lit(whole) + F.when(key_hash(key, salt) < r - whole, 1).otherwise(0)).otherwise(1)
    return df.withColumn("__copies", F.sequence(F.lit(1), copies)).select(
        "*", F.explode("__copies").alias("replica")).drop("__copies")


def upsample_random(df: DataFrame, label: str, minority, ratio: float, seed: int = 42) -> DataFrame:
    """M2 (reference form): minority rows sampled with replacement."""
    up = df.filter(F.col(label) == F.lit(minority)).sample(True, ratio, seed)
    return df.filter(F.col(label) != F.lit(minority)).unionByName(up)


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """M3: weight = negatives/positives for positive rows, else 1."""
    pos, neg = df.agg(F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)).first()
    w = (neg / pos) if pos else 1.0
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(w)).otherwise(F.lit(1.0)))


def downsample_buckets(df: DataFrame, t: str, unit: str, label: str, key: str, salt: int = 42) -> DataFrame:
    """M4: downsample the majority class inside each day/week/month bucket;
    buckets holding one class are kept whole.  Class counts per bucket are
    a small aggregate (one row per bucket) joined back; AQE broadcasts it
    from its measured size."""
    b = df.withColumn("__bkt", F.date_trunc(unit, F.col(t)))
    cnt = b.groupBy("__bkt").agg(F.count_if(F.col(label) == 1).alias("__n1"), F.count_if(F.col(label) == 0).alias("__n0"))
    cnt = cnt.withColumn("__maj", F.when(F.col("__n1") > F.col("__n0"), 1).otherwise(0)).withColumn(
        "__thr", F.least("__n1", "__n0") / F.greatest("__n1", "__n0"))
    j = b.join(cnt, "__bkt")
    keep = ((F.col("__n1") == 0) | (F.col("__n0") == 0) | (F.col(label) != F.col("__maj"))
            | (key_hash(key, salt) < F.col("__thr")))
    return j.filter(keep).drop("__bkt", "__n1", "__n0", "__maj", "__thr")


def train_test_split(df: DataFrame, t: str, split=None, test_fraction: float | None = None,
                     upper=None) -> tuple[DataFrame, DataFrame]:
    """M5: split by a date (train < split <= test), or so that the test part
    is the last whole days of the span: floor(test_fraction * days) of them;
    optional upper limit on the data."""
    x = df if upper is None else df.filter(F.col(t) < F.lit(upper))
    if split is None:
        lo, hi = x.agg(F.min(t), F.max(t)).first()
        split = hi - timedelta(days=int((hi - lo).days * test_fraction))
    return x.filter(F.col(t) < F.lit(split)), x.filter(F.col(t) >= F.lit(split))


@dataclass
class Fold:
    fold: int
    train_lo: object
    train_hi: object
    val_lo: object
    val_hi: object


def cv_bounds(df: DataFrame, t: str, k: int = 3, blocking: bool = False, overlap: float = 0.0,
              method: str = "cumulative") -> list[Fold]:
    """M6: k folds by days, bounds relative to the earliest timestamp.

    chunk = ceil(days / (k + 1 - overlap (k - 1))).  Fold i validates on the
    chunk after its training end; the last end is clamped to the day after
    the data.  Training starts at 0 (expanding) or moves with the fold
    (``blocking``).  ``method``:

    * ``"cumulative"`` -- offsets advance cumulatively, the start by
      ceil((1 - overlap) chunk) and the end by floor((1 - overlap) chunk);
      this produced the published fold dates (``FOLDS``);
    * ``"truncated"`` -- offsets int(i (1 - overlap) chunk) and that + chunk,
      folds whose validation starts at or after the last time dropped;
    * ``"fixed_end"`` -- training ends at (i + 1) chunk whatever the overlap.
    """
    lo, hi = df.agg(F.min(t), F.max(t)).first()
    n_days = (hi - lo).days + 1
    width = k + 1 - overlap * (k - 1)
    chunk = int(math.ceil(n_days / width))
    step = (1 - overlap) * chunk
    out = []
    tmin = tmax = 0
    for i in range(k):
        if method == "cumulative":
            if i == 0:
                tmin, tmax = 0, chunk
            else:
                tmin += int(math.ceil(step))
                tmax += int(math.floor(step))
            ts = tmin if blocking else 0
            te = tmax
        elif method == "fixed_end":
            ts = int(i * step) if blocking else 0
            te = (i + 1) * chunk
        else:
            ts = int(i * step) if blocking else 0
            te = int(i * step + chunk)
        vs, ve = te, te + chunk
        f = Fold(i, lo + timedelta(days=ts), lo + timedelta(days=te), lo + timedelta(days=vs),
                 min(lo + timedelta(days=ve), hi + timedelta(days=1)))
        if method == "truncated" and f.val_lo >= hi:
            break
        out.append(f)
    return out


def folds_frame(spark, folds: list[Fold]) -> DataFrame:
    """Fold bounds as a DataFrame (fold, train_lo, train_hi, val_lo, val_hi)."""
    rows = [(f.fold, f.train_lo, f.train_hi, f.val_lo, f.val_hi) for f in folds]
    return spark.createDataFrame(rows, "fold int, train_lo timestamp, train_hi timestamp, val_lo timestamp, val_hi timestamp")


def fold_frames(df: DataFrame, t: str, folds: list[Fold]) -> list[tuple[DataFrame, DataFrame]]:
    """(train, validation) filters per fold, half-open [lo, hi)."""
    return [(df.filter((F.col(t) >= F.lit(f.train_lo)) & (F.col(t) < F.lit(f.train_hi))),
             df.filter((F.col(t) >= F.lit(f.val_lo)) & (F.col(t) < F.lit(f.val_hi)))) for f in folds]


def _row_folds(n: int, k: int, blocking: bool, overlap: float) -> list[tuple[int, int, int, int]]:
    """(train_lo, train_hi, val_lo, val_hi) as 1-based rows, ends inclusive.

    Without overlap chunk = floor(n / (k + 1)) and the last fold validates up
    to the row before the last one.  With it chunk = floor(n / (k + 1 -
    overlap (k - 1))), each fold starts floor((1 - overlap) chunk) rows after
    the one before and validates on the chunk after its training rows.
    """
    if not overlap:
        chunk = max(n // (k + 1), 1)
        edges = [i * chunk + 1 for i in range(k + 1)] + [n]
        return [(edges[i] if blocking else 1, edges[i + 1] - 1, edges[i + 1], edges[i + 2] - 1) for i in range(k)]
    chunk = math.floor(n / (k + 1 - overlap * (k - 1)))
    step = math.floor((1 - overlap) * chunk)
    return [(i * step + 1 if blocking else 1, i * step + chunk, i * step + chunk + 1, i * step + 2 * chunk) for i in range(k)]


def cv_bounds_rows(df: DataFrame, order: list[str], k: int = 3, blocking: bool = False, overlap: float = 0.0) -> DataFrame:
    """M7: k folds by row count on the global row order (``order`` unique),
    neighbours sharing ``overlap`` of a chunk (see ``_row_folds``).  Returns
    the rows with (fold, part), part train or val; a row may be in several
    folds.

    Nothing is sorted or numbered: the few rows at the folds' bounds are found
    by distributed selection (``selection.values_at``), and the folds are
    filters on the order columns.
    """
    from functools import reduce
    from leadtime.operators import selection as sel
    n = df.count()
    folds = _row_folds(n, k, blocking, overlap)
    at = sel.values_at(df, order, [p for f in folds for p in f])
    key = sel.row_key(order)

    def inside(lo: int, hi: int) -> Column:
        if lo > hi or lo > n:
            return F.lit(False)
        upto = key <= sel.key_literal(df, order, at[hi]) if hi < n else F.lit(True)
        return upto & (key >= sel.key_literal(df, order, at[lo])) if lo > 1 else upto

    out = []
    for i, (t_lo, t_hi, v_lo, v_hi) in enumerate(folds):
        part = F.when(inside(v_lo, v_hi), "val").when(inside(t_lo, t_hi), "train")
        out.append(df.withColumn("fold", F.lit(i)).withColumn("part", part).filter(F.col("part").isNotNull()))
    return reduce(lambda a, b: a.unionByName(b), out)


def row_fold_times(df: DataFrame, t: str, k: int = 3, blocking: bool = False, overlap: float = 0.0) -> DataFrame:
    """M7: the times of the rows at the folds' bounds, one row per fold:
    (fold, train_min, train_max, test_min, test_max); ties in ``t`` don't
    matter.  Bounds beyond the last row are NULL."""
    from leadtime.operators import selection as sel
    folds = _row_folds(df.count(), k, blocking, overlap)
    at = sel.values_at(df, [t], [p for f in folds for p in f])
    rows = [(i, *[at.get(p, (None,))[0] for p in f]) for i, f in enumerate(folds)]
    names = ["train_min", "train_max", "test_min", "test_max"]
    got = df.sparkSession.createDataFrame(rows, "fold int, " + ", ".join(f"{c} long" for c in names))
    kind = df.schema[t].dataType.simpleString()
    back = {"timestamp": F.timestamp_micros, "date": lambda c: F.date_from_unix_date(F.col(c).cast("int"))}.get(kind, lambda c: F.col(c).cast(kind))
    return got.select("fold", *[back(c).alias(c) for c in names])


def random_split(df: DataFrame, weights: list[float], seed: int = 42) -> list[DataFrame]:
    """M8."""
    return df.randomSplit(weights, seed)


def sample_n(df: DataFrame, n: int, key: str, salt: int = 7) -> DataFrame:
    """About n rows, chosen by the key hash (no driver collect); the
    number is binomial, so within 6 sqrt(n) of n but for one in a billion."""
    total = df.count()
    return df.filter(key_hash(key, salt) < (n / total if total else 0.0))


def bind_fold(df: DataFrame, i: int, templates: dict[str, str], fill: list[str] = ()) -> DataFrame:
    """Rename fold-suffixed columns (``{i}`` templates, e.g.
    'daily_{i}' -> 'daily') and zero-fill the listed columns."""
    m = {old.format(i=i): new for old, new in templates.items() if old.format(i=i) in df.columns}
    out = df.withColumnsRenamed(m)
    cols = [c for c in fill if c in out.columns]
    return out.fillna(0, subset=cols) if cols else out

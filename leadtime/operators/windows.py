"""Window operators (W1-W18) that stay exact when one key is huge.

A plain ``Window.partitionBy(site)`` puts the whole history of a site in one
task; with a hub holding a third of all rows that task never finishes.
Every per-entity window here is therefore evaluated on partitions
(entity, time bucket):

* range frames (look back ``span`` seconds): each row is also copied, as a
  *halo* row, into the following buckets whose frames can reach it
  (``range_halo``);
* row frames (look back ``n`` rows): the last ``n`` rows before each bucket
  are gathered from a per-bucket summary (at most ``n`` rows per bucket, so
  its size depends on the time span, not the data volume) and added to the
  bucket as halo rows (``rows_halo``).

Window functions then run over (entity, bucket); halo rows are dropped
afterwards.  Results equal the plain per-entity window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


_US = 1_000_000
DAY_S = 86_400.0


def _bucket(t: str, width_s: float) -> Column:
    return F.floor(F.unix_micros(F.col(t)) / F.lit(int(width_s * _US))).cast("long")


# ---------------------------------------------------------------------------
# Halo builders

def range_halo(df: DataFrame, t: str, back_s: float = 0.0, fwd_s: float = 0.0,
               width_s: float | None = None, carry: list[str] | None = None) -> DataFrame:
    """Add ``__bk`` (bucket) and ``__halo`` (0 own row / 1 copy).

    A row at time x is copied into every bucket whose rows may look back
    ``back_s`` seconds (or forward ``fwd_s``) and reach x.  With ``carry``
    the copies hold only those columns (the rest NULL): halo rows feed
    window frames and are dropped afterwards.
    """
    # Buckets at least four frame spans wide: only rows within one span of a
    # border are copied (<= 25 % extra rows), while a bucket still holds at
    # most a few days of one key.
    w = float(width_s or max(4 * back_s, 4 * fwd_s, DAY_S))
    w_us = int(w * _US)
    x = F.unix_micros(F.col(t))
    own = F.floor(x / F.lit(w_us)).cast("long")
    lo = F.floor((x - F.lit(int(fwd_s * _US))) / F.lit(w_us)).cast("long")
    hi = F.floor((x + F.lit(int(back_s * _US))) / F.lit(w_us)).cast("long")
    base = df.withColumn("__bk", own).withColumn("__halo", F.lit(0))
    src = df if carry is None else df.select(*dict.fromkeys([t, *carry]))
    copies = (src.withColumn("__own", own).withColumn("__bk", F.explode(F.sequence(lo, hi)))
              .filter(F.col("__bk") != F.col("__own")).drop("__own").withColumn("__halo", F.lit(1)))
    return base.unionByName(copies, allowMissingColumns=True)


def rows_halo(df: DataFrame, keys: list[str], t: str, tie: str, back: int = 0, fwd: int = 0,
              width_s: float = DAY_S, carry: list[str] | None = None) -> DataFrame:
    """Add ``__bk`` and ``__halo`` so each (keys, bucket) partition also holds
    the ``back`` rows before it and the ``fwd`` rows after it (per entity).
    With ``carry`` the halo rows hold only keys, order and those columns."""
    base = df.withColumn("__bk", _bucket(t, width_s)).withColumn("__halo", F.lit(0))
    cols = base.columns if carry is None else list(dict.fromkeys([*keys, t, tie, *carry, "__bk", "__halo"]))
    parts = [base]
    pk = [*keys, "__bk"]
    if back > 0:
        wd = Window.partitionBy(*pk).orderBy(F.col(t).desc(), F.col(tie).desc())
        tail = base.withColumn("__rr", F.row_number().over(wd)).filter(F.col("__rr") <= back)
        # a bucket's own last rows as one list each; the lists of the buckets
        # before fill up what it lacks, newest first
        own = (tail.groupBy(*pk).agg(F.array_sort(F.collect_list(F.struct(F.col("__rr"), F.struct(*cols).alias("__r"))), lambda a, b: a["__rr"] - b["__rr"]).alias("__l"))
               .select(*pk, F.transform("__l", lambda x: x["__r"]).alias("__l")))
        we = Window.partitionBy(*keys).orderBy("__bk").rowsBetween(-(back - 1), 0)
        last = own.withColumn("__lst", F.slice(F.flatten(F.reverse(F.collect_list("__l").over(we))), 1, back))
        nxt = last.withColumn("__to", F.lead("__bk").over(Window.partitionBy(*keys).orderBy("__bk")))
        h = (nxt.filter(F.col("__to").isNotNull())
             .select("__to", F.explode("__lst").alias("__r"))
             .select(*[F.col("__r")[c].alias(c) for c in cols if c not in ("__bk", "__halo")],
                     F.col("__to").alias("__bk"), F.lit(1).alias("__halo")))
        parts.append(h)
    if fwd > 0:
        wa = Window.partitionBy(*pk).orderBy(F.col(t).asc(), F.col(tie).asc())
        head = base.withColumn("__rr", F.row_number().over(wa)).filter(F.col("__rr") <= fwd)
        own = (head.groupBy(*pk).agg(F.array_sort(F.collect_list(F.struct(F.col("__rr"), F.struct(*cols).alias("__r"))), lambda a, b: a["__rr"] - b["__rr"]).alias("__l"))
               .select(*pk, F.transform("__l", lambda x: x["__r"]).alias("__l")))
        we = Window.partitionBy(*keys).orderBy("__bk").rowsBetween(0, fwd - 1)
        first = own.withColumn("__lst", F.slice(F.flatten(F.collect_list("__l").over(we)), 1, fwd))
        prv = first.withColumn("__to", F.lag("__bk").over(Window.partitionBy(*keys).orderBy("__bk")))
        h = (prv.filter(F.col("__to").isNotNull())
             .select("__to", F.explode("__lst").alias("__r"))
             .select(*[F.col("__r")[c].alias(c) for c in cols if c not in ("__bk", "__halo")],
                     F.col("__to").alias("__bk"), F.lit(1).alias("__halo")))
        parts.append(h)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _finish(df: DataFrame) -> DataFrame:
    return df.filter(F.col("__halo") == 0).drop("__halo", "__bk")


# ---------------------------------------------------------------------------
# Dedup / one row per key

def _first_row(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Per key the first row in ``order``: a row number limited to 1, of which
    Spark keeps one row per key and map task ahead of the shuffle (window
    group limit), so a key holding any share of the rows is no hot spot and
    whole rows are sorted, never aggregated."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def dedup_least_null(df: DataFrame, keys: list[str], feats: list[str], tie: list[str]) -> DataFrame:
    """Per key keep the row with the fewest NULLs among ``feats``;
    ``tie`` makes the pick deterministic (the reference has none)."""
    from leadtime.functions.text import null_count
    return _first_row(df, keys, [null_count(feats), *[F.col(c).asc_nulls_last() for c in tie]])


def first_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key, the first by ``order`` ascending, NULLs last
    (must be total)."""
    return _first_row(df, keys, [(F.col(c) if isinstance(c, str) else c).asc_nulls_last() for c in order])


# ---------------------------------------------------------------------------
# Row-offset windows

def prior_event(df: DataFrame, entity: str, t: str, tie: str, cols: list[str], prefix: str = "prior_",
                width_s: float = DAY_S) -> DataFrame:
    """The previous row's columns for the same entity (all lags
    taken over one window in one select)."""
    h = rows_halo(df, [entity], t, tie, back=1, width_s=width_s, carry=cols)
    w = Window.partitionBy(entity, "__bk").orderBy(t, tie)
    return _finish(h.select("*", *[F.lag(c).over(w).alias(f"{prefix}{c}") for c in cols]))


def interpolate_midpoint(df: DataFrame, key: str, t: str, tie: str, col: str,
                         width_s: float = DAY_S) -> DataFrame:
    """A NULL between two present neighbours becomes their mean."""
    h = rows_halo(df, [key], t, tie, back=1, fwd=1, width_s=width_s, carry=[col])
    w = Window.partitionBy(key, "__bk").orderBy(t, tie)
    prv, nxt = F.lag(col).over(w), F.lead(col).over(w)
    fill = F.when(F.col(col).isNull() & prv.isNotNull() & nxt.isNotNull(), (prv + nxt) / 2).otherwise(F.col(col))
    return _finish(h.withColumn(col, fill))


def ffill_rows(df: DataFrame, keys: list[str], t: str, tie: str, col: str, n: int,
               include_self: bool = False, overwrite: bool = False, out: str | None = None,
               width_s: float = DAY_S) -> DataFrame:
    """Last non-NULL value among the previous ``n`` rows.

    Default keeps the row's own value when present (coalesce); with
    ``overwrite=True`` and ``include_self=True`` the window value replaces it
    (the first reference version).
    """
    h = rows_halo(df, keys, t, tie, back=n, width_s=width_s, carry=[col])
    end = 0 if include_self else -1
    # Running last non-NULL (with its row number) instead of re-scanning an
    # n-row frame per row: O(1) per row whatever n is.
    w = Window.partitionBy(*keys, "__bk").orderBy(t, tie)
    h = h.withColumn("__rn", F.row_number().over(w))
    lastv = F.last(F.when(F.col(col).isNotNull(), F.struct(F.col("__rn").alias("i"), F.col(col).alias("v"))),
                   ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, end))
    h = h.withColumn("__lv", lastv)
    v = F.when(F.col("__lv.i") >= F.col("__rn") - n, F.col("__lv.v"))
    res = v if overwrite else F.coalesce(F.col(col), v)
    return _finish(h.withColumn(out or col, res).drop("__rn", "__lv"))


def ema_values(values: Column, alpha: float) -> Column:
    """Exponential smoothing of an array ordered oldest -> newest:
    sum((1-a)^i x) / sum((1-a)^i), i = 0 for the newest value; NULLs
    skipped; empty -> NULL."""
    vals = F.reverse(F.filter(values, lambda x: x.isNotNull()))
    idx = F.sequence(F.lit(0), F.size(vals) - 1)
    zipped = F.arrays_zip(vals.alias("v"), idx.alias("i"))
    init = F.struct(F.lit(0.0).alias("num"), F.lit(0.0).alias("den"))
    acc = F.aggregate(zipped, init, lambda a, z: F.struct(
        (a["num"] + z["v"] * F.pow(F.lit(1.0 - alpha), z["i"])).alias("num"),
        (a["den"] + F.pow(F.lit(1.0 - alpha), z["i"])).alias("den")))
    return F.when(F.size(vals) > 0, acc["num"] / acc["den"])


def ema_fill(df: DataFrame, key: str, t: str, tie: str, col: str | list[str], n: int, alpha: float,
             count_nonnull: bool = False, default: float | None = None, out: str | None = None,
             width_s: float = DAY_S) -> DataFrame:
    """Fill NULLs with an exponential smoothing of earlier values.

    ``count_nonnull=False``: the previous ``n`` rows (NULLs skipped).
    ``count_nonnull=True``: the last ``n`` non-NULL values up to and
    including the row, however far back (W13) -- evaluated on the non-NULL
    rows only, so the frame is again ``n`` rows.  Several columns (a list)
    are filled in place, for ``n`` rows by one halo and one window; ``out``
    names a single one.
    """
    if not count_nonnull:
        cols = [col] if isinstance(col, str) else list(col)
        h = rows_halo(df, [key], t, tie, back=n, width_s=width_s, carry=cols)
        w = Window.partitionBy(key, "__bk").orderBy(t, tie).rowsBetween(-n, -1)
        h = h.select("*", *[F.collect_list(c).over(w).alias(f"__fr{i}") for i, c in enumerate(cols)])
        rest = [F.lit(default)] if default is not None else []
        res = {(out if out and len(cols) == 1 else c): F.coalesce(F.col(c), ema_values(F.col(f"__fr{i}"), alpha), *rest)
               for i, c in enumerate(cols)}
        return _finish(h.withColumns(res).drop(*[f"__fr{i}" for i in range(len(cols))]))
    if not isinstance(col, str):
        out_df = df
        for c in col:
            out_df = ema_fill(out_df, key, t, tie, c, n, alpha, True, default, None, width_s)
        return out_df
    # Last n non-NULL values up to the row: rows with a value see their own
    # value and the n-1 before it among non-NULL rows; NULL rows take the
    # list of the latest non-NULL row before them.
    nn = df.filter(F.col(col).isNotNull())
    h = rows_halo(nn, [key], t, tie, back=n - 1, width_s=width_s, carry=[col])
    w = Window.partitionBy(key, "__bk").orderBy(t, tie).rowsBetween(-(n - 1), 0)
    lists = _finish(h.withColumn("__lst", F.collect_list(col).over(w))).select(
        F.col(key).alias("__k"), F.col(t).alias("__t"), F.col(tie).alias("__tie"), "__lst")
    # Attach each row's latest list at or before it (as-of on row order).
    allr = df.select("*", F.lit(0).alias("__src")).unionByName(
        lists.select(F.col("__k").alias(key), F.col("__t").alias(t), F.col("__tie").alias(tie), "__lst",
                     F.lit(1).alias("__src")), allowMissingColumns=True)
    h2 = rows_halo_last(allr, key, t, tie, "__src", "__lst", width_s)
    sm = ema_values(F.col("__lst"), alpha)
    res = F.coalesce(F.col(col), sm, F.lit(default)) if default is not None else F.coalesce(F.col(col), sm)
    return h2.withColumn(out or col, res).drop("__lst", "__src")


def rows_halo_last(df: DataFrame, key: str, t: str, tie: str, src: str, carry: str,
                   width_s: float) -> DataFrame:
    """Carry the newest non-NULL ``carry`` (set on rows with src=1) forward to
    the rows with src=0 at or after it, however far back it lies.

    Inside a bucket a running ``last(ignorenulls)`` does it; across buckets
    a per-bucket summary (one row per entity and bucket, so bounded by the
    time span) gives each bucket the newest value of earlier buckets.
    """
    b = df.withColumn("__bk", _bucket(t, width_s))
    w = (Window.partitionBy(key, "__bk").orderBy(t, tie, F.col(src).desc())
         .rowsBetween(Window.unboundedPreceding, 0))
    b = b.withColumn("__in", F.last(carry, ignorenulls=True).over(w))
    summ = (b.filter(F.col(carry).isNotNull()).groupBy(key, "__bk")
            .agg(F.max_by(carry, F.struct(t, tie)).alias("__bl"))
            .withColumn("__is", F.lit(1)))
    marks = (b.filter(F.col(src) == 0).select(key, "__bk").distinct()
             .withColumn("__bl", F.lit(None).cast(summ.schema["__bl"].dataType)).withColumn("__is", F.lit(0)))
    wb = (Window.partitionBy(key).orderBy("__bk", "__is")
          .rowsBetween(Window.unboundedPreceding, -1))
    prev = (marks.unionByName(summ).withColumn("__prev", F.last("__bl", ignorenulls=True).over(wb))
            .filter(F.col("__is") == 0).select(key, "__bk", "__prev"))
    out = b.filter(F.col(src) == 0).join(prev, [key, "__bk"], "left")
    return out.withColumn(carry, F.coalesce(F.col("__in"), F.col("__prev"))).drop("__in", "__prev", "__bk")


def last_before(df: DataFrame, marks: DataFrame, key: str, at: str, value: str, width: int = int(DAY_S * _US)) -> DataFrame:
    """``df`` with ``value`` of the newest row of ``marks`` (key, at, value;
    value not NULL) of the same key at or before the row's ``at`` (a number),
    however far back; NULL without one, or where key or ``at`` is NULL.

    Inside a bucket of ``width`` it is a running last value; a bucket's first
    rows take the last value of the key's earlier buckets, from a table with
    one row per key and bucket.
    """
    both = df.withColumn("__m", F.lit(0)).unionByName(marks.select(key, at, value).withColumn("__m", F.lit(1)), allowMissingColumns=True)
    both = both.withColumn("__bk", F.floor(F.col(at) / F.lit(width)).cast("long"))
    w = Window.partitionBy(key, "__bk").orderBy(F.col(at), F.desc("__m")).rowsBetween(Window.unboundedPreceding, 0)
    inside = both.withColumn("__in", F.last(value, ignorenulls=True).over(w))
    ends = (marks.withColumn("__bk", F.floor(F.col(at) / F.lit(width)).cast("long")).groupBy(key, "__bk")
            .agg(F.max_by(value, at).alias("__last")))
    need = df.select(key, F.floor(F.col(at) / F.lit(width)).cast("long").alias("__bk")).distinct().withColumn("__ask", F.lit(1))
    # the frame ends before the bucket itself
    wb = Window.partitionBy(key).orderBy("__bk").rangeBetween(Window.unboundedPreceding, -1)
    before = (need.withColumn("__last", F.lit(None).cast(marks.schema[value].dataType))
              .unionByName(ends.withColumn("__ask", F.lit(0))).withColumn("__prev", F.last("__last", ignorenulls=True).over(wb))
              .filter("__ask = 1").select(F.col(key).alias("__k2"), F.col("__bk").alias("__b2"), "__prev"))
    out = inside.filter("__m = 0").join(before, (F.col(key) == F.col("__k2")) & (F.col("__bk") == F.col("__b2")), "left")
    return out.withColumn(value, F.coalesce("__in", "__prev")).select(*df.columns, value)


def rolling_mean(df: DataFrame, keys: list[str], order: str, col: str, start: int = -30, end: int = -1,
                 out: str | None = None) -> DataFrame:
    """Mean over rows [start, end] relative to the row (daily tables:
    one row per key and day, so a key holds at most one row per day)."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(start, end)
    return df.withColumn(out or f"{col}_roll", F.avg(col).over(w))


def rolling_fill(df: DataFrame, key: str, t: str, tie: str, col: str, n: int = 8,
                 width_s: float = DAY_S) -> DataFrame:
    """NULL -> plain mean of the previous ``n`` rows."""
    h = rows_halo(df, [key], t, tie, back=n, width_s=width_s, carry=[col])
    w = Window.partitionBy(key, "__bk").orderBy(t, tie).rowsBetween(-n, -1)
    return _finish(h.withColumn(col, F.coalesce(F.col(col), F.avg(col).over(w))))


# ---------------------------------------------------------------------------
# Time-range windows

def ffill_range(df: DataFrame, keys: list[str], t: str, col: str | list[str], secs: float, out: str | None = None,
                width_s: float | None = None, tie: str | None = None) -> DataFrame:
    """Own value, else the latest non-NULL value of the same keys within
    the previous ``secs`` seconds.  A running ``last(ignorenulls)`` of
    (time, value) over (keys, time bucket) partitions -- rows within
    ``secs`` of a border are copied into the next bucket -- then an age
    check: O(1) per row instead of re-scanning a frame.  Rows at the same
    instant are ordered by ``tie`` (if given).  Several columns (a list) are
    filled in place by one halo and one window; ``out`` names a single one."""
    cols = [col] if isinstance(col, str) else list(col)
    h = range_halo(df, t, back_s=secs, width_s=width_s, carry=[*keys, *cols] + ([tie] if tie else []))
    x = F.unix_micros(F.col(t))
    order = [x] + ([F.col(tie)] if tie else []) + [F.col("__halo").desc()]
    w = Window.partitionBy(*keys, "__bk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    h = h.select("*", *[F.last(F.when(F.col(c).isNotNull(), F.struct(x.alias("t"), F.col(c).alias("v"))), ignorenulls=True).over(w)
                        .alias(f"__lv{i}") for i, c in enumerate(cols)])
    filled = {}
    for i, c in enumerate(cols):
        fresh = F.when(F.col(f"__lv{i}.t") >= x - F.lit(int(secs * _US)), F.col(f"__lv{i}.v"))
        filled[out if out and len(cols) == 1 else c] = F.coalesce(F.col(c), fresh)
    return _finish(h.withColumns(filled).drop(*[f"__lv{i}" for i in range(len(cols))]))


def range_mean_if(df: DataFrame, keys: list[str], t: str, col: str, cond: Column | None, secs: float,
                  out: str, include_current: bool = False, width_s: float | None = None) -> DataFrame:
    """Mean of ``col`` over rows of the same keys in the previous
    ``secs`` seconds where ``cond`` holds -- strictly earlier rows (rows at
    the same instant excluded) unless ``include_current``.  Row j counts for
    row i when t_i lies in (t_j, t_j + secs] (or [t_j, t_j + secs]):
    interval stabbing, O(n log n) however many rows a frame holds."""
    x = F.unix_micros(F.col(t))
    lo = x if include_current else x + F.lit(1)
    hi = x + F.lit(int(secs * _US))
    w_us = int((width_s or max(2 * secs, 3600.0)) * _US)
    return interval_means(df, keys, x, lo, hi, {out: col}, w_us, cond)


def lagged_stat(df: DataFrame, keys: list[str], sched: str, actual: str, cutoff: str | None, cols: dict[str, str],
                span_s: float = 4 * 3600.0, width_s: float | None = None,
                cutoff_s: float | None = None) -> DataFrame:
    """Stale-aware range mean.

    Over rows of the same keys scheduled in [sched - span, sched] (peers
    included), average only values whose *actual* time is before the
    row's cutoff: what was known at the cutoff.  NULL values are skipped;
    no qualifying value -> NULL.  ``cols`` maps output name -> value column.

    With a fixed cutoff offset (``cutoff_s``: cutoff = sched - cutoff_s)
    the statistic is an interval-stabbing sum: row j counts for row i
    exactly when sched_i lies in [max(sched_j, actual_j + cutoff_s + 1us),
    sched_j + span].  Each row emits +value at the interval start and
    -value just after its end; one ordered running sum per (keys, time
    bucket) -- intervals crossing a bucket border are copied into the next
    bucket -- yields sum and count at every row.  Cost O(n log n) whatever
    the number of rows inside a frame; sums run in DECIMAL, so they are
    exact.  With any cutoff *column* it is a two-sided question (scheduled in
    the span, actual before the cutoff), answered by dominance sums
    (``_dominance_means``).
    """
    if cutoff_s is None:
        return _dominance_means(df, keys, sched, actual, cutoff, cols, span_s, width_s)
    s_us = F.unix_micros(F.col(sched))
    lo = F.greatest(s_us, F.unix_micros(F.col(actual)) + F.lit(int(cutoff_s * _US) + 1))
    hi = s_us + F.lit(int(span_s * _US))
    w_us = int((width_s or max(2 * span_s, 3600.0)) * _US)
    return interval_means(df, keys, s_us, lo, hi, cols, w_us)


def interval_means(df: DataFrame, keys: list[str], probe_us: Column, lo_us: Column, hi_us: Column,
                   cols: dict[str, str], width_us: int, cond: Column | None = None) -> DataFrame:
    """Mean of each value over the rows whose interval [lo, hi] (microsecond
    epochs, computed per row) contains the probe time of the current row,
    same keys.  Interval stabbing by one ordered running sum per
    (keys, time bucket): +value at lo, -value just after hi, probes read
    the running sum; intervals crossing a bucket border are copied into the
    buckets they overlap (intervals must be short against the bucket).
    Sums are DECIMAL (exact); NULL values and rows failing ``cond`` are
    skipped; no value -> NULL.  Input rows pass through unchanged."""
    dec = "decimal(38,12)"
    names = list(cols)
    # NaN and infinite measures count as missing: they have no decimal form
    vals = [F.when(F.abs(F.col(v).cast("double")) < 1e25, F.col(v).cast(dec)) for v in cols.values()]
    if cond is not None:
        vals = [F.when(cond, v) for v in vals]
    ev = df.select(*[F.col(k) for k in keys], lo_us.alias("__lo"), hi_us.alias("__hi"),
                   *[v.alias(f"__v{i}") for i, v in enumerate(vals)])
    ev = ev.filter(F.col("__lo") <= F.col("__hi"))
    ev = ev.withColumn("__bk", F.explode(F.sequence(F.floor(F.col("__lo") / width_us).cast("long"),
                                                    F.floor(F.col("__hi") / width_us).cast("long"))))
    signs = F.explode(F.array(F.struct(F.col("__lo").alias("__t"), F.lit(1).alias("__sg")),
                              F.struct((F.col("__hi") + 1).alias("__t"), F.lit(-1).alias("__sg"))))
    ev = ev.select(*keys, "__bk", *[f"__v{i}" for i in range(len(names))], signs.alias("__e")).select(
        *keys, "__bk", F.col("__e.__t").alias("__t"), F.lit(0).alias("__kind"),
        *[(F.col(f"__v{i}") * F.col("__e.__sg")).alias(f"__v{i}") for i in range(len(names))],
        *[F.when(F.col(f"__v{i}").isNotNull(), F.col("__e.__sg")).otherwise(0).alias(f"__n{i}")
          for i in range(len(names))])
    # Probe rows carry the whole input row, so no row id / join back is needed.
    pr = df.select("*", F.floor(probe_us / width_us).cast("long").alias("__bk"), probe_us.alias("__t"),
                   F.lit(1).alias("__kind"), *[F.lit(None).cast(dec).alias(f"__v{i}") for i in range(len(names))],
                   *[F.lit(0).alias(f"__n{i}") for i in range(len(names))])
    u = pr.unionByName(ev, allowMissingColumns=True)
    w = (Window.partitionBy(*keys, "__bk").orderBy("__t", "__kind")
         .rowsBetween(Window.unboundedPreceding, 0))
    sums = {f"__s{i}": F.sum(f"__v{i}").over(w) for i in range(len(names))}
    cnts = {f"__c{i}": F.sum(f"__n{i}").over(w) for i in range(len(names))}
    run = u.withColumns({**sums, **cnts}).filter(F.col("__kind") == 1)
    return run.select(*[F.col(c) for c in df.columns],
                      *[F.when(F.col(f"__c{i}") > 0, F.col(f"__s{i}").cast("double") / F.col(f"__c{i}")).alias(name)
                        for i, name in enumerate(names)])


def _dominance_means(df: DataFrame, keys: list[str], sched: str, actual: str, cutoff: str, cols: dict[str, str],
                     span_s: float, width_s: float | None) -> DataFrame:
    """Means over rows scheduled in [sched - span, sched] with an actual time
    before the row's ``cutoff`` (any column).

    Rows are numbered by schedule inside (keys, time bucket), in buckets no
    shorter than the span, so a span is a difference of prefixes: up to its
    end in the row's bucket, less up to its start, plus the whole bucket before
    if it starts there.  A prefix of r rows is cut into dyadic blocks, one for
    each set bit of r, and a row lies in one block a level.  Each block is one
    sorted run by actual time in which a cutoff reads a running sum.  Cost is n
    log m rows for m rows a bucket, whatever the number of rows in a span;
    nothing is gathered, and a hot key is spread over buckets and blocks.
    Equal questions are asked once; sums are DECIMAL, so differences are exact.
    NULL times or cutoffs count for, or get, nothing.
    """
    dec = "decimal(38,12)"
    span = int(span_s * _US)
    width = max(int((width_s or max(2 * span_s, 3600.0)) * _US), span, 1)
    ks = [f"__k{i}" for i in range(len(keys))]
    key_cols = [F.col(k).alias(a) for k, a in zip(keys, ks)]
    s_us, a_us, c_us = (F.unix_micros(F.col(c)) for c in (sched, actual, cutoff))
    n = range(len(cols))
    # NaN and infinite measures count as missing: they have no decimal form
    vals = [F.when(F.abs(F.col(v).cast("double")) < 1e25, F.col(v).cast(dec)).alias(f"__v{i}") for i, v in enumerate(cols.values())]
    data = (df.select(*key_cols, s_us.alias("__s"), a_us.alias("__x"), *vals).filter("__s IS NOT NULL AND __x IS NOT NULL")
            .groupBy(*ks, "__s", "__x").agg(*[F.sum(f"__v{i}").alias(f"__v{i}") for i in n], *[F.count(f"__v{i}").alias(f"__n{i}") for i in n]))
    data = data.select(*ks, F.floor(F.col("__s") / width).cast("long").alias("__bk"), F.col("__s").alias("__t"), F.lit(1).alias("__kind"),
                       "__x", *[c for i in n for c in (f"__v{i}", f"__n{i}")])
    asks = df.select(*key_cols, s_us.alias("__s"), c_us.alias("__c")).filter("__s IS NOT NULL AND __c IS NOT NULL").distinct()
    own, low = F.floor(F.col("__s") / width).cast("long"), F.floor((F.col("__s") - span) / width).cast("long")

    def probe(bucket, t, kind, sign):
        return F.struct(bucket.alias("bk"), t.alias("t"), F.lit(kind).alias("kind"), F.lit(sign).alias("sign"))

    # kind 0 comes before the rows of its instant, kind 2 after them
    parts = F.array(probe(own, F.col("__s"), 2, 1), probe(low, F.col("__s") - span, 0, -1),
                    probe(F.when(low < own, low), (low + 1) * width, 2, 1))
    asks = asks.withColumn("__p", F.explode(parts)).filter("__p.bk IS NOT NULL").select(
        *ks, F.col("__p.bk").alias("__bk"), F.col("__p.t").alias("__t"), F.col("__p.kind").alias("__kind"), F.col("__c").alias("__x"),
        F.col("__p.sign").alias("__sign"), F.col("__s").alias("__ask"))
    both = data.unionByName(asks, allowMissingColumns=True)
    is_row = F.when(F.col("__kind") == 1, 1)
    w = Window.partitionBy(*ks, "__bk").orderBy("__t", "__kind", "__x")
    both = both.withColumn("__r", F.count(is_row).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    # row number r - 1 lies in block (k, (r - 1) >> k); a prefix of r rows has
    # block (k, (r >> k) - 1) for each set bit k: both are even numbers.  A
    # row only takes levels that a prefix of its bucket can have.
    both = both.withColumn("__m", F.count(is_row).over(Window.partitionBy(*ks, "__bk")))
    blocks = F.expr("filter(transform(sequence(0, length(bin(__m)) - 1), k -> struct(k AS k, "
                    "if(__kind = 1, shiftright(__r - 1, k), shiftright(__r, k) - 1) AS nd)), x -> x.nd % 2 = 0)")
    runs = both.withColumn("__b", F.explode(blocks)).select(
        *ks, "__bk", F.col("__b.k").alias("__lv"), F.col("__b.nd").alias("__nd"), "__ask", "__x", "__sign", "__kind",
        *[c for i in n for c in (f"__v{i}", f"__n{i}")])
    # Spread by block: the window below would else sort all levels of a task's
    # buckets where they were numbered, log m times the rows that came in.
    runs = runs.repartition(*ks, "__bk", "__lv", "__nd")
    wb = (Window.partitionBy(*ks, "__bk", "__lv", "__nd").orderBy(F.col("__x"), F.col("__kind") == 1)
          .rowsBetween(Window.unboundedPreceding, 0))
    runs = runs.select(*ks, "__ask", "__x", "__sign", "__kind", *[F.sum(f"__v{i}").over(wb).alias(f"__s{i}") for i in n],
                       *[F.sum(f"__n{i}").over(wb).alias(f"__c{i}") for i in n]).filter("__kind <> 1")
    got = runs.groupBy(*ks, "__ask", "__x").agg(*[F.sum(F.col(f"__s{i}") * F.col("__sign")).alias(f"__s{i}") for i in n],
                                                *[F.sum(F.col(f"__c{i}") * F.col("__sign")).alias(f"__c{i}") for i in n])
    got = got.select(*ks, "__ask", F.col("__x").alias("__cut"),
                     *[F.when(F.col(f"__c{i}") > 0, F.col(f"__s{i}").cast("double") / F.col(f"__c{i}")).alias(name) for i, name in enumerate(cols)])
    on = (s_us == F.col("__ask")) & (c_us == F.col("__cut"))
    for k, a in zip(keys, ks):
        on = on & F.col(k).eqNullSafe(F.col(a))
    return df.join(got, on, "left").drop(*ks, "__ask", "__cut")


# ---------------------------------------------------------------------------
# Row indices

def _numbered(df: DataFrame, order: list[str | Column]) -> DataFrame:
    """``df`` range-partitioned and sorted by ``order`` (names, or columns
    with a direction), with the partition (``__pid``) and the 0-based place in
    it (``__at``), written out.

    Ranges are sampled anew whenever a plan is evaluated, so two uses of an
    unwritten frame would disagree about the partitions; the stored numbers
    are the same for every reader.
    """
    from leadtime.sources.io import stage_to
    by = [F.col(c) if isinstance(c, str) else c for c in order]
    parts = df.repartitionByRange(*by).sortWithinPartitions(*by)
    # partition number in the upper bits, row number in the lower 33
    parts = parts.withColumn("__mid", F.monotonically_increasing_id())
    parts = parts.withColumns({"__pid": F.shiftright("__mid", 33), "__at": F.col("__mid").bitwiseAND((1 << 33) - 1)})
    return stage_to(parts.drop("__mid"))


def _add_offsets(rows: DataFrame, totals: DataFrame, value: str, keys: list[str] = ()) -> DataFrame:
    """Join ``__off``: the sum of ``value`` over earlier partitions (of the
    same ``keys``).  ``totals`` has one row per partition (and key)."""
    w = Window.partitionBy(*keys).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = totals.withColumn("__off", F.coalesce(F.sum(value).over(w), F.lit(0))).drop(value)
    on = F.col("__pid") == F.col("__p2")
    names = {"__pid": "__p2"}
    for i, k in enumerate(keys):
        names[k] = f"__k{i}"
        on = on & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return rows.join(offs.withColumnsRenamed(names), on).drop(*names.values())


def row_index(df: DataFrame, order: list[str | Column], out: str = "row_idx") -> DataFrame:
    """Global 1-based row number in ``order`` without a single-partition
    window: range-partition by the order, number rows inside each
    partition, add the preceding partitions' counts (a tiny table)."""
    rows = _numbered(df, order)
    counts = rows.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    return (_add_offsets(rows, counts, "__n").withColumn(out, (F.col("__off") + F.col("__at") + 1).cast("long"))
            .drop("__pid", "__at", "__off"))


def prefix_sum(df: DataFrame, order: str, weight: str, out: str) -> DataFrame:
    """Sum of ``weight`` over all rows strictly before each row in ``order``
    (``order`` unique), without a single-partition window: range-partition,
    local running sums, plus the totals of earlier partitions (one row per
    partition)."""
    rows = _numbered(df, [order])
    w = Window.partitionBy("__pid").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    tot = rows.groupBy("__pid").agg(F.sum(weight).alias("__t"))
    rows = rows.withColumn("__loc", F.coalesce(F.sum(weight).over(w), F.lit(0)))
    return (_add_offsets(rows, tot, "__t").withColumn(out, F.col("__off") + F.col("__loc"))
            .drop("__pid", "__at", "__loc", "__off"))


def grouped_prefix_sum(df: DataFrame, groups: list[str], order: str, weight: str, out: str) -> DataFrame:
    """Per group, the sum of ``weight`` over rows strictly before each row in
    ``order`` (unique within the group).  Range-partitioned on
    (groups, order): local running sums plus, from a table with one row per
    (partition, group), the totals of the group's earlier partitions."""
    rows = _numbered(df, [*groups, order])
    w = Window.partitionBy("__pid", *groups).orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    tot = rows.groupBy("__pid", *groups).agg(F.sum(weight).alias("__t"))
    rows = rows.withColumn("__loc", F.coalesce(F.sum(weight).over(w), F.lit(0)))
    return (_add_offsets(rows, tot, "__t", groups).withColumn(out, F.col("__off") + F.col("__loc"))
            .drop("__pid", "__at", "__loc", "__off"))


def index_ids(ids: DataFrame, id_col: str, out: str = "idx") -> DataFrame:
    """Dense 0-based index of distinct ids in sorted order."""
    return row_index(ids.select(id_col).distinct(), [id_col], out).withColumn(out, F.col(out) - 1)


def occurrence(df: DataFrame, keys: list[str], order: list[str], out: str = "occurrence",
               width_s: float = DAY_S) -> DataFrame:
    """Occurrence number of a row within its keys (1, 2, ...).

    When the first order column is a timestamp the count is built per
    (keys, day bucket) -- local row numbers plus the counts of the key's
    earlier buckets (one row per key and bucket) -- so a key holding a large
    share of the rows is still numbered by many tasks.
    """
    first = order[0]
    if dict(df.dtypes).get(first) not in ("timestamp", "timestamp_ntz"):
        # any other order: ranges of (keys, order), so one key may fill many
        # tasks; its count in earlier ranges is added to the local number
        rows = _numbered(df, [*keys, *order])
        cnt = rows.groupBy("__pid", *keys).agg(F.count(F.lit(1)).alias("__c"))
        local = rows.withColumn("__loc", F.row_number().over(Window.partitionBy("__pid", *keys).orderBy("__at")))
        return (_add_offsets(local, cnt, "__c", keys).withColumn(out, (F.col("__off") + F.col("__loc")).cast("int"))
                .drop("__pid", "__at", "__loc", "__off"))
    b = df.withColumn("__bk", _bucket(first, width_s))
    local = b.withColumn("__loc", F.row_number().over(Window.partitionBy(*keys, "__bk").orderBy(*order)))
    cnt = b.groupBy(*keys, "__bk").agg(F.count(F.lit(1)).alias("__c"))
    cnt = cnt.withColumn("__off", F.coalesce(F.sum("__c").over(
        Window.partitionBy(*keys).orderBy("__bk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    j = local.join(cnt.drop("__c"), [*keys, "__bk"])
    return j.withColumn(out, (F.col("__off") + F.col("__loc")).cast("int")).drop("__bk", "__loc", "__off")

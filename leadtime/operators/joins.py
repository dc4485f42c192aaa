"""Join operators.

The central one is the interval as-of join (J10): an equi key plus a
reading time inside [t - max_age, t - min_age], keeping the newest
reading.  It is planned as an equi join on (key, time bucket) where the
right side is replicated only into the (at most two) left buckets it can
serve, so a hot key is spread over its time buckets and the per-row pick
runs on the join's own partitioning with no extra shuffle.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadtime.functions.geo import haversine
from leadtime.operators._plan import as_list

_US = 1_000_000


def lookup_two_roles(fact: DataFrame, dim: DataFrame, dim_key: str, roles: dict[str, str],
                     cols: list[str]) -> DataFrame:
    """Join the same dimension twice (e.g. origin and destination).

    ``roles`` maps fact key column -> output prefix; dimension columns come
    out as ``<prefix><col>``.  Spark broadcasts the dimension from its file
    or measured size.
    """
    d = dim.select(dim_key, *cols)
    out = fact
    for fact_key, prefix in roles.items():
        r = d.select(F.col(dim_key).alias(f"__k_{prefix}"), *[F.col(c).alias(f"{prefix}{c}") for c in cols])
        out = out.join(r, out[fact_key] == r[f"__k_{prefix}"], "left").drop(f"__k_{prefix}")
    return out


def missing_keys(a: DataFrame, b: DataFrame, a_key: str, b_key: str | None = None) -> DataFrame:
    """Distinct keys of ``a`` with no match in ``b`` (anti join)."""
    b_key = b_key or a_key
    ka = a.select(F.col(a_key).alias("key")).distinct()
    kb = b.select(F.col(b_key).alias("key"))
    return ka.join(kb, "key", "left_anti")


def unmatched(a: DataFrame, b: DataFrame, a_key: str, b_key: str, b_required: list[str]) -> DataFrame:
    """Rows of ``a`` whose key is missing in ``b`` or whose match lacks
    any of ``b_required`` (left join + NULL test)."""
    bb = b.select(F.col(b_key).alias("__bk"), *[F.col(c).alias(f"__b_{c}") for c in b_required])
    j = a.join(bb, a[a_key] == bb["__bk"], "left")
    bad = F.col("__bk").isNull()
    for c in b_required:
        bad = bad | F.col(f"__b_{c}").isNull()
    return j.filter(bad).select(*a.columns,
                                F.when(F.col("__bk").isNull(), "missing").otherwise("incomplete").alias("reason"))


def match_rate(df: DataFrame, cols: list[str]) -> DataFrame:
    """Share of rows with a non-NULL value in each column, one pass."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in cols:
        aggs.append(F.count(F.col(c)).alias(f"n_{c}"))
    out = df.agg(*aggs)
    return out.select("n_rows", *[F.col(f"n_{c}") for c in cols],
                      *[(F.col(f"n_{c}") / F.col("n_rows")).alias(f"rate_{c}") for c in cols])


# ---------------------------------------------------------------------------
# Range-bounded pick (J10-J13): the shared plan shape.

def _range_pick(left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str],
                left_t: str, right_t: str, lo_us: int, hi_us: int, order: list[Column],
                row_id: str, width_us: int | None, how: str = "left") -> DataFrame:
    """Keep, per left row, the best right row with
    ``left_t + lo <= right_t <= left_t + hi`` (offsets in microseconds).

    Plan: the left row falls in bucket floor(t / W); a right row at r can
    serve left times in [r - hi, r - lo], i.e. buckets floor((r-hi)/W) ..
    floor((r-lo)/W) -- with W >= hi - lo that is at most two buckets.  The
    equi join on (keys, bucket) is followed by a ``row_number`` whose
    partitioning (keys, bucket, row_id) is already satisfied by the join,
    so the pick costs a local sort, not another shuffle.
    """
    span = hi_us - lo_us
    w = int(width_us or max(span, 1))
    lb = F.floor(F.unix_micros(F.col(left_t)) / F.lit(w)).cast("long")
    L = left.withColumn("__lb", lb)
    r_us = F.unix_micros(F.col(right_t))
    first_b = F.floor((r_us - F.lit(hi_us)) / F.lit(w)).cast("long")
    last_b = F.floor((r_us - F.lit(lo_us)) / F.lit(w)).cast("long")
    rk = [f"__rk{i}" for i in range(len(right_keys))]
    rcols = [c for c in right.columns]
    R = right.select(*[F.col(k).alias(a) for k, a in zip(right_keys, rk)], *rcols,
                     F.explode(F.sequence(first_b, last_b)).alias("__rb"))
    cond = [L[lk] == R[a] for lk, a in zip(left_keys, rk)] + [L["__lb"] == R["__rb"]]
    t_us = F.unix_micros(L[left_t])
    cond.append(r_us >= t_us + F.lit(lo_us))
    cond.append(F.unix_micros(R[right_t]) <= t_us + F.lit(hi_us))
    j = L.join(R, reduce(lambda a, b: a & b, cond), how)
    win = Window.partitionBy(*[L[k] for k in left_keys], L["__lb"], L[row_id]).orderBy(*order)
    out = j.withColumn("__rn", F.row_number().over(win)).filter(F.col("__rn") == 1)
    return out.drop("__rn", "__lb", "__rb", *rk)


def _asof_sorted(left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str],
                 left_t: str, right_t: str, back_us: int | None, fwd_us: int | None, probe_shift_us: int,
                 tie: str | None, width_us: int) -> DataFrame:
    """Sort-based as-of lookup (no candidate explosion).

    Left and right rows are unioned, partitioned by (key, time bucket) and
    scanned in time order: ``last(right, ignorenulls)`` gives, for each left
    probe at ``left_t - probe_shift``, the newest right row at or before it;
    ``first(right, ignorenulls)`` on the opposite scan the oldest at or
    after it.  Right rows are also copied (halo) into the neighbouring
    bucket when they lie within the look-back/forward distance of it, so a
    match never depends on bucket borders and a hot key is still spread over
    its time buckets.  Each left row comes out exactly once.
    """
    rk = [f"__rk{i}" for i in range(len(right_keys))]
    rcols = right.columns
    r_us = F.unix_micros(F.col(right_t))
    w = F.lit(width_us)
    tie_type = right.schema[tie].dataType.simpleString() if tie else "long"
    Rt = right.select(*[F.col(k).alias(a) for k, a in zip(right_keys, rk)], r_us.alias("__ts"),
                      (F.col(tie) if tie else F.lit(0).cast("long")).alias("__tie"),
                      F.struct(*[F.col(c) for c in rcols]).alias("__r"))
    Rt = Rt.dropna(subset=rk)   # a NULL key matches nothing
    lo_b = F.floor((F.col("__ts") - F.lit(fwd_us or 0)) / w).cast("long")
    hi_b = F.floor((F.col("__ts") + F.lit(back_us or 0)) / w).cast("long")
    Rt = Rt.withColumn("__bk", F.explode(F.sequence(lo_b, hi_b))).withColumn("__kind", F.lit(0))
    Lt = left.select(*[F.col(c) for c in left.columns],
                     *[F.col(k).alias(a) for k, a in zip(left_keys, rk)],
                     (F.unix_micros(F.col(left_t)) - F.lit(probe_shift_us)).alias("__ts"),
                     F.lit(None).cast(tie_type).alias("__tie"), F.lit(1).alias("__kind"))
    Lt = Lt.withColumn("__bk", F.floor(F.col("__ts") / w).cast("long"))
    u = Lt.unionByName(Rt, allowMissingColumns=True)
    part = [*rk, "__bk"]
    res = {}
    if back_us is not None:
        wb = (Window.partitionBy(*part).orderBy("__ts", "__kind", "__tie")
              .rowsBetween(Window.unboundedPreceding, 0))
        res["__b"] = F.last(F.when(F.col("__kind") == 0, F.struct("__ts", "__r")), ignorenulls=True).over(wb)
    if fwd_us is not None:
        # the next reading, as the last one of the opposite order: a frame that
        # ends at the last row would be read anew for every row
        wf = (Window.partitionBy(*part).orderBy(F.col("__ts").desc(), F.col("__kind").asc(), F.col("__tie").asc())
              .rowsBetween(Window.unboundedPreceding, 0))
        res["__f"] = F.last(F.when(F.col("__kind") == 0, F.struct("__ts", "__r")), ignorenulls=True).over(wf)
    u = u.withColumns(res).filter(F.col("__kind") == 1)
    pick = None
    if back_us is not None:
        okb = F.col("__b").isNotNull() & (F.col("__b.__ts") >= F.col("__ts") - F.lit(back_us))
        b = F.when(okb, F.col("__b"))
        pick = b
    if fwd_us is not None:
        okf = F.col("__f").isNotNull() & (F.col("__f.__ts") <= F.col("__ts") + F.lit(fwd_us))
        f = F.when(okf, F.col("__f"))
        if pick is None:
            pick = f
        else:
            db = F.col("__ts") - F.col("__b.__ts")
            df_ = F.col("__f.__ts") - F.col("__ts")
            # nearest; equal distance -> the later reading
            pick = (F.when(b.isNull(), f).when(f.isNull(), b)
                    .when(df_ <= db, f).otherwise(b))
    out = u.withColumn("__p", pick)
    return out.select(*[F.col(c) for c in left.columns], *[F.col("__p.__r")[c].alias(c) for c in rcols],
                      F.col("__p").isNotNull().alias("__matched"))


def asof_join(left: DataFrame, right: DataFrame, left_on, right_on, left_t: str, right_t: str,
              min_age_s: float, max_age_s: float, row_id: str | None = None, tie: str | None = None,
              bucket_s: float | None = None, how: str = "left", method: str = "sort") -> DataFrame:
    """Interval as-of join.

    For every left row keep the right row with the same key whose time lies
    in [left_t - max_age, left_t - min_age], newest first, ties broken by
    ``tie`` descending.  ``how='left'`` keeps unmatched left rows with NULL
    right columns (``'inner'`` drops them).  Right columns must not clash
    with left ones (prefix them first, see ``prefix``).

    ``method='sort'`` (default): newest right row at or before
    left_t - min_age by one ordered scan, accepted if not older than
    max_age -- cost O(n log n), independent of how many readings fall in
    the window.  ``method='join'``: bucketed equi join + per-row pick
    (needs a unique ``row_id``); kept as an independent formulation.
    """
    if method == "join":
        order = [F.col(right_t).desc_nulls_last()]
        if tie:
            order.append(F.col(tie).desc_nulls_last())
        width = int(bucket_s * _US) if bucket_s else None
        return _range_pick(left, right, as_list(left_on), as_list(right_on), left_t, right_t,
                           -int(round(max_age_s * _US)), -int(round(min_age_s * _US)), order, row_id, width, how)
    span = int(round((max_age_s - min_age_s) * _US))
    # Bucket = two window spans (at least an hour): readings within one span
    # of a bucket border are copied into the next bucket, and a hot key is
    # cut into many (key, bucket) partitions.
    width = int(bucket_s * _US) if bucket_s else max(2 * span, int(3600 * _US))
    out = _asof_sorted(left, right, as_list(left_on), as_list(right_on), left_t, right_t, span, None,
                       int(round(min_age_s * _US)), tie, width)
    if how == "inner":
        out = out.filter("__matched")
    return out.drop("__matched")


def nearest_in_time(left: DataFrame, right: DataFrame, left_on, right_on, left_t: str, right_t: str,
                    tolerance_s: float, row_id: str | None = None, tie: str | None = None, how: str = "left",
                    method: str = "sort") -> DataFrame:
    """J12 core: right row with the same key nearest in time within
    +-tolerance (equal distance: the later one; then ``tie`` descending)."""
    tol = int(round(tolerance_s * _US))
    if method == "join":
        dist = F.abs(F.unix_micros(F.col(right_t)) - F.unix_micros(F.col(left_t)))
        order = [dist.asc_nulls_last(), F.col(right_t).desc_nulls_last()]
        if tie:
            order.append(F.col(tie).desc_nulls_last())
        return _range_pick(left, right, as_list(left_on), as_list(right_on), left_t, right_t,
                           -tol, tol, order, row_id, None, how)
    out = _asof_sorted(left, right, as_list(left_on), as_list(right_on), left_t, right_t, tol, tol, 0, tie,
                       max(2 * tol, int(3600 * _US)))
    if how == "inner":
        out = out.filter("__matched")
    return out.drop("__matched")


def fill_from_neighbor(df: DataFrame, nbrs: DataFrame, key: str, t: str, cols: list[str], row_id: str,
                       nbr_key: str = "neighbor", tolerance_s: float | None = 86400.0,
                       min_age_s: float | None = None, max_age_s: float | None = None) -> DataFrame:
    """Fill NULL measures from a neighbouring site's reading.

    * default: the neighbour's reading nearest in time within ``tolerance_s``
      (J12);
    * ``min_age_s``/``max_age_s``: only neighbour readings that old (J13);
    * ``tolerance_s=None`` and no ages: the neighbour's reading at the same
      instant (J14, plain equi join).
    Only neighbour readings where the measure is present are used; one
    neighbour per site (``nbrs``: key -> nbr_key).  All measures are looked up
    together: one scan in time order keeps, for each measure, the last (and
    the next) reading that has it, so shuffles don't grow with their number.
    """
    # only rows that miss a measure are looked up; the rest pass through
    full = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    need = df.filter(~full).join(nbrs.select(F.col(key).alias("__k"), F.col(nbr_key).alias("__nbr")), F.col(key) == F.col("__k"), "left").drop("__k")
    some = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in cols])
    src = df.filter(some & F.col(key).isNotNull()).select(F.col(key).alias("__nk"), F.col(t).alias("__nt"), F.col(row_id).alias("__nid"),
                                 *[F.col(c).alias(f"__v{i}") for i, c in enumerate(cols)])
    if tolerance_s is None and min_age_s is None:
        best = src.groupBy("__nk", "__nt").agg(*[F.max_by(f"__v{i}", F.when(F.col(f"__v{i}").isNotNull(), F.col("__nid"))).alias(f"__v{i}")
                                                 for i in range(len(cols))])
        got = need.join(best, (F.col("__nbr") == F.col("__nk")) & (F.col(t) == F.col("__nt")), "left").drop("__nk", "__nt")
    elif min_age_s is not None:
        got = _last_of_each(need, src, t, len(cols), int(round((max_age_s - min_age_s) * _US)), None, int(round(min_age_s * _US)))
    else:
        tol = int(round(tolerance_s * _US))
        got = _last_of_each(need, src, t, len(cols), tol, tol, 0)
    filled = got.withColumns({c: F.coalesce(F.col(c), F.col(f"__v{i}")) for i, c in enumerate(cols)})
    return df.filter(full).unionByName(filled.select(df.columns))


def _last_of_each(need: DataFrame, src: DataFrame, t: str, n: int, back_us: int, fwd_us: int | None, shift_us: int) -> DataFrame:
    """``need`` with ``__v0`` .. : for each value column of ``src`` (key
    ``__nk``, time ``__nt``, tie ``__nid``) the one of the reading nearest to
    ``t`` - shift that has it, of the row's neighbour ``__nbr``, up to
    ``back_us`` before and (if given) ``fwd_us`` after; equal distances go to
    the later one.  The scan of ``_asof_sorted`` with one running state per
    value column."""
    width = F.lit(max(2 * max(back_us, fwd_us or 0), 3600 * _US))
    r = src.select(F.col("__nk").alias("__nbr"), F.unix_micros("__nt").alias("__ts"), F.col("__nid").alias("__tie"),
                   *[f"__v{i}" for i in range(n)], F.lit(0).alias("__kind"))
    r = r.withColumn("__bk", F.explode(F.sequence(F.floor((F.col("__ts") - F.lit(fwd_us or 0)) / width).cast("long"),
                                                  F.floor((F.col("__ts") + F.lit(back_us)) / width).cast("long"))))
    p = need.withColumn("__ts", F.unix_micros(F.col(t)) - F.lit(shift_us)).withColumn("__kind", F.lit(1))
    both = p.withColumn("__bk", F.floor(F.col("__ts") / width).cast("long")).unionByName(r, allowMissingColumns=True)
    before = Window.partitionBy("__nbr", "__bk").orderBy("__ts", "__kind", "__tie").rowsBetween(Window.unboundedPreceding, 0)
    # the next reading, as the last one of the opposite order (``_asof_sorted``)
    after = (Window.partitionBy("__nbr", "__bk").orderBy(F.col("__ts").desc(), F.col("__kind").asc(), F.col("__tie").asc())
             .rowsBetween(Window.unboundedPreceding, 0))

    def known(i):
        return F.when((F.col("__kind") == 0) & F.col(f"__v{i}").isNotNull(), F.struct(F.col("__ts").alias("t"), F.col(f"__v{i}").alias("v")))

    cols = [F.last(known(i), ignorenulls=True).over(before).alias(f"__b{i}") for i in range(n)]
    if fwd_us is not None:
        cols += [F.last(known(i), ignorenulls=True).over(after).alias(f"__f{i}") for i in range(n)]
    seen = both.select("*", *cols).filter("__kind = 1")
    picks = {}
    for i in range(n):
        b = F.when(F.col(f"__b{i}.t") >= F.col("__ts") - back_us, F.col(f"__b{i}"))
        if fwd_us is None:
            picks[f"__v{i}"] = b["v"]
        else:
            f = F.when(F.col(f"__f{i}.t") <= F.col("__ts") + fwd_us, F.col(f"__f{i}"))
            later = b.isNull() | (f["t"] - F.col("__ts") <= F.col("__ts") - b["t"])
            picks[f"__v{i}"] = F.when(f.isNotNull() & later, f["v"]).otherwise(b["v"])
    return seen.withColumns(picks).drop("__ts", "__kind", "__bk", "__tie", *[f"__{x}{i}" for x in ("b", "f") for i in range(n)])


def semi_reduce(big: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Keep only rows of a big fact whose keys occur in ``keys``.

    A left-semi join.  The distinct key set is derived from another fact,
    so its size is only known at run time: AQE broadcasts it when the
    materialised key stage is small, otherwise it stays a shuffle semi join
    (a count-based check would compute the keys twice).
    """
    return big.join(keys.select(*on).distinct(), on, "left_semi")


def day_keys(df: DataFrame, site: str, lo_t: str, hi_t: str) -> DataFrame:
    """J9 helper: (site, day) pairs touched by the window [lo_t, hi_t] --
    both days when the window crosses midnight."""
    return (df.select(F.col(site).alias("site"),
                      F.explode(F.sequence(F.to_date(lo_t), F.to_date(hi_t))).alias("day"))
            .distinct())


def match_any(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], row_id: str | None,
              order_col: str, valid_from: str | None = None, valid_to: str | None = None,
              left_t: str | None = None) -> DataFrame:
    """OR-condition join without pairs.

    A right row matches if any (left_col, right_col) pair is equal (and,
    when given, ``left_t`` is within [valid_from, valid_to]; a NULL bound or
    time never matches); per left row the match with the latest ``order_col``
    wins (NULL last, then the least other columns).  Right rows are numbered
    by that order once, so a winner is a least number: the least of a key --
    or, with validity bounds, of the key's segment of time in which the left
    row falls (``winning_segments``) -- and then of the branches.  One join
    fetches its columns.  Every left row comes out once, repeated ones too;
    no pair of rows is built that isn't in the result.  ``row_id`` is not
    needed (kept for callers).
    """
    from leadtime.operators.windows import last_before, row_index
    others = [c for c in right.columns if c != order_col]
    ranked = row_index(right, [F.col(order_col).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in others]], "__prio")
    bounded = bool(left_t and (valid_from or valid_to))
    out, found = left, []
    for i, (lc, rc) in enumerate(pairs):
        prio = f"__p{i}"
        if bounded:
            seg = winning_segments(ranked, rc, "__prio", valid_from, valid_to)
            probes = out.withColumns({"__key": F.col(lc).cast(right.schema[rc].dataType),
                                      "__at": F.unix_micros(F.col(left_t).cast("timestamp"))})
            # segments without a valid row end the ones before them
            out = last_before(probes, seg.select("__key", F.col("__from").alias("__at"), F.coalesce("__prio", F.lit(-1)).alias(prio)),
                              "__key", "__at", prio).withColumn(prio, F.when(F.col(prio) >= 0, F.col(prio))).drop("__key", "__at")
        else:
            best = ranked.filter(F.col(rc).isNotNull()).groupBy(F.col(rc).alias("__key")).agg(F.min("__prio").alias(prio))
            out = out.join(best, F.col(lc) == F.col("__key"), "left").drop("__key")
        found.append(prio)
    out = out.withColumn("__win", F.least(*found) if len(found) > 1 else F.col(found[0])).drop(*found)
    return out.join(ranked, F.col("__win") == F.col("__prio"), "left").drop("__win", "__prio")


# The first microsecond of year 1, before every timestamp (fixed value).
_FIRST_US = -62_135_596_800_000_000


def winning_segments(ranked: DataFrame, key: str, prio: str, valid_from: str | None, valid_to: str | None) -> DataFrame:
    """The time line of each key cut into segments with one winner each:
    ``__key, __from`` (microseconds; a segment lasts until the key's next) and
    ``prio``, the least one among rows valid throughout it (NULL: none).

    Interval ends are numbered per key, and an interval of numbers is cut into
    at most two dyadic nodes a level; a node keeps the least number of the
    rows on it, and a segment takes the least over the nodes above it.  All of
    it is grouped minima combined map-side: n log n rows for n intervals of a
    key, spread by node, so a key with any share of the rows is many tasks'
    work and nested or overlapping intervals cost nothing extra.
    """
    from leadtime.operators.windows import occurrence
    lo = F.unix_micros(F.col(valid_from).cast("timestamp")) if valid_from else F.lit(_FIRST_US)
    hi = F.unix_micros(F.col(valid_to).cast("timestamp")) + 1 if valid_to else F.lit((1 << 63) - 1)
    iv = ranked.select(F.col(key).alias("__key"), lo.alias("__lo"), hi.alias("__hi"), F.col(prio).alias("__prio"))
    iv = iv.filter("__key IS NOT NULL AND __lo < __hi")
    ends = iv.select("__key", F.explode(F.array("__lo", "__hi")).alias("__from")).distinct()
    ends = occurrence(ends, ["__key"], ["__from"], "__no")
    count = ends.groupBy("__key").agg(F.max("__no").alias("__n"))
    for side in ("__lo", "__hi"):
        at = ends.select(F.col("__key").alias("__k"), F.col("__from").alias("__x"), (F.col("__no") - 1).cast("long").alias(f"{side}_no"))
        iv = iv.join(at, (F.col("__key") == F.col("__k")) & (F.col(side) == F.col("__x"))).drop("__k", "__x")
    # at level k the nodes from ceil(lo / 2^k) to floor(hi / 2^k), exclusive,
    # lie inside; the first if odd and the last if even have no such parent
    levels = iv.withColumn("__lv", F.explode(F.expr("sequence(0, length(bin(__hi_no - __lo_no)))")))
    levels = levels.withColumns({"__a": F.expr("shiftright(__lo_no + shiftleft(1L, __lv) - 1, __lv)"), "__b": F.expr("shiftright(__hi_no, __lv)")})
    nodes = (levels.filter("__a < __b")
             .withColumn("__nd", F.explode(F.expr("filter(array(if(__a % 2 = 1, __a, -1L), if(__b % 2 = 1, __b - 1, -1L)), x -> x >= 0)")))
             .groupBy("__key", "__lv", "__nd").agg(F.min("__prio").alias("__prio")).withColumnRenamed("__key", "__k"))
    segs = ends.join(count, "__key").withColumn("__lv", F.explode(F.expr("sequence(0, length(bin(cast(__n as long))))")))
    segs = segs.withColumn("__nd", F.expr("shiftright(cast(__no - 1 as long), __lv)"))
    hit = segs.join(nodes.withColumnsRenamed({"__lv": "__l2", "__nd": "__n2"}),
                    (F.col("__key") == F.col("__k")) & (F.col("__lv") == F.col("__l2")) & (F.col("__nd") == F.col("__n2")), "left")
    return hit.groupBy("__key", "__from").agg(F.min("__prio").alias(prio))


def assign_intervals(df: DataFrame, bounds: DataFrame, t: str, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Range join of rows to [lo, hi) intervals; a row may fall in
    several.  The bounds table is one row per fold, so Spark plans a
    broadcast nested-loop join over a handful of rows."""
    return df.join(bounds, (df[t] >= bounds[lo]) & (df[t] < bounds[hi]), "inner")


def apply_seasonality(df: DataFrame, weekly: DataFrame, yearly: DataFrame, site: str, ts: str,
                      suffix: str = "") -> DataFrame:
    """Composite equi lookups (site, dow, hour) and (site, month, dom).

    Lookup tables hold at most 168 / 366 rows per site.  They are usually
    aggregates of the fact itself, so AQE decides the broadcast from their
    measured size (a count would recompute the aggregation).
    """
    wk = weekly.select(F.col("site").alias("__s1"), F.col("dow").alias("__dow"), F.col("hour").alias("__hr"),
                       F.col("weekly").alias(f"weekly{suffix}"), F.col("daily").alias(f"daily{suffix}"))
    yr = yearly.select(F.col("site").alias("__s2"), F.col("month").alias("__mo"), F.col("dom").alias("__dom"),
                       F.col("yearly").alias(f"yearly{suffix}"), F.col("holidays").alias(f"holidays{suffix}"))
    out = df.join(wk, (df[site] == wk["__s1"]) & (F.dayofweek(df[ts]) == wk["__dow"]) & (F.hour(df[ts]) == wk["__hr"]), "left")
    out = out.join(yr, (out[site] == yr["__s2"]) & (F.month(out[ts]) == yr["__mo"]) & (F.dayofmonth(out[ts]) == yr["__dom"]), "left")
    return out.drop("__s1", "__dow", "__hr", "__s2", "__mo", "__dom")


def join_back(df: DataFrame, agg: DataFrame, keys: list[str]) -> DataFrame:
    """Attach aggregates on their keys (left join)."""
    return df.join(agg, keys, "left")


def merge_counts(df: DataFrame, key: str, cls: str, classes: list) -> DataFrame:
    """Per-class counts side by side -- one grouped conditional count
    instead of one group-by per class plus full outer joins."""
    return df.groupBy(key).agg(*[F.count_if(F.col(cls) == F.lit(c)).alias(f"n_{c}") for c in classes])


def history_avg_selfjoin(df: DataFrame, keys: list[str], t: str, value: str, cond: Column | None,
                         span_s: float, row_id: str | None = None) -> DataFrame:
    """Mean of ``value`` over earlier rows of the same keys within
    ``span_s`` seconds (strictly before), optionally only where ``cond``.

    The reference writes this as an inequality self-join; every pair it
    would produce is an earlier row j whose window (t_j, t_j + span]
    contains t_i, so it is evaluated as interval stabbing -- one ordered
    running sum per (keys, time bucket) -- without materialising the pairs.
    Adds ``hist_avg``.
    """
    from leadtime.operators.windows import interval_means
    x = F.unix_micros(F.col(t))
    width = int(max(2 * span_s, 3600.0) * _US)
    return interval_means(df, keys, x, x + F.lit(1), x + F.lit(int(span_s * _US)), {"hist_avg": value}, width, cond)


def attach_wide(df: DataFrame, long: DataFrame, key: str, pivot_col: str, value: str,
                values: list, prefix: str) -> DataFrame:
    """One column per fold: pivot the long table once, then one join."""
    wide = long.groupBy(key).pivot(pivot_col, values).agg(F.first(value))
    wide = wide.select(key, *[F.col(str(v)).alias(f"{prefix}{v}") for v in values])
    return df.join(wide, key, "left")


def align_predictions(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Inner join of two prediction sets on (entity, time)."""
    return a.join(b, on, "inner")


def expand_neighbors(df: DataFrame, nbrs: DataFrame, key: str) -> DataFrame:
    """One-to-many neighbour expansion (left join)."""
    return df.join(nbrs, key, "left")


def dedup_keep_non(df: DataFrame, keys: list[str], type_col: str, bad_value) -> DataFrame:
    """For duplicated keys drop rows of the unwanted report type; keep
    unique keys as they are.  Key counts come from a grouped count
    (map-side combined, so a hot key is pre-aggregated) joined back on the
    keys -- AQE splits a skewed key on the big side of that join."""
    cnt = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    j = df.join(cnt, [df[k].eqNullSafe(cnt[k]) for k in keys]).drop(*[cnt[k] for k in keys])
    return (j.filter((F.col("__n") == 1) | ~F.coalesce(F.col(type_col) == F.lit(bad_value), F.lit(False)))
            .drop("__n"))


def overlap(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``a`` that also occur in ``b`` on the given keys."""
    return a.join(b.select(*on).distinct(), on, "left_semi")


# ---------------------------------------------------------------------------
# Nearest site (J6/J7/F23): exact grid search, no cross join.

def nearest(points: DataFrame, sites: DataFrame, point_id: str, p_lat: str, p_lon: str,
            site_id: str, s_lat: str, s_lon: str, cell_deg: float | None = None, unit: str = "km", k: int = 1) -> DataFrame:
    """Nearest site (or the ``k`` nearest sites) per point by haversine
    distance, exact.

    Both sides are keyed by grid cells.  A round compares each unresolved
    point only with the sites in the 3x3 block of cells around it (sites are
    replicated into the cells they can serve) and accepts the best candidate
    once it is provably closer than anything outside the block; the rest go
    to the next round with cells three times as wide, until the block spans
    the globe.  The cells divide the circle evenly, so blocks wrap around the
    date line without overlap.  Distances are compared at 1e-6 (mm)
    resolution so floating-point noise cannot decide between equally distant
    sites; ties break on ``site_id``.  Output: point_id, site_id, distance;
    points without coordinates (or with no site at all) have NULLs.

    With ``k`` above 1 a point is done when its k-th best candidate is closer
    than anything outside the block; candidates are cut to k per point and
    task ahead of the shuffle (window group limit).  There is one row per
    point and site, with its ``rank``, and fewer than k where there are fewer
    sites; points without any have one row with NULLs.
    """
    from leadtime.functions.geo import EARTH_RADIUS
    from leadtime.sources.io import remove_path, stage_path, stage_to
    R = EARTH_RADIUS[unit]
    spark = points.sparkSession
    if cell_deg is None:
        # About two sites per cell on average over the sites' bounding box
        # (one small aggregate over the site dimension).
        b = sites.agg(F.min(s_lat), F.max(s_lat), F.min(s_lon), F.max(s_lon), F.count(s_lat)).first()
        cell_deg = 1.0
        if b[4]:
            area = max(b[1] - b[0], 0.01) * max(b[3] - b[2], 0.01)
            cell_deg = float(min(max(math.sqrt(2.0 * area / b[4]), 0.05), 30.0))
    S = sites.select(F.col(site_id).alias("__sid"), F.col(s_lat).cast("double").alias("__slat"),
                     F.col(s_lon).cast("double").alias("__slon")).dropna()
    P = points.select(F.col(point_id).alias("__pid"), F.col(p_lat).cast("double").alias("__plat"),
                      F.col(p_lon).cast("double").alias("__plon"))
    if k > 1:
        P, S = P.distinct(), S.distinct()
    located = F.col("__plat").isNotNull() & F.col("__plon").isNotNull()
    results = [P.filter(~located).select("__pid", F.lit(None).cast(S.schema["__sid"].dataType).alias("__sid"),
                                         F.lit(None).cast("double").alias("__d"), *[F.lit(None).cast("int").alias("__rank")] * (k > 1))]
    pending, old = P.filter(located), []
    while True:
        n_lon = max(1, int(360.0 // cell_deg))          # cells around the circle
        w_lon = 360.0 / n_lon
        n_lat = max(1, int(180.0 // cell_deg))
        w_lat = 180.0 / n_lat
        all_lon, all_lat = n_lon <= 3, n_lat <= 2       # the block spans all longitudes / latitudes

        def cell(lat, lon):
            i = F.least(F.floor((F.col(lat) + 90.0) / w_lat), F.lit(n_lat - 1)).cast("long")
            return i, F.floor((F.col(lon) + 180.0) / w_lon).cast("long")

        si, sj = cell("__slat", "__slon")
        ring = F.array(*[F.lit(k) for k in (-1, 0, 1)])
        around = F.array(*[F.lit(k) for k in ((-1, 0, 1) if n_lon >= 3 else range(n_lon))])
        served = (S.withColumns({"__si": si, "__sj": sj}).withColumn("__di", F.explode(ring))
                  .withColumn("__dj", F.explode(around))
                  .select("__sid", "__slat", "__slon", (F.col("__si") + F.col("__di")).alias("__ki"),
                          F.pmod(F.col("__sj") + F.col("__dj"), F.lit(n_lon)).alias("__kj")))
        pi, pj = cell("__plat", "__plon")
        keyed = pending.withColumns({"__ci": pi, "__cj": pj})
        cand = keyed.join(served, (F.col("__ci") == F.col("__ki")) & (F.pmod("__cj", F.lit(n_lon)) == F.col("__kj")), "left")
        cand = cand.withColumn("__d", haversine("__plat", "__plon", "__slat", "__slon", unit))
        point = ["__pid", "__plat", "__plon", "__ci", "__cj"]
        if k == 1:
            best = cand.groupBy(*point).agg(F.min_by(F.struct(F.col("__sid"), F.col("__d")), F.when(
                F.col("__sid").isNotNull(), F.struct(F.round(F.col("__d"), 6), F.col("__sid")))).alias("__b"))
        else:
            closest = Window.partitionBy(*point).orderBy(F.round("__d", 6).asc_nulls_last(), F.col("__sid").asc_nulls_last())
            cand = cand.withColumn("__rank", F.row_number().over(closest)).filter(F.col("__rank") <= k)
            best = cand.groupBy(*point).agg(F.sort_array(F.collect_list(F.when(F.col("__sid").isNotNull(), F.struct("__rank", "__sid", "__d")))).alias("__all"))
            best = best.withColumn("__b", F.get("__all", F.lit(k - 1)))
        # Lower bound of the distance to any site outside the block.
        south, north = (F.col("__ci") - 1) * w_lat - 90.0, (F.col("__ci") + 2) * w_lat - 90.0
        bound_lat = F.radians(F.least(F.when(south > -90.0, F.col("__plat") - south).otherwise(F.lit(1e3)),
                                      F.when(north < 90.0, north - F.col("__plat")).otherwise(F.lit(1e3)))) * R
        cos_band = F.cos(F.radians(F.least(F.greatest(F.abs(south), F.abs(north)), F.lit(90.0))))
        dlon = F.least(F.col("__plon") + 180.0 - (F.col("__cj") - 1) * w_lon, (F.col("__cj") + 2) * w_lon - F.col("__plon") - 180.0)
        bound_lon = F.lit(2 * R) * F.asin(F.least(F.lit(1.0), F.sqrt(F.greatest(
            F.cos(F.radians(F.col("__plat"))) * cos_band, F.lit(0.0))) * F.sin(F.radians(dlon) / 2)))
        whole = all_lon and all_lat
        bound = bound_lat if all_lon else F.least(bound_lat, bound_lon)
        ok = F.lit(True) if whole else F.coalesce(F.col("__b")["__d"] <= bound, F.lit(False))
        old.append(stage_path(spark))
        best = stage_to(best.withColumn("__ok", ok), old[-1])
        if k == 1:
            results.append(best.filter("__ok").select("__pid", F.col("__b")["__sid"].alias("__sid"), F.col("__b")["__d"].alias("__d")))
        else:
            rows = best.filter("__ok").select("__pid", F.explode_outer("__all").alias("__b"))
            results.append(rows.select("__pid", "__b.__sid", "__b.__d", "__b.__rank"))
        pending = best.filter(~F.col("__ok")).select("__pid", "__plat", "__plon")
        if whole or not pending.head(1):
            break
        cell_deg *= 3
    out = reduce(lambda a, b: a.unionByName(b), results)
    out = stage_to(out.select(F.col("__pid").alias(point_id), F.col("__sid").alias(site_id), F.col("__d").alias("distance"),
                              *[F.col("__rank").alias("rank")] * (k > 1)))
    for path in old:
        remove_path(spark, path)
    return out


def augment_pairs(pairs: DataFrame, needed: DataFrame, sites: DataFrame, point_key: str,
                  p_lat: str, p_lon: str, site_id: str, s_lat: str, s_lon: str) -> DataFrame:
    """Add nearest-site rows for points missing from an existing pair
    table, then union (anti join picks the missing points first)."""
    miss = needed.join(pairs.select(point_key).distinct(), point_key, "left_anti")
    extra = nearest(miss, sites, point_key, p_lat, p_lon, site_id, s_lat, s_lon)
    return pairs.select(point_key, site_id, "distance").unionByName(extra)

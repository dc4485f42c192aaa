"""Aggregations and profiles.

Everything is a grouped aggregate with map-side partial aggregation; the
profiles compute all columns in one pass and then ``unpivot`` to rows
instead of one job per column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC = (T.IntegerType, T.LongType, T.DoubleType, T.FloatType, T.ShortType, T.ByteType, T.DecimalType)


def group_means(df: DataFrame, keys: list[str], cols: list[str], prefix: str = "mean_") -> DataFrame:
    """A1."""
    return df.groupBy(*keys).agg(*[F.avg(c).alias(f"{prefix}{c}") for c in cols])


def daily_stats(df: DataFrame, day: Column | str, delay: str, label: str) -> DataFrame:
    """A2: per day mean delay, share disrupted, volume."""
    return df.groupBy((F.col(day) if isinstance(day, str) else day).alias("day")).agg(
        F.avg(delay).alias("mean_delay"), F.avg(label).alias("share_disrupted"), F.count(F.lit(1)).alias("n"))


def duplicate_report(df: DataFrame, keys: list[str]) -> DataFrame:
    """A3: number of keys occurring more than once and rows inside them."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return g.agg(F.count(F.lit(1)).alias("dup_groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("dup_rows"))


def null_profile(df: DataFrame, cols: list[str] | None = None, nan: bool = True) -> DataFrame:
    """A4: NULL (and NaN for floating columns) count for every column, as
    rows (column, n_null, n_rows), from a single aggregate."""
    cols = cols or df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs = [F.count(F.lit(1)).alias("__n")]
    for c in cols:
        cond = F.col(c).isNull()
        if nan and isinstance(types[c], (T.DoubleType, T.FloatType)):
            cond = cond | F.isnan(F.col(c))
        aggs.append(F.count_if(cond).alias(c))
    wide = df.agg(*aggs)
    long = wide.unpivot("__n", cols, "column", "n_null")
    return long.select("column", F.col("n_null").cast("long").alias("n_null"), F.col("__n").alias("n_rows"))


def null_by_group(df: DataFrame, key: str, col: str, min_nulls: int = 1) -> DataFrame:
    """A5: NULL and non-NULL counts per group, keep groups with NULLs."""
    g = df.groupBy(key).agg(F.count_if(F.col(col).isNull()).alias("n_null"), F.count(col).alias("n_present"))
    return g.filter(F.col("n_null") >= min_nulls)


def null_cooccurrence(df: DataFrame, col: str, others: list[str] | None = None) -> DataFrame:
    """NULL profile of the other columns on rows where ``col`` is NULL."""
    others = others or [c for c in df.columns if c != col]
    return null_profile(df.filter(F.col(col).isNull()), others)


def null_rate(df: DataFrame, key: str, col: str) -> DataFrame:
    """Percent NULL per group."""
    return df.groupBy(key).agg((F.avg(F.col(col).isNull().cast("double")) * 100).alias("pct_null"))


def compare_profiles(before: DataFrame, after: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """NULL profiles before/after, side by side per column."""
    b = null_profile(before, cols).select("column", F.col("n_null").alias("null_before"),
                                          F.col("n_rows").alias("rows_before"))
    a = null_profile(after, cols).select("column", F.col("n_null").alias("null_after"),
                                         F.col("n_rows").alias("rows_after"))
    return b.join(a, "column", "full")


def distinct_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Whole-row distinct or first row per subset (``dropDuplicates``)."""
    return df.dropDuplicates(subset) if subset else df.distinct()


def distinct_counts(df: DataFrame, key: str, col: str) -> DataFrame:
    """A10: distinct count per group."""
    return df.groupBy(key).agg(F.count_distinct(col).alias(f"n_distinct_{col}"))


def collect_sets(df: DataFrame, key: str, col: str, struct_cols: list[str] | None = None) -> DataFrame:
    """Sorted set of values (and of distinct structs) per key.  Sets are
    combined map-side, so a key costs its distinct values, not its rows."""
    aggs = [F.array_sort(F.collect_set(col)).alias(f"{col}_set")]
    if struct_cols:
        aggs.append(F.array_sort(F.collect_set(F.struct(*struct_cols))).alias("items"))
    return df.groupBy(key).agg(*aggs)


PAIR_BLOCK = 256   # members of an item set in one block


def pair_counts(df: DataFrame, key: str, item: str, block: int = PAIR_BLOCK) -> DataFrame:
    """For each unordered pair of items, the number of keys holding both.

    Each key's distinct items are reduced to one sorted item set; identical
    sets are counted once (``groupBy(set)``), and pairs are expanded per
    *distinct set* with its weight -- never per key -- then summed.  A set is
    cut into blocks of ``block`` members and each pair of blocks is a row of
    its own, dealt over the tasks, that gives at most block x block pairs: no
    row holds all pairs of a large set.
    """
    sets = (df.select(key, item).filter(F.col(item).isNotNull()).distinct()
            .groupBy(key).agg(F.array_sort(F.collect_list(item)).alias("__set")))
    w = sets.groupBy("__set").agg(F.count(F.lit(1)).alias("__w")).filter(F.size("__set") >= 2)
    pairs = set_pairs(w, block).select("__w", "item_a", F.explode("__right").alias("item_b")).filter("item_a < item_b")
    return pairs.groupBy("item_a", "item_b").agg(F.sum("__w").alias("n_keys"))


def set_pairs(sets: DataFrame, block: int) -> DataFrame:
    """A12 helper: ``__w, item_a, __right``: each member of the sorted arrays
    ``__set`` with the members of one block, which include all greater ones in
    the same block and all of each later block."""
    last = F.floor((F.size("__set") - 1) / block).cast("int")
    one = sets.filter(F.size("__set") <= block).select("__w", F.col("__set").alias("__left"), F.col("__set").alias("__right"))
    many = sets.filter(F.size("__set") > block).select("*", F.explode(F.sequence(F.lit(0), last)).alias("__i"))
    many = many.select("*", F.explode(F.sequence(F.col("__i"), last)).alias("__j"))

    def members(i):
        return F.expr(f"slice(__set, {i} * {block} + 1, {block})")

    many = many.select("__w", members("__i").alias("__left"), members("__j").alias("__right"), "__i", "__j")
    many = many.repartition(F.xxhash64("__left", "__right")).drop("__i", "__j")
    return one.unionByName(many).select("__w", F.explode("__left").alias("item_a"), "__right")


def bounds(df: DataFrame, t: str) -> DataFrame:
    """Min, max and span in days."""
    return df.agg(F.min(t).alias("t_min"), F.max(t).alias("t_max")).withColumn(
        "span_days", F.datediff(F.to_date("t_max"), F.to_date("t_min")) + 1)


def confusion(df: DataFrame, y: str, p: str) -> DataFrame:
    """Confusion counts, long form."""
    return df.groupBy(F.col(y).alias("label"), F.col(p).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def confusion_by(df: DataFrame, dim: str, y: str, p: str) -> DataFrame:
    """TP/TN/FP/FN counts per dimension value (pivot with fixed
    values), worst (most errors) first."""
    cls = (F.when((F.col(y) == 1) & (F.col(p) == 1), "TP").when((F.col(y) == 0) & (F.col(p) == 0), "TN")
           .when((F.col(y) == 0) & (F.col(p) == 1), "FP").otherwise("FN"))
    piv = df.withColumn("__c", cls).groupBy(dim).pivot("__c", ["TP", "TN", "FP", "FN"]).agg(F.count(F.lit(1)))
    piv = piv.fillna(0, subset=["TP", "TN", "FP", "FN"])
    return piv.withColumn("errors", F.col("FP") + F.col("FN")).orderBy(F.desc("errors"), dim)


def confusion_rates(df: DataFrame, y: str, p: str) -> DataFrame:
    """Row-normalised confusion matrix (count / row total)."""
    c = confusion(df, y, p)
    tot = F.sum("n").over(Window.partitionBy("label"))
    return c.withColumn("rate", F.col("n") / tot)


def error_rates(df: DataFrame, dim: str, y: str, p: str, min_n: int = 1) -> DataFrame:
    """FP and FN rates per group with minimum support, plus the group's
    true positive rate (share of label 1)."""
    g = df.groupBy(dim).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(((F.col(y) == 0) & (F.col(p) == 1)).cast("double")).alias("fp_rate"),
        F.avg(((F.col(y) == 1) & (F.col(p) == 0)).cast("double")).alias("fn_rate"),
        F.avg(F.col(y).cast("double")).alias("true_rate"))
    return g.filter(F.col("n") >= min_n)


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Row count and share per class."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def cause_share(df: DataFrame, label: str, cause: str) -> DataFrame:
    """Share of positive rows that have the cause (> 0)."""
    return df.filter(F.col(label) == 1).agg(F.avg((F.col(cause) > 0).cast("double")).alias("cause_share"))


def cause_breakdown(df: DataFrame, causes: list[str]) -> DataFrame:
    """Per cause: share of all cause minutes and share of rows with the
    cause > 0 (one aggregate, then unpivot)."""
    aggs = []
    for c in causes:
        aggs += [F.sum(c).alias(f"s_{c}"), F.count_if(F.col(c) > 0).alias(f"n_{c}")]
    wide = df.agg(F.count(F.lit(1)).alias("__rows"), *aggs)
    tot = sum((F.coalesce(F.col(f"s_{c}"), F.lit(0.0)) for c in causes), F.lit(0.0))
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("cause"), (F.col(f"s_{c}") / tot).alias("minute_share"),
                                         (F.col(f"n_{c}") / F.col("__rows")).alias("row_share")) for c in causes]))
    return wide.select(rows.alias("r")).select("r.*")


def route_means(df: DataFrame, a: str, b: str, col: str, sep: str = "-") -> DataFrame:
    """Mean per route label a-b."""
    return df.groupBy(F.concat_ws(sep, F.col(a).cast("string"), F.col(b).cast("string")).alias("route")).agg(
        F.avg(col).alias(f"mean_{col}"), F.count(F.lit(1)).alias("n"))


def site_summary(df: DataFrame, site: str, col: str, lat: str, lon: str) -> DataFrame:
    """Per-site mean, count and coordinates (any value)."""
    return df.groupBy(site).agg(F.avg(col).alias(f"mean_{col}"), F.count(F.lit(1)).alias("n"),
                                F.any_value(lat).alias("lat"), F.any_value(lon).alias("lon"))


def exact_quantiles(df: DataFrame, col: str, probs, by: list[str] = ()) -> DataFrame:
    """Exact quantiles with linear interpolation (same definition as SQL
    ``percentile``/``quantile_cont``), computed without gathering a
    group's values in one task: value counts (pre-aggregated), distributed
    prefix counts, then each target position is found by a range match
    against a tiny table of (group, prob, position).  Output: (by..., p, q)."""
    from leadtime.operators.windows import grouped_prefix_sum
    by = list(by)
    g = by if by else ["__all"]
    x = df if by else df.withColumn("__all", F.lit(0))
    vc = x.filter(F.col(col).isNotNull()).groupBy(*g, F.col(col).cast("double").alias("__v")).agg(
        F.count(F.lit(1)).alias("__c"))
    vc = grouped_prefix_sum(vc, g, "__v", "__c", "__before")
    n = vc.groupBy(*g).agg(F.sum("__c").alias("__n"))
    targets = n.select(*g, "__n", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p"))
    targets = targets.withColumn("__h", F.col("p") * (F.col("__n") - 1))
    targets = targets.select(*g, "p", "__h", F.explode(F.array(F.floor("__h"), F.ceil("__h"))).alias("__k"))
    # targets: 2 positions x probs per group.  Ungrouped that is a bound by
    # construction -> broadcast, so the value counts never shuffle on a
    # constant key; grouped, AQE decides from the measured size.
    tj = targets if by else F.broadcast(targets)
    hit = vc.join(tj, [*g]).filter((F.col("__before") <= F.col("__k")) & (F.col("__k") < F.col("__before") + F.col("__c")))
    lo_hi = hit.groupBy(*g, "p", "__h").agg(F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
    q = F.col("__lo") + (F.col("__h") - F.floor("__h")) * (F.col("__hi") - F.col("__lo"))
    out = lo_hi.select(*g, "p", q.alias("q"))
    return out.drop("__all") if not by else out


SKETCH_ACCURACY = 10_000   # ranks of the quantile sketches are right to one part in this


def column_quantiles(df: DataFrame, cols: list[str], probs, accuracy: int = SKETCH_ACCURACY, stats: list = ()) -> tuple[DataFrame, object]:
    """Exact quantiles (linear interpolation) of many columns in two scans:
    ``column, p, q``, and the first scan's row of ``stats`` aggregates.

    The first scan takes one mergeable sketch per column, whose values around
    each probability bracket the quantile.  The second counts what lies below
    a bracket and keeps the few values inside it, which are then numbered by
    a distributed prefix sum.  A bracket that doesn't hold its place (sketches
    are right to one part in ``accuracy``) leaves that column to
    ``exact_quantiles``.
    """
    from leadtime.operators.windows import grouped_prefix_sum
    from leadtime.sources.io import stage_to
    d = df.select(*cols)
    for i, c in enumerate(cols):
        d = d.withColumn(f"__q{i}", F.col(c).cast("double"))
    around = [min(max(float(p) + s * 2.0 / accuracy, 0.0), 1.0) for p in probs for s in (-1, 1)]
    first = d.agg(*stats, *[F.count(f"__q{i}").alias(f"__n{i}") for i in range(len(cols))],
                  *[F.percentile_approx(f"__q{i}", around, accuracy).alias(f"__b{i}") for i in range(len(cols))]).first()
    places = []   # (column, number of the probability, probability, lower and upper value, place)
    for i in range(len(cols)):
        n, bracket = first[f"__n{i}"], first[f"__b{i}"]
        places += [(i, j, float(p), bracket[2 * j], bracket[2 * j + 1], float(p) * (n - 1)) for j, p in enumerate(probs) if n]
    spark = df.sparkSession
    if not places:
        return spark.createDataFrame([], "column string, p double, q double"), first
    # a cell per bracket the value isn't above: NULL stands for below
    cells = F.array(*[F.when(F.col(f"__q{i}") <= F.lit(hi), F.struct(
        F.lit(i).alias("c"), F.lit(j).alias("b"), F.when(F.col(f"__q{i}") >= F.lit(lo), F.col(f"__q{i}")).alias("v")))
        for i, j, _, lo, hi, _ in places])
    counts = d.select(F.explode(F.array_compact(cells)).alias("x")).select("x.*").groupBy("c", "b", "v").agg(F.count(F.lit(1)).alias("n"))
    ranked = stage_to(grouped_prefix_sum(counts, ["c", "b"], "v", "n", "before"))
    want = spark.createDataFrame([(i, j, p, h) for i, j, p, _, _, h in places], "i int, j int, p double, h double")
    hit = ranked.filter("v IS NOT NULL").join(F.broadcast(want), (F.col("c") == F.col("i")) & (F.col("b") == F.col("j")))
    floor_in = (F.col("before") <= F.floor("h")) & (F.floor("h") < F.col("before") + F.col("n"))
    ceil_in = (F.col("before") <= F.ceil("h")) & (F.ceil("h") < F.col("before") + F.col("n"))
    got = hit.groupBy("c", "p", "h").agg(F.max(F.when(floor_in, F.col("v"))).alias("lo"), F.max(F.when(ceil_in, F.col("v"))).alias("hi"))
    got = got.filter("lo IS NOT NULL AND hi IS NOT NULL").select("c", "p", (F.col("lo") + (F.col("h") - F.floor("h")) * (F.col("hi") - F.col("lo"))).alias("q"))
    names = F.array(*[F.lit(c) for c in cols])
    out = got.select(names[F.col("c")].alias("column"), "p", "q")
    found = {(r.column, r.p) for r in out.select("column", "p").collect()}   # one row per column and probability
    for c in {cols[i] for i, _, p, *_ in places if (cols[i], p) not in found}:
        exact = exact_quantiles(df, c, probs).select(F.lit(c).alias("column"), "p", "q")
        out = out.filter(F.col("column") != c).unionByName(exact)
    return out, first


def summary(df: DataFrame, cols: list[str], probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """Count, mean, stddev, min, exact percentiles, max per column, in
    two scans for any number of columns (``column_quantiles``)."""
    stats = [f(F.col(c)).alias(f"__{name}{i}") for i, c in enumerate(cols)
             for name, f in (("mean", F.avg), ("sd", F.stddev), ("min", lambda x: F.min(x.cast("double"))), ("max", lambda x: F.max(x.cast("double"))))]
    quantiles, first = column_quantiles(df, cols, probs, stats=stats)
    rows = [(c, first[f"__n{i}"], *[None if v is None else float(v) for v in (first[f"__mean{i}"], first[f"__sd{i}"], first[f"__min{i}"], first[f"__max{i}"])])
            for i, c in enumerate(cols)]
    base = df.sparkSession.createDataFrame(rows, "column string, count long, mean double, stddev double, min double, max double")
    wide = quantiles.groupBy("column").agg(*[F.max(F.when(F.col("p") == float(p), F.col("q"))).alias(f"p{int(p * 100)}") for p in probs])
    return base.join(wide, "column", "left").select("column", "count", "mean", "stddev", "min", *[f"p{int(q * 100)}" for q in probs], "max")


def spearman(df: DataFrame, cols: list[str]) -> DataFrame:
    """Spearman rank correlation matrix, as (a, b, rho) rows.

    Average ranks (ties share the mean rank) come from value counts
    (map-side combined, so a value held by a third of the rows is no
    problem) and distributed prefix sums over the sorted distinct values, in
    one pass for all (numeric) columns.  Rows become cells (row, column,
    value), take their rank in one join for all columns and are put together
    by row again; then Pearson ``corr`` of the ranks in one aggregate.  The
    number of shuffles does not depend on the number of columns.
    """
    from leadtime.operators.windows import grouped_prefix_sum
    from leadtime.sources.io import stage_to
    values = F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v")) for i, c in enumerate(cols)])
    # the row numbers are stored, so that all readers see the same ones
    cells = df.select(F.monotonically_increasing_id().alias("row"), values.alias("xs")).select("row", F.explode("xs").alias("x"))
    cells = stage_to(cells.select("row", "x.c", "x.v").filter("v IS NOT NULL"))
    counts = cells.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
    ranks = grouped_prefix_sum(counts, ["c"], "v", "n", "before")
    ranks = ranks.select(F.col("c").alias("c2"), F.col("v").alias("v2"), (F.col("before") + (F.col("n") + 1) / 2.0).alias("r"))
    # one row per distinct value: AQE splits a value with many rows
    ranked = cells.join(ranks, (F.col("c") == F.col("c2")) & (F.col("v") == F.col("v2")))
    rows = ranked.groupBy("row").agg(*[F.max(F.when(F.col("c") == i, F.col("r"))).alias(f"r{i}") for i in range(len(cols))])
    aggs = [F.struct(F.lit(cols[i]).alias("a"), F.lit(cols[j]).alias("b"), F.corr(f"r{i}", f"r{j}").alias("rho"))
            for i in range(len(cols)) for j in range(i, len(cols))]
    return rows.agg(F.array(*aggs).alias("m")).select(F.explode("m").alias("x")).select("x.*")


def histogram(df: DataFrame, col: str, lo: float, hi: float, bins: int, by: str | None = None) -> DataFrame:
    """Counts in equal-width bins (values outside [lo, hi] go to the
    edge bins 0 and bins+1 as width_bucket does), optionally per class."""
    b = F.width_bucket(F.col(col), F.lit(lo), F.lit(hi), F.lit(bins)).alias("bin")
    keys = [b] + ([F.col(by)] if by else [])
    return df.filter(F.col(col).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def box_stats(df: DataFrame, col: str, by: str) -> DataFrame:
    """Min, quartiles, max and whisker bounds per class (exact
    quantiles, computed distributively)."""
    g = df.groupBy(by).agg(F.min(col).alias("min"), F.max(col).alias("max"))
    q = exact_quantiles(df, col, (0.25, 0.5, 0.75), [by]).groupBy(by).pivot("p", [0.25, 0.5, 0.75]).agg(F.first("q"))
    q = q.select(by, F.col("`0.25`").alias("q1"), F.col("`0.5`").alias("median"), F.col("`0.75`").alias("q3"))
    g = g.join(q, by, "left").select(by, "min", "q1", "median", "q3", "max")
    iqr = F.col("q3") - F.col("q1")
    return g.withColumns({"lower_whisker": F.col("q1") - 1.5 * iqr, "upper_whisker": F.col("q3") + 1.5 * iqr})


def agg_dict(df: DataFrame, key: str, spec: dict[str, str]) -> DataFrame:
    """Aggregate by a {column: function} dict, named ``fn_col``."""
    return df.groupBy(key).agg(*[getattr(F, fn)(c).alias(f"{fn}_{c}") for c, fn in spec.items()])


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), col)

"""Registered queries: sampling and splits (M1-M10), evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadtime.operators import clean, evaluate as ev
from leadtime.operators import sampling as sm
from leadtime.plans.fixtures import Fixtures, with_views
from leadtime.plans.registry import query


def r6(c):
    return F.round(c, 6)


_LABEL = "CASE WHEN delay_min >= 15 OR cancelled = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
_HASH = "(CAST('0x' || substr(md5('{s}:' || CAST({k} AS VARCHAR)), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE)"


def _trips_l(fx):
    return fx.trips().withColumn("label", clean.label("delay_min", "cancelled"))


_CLASS_CTE = f""",
t AS (SELECT *, {_LABEL} AS label FROM trips),
c AS (SELECT label, count(*) AS n FROM t GROUP BY label),
mm AS (SELECT (SELECT label FROM c ORDER BY n, label LIMIT 1) AS minority,
              (SELECT label FROM c ORDER BY n DESC, label DESC LIMIT 1) AS majority,
              min(n) AS nmin, max(n) AS nmax FROM c)"""


@query("downsample", with_views(["trips"], _CLASS_CTE + f"""
SELECT trip_id, label FROM t, mm WHERE label <> majority OR {_HASH.format(k='trip_id', s=42)} < nmin / nmax"""))
def q_downsample(spark, d):
    return sm.downsample(_trips_l(Fixtures(spark, d)), "label", "trip_id").select("trip_id", "label")


@query("upsample", with_views(["trips"], _CLASS_CTE + f"""
SELECT trip_id, CASE WHEN label = minority THEN CAST(floor(nmax / nmin) AS BIGINT)
   + CASE WHEN {_HASH.format(k='trip_id', s=42)} < nmax / nmin - floor(nmax / nmin) THEN 1 ELSE 0 END ELSE 1 END AS copies
FROM t, mm"""))
def q_upsample(spark, d):
    u = sm.upsample(_trips_l(Fixtures(spark, d)), "label", "trip_id")
    return u.groupBy("trip_id").agg(F.count(F.lit(1)).alias("copies"))


@query("class_weights", with_views(["trips"], _CLASS_CTE + """
SELECT trip_id, round(CASE WHEN label = 1 THEN (SELECT n FROM c WHERE label = 0) / (SELECT n FROM c WHERE label = 1) ELSE 1.0 END, 6) AS weight
FROM t"""))
def q_class_weights(spark, d):
    w = sm.class_weights(_trips_l(Fixtures(spark, d)), "label")
    return w.select("trip_id", r6(F.col("weight")).alias("weight"))


@query("downsample_buckets", with_views(["trips"], f""",
t AS (SELECT *, {_LABEL} AS label, date_trunc('day', sched) AS bkt FROM trips),
c AS (SELECT bkt, count(*) FILTER (WHERE label = 1) AS n1, count(*) FILTER (WHERE label = 0) AS n0 FROM t GROUP BY bkt)
SELECT trip_id FROM t JOIN c USING (bkt)
WHERE n1 = 0 OR n0 = 0 OR label <> CASE WHEN n1 > n0 THEN 1 ELSE 0 END
   OR {_HASH.format(k='trip_id', s=42)} < least(n1, n0) / greatest(n1, n0)"""))
def q_downsample_buckets(spark, d):
    return sm.downsample_buckets(_trips_l(Fixtures(spark, d)), "sched", "day", "label", "trip_id").select("trip_id")


@query("train_test_split", with_views(["trips"], """,
b AS (SELECT epoch_us(min(sched)) AS lo, epoch_us(max(sched)) AS hi FROM trips WHERE sched < TIMESTAMP '2024-01-29')
SELECT CASE WHEN epoch_us(sched) < hi - 86400000000 * CAST(floor((hi - lo) // 86400000000 * 0.2) AS BIGINT) THEN 'train' ELSE 'test' END AS part, count(*) AS n
FROM trips, b WHERE sched < TIMESTAMP '2024-01-29' GROUP BY 1"""))
def q_split(spark, d):
    t = Fixtures(spark, d).trips()
    tr, te = sm.train_test_split(t, "sched", test_fraction=0.2, upper=F.lit("2024-01-29").cast("timestamp"))
    return (tr.agg(F.lit("train").alias("part"), F.count(F.lit(1)).alias("n"))
            .unionByName(te.agg(F.lit("test").alias("part"), F.count(F.lit(1)).alias("n"))))


@query("cv_bounds", with_views(["trips"], """,
b AS (SELECT min(sched) AS lo, max(sched) AS hi,
        (epoch_us(max(sched)) - epoch_us(min(sched))) // 86400000000 + 1 AS n_days FROM trips),
p AS (SELECT lo, hi, CAST(ceil(n_days / (3 + 1 - 0.5 * 2)) AS BIGINT) AS chunk FROM b),
f AS (SELECT i AS fold, lo, hi, chunk,
        i * CAST(ceil(0.5 * chunk) AS BIGINT) AS ts, chunk + i * CAST(floor(0.5 * chunk) AS BIGINT) AS te
      FROM p, range(3) r(i)),
fb AS (SELECT fold, lo + to_days(CAST(ts AS INTEGER)) AS train_lo, lo + to_days(CAST(te AS INTEGER)) AS train_hi,
        least(lo + to_days(CAST(te + chunk AS INTEGER)), hi + INTERVAL 1 DAY) AS val_hi FROM f)
SELECT CAST(fold AS INTEGER) AS fold, count(*) FILTER (WHERE t.sched >= train_lo AND t.sched < train_hi) AS n_train,
       count(*) FILTER (WHERE t.sched >= train_hi AND t.sched < val_hi) AS n_val
FROM fb, trips t GROUP BY 1"""))
def q_cv_bounds(spark, d):
    t = Fixtures(spark, d).trips()
    folds = sm.cv_bounds(t, "sched", k=3, blocking=True, overlap=0.5)
    fb = sm.folds_frame(spark, folds)
    j = t.join(F.broadcast(fb), (t.sched >= fb.train_lo) & (t.sched < fb.val_hi))
    return j.groupBy("fold").agg(F.count_if(F.col("sched") < F.col("train_hi")).alias("n_train"),
                                 F.count_if(F.col("sched") >= F.col("val_lo")).alias("n_val"))


@query("cv_bounds_rows", with_views(["trips"], """,
r AS (SELECT trip_id, row_number() OVER (ORDER BY sched, trip_id) AS rn FROM trips),
n AS (SELECT count(*) AS n, count(*) // 4 AS chunk FROM trips),
edges AS (SELECT j, CASE WHEN j = 4 THEN n ELSE j * chunk + 1 END AS edge FROM n, range(5) e(j)),
f AS (SELECT i AS fold, (SELECT edge FROM edges WHERE j = 0) AS t_lo, (SELECT edge FROM edges WHERE j = i + 1) AS v_lo,
             (SELECT edge FROM edges WHERE j = i + 2) AS v_hi FROM range(3) r(i))
SELECT CAST(fold AS INTEGER) AS fold, CASE WHEN rn >= v_lo AND rn < v_hi THEN 'val' ELSE 'train' END AS part, count(*) AS n
FROM r, f WHERE rn >= t_lo AND rn < v_hi GROUP BY 1, 2"""))
def q_cv_rows(spark, d):
    f = sm.cv_bounds_rows(Fixtures(spark, d).trips(), ["sched", "trip_id"], k=3)
    return f.groupBy("fold", "part").agg(F.count(F.lit(1)).alias("n"))


_OVERLAP_ROWS = """,
r AS (SELECT trip_id, sched, row_number() OVER (ORDER BY sched, trip_id) AS rn FROM trips),
n AS (SELECT CAST(floor(count(*) / (5 - 0.2::DOUBLE * 3)) AS BIGINT) AS chunk FROM trips),
s AS (SELECT chunk, CAST(floor(0.8::DOUBLE * chunk) AS BIGINT) AS step FROM n),
f AS (SELECT CAST(i AS INTEGER) AS fold, i * step + 1 AS t_lo, i * step + chunk AS t_hi, i * step + 2 * chunk AS v_hi FROM s, range(4) g(i))
"""


@query("cv_bounds_rows_overlap", with_views(["trips"], _OVERLAP_ROWS + """
SELECT fold, CASE WHEN rn > t_hi THEN 'val' ELSE 'train' END AS part, count(*) AS n, min(trip_id) AS lo, max(trip_id) AS hi,
       sum(trip_id)::BIGINT AS ids FROM r, f WHERE rn BETWEEN t_lo AND v_hi GROUP BY 1, 2"""))
def q_cv_rows_overlap(spark, d):
    """M7: moving folds that share a fifth of a chunk."""
    f = sm.cv_bounds_rows(Fixtures(spark, d).trips(), ["sched", "trip_id"], k=4, blocking=True, overlap=0.2)
    return f.groupBy("fold", "part").agg(F.count(F.lit(1)).alias("n"), F.min("trip_id").alias("lo"), F.max("trip_id").alias("hi"),
                                         F.sum("trip_id").alias("ids"))


@query("row_fold_times", with_views(["trips"], _OVERLAP_ROWS + """
SELECT fold, (SELECT min(sched) FROM trips) AS train_min, (SELECT sched FROM r WHERE rn = t_hi) AS train_max,
       (SELECT sched FROM r WHERE rn = t_hi + 1) AS test_min, (SELECT sched FROM r WHERE rn = v_hi) AS test_max FROM f"""))
def q_row_fold_times(spark, d):
    """M7: the published form, times of the rows at the bounds."""
    return sm.row_fold_times(Fixtures(spark, d).trips(), "sched", k=4, overlap=0.2)


@query("sample_n", with_views(["trips"], f"""
SELECT trip_id FROM trips WHERE {_HASH.format(k='trip_id', s=7)} < 500 / (SELECT count(*) FROM trips)"""))
def q_sample_n(spark, d):
    return sm.sample_n(Fixtures(spark, d).trips(), 500, "trip_id").select("trip_id")


@query("random_split")
def q_random_split(spark, d):
    a, b = sm.random_split(Fixtures(spark, d).trips(), [0.8, 0.2], seed=42)
    return a.select(F.lit("a").alias("part"), "trip_id").unionByName(b.select(F.lit("b").alias("part"), "trip_id"))


@query("bind_fold", with_views(["trips"], "SELECT trip_id, coalesce(delay_min * 2, 0) AS delay FROM trips"))
def q_bind_fold(spark, d):
    t = Fixtures(spark, d).trips().select("trip_id", F.col("delay_min").alias("delay_0"), (F.col("delay_min") * 2).alias("delay_1"))
    b = sm.bind_fold(t, 1, {"delay_{i}": "delay"}, fill=["delay"])
    return b.select("trip_id", "delay")


# ---------------------------------------------------------------------------
# Evaluation

@query("f_beta", with_views(["scored"], """,
c AS (SELECT count(*) FILTER (WHERE outcome = 1 AND pred1 = 1) AS tp, count(*) FILTER (WHERE outcome <> 1 AND pred1 = 1) AS fp,
             count(*) FILTER (WHERE outcome = 1 AND pred1 <> 1) AS fn FROM scored),
pr AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS prec, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS rec FROM c)
SELECT tp, fp, fn, round(prec, 6) AS precision, round(rec, 6) AS recall,
       round(CASE WHEN prec + rec > 0 THEN 5 * prec * rec / (4 * prec + rec) ELSE 0.0 END, 6) AS f_beta FROM pr"""))
def q_f_beta(spark, d):
    f = ev.f_beta(Fixtures(spark, d).scored(), "outcome", "pred1", 2.0)
    return f.select("tp", "fp", "fn", *[r6(F.col(c)).alias(c) for c in ["precision", "recall", "f_beta"]])


@query("area_under_pr", with_views(["scored"], """,
g AS (SELECT p1, sum(outcome) AS pos, count(*) AS n FROM scored GROUP BY p1),
c AS (SELECT pos, sum(pos) OVER w AS tp, sum(n) OVER w AS k, sum(pos) OVER () AS p FROM g WINDOW w AS (ORDER BY p1 DESC)),
q AS (SELECT pos, p, tp / k AS prec, lag(tp / k) OVER (ORDER BY k) AS prev FROM c)
SELECT (SELECT count(*) FROM scored) AS n, round(sum(pos / p * (prec + coalesce(prev, prec)) / 2), 6) AS area_under_pr FROM q"""))
def q_aupr(spark, d):
    s = Fixtures(spark, d).scored()
    v = ev.area_under_pr(s, "outcome", "p1")
    return s.agg(F.count(F.lit(1)).alias("n")).select("n", F.lit(round(v, 6)).alias("area_under_pr"))


@query("classify", with_views(["scored"], """
SELECT CASE WHEN outcome = 1 AND pred2 = 1 THEN 'TP' WHEN outcome = 0 AND pred2 = 0 THEN 'TN'
            WHEN outcome = 0 AND pred2 = 1 THEN 'FP' WHEN outcome = 1 AND pred2 = 0 THEN 'FN' END AS cls, count(*) AS n
FROM scored GROUP BY 1"""))
def q_classify(spark, d):
    s = Fixtures(spark, d).scored()
    return s.groupBy(ev.classify("outcome", "pred2").alias("cls")).agg(F.count(F.lit(1)).alias("n"))


@query("ensembles", with_views(["scored"], """
SELECT event_id, round(p1 * 0.25 / 1.75 + p2 * 0.5 / 1.75 + p3 * 1.0 / 1.75, 6) AS ens_prob,
  CASE WHEN p1 * 0.25 / 1.75 + p2 * 0.5 / 1.75 + p3 * 1.0 / 1.75 >= 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS ens_pred,
  round((pred1 + pred2 + pred3) / 3, 0) AS vote,
  CASE WHEN (p1 + p2 + p3) / 3 >= 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS mean_prob_pred,
  CASE WHEN round((p1 + p2 + p3) / 3, 0) >= 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS mean_prob_rounded
FROM scored"""))
def q_ensembles(spark, d):
    s = Fixtures(spark, d).scored()
    prob, pred = ev.fold_ensemble(["p1", "p2", "p3"], 0.5)
    return s.select("event_id", r6(prob).alias("ens_prob"), pred.alias("ens_pred"), ev.vote(["pred1", "pred2", "pred3"]).alias("vote"),
                    ev.mean_prob(["p1", "p2", "p3"]).alias("mean_prob_pred"),
                    ev.mean_prob(["p1", "p2", "p3"], round_first=True).alias("mean_prob_rounded"))


@query("agreement", with_views(["scored"], """
SELECT 'all' AS pred_a, NULL::DOUBLE AS pred_b, count(*) AS n, count(*) FILTER (WHERE pred1 = pred2) AS agree,
  count(*) FILTER (WHERE pred1 = outcome AND pred2 = outcome) AS both_right,
  count(*) FILTER (WHERE pred1 <> outcome AND pred2 <> outcome) AS both_wrong FROM scored
UNION ALL SELECT CAST(pred1 AS VARCHAR), pred2, count(*), NULL, NULL, NULL FROM scored GROUP BY pred1, pred2"""))
def q_agreement(spark, d):
    s = Fixtures(spark, d).scored()
    a = ev.agreement(s, "pred1", "pred2", "outcome").select(
        F.lit("all").alias("pred_a"), F.lit(None).cast("double").alias("pred_b"), "n", "agree", "both_right", "both_wrong")
    t = ev.comparison_table(s, "pred1", "pred2").select(
        F.col("pred_a").cast("string").alias("pred_a"), "pred_b", "n", *[F.lit(None).cast("long").alias(c) for c in ["agree", "both_right", "both_wrong"]])
    return a.unionByName(t)


@query("errors_over", with_views(["scored"], """
SELECT CAST(hour(ts) AS INTEGER) AS dim, count(*) AS n, count(*) FILTER (WHERE outcome = 0 AND pred3 = 1) AS fp,
  count(*) FILTER (WHERE outcome = 1 AND pred3 = 0) AS fn, round(avg(CASE WHEN outcome <> pred3 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS error_rate
FROM scored GROUP BY 1"""))
def q_errors_over(spark, d):
    e = ev.errors_over(Fixtures(spark, d).scored(), F.hour("ts"), "outcome", "pred3")
    return e.select("dim", "n", "fp", "fn", r6(F.col("error_rate")).alias("error_rate"))


def _avg_rank(c):
    return f"CASE WHEN {c} IS NULL THEN NULL ELSE rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 END"


@query("error_correlation", with_views(["scored"], f""",
x AS (SELECT CASE WHEN outcome = 0 AND pred1 = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_fp,
             CASE WHEN outcome = 1 AND pred1 = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_fn, p2, p3 FROM scored),
r AS (SELECT {_avg_rank('is_fp')} AS a, {_avg_rank('is_fn')} AS b, {_avg_rank('p2')} AS c2, {_avg_rank('p3')} AS c3 FROM x)
SELECT 'is_fp' AS a, 'p2' AS b, round(corr(a, c2), 6) AS rho FROM r UNION ALL SELECT 'is_fp', 'p3', round(corr(a, c3), 6) FROM r
UNION ALL SELECT 'is_fn', 'p2', round(corr(b, c2), 6) FROM r UNION ALL SELECT 'is_fn', 'p3', round(corr(b, c3), 6) FROM r"""))
def q_error_corr(spark, d):
    e = ev.error_correlation(Fixtures(spark, d).scored(), "outcome", "pred1", ["p2", "p3"])
    return e.select("a", "b", r6(F.col("rho")).alias("rho"))


@query("residuals", with_views(["scored"], """
SELECT CASE WHEN r < -1 THEN 0 WHEN r >= 1 THEN 21 ELSE CAST(floor((r + 1) / 2.0 * 20) AS BIGINT) + 1 END AS bin, count(*) AS n
FROM (SELECT outcome - p1 AS r FROM scored) GROUP BY 1"""))
def q_residuals(spark, d):
    h = ev.residuals(Fixtures(spark, d).scored(), "outcome", "p1", 20)
    return h.select(F.col("bin").cast("long").alias("bin"), "n")


@query("upsample_random")
def q_upsample_random(spark, d):
    """M2 (reference form): minority rows drawn with replacement up to the
    majority size (seeded; rows-only check)."""
    t = _trips_l(Fixtures(spark, d))
    c = {r[0]: r[1] for r in t.groupBy("label").count().collect()}  # two classes
    ratio = max(c.values()) / min(c.values()) - 1.0
    minority = min(c, key=c.get)
    return sm.upsample_random(t, "label", minority, ratio).groupBy("label").agg(F.count(F.lit(1)).alias("n"))

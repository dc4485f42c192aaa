"""Registered queries: model pipelines and seasonal fits (mostly rows-only checks:
fitted models and least-squares fits have no SQL statement)."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from leadtime.functions.text import positive_probability
from leadtime.operators import sampling as sm
from leadtime.plans import ml
from leadtime.plans import seasonality as ss
from leadtime.plans.fixtures import HOLIDAYS, Fixtures
from leadtime.plans.registry import query
from leadtime.sources.io import stage_to

CAT, NUM = ["lang", "source"], ["n_chars"]


def _model_input(fx):
    lab = fx.table("labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    doc = fx.table("documents").select("doc_id", F.col("n_chars").cast("double").alias("n_chars"), "lang", "source")
    return lab.join(doc, "doc_id")


def _folds(df, k=3):
    f = sm.cv_bounds_rows(df, ["doc_id"], k=k)
    ids = sorted(r[0] for r in f.select("fold").distinct().collect())  # at most k small ints
    return [(f.filter((F.col("fold") == i) & (F.col("part") == "train")).drop("fold", "part"),
             f.filter((F.col("fold") == i) & (F.col("part") == "val")).drop("fold", "part")) for i in ids]


def _split(df):
    return df.filter(sm.key_hash("doc_id") < 0.75), df.filter(sm.key_hash("doc_id") >= 0.75)


def _lr(**p):
    return Pipeline(stages=ml.encode_stages(CAT, NUM, scale="standard") + [ml.model("logreg", maxIter=20, **p)])


@query("ml_cross_validate")
def q_ml_cv(spark, d):
    x = _model_input(Fixtures(spark, d))
    return ml.metrics_frame(spark, ml.cross_validate(_folds(x), _lr))


@query("ml_models")
def q_ml_models(spark, d):
    fx = Fixtures(spark, d)
    x = _model_input(fx)
    tr, te = _split(x)
    rows = []
    for kind, kw in [("logreg", {"maxIter": 20, "elasticNetParam": 0.5, "regParam": 0.01}),
                     ("rf", {"numTrees": 10, "maxDepth": 5}), ("gbt", {"maxDepth": 3, "maxIter": 10})]:
        _, m = ml.final_eval(tr, te, Pipeline(stages=ml.encode_stages(CAT, NUM) + [ml.model(kind, **kw)]),
                             sampling_fn=lambda df: sm.downsample(df, "label", "doc_id"))
        rows.append({**m, "model": kind})
    mlp = ml.fit_mlp(tr, ml.encode_stages(CAT, NUM, scale="minmax"), [4], maxIter=30)
    rows.append({**ml._metrics(mlp.transform(te), "label", "final"), "model": "mlp"})
    return ml.metrics_frame(spark, rows)


@query("ml_grid_search")
def q_ml_grid(spark, d):
    x = _model_input(Fixtures(spark, d))
    return ml.metrics_frame(spark, ml.grid_search(_folds(x, 2), _lr, {"regParam": [0.0, 0.1], "elasticNetParam": [0.0, 0.5]}))


@query("ml_random_search")
def q_ml_random(spark, d):
    x = _model_input(Fixtures(spark, d))

    def rf(numTrees, maxDepth):
        return Pipeline(stages=ml.encode_stages(CAT, NUM) + [ml.model("rf", numTrees=numTrees, maxDepth=maxDepth)])
    return ml.metrics_frame(spark, ml.random_search(_folds(x, 2), rf, {"numTrees": (3, 8), "maxDepth": (2, 4)}, 2))


@query("ml_oof_predictions")
def q_ml_oof(spark, d):
    x = _model_input(Fixtures(spark, d))
    return ml.oof_predictions(_folds(x), _lr, ["doc_id", "label"])


@query("ml_ablation")
def q_ml_ablation(spark, d):
    tr, te = _split(_model_input(Fixtures(spark, d)))
    rows = ml.ablation(tr, te, {"size": ["n_chars"], "meta": ["lang", "source"]}, CAT, NUM, "rf", numTrees=5, maxDepth=4)
    return ml.metrics_frame(spark, rows)


@query("ml_scaled_values", """
WITH x AS (SELECT doc_id, CAST(n_chars AS DOUBLE) AS v FROM labels JOIN documents USING (doc_id))
SELECT doc_id, round((v - avg(v) OVER ()) / stddev_samp(v) OVER (), 6) + 0.0 AS standard,
       round((v - min(v) OVER ()) / (max(v) OVER () - min(v) OVER ()), 6) + 0.0 AS minmax FROM x""")
def q_ml_scaled(spark, d):
    from pyspark.ml.functions import vector_to_array
    x = stage_to(_model_input(Fixtures(spark, d)).select("doc_id", "n_chars"))
    for kind in ("standard", "minmax"):
        fitted = Pipeline(stages=ml.encode_stages([], ["n_chars"], scale=kind, out=kind)).fit(x)
        x = fitted.transform(x).drop(f"{kind}__raw")
    return x.select("doc_id", *[F.round(vector_to_array(k)[0], 6).alias(k) for k in ("standard", "minmax")])


@query("ml_importance")
def q_ml_importance(spark, d):
    tr, _ = _split(_model_input(Fixtures(spark, d)))
    m = Pipeline(stages=ml.encode_stages(CAT, NUM) + [ml.model("rf", numTrees=5, maxDepth=4)]).fit(tr)
    return ml.importance_by_family(m, tr, {"size": ["n_chars"], "meta": ["lang", "source"]})


@query("ml_loss_history")
def q_ml_loss(spark, d):
    tr, _ = _split(_model_input(Fixtures(spark, d)))
    m = _lr().fit(tr)
    hist = ml.loss_history(m.stages[-1])
    return spark.createDataFrame(list(enumerate(hist)), "iter int, loss double")


@query("ml_split_table")
def q_ml_split(spark, d):
    from leadtime.plans.bind_core import _scratch
    tr, _ = _split(_model_input(Fixtures(spark, d)))
    m = Pipeline(stages=ml.encode_stages(CAT, NUM) + [ml.model("gbt", maxDepth=3, maxIter=5)]).fit(tr)
    nodes = ml.split_table(spark, m.stages[-1], _scratch(spark, "tree"))
    return ml.split_stats(nodes)


@query("ml_save_load")
def q_ml_save_load(spark, d):
    from leadtime.plans.bind_core import _scratch
    from leadtime.sources.io import load_model, save_model
    tr, te = _split(_model_input(Fixtures(spark, d)))
    m = _lr().fit(tr)
    path = _scratch(spark, "model")
    save_model(m, path)
    again = load_model(path)
    a = m.transform(te).select("doc_id", positive_probability("probability").alias("p_a"))
    b = again.transform(te).select("doc_id", positive_probability("probability").alias("p_b"))
    return a.join(b, "doc_id").select("doc_id", (F.abs(F.col("p_a") - F.col("p_b")) < 1e-12).alias("same"))


@query("ml_interactions")
def q_ml_inter(spark, d):
    tr, te = _split(_model_input(Fixtures(spark, d)))
    st = ml.encode_stages(CAT, NUM, scale="standard", interactions=[("lang", "n_chars")])
    _, m = ml.final_eval(tr, te, Pipeline(stages=st + [ml.model("logreg", maxIter=20)]))
    return ml.metrics_frame(spark, [m])


# ---------------------------------------------------------------------------
# Seasonal fits

@query("seasonality_week")
def q_season_week(spark, d):
    t = Fixtures(spark, d).trips()
    return ss.fit_seasonality_week(t, "origin", "sched", "delay_min")


@query("seasonality_year")
def q_season_year(spark, d):
    o = Fixtures(spark, d).table("orders")
    return ss.fit_seasonality_year(o, "o_orderpriority", "o_orderdate", "o_totalprice", HOLIDAYS)


@query("seasonality_by_fold")
def q_season_fold(spark, d):
    fx = Fixtures(spark, d)
    t = fx.trips()
    wk, yr = ss.seasonality_by_fold(t, fx.folds(), "origin", "sched", "delay_min", HOLIDAYS)
    out = ss.apply_by_fold(t, wk, yr, [0, 1, 2, 3], "origin", "sched")
    return out.select("trip_id", *[c for c in out.columns if c.startswith(("weekly_", "daily_", "yearly_", "holidays_"))])


@query("trend_features", """
WITH a AS (SELECT o_orderpriority AS site, CAST(o_orderdate AS DATE) AS day, avg(o_totalprice) AS y FROM orders GROUP BY 1, 2),
r AS (SELECT site, min(day) AS lo, max(day) AS hi FROM a GROUP BY site),
c AS (SELECT site, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM r),
f AS (SELECT c.site, c.day, last_value(y IGNORE NULLS) OVER (PARTITION BY c.site ORDER BY c.day) AS s
      FROM c LEFT JOIN a ON a.site = c.site AND a.day = c.day),
t AS (SELECT *, avg(s) OVER (PARTITION BY site ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS trend,
             row_number() OVER (PARTITION BY site ORDER BY day) AS n FROM f),
w AS (SELECT *, avg(s - trend) OVER (PARTITION BY site, dayofweek(day) ORDER BY day) AS season FROM t)
SELECT o.o_orderkey, round(trend, 6) + 0.0 AS trend, round(season, 6) + 0.0 AS season, round(s - trend - season, 6) + 0.0 AS resid
FROM orders o LEFT JOIN w ON w.site = o.o_orderpriority AND w.n >= 90
  AND CAST(o.o_orderdate AS DATE) = w.day + INTERVAL 7 DAY""")
def q_trend(spark, d):
    o = Fixtures(spark, d).table("orders")
    out = ss.trend_features(o, "o_orderpriority", "o_orderdate", "o_totalprice")
    return out.select("o_orderkey", *[F.round(c, 6).alias(c) for c in ("trend", "season", "resid")])


@query("ml_time_cv")
def q_ml_time_cv(spark, d):
    """Modelling flow on the trip feature table: time split (last 20 % held
    out), class weights, three blocked overlapping time folds, weighted
    logistic regression cross-validated, final fit scored on the held-out
    span (F2 and area under PR per fold and final)."""
    from leadtime.operators import clean
    from leadtime.plans import features as ft
    fx = Fixtures(spark, d)
    t = fx.trips().withColumn("period", F.floor(F.datediff(F.to_date("sched"), F.lit("2024-01-01").cast("date")) / 7).cast("long"))
    tab = ft.feature_table(t, fx.sites(), fx.stations(), fx.readings().select("reading_id", "site", "read_ts", "wind"),
                           fx.holidays(), period="period")
    num = ["hour_sin", "hour_cos", "dow_sin", "dow_cos", "prior_turnaround", "prior_depdelay_calc", "prior_isdelayed_calc",
           "mean_dep_delay", "prop_delayed", "lag_mean_delay", "days_to_holiday", "w_wind", "prev_rank"]
    tab = stage_to(clean.fill(tab.select("trip_id", "sched_utc", "label", "origin_zone", *num), numeric_value=0.0))
    train, test = sm.train_test_split(tab, "sched_utc", test_fraction=0.2)
    folds = sm.fold_frames(train, "sched_utc", sm.cv_bounds(train, "sched_utc", k=3, blocking=True, overlap=0.5))

    def lr():
        return Pipeline(stages=ml.encode_stages(["origin_zone"], num, scale="standard")
                        + [ml.model("logreg", weight="weight", maxIter=30)])
    def weighted(part):
        return sm.class_weights(part, "label")
    rows = ml.cross_validate(folds, lr, weight_fn=weighted, keep=["label", "origin_zone", *num])
    _, final = ml.final_eval(weighted(train), test, lr())
    return ml.metrics_frame(spark, rows + [final])

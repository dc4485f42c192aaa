"""Model pipelines (L1-L11, L14, L18, L19, L23-L25) on ``pyspark.ml``.

Fitting is distributed by Spark ML; the loops here run over a handful of
folds / parameter draws, each a full distributed fit.  Metrics come back
as DataFrames (one row per fold or trial) so they can be saved as tables.
"""

from __future__ import annotations

import itertools
import random
from typing import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier,
                                       RandomForestClassifier)
from pyspark.ml.feature import (Interaction, MinMaxScaler, OneHotEncoder, StandardScaler, StringIndexer,
                                VectorAssembler)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadtime.operators import evaluate as ev


def encode_stages(cat_cols: list[str], num_cols: list[str], invalid: str = "keep", scale: str | None = None,
                  interactions: list[tuple[str, str]] = (), out: str = "features") -> list:
    """L1-L4: index + one-hot (unseen categories kept), optional interaction
    terms, assemble (``invalid`` = 'keep' or 'skip'), optional min-max or
    standard (with mean) scaling."""
    idx = [f"{c}__idx" for c in cat_cols]
    ohe = [f"{c}__ohe" for c in cat_cols]
    stages = []
    if cat_cols:
        stages.append(StringIndexer(inputCols=cat_cols, outputCols=idx, handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=idx, outputCols=ohe, handleInvalid="keep"))
    inter = []
    for a, b in interactions:
        a_in = f"{a}__ohe" if a in cat_cols else a
        b_in = f"{b}__ohe" if b in cat_cols else b
        name = f"{a}_x_{b}"
        stages.append(Interaction(inputCols=[a_in, b_in], outputCol=name))
        inter.append(name)
    raw = out if not scale else f"{out}__raw"
    stages.append(VectorAssembler(inputCols=ohe + list(num_cols) + inter, outputCol=raw, handleInvalid=invalid))
    if scale == "minmax":
        stages.append(MinMaxScaler(inputCol=raw, outputCol=out))
    elif scale == "standard":
        stages.append(StandardScaler(inputCol=raw, outputCol=out, withMean=True, withStd=True))
    return stages


def model(kind: str, label: str = "label", features: str = "features", weight: str | None = None, **kw):
    """Classifier by name: 'logreg', 'rf', 'mlp', 'gbt'."""
    if kind == "logreg":
        m = LogisticRegression(labelCol=label, featuresCol=features, maxIter=kw.get("maxIter", 50),
                               regParam=kw.get("regParam", 0.0), elasticNetParam=kw.get("elasticNetParam", 0.0))
        if weight:
            m.setWeightCol(weight)
        return m
    if kind == "rf":
        m = RandomForestClassifier(labelCol=label, featuresCol=features, numTrees=kw.get("numTrees", 20),
                                   maxDepth=kw.get("maxDepth", 10), seed=kw.get("seed", 42))
        if weight:
            m.setWeightCol(weight)
        return m
    if kind == "gbt":
        m = GBTClassifier(labelCol=label, featuresCol=features, maxDepth=kw.get("maxDepth", 10),
                          maxIter=kw.get("maxIter", 20), stepSize=kw.get("stepSize", 0.1), seed=kw.get("seed", 42))
        if weight:
            m.setWeightCol(weight)
        return m
    if kind == "mlp":
        return MultilayerPerceptronClassifier(labelCol=label, featuresCol=features, layers=kw["layers"],
                                              maxIter=kw.get("maxIter", 100), blockSize=kw.get("blockSize", 128),
                                              stepSize=kw.get("stepSize", 0.03), seed=kw.get("seed", 42))
    raise ValueError(kind)


def feature_size(encoder: PipelineModel, df: DataFrame, features: str = "features") -> int:
    """Input width after encoding (needed for the MLP input layer): read from
    the assembled column's ML attribute metadata, no data pass."""
    out = encoder.transform(df.limit(0))
    meta = out.schema[features].metadata.get("ml_attr", {})
    if "num_attrs" in meta:
        return int(meta["num_attrs"])
    return int(out.schema[features].metadata["ml_attr"]["attrs"].__len__())


def fit_mlp(df: DataFrame, stages: list, hidden: list[int], label: str = "label", **kw) -> PipelineModel:
    """Two-step fit: encoders first, then the MLP with layers
    [input] + hidden + [2]."""
    enc = Pipeline(stages=stages).fit(df)
    n_in = feature_size(enc, df)
    mlp = model("mlp", label, layers=[n_in, *hidden, 2], **kw)
    m = mlp.fit(enc.transform(df))
    return PipelineModel(stages=[*enc.stages, m])


def _metrics(pred: DataFrame, label: str, fold, extra: dict | None = None) -> dict:
    from pyspark.ml.functions import vector_to_array
    pp = pred.withColumn("__p1", vector_to_array("probability")[1])
    f = ev.f_beta(pp, label, "prediction", 2.0).first()
    aupr = ev.area_under_pr(pp, label, "__p1")
    row = {"fold": fold, "f2": float(f["f_beta"]), "precision": float(f["precision"]), "recall": float(f["recall"]),
           "aupr": float(aupr)}
    row.update(extra or {})
    return row


def cross_validate(folds: list[tuple[DataFrame, DataFrame]], make_pipeline: Callable[[], Pipeline], label: str = "label",
                   sampling_fn: Callable[[DataFrame], DataFrame] | None = None,
                   weight_fn: Callable[[DataFrame], DataFrame] | None = None, keep: list[str] | None = None,
                   templates: dict[str, str] | None = None, fill: list[str] = ()) -> list[dict]:
    """Fit on each fold's training part, score its validation part; one
    metrics dict per fold.

    Per fold, in this order: fold-suffixed columns get their plain names
    (``templates``, ``fill``: ``sampling.bind_fold``), the ``keep`` columns
    are selected, the training part is resampled and weighted from its own
    rows.  A training part is read several times by a fit, so it is kept
    until the fold is done; folds should read a staged table.
    """
    from leadtime.operators.sampling import bind_fold
    out = []
    for i, (tr, va) in enumerate(folds):
        if templates:
            tr, va = bind_fold(tr, i, templates, fill), bind_fold(va, i, templates, fill)
        if keep:
            tr, va = tr.select(*keep), va.select(*keep)
        for fn in (sampling_fn, weight_fn):
            tr = fn(tr) if fn is not None else tr
        tr = tr.persist()
        pred = make_pipeline().fit(tr).transform(va).select(label, "prediction", "probability").persist()
        out.append(_metrics(pred, label, i))
        tr.unpersist()
        pred.unpersist()
    return out


def metrics_frame(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Metrics list -> DataFrame (saved like any table; replaces a tracking server)."""
    keys = sorted({k for r in rows for k in r})
    return spark.createDataFrame([tuple(r.get(k) for k in keys) for r in rows], keys)


def grid_search(folds, make_pipeline: Callable[..., Pipeline], grid: dict[str, list], label: str = "label") -> list[dict]:
    """Every combination of the grid, cross-validated."""
    names = sorted(grid)
    rows = []
    for combo in itertools.product(*[grid[n] for n in names]):
        params = dict(zip(names, combo))
        res = cross_validate(folds, lambda: make_pipeline(**params), label)
        rows.append({**{f"param_{k}": float(v) for k, v in params.items()},
                     "mean_f2": sum(r["f2"] for r in res) / len(res)})
    return rows


def random_search(folds, make_pipeline: Callable[..., Pipeline], space: dict[str, tuple], n: int, seed: int = 42,
                  label: str = "label") -> list[dict]:
    """``n`` seeded random draws from the space (uniform on (lo, hi), or
    a choice from a list), each cross-validated."""
    rng = random.Random(seed)
    rows = []
    for t in range(n):
        params = {}
        for k, v in sorted(space.items()):
            if isinstance(v, list):
                params[k] = rng.choice(v)
            else:
                lo, hi = v
                params[k] = rng.randint(lo, hi) if isinstance(lo, int) and isinstance(hi, int) else rng.uniform(lo, hi)
        res = cross_validate(folds, lambda: make_pipeline(**params), label)
        rows.append({"trial": t, **{f"param_{k}": float(v) for k, v in params.items()},
                     "mean_f2": sum(r["f2"] for r in res) / len(res)})
    return rows


def oof_predictions(folds, make_pipeline: Callable[[], Pipeline], keep: list[str]) -> DataFrame:
    """Out-of-fold predictions stacked over folds (fold column added)."""
    from functools import reduce
    from pyspark.ml.functions import vector_to_array
    parts = []
    for i, (tr, va) in enumerate(folds):
        m = make_pipeline().fit(tr)
        p = m.transform(va).select(*keep, F.lit(i).alias("fold"), "prediction",
                                   vector_to_array("probability")[1].alias("prob"))
        parts.append(p)
    return reduce(lambda a, b: a.unionByName(b), parts)


def ablation(train: DataFrame, test: DataFrame, families: dict[str, list[str]], cat_cols: list[str],
             num_cols: list[str], kind: str = "rf", label: str = "label", **kw) -> list[dict]:
    """Refit without one feature family at a time (and with all)."""
    rows = []
    for fam in [None, *families]:
        drop = set(families.get(fam, [])) if fam else set()
        stages = encode_stages([c for c in cat_cols if c not in drop], [c for c in num_cols if c not in drop])
        p = Pipeline(stages=stages + [model(kind, label, **kw)]).fit(train)
        rows.append(_metrics(p.transform(test), label, -1, {"without": fam or "none"}))
    return rows


def importance_by_family(fitted: PipelineModel, df: DataFrame, families: dict[str, list[str]],
                         features: str = "features") -> DataFrame:
    """Tree feature importances named through the assembled vector's
    attribute metadata, with the share of each feature family."""
    spark = df.sparkSession
    tree = fitted.stages[-1]
    meta = fitted.transform(df.limit(0)).schema[features].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for group in meta.values() for a in group}
    imp = tree.featureImportances.toArray()

    def family(n):
        for f, cols in families.items():
            if any(n == c or n.startswith(f"{c}__") for c in cols):
                return f
        return "other"

    rows = [(names.get(i, str(i)), family(names.get(i, str(i))), float(v)) for i, v in enumerate(imp)]
    t = spark.createDataFrame(rows, "feature string, family string, importance double")
    from pyspark.sql import Window
    return t.withColumn("family_share", F.sum("importance").over(Window.partitionBy("family")))


def loss_history(fitted_lr) -> list[float]:
    """Training objective per iteration of a fitted logistic model."""
    return list(fitted_lr.summary.objectiveHistory)


def final_eval(train: DataFrame, test: DataFrame, pipeline: Pipeline, label: str = "label",
               sampling_fn=None) -> tuple[PipelineModel, dict]:
    """Fit on the (optionally resampled) full training set, score the
    held-out set, return the model and its metrics."""
    tr = sampling_fn(train) if sampling_fn else train
    m = pipeline.fit(tr)
    return m, _metrics(m.transform(test), label, "final")


def split_table(spark: SparkSession, fitted_tree, path: str) -> DataFrame:
    """Tree nodes as a table (the node data Spark saves as Parquet)."""
    fitted_tree.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    nd = "nodeData" if "nodeData" in nodes.columns else None
    base = nodes.select("treeID", "nodeData.*") if nd else nodes.select(F.lit(0).alias("treeID"), "*")
    return base.select("treeID", "id", "prediction", "impurity", "leftChild", "rightChild",
                       F.col("split.featureIndex").alias("feature"),
                       F.col("split.leftCategoriesOrThreshold").alias("thresholds"))


def split_stats(nodes: DataFrame) -> DataFrame:
    """Distribution of split thresholds per feature (internal nodes)."""
    x = nodes.filter(F.col("leftChild") >= 0).select("feature", F.explode("thresholds").alias("thr"))
    return x.groupBy("feature").agg(F.count(F.lit(1)).alias("n_splits"), F.min("thr").alias("min_thr"),
                                    F.max("thr").alias("max_thr"), F.avg("thr").alias("mean_thr"))

"""Evaluation of predictions (L12-L17, L20-L22): all grouped aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadtime.operators import aggregates as ag


def f_beta(df: DataFrame, y: str, p: str, beta: float = 2.0, positive=1) -> DataFrame:
    """Precision, recall and F-beta for the positive class in one pass."""
    tp = F.count_if((F.col(y) == positive) & (F.col(p) == positive))
    fp = F.count_if((F.col(y) != positive) & (F.col(p) == positive))
    fn = F.count_if((F.col(y) == positive) & (F.col(p) != positive))
    c = df.agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"))
    prec = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(0.0)
    rec = F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(0.0)
    b2 = beta * beta
    f = F.when(prec + rec > 0, (1 + b2) * prec * rec / (b2 * prec + rec)).otherwise(0.0)
    return c.select("tp", "fp", "fn", prec.alias("precision"), rec.alias("recall"), f.alias("f_beta"))


def area_under_pr(df: DataFrame, y: str, score: str) -> float:
    """Area under the precision-recall curve (Spark evaluator, a point
    for every distinct score)."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    ev = BinaryClassificationEvaluator(rawPredictionCol=score, labelCol=y, metricName="areaUnderPR", numBins=0)
    return ev.evaluate(df.select(F.col(score).cast("double").alias(score), F.col(y).cast("double").alias(y)))


def classify(y, p) -> Column:
    """TP / TN / FP / FN label."""
    yc, pc = F.col(y), F.col(p)
    return (F.when((yc == 1) & (pc == 1), "TP").when((yc == 0) & (pc == 0), "TN")
            .when((yc == 0) & (pc == 1), "FP").when((yc == 1) & (pc == 0), "FN"))


def fold_ensemble(prob_cols: list[str], alpha: float = 0.5, threshold: float = 0.5) -> tuple[Column, Column]:
    """Weighted mean of fold-model probabilities, weight alpha^(k-1-i)
    normalised (later folds weigh more); prediction = mean >= threshold."""
    k = len(prob_cols)
    ws = [alpha ** (k - 1 - i) for i in range(k)]
    s = sum(ws)
    prob = reduce(lambda a, b: a + b, [F.col(c) * (w / s) for c, w in zip(prob_cols, ws)])
    return prob, F.when(prob >= threshold, 1.0).otherwise(0.0)


def vote(pred_cols: list[str]) -> Column:
    """Majority vote = rounded mean of 0/1 predictions (half up)."""
    m = reduce(lambda a, b: a + b, [F.col(c) for c in pred_cols]) / len(pred_cols)
    return F.round(m, 0)


def mean_prob(prob_cols: list[str], threshold: float = 0.5, round_first: bool = False) -> Column:
    """Mean probability >= threshold (``round_first`` reproduces the
    reference, which rounds the mean before comparing)."""
    m = reduce(lambda a, b: a + b, [F.col(c) for c in prob_cols]) / len(prob_cols)
    if round_first:
        m = F.round(m, 0)
    return F.when(m >= threshold, 1.0).otherwise(0.0)


def agreement(df: DataFrame, a: str, b: str, y: str | None = None) -> DataFrame:
    """Agreement counts between two models (and both right/wrong when
    the label is given)."""
    aggs = [F.count(F.lit(1)).alias("n"), F.count_if(F.col(a) == F.col(b)).alias("agree")]
    if y:
        aggs += [F.count_if((F.col(a) == F.col(y)) & (F.col(b) == F.col(y))).alias("both_right"),
                 F.count_if((F.col(a) != F.col(y)) & (F.col(b) != F.col(y))).alias("both_wrong")]
    return df.agg(*aggs)


def comparison_table(df: DataFrame, a: str, b: str) -> DataFrame:
    """Class-by-class table of two models' predictions."""
    return df.groupBy(F.col(a).alias("pred_a"), F.col(b).alias("pred_b")).agg(F.count(F.lit(1)).alias("n"))


def errors_over(df: DataFrame, dim, y: str, p: str, name: str = "dim") -> DataFrame:
    """Error counts (FP, FN, total) and error rate per dimension value
    (day, hour, quarter, site ...)."""
    d = F.col(dim) if isinstance(dim, str) else dim
    return df.groupBy(d.alias(name)).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((F.col(y) == 0) & (F.col(p) == 1)).alias("fp"),
        F.count_if((F.col(y) == 1) & (F.col(p) == 0)).alias("fn"),
        F.avg((F.col(y) != F.col(p)).cast("double")).alias("error_rate"))


def error_correlation(df: DataFrame, y: str, p: str, features: list[str]) -> DataFrame:
    """Rank correlation of error flags (FP, FN) with features."""
    x = df.withColumns({"is_fp": ((F.col(y) == 0) & (F.col(p) == 1)).cast("double"),
                        "is_fn": ((F.col(y) == 1) & (F.col(p) == 0)).cast("double")})
    m = ag.spearman(x, ["is_fp", "is_fn", *features])
    return m.filter(F.col("a").isin("is_fp", "is_fn") & ~F.col("b").isin("is_fp", "is_fn"))


def residuals(df: DataFrame, y: str, prob: str, bins: int = 20) -> DataFrame:
    """Histogram of y - p over [-1, 1]."""
    from leadtime.functions.text import residual
    return ag.histogram(df.withColumn("__res", residual(y, prob)), "__res", -1.0, 1.0, bins)

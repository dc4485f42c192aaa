"""Set operations and sort/limit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def distinct_values(df: DataFrame, cols: list[str], out: str = "value") -> DataFrame:
    """Distinct values found in any of the columns (union + distinct)."""
    parts = [df.select(F.col(c).alias(out)) for c in cols]
    return reduce(lambda a, b: a.union(b), parts).distinct()


def union_all(dfs: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Union by name over a list."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


def union_aligned(a: DataFrame, b: DataFrame) -> DataFrame:
    """Positional union after aligning ``b`` to ``a``'s columns (columns
    of ``a`` missing in ``b`` become NULL)."""
    bcols = set(b.columns)
    types = {f.name: f.dataType for f in a.schema.fields}
    bb = b.select(*[F.col(c) if c in bcols else F.lit(None).cast(types[c]).alias(c) for c in a.columns])
    return a.union(bb)


def split_apply_union(df: DataFrame, cond: Column, f, g) -> DataFrame:
    """U4: process the rows where ``cond`` holds with f, the rest with g, and
    recombine by name."""
    c = F.coalesce(cond, F.lit(False))
    return f(df.filter(c)).unionByName(g(df.filter(~c)))


def distinct_exploded(df: DataFrame, cols: list[str], out: str = "value") -> DataFrame:
    """Distinct values of several columns through one array explode."""
    return df.select(F.explode(F.array(*[F.col(c) for c in cols])).alias(out)).distinct()


def sort_by(df: DataFrame, keys: list) -> DataFrame:
    """Global sort; keys are names ('-name' = descending) or Columns."""
    cols = []
    for k in keys:
        if isinstance(k, str) and k.startswith("-"):
            cols.append(F.col(k[1:]).desc())
        else:
            cols.append(F.col(k) if isinstance(k, str) else k)
    return df.orderBy(*cols)


def top_k(df: DataFrame, score: str, k: int, skip: int = 0, tie: str | None = None) -> DataFrame:
    """Top k by score (descending), optionally skipping the first
    ``skip``; ties broken on ``tie``.  Spark plans this as a
    TakeOrderedAndProject: each task keeps only its local top k+skip."""
    order = [F.col(score).desc()] + ([F.col(tie).asc()] if tie else [])
    out = df.orderBy(*order).limit(k + skip)
    return out.offset(skip) if skip else out


def top_k_per_group(df: DataFrame, key: str, score: str, k: int, tie: str) -> DataFrame:
    """K best rows per group; ``row_number() <= k`` is planned with a
    window group limit, so each group is cut before the full sort."""
    w = Window.partitionBy(key).orderBy(F.col(score).desc(), F.col(tie).asc())
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def head(df: DataFrame, n: int, order: list[str] | None = None) -> DataFrame:
    """T4: ``n`` rows, the first in ``order`` when given (a top-k plan, no
    full sort)."""
    return df.orderBy(*order).limit(n) if order else df.limit(n)


def top_features(df: DataFrame, by: str, n: int, name: str = "feature") -> DataFrame:
    """T5: the n largest entries (e.g. feature importances)."""
    return df.orderBy(F.col(by).desc(), F.col(name).asc()).limit(n)

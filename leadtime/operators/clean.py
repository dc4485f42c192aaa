"""Projections, filters and predicates."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadtime.functions._util import col


def keep_columns(df: DataFrame, names: list[str] = (), patterns: list[str] = ()) -> DataFrame:
    """Keep listed columns plus those matching any regex pattern
    (prefix/suffix patterns such as '^origin_' or '_utc$'), in input order."""
    pats = [re.compile(p) for p in patterns]
    keep = [c for c in df.columns if c in set(names) or any(p.search(c) for p in pats)]
    return df.select(*keep)


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """P2."""
    return df.drop(*names)


def filter_has_outcome(df: DataFrame, outcome: str, flag: str) -> DataFrame:
    """Rows whose outcome is known: a value, or the flag set (cancelled)."""
    return df.filter(F.col(outcome).isNotNull() | (F.col(flag) == 1))


def filter_complete(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows with every mandatory key present."""
    return df.dropna(subset=list(cols))


def label(delay, flag, threshold: float = 15.0) -> Column:
    """P5: 1.0 if delay >= threshold or flag = 1, else 0.0 (NULL delay = not late)."""
    return F.when((col(delay) >= threshold) | (col(flag) == 1), 1.0).otherwise(0.0)


def label_nullable(delay, threshold: float = 15.0) -> Column:
    """NULL where the delay is NULL."""
    return F.when(col(delay).isNull(), F.lit(None).cast("double")).when(col(delay) >= threshold, 1.0).otherwise(0.0)


def remap(df: DataFrame, column: str, mapping: dict, when: Column | None = None) -> DataFrame:
    """Replace codes; with ``when`` only on rows where it holds."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    new = F.coalesce(m[F.col(column)], F.col(column))
    if when is not None:
        new = F.when(when, new).otherwise(F.col(column))
    return df.withColumn(column, new)


def repair(df: DataFrame, column: str, bad, good) -> DataFrame:
    """Sentinel repair (e.g. wind 2237 -> 0)."""
    return df.withColumn(column, F.when(F.col(column) == F.lit(bad), F.lit(good)).otherwise(F.col(column)))


def outliers(df: DataFrame, column: str, above: float) -> DataFrame:
    """P8 probe: rows beyond a bound."""
    return df.filter(F.col(column) > above)


def filter_in(df: DataFrame, keys: DataFrame, on: str, key_col: str | None = None) -> DataFrame:
    """Membership filter from a key table -- a left-semi join, not a
    driver-side collect + isin.  AQE broadcasts the distinct keys when their
    measured size is small."""
    k = keys.select(F.col(key_col or on).alias(on)).distinct()
    return df.join(k, on, "left_semi")


def filter_matches(df: DataFrame, column: str, contains: str | None = None,
                   regex: str | None = None) -> DataFrame:
    """P10: substring or regex filter."""
    c = F.lit(True)
    if contains is not None:
        c = c & F.col(column).contains(contains)
    if regex is not None:
        c = c & F.col(column).rlike(regex)
    return df.filter(c)


def filter_country(df: DataFrame, name_col: str, code: str) -> DataFrame:
    """Keep rows whose name ends with the 2-letter country code."""
    return df.filter(F.substring(F.col(name_col), -2, 2) == code)


def select_except(df: DataFrame, names: list[str]) -> DataFrame:
    """All columns but the listed ones."""
    return df.select(*[c for c in df.columns if c not in set(names)])


def prefix(df: DataFrame, p: str, exclude: list[str] = ()) -> DataFrame:
    """Prefix all columns (except ``exclude``)."""
    return df.select(*[F.col(c).alias(c if c in exclude else f"{p}{c}") for c in df.columns])


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename by map."""
    return df.withColumnsRenamed(mapping)


def duplicate_names(df: DataFrame) -> list[str]:
    """Names occurring more than once (case-insensitive, as Spark resolves)."""
    seen, dup = set(), []
    for c in df.columns:
        k = c.lower()
        if k in seen and c not in dup:
            dup.append(c)
        seen.add(k)
    return dup


def drop_duplicate_names(df: DataFrame) -> DataFrame:
    """Keep the first of same-named columns (positional rename)."""
    names, keep = [], []
    for i, c in enumerate(df.columns):
        names.append(f"__c{i}")
        if c.lower() not in {df.columns[j].lower() for j in range(i)}:
            keep.append((f"__c{i}", c))
    t = df.toDF(*names)
    return t.select(*[F.col(a).alias(b) for a, b in keep])


def cast_all(df: DataFrame, cols: list[str], to: str) -> DataFrame:
    """Bulk cast with ``try_cast`` (bad values -> NULL, ANSI-safe)."""
    return df.withColumns({c: F.col(c).try_cast(to) for c in cols})


def fill(df: DataFrame, mapping: dict | None = None, numeric_value=None) -> DataFrame:
    """Fill NULLs by dict, or every numeric column with one constant."""
    if mapping:
        return df.fillna(mapping)
    num = [f.name for f in df.schema.fields if f.dataType.typeName() in
           ("integer", "long", "double", "float", "short", "byte", "decimal")]
    return df.fillna(numeric_value, subset=num)


def select_features(df: DataFrame, label_col: str, exclude: list[str] = (),
                    id_like: tuple[str, ...] = ("_id", "_ts", "_utc")) -> tuple[list[str], list[str]]:
    """(numeric, categorical) feature columns from the schema: strings are
    categorical, numbers numeric; the label, excluded names and id/time-like
    suffixes are left out."""
    num, cat = [], []
    for f in df.schema.fields:
        n = f.name
        if n == label_col or n in exclude or any(n.endswith(s) for s in id_like):
            continue
        t = f.dataType.typeName()
        if t == "string":
            cat.append(n)
        elif t in ("integer", "long", "double", "float", "short", "decimal"):
            num.append(n)
    return num, cat


def between(df: DataFrame, column: str, lo=None, hi=None, hi_inclusive: bool = False) -> DataFrame:
    """Range filter on a plain column (pushed down to the Parquet scan)."""
    c = F.lit(True)
    if lo is not None:
        c = c & (F.col(column) >= F.lit(lo))
    if hi is not None:
        c = c & ((F.col(column) <= F.lit(hi)) if hi_inclusive else (F.col(column) < F.lit(hi)))
    return df.filter(c)


def only_correct(df: DataFrame, y: str, pred: str, others: list[str]) -> DataFrame:
    """Rows where ``pred`` is right and every other model is wrong."""
    cond = F.col(pred) == F.col(y)
    for o in others:
        cond = cond & (F.col(o) != F.col(y))
    return df.filter(cond)

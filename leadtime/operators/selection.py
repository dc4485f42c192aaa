"""Rows at given places of an order, without sorting or numbering the table.

``values_at`` narrows each place down with histograms of the first order
column: one aggregate pass counts equal-width bins over its span, the bin
that holds a place becomes the next span, and so on until the bin is small
or a single value.  Only those bins' rows are sorted; a value with many ties
goes on with the next order column.  The driver sees bin counts (a bounded
number for each place) and one row per place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BINS = 4096        # bins of a span in one pass
SMALL = 10_000     # rows of a bin that are sorted

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _axis(df: DataFrame, c: str) -> Column | None:
    """The column as a whole number in the same order; None if it has none."""
    t = df.schema[c].dataType
    if isinstance(t, T.TimestampType):
        return F.unix_micros(F.col(c))
    if isinstance(t, T.DateType):
        return F.unix_date(F.col(c)).cast("long")
    return F.col(c).cast("long") if isinstance(t, _INTEGERS) else None


def _raw(df: DataFrame, c: str) -> Column:
    """What is fetched for a column: its number where it has one."""
    a = _axis(df, c)
    return F.col(c) if a is None else a


def literal(df: DataFrame, c: str, value) -> Column:
    """A fetched value as a column of the type of ``c``."""
    t = df.schema[c].dataType
    if value is not None and isinstance(t, T.TimestampType):
        return F.timestamp_micros(F.lit(value))
    if value is not None and isinstance(t, T.DateType):
        return F.date_from_unix_date(F.lit(value).cast("int"))
    return F.lit(value).cast(t)


def _sorted_picks(df: DataFrame, order: list[str], spans: list[tuple[Column, int]], wanted: dict[int, int]) -> dict[int, tuple]:
    """``wanted``: place -> span; each span is a condition with the number of
    rows before it, and few rows, which are sorted."""
    which = F.lit(None).cast("int")
    for i, (cond, _) in enumerate(spans):
        which = F.when(cond, F.lit(i)).otherwise(which)
    rows = df.select(*order, which.alias("__span")).filter("__span IS NOT NULL")
    rows = rows.withColumn("__no", F.row_number().over(Window.partitionBy("__span").orderBy(*order)))
    pick = F.lit(False)
    for place, i in wanted.items():
        pick = pick | ((F.col("__span") == i) & (F.col("__no") == place - spans[i][1]))
    got = rows.filter(pick).select("__span", "__no", F.struct(*[_raw(df, c).alias(f"c{j}") for j, c in enumerate(order)]).alias("v")).collect()
    by = {(r["__span"], r["__no"]): tuple(r["v"]) for r in got}
    return {place: by[i, place - spans[i][1]] for place, i in wanted.items()}


def values_at(df: DataFrame, order: list[str], places: list[int]) -> dict[int, tuple]:
    """The values of the ``order`` columns in the rows at the 1-based
    ``places`` in ascending order, NULLs first: timestamps as microseconds,
    dates as days (``literal`` makes columns of them).  Places outside of the
    table are left out.

    The first column should be a timestamp, date or integer.  Where a column
    of another type decides (it comes first, or all before it are tied), the
    rows in question are numbered by a distributed sort instead.
    """
    df = df.select(*order)
    x = _axis(df, order[0])
    if x is None:
        return _numbered_picks(df, order, places)
    d = df.withColumn("__x", x)
    n, known, lo, hi = d.agg(F.count(F.lit(1)), F.count("__x"), F.min("__x"), F.max("__x")).first()
    places = sorted({p for p in places if 1 <= p <= n})
    nulls = n - known
    # place -> (lowest, highest value, rows before, rows)
    spans = {p: (lo, hi, nulls, known) for p in places if p > nulls}
    while True:
        open_spans = sorted({s for s in spans.values() if s[0] < s[1] and s[3] > SMALL})
        if not open_spans:
            break
        cell = F.lit(None).cast("struct<s:int,b:long>")
        for i, (a, z, _, _) in enumerate(open_spans):
            inside = (F.col("__x") >= F.lit(a)) & (F.col("__x") <= F.lit(z))
            step = (z - a) // BINS + 1
            cell = F.when(inside, F.struct(F.lit(i).alias("s"), F.expr(f"(__x - ({a}L)) div {step}L").alias("b"))).otherwise(cell)
        counts: dict[int, list] = {}
        for r in d.select(cell.alias("c")).filter("c IS NOT NULL").groupBy("c").count().collect():
            counts.setdefault(r.c.s, []).append((r.c.b, r["count"]))
        for p, s in list(spans.items()):
            if s in open_spans:
                a, z, before, _ = s
                step = (z - a) // BINS + 1
                for b, m in sorted(counts[open_spans.index(s)]):
                    if p <= before + m:
                        spans[p] = (a + b * step, min(z, a + (b + 1) * step - 1), before, m)
                        break
                    before += m
    out, small, wanted = {}, [], {}
    for s in sorted(set(spans.values())):
        mine = [p for p in spans if spans[p] == s]
        a, z, before, m = s
        inside = (_axis(df, order[0]) >= F.lit(a)) & (_axis(df, order[0]) <= F.lit(z))
        if m <= SMALL:
            wanted.update({p: len(small) for p in mine})
            small.append((inside, before))
        elif len(order) == 1:
            out.update({p: (a,) for p in mine})
        else:
            rest = values_at(df.filter(inside), order[1:], [p - before for p in mine])
            out.update({p: (a, *rest[p - before]) for p in mine})
    if small:
        out.update(_sorted_picks(df, order, small, wanted))
    in_nulls = [p for p in places if p <= nulls]
    if in_nulls and len(order) == 1:
        out.update({p: (None,) for p in in_nulls})
    elif in_nulls:
        rest = values_at(df.filter(F.col(order[0]).isNull()), order[1:], in_nulls)
        out.update({p: (None, *rest[p]) for p in in_nulls})
    return out


def _numbered_picks(df: DataFrame, order: list[str], places: list[int]) -> dict[int, tuple]:
    from leadtime.operators.windows import row_index
    idx = row_index(df, order, "__no").filter(F.col("__no").isin(*[int(p) for p in places]))
    rows = idx.select("__no", F.struct(*[_raw(df, c).alias(f"c{j}") for j, c in enumerate(order)]).alias("v")).collect()
    return {r["__no"]: tuple(r["v"]) for r in rows}


def row_key(order: list[str]) -> Column:
    """The order columns as one comparable value (NULLs first)."""
    return F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(order)])


def key_literal(df: DataFrame, order: list[str], values: tuple) -> Column:
    """Values of ``values_at`` as a value that compares with ``row_key``."""
    return F.struct(*[literal(df, c, v).alias(f"c{i}") for i, (c, v) in enumerate(zip(order, values))])

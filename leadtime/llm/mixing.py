"""Mixing sources to target weights.

Sizes are summed per source, each source's target gives a repetition rate,
and each document is emitted floor(rate) times plus one more copy with
probability equal to the fraction, drawn from a seeded hash of the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadtime.llm.common import WORD, packed, staged
from leadtime.operators.windows import row_index

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0


def text_size(text: Column) -> Column:
    """Number of words; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(seed: int, doc_id: Column, size: Column) -> Column:
    """A number in [0, 1) from the document alone, equal in every run."""
    key = F.concat_ws("|", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("null")), size.cast("string"))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``source, source_size, target`` from rows of (source, size).

    Sources in code-point order, NULL last, take the weights in turn and
    share ``share`` times all sizes.  A target stops at ``cap`` times its
    source's size and the excess is shared again by weight until none is
    above.  Only sums over the sources reach the driver.
    """
    per = (sized.groupBy("source").agg(F.sum("size").alias("source_size"))
           .withColumn("nul", F.col("source").isNull()))
    pick = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("i") % len(weights) + 1).cast("int"))
    per = staged(row_index(per, ["nul", "source"], "n").withColumn("i", F.col("n") - 1)
                 .withColumn("weight", pick.cast("long")).select("source", "source_size", "weight"), "sources")
    most = F.col("source_size") * F.lit(cap)
    total = per.agg(F.sum("source_size").alias("s"), F.sum("weight").alias("w")).first()
    want, level = share * float(total.s or 0), 0.0
    held, free = 0.0, float(total.w or 0)
    while free:
        level = (want - held) / free
        full = F.lit(level) * F.col("weight") > most
        r = per.agg(F.sum(F.when(full, most)).alias("held"), F.sum(F.when(~full, F.col("weight"))).alias("free")).first()
        if (r.held or 0.0, float(r.free or 0)) == (held, free):
            break
        held, free = r.held or 0.0, float(r.free or 0)
    target = F.least(F.lit(level) * F.col("weight"), most) if free else most
    return staged(per.select("source", "source_size", target.alias("target")), "targets")


def _copies(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Adds ``source_size, target, copies`` to rows with (source, size, u).

    The join is on the source; a staged table of few sources is broadcast
    from its file size, a larger one is joined by shuffle, where adaptive
    execution splits a hot source.
    """
    t = targets.select(F.col("source").alias("__s"), "source_size", "target")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    n = whole + (F.col("u") < rate - whole).cast("long")
    return (sized.join(t, F.col("source").eqNullSafe(F.col("__s")), "left").drop("__s").withColumn("copies", n))


def mix_report(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = 7) -> DataFrame:
    """Per row: ``doc_id, size, source_size, target, taken`` (size times the
    copies the mix takes).

    A NULL or blank text has size 0 and takes nothing; a NULL source is a
    source of its own; NULL ids and repeated rows are drawn like others
    (equal id and size: equal draw).  Extra columns are not read.  An empty
    table gives an empty result.
    """
    sized = staged(docs.select(F.col("doc_id"), F.col("source"), text_size(F.col("text")).alias("size")), "sizes")
    sized = sized.withColumn("u", draw(seed, F.col("doc_id"), F.col("size")))
    out = _copies(sized, source_targets(sized, weights, share, cap))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = 7) -> DataFrame:
    """The mixed corpus: the columns of ``docs``, each row as often as the
    mix takes it."""
    one = packed(docs, source=F.col("source"), __id=F.col("doc_id"), size=text_size(F.col("text")))
    targets = source_targets(one.select("source", "size"), weights, share, cap)
    out = _copies(one.withColumn("u", draw(seed, F.col("__id"), F.col("size"))), targets)
    out = out.filter(F.col("copies") > 0).select("row", F.explode(F.expr("array_repeat(0, int(copies))")))
    return out.select("row.*")


def sql(weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = 7) -> str:
    """DuckDB SQL for ``mix_report`` over ``documents``.

    With sources ordered by cap / weight, the sources that stop at their cap
    come first: the level is the first at which no further source is above.
    """
    return f"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
           FROM documents),
p AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             row_number() OVER (ORDER BY source IS NULL, source) - 1 AS i FROM d GROUP BY source),
w AS (SELECT *, [{', '.join(map(str, weights))}][CAST(i % {len(weights)} AS INT) + 1] AS weight,
             source_size * {cap!r}::DOUBLE AS most FROM p),
o AS (SELECT *, coalesce(sum(most) OVER before, 0) AS held,
             sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS free,
             sum(source_size) OVER () * {share!r}::DOUBLE AS want
      FROM w WINDOW before AS (ORDER BY most / weight, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT (want - held) / free AS level FROM o
      WHERE (want - held) / free * weight <= most ORDER BY most / weight, i LIMIT 1),
t AS (SELECT source, source_size, least(coalesce((SELECT level FROM l) * weight, most), most) AS target FROM w),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
             CAST('0x' || substr(md5('{seed}|' || coalesce(CAST(d.doc_id AS VARCHAR), 'null') || '|' ||
                                     CAST(d.size AS VARCHAR)), 1, 13) AS BIGINT) / {float(1 << 52)!r}::DOUBLE AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       size * CAST(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS taken FROM r
"""

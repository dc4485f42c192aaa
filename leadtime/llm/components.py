"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadtime.llm.common import remove, scratch_path, staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (a, b), a < b.

    Large: each node sends its larger neighbours to its smallest neighbour or
    itself.  Small: each node sends itself and its smaller neighbours to the
    smallest of them.  The smallest neighbour is a map-side combined minimum;
    the join back is one row per node on one side, so adaptive execution
    splits the rows of a hub.
    """
    up, down = edges.select(F.col("a").alias("u"), F.col("b").alias("v")), edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    if large:
        least = up.unionByName(down).groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        out = up.join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    else:
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = down.join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        out = moved.unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
    return out.filter("a < b").distinct()


def _digest(edges: DataFrame):
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return r.n, r.h


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the links (a, b) of longs, a = b
    ignored: the smallest node of its component (signed order).

    Rounds go on until the links stop changing -- a logarithmic number -- and
    each is written to the shared folder and replaces the one before.
    """
    spark = edges.sparkSession
    cur = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b")
    last, old = None, None
    while True:
        path = scratch_path(spark, "star")
        cur = staged(_star(_star(cur, True), False), "star", path)
        if old:
            remove(spark, old)
        old, now = path, _digest(cur)
        if now == last:
            break
        last = now
    return (cur.select(F.col("b").alias("node"), F.col("a").alias("root"))
            .unionByName(cur.select(F.col("a").alias("node"), F.col("a").alias("root"))).distinct())

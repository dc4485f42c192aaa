"""Rank features from the event network."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadtime.operators import graph, joins


def previous_period_rank(df: DataFrame, src: str, dst: str, period: str, reset: float = 0.15,
                         iters: int = 10, out: str = "prev_rank", graph_rows: DataFrame | None = None,
                         degrees: bool = False) -> DataFrame:
    """PageRank of each period's network, attached to the rows of the
    *next* period (no leakage).  All periods are ranked in one grouped plan
    (group = period) instead of a driver loop; the period is shifted by one
    in the key and joined once.  ``period`` must be a consecutive integer
    index (e.g. year*4 + quarter).  With ``degrees`` also the number of
    distinct sources and destinations linked to the node in that period
    (``in_degree``, ``out_degree``; NULL for a node not in the network)."""
    g = (graph_rows if graph_rows is not None else df).select(src, dst, period)
    v, e = graph.build_graph(g, src, dst, group=period)
    pr = graph.pagerank(v, e, reset, iters, group=period)
    extra = []
    if degrees:
        deg = graph.degrees(e.distinct(), period).withColumnsRenamed({period: "__dp", "id": "__did"})
        pr = pr.join(deg, (pr[period] == deg["__dp"]) & (pr["id"] == deg["__did"]), "left")
        extra = [F.coalesce(c, F.lit(0)).alias(c) for c in ("in_degree", "out_degree")]
    nxt = pr.select((F.col(period) + 1).alias("__p"), F.col("id").alias("__id"), F.col("pagerank").alias(out), *extra)
    j = df.join(nxt, (df[period] == nxt["__p"]) & (df[src].cast("string") == nxt["__id"]), "left")
    return j.drop("__p", "__id")


def rank_by_fold(df: DataFrame, bounds: DataFrame, src: str, dst: str, t: str, folds: list[int],
                 reset: float = 0.15, iters: int = 10, prefix: str = "pr_") -> DataFrame:
    """PageRank per CV fold (rows of the fold's [lo, hi) span), all
    folds in one grouped plan, attached as one column per fold (pivot +
    one join)."""
    x = joins.assign_intervals(df, bounds, t)
    v, e = graph.build_graph(x, src, dst, group="fold")
    pr = graph.pagerank(v, e, reset, iters, group="fold")
    keyed = df.withColumn("__k", F.col(src).cast("string"))
    long = pr.withColumnRenamed("id", "__k")
    return joins.attach_wide(keyed, long, "__k", "fold", "pagerank", folds, prefix).drop("__k")

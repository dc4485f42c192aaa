"""Registered queries: graph operators (G1-G11) and rank features.

The SQL oracles unroll the iterations as a chain of CTEs.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from leadtime.operators import graph
from leadtime.plans.fixtures import Fixtures, with_views
from leadtime.plans.registry import query
from leadtime.sources.io import adjacency_from_lines


def r6(c):
    return F.round(c, 6)


def pagerank_sql(edges: str, iters: int, reset: float = 0.15, grouped: bool = False) -> str:
    """CTE chain computing grouped PageRank over ``edges(g, src, dst)``;
    the last CTE is ``r{iters}(g, id, r)``."""
    g = "g" if grouped else "0"
    parts = [
        f"e0 AS (SELECT {g} AS g, src, dst FROM {edges})",
        "v AS (SELECT g, src AS id FROM e0 UNION SELECT g, dst FROM e0)",
        "nn AS (SELECT g, CAST(count(*) AS DOUBLE) AS n FROM v GROUP BY g)",
        "p AS (SELECT g, src, dst, count(*) / sum(count(*)) OVER (PARTITION BY g, src) AS p FROM e0 GROUP BY g, src, dst)",
        "dv AS (SELECT v.g, v.id, NOT EXISTS (SELECT 1 FROM p WHERE p.g = v.g AND p.src = v.id) AS dang FROM v)",
        "r0 AS (SELECT dv.g, dv.id, dv.dang, 1.0 / nn.n AS r FROM dv JOIN nn USING (g))",
    ]
    for k in range(1, iters + 1):
        a = f"r{k - 1}"
        parts.append(f"""r{k} AS (SELECT d.g, d.id, d.dang,
  {reset} / nn.n + {1 - reset} * (coalesce(c.c, 0.0) + coalesce(m.m, 0.0) / nn.n) AS r
  FROM {a} d JOIN nn USING (g)
  LEFT JOIN (SELECT p.g, p.dst AS id, sum(x.r * p.p) AS c FROM p JOIN {a} x ON x.g = p.g AND x.id = p.src GROUP BY 1, 2) c
    ON c.g = d.g AND c.id = d.id
  LEFT JOIN (SELECT g, sum(r) AS m FROM {a} WHERE dang GROUP BY g) m ON m.g = d.g)""")
    return ",\n".join(parts)


@query("build_graph", with_views(["edges_dense"], """
SELECT 'v' AS part, count(*) AS n, NULL::DOUBLE AS w FROM (SELECT src AS id FROM edges_dense UNION SELECT dst FROM edges_dense)
UNION ALL SELECT 'e', count(*), NULL FROM edges_dense
UNION ALL SELECT 'we', count(*), sum(w) FROM (SELECT src, dst, CAST(count(*) AS DOUBLE) AS w FROM edges_dense GROUP BY 1, 2)"""))
def q_build_graph(spark, d):
    e0 = Fixtures(spark, d).edges_dense()
    v, e = graph.build_graph(e0, "src", "dst")
    _, we = graph.build_graph(e0, "src", "dst", weighted=True)
    return (v.agg(F.lit("v").alias("part"), F.count(F.lit(1)).alias("n"), F.lit(None).cast("double").alias("w"))
            .unionByName(e.agg(F.lit("e").alias("part"), F.count(F.lit(1)).alias("n"), F.lit(None).cast("double").alias("w")))
            .unionByName(we.agg(F.lit("we").alias("part"), F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w"))))


@query("degrees", with_views(["edges_sparse"], """,
o AS (SELECT src AS id, count(*) AS out_degree FROM edges_sparse GROUP BY 1),
i AS (SELECT dst AS id, count(*) AS in_degree FROM edges_sparse GROUP BY 1)
SELECT coalesce(o.id, i.id) AS id, coalesce(out_degree, 0) AS out_degree, coalesce(in_degree, 0) AS in_degree
FROM o FULL JOIN i ON o.id = i.id"""))
def q_degrees(spark, d):
    return graph.degrees(Fixtures(spark, d).edges_sparse())


@query("transition_weights", with_views(["edges_sparse"], """
SELECT src, dst, round(count(*) / sum(count(*)) OVER (PARTITION BY src), 6) AS p FROM edges_sparse GROUP BY src, dst"""))
def q_transition(spark, d):
    t = graph.transition_weights(Fixtures(spark, d).edges_sparse())
    return t.select("src", "dst", r6(F.col("p")).alias("p"))


@query("pagerank", with_views(["edges_sparse"], ",\n" + pagerank_sql("edges_sparse", 10) + """
SELECT id, round(r, 6) AS pagerank FROM r10"""))
def q_pagerank(spark, d):
    v, e = graph.build_graph(Fixtures(spark, d).edges_sparse(), "src", "dst")
    pr = graph.pagerank(v, e, 0.15, 10)
    return pr.select("id", r6(F.col("pagerank")).alias("pagerank"))


@query("pagerank_dense_mass", with_views(["edges_dense"], ",\n" + pagerank_sql("edges_dense", 5) + """
SELECT round(sum(r), 6) AS mass, round(max(r) * 25, 6) AS max_unnormalized FROM r5"""))
def q_pagerank_dense(spark, d):
    v, e = graph.build_graph(Fixtures(spark, d).edges_dense(), "src", "dst")
    pr = graph.pagerank(v, e, 0.15, 5, normalized=False)
    m = graph.rank_mass(pr.withColumn("pagerank", F.col("pagerank") / 25.0))
    return m.select(r6(F.col("mass")).alias("mass")).join(
        pr.agg(r6(F.max("pagerank")).alias("max_unnormalized")))


@query("personalized_pagerank", with_views(["edges_sparse"], """,
p AS (SELECT src, dst, count(*) / sum(count(*)) OVER (PARTITION BY src) AS p FROM edges_sparse GROUP BY src, dst),
v AS (SELECT src AS id FROM edges_sparse UNION SELECT dst FROM edges_sparse),
dv AS (SELECT id FROM v WHERE id NOT IN (SELECT src FROM p)),
s AS (SELECT id AS source FROM v),
r0 AS (SELECT source, source AS id, 1.0 AS r FROM s),
""" + ",\n".join(f"""r{k} AS (
  SELECT coalesce(c.source, t.source) AS source, coalesce(c.id, t.id) AS id, 0.85 * coalesce(c.c, 0.0) + coalesce(t.t, 0.0) AS r
  FROM (SELECT x.source, p.dst AS id, sum(x.r * p.p) AS c FROM r{k - 1} x JOIN p ON p.src = x.id GROUP BY 1, 2) c
  FULL JOIN (SELECT s.source, s.source AS id, 0.15 + 0.85 * coalesce(m.m, 0.0) AS t FROM s
             LEFT JOIN (SELECT source, sum(r) AS m FROM r{k - 1} WHERE id IN (SELECT id FROM dv) GROUP BY 1) m USING (source)) t
  ON c.source = t.source AND c.id = t.id)""" for k in range(1, 7)) + """
SELECT source, id, round(r, 6) AS pagerank FROM r6"""))
def q_ppr(spark, d):
    fx = Fixtures(spark, d)
    v, e = graph.build_graph(fx.edges_sparse(), "src", "dst")
    pr = graph.personalized_pagerank(v, e, v, 0.15, 6)
    return pr.select("source", "id", r6(F.col("pagerank")).alias("pagerank"))


@query("top_sources", with_views(["edges_dense"], """,
p AS (SELECT src, dst, count(*) / sum(count(*)) OVER (PARTITION BY src) AS p FROM edges_dense GROUP BY src, dst),
s AS (SELECT DISTINCT src AS source FROM edges_dense),
r0 AS (SELECT source, source AS id, 1.0 AS r FROM s),
r1 AS (SELECT coalesce(c.source, t.source) AS source, coalesce(c.id, t.id) AS id, 0.85 * coalesce(c.c, 0.0) + coalesce(t.t, 0.0) AS r
  FROM (SELECT x.source, p.dst AS id, sum(x.r * p.p) AS c FROM r0 x JOIN p ON p.src = x.id GROUP BY 1, 2) c
  FULL JOIN (SELECT source, source AS id, 0.15 AS t FROM s) t ON c.source = t.source AND c.id = t.id),
rk AS (SELECT id, source, r, row_number() OVER (PARTITION BY id ORDER BY r DESC, source) AS rn FROM r1)
SELECT id, string_agg(source, ',' ORDER BY rn) AS top3 FROM rk WHERE rn <= 3 GROUP BY id"""))
def q_top_sources(spark, d):
    fx = Fixtures(spark, d)
    v, e = graph.build_graph(fx.edges_dense(), "src", "dst")
    ppr = graph.personalized_pagerank(v, e, v, 0.15, 1)
    t = graph.top_sources(ppr, 3)
    return t.select("id", F.array_join(F.transform("top", lambda s: s["source"]), ",").alias("top3"))


@query("init_graph", with_views(["edges_sparse"], """,
v AS (SELECT src AS id FROM edges_sparse UNION SELECT dst FROM edges_sparse)
SELECT 'nodes' AS what, count(*) AS n, round(1.0 / count(*), 6) AS score FROM v
UNION ALL SELECT 'links', count(*), NULL FROM edges_sparse
UNION ALL SELECT 'dangling', count(*), NULL FROM v WHERE id NOT IN (SELECT src FROM edges_sparse)
UNION ALL SELECT 'out_mean', round(avg(c), 6), NULL FROM (SELECT src, count(*) AS c FROM edges_sparse GROUP BY src)"""))
def q_init_graph(spark, d):
    adj = adjacency_from_lines(Fixtures(spark, d).adjacency())
    v, e = graph.init_graph(adj)
    sc = graph.init_scores(v)
    st = graph.node_stats(adj)
    _, mean = graph.outdegree_stats(adj)
    return (sc.agg(F.lit("nodes").alias("what"), F.count(F.lit(1)).cast("double").alias("n"), r6(F.max("score")).alias("score"))
            .unionByName(e.agg(F.lit("links").alias("what"), F.count(F.lit(1)).cast("double").alias("n"), F.lit(None).cast("double").alias("score")))
            .unionByName(st.select(F.lit("dangling").alias("what"), F.col("n_dangling").cast("double").alias("n"), F.lit(None).cast("double").alias("score")))
            .unionByName(mean.select(F.lit("out_mean").alias("what"), r6(F.col("mean_out_degree")).alias("n"), F.lit(None).cast("double").alias("score"))))


@query("outdegree_top", with_views(["edges_sparse"], """
SELECT src AS id, count(*) AS out_degree FROM edges_sparse GROUP BY src ORDER BY out_degree DESC, id LIMIT 10"""))
def q_outdeg_top(spark, d):
    adj = adjacency_from_lines(Fixtures(spark, d).adjacency())
    tops, _ = graph.outdegree_stats(adj)
    return tops


def _lpa_sql(iters, edges="edges_sparse"):
    parts = [f"u AS (SELECT src AS a, dst AS b FROM {edges} WHERE src <> dst UNION ALL SELECT dst, src FROM {edges} WHERE src <> dst)",
             f"l0 AS (SELECT id, id AS label FROM (SELECT src AS id FROM {edges} UNION SELECT dst FROM {edges}))"]
    for k in range(1, iters + 1):
        parts.append(f"""l{k} AS (SELECT l.id, coalesce(b.label, l.label) AS label FROM l{k - 1} l LEFT JOIN (
  SELECT id, label FROM (SELECT id, label, row_number() OVER (PARTITION BY id ORDER BY c DESC, label) AS rn FROM (
    SELECT u.a AS id, x.label, count(*) AS c FROM u JOIN l{k - 1} x ON x.id = u.b GROUP BY 1, 2)) WHERE rn = 1) b
  ON b.id = l.id)""")
    return ",\n".join(parts)


@query("label_propagation", with_views(["edges_sparse"], ",\n" + _lpa_sql(5) + """
SELECT id, label FROM l5"""))
def q_lpa(spark, d):
    v, e = graph.build_graph(Fixtures(spark, d).edges_sparse(), "src", "dst")
    return graph.label_propagation(v, e, 5)


@query("community_sizes", with_views(["edges_sparse"], ",\n" + _lpa_sql(5) + """
SELECT label, count(*) AS size FROM l5 GROUP BY label"""))
def q_communities(spark, d):
    v, e = graph.build_graph(Fixtures(spark, d).edges_sparse(), "src", "dst")
    return graph.community_sizes(graph.label_propagation(v, e, 5))


@query("previous_period_rank", with_views(["trips"], """,
tw AS (SELECT *, CAST(date_diff('day', DATE '2024-01-01', CAST(sched AS DATE)) // 7 AS BIGINT) AS period FROM trips),
pe AS (SELECT period AS g, CAST(origin AS VARCHAR) AS src, CAST(dest AS VARCHAR) AS dst FROM tw),
""" + pagerank_sql("pe", 5, grouped=True) + """
SELECT t.trip_id, round(r.r, 6) AS prev_rank FROM tw t LEFT JOIN r5 r ON r.g = t.period - 1 AND r.id = CAST(t.origin AS VARCHAR)"""))
def q_prev_rank(spark, d):
    from leadtime.plans.features_graph import previous_period_rank
    t = Fixtures(spark, d).trips().withColumn("period", F.floor(F.datediff(F.to_date("sched"), F.lit("2024-01-01").cast("date")) / 7).cast("long"))
    out = previous_period_rank(t, "origin", "dest", "period", iters=5)
    return out.select("trip_id", r6(F.col("prev_rank")).alias("prev_rank"))


@query("previous_period_degrees", with_views(["trips"], """,
tw AS (SELECT *, CAST(date_diff('day', DATE '2024-01-01', CAST(sched AS DATE)) // 7 AS BIGINT) AS period FROM trips),
e AS (SELECT DISTINCT period, origin, dest FROM tw),
v AS (SELECT period, origin AS id FROM e UNION SELECT period, dest FROM e),
o AS (SELECT period, origin AS id, count(*) AS n FROM e GROUP BY 1, 2),
i AS (SELECT period, dest AS id, count(*) AS n FROM e GROUP BY 1, 2)
SELECT t.trip_id, CASE WHEN v.id IS NULL THEN NULL ELSE coalesce(i.n, 0) END AS in_degree,
       CASE WHEN v.id IS NULL THEN NULL ELSE coalesce(o.n, 0) END AS out_degree
FROM tw t LEFT JOIN v ON v.period = t.period - 1 AND v.id = t.origin
LEFT JOIN o ON o.period = v.period AND o.id = v.id LEFT JOIN i ON i.period = v.period AND i.id = v.id"""))
def q_prev_degrees(spark, d):
    from leadtime.plans.features_graph import previous_period_rank
    t = Fixtures(spark, d).trips().withColumn("period", F.floor(F.datediff(F.to_date("sched"), F.lit("2024-01-01").cast("date")) / 7).cast("long"))
    return previous_period_rank(t, "origin", "dest", "period", iters=1, degrees=True).select("trip_id", "in_degree", "out_degree")


@query("rank_by_fold", with_views(["trips", "folds"], """,
fe AS (SELECT f.fold AS g, CAST(t.origin AS VARCHAR) AS src, CAST(t.dest AS VARCHAR) AS dst FROM trips t JOIN folds f ON t.sched >= f.lo AND t.sched < f.hi),
""" + pagerank_sql("fe", 5, grouped=True) + """
SELECT t.trip_id, round(a.r, 6) AS pr_0, round(b.r, 6) AS pr_1, round(c.r, 6) AS pr_2, round(dd.r, 6) AS pr_3 FROM trips t
LEFT JOIN r5 a ON a.g = 0 AND a.id = CAST(t.origin AS VARCHAR) LEFT JOIN r5 b ON b.g = 1 AND b.id = CAST(t.origin AS VARCHAR)
LEFT JOIN r5 c ON c.g = 2 AND c.id = CAST(t.origin AS VARCHAR) LEFT JOIN r5 dd ON dd.g = 3 AND dd.id = CAST(t.origin AS VARCHAR)"""))
def q_rank_by_fold(spark, d):
    from leadtime.plans.features_graph import rank_by_fold
    fx = Fixtures(spark, d)
    out = rank_by_fold(fx.trips(), fx.folds(), "origin", "dest", "sched", [0, 1, 2, 3], iters=5)
    return out.select("trip_id", *[r6(F.col(f"pr_{i}")).alias(f"pr_{i}") for i in range(4)])


@query("outdegree_sample", with_views(["edges_sparse"], """,
n AS (SELECT src AS id, count(*) AS out_degree FROM edges_sparse GROUP BY src)
SELECT * FROM n WHERE CAST('0x' || substr(md5('7:' || id), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE < 10 / (SELECT count(*) FROM n)"""))
def q_outdeg_sample(spark, d):
    """An n-point sample of the out-degree distribution (hash-chosen)."""
    from leadtime.operators.sampling import sample_n
    adj = adjacency_from_lines(Fixtures(spark, d).adjacency())
    deg = adj.select(F.col("node").alias("id"),
                     F.aggregate(F.map_values("nbrs"), F.lit(0).cast("long"), lambda a, x: a + x).alias("out_degree"))
    return sample_n(deg, 10, "id")


# ---------------------------------------------------------------------------
# A graph that grows with the tables: customers to suppliers

@query("pagerank_trade", with_views(["edges_trade"], ",\n" + pagerank_sql("edges_trade", 4) + """
SELECT id, round(r, 9) AS pagerank FROM r4"""))
def q_pagerank_trade(spark, d):
    v, e = graph.build_graph(Fixtures(spark, d).edges_trade(), "src", "dst")
    return graph.pagerank(v, e, 0.15, 4).select("id", F.round("pagerank", 9).alias("pagerank"))


@query("degrees_trade", with_views(["edges_trade"], """,
o AS (SELECT src AS id, count(*) AS out_degree FROM edges_trade GROUP BY 1),
i AS (SELECT dst AS id, count(*) AS in_degree FROM edges_trade GROUP BY 1)
SELECT coalesce(o.id, i.id) AS id, coalesce(out_degree, 0) AS out_degree, coalesce(in_degree, 0) AS in_degree
FROM o FULL JOIN i ON o.id = i.id"""))
def q_degrees_trade(spark, d):
    return graph.degrees(Fixtures(spark, d).edges_trade())


@query("label_propagation_trade", with_views(["edges_trade"], ",\n" + _lpa_sql(15, "edges_trade") + """
SELECT id, label FROM l15"""))
def q_lpa_trade(spark, d):
    """Fifteen rounds over every customer and supplier."""
    v, e = graph.build_graph(Fixtures(spark, d).edges_trade(), "src", "dst")
    return graph.label_propagation(v, e, 15)


def _push_sql(bound, rounds, reset=0.15):
    parts = ["e AS (SELECT src, dst FROM edges_trade UNION ALL SELECT dst, src FROM edges_trade)",
             "p AS (SELECT src, dst, count(*) / sum(count(*)) OVER (PARTITION BY src) AS p FROM e GROUP BY src, dst)",
             "q0 AS (SELECT 'c' || c_custkey AS source, 'c' || c_custkey AS id, 0.0::DOUBLE AS p, 1.0::DOUBLE AS r FROM customer WHERE c_custkey % 100 = 0)"]
    for k in range(1, rounds + 1):
        parts.append(f"""q{k} AS MATERIALIZED (SELECT source, id, sum(p) AS p, sum(r) AS r FROM (
  SELECT source, id, p + CASE WHEN r > {bound} THEN {reset} * r ELSE 0 END AS p, CASE WHEN r > {bound} THEN 0 ELSE r END AS r FROM q{k - 1}
  UNION ALL SELECT q.source, p.dst, 0, {1 - reset} * q.r * p.p FROM q{k - 1} q JOIN p ON p.src = q.id WHERE q.r > {bound}
  UNION ALL SELECT q.source, q.source, 0, {1 - reset} * q.r FROM q{k - 1} q WHERE q.r > {bound} AND q.id NOT IN (SELECT src FROM p)) GROUP BY 1, 2)""")
    return ",\n".join(parts)


def _push(spark, d):
    fx = Fixtures(spark, d)
    # both directions of a row at once: the rows are made once
    ends = F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))
    both = fx.edges_trade().select(F.explode(ends).alias("e")).select("e.*")
    keys = fx.table("customer").filter("c_custkey % 100 = 0").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("id"))
    return graph.push_pagerank(both, keys, bound=0.0007, rounds=10)


@query("push_pagerank_trade", with_views(["edges_trade"], ",\n" + _push_sql(0.0007, 10) + """
SELECT source, id, round(p, 9) AS pagerank, round(sum(r) OVER (PARTITION BY source), 6) AS rest FROM q10"""))
def q_push(spark, d):
    """Ranks of customers and suppliers around every hundredth customer
    (the stated sources), by forward push over the trade graph."""
    return _push(spark, d).select("source", "id", F.round("pagerank", 9).alias("pagerank"), r6(F.col("rest")).alias("rest"))


@query("top_sources_trade", with_views(["edges_trade"], ",\n" + _push_sql(0.0007, 10) + """,
k AS (SELECT id, source, row_number() OVER (PARTITION BY id ORDER BY round(p, 9) DESC, source) AS rn FROM q10 WHERE p > 0)
SELECT id, string_agg(source, ',' ORDER BY rn) AS top3 FROM k WHERE rn <= 3 GROUP BY id"""))
def q_top_sources_trade(spark, d):
    """The sources that rank each vertex highest, after ten rounds."""
    ranks = _push(spark, d).filter("pagerank > 0").withColumn("pagerank", F.round("pagerank", 9))
    return graph.top_sources(ranks, 3).select("id", F.array_join(F.transform("top", lambda s: s["source"]), ",").alias("top3"))

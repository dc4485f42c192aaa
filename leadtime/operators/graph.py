"""Graph operators (G1-G11) on vertex/edge DataFrames.

PageRank and label propagation are iterated joins + grouped sums.  All
ranks are keyed by a *group* column (period, fold, or personalised
source), so many independent graphs run in one plan.  Lineage is cut every
few iterations by writing Parquet into the session's shared checkpoint folder
(``spark.checkpoint.dir``) and reading it back.

Messages go along a *vertex cut*: the edges of a source are kept by source,
but a source with more than ``BLOCK_EDGES`` of them (a hub) is cut into blocks
by destination, and its value is mirrored to the blocks.  So no task holds a
hub's edges, and the edges of all others never move again.  Forward push
keeps edges as lists, a hub's cut into blocks (``_packed_edges``).
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_G = "__g"
_SEP = "\n"   # between the ids of a list
BLOCK_EDGES = 1 << 16   # edges of one source in one block, about
PART_EDGES = 1 << 21    # edges of one partition of label propagation, at most about
FEW_IDS = 1 << 12       # vertices up to which label propagation counts multi-edges first
PUSH_ROWS = 1 << 20     # rows of one task of forward push, about
SOURCE_ROWS = 1 << 23   # rows of one source that forward push keeps in one task, at most
FEW_ROWS = 1 << 14      # rows that are worth a task of forward push
MAX_LONG = (1 << 63) - 1


def _with_group(df: DataFrame, group: str | None) -> DataFrame:
    return df.withColumn(_G, F.col(group) if group else F.lit(0))


def build_graph(df: DataFrame, src: str, dst: str, weighted: bool = False,
                group: str | None = None) -> tuple[DataFrame, DataFrame]:
    """G1: vertices (id) and edges (src, dst[, weight]) from event rows.
    Multi-edges are kept unless ``weighted`` (then counted into ``weight``)."""
    g = [F.col(group)] if group else []
    e = df.select(*g, F.col(src).cast("string").alias("src"), F.col(dst).cast("string").alias("dst")).filter(
        F.col("src").isNotNull() & F.col("dst").isNotNull())
    if weighted:
        e = e.groupBy(*g, "src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    # both ends of a row at once: the rows are made once, not once per end
    v = e.select(*g, F.explode(F.array("src", "dst")).alias("id")).distinct()
    return v, e


def degrees(edges: DataFrame, group: str | None = None) -> DataFrame:
    """In- and out-degree per vertex (multi-edges counted), full outer."""
    g = [group] if group else []
    o = edges.groupBy(*g, F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("out_degree"))
    i = edges.groupBy(*g, F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("in_degree"))
    return o.join(i, [*g, "id"], "full").fillna(0, subset=["out_degree", "in_degree"])


def transition_weights(edges: DataFrame, group: str | None = None, weight: str | None = None) -> DataFrame:
    """Edge transition probability = weight / out-weight of its source
    (1/out-degree for unweighted multi-edges)."""
    g = [group] if group else []
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    e = edges.select(*g, "src", "dst", w.alias("__w")).groupBy(*g, "src", "dst").agg(F.sum("__w").alias("__w"))
    out = e.groupBy(*g, "src").agg(F.sum("__w").alias("__ow"))
    return e.join(out, [*g, "src"]).select(*g, "src", "dst", (F.col("__w") / F.col("__ow")).alias("p"))


def _ckpt(df: DataFrame, stages: list[str] | None = None) -> DataFrame:
    """Cut lineage: write the frame as Parquet under the shared checkpoint
    folder and read it back; the folder is added to ``stages``.
    (``Dataset.checkpoint`` was measured to slow down geometrically over a
    long iteration chain on this Spark version; a written table keeps every
    round at constant cost.)"""
    from leadtime.sources.io import stage_path, stage_to
    path = stage_path(df.sparkSession)
    if stages is not None:
        stages.append(path)
    return stage_to(df, path)


def _release(spark, stages: list[str]) -> None:
    from leadtime.sources.io import remove_path
    for path in stages:
        remove_path(spark, path)
    stages.clear()


class _VertexCut:
    """Edges (keys, src, dst, value) dealt out once and kept for many rounds.

    ``send`` joins them to one value per (keys, src).  Edges of ordinary
    sources are partitioned by source; a hub's by (source, block of
    destinations), and its row of the values is copied to each block.
    """

    def __init__(self, edges: DataFrame, keys: list[str], value: str, block_edges: int, n: int | None = None):
        self.keys, self.value, spark = keys, value, edges.sparkSession
        n = n or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.stages: list[str] = []
        counts = edges.groupBy(*keys, "src").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > block_edges)
        self.hubs = _ckpt(counts.select(*keys, "src", F.ceil(F.col("__n") / block_edges).cast("int").alias("__nb")), self.stages)
        self.has_hubs = bool(self.hubs.head(1))
        cols = [*keys, "src", "dst", value]
        light = edges.select(*cols)
        self.heavy = None
        if self.has_hubs:
            on = [*keys, "src"]
            self.heavy = (edges.select(*cols).join(self.hubs, on).withColumn("__b", F.pmod(F.xxhash64("dst"), F.col("__nb")).cast("int"))
                          .drop("__nb").repartition(n, *on, "__b").sortWithinPartitions(*on, "__b").persist())
            light = light.join(self.hubs.drop("__nb"), on, "left_anti")
        # the number is given so that a round's values are brought to the
        # edges' partitions and not the other way round
        self.light = light.repartition(n, *keys, "src").sortWithinPartitions(*keys, "src").persist()

    def send(self, values: DataFrame) -> DataFrame:
        """Edges with the columns of ``values`` (keys, src, ...) of their source."""
        on = [*self.keys, "src"]
        out = self.light.join(values, on)
        if self.has_hubs:
            mirrored = values.join(self.hubs, on).withColumn("__b", F.explode(F.sequence(F.lit(0), F.col("__nb") - 1))).drop("__nb")
            out = out.unionByName(self.heavy.join(mirrored, [*on, "__b"]).drop("__b"))
        return out

    def release(self) -> None:
        self.light.unpersist()
        if self.heavy is not None:
            self.heavy.unpersist()
        _release(self.hubs.sparkSession, self.stages)


def pagerank(vertices: DataFrame, edges: DataFrame, reset: float = 0.15, iters: int = 10,
             group: str | None = None, weight: str | None = None, normalized: bool = True,
             checkpoint_every: int = 5, block_edges: int = BLOCK_EDGES) -> DataFrame:
    """PageRank with dangling mass spread evenly; scores sum to 1 per
    group (``normalized=False`` scales by the vertex count, like the
    un-normalised library result).

        r'(v) = reset/N + (1-reset) * (sum_{u->v} r(u) p(u,v) + m/N)

    where m is the rank held by vertices without out-edges.  What every vertex
    gets alike, s = reset + (1-reset) m, is one number per group and round, and
    ranks are linear in it: with u_0 = 1 and u_j = (1-reset) P u_(j-1),

        N r_k = u_k + sum_{j<k} s_(k-j) u_j

    So the rounds only push u along the edges (one grouped sum, combined
    map-side); nothing per group is joined in between.  The s follow at the
    end from the sums of u_j over dangling vertices.  Edges go by vertex cut.
    The rounds run when the function is called; the returned frame reads the
    staged final ranks.  Output: (group?, id, pagerank).
    """
    V = _with_group(vertices, group).select(_G, F.col("id").cast("string").alias("id")).distinct()
    P = transition_weights(_with_group(edges, group), _G, weight).withColumn("src", F.col("src").cast("string"))
    spark, stages = vertices.sparkSession, []
    V = _ckpt(V, stages)
    P = _ckpt(P, stages)
    cut = _VertexCut(P, [_G], "p", block_edges)
    u = V.withColumn("u", F.lit(1.0))
    waves, held = [], []
    for j in range(1, iters + 1):
        sent = cut.send(u.withColumnRenamed("id", "src"))
        u = sent.groupBy(_G, F.col("dst").cast("string").alias("id")).agg(F.sum(F.lit(1.0 - reset) * F.col("u") * F.col("p")).alias("u")).persist()
        held.append((j, u))
        if j == iters or (checkpoint_every and j % checkpoint_every == 0):
            wave = reduce(lambda a, b: a.unionByName(b), [h.withColumn("j", F.lit(i)) for i, h in held])
            waves.append(_ckpt(wave, stages))
            for _, h in held:
                h.unpersist()
            held, u = [], waves[-1].filter(F.col("j") == j).drop("j")
    out = _combined_waves(V, P, waves, iters, reset, stages)
    # materialise the final ranks, then release what they were made of
    out = _ckpt(out)
    cut.release()
    _release(spark, stages)
    score = F.col("r") / F.col("__n") if normalized else F.col("r")
    cols = ([F.col(_G).alias(group)] if group else []) + [F.col("id"), score.alias("pagerank")]
    return out.select(*cols)


def _combined_waves(V: DataFrame, P: DataFrame, waves: list[DataFrame], iters: int, reset: float, stages: list[str]) -> DataFrame:
    """(group, id, r, __n): N times the ranks after ``iters`` rounds from the
    waves u_1.. (``pagerank``), and the group's number of vertices."""
    dangling = V.join(P.select(_G, F.col("src").alias("id")).distinct(), [_G, "id"], "left_anti")
    parts = [dangling.select(_G, F.lit(0).alias("j"), F.lit(1.0).alias("u"))]
    parts += [w.join(dangling, [_G, "id"]).select(_G, "j", "u") for w in waves]
    sums = reduce(lambda a, b: a.unionByName(b), parts).groupBy(_G, "j").agg(F.sum("u").alias("d"))
    d = sums.groupBy(_G).agg(F.map_from_entries(F.collect_list(F.struct("j", "d"))).alias("__d"))
    stats = V.groupBy(_G).agg(F.count(F.lit(1)).cast("double").alias("__n")).join(d, _G, "left")
    # s_1 .. s_k in turn, each from those before and the dangling sums d_j / N
    dj = F.transform(F.sequence(F.lit(0), F.lit(max(iters - 1, 0))), lambda j: F.coalesce(F.col("__d")[j], F.lit(0.0)) / F.col("__n"))
    stats = stats.withColumn("__dj", dj)
    keep = 1.0 - reset
    s = (f"aggregate(sequence(1, {iters}), cast(array() as array<double>), (s, i) -> concat(s, array({reset} + {keep} * (__dj[i - 1] + "
         f"aggregate(zip_with(s, reverse(slice(__dj, 1, i - 1)), (x, y) -> x * y), 0D, (t, x) -> t + x)))))")
    stats = _ckpt(stats.select(_G, "__n", (F.expr(s) if iters else F.expr("cast(array() as array<double>)")).alias("__s")), stages)
    if not iters:
        return V.join(stats, _G).select(_G, "id", F.lit(1.0).alias("r"), "__n")
    base = F.col("__s")[iters - 1]
    got = reduce(lambda a, b: a.unionByName(b), waves)
    share = F.when(F.col("j") == iters, F.lit(1.0)).otherwise(F.expr(f"get(__s, {iters} - j - 1)"))
    got = got.join(stats.select(_G, "__s"), _G).groupBy(_G, "id").agg(F.sum(share * F.col("u")).alias("__x"))
    return (V.join(got, [_G, "id"], "left").join(stats, _G)
            .select(_G, "id", (base + F.coalesce("__x", F.lit(0.0))).alias("r"), "__n"))


def rank_mass(ranks: DataFrame, group: str | None = None, score: str = "pagerank") -> DataFrame:
    """Total rank per group (should be 1 each iteration)."""
    g = [group] if group else []
    return ranks.groupBy(*g).agg(F.sum(score).alias("mass"))


def personalized_pagerank(vertices: DataFrame, edges: DataFrame, sources: DataFrame, reset: float = 0.15,
                          iters: int = 10, checkpoint_every: int = 2) -> DataFrame:
    """Personalised PageRank for many sources at once, keyed by
    (source, id): teleport and dangling mass go back to the source.

        r_s'(v) = reset [v=s] + (1-reset) (sum_{u->v} r_s(u) p(u,v) + m_s [v=s])

    Dangling vertices get one edge to a NULL destination, so a single
    grouped sum per round gives the contributions and each source's m_s.
    """
    P = transition_weights(edges)
    V = vertices.select(F.col("id").cast("string").alias("id")).distinct()
    outs = P.select(F.col("src").alias("id")).distinct().withColumn("__has_out", F.lit(True))
    dang = V.join(outs, "id", "left").filter(F.col("__has_out").isNull()).select(
        F.col("id").alias("src"), F.lit(None).cast("string").alias("dst"), F.lit(1.0).alias("p"))
    spark, stages = vertices.sparkSession, []
    P = _ckpt(P.unionByName(dang), stages)
    S = _ckpt(sources.select(F.col("id").cast("string").alias("source")).distinct(), stages)
    R = S.select("source", F.col("source").alias("id"), F.lit(1.0).alias("r"))
    for it in range(iters):
        C = (R.join(P.withColumnRenamed("src", "id"), "id")
             .groupBy("source", "dst").agg(F.sum(F.col("r") * F.col("p")).alias("__c")))
        tele = (S.join(C.filter(F.col("dst").isNull()).select("source", F.col("__c").alias("__m")), "source", "left")
                .select("source", F.col("source").alias("id"),
                        (F.lit(reset) + F.lit(1.0 - reset) * F.coalesce(F.col("__m"), F.lit(0.0))).alias("__t")))
        R = (C.filter(F.col("dst").isNotNull()).withColumnRenamed("dst", "id").join(tele, ["source", "id"], "full")
             .select("source", "id", (F.lit(1.0 - reset) * F.coalesce(F.col("__c"), F.lit(0.0))
                                      + F.coalesce(F.col("__t"), F.lit(0.0))).alias("r")))
        if checkpoint_every and (it + 1) % checkpoint_every == 0 and it + 1 < iters:
            R = _ckpt(R, stages)
    out = _ckpt(R).select("source", "id", F.col("r").alias("pagerank"))
    _release(spark, stages)
    return out


def push_pagerank(edges: DataFrame, sources: DataFrame, reset: float = 0.15, bound: float = 1e-4, rounds: int = 100,
                  block_edges: int = BLOCK_EDGES) -> DataFrame:
    """Personalised PageRank by forward push, for many sources at once.

    A source starts with residual 1 on itself.  In a round every (source,
    vertex) row whose residual is above ``bound`` keeps ``reset`` of it as
    rank and sends the rest along its edges (from vertices without edges back
    to the source); other rows wait.  A push settles at least reset x bound,
    so a source has at most 1 / (reset x bound) pushes and rows near that
    number times the degree of what was pushed, not one per vertex.  Rounds
    end when no residual is above the bound; once half of the sources have
    none, theirs are set aside and the next rounds leave them alone.

    The rows that wait are by far the most, and no round writes them: residuals
    are linear in what was pushed, so a round stages only the pushes
    (source, id, p pushed so far, r pushed now) and makes the residuals from
    them and the edges again.  It does so only for sources in which one can be
    above the bound: none is if the greatest that waited and all that a vertex
    can be sent now are not above it together.  Edges are kept and sent as
    lists (``_packed_edges``), read where the source is.

    Output (source, id, pagerank, residual, rest): ``rest`` is the source's
    unsent total, which is 1 less its ranks, and the exact rank lies in
    [pagerank, pagerank + rest].  The rows are made when the result is read,
    from the staged pushes and lists.  ``personalized_pagerank`` is the exact
    form.
    """
    from leadtime.sources.io import remove_path, stage_path, stage_to
    spark, stages, keep = edges.sparkSession, [], 1.0 - reset
    packs, ends = _packed_edges(edges, block_edges, stages)
    first = 1.0 if bound < 1.0 and rounds else 0.0
    path = stage_path(spark)
    pushed = stage_to(sources.select(F.col("id").cast("string").alias("source")).filter("source IS NOT NULL").distinct().select(
        "source", F.col("source").alias("id"), F.lit(first).alias("p"), F.lit(first).alias("r")), path)
    # (path, rows) of the sources that are done, and the greatest residuals that wait
    parts, waits, held = [], None, pushed.count()
    for _ in range(rounds - 1 if first else 0):
        at = _ckpt(pushed.join(ends, "id", "left"), stages)
        most = keep * F.col("r") * F.coalesce(F.col("top") / F.col("out"), F.lit(1.0))
        due = at.select("source", most.alias("most"), _n_rows().alias("rows"), F.lit(0.0).alias("wait"))
        if waits is not None:
            due = due.unionByName(waits)
        due = due.groupBy("source").agg(F.sum("most").alias("most"), F.sum("rows").alias("rows"), F.max("wait").alias("wait"))
        # a little below the bound: the sums may be rounded either way
        due = _ckpt(due.filter((F.col("most") > 0) & (F.col("wait") + F.col("most") > bound * (1 - 1e-9))).select("source", "rows"), stages)
        size = due.agg(F.sum("rows").alias("all"), F.max("rows").alias("most")).head()
        if size.all is None:
            break
        act = F.col("r") > bound
        found = _ckpt(_residuals(at.join(due.select("source"), "source", "left_semi"), packs, ["source"], keep, size)
                      .groupBy("source", act.alias("act"), F.when(act, F.col("id")).alias("id")).agg(F.max("r").alias("r")), stages)
        active = found.filter("act").select("source", "id", F.col("r").alias("p"), "r")
        waits = found.filter("NOT act").select("source", F.lit(0.0).alias("most"), F.lit(0).cast("long").alias("rows"), F.col("r").alias("wait"))
        n_active = active.count()
        if not n_active:
            break
        old, path, before = path, stage_path(spark), pushed
        if 2 * n_active <= held:  # so at most half of the sources have a push to come
            live = active.select("source").distinct()
            parts.append((old, pushed.join(live, "source", "left_anti")))
            before, held = pushed.join(live, "source", "left_semi"), n_active
        pushed = stage_to(before.withColumn("r", F.lit(0.0)).unionByName(active)
                          .groupBy("source", "id").agg(F.sum("p").alias("p"), F.sum("r").alias("r")), path)
        if not any(old == x for x, _ in parts):
            remove_path(spark, old)
    done = reduce(lambda a, b: a.unionByName(b), [*[x for _, x in parts], pushed])
    left = done.groupBy("source").agg((1.0 - reset * F.sum("p")).alias("rest"))
    at = _ckpt(done.drop("r").join(left, "source").join(ends, "id", "left"))
    size = at.groupBy("source").agg(F.sum(_n_rows()).alias("rows")).agg(F.sum("rows").alias("all"), F.max("rows").alias("most")).head()
    _release(spark, [*stages, *[x for x, _ in parts], path])
    rows = _residuals(at, packs, ["source", "rest"], keep, size)
    return rows.select("source", "id", (reset * F.col("p")).alias("pagerank"), F.greatest("r", F.lit(0.0)).alias("residual"), "rest")


def _packed_edges(edges: DataFrame, block_edges: int, stages: list[str]) -> tuple[DataFrame, DataFrame]:
    """Edges as lists (src, block, w, n, ids): the n vertices that w equal edges
    of src lead to, as one text (``_listed``), at most ``block_edges`` in a
    block; and what a source has (id, out edges, n different ones, blocks,
    top w).  A hub's edges are counted and cut by the task that has the source;
    its blocks are dealt out after.  The lists are staged for good, the others
    are added to ``stages``."""
    e = edges.select(F.col("src").cast("string").alias("src"), F.col("dst").cast("string").alias("dst")).filter("src IS NOT NULL")
    # moved once, by source: counts, numbers and lists are made where the rows are
    e = e.repartition("src").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("w"))
    at = Window.partitionBy("src").orderBy("w", "dst")
    e = e.withColumn("block", F.floor((F.row_number().over(at) - 1) / block_edges).cast("int"))
    packs = _ckpt(e.groupBy("src", "block", "w").agg(F.count(F.lit(1)).alias("n"), F.collect_list(_listed(F.col("dst"))).alias("ids"))
                  .withColumn("ids", F.array_join("ids", _SEP)))
    ends = packs.groupBy(F.col("src").alias("id")).agg(
        F.sum(F.col("w") * F.col("n")).alias("out"), F.sum("n").alias("n"), (F.max("block") + 1).alias("blocks"), F.max("w").alias("top"))
    return packs, _ckpt(ends, stages)


def _listed(c):
    """An id as it stands in a list: without separators, and never null."""
    return F.coalesce(F.replace(F.replace(c, F.lit("\\"), F.lit("\\a")), F.lit(_SEP), F.lit("\\b")), F.lit("\\c"))


def _unlisted(c):
    """The id back from ``_listed``."""
    plain = F.replace(F.replace(c, F.lit("\\b"), F.lit(_SEP)), F.lit("\\a"), F.lit("\\"))
    return F.when(~c.contains("\\"), c).when(c != "\\c", plain)


def _n_rows():
    """Rows that a push makes: one per edge and one of its own."""
    return F.coalesce(F.col("n"), F.lit(1)) + 1


def _residuals(at: DataFrame, packs: DataFrame, keys: list[str], keep: float, size) -> DataFrame:
    """(keys, id, p, r): what was pushed and the residual of every vertex that
    a source reached, from its pushes ``at`` (keys, id, p and the columns of
    the vertex's edges).  The lists move to where their source is, in parts of
    about ``PUSH_ROWS`` rows; where one source has more than fit a task, the
    rows move by (source, id)."""
    none = F.lit(0.0).alias("p")
    start = F.when(F.col("id") == F.col("source"), 1.0).otherwise(0.0)
    own = at.select(*keys, "p", (start - F.col("p")).alias("r"), _listed(F.col("id")).alias("ids"))
    home = at.filter("out IS NULL").select(*keys, none, (keep * F.col("p")).alias("r"), _listed(F.col("source")).alias("ids"))
    sent = at.filter("out IS NOT NULL AND p > 0").drop("n").withColumnRenamed("id", "src").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).join(packs, ["src", "block"])
    sent = sent.select(*keys, none, (keep * F.col("p") * F.col("w") / F.col("out")).alias("r"), "ids")
    rows = own.unionByName(home).unionByName(sent)
    total, most = size.all or 0, size.most or 0
    if most <= SOURCE_ROWS:
        n = min(int(at.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // FEW_ROWS)
        rows = rows.repartition(max(n, total // PUSH_ROWS) + 1, "source")
    rows = rows.select(*keys, "p", "r", F.explode(F.split("ids", _SEP)).alias("id")).withColumn("id", _unlisted(F.col("id")))
    return rows.groupBy(*keys, "id").agg(F.sum("p").alias("p"), F.sum("r").alias("r"))


def top_sources(ppr: DataFrame, k: int = 10) -> DataFrame:
    """Per vertex the k sources ranking it highest, as a sorted array of
    (source, score) and as a map."""
    from leadtime.operators.sets import top_k_per_group
    t = top_k_per_group(ppr, "id", "pagerank", k, "source")
    g = t.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("rank", "source", "pagerank"))).alias("__l"))
    arr = F.transform("__l", lambda s: F.struct(s["source"].alias("source"), s["pagerank"].alias("score")))
    return g.select("id", arr.alias("top"), F.map_from_entries(F.transform("__l", lambda s: F.struct(s["source"], s["pagerank"]))).alias("top_map"))


def init_graph(adj: DataFrame, node: str = "node", nbrs: str = "nbrs") -> tuple[DataFrame, DataFrame]:
    """From adjacency rows (node, map nbr -> count) to every node
    (including those only linked to) with score 1/N, and edges with
    repeated links repeated."""
    e = (adj.select(F.col(node).alias("src"), F.explode(nbrs).alias("dst", "n"))
         .select("src", "dst", F.explode(F.array_repeat(F.lit(1), F.col("n").cast("int"))).alias("__x")).drop("__x"))
    v = adj.select(F.col(node).alias("id")).union(e.select(F.col("dst").alias("id"))).distinct()
    return v, e


def init_scores(vertices: DataFrame) -> DataFrame:
    """Score 1/N for every vertex (N is one count, read as a scalar)."""
    n = vertices.count()
    return vertices.select("id", F.lit(1.0 / n if n else 0.0).alias("score"))


def node_stats(adj: DataFrame, node: str = "node", nbrs: str = "nbrs") -> DataFrame:
    """Number of nodes (including nodes only linked to) and of dangling
    nodes (no out-links)."""
    srcs = adj.select(F.col(node).alias("id"), (F.size(nbrs) > 0).alias("__has"))
    dsts = adj.select(F.explode(F.map_keys(nbrs)).alias("id"), F.lit(False).alias("__has"))
    allv = srcs.union(dsts).groupBy("id").agg(F.max("__has").alias("__has"))
    return allv.agg(F.count(F.lit(1)).alias("n_nodes"), F.count_if(~F.col("__has")).alias("n_dangling"))


def outdegree_stats(adj: DataFrame, node: str = "node", nbrs: str = "nbrs", top: int = 10) -> tuple[DataFrame, DataFrame]:
    """Out-degree (sum of link counts) per node: the ``top`` largest and
    the mean over non-dangling nodes.  (A sample of the degree column is
    ``sample_n`` in ``sampling``.)"""
    deg = adj.select(F.col(node).alias("id"),
                     F.aggregate(F.map_values(nbrs), F.lit(0).cast("long"), lambda a, x: a + x).alias("out_degree"))
    tops = deg.orderBy(F.desc("out_degree"), "id").limit(top)
    mean = deg.filter("out_degree > 0").agg(F.avg("out_degree").alias("mean_out_degree"),
                                            F.count(F.lit(1)).alias("n_non_dangling"))
    return tops, mean


def label_propagation(vertices: DataFrame, edges: DataFrame, iters: int = 15, checkpoint_every: int = 3,
                      block_edges: int = BLOCK_EDGES) -> DataFrame:
    """Label propagation.  Each round a vertex takes the most frequent
    label among its neighbours (both edge directions, multi-edges counted),
    smallest label on ties; vertices without neighbours keep theirs.

    Every round sends the labels along the edges, over a vertex cut, and
    counts them where the receiver is: one shuffle of at most one row per edge
    and direction.  Receivers that are hubs are counted by (vertex, label),
    combined map-side, so no task gathers a hub's neighbours.  The first round
    reads the weights of a vertex's own edges.

    All vertices move at once, so the labels come to swap between two states
    (the sides of a bipartite graph hand theirs to and fro for ever).  A round
    is made of the one before only: once every label is that of two rounds
    before, the rest of the rounds only alternate, and they end; so they do
    when no label changes.  Labels are staged in every round
    (``checkpoint_every`` is kept for callers).  Output (id, label)."""
    from leadtime.operators.windows import index_ids
    from leadtime.sources.io import remove_path, stage_path, stage_to
    spark, stages = vertices.sparkSession, []
    # vertices by number, in the order of their ids
    V = _ckpt(index_ids(vertices.select(F.col("id").cast("string").alias("id")).distinct(), "id", "v"), stages)
    E = edges.select(F.col("src").cast("string").alias("s"), F.col("dst").cast("string").alias("t")).filter("s <> t")
    n_ids, w = V.count(), F.lit(1)
    if n_ids <= FEW_IDS:  # few pairs: they are counted before their ends are numbered
        E, w = E.groupBy("s", "t").agg(F.count(F.lit(1)).alias("w")), F.col("w")
    # one row per id on the numbers' side: their parts are hash tables, and the edges are not sorted by text
    for end, no in (("s", "a"), ("t", "b")):
        E = E.join(V.select(F.col("id").alias(end), F.col("v").alias(no)).hint("shuffle_hash"), end).drop(end)
    E = E.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum(w).alias("w"))
    E = _ckpt(E, stages)
    U = E.select(F.col("a").alias("src"), F.col("b").alias("dst"), "w").unionByName(E.select(F.col("b").alias("src"), F.col("a").alias("dst"), "w"))
    size = E.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("w"), F.lit(0)).alias("w")).head()
    least = 2 * size.n // PART_EDGES + 1
    n = min(max(int(spark.conf.get("spark.sql.shuffle.partitions")), least), 8 * least)
    cut = _VertexCut(U, [], "w", block_edges, n)
    score, label_of = _label_order(n_ids, size.w)
    labels, l_path = V.select("v", F.col("v").alias("label"), F.lit(None).cast("long").alias("old")), None
    for it in range(iters):
        best = _label_winners(cut, labels, score, n) if it else _first_winners(cut, score)
        best = best.select("v", label_of(F.col("m")).alias("new"))
        spent, l_path = l_path, stage_path(spark)
        labels = stage_to(labels.select("v", F.col("label").alias("old"), F.col("old").alias("older")).join(best, "v", "left")
                          .select("v", F.coalesce("new", "old").alias("label"), "old", "older"), l_path)
        if spent:
            remove_path(spark, spent)
        moved = labels.agg(F.bool_or(F.col("label") != F.col("old")).alias("one"), F.bool_or(F.col("label") != F.col("older")).alias("two")).head()
        if not moved.one:
            break
        if it and not moved.two:
            if (iters - 1 - it) % 2:
                labels = labels.withColumn("label", F.col("old"))
            break
    names = V.select(F.col("v").alias("label"), F.col("id").alias("name"))
    out = _ckpt(labels.select("v", "label").join(V, "v").join(names, "label").select("id", F.col("name").alias("label")))
    if l_path:
        remove_path(spark, l_path)
    cut.release()
    _release(spark, stages)
    return out


def _label_order(n_labels: int, weight: int):
    """(score, label_of): greatest count, then smallest label, as one number,
    and the label back from it.  The number is a long where counts up to
    ``weight`` leave room for it, otherwise a decimal."""
    if (weight + 1) * n_labels <= MAX_LONG:
        base, kind = F.lit(n_labels).cast("long"), "long"
    else:
        base, kind = F.lit(Decimal(10 ** 19)), "decimal(18,0)"
    return (lambda n, label: n.cast(kind) * base + (base - 1 - label),
            lambda m: (base - 1 - m % base).cast("long"))


def _first_winners(cut: _VertexCut, score) -> DataFrame:
    """(v, m) of the first round, when a neighbour's label is its own number:
    edges go both ways, so a vertex has its neighbours in its own edges."""
    def won(rows):
        return rows.groupBy(F.col("src").alias("v")).agg(F.max(score(F.col("w"), F.col("dst"))).alias("m"))
    return won(cut.light).unionByName(won(cut.heavy)) if cut.has_hubs else won(cut.light)


def _label_winners(cut: _VertexCut, labels: DataFrame, score, n: int) -> DataFrame:
    """(v, m): the greatest score among the labels sent to each vertex."""
    sent = cut.send(labels.select(F.col("v").alias("src"), "label")).select(F.col("dst").alias("v"), "label", "w")

    def won(rows):
        counts = rows.groupBy("v", "label").agg(F.sum("w").alias("n"))
        return counts.groupBy("v").agg(F.max(score(F.col("n"), F.col("label"))).alias("m"))

    if not cut.has_hubs:
        return won(sent.repartition(n, "v"))
    hubs = cut.hubs.select(F.col("src").alias("v"))
    return won(sent.join(hubs, "v", "left_anti").repartition(n, "v")).unionByName(won(sent.join(hubs, "v", "left_semi")))


def community_sizes(labels: DataFrame) -> DataFrame:
    """Members per label."""
    return labels.groupBy("label").agg(F.count(F.lit(1)).alias("size"))

"""Graph loops over a vertex cut against brute force, with hubs."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from leadtime.operators import graph


def random_edges(seed, n=30, m=150, hub_share=3):
    rng = random.Random(seed)
    e = [(str(rng.randrange(n)), str(rng.randrange(n + 8)), float(rng.randint(1, 4))) for _ in range(m)]
    return e + [("hub", str(rng.randrange(n + 8)), 1.0) for _ in range(m // hub_share)] + [(str(rng.randrange(n)), "hub", 2.0) for _ in range(10)]


def brute_pagerank(vertices, edges, iters, reset=0.15):
    out = defaultdict(Counter)
    for a, b, w in edges:
        out[a][b] += w
    n = len(vertices)
    r = {v: 1 / n for v in vertices}
    for _ in range(iters):
        c = defaultdict(float)
        for a, to in out.items():
            for b, w in to.items():
                c[b] += r[a] * w / sum(to.values())
        m = sum(r[v] for v in vertices if v not in out)
        r = {v: reset / n + (1 - reset) * (c[v] + m / n) for v in vertices}
    return r


@pytest.mark.parametrize("iters,every", [(0, 5), (1, 5), (7, 3), (12, 5)])
@pytest.mark.parametrize("block", [4, 1 << 16])
def test_pagerank(spark, iters, every, block):
    rows, want = [], {}
    for g in ("x", "y"):
        e = random_edges(g)
        rows += [(g, *x) for x in e]
        vs = {v for a, b, _ in e for v in (a, b)}
        want.update({(g, v): p for v, p in brute_pagerank(vs, e, iters).items()})
    df = spark.createDataFrame(rows, "g string, src string, dst string, w double")
    v, e = graph.build_graph(df, "src", "dst", group="g")
    got = graph.pagerank(v, df, 0.15, iters, group="g", weight="w", checkpoint_every=every, block_edges=block)
    got = {(r.g, r.id): r.pagerank for r in got.collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_a_hub_is_dealt_out(spark):
    """One source with a third of the edges: no partition of the kept edges
    holds more than twice the median."""
    n = 30_000
    e = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit("hub")).otherwise((F.col("id") % 4999).cast("string")).alias("src"),
                              F.col("id").cast("string").alias("dst"), F.lit(1.0).alias("p"))
    cut = graph._VertexCut(e, [], "p", 200)
    assert cut.has_hubs
    for kept in (cut.heavy, cut.light):
        sizes = sorted(r["count"] for r in kept.groupBy(F.spark_partition_id()).count().collect())
        assert sizes[-1] <= 2 * sizes[len(sizes) // 2], sizes
    values = e.select("src").distinct().withColumn("v", F.lit(2))
    sent = cut.send(values)
    assert sent.count() == n and sent.select("dst").distinct().count() == n and sent.filter("v <> 2").count() == 0
    cut.release()


def brute_labels(vertices, edges, iters):
    near = defaultdict(Counter)
    for a, b, _ in edges:
        if a != b:
            near[a][b] += 1
            near[b][a] += 1
    label = {v: v for v in vertices}
    for _ in range(iters):
        new = {}
        for v in vertices:
            c = Counter()
            for u, w in near[v].items():
                c[label[u]] += w
            new[v] = min(c, key=lambda x: (-c[x], x)) if c else label[v]
        if new == label:
            break
        label = new
    return label


@pytest.mark.parametrize("block", [3, 1 << 16])
@pytest.mark.parametrize("iters", [1, 4, 15])
def test_label_propagation(spark, iters, block):
    e = random_edges(5, 60, 90)
    vs = {v for a, b, _ in e for v in (a, b)} | {"alone", "zz"}
    v = spark.createDataFrame([(x,) for x in vs], "id string")
    df = spark.createDataFrame(e, "src string, dst string, w double")
    got = {r.id: r.label for r in graph.label_propagation(v, df, iters, block_edges=block).collect()}
    assert got == brute_labels(vs, e, iters)


def test_label_propagation_stops_early(spark, monkeypatch):
    """Two triangles settle in a few rounds, whatever the limit."""
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "y"), ("y", "z"), ("z", "x")], "src string, dst string")
    sent, send = [], graph._VertexCut.send
    monkeypatch.setattr(graph._VertexCut, "send", lambda self, values: sent.append(1) or send(self, values))
    v, _ = graph.build_graph(e, "src", "dst")
    got = {r.id: r.label for r in graph.label_propagation(v, e, 1000).collect()}
    assert set(got.values()) == {"a", "x"} and len(sent) < 10


@pytest.mark.parametrize("iters", [40, 41])
def test_label_propagation_ends_when_labels_swap(spark, monkeypatch, iters):
    """Sides of a bipartite graph hand their labels to and fro for ever: the
    rounds end once every label is that of two rounds before."""
    rng = random.Random(3)
    e = [(f"c{rng.randrange(40)}", f"s{rng.randrange(9)}", 1.0) for _ in range(160)] + [("x", "y", 1.0), ("p", "q", 1.0), ("q", "r", 1.0), ("r", "p", 1.0)]
    vs = {v for a, b, _ in e for v in (a, b)}
    sent, send = [], graph._VertexCut.send
    monkeypatch.setattr(graph._VertexCut, "send", lambda self, values: sent.append(1) or send(self, values))
    df = spark.createDataFrame(e, "src string, dst string, w double")
    v, _ = graph.build_graph(df, "src", "dst")
    got = {r.id: r.label for r in graph.label_propagation(v, df, iters).collect()}
    assert got == brute_labels(vs, e, iters) and got != brute_labels(vs, e, iters + 1)
    assert len(sent) < 15


@pytest.mark.parametrize("name,value", [("MAX_LONG", 0), ("FEW_IDS", 0), ("PART_EDGES", 20)])
@pytest.mark.parametrize("block", [3, 1 << 16])
def test_label_propagation_forms(spark, monkeypatch, name, value, block):
    """Scores as decimals, ends numbered before multi-edges are counted, and
    more partitions than the session's: the same labels."""
    monkeypatch.setattr(graph, name, value)
    e = random_edges(6, 50, 80)
    e += e[:30] + [(b, a, w) for a, b, w in e[10:40]]
    vs = {v for a, b, _ in e for v in (a, b)}
    df = spark.createDataFrame([*e, ("1", None, 1.0), (None, "2", 1.0)], "src string, dst string, w double")
    v, _ = graph.build_graph(df, "src", "dst")
    got = {r.id: r.label for r in graph.label_propagation(v, df, 6, block_edges=block).collect()}
    assert got == brute_labels(vs, e, 6)


def brute_personal(edges, source, iters, reset=0.15):
    out = defaultdict(Counter)
    for a, b, _ in edges:
        out[a][b] += 1
    r = {source: 1.0}
    for _ in range(iters):
        new = defaultdict(float)
        for u, x in r.items():
            for b, w in out[u].items() if u in out else [(source, 1)]:
                new[b] += (1 - reset) * x * w / (sum(out[u].values()) if u in out else 1)
        new[source] += reset
        r = new
    return r


@pytest.mark.parametrize("block", [4, 1 << 16])
def test_push_is_within_its_bound(spark, block):
    e = random_edges(9)
    df = spark.createDataFrame(e, "src string, dst string, w double").drop("w")
    sources = spark.createDataFrame([("hub",), ("3",), ("35",), ("3",)], "id string")
    exact = {(s, v): p for s in ("hub", "3", "35") for v, p in brute_personal(e, s, 80).items()}
    got = {(r.source, r.id): r for r in graph.push_pagerank(df, sources, bound=1e-3, block_edges=block).collect()}
    rest = {s: r.rest for (s, _), r in got.items()}
    assert set(rest) == {"hub", "3", "35"} and all(r.residual <= 1e-3 for r in got.values())
    for k, x in exact.items():
        low = got[k].pagerank if k in got else 0.0
        assert low - 1e-5 <= x <= low + rest[k[0]] + 1e-5


def test_push_rows_follow_the_bound(spark):
    """A long chain: a source reaches as far as the bound lets it."""
    e = spark.range(5000).select(F.col("id").cast("string").alias("src"), (F.col("id") + 1).cast("string").alias("dst"))
    got = graph.push_pagerank(e, spark.createDataFrame([("0",)], "id string"), bound=1e-3)
    assert got.count() < 60


def brute_push(edges, source, bound, rounds, reset=0.15):
    """(ranks, residuals) of one source after forward push, row by row."""
    out = defaultdict(Counter)
    for a, b in edges:
        if a is not None:
            out[a][b] += 1
    p, r = defaultdict(float), {source: 1.0}
    for _ in range(rounds):
        act = {u: x for u, x in r.items() if x > bound}
        r = defaultdict(float, {u: 0.0 if u in act else x for u, x in r.items()})
        for u, x in act.items():
            p[u] += reset * x
            to = out[u] if u in out else {source: 1}
            for b, w in to.items():
                r[b] += (1 - reset) * x * w / sum(to.values())
    return p, r


@pytest.mark.parametrize("bound,rounds,name,value,block", [
    (0.004, 0, "PUSH_ROWS", 50, 1 << 16), (0.004, 1, "SOURCE_ROWS", 0, 4), (0.004, 2, "PUSH_ROWS", 50, 4),
    (0.004, 5, "PUSH_ROWS", 50, 1 << 16), (0.004, 5, "SOURCE_ROWS", 0, 4), (0.3, 20, "SOURCE_ROWS", 1 << 23, 4)])
def test_push_rounds(spark, monkeypatch, bound, rounds, name, value, block):
    """Every row after so many rounds, whether lists or rows move: with
    multi-edges, loops, dangling vertices, null ends and ids of any text."""
    monkeypatch.setattr(graph, name, value)
    rng = random.Random(11)
    ids = ["hub", "", "a\nb", "\\", "\\c", "\\a\\b", "a,b", " "] + [str(i) for i in range(30)]
    e = [(rng.choice(ids[:30]), rng.choice(ids)) for _ in range(150)] + [("hub", x) for x in ids] + [("hub", "1")] * 3
    e += [("a\nb", None), ("\\", None), (None, "1"), (None, None), ("", "")]
    names = ["hub", "a\nb", "\\", "33", "alone"]
    sources = spark.createDataFrame([(s,) for s in [*names, "hub", None]], "id string")
    rows = graph.push_pagerank(spark.createDataFrame(e, "src string, dst string"), sources, bound=bound, rounds=rounds, block_edges=block).collect()
    got = {(r.source, r.id): r for r in rows}
    assert len(got) == len(rows)
    want = {s: brute_push(e, s, bound, rounds) for s in names}
    assert set(got) == {(s, v) for s, (_, r) in want.items() for v in r}
    for (s, v), row in got.items():
        p, r = want[s]
        assert row.pagerank == pytest.approx(p.get(v, 0.0), abs=1e-12) and row.residual == pytest.approx(r[v], abs=1e-12)
        assert row.rest == pytest.approx(sum(r.values()), abs=1e-12)


def test_push_with_a_bound_of_one(spark):
    e = spark.createDataFrame([("a", "b")], "src string, dst string")
    got = graph.push_pagerank(e, spark.createDataFrame([("a",), ("x",)], "id string"), bound=1.0)
    assert sorted(map(tuple, got.collect())) == [("a", "a", 0.0, 1.0, 1.0), ("x", "x", 0.0, 1.0, 1.0)]


def test_push_rounds_write_no_rows_that_wait(spark, monkeypatch):
    """Two sources reach 2000 vertices each that wait from the second round
    on, while the rounds go on: what is written are the pushes and the lists."""
    from leadtime.sources import io
    e = [(s, m) for s in ("s0", "s1") for m in ("m0", "m1")] + [(m, s) for s in ("s0", "s1") for m in ("m0", "m1")]
    e += [(m, f"{m}_{i}") for m in ("m0", "m1") for i in range(1000)] + [("m0", "s0")] * 3000
    written, stage_to = [], io.stage_to
    monkeypatch.setattr(io, "stage_to", lambda df, path=None: [out := stage_to(df, path), written.append(out.count())][0])
    sources = spark.createDataFrame([("s0",), ("s1",)], "id string")
    got = graph.push_pagerank(spark.createDataFrame(e, "src string, dst string"), sources, bound=0.01, rounds=6)
    assert got.count() > 4000 and sum(written) < 400


def test_top_sources_of_a_push(spark):
    """The three sources that rank a vertex highest, of those with a rank."""
    rng = random.Random(5)
    e = [(f"c{rng.randrange(12)}", f"s{rng.randrange(5)}") for _ in range(70)]
    e += [(b, a) for a, b in e]
    names = [f"c{i}" for i in range(12)]
    ranks = graph.push_pagerank(spark.createDataFrame(e, "src string, dst string"), spark.createDataFrame([(s,) for s in names], "id string"), bound=0.01, rounds=5)
    got = {r.id: [t.source for t in r.top] for r in graph.top_sources(ranks.filter("pagerank > 0").withColumn("pagerank", F.round("pagerank", 9)), 3).collect()}
    want = defaultdict(list)
    for s in names:
        for v, x in brute_push(e, s, 0.01, 5)[0].items():
            want[v].append((-round(x, 9), s))
    assert got == {v: [s for _, s in sorted(xs)[:3]] for v, xs in want.items()}


def test_top_sources_write_no_rows_that_wait(spark, monkeypatch):
    """Sources with a common neighbourhood that waits: the best sources of the
    vertices that rank, without the others' rows being written."""
    from leadtime.sources import io
    e = [(s, "m") for s in ("s0", "s1", "s2", "s3")] + [("m", s) for s in ("s0", "s1", "s2", "s3")] * 300 + [("m", f"x{i}") for i in range(1500)]
    written, stage_to = [], io.stage_to
    monkeypatch.setattr(io, "stage_to", lambda df, path=None: [out := stage_to(df, path), written.append(out.count())][0])
    names = ["s0", "s1", "s2", "s3"]
    ranks = graph.push_pagerank(spark.createDataFrame(e, "src string, dst string"), spark.createDataFrame([(s,) for s in names], "id string"), bound=0.01, rounds=4)
    got = {r.id: sorted(t.source for t in r.top) for r in graph.top_sources(ranks.filter("pagerank > 0"), 4).collect()}
    assert got == {v: names for v in ["m", *names]}
    assert ranks.count() == 4 * 1505 and sum(written) < 500

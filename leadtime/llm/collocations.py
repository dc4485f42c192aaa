"""Phrase collocations on a weighted de Bruijn graph.

Nodes are phrases of n - 1 words, an edge is a phrase of n words from its
first n - 1 words to its last n - 1, weighted by its occurrences.  Only edges
are counted.  A node's count is the flow out of it plus the pieces that end
in it, and the same rule gives the counts of shorter phrases.  Paths of nodes
with one way in and one way out carry one weight; they are compacted by
pointer doubling into maximal phrases, whose inner nodes need no scoring:
each lies in an edge of the same count.

Map tasks reduce slices of text to sorted distinct edges and send them as
compressed blocks, one per bucket of nodes.  A bucket's task adds them up,
derives the flows and keeps what reaches the least count.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadtime.llm.common import LOWER, UPPER, mix64, remove, scratch_path, staged
from leadtime.operators.windows import occurrence

MAX_WORDS, MIN_COUNT, TOP = 3, 10, 2000
INSIDE_SHARE = 50            # per cent of a phrase's count that a longer one must reach to replace it
GROUP_BYTES = 8 << 20        # text reduced at once by a map task (one text at least)
BUCKET_BYTES = 8 << 20       # text whose edges meet in one bucket, about
HOT_NODE = 1 << 16           # a node with more successors in one slice is dealt out by edge
UND = "und"

_TABLE = bytes.maketrans(UPPER.encode() + b"\t.,;:!?\x0b\x0c\r", LOWER.encode() + b" " + b"\n" * 9)
_SPACE, _BREAK = 32, 10


def _binary(data: np.ndarray, lens: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(lens) + 1, np.int64)
    np.cumsum(lens, out=offsets[1:])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lens), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _parts(a: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Data and lengths of a large binary array."""
    offsets = np.frombuffer(a.buffers()[1], np.int64)[a.offset:a.offset + len(a) + 1]
    data = a.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data else np.empty(0, np.uint8)
    return data, np.diff(offsets)


def split_words(text: bytes) -> tuple[pa.Array, np.ndarray]:
    """Words of a slice (lower-cased) and the number of each one's piece."""
    b = np.frombuffer(text.translate(_TABLE), np.uint8)
    inside = np.zeros(len(b) + 2, bool)
    inside[1:-1] = (b != _SPACE) & (b != _BREAK)
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2], edge[1::2]
    piece = np.cumsum(b == _BREAK)[starts] if len(starts) else np.empty(0, np.int64)
    return _binary(b[inside[1:-1]], ends - starts), piece


class Slice:
    """Distinct phrases of up to ``n`` words of a slice of text.

    ``codes[k]`` numbers the distinct runs of k words; a run that its piece
    ends too early is filled up with word 0.  Code c of length k is run
    ``keys[k][c] // width`` of length k - 1 followed by word
    ``keys[k][c] % width``, so a run's flow is the sum over its codes.
    """

    def __init__(self, text: bytes, n: int):
        words, piece = split_words(text)
        found = words.dictionary_encode()
        order = pc.array_sort_indices(found.dictionary)
        rank = np.empty(len(order), np.int64)
        rank[order.to_numpy()] = np.arange(1, len(order) + 1)
        self.vocab = pa.concat_arrays([pa.array([b""], pa.large_binary()), found.dictionary.take(order)])
        self.width = len(self.vocab)
        ids = rank[found.indices.to_numpy()] if len(words) else np.empty(0, np.int64)
        self.keys, code = [None, np.arange(self.width)], ids
        for k in range(2, n + 1):
            nxt = np.zeros(len(ids), np.int64)
            if len(ids) >= k:
                nxt[:-(k - 1)] = np.where(piece[k - 1:] == piece[:-(k - 1)], ids[k - 1:], 0)
            if k < n:
                keys, code = np.unique(code * self.width + nxt, return_inverse=True)
            else:
                keys, self.count = np.unique(code * self.width + nxt, return_counts=True)
            self.keys.append(keys)
        self.hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in self.vocab.to_pylist()], np.uint64)

    def words(self, k: int, codes: np.ndarray) -> list[np.ndarray]:
        """The k words of runs of length k."""
        out = []
        for j in range(k, 1, -1):
            out.append(self.keys[j][codes] % self.width)
            codes = self.keys[j][codes] // self.width
        return [codes, *out[::-1]]

    def phrases(self, words: list[np.ndarray]) -> pa.Array:
        cols = [self.vocab.take(pa.array(w)) for w in words]
        return pc.binary_join_element_wise(*cols, pa.scalar(b" ", pa.large_binary())) if len(cols) > 1 else cols[0]

    def hash(self, words: list[np.ndarray]) -> np.ndarray:
        h = np.full(len(words[0]), len(words), np.uint64)
        for w in words:
            h = mix64(h * np.uint64(31) + self.hashes[w])
        return h

    def flow(self, k: int, counts: np.ndarray) -> np.ndarray:
        """Counts of the runs of k - 1 words from those of k: the flow out of
        each, and the pieces that end in it (word 0)."""
        return np.bincount(self.keys[k] // self.width, counts, len(self.keys[k - 1])).astype(np.int64)


def _pack(*arrays) -> bytes:
    """Arrays of numbers or strings as one compressed block."""
    parts = []
    for a in arrays:
        for x in (_parts(a) if isinstance(a, pa.Array) else (a,)):
            raw = (x if x.dtype == np.uint8 else x.astype(np.uint32)).tobytes()
            parts += [len(raw).to_bytes(8, "little"), raw]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def _unpack(block: bytes, kinds: str) -> list:
    """``kinds``: s for strings, n for numbers."""
    raw, at, out = zstandard.ZstdDecompressor().decompress(block), 0, []

    def take(dtype):
        nonlocal at
        size = int.from_bytes(raw[at:at + 8], "little")
        a = np.frombuffer(raw, dtype, size // np.dtype(dtype).itemsize, at + 8)
        at += 8 + size
        return a

    for kind in kinds:
        if kind == "s":
            data = take(np.uint8)
            out.append(_binary(data, take(np.uint32)))
        else:
            out.append(take(np.uint32).astype(np.int64))
    return out


def _dealt(bucket: np.ndarray):
    """(bucket, places) in bucket order, places ascending."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, cuts) if len(order) else []:
        yield int(bucket[part[0]]), part


def slice_blocks(text: bytes, n: int, buckets: int, hot: int = HOT_NODE):
    """(level, bucket, block): the edges of a slice (level n) by bucket of
    their node, and the flows of runs of up to n - 2 words (level k).

    A node with more than ``hot`` successors is dealt out by edge; a count of
    zero then marks it in its own bucket and in those its edges go to, where
    its counts are partial.
    """
    s = Slice(text, n)
    if s.width == 1:
        return
    counts = s.count
    node, nxt = s.keys[n] // s.width, s.keys[n] % s.width
    words = s.words(n - 1, np.arange(len(s.keys[n - 1])))
    whole = words[-1] > 0
    home = (s.hash(words) % np.uint64(buckets)).astype(np.int64)
    here = home[node]
    spread = (np.bincount(node, minlength=len(home)) > hot) & whole
    edges = whole[node]
    if spread.any():
        far = spread[node] & edges
        h = mix64(s.hash([w[node[far]] for w in words]) + s.hashes[nxt[far]])
        here[far] = (h % np.uint64(buckets)).astype(np.int64)
        marks = np.unique(np.concatenate([node[far] * buckets + here[far],
                                          np.flatnonzero(spread) * buckets + home[spread]]))
        node, nxt = np.concatenate([node[edges], marks // buckets]), np.concatenate([nxt[edges], np.zeros(len(marks), np.int64)])
        here, value = np.concatenate([here[edges], marks % buckets]), np.concatenate([counts[edges], np.zeros(len(marks), np.int64)])
        order = np.argsort(node, kind="stable")
        node, nxt, here, value = node[order], nxt[order], here[order], value[order]
    else:
        node, nxt, here, value = node[edges], nxt[edges], here[edges], counts[edges]
    for bucket, at in _dealt(here):
        nodes, runs = np.unique(node[at], return_counts=True)
        yield n, bucket, _pack(s.phrases([w[nodes] for w in words]), runs, s.vocab.take(pa.array(nxt[at])), value[at])
    for k in range(n - 1, 1, -1):
        counts = s.flow(k + 1, counts)
        runs = s.flow(k, counts)
        words = s.words(k - 1, np.arange(len(runs)))
        at = np.flatnonzero((words[-1] > 0) & (runs > 0))
        words = [w[at] for w in words]
        for bucket, part in _dealt((s.hash(words) % np.uint64(buckets)).astype(np.int64)):
            yield k - 1, bucket, _pack(s.phrases([w[part] for w in words]), runs[at][part])


def _codes(a: pa.Array) -> tuple[np.ndarray, pa.Array]:
    d = a.dictionary_encode()
    return d.indices.to_numpy().astype(np.int64), d.dictionary


def merge_edges(blocks: list[bytes], n: int, least: int) -> list[tuple[int, pa.Array, np.ndarray]]:
    """(words, phrases, counts) of a bucket's nodes and edges of at least
    ``least`` occurrences; those of marked nodes whatever their count."""
    parts = [_unpack(b, "snsn") for b in blocks]
    of, nodes = _codes(pa.concat_arrays([p[0] for p in parts]))
    node = np.repeat(of, np.concatenate([p[1] for p in parts]))
    word, words = _codes(pa.concat_arrays([p[2] for p in parts]))
    value = np.concatenate([p[3] for p in parts])
    marked = np.zeros(len(nodes), bool)
    marked[node[value == 0]] = True
    keys, at = np.unique(node * len(words) + word, return_inverse=True)
    edge = np.bincount(at, value, len(keys)).astype(np.int64)
    node, word = keys // len(words), keys % len(words)
    flow = np.bincount(node, edge, len(nodes)).astype(np.int64)
    real = np.array([w != b"" for w in words.to_pylist()], bool)[word]
    keep = np.flatnonzero(real & ((edge >= least) | marked[node]))
    solid = np.flatnonzero((flow >= least) | marked)
    phrases = pc.binary_join_element_wise(nodes.take(pa.array(node[keep])), words.take(pa.array(word[keep])),
                                          pa.scalar(b" ", pa.large_binary()))
    out = [(n, phrases, edge[keep]), (n - 1, nodes.take(pa.array(solid)), flow[solid])]
    return out + [_total(flow)] if n == 2 else out


def _total(flow: np.ndarray) -> tuple[int, pa.Array, np.ndarray]:
    return 0, pa.array([b""], pa.large_binary()), flow.sum(keepdims=True)


def merge_flows(blocks: list[bytes], k: int, least: int) -> list[tuple[int, pa.Array, np.ndarray]]:
    """(k, phrases, counts) of at least ``least``; for single words also
    (0, "", all occurrences)."""
    parts = [_unpack(b, "sn") for b in blocks]
    of, phrases = _codes(pa.concat_arrays([p[0] for p in parts]))
    total = np.bincount(of, np.concatenate([p[1] for p in parts]), len(phrases)).astype(np.int64)
    at = np.flatnonzero(total >= least)
    out = [(k, phrases.take(pa.array(at)), total[at])]
    return out + [_total(total)] if k == 1 else out


def phrase_counts(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, text: str = "text",
                  lang: str = "lang", group_bytes: int = GROUP_BYTES, bucket_bytes: int = BUCKET_BYTES,
                  hot_node: int = HOT_NODE) -> DataFrame:
    """``lang, words, phrase, f``: every phrase of 1 to ``max_words`` words
    (two at least) that occurs ``min_count`` times or more in its language,
    and one row with 0 words and the number of all word occurrences.

    Counts are over whole texts of all rows.  A NULL text is empty, a NULL
    language ``und``; repeated rows count each time; extra columns are not
    read; an empty table, or one without a word, gives an empty result.  A
    task holds one slice of ``group_bytes`` (or one longer text) or one bucket.
    """
    if max_words < 2:
        raise ValueError("max_words must be 2 or more")
    src = docs.select(F.coalesce(F.col(lang), F.lit(UND)).alias("lang"), F.col(text).alias("t")).filter("t IS NOT NULL")
    size = src.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    buckets = max(1, math.ceil(size / bucket_bytes))

    def reduce_slices(batches):
        held: dict[str, list] = {}
        sizes: dict[str, int] = {}

        def flush(langs):
            for one in langs:
                sizes.pop(one)
                rows = [(one, k, b, block) for k, b, block in slice_blocks(b"\n".join(held.pop(one)), max_words, buckets, hot_node)]
                if rows:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int32(), pa.int64(), pa.binary()))],
                                          ["lang", "level", "bucket", "block"])

        for batch in batches:
            for one, t in zip(batch.column(0), batch.column(1)):
                one, t = one.as_py(), t.as_buffer().to_pybytes()
                held.setdefault(one, []).append(t)
                sizes[one] = sizes.get(one, 0) + len(t)
                if sizes[one] >= group_bytes:
                    yield from flush([one])
                elif sum(sizes.values()) >= 2 * group_bytes:
                    yield from flush(list(sizes))
        yield from flush(list(sizes))

    def add_up(batches):
        key, blocks = None, []

        def merged():
            one, level, _ = key
            for k, phrases, counts in (merge_edges(blocks, level, min_count) if level == max_words
                                       else merge_flows(blocks, level, min_count)):
                if len(counts):
                    yield pa.record_batch([pa.array([one] * len(counts), pa.string()), pa.array([k] * len(counts), pa.int32()),
                                           phrases.cast(pa.large_string()).cast(pa.string()), pa.array(counts, pa.int64())],
                                          ["lang", "words", "phrase", "f"])

        for batch in batches:
            *cols, data = (batch.column(i).to_pylist() for i in range(4))
            for *now, block in zip(*cols, data):
                if now != key and blocks:
                    yield from merged()
                    blocks = []
                key = now
                blocks.append(block)
        if blocks:
            yield from merged()

    blocks = src.mapInArrow(reduce_slices, "lang string, level int, bucket long, block binary")
    dealt = blocks.repartition("lang", "level", "bucket").sortWithinPartitions("lang", "level", "bucket")
    part = dealt.mapInArrow(add_up, "lang string, words int, phrase string, f long")
    # one row per phrase already, but for marked nodes and the totals
    return part.groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f")).filter(f"words = 0 OR f >= {int(min_count)}")


def _without_last():
    return F.expr("substring_index(phrase, ' ', words - 1)")


def _without_first():
    return F.expr("substring_index(phrase, ' ', 1 - words)")


def compact_paths(counts: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """``lang, phrase, words, weight, inner``: the maximal unary paths of the
    graph of ``phrase_counts``, spelled out, and the nodes inside them.

    A node is inside when one edge brings all of its flow and one edge takes
    all of it; then both weigh as much as the node.  Edges are linked over
    such nodes and ranked by pointer doubling, in a logarithmic number of
    rounds.  Pieces begin outside of inner nodes, so there are no cycles.
    Edges without an inner node are paths of their own.  A path is at most as
    long as the longest piece.
    """
    spark = counts.sparkSession
    nodes = counts.filter(F.col("words") == max_words - 1).select("lang", F.col("phrase").alias("node"), F.col("f").alias("flow"))
    edges = counts.filter(F.col("words") == max_words).select("lang", F.col("phrase").alias("edge"), F.col("f").alias("weight"),
                                                              _without_last().alias("a"), _without_first().alias("b"))
    into = edges.select("lang", F.col("b").alias("node"), F.col("edge").alias("before"), F.col("weight").alias("w1"))
    out_of = edges.select("lang", F.col("a").alias("node"), F.col("edge").alias("after"), F.col("weight").alias("w2"))
    links = staged(nodes.join(into, ["lang", "node"]).filter("w1 = flow").join(out_of, ["lang", "node"]).filter("w2 = flow")
                   .select("lang", "node", "before", "after"), "links")
    # head: the first edge reached going back so far, at: steps to it
    back = edges.select("lang", "edge").join(links.select("lang", F.col("after").alias("edge"), F.col("before").alias("head")),
                                             ["lang", "edge"], "left")
    path = scratch_path(spark, "paths")
    cur = staged(back.select("lang", "edge", F.coalesce("head", "edge").alias("head"),
                             F.col("head").isNotNull().cast("long").alias("at")), "paths", path)
    while True:
        old, path = path, scratch_path(spark, "paths")
        hop = cur.filter("at > 0").select("lang", F.col("edge").alias("head"), F.col("head").alias("further"), F.col("at").alias("more"))
        cur = staged(cur.join(hop, ["lang", "head"], "left")
                     .select("lang", "edge", F.coalesce("further", "head").alias("head"), (F.col("at") + F.coalesce("more", F.lit(0))).alias("at"),
                             F.col("more").isNotNull().alias("moved")), "paths", path)
        remove(spark, old)
        if not cur.filter("moved").head(1):
            break
    steps = cur.select("lang", "edge", "head", "at").join(edges, ["lang", "edge"])
    lists = steps.groupBy("lang", "head").agg(F.sort_array(F.collect_list(F.struct("at", "a", F.substring_index("edge", " ", -1).alias("last")))).alias("s"),
                                              F.first("weight").alias("weight"))
    inner = F.transform(F.slice("s", 2, F.greatest(F.size("s") - 1, F.lit(0))), lambda x: x["a"])
    return lists.select("lang", F.concat_ws(" ", "head", F.expr("transform(slice(s, 2, size(s)), x -> x.last)")).alias("phrase"),
                        (F.size("s") + (max_words - 1)).alias("words"), "weight", inner.alias("inner"))


def score_cuts(counts: DataFrame, phrases: DataFrame) -> DataFrame:
    """``phrases`` (lang, words, phrase, f) with ``l, r, score`` of the cut
    with the lowest score, the first such cut.  Scores are
    floor(1000000 f f / (l r)), in DECIMAL, so exact for counts below 10^13."""
    cut = phrases.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut"))
    cut = cut.select("lang", "words", "phrase", "f", "cut", F.expr("substring_index(phrase, ' ', cut)").alias("first"),
                     F.expr("substring_index(phrase, ' ', cut - words)").alias("rest"))
    known = counts.filter("words > 0").select("lang", F.col("phrase").alias("p"), F.col("f").alias("n"))
    cut = cut.join(known.select("lang", F.col("p").alias("first"), F.col("n").alias("l")), ["lang", "first"])
    cut = cut.join(known.select("lang", F.col("p").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    score = F.expr("(1000000BD * cast(f as decimal(13,0)) * cast(f as decimal(13,0))) div (cast(l as decimal(13,0)) * cast(r as decimal(13,0)))")
    best = (cut.withColumn("score", score).groupBy("lang", "words", "phrase", "f")
            .agg(F.min(F.struct("score", "cut", "l", "r")).alias("c")))
    return best.select("lang", "words", "phrase", "f", "c.l", "c.r", "c.score")


def first_per_lang(df: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of each language by score and count descending
    and phrase ascending, with ``rank``.  A language's rows are cut to ``top``
    in many parts, and what is left is numbered by ranges of the order, so a
    language never meets in one task."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["down_score", "down_f", "phrase"]
    df = df.withColumns({"down_score": -F.col("score"), "down_f": -F.col("f"), "part": F.pmod(F.xxhash64("phrase"), F.lit(parts))})
    df = df.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = occurrence(df.drop("rank", "part"), ["lang"], order, "rank").withColumn("rank", F.col("rank").cast("long"))
    return ranked.filter(F.col("rank") <= top).drop("down_score", "down_f")


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, top: int = TOP,
                 inside_share: int = INSIDE_SHARE, **sizes) -> DataFrame:
    """Per language the ``top`` phrases of 2 to ``max_words`` words:
    ``lang, rank, phrase, a, l, r, n, score``.

    Candidates occur ``min_count`` times or more (a); l and r are the counts
    of the parts of the lowest-scoring cut, n is the language's number of
    words.  A candidate inside a longer one with ``inside_share`` per cent of
    its count or more is dropped: inner nodes of compacted paths at once, the
    others by comparison.  It is enough to look one word further, as counts
    only fall with length.  Other cases as ``phrase_counts`` states.
    """
    counts = staged(phrase_counts(docs, max_words, min_count, **sizes), "phrases")
    found = counts.filter("words > 1")
    inner = compact_paths(counts, max_words).select("lang", F.explode("inner").alias("phrase"))
    left = found.join(inner, ["lang", "phrase"], "left_anti")
    longer = found.filter("words > 2")
    around = (longer.select("lang", _without_last().alias("phrase"), "f")
              .unionByName(longer.select("lang", _without_first().alias("phrase"), "f"))
              .groupBy("lang", "phrase").agg(F.max("f").alias("over")))
    left = (left.join(around, ["lang", "phrase"], "left")
            .filter(F.coalesce(100 * F.col("over") < inside_share * F.col("f"), F.lit(True))).drop("over"))
    ranked = first_per_lang(score_cuts(counts, left), top)
    total = counts.filter("words = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(total, "lang").select("lang", "rank", "phrase", F.col("f").alias("a"), "l", "r", "n", "score")


def sql(max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, top: int = TOP, inside_share: int = INSIDE_SHARE) -> str:
    """DuckDB SQL for ``collocations`` over ``documents``: every phrase of
    every length is counted on its own."""
    return rf"""
WITH d AS (SELECT coalesce(lang, '{UND}') AS lang, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM d),
w AS (SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
g AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
k AS (SELECT lang, w, i, unnest(range(1, {max_words + 1})) AS k FROM g),
f AS (SELECT lang, k, w[i:i + k - 1] AS g, count(*) AS f FROM k WHERE i + k - 1 <= len(w) GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND f >= {min_count}),
x AS (SELECT s.lang, s.g, max(b.f) AS over FROM c s JOIN c b ON b.lang = s.lang AND b.k > s.k
      AND contains(' ' || array_to_string(b.g, ' ') || ' ', ' ' || array_to_string(s.g, ' ') || ' ') GROUP BY ALL),
u AS (SELECT c.lang, c.k, c.g, c.f, unnest(range(1, c.k)) AS cut FROM c),
s AS (SELECT u.lang, u.g, u.f, cut, l.f AS l, r.f AS r, (1000000::HUGEINT * u.f * u.f) // (l.f::HUGEINT * r.f) AS score
      FROM u JOIN f l ON l.lang = u.lang AND l.g = u.g[1:cut] JOIN f r ON r.lang = u.lang AND r.g = u.g[cut + 1:]),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
o AS (SELECT b.lang, array_to_string(b.g, ' ') AS phrase, b.f, l, r, score FROM b LEFT JOIN x ON x.lang = b.lang AND x.g = b.g
      WHERE over IS NULL OR 100 * over < {inside_share} * b.f)
SELECT o.lang, row_number() OVER (PARTITION BY o.lang ORDER BY score DESC, f DESC, phrase) AS rank, phrase, f AS a, l, r, n,
       score::BIGINT AS score
FROM o JOIN n ON n.lang = o.lang QUALIFY rank <= {top}
"""

"""Prefix trie of conversations as a z-fast trie.

A conversation is a string whose letters are turns.  The trie is compacted:
a node spells a whole edge of turns, from its parent's depth (exclusive) to
its own.  Its handle is the prefix whose length is the two-fattest number in
that span (the one divisible by the greatest power of two), and a table maps
the hash of each handle to its node.  Where a conversation leaves the trie is
found by fat binary search: the two-fattest length of what is still possible
is probed, a hit jumps to the node's depth, a miss halves the rest.

Conversations are inserted in batches.  A batch is one conversation of each
place where some leave the trie and each turn that follows there; splits of
one edge by many conversations are made together.  Whoever shares a longer
prefix with one of the batch is looked up again below it.  The one inserted
is picked by hash, so the number of batches grows with the logarithm of the
number of conversations.  Sums over subtrees take a logarithmic number of
rounds as well; at the end edges are expanded into one row per depth.

Prefixes are compared by 128-bit hashes.  Texts are read once; after that a
turn is 16 bytes of digest and a number.  Equal conversations are one string.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadtime.llm.common import remove, scratch_path, staged

SHARED_TURNS = 9      # the rebuilt prefix has crc32(id) modulo this many turns
BLOCK = 5             # and comes from the conversation with the block's first id
STEPS = 3             # probes of the fat binary search in one job
CHUNK_IDS = 4096      # ids that are joined to one text before a node's texts meet

ROOT = hashlib.blake2b(b"", digest_size=16).digest()


def turn_digests(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """``c, turn, digest, bytes``: a turn's 128-bit digest of role and text
    (NULL: empty) and the text's UTF-8 bytes.  Rows without an id go."""
    r, t = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in (role, text))
    mark = F.concat(F.length(r).cast("string"), F.lit(":"), r, t)
    digest = F.substring(F.unhex(F.sha2(mark.cast("binary"), 256)), 1, 16)
    return (conversations.filter(F.col(conv).isNotNull())
            .select(F.col(conv).cast("long").alias("c"), F.col(turn).alias("turn"), digest.alias("digest"),
                    F.octet_length(t).cast("long").alias("bytes")))


def sequences(turns: DataFrame) -> DataFrame:
    """``c, s``: a conversation's turns in order as (digest, bytes).  Turns
    without a number come first; equal numbers are ordered by the digest."""
    s = F.sort_array(F.collect_list(F.struct("turn", "digest", "bytes")))
    return turns.groupBy("c").agg(F.transform(s, lambda x: F.struct(x["digest"].alias("digest"), x["bytes"].alias("bytes"))).alias("s"))


def rebuilt(convs: DataFrame) -> DataFrame:
    """Conversations that start with the first turns of their block's first
    one (crc32 of the id, modulo 9, gives how many) and go on with their own."""
    h = F.pmod(F.crc32(F.col("c").cast("string").cast("binary")), F.lit(SHARED_TURNS)).cast("int")
    first = convs.filter(F.col("c") % BLOCK == 0).select(F.col("c").alias("base"),
                                                         F.slice("s", 1, SHARED_TURNS - 1).alias("prefix"))
    own = convs.select("c", "s", h.alias("h"), (F.col("c") - F.col("c") % BLOCK).alias("base")).join(first, "base", "left")
    none = F.filter("s", lambda x: F.lit(False))
    return own.select("c", F.concat(F.coalesce(F.slice("prefix", 1, F.col("h")), none),
                                    F.expr("slice(s, h + 1, size(s))")).alias("s"))


def _prefixes(convs: DataFrame) -> DataFrame:
    """``c, n, last, p, b``: the hashes of all prefixes of 1 to n turns and
    their bytes summed; last is the whole conversation's hash."""
    def run(batches):
        for batch in batches:
            ids, ns, last, ps, bs = [], [], [], [], []
            for c, s in zip(batch.column(0).to_pylist(), batch.column(1)):
                at, total, p, b = ROOT, 0, [], []
                for x in s.as_py():
                    at = hashlib.blake2b(at + x["digest"], digest_size=16).digest()
                    total += x["bytes"]
                    p.append(at)
                    b.append(total)
                ids.append(c)
                ns.append(len(p))
                last.append(at)
                ps.append(p)
                bs.append(b)
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(last, pa.binary()),
                                   pa.array(ps, pa.list_(pa.binary())), pa.array(bs, pa.list_(pa.int64()))],
                                  ["c", "n", "last", "p", "b"])

    return convs.mapInArrow(run, "c long, n long, last binary, p array<binary>, b array<long>")


def two_fattest(a: str, b: str) -> Column:
    """The number in (a, b], a < b, divisible by the greatest power of two."""
    return F.expr(f"{b} & shiftleft(-1L, length(bin({a} ^ {b})) - 1)")


def _at(array: str, place: str) -> Column:
    """1-based element of an array; NULL where the place is outside."""
    return F.expr(f"get({array}, cast({place} - 1 as int))")


def _nodes(edges: DataFrame) -> DataFrame:
    """Node rows from ``lo, hi, up, p, b`` (the edge's prefix hashes and
    bytes, parent hash ``up``): with key (hash after the first turn), id (hash
    of the whole) and the handle's hash."""
    return (edges.withColumn("key", F.col("p")[0]).withColumn("id", F.element_at("p", -1))
            .withColumn("f", two_fattest("lo", "hi")).withColumn("handle", _at("p", "f - lo")).drop("f"))


def _locate(strings: DataFrame, nodes: DataFrame) -> tuple[DataFrame, str]:
    """Sets each string's ``a`` to the depth of the deepest node that spells a
    prefix of it, by fat binary search from its present ``a``; and the path
    that holds the result."""
    zmap = nodes.select("handle", "id", F.col("lo").alias("z_lo"), F.col("hi").alias("z_hi"))
    cur, path = strings.withColumn("z", F.col("n")), None
    while True:
        for _ in range(STEPS):
            probe = F.when(F.col("a") < F.col("z"), _at("p", "probe")).otherwise(F.unhex(F.lpad(F.hex("s"), 16, "0")))
            cur = (cur.withColumn("probe", F.when(F.col("a") < F.col("z"), two_fattest("a", "z")))
                   .withColumn("handle", probe).join(zmap, "handle", "left"))
            hit = F.col("id").isNotNull()
            spelt = hit & F.coalesce((F.col("z_hi") <= F.col("n")) & (_at("p", "z_hi") == F.col("id")), F.lit(False))
            searching = F.col("a") < F.col("z")
            # a hit on a node that isn't spelt out ends the search at its parent
            depth = F.when(searching & spelt, F.col("z_hi")).when(searching & hit, F.col("z_lo")).otherwise(F.col("a"))
            rest = (F.when(searching & spelt, F.greatest("z", "z_hi")).when(searching & hit, F.col("z_lo"))
                    .when(searching, F.col("probe") - 1).otherwise(F.col("z")))
            cur = (cur.withColumns({"__a": depth, "__z": rest}).drop("a", "z", "probe", "handle", "id", "z_lo", "z_hi")
                   .withColumnsRenamed({"__a": "a", "__z": "z"}))
        old, path = path, scratch_path(strings.sparkSession, "search")
        cur = staged(cur, "search", path)
        if old:
            remove(strings.sparkSession, old)
        if not cur.filter("a < z").head(1):
            return cur.drop("z"), path


def _exits(found: DataFrame, nodes: DataFrame) -> DataFrame:
    """Adds ``key`` (of the edge that the string enters, if any) and ``stop``,
    the depth up to which it follows the trie."""
    edge = nodes.select("key", F.col("lo").alias("e_lo"), F.col("hi").alias("e_hi"), F.col("p").alias("e_p"))
    step = F.coalesce(F.when(F.col("a") < F.col("n"), _at("p", "a + 1")), F.unhex(F.lpad(F.hex("s"), 16, "0")))
    x = found.withColumn("key", step).join(edge, "key", "left").withColumn("e_p", F.expr("coalesce(e_p, slice(p, 1, 0))"))
    # equal prefixes stay equal, so the common length is the number of equal places
    same = F.expr("size(filter(arrays_zip(slice(p, cast(a + 1 as int), size(e_p)), e_p), x -> x['0'] = x['e_p']))")
    stop = F.when(F.col("e_hi").isNull(), F.col("a")).otherwise(F.col("a") + same)
    inside = F.col("e_hi").isNotNull() & (stop < F.col("e_hi"))
    return (x.withColumn("stop", stop.cast("long")).withColumn("cut", F.when(inside, F.col("stop")))
            .drop("e_lo", "e_hi", "e_p"))


def _split(nodes: DataFrame, cuts: DataFrame) -> DataFrame:
    """Nodes with their edges cut at the depths in ``cuts`` (key, cut)."""
    at = cuts.groupBy("key").agg(F.sort_array(F.collect_set("cut")).alias("at"))
    x = nodes.join(at, "key", "left")
    whole = x.filter("at IS NULL").select(nodes.columns)
    bounds = F.concat(F.array("lo"), F.col("at"), F.array("hi"))
    x = x.filter("at IS NOT NULL").withColumn("bounds", bounds)
    x = x.select("lo", "up", "p", "b", "base", "bounds", F.explode(F.sequence(F.lit(0), F.size("at"))).alias("i"))
    x = x.select(F.col("lo").alias("from"), "up", "p", "b", "base", F.col("bounds")[F.col("i")].alias("lo"),
                 F.col("bounds")[F.col("i") + 1].alias("hi"))
    def cut(c):
        return F.expr(f"slice({c}, cast(lo - from + 1 as int), cast(hi - lo as int))")
    x = x.select("lo", "hi", F.expr("if(lo = from, up, p[cast(lo - from - 1 as int)])").alias("up"), cut("p").alias("p"),
                 cut("b").alias("b"), F.expr("if(lo = from, base, b[cast(lo - from - 1 as int)])").alias("base"))
    return whole.unionByName(_nodes(x).select(nodes.columns))


def build(strings: DataFrame) -> DataFrame:
    """The compacted trie of distinct strings (s, n, p, b): a row per node
    below the root with ``id, up`` (hashes of its prefix and its parent's),
    ``lo, hi`` (parent's and own depth), ``p, b`` (prefix hashes and bytes on
    its edge), ``base`` (bytes of the parent's prefix), ``key`` and ``handle``.
    """
    spark = strings.sparkSession
    cols = ["id", "up", "lo", "hi", "p", "b", "base", "key", "handle"]
    left = strings.filter("n > 0").select("s", "n", "p", "b", F.lit(0).cast("long").alias("a"))
    nodes, n_path, l_path = None, None, None
    while True:
        old = [p for p in (n_path, l_path) if p]
        if nodes is None:
            out = left.withColumn("key", F.col("p")[0]).withColumn("stop", F.lit(0).cast("long"))
        else:
            found, path = _locate(left, nodes)
            exits = staged(_exits(found, nodes), "exits", x_path := scratch_path(spark, "exits"))
            old += [path, x_path]
            out = exits.filter("stop < n")
        # one string of each exit and next turn, by hash: the rest follow it
        out = out.withColumn("next", _at("p", "stop + 1"))
        leader = out.groupBy("next").agg(F.min(F.struct(F.xxhash64("s"), F.col("s").alias("s"))).alias("m")).select(
            F.col("next").alias("n2"), F.col("m.s").alias("leader"))
        out = out.join(leader, F.col("next") == F.col("n2")).drop("n2")
        tail = "cast(stop + 1 as int), cast(n - stop as int)"
        leaf = out.filter("s = leader").select(
            F.col("stop").alias("lo"), F.col("n").alias("hi"), F.coalesce(_at("p", "stop"), F.lit(ROOT)).alias("up"),
            F.expr(f"slice(p, {tail})").alias("p"), F.expr(f"slice(b, {tail})").alias("b"),
            F.coalesce(_at("b", "stop"), F.lit(0).cast("long")).alias("base"))
        grown = _nodes(leaf).select(cols)
        if nodes is not None:
            cuts = exits.filter("cut IS NOT NULL").select("key", "cut").distinct()
            grown = grown.unionByName(_split(nodes, cuts))
        n_path, l_path = scratch_path(spark, "trie"), scratch_path(spark, "strings")
        nodes = staged(grown, "trie", n_path)
        left = staged(out.filter("s != leader").select("s", "n", "p", "b", F.col("stop").alias("a")), "strings", l_path)
        for path in old:
            remove(spark, path)
        if not left.head(1):
            remove(spark, l_path)
            return nodes


def _subtrees(nodes: DataFrame) -> DataFrame:
    """``id`` with the sums of ``own_n, own_bytes, edge, leaf`` and the
    minimum of ``own_c`` over the node's subtree, and ``children``.

    Pointers double: after round k a node holds the sums of the descendants
    fewer than 2^k steps below, and points 2^k steps up.
    """
    spark = nodes.sparkSession
    sums, least = ["n", "bytes", "edge", "leaves"], "c"
    children = nodes.filter("up IS NOT NULL").groupBy("up").agg(F.count(F.lit(1)).alias("children"))
    cur = nodes.join(children.withColumnRenamed("up", "id"), "id", "left").fillna(0, ["children"])
    cur = cur.select("id", "up", F.col("own_n").alias("n"), F.col("own_bytes").alias("bytes"), "edge",
                     F.expr("if(children = 0, 1L, 0L)").alias("leaves"), F.col("own_c").alias("c"), "children")
    path = scratch_path(spark, "sums")
    cur = staged(cur, "sums", path)
    while cur.filter("up IS NOT NULL").head(1):
        old, path = path, scratch_path(spark, "sums")
        below = (cur.filter("up IS NOT NULL").groupBy("up")
                 .agg(*[F.sum(x).alias(f"d_{x}") for x in sums], F.min(least).alias("d_c")).withColumnRenamed("up", "id"))
        further = cur.filter("up IS NOT NULL").select(F.col("id").alias("up"), F.col("up").alias("up2"))
        # rows that point nowhere look for themselves, in vain, so they don't meet
        cur = cur.join(below, "id", "left").withColumn("up", F.coalesce("up", "id")).join(further, "up", "left")
        cur = staged(cur.select("id", F.col("up2").alias("up"), *[(F.col(x) + F.coalesce(f"d_{x}", F.lit(0))).alias(x) for x in sums],
                                F.least("c", "d_c").alias("c"), "children"), "sums", path)
        remove(spark, old)
    return cur


def _joined_ids(members: DataFrame) -> DataFrame:
    """``id, sha``: SHA-256 of a node's member ids, ascending and joined by
    commas.  Ids are sorted over all tasks and joined to texts of some
    thousand ids; only these meet, in order, and are hashed one at a time."""
    def rows(done, *types):
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*done), types)], (["id", "first", "text"] if len(types) == 3 else ["id", "sha"]))

    def chunks(batches):
        key, ids = None, []
        for batch in batches:
            done = []
            for node, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if ids and (node != key or len(ids) == CHUNK_IDS):
                    done.append((key, ids[0], ",".join(map(str, ids))))
                    ids = []
                key = node
                ids.append(c)
            if done:
                yield rows(done, pa.binary(), pa.int64(), pa.string())
        if ids:
            yield rows([(key, ids[0], ",".join(map(str, ids)))], pa.binary(), pa.int64(), pa.string())

    def digests(batches):
        key, sha = None, None
        for batch in batches:
            done = []
            for node, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if node != key:
                    if key is not None:
                        done.append((key, sha.hexdigest()))
                    key, sha = node, hashlib.sha256(text.encode())
                else:
                    sha.update(b"," + text.encode())
            if done:
                yield rows(done, pa.binary(), pa.string())
        if key is not None:
            yield rows([(key, sha.hexdigest())], pa.binary(), pa.string())

    parts = members.repartitionByRange("id", "c").sortWithinPartitions("id", "c").mapInArrow(chunks, "id binary, first long, text string")
    return parts.repartition("id").sortWithinPartitions("id", "first").mapInArrow(digests, "id binary, sha string")


def trie_rows(convs: DataFrame) -> DataFrame:
    """Per trie node ``conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256`` (see ``prefix_trie``), from
    conversations ``c, s`` (s: array of (digest, bytes))."""
    spark = convs.sparkSession
    full = staged(_prefixes(convs), "prefixes")
    # equal conversations are one string, named by its smallest id; equal
    # hashes mean equal arrays, so the arrays need no place in the aggregate
    names = full.groupBy("last").agg(F.min("c").alias("s"), F.count(F.lit(1)).alias("copies"))
    strings = staged(full.join(names.select("s", "copies"), F.col("c") == F.col("s")).drop("c"), "strings")
    nodes = build(strings)
    ends = strings.select(F.col("last").alias("id"), F.col("s").alias("own_c"), F.col("copies").alias("own_n"),
                          (F.col("copies") * F.coalesce(F.try_element_at("b", F.lit(-1)), F.lit(0))).alias("own_bytes"))
    root = strings.limit(1).select(F.lit(ROOT).alias("id"), F.lit(None).cast("binary").alias("up"), F.lit(0).cast("long").alias("edge"))
    ids = root.unionByName(nodes.select("id", "up", (F.element_at("b", -1) - F.col("base")).alias("edge")))
    sums = _subtrees(ids.join(ends, "id", "left").fillna(0, ["own_n", "own_bytes"]))
    sha = _joined_ids(full.select(F.col("last").alias("id"), "c"))
    done = staged(sums.drop("up").join(sha, "id", "left"), "done")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    x = nodes.join(done, "id").join(done.select(F.col("id").alias("up"), F.col("c").alias("up_c")), "up")
    x = x.select("*", F.posexplode("b").alias("i", "to"))
    start = F.expr("if(i = 0, base, b[i - 1])")
    low = F.col("i") == F.size("b") - 1
    whole = F.element_at("b", -1)
    rows = x.select(
        F.col("c").alias("conv_id"), (F.col("lo") + F.col("i") + 1).cast("long").alias("depth"),
        F.when(F.col("i") == 0, F.col("up_c")).otherwise(F.col("c")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(low, F.col("children")).otherwise(F.lit(1)).cast("long").alias("n_children"), F.col("leaves").alias("n_leaves"),
        # bytes once per member, less bytes once per node, from this depth on
        (F.col("bytes") - F.col("n") * start - (F.col("edge") - (start - F.col("base")))).alias("saved_tokens"),
        F.when(low, F.coalesce("sha", nothing)).otherwise(nothing).alias("ends_sha256"))
    top = done.filter(F.col("id") == F.lit(ROOT)).select(
        F.col("c").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.col("children").cast("long").alias("n_children"), F.col("leaves").alias("n_leaves"),
        (F.col("bytes") - F.col("edge")).alias("saved_tokens"), F.coalesce("sha", nothing).alias("ends_sha256"))
    return rows.unionByName(top)


def prefix_trie(conversations: DataFrame, rebuild: bool = True, conv: str = "conv_id", turn: str = "turn",
                role: str = "role", text: str = "text") -> DataFrame:
    """One row per distinct prefix of the conversations' turns (role, text):
    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``
    (members), ``n_children``, ``n_leaves`` (childless nodes in the subtree),
    ``saved_tokens`` (bytes that members share: over the subtree, (members -
    1) x bytes of the node's text), ``ends_sha256`` (of the ids that end here).

    With ``rebuild`` conversations first take over the beginning of their
    block's first one (``rebuilt``).  Turns without a number come first, equal
    numbers are ordered by a digest of role and text, and repeated rows are
    turns of their own.  NULL roles and texts are empty, rows without a
    conversation id are no conversation, extra columns are not read, and an
    empty table gives an empty result (no root).  One conversation's digests,
    about 40 bytes a turn, are held in one row, its texts never.
    """
    convs = sequences(turn_digests(conversations, conv, turn, role, text))
    return trie_rows(rebuilt(convs) if rebuild else convs)


# CRC-32: the reflected polynomial (fixed value).
_POLY = 0xEDB88320


def sql() -> str:
    """DuckDB SQL for ``prefix_trie`` over ``conversations``: every prefix of
    every conversation on its own.  CRC-32 is worked out bit by bit."""
    crc = (f"xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(c::VARCHAR, ''), "
           f"lambda x: [ascii(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), "
           f"lambda a, x: CASE WHEN xor(a, x) & 1 = 1 THEN xor(xor(a, x) >> 1, {_POLY}) ELSE xor(a, x) >> 1 END), 4294967295)")
    return f"""
WITH t AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
m AS (SELECT *, substr(sha256(length(role)::VARCHAR || ':' || role || text), 1, 32) AS d FROM t),
s AS (SELECT c, list({{'d': d, 'b': strlen(text)}} ORDER BY turn NULLS FIRST, d) AS s FROM m GROUP BY c),
h AS (SELECT c, s, {crc} % {SHARED_TURNS} AS h FROM s),
r AS (SELECT h.c, list_concat(coalesce(f.s[1:h.h], []), h.s[h.h + 1:]) AS s FROM h LEFT JOIN s f ON f.c = h.c - h.c % {BLOCK}),
p AS (SELECT c, len(s) AS n, s, unnest(range(0, len(s) + 1)) AS d FROM r),
k AS (SELECT c, n, d, array_to_string(list_transform(s[1:d], lambda x: x.d), '') AS k,
      array_to_string(list_transform(s[1:d - 1], lambda x: x.d), '') AS up, s[d].b AS b FROM p),
g AS (SELECT d, k, min(up) AS up, min(c) AS c, count(*) AS n, max(b) AS b,
      string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d) AS ends FROM k GROUP BY d, k),
ch AS (SELECT d, up, count(*) AS n FROM g WHERE d > 0 GROUP BY d, up),
v AS (SELECT g.*, coalesce(ch.n, 0) AS children FROM g LEFT JOIN ch ON ch.d = g.d + 1 AND ch.up = g.k),
u AS (SELECT a.d, a.k, sum((x.n - 1) * coalesce(x.b, 0)) AS saved, count(*) FILTER (x.children = 0) AS leaves
      FROM v a JOIN v x ON x.d >= a.d AND starts_with(x.k, a.k) GROUP BY a.d, a.k)
SELECT v.c AS conv_id, v.d::BIGINT AS depth, CASE WHEN v.d > 0 THEN w.c END AS parent_conv_id, v.n AS n_convs,
       v.children::BIGINT AS n_children, u.leaves AS n_leaves, u.saved::BIGINT AS saved_tokens,
       sha256(coalesce(v.ends, '')) AS ends_sha256
FROM v JOIN u ON u.d = v.d AND u.k = v.k LEFT JOIN g w ON w.d = v.d - 1 AND w.k = v.up
"""

"""Substring dedup with fixed-block anchors.

A window of 13 words always contains a whole block of 7 words that starts at
a multiple of 7, whatever the alignment.  So the non-overlapping 7-word
blocks of every document are indexed and every rolling 7-word window probes
them; only windows of 13 words around a hit can repeat, and these are
compared exactly in a second exchange.  Overlapping windows that repeat add
up to the maximal exact repeats.

Documents are kept in *bundles* of a few million characters, stored once in
a table bucketed by bundle, so no later step shuffles text.  What is
shuffled is, per bundle and hash bucket, one packed row: the bundle's sorted
distinct hashes (a passage in a third of all documents costs one entry a
bundle), answered by one bit per entry.
"""

from __future__ import annotations

import hashlib
import uuid
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadtime.llm.common import mix64, rolling_hash, staged

WINDOW = 13
BLOCK = (WINDOW + 1) // 2
BUNDLE_CHARS = 4 << 20
FILE_CHARS = 1 << 26     # characters in one file of the bundles, about
BUCKET_ENTRIES = 2 << 20


def _distinct(h: np.ndarray, g: np.ndarray):
    """Distinct pairs of two 64-bit hashes in ascending order, and the index
    of each pair among them."""
    order = np.lexsort((g, h))
    a, b = h[order], g[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    where = np.empty(len(a), np.int64)
    where[order] = np.cumsum(new) - 1
    return a[new], b[new], where


def _least(n: int, where: np.ndarray, ids: np.ndarray) -> np.ndarray:
    out = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(out, where, ids)
    return out


class Bundle:
    """The documents of one bundle in a fixed order, their words one after
    the other, and the hashes of windows (which never cross documents)."""

    def __init__(self, frame: pa.Table):
        import xxhash
        order = np.argsort(frame.column("seq").to_numpy(), kind="stable")
        ids = frame.column("doc_id").to_pylist()
        texts = frame.column("text").to_pylist()
        self.ids = [ids[i] for i in order]
        self.words = [texts[i].encode("utf-8").split() if texts[i] else [] for i in order]
        del texts
        sizes = np.array([len(w) for w in self.words], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.doc = np.repeat(np.arange(len(sizes)), sizes)
        # NULL ids neither lose words nor are references
        self.used = (sizes >= WINDOW) & np.array([i is not None for i in self.ids])
        digest = xxhash.xxh3_64_intdigest
        self.h = np.fromiter((digest(w) for ws in self.words for w in ws), np.uint64, int(self.starts[-1]))

    def hashes(self, width: int, seed: int = 0):
        """Hash and place (among the bundle's words) of every window."""
        h = rolling_hash(self.h if not seed else mix64(self.h + np.uint64(seed)), width, width + seed)
        at = np.arange(len(h))
        doc = self.doc[:len(h)]
        ok = self.used[doc] & (at + width <= self.starts[doc + 1])
        return h[ok], at[ok]

    def anchors(self):
        """Sorted distinct hashes of the 7-word windows, whether the bundle
        has each as an aligned block, how often it has it, and each window's
        index among them and place."""
        h, at = self.hashes(BLOCK)
        values, where, n = np.unique(h, return_inverse=True, return_counts=True)
        aligned = np.zeros(len(values), bool)
        aligned[where[(at - self.starts[self.doc[at]]) % BLOCK == 0]] = True
        return values, aligned, n, where, at

    def windows(self, hit: np.ndarray, anchors):
        """The 13-word windows around hit anchors: sorted distinct pairs of
        hashes, the bundle's smallest id of each, each window's index among
        them and place, and the documents' ids."""
        _, _, _, where, at = anchors
        start = at[hit[where]]
        mark = np.zeros(len(self.doc) + 1, np.int64)   # starts start-6 .. start, cut to the document
        np.add.at(mark, np.maximum(start - BLOCK + 1, self.starts[self.doc[start]]), 1)
        np.add.at(mark, start + 1, -1)
        h, at = self.hashes(WINDOW)
        sel = (np.cumsum(mark[:-1]) > 0)[at]
        values, second, where = _distinct(h[sel], self.hashes(WINDOW, 1)[0][sel])
        at = at[sel]
        ids = np.array([0 if i is None else i for i in self.ids], np.int64)
        return values, second, _least(len(values), where, ids[self.doc[at]]), where, at, ids


def _bucket_of(values: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each sorted hash: equal slices of the hash range, so a
    bundle's entries of a bucket are one slice of its sorted hashes."""
    return ((values >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _slices(values: np.ndarray, buckets: int):
    b = _bucket_of(values, buckets)
    cuts = np.concatenate([[0], np.nonzero(np.diff(b))[0] + 1, [len(b)]]) if len(b) else [0]
    return [(int(b[lo]), int(lo), int(hi)) for lo, hi in zip(cuts[:-1], cuts[1:])]


def _pack(values: np.ndarray) -> bytes:
    """Sorted unsigned 64-bit values as differences in byte planes, which the
    shuffle's compression shrinks."""
    d = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    return np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    d = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<u8").reshape(-1)
    return np.cumsum(d, dtype=np.uint64)


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _flags(raw: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, np.uint8), count=n).astype(bool)


def _answers(frame: pa.Table, name: str, values: np.ndarray, buckets: int) -> np.ndarray:
    """The answer bits for a bundle's sorted hashes, put together by bucket."""
    found = dict(zip(frame.column("bucket").to_pylist(), frame.column(name).to_pylist()))
    out = np.zeros(len(values), bool)
    for b, lo, hi in _slices(values, buckets):
        if b in found:
            out[lo:hi] = _flags(found[b], hi - lo)
    return out


def _anchor_rows(frame: pa.Table, buckets: int) -> pa.Table:
    p = frame.column("p")[0].as_py()
    values, aligned, n, *_ = Bundle(frame).anchors()
    cut = _slices(values, buckets)
    return pa.table([pa.array([p] * len(cut), pa.int64()), pa.array([b for b, _, _ in cut], pa.int64()),
                     pa.array([_pack(values[lo:hi]) for _, lo, hi in cut], pa.binary()),
                     pa.array([_bits(aligned[lo:hi]) for _, lo, hi in cut], pa.binary()),
                     pa.array([_bits(n[lo:hi] > 1) for _, lo, hi in cut], pa.binary())],
                    ["p", "bucket", "hashes", "aligned", "many"])


def _match_anchors(frame: pa.Table) -> pa.Table:
    """Hits of one bucket: an entry is hit when the same words are an aligned
    block at another place, or are an aligned block here and occur elsewhere."""
    parts = [_unpack(r) for r in frame.column("hashes").to_pylist()]
    sizes = [len(x) for x in parts]
    aligned = np.concatenate([_flags(r, n) for r, n in zip(frame.column("aligned").to_pylist(), sizes)])
    many = np.concatenate([_flags(r, n) for r, n in zip(frame.column("many").to_pylist(), sizes)])
    _, where, n = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    blocks = np.bincount(where, weights=aligned, minlength=len(n))
    hit = (blocks[where] > 0) & ((n[where] > 1) | many)
    ends = np.cumsum(sizes)
    bits = [_bits(hit[e - s:e]) for s, e in zip(sizes, ends)]
    some = [bool(hit[e - s:e].any()) for s, e in zip(sizes, ends)]
    out = pa.table([frame.column("p"), frame.column("bucket"), pa.array(bits, pa.binary())], ["p", "bucket", "hit"])
    return out.filter(pa.array(some, pa.bool_()))


def _window_rows(docs: pa.Table, hits: pa.Table, buckets: int, window_buckets: int) -> pa.Table:
    schema = pa.schema([("p", pa.int64()), ("bucket", pa.int64()), ("hashes", pa.binary()), ("second", pa.binary()),
                        ("ids", pa.binary())])
    if not docs.num_rows or not hits.num_rows:
        return schema.empty_table()
    p = docs.column("p")[0].as_py()
    bundle = Bundle(docs)
    anchors = bundle.anchors()
    values, second, least, *_ = bundle.windows(_answers(hits, "hit", anchors[0], buckets), anchors)
    cut = _slices(values, window_buckets)
    return pa.table([pa.array([p] * len(cut), pa.int64()), pa.array([b for b, _, _ in cut], pa.int64()),
                     pa.array([_pack(values[lo:hi]) for _, lo, hi in cut], pa.binary()),
                     pa.array([second[lo:hi].astype("<u8").tobytes() for _, lo, hi in cut], pa.binary()),
                     pa.array([least[lo:hi].astype("<i8").tobytes() for _, lo, hi in cut], pa.binary())], schema=schema)


def _match_windows(frame: pa.Table) -> pa.Table:
    """For each entry of a bucket: does a document with a smaller id, in
    another bundle, have the same window?"""
    parts = [_unpack(r) for r in frame.column("hashes").to_pylist()]
    ids = np.concatenate([np.frombuffer(r, "<i8") for r in frame.column("ids").to_pylist()])
    second = np.concatenate([np.frombuffer(r, "<u8") for r in frame.column("second").to_pylist()])
    values, _, where = _distinct(np.concatenate(parts), second)
    later = ids > _least(len(values), where, ids)[where]
    ends = np.cumsum([len(x) for x in parts])
    cut = [(e - len(x), e) for x, e in zip(parts, ends)]
    out = pa.table([frame.column("p"), frame.column("bucket"),
                    pa.array([_bits(later[lo:hi]) for lo, hi in cut], pa.binary())], ["p", "bucket", "later"])
    return out.filter(pa.array([bool(later[lo:hi].any()) for lo, hi in cut], pa.bool_()))


def _kept_rows(docs: pa.Table, replies: pa.Table, buckets: int, window_buckets: int, schema: pa.Schema) -> pa.Table:
    """Apply the answers: words covered by a window that starts in a document
    with a smaller id -- of this bundle or of another -- go."""
    if not docs.num_rows:
        return schema.empty_table()
    bundle = Bundle(docs)
    gone = np.zeros(bundle.starts[-1] + 1, np.int64)
    hits = replies.filter(pa.compute.is_valid(replies.column("hit")))
    if hits.num_rows:
        anchors = bundle.anchors()
        values, _, least, where, at, ids = bundle.windows(_answers(hits, "hit", anchors[0], buckets), anchors)
        del anchors
        later = _answers(replies.filter(pa.compute.is_valid(replies.column("later"))), "later", values, window_buckets)
        first = at[later[where] | (ids[bundle.doc[at]] > least[where])]
        np.add.at(gone, first, 1)
        np.add.at(gone, first + WINDOW, -1)
    keep = np.cumsum(gone[:-1]) == 0
    rows = []
    for i, ws in enumerate(bundle.words):
        k = keep[bundle.starts[i]:bundle.starts[i + 1]]
        left = ws if k.all() else list(compress(ws, k.tolist()))
        rows.append((bundle.ids[i], len(ws), len(ws) - len(left), b" ".join(left)))
    cols = list(zip(*rows))
    last = (pa.array([hashlib.sha256(t).hexdigest() for t in cols[3]]) if schema.names[-1] == "kept_sha256"
            else pa.array([t.decode("utf-8") for t in cols[3]]))
    return pa.table([pa.array(cols[0], schema.field(0).type), pa.array(cols[1], pa.int64()),
                     pa.array(cols[2], pa.int64()), last], schema=schema)


def shared_warehouse(spark: SparkSession) -> None:
    """Raise where the warehouse is a folder of the driver's machine: on a
    cluster it has to be named."""
    conf = spark.sparkContext.getConf()
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local" and not conf.contains("spark.sql.warehouse.dir"):
        raise RuntimeError("set spark.sql.warehouse.dir to a folder that the driver and all executors share")


def _bundles(docs: DataFrame, doc_id: str, text: str, name: str) -> DataFrame:
    """Write the documents as a table bucketed and sorted by bundle: a file
    holds about ``FILE_CHARS`` characters at any size of the table."""
    spark = docs.sparkSession
    shared_warehouse(spark)
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    chars = src.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(chars) // FILE_CHARS))
    count = max(n, -(-int(chars) // BUNDLE_CHARS))
    seq = F.monotonically_increasing_id()
    out = src.withColumn("seq", seq).withColumn("p", F.pmod(F.xxhash64("seq"), F.lit(count)))
    (out.repartition(n, "p").write.bucketBy(n, "p").sortBy("p", "seq").option("compression", "zstd")
     .mode("overwrite").saveAsTable(name))
    return spark.table(name)


def substring_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """Per row ``doc_id, n_words, n_removed`` and ``kept_text`` (the kept
    words joined by one space) or, with ``digest``, ``kept_sha256``.

    A word goes when a window of 13 consecutive words covers it and the same
    window also starts in a document with a smaller id; windows are those of
    the input.  A NULL text has no words.  Rows with a NULL id are returned
    whole and are no reference; rows that share an id don't remove each
    other's words; extra columns are not read; an empty table gives an empty
    result.  Ids are integers.  Windows are compared by 128 bits of hashes.
    """
    spark: SparkSession = docs.sparkSession
    name = f"substring_bundles_{uuid.uuid4().hex}"
    try:
        table = _bundles(docs, doc_id, text, name)
        words = table.agg(F.sum(F.length("text"))).first()[0] or 0
        buckets = max(1, -(-int(words) // 6 // BUCKET_ENTRIES))
        grouped = table.groupBy("p")
        probes = grouped.applyInArrow(lambda t: _anchor_rows(t, buckets),
                                      "p long, bucket long, hashes binary, aligned binary, many binary")
        hits = staged(probes.groupBy("bucket").applyInArrow(_match_anchors, "p long, bucket long, hit binary"), "anchors")
        windows = grouped.cogroup(hits.groupBy("p")).applyInArrow(
            lambda d, h: _window_rows(d, h, buckets, buckets), "p long, bucket long, hashes binary, second binary, ids binary")
        later = windows.groupBy("bucket").applyInArrow(_match_windows, "p long, bucket long, later binary")
        none = F.lit(None).cast("binary")
        replies = (hits.withColumn("later", none)
                   .unionByName(later.withColumn("hit", none).select("p", "bucket", "hit", "later")))
        last = "kept_sha256" if digest else "kept_text"
        schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), (last, pa.string())])
        kept = grouped.cogroup(replies.groupBy("p")).applyInArrow(
            lambda d, r: _kept_rows(d, r, buckets, buckets, schema),
            f"doc_id long, n_words long, n_removed long, {last} string")
        return staged(kept, "substring-kept")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def sql() -> str:
    """DuckDB SQL for the digest form over ``documents``."""
    return r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
           FROM documents),
x AS (SELECT r, doc_id, unnest(range(1, len(w) - 11)) AS s, w FROM d WHERE doc_id IS NOT NULL AND len(w) >= 13),
g AS (SELECT r, doc_id, s, array_to_string(w[s:s + 12], ' ') AS g FROM x),
m AS (SELECT g, min(doc_id) AS first FROM g GROUP BY g HAVING min(doc_id) < max(doc_id)),
c AS (SELECT DISTINCT r, unnest(range(s, s + 13)) AS i FROM g JOIN m USING (g) WHERE doc_id > first),
l AS (SELECT r, list(i) AS gone FROM c GROUP BY r)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(list_transform(list_filter(range(1, len(w) + 1),
              lambda i: NOT list_contains(coalesce(gone, []), i)), lambda i: w[i]), ' ')) AS kept_sha256
FROM d LEFT JOIN l USING (r)
"""

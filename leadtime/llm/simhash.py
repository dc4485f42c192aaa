"""SimHash near-dedup by pivot distance tables.

Every distinct fingerprint gets its Hamming distances to a fixed set of
reference fingerprints (pivots): a base pivot, 64 pivots that differ from it
inside one of eight byte blocks, and a few random ones.  The difference
between a block pivot's distance and the base pivot's depends on that block
alone, so two fingerprints at most two bits apart have equal coordinates in
at least six of the eight blocks; bucketing on six blocks' coordinates, for
each of the 28 choices, loses no pair.  Inside a bucket pairs are discarded
by the largest coordinate difference over the whole table (it never exceeds
the Hamming distance) and the survivors are verified.  A bucket fixes 48
bits, so it holds at most 2^16 distinct fingerprints at any input size.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadtime.llm.common import mix64, packed, staged
from leadtime.llm.components import components

BLOCKS = 8
MAX_BITS = 2
_HASHES = 1 << 18  # shingle hashes expanded to bits at a time


def _pivots() -> tuple[np.uint64, np.ndarray, np.ndarray]:
    """Base pivot, block pivots [block, k] and random pivots.

    The masks of a block are the rows of the 8 x 8 Hadamard matrix as 0/1:
    their eight popcounts determine the block's eight bits."""
    rng = np.random.default_rng(64)
    base, extra = rng.integers(0, 1 << 63, dtype=np.uint64), rng.integers(0, 1 << 63, 16, dtype=np.uint64)
    had = np.array([[1]])
    for _ in range(3):
        had = np.block([[had, had], [had, -had]])
    masks = ((had + 1) // 2 @ (1 << np.arange(8))).astype(np.uint64)
    blocks = base ^ (masks[None, :] << (np.uint64(8) * np.arange(BLOCKS, dtype=np.uint64)[:, None]))
    return base, blocks, extra


BASE, BLOCK_PIVOTS, EXTRA = _pivots()
PIVOTS = np.concatenate([[BASE], BLOCK_PIVOTS.reshape(-1), EXTRA])
CHOICES = list(combinations(range(BLOCKS), BLOCKS - MAX_BITS))


def distance_table(fps: np.ndarray) -> np.ndarray:
    """Hamming distances of each fingerprint to each pivot (uint8)."""
    return np.bitwise_count(fps[:, None] ^ PIVOTS[None, :])


def bucket_keys(fps: np.ndarray) -> np.ndarray:
    """[fingerprint, choice]: hash of the relative coordinates of the chosen
    blocks."""
    t = distance_table(fps).astype(np.int64)
    rel = (t[:, 1:1 + 8 * BLOCKS] - t[:, :1]).reshape(-1, BLOCKS, 8) + 8
    code = (rel * (17 ** np.arange(8))).sum(axis=2).astype(np.uint64)
    keys = np.empty((len(fps), len(CHOICES)), np.uint64)
    for c, chosen in enumerate(CHOICES):
        k = np.full(len(fps), c + 1, np.uint64)
        for b in chosen:
            k = mix64(k * np.uint64(0x9E3779B97F4A7C15) ^ code[:, b])
        keys[:, c] = k
    return keys


def close_pairs(fps: np.ndarray, max_bits: int = MAX_BITS):
    """Index pairs (i, j) of a bucket at most ``max_bits`` apart: sorted by
    the base pivot's distance, compared within a window of that coordinate,
    discarded by the largest coordinate difference, then verified."""
    if len(fps) == 2:
        near = np.bitwise_count(fps[0] ^ fps[1]) <= max_bits
        table = distance_table(fps).astype(np.int8)
        keep = near and np.abs(table[0] - table[1]).max() <= max_bits
        return np.array([[0, 1]] if keep else np.empty((0, 2), int), int)
    table = distance_table(fps).astype(np.int8)
    order = np.argsort(table[:, 0], kind="stable")
    first = table[order, 0]
    ends = np.searchsorted(first, first + max_bits, side="right")
    out, step = [], 256
    for lo in range(0, len(fps), step):
        hi = min(lo + step, len(fps))
        a, b = order[lo:hi], order[lo:ends[hi - 1]]
        ok = np.ones((len(a), len(b)), bool)
        for at in range(0, table.shape[1], 9):   # coordinates in groups; few pairs outlast the first
            i, j = np.nonzero(ok) if at else (None, None)
            if at == 0:
                ok = np.abs(table[a, None, :9] - table[None, b, :9]).max(axis=2) <= max_bits
            else:
                far = np.abs(table[a[i], at:at + 9] - table[b[j], at:at + 9]).max(axis=1) > max_bits
                ok[i[far], j[far]] = False
        i, j = np.nonzero(ok)
        i, j = a[i], b[j]
        good = (np.bitwise_count(fps[i] ^ fps[j]) <= max_bits) & (fps[i] < fps[j])
        back = (np.bitwise_count(fps[i] ^ fps[j]) <= max_bits) & (fps[i] > fps[j])
        out += [np.stack([i[good], j[good]], 1), np.stack([j[back], i[back]], 1)]
    return np.unique(np.concatenate(out), axis=0)


def _forest(n: int, pairs: np.ndarray) -> list[tuple[int, int]]:
    """The pairs that join separate parts of a bucket; the others add no
    reachable fingerprint."""
    top = list(range(n))

    def find(x):
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    kept = []
    for i, j in pairs.tolist():
        a, b = find(i), find(j)
        if a != b:
            top[max(a, b)] = min(a, b)
            kept.append((i, j))
    return kept


def text_fingerprint(text, width: int = 3) -> int:
    """64-bit SimHash of a text: a bit is 1 when set in over half of the
    XXH64 values (seed 42) of its word shingles, repeats included."""
    import xxhash
    ws = text.encode("utf-8").lower().split() if text else []   # bytes.lower() changes A-Z only
    if not ws:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(ws) < width:
        return digest(b" ".join(ws), 42)
    total, ones = len(ws) - width + 1, np.zeros(64, np.int64)
    for lo in range(0, total, _HASHES):
        hi = min(lo + _HASHES, total)
        cut = [ws[lo + k:hi + k] for k in range(width)]
        h = np.fromiter((digest(s, 42) for s in map(b" ".join, zip(*cut))), np.uint64, hi - lo)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits((2 * ones > total).astype(np.uint8), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """``doc_id, row_hash, fp`` for every row: the hash of all its columns and
    the fingerprint's 64 bits as a long; NULL and blank texts have
    fingerprint zero."""
    src = docs.select(F.col(doc_id).alias("doc_id"), row_hash(docs).alias("row_hash"), F.col(text).alias("t"))

    def run(batches):
        for b in batches:
            fps = np.array([text_fingerprint(t.as_py(), width) for t in b.column(2)], np.uint64)
            yield pa.record_batch([b.column(0), b.column(1), pa.array(fps.view(np.int64))], ["doc_id", "row_hash", "fp"])

    id_type = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {id_type}, row_hash long, fp long")


def row_hash(docs: DataFrame):
    return F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Distinct links (a, b) among distinct fingerprints ``fp`` that join the
    same components as all pairs at most ``max_bits`` apart."""
    def keys(batches):
        for b in batches:
            f = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for lo in range(0, len(f), 2048):
                part = f[lo:lo + 2048]
                k = bucket_keys(part)
                yield pa.record_batch([pa.array(k.reshape(-1).view(np.int64)),
                                       pa.array(np.repeat(part, k.shape[1]).view(np.int64))], ["k", "fp"])

    def pairs(batches):
        for b in batches:
            a, z = [], []
            for members in b.column(0):
                f = np.unique(members.values.to_numpy(zero_copy_only=False).view(np.uint64))
                for i, j in _forest(len(f), close_pairs(f, max_bits)):
                    a.append(f[i])
                    z.append(f[j])
            yield pa.record_batch([pa.array(np.array(a, np.uint64).view(np.int64)),
                                   pa.array(np.array(z, np.uint64).view(np.int64))], ["a", "b"])

    buckets = (fps.select("fp").mapInArrow(keys, "k long, fp long").groupBy("k")
               .agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1).select("fps"))
    return buckets.mapInArrow(pairs, "a long, b long").distinct()


def _classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3,
             max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, row_hash, fp, root, component_id`` for every row."""
    if not 1 <= max_bits <= MAX_BITS:
        raise ValueError("the block choices hold for one or two differing bits")
    rows = staged(fingerprints(docs, doc_id, text, width), "fingerprints")
    distinct = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprint-ids")
    roots = components(staged(links(distinct, max_bits), "simhash-links"))
    named = (distinct.join(roots, distinct.fp == roots.node, "left")
             .select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    names = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = staged(named.join(names, "root").select(F.col("fp").alias("f"), "root", "component_id"), "simhash-names")
    return rows.join(named, rows.fp == named.f).drop("f")


def simhash_classes(docs: DataFrame, **options) -> DataFrame:
    """Per row: ``doc_id, fingerprint, component_id`` -- 16 hex digits, and
    the smallest id reachable over links of at most ``max_bits`` (2) bits.

    Rows are grouped by fingerprint first, so copies of any number cost one
    entry.  NULL and blank texts share fingerprint zero and link like any
    other.  NULL ids belong to their component but never name it (a component
    of NULL ids alone is named NULL); repeated rows come back repeated; other
    columns are only hashed; an empty table gives an empty result.
    """
    return _classes(docs, **options).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """One row of each component, with the columns of ``docs``: the smallest
    id (NULL ids last), of equal ids the smallest fingerprint and row hash;
    of rows equal in every column one stays."""
    rows = _classes(docs, doc_id, **options)
    pick = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "fp", "row_hash"))
    first = rows.groupBy("root").agg(pick.alias("p")).select(F.col("p.doc_id").alias("__id"), F.col("p.row_hash").alias("__h"))
    alike = rows.groupBy("doc_id", "row_hash").agg(F.count(F.lit(1)).alias("__n"))
    first = staged(first.join(alike, (F.col("__h") == F.col("row_hash")) & F.col("__id").eqNullSafe(F.col("doc_id")))
                   .select("__id", "__h", "__n"), "simhash-kept")
    kept = packed(docs, d=F.col(doc_id), h=row_hash(docs)).join(first, (F.col("h") == F.col("__h")) & F.col("d").eqNullSafe(F.col("__id")))
    single = kept.filter(F.col("__n") == 1)
    repeated = kept.filter(F.col("__n") > 1).dropDuplicates(["__id", "__h"])
    return single.select("row").unionByName(repeated.select("row")).select("row.*")

"""Token counts by a map-side two-tier lookup.

The text never leaves its row: a *pre-token* is a maximal run without ASCII
white space, which the tokenizer's own splitter never crosses, so a text's
count is the sum over its pre-tokens.  Tier 1 is a broadcast table with the
lengths of the frequent pre-tokens; tier 2 is a cache in each worker that
takes the misses, encoded in batches by the tokenizers library.  No
pre-token is shuffled: tier 1 comes from one bounded summary per task.
"""

from __future__ import annotations

import os
from collections import Counter
from itertools import islice
from sys import getsizeof

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadtime.llm.common import text_groups

HEAVY_SHARE = 1 / 32768   # tier 1 holds pre-tokens with at least this share
SUMMARY_ENTRIES = 1 << 18  # entries a task counts before it prunes rare ones
CACHE_ENTRIES = 1 << 18   # a worker's cache (tier 2) keeps up to twice as many ...
CACHE_BYTES = 40 << 20    # ... and up to twice so many bytes
SLOT_BYTES = 64           # of the table itself for an entry, about
KEY_BYTES = 64            # longer pre-tokens are neither tier-1 keys nor cached

_LOADED: dict = {}        # per worker process: tokenizers and caches


def _tokenizer(path: str):
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        _LOADED[path] = t
    return _LOADED[path]


class PieceCache:
    """What the tokenizer gives for a piece, in two generations.

    ``base`` entries stay; of the others the last ones are kept, up to twice
    ``entries`` and up to twice ``max_bytes`` (and one batch) of pieces,
    values and table.  Pieces longer than ``KEY_BYTES`` are encoded each time.
    Misses are encoded in one batch.
    """

    def __init__(self, encode, entries: int, base: dict | None = None, max_bytes: int = CACHE_BYTES):
        self.encode, self.entries, self.base, self.max_bytes = encode, entries, base or {}, max_bytes
        self.known, self.old, self.used = dict(self.base), {}, 0

    def lookup(self, pieces: list) -> list:
        out = list(map(self.known.get, pieces))
        if None not in out:
            return out
        holes = [i for i, v in enumerate(out) if v is None]
        missing = {pieces[i] for i in holes}
        if self.used > self.max_bytes or len(self.known) + len(missing) > self.entries + len(self.base):
            self.old, self.known, self.used = self.known, dict(self.base), 0
        old, found, new = self.old, {}, []
        for p in missing:
            v = old.get(p)
            if v is None:
                new.append(p)
            else:
                found[p] = v
        if new:
            found.update(zip(new, self.encode(new)))
        kept = {p: v for p, v in found.items() if len(p) <= KEY_BYTES}
        self.used += SLOT_BYTES * len(kept) + sum(map(getsizeof, kept)) + sum(map(getsizeof, kept.values()))
        self.known.update(kept)
        for i in holes:
            out[i] = found[pieces[i]]
        return out


def encode_lengths(tok, pieces: list[str]) -> list[int]:
    return [len(e.ids) for e in tok.encode_batch_fast(pieces, add_special_tokens=False)]


def _utf8(texts):
    return [t.encode("utf-8") if t else b"" for t in texts]


def frequent_pretokens(docs: DataFrame, text: str = "text", share: float = HEAVY_SHARE) -> list[bytes]:
    """Pre-tokens making up at least ``share`` of all pre-tokens.

    Each task counts its rows (lossy counting: rare entries are pruned when
    the table is full) and emits only pre-tokens with that share of its own
    total -- at most 1/share rows; a globally frequent one is frequent in
    some task.  The result is bounded by 1/share rows too.
    """
    def summarise(batches):
        seen, total = Counter(), 0
        for b in batches:
            col = b.column(0).to_pylist()
            for lo, hi in text_groups(col):
                for t in _utf8(col[lo:hi]):
                    ws = t.split()
                    total += len(ws)
                    seen.update(ws)
                if len(seen) > SUMMARY_ENTRIES:
                    keep = total * share / 8
                    floor = 1
                    while len(seen) > SUMMARY_ENTRIES // 2 and floor <= max(keep, 1):
                        seen = Counter({k: v for k, v in seen.items() if v > floor})
                        floor *= 2
        rows = [(k, v) for k, v in seen.items() if v >= share * total and len(k) <= KEY_BYTES]
        yield pa.record_batch([pa.array([k for k, _ in rows], pa.binary()),
                               pa.array([v for _, v in rows], pa.int64())], ["piece", "n"])

    top = (docs.select(F.col(text).alias("t")).mapInArrow(summarise, "piece binary, n long")
           .groupBy("piece").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "piece").limit(int(1 / share)))
    return [bytes(r.piece) for r in top.collect()]


def token_counts(docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text",
                 limit: int = 2048, share: float = HEAVY_SHARE) -> DataFrame:
    """Per row: id, ``n_bytes``, ``n_tokens``, ``over_limit`` (more than
    ``limit`` tokens).

    A NULL text counts as empty (0 bytes, 0 tokens); a NULL id stays NULL;
    repeated rows are counted one by one; other columns, whatever their
    names, are not read.  Very long texts are handled in their row.  An
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t"))
    pieces = frequent_pretokens(src, "t", share)
    tok = _tokenizer(tokenizer_path)
    table = dict(zip(pieces, encode_lengths(tok, [p.decode("utf-8", "replace") for p in pieces])))
    tier1 = spark.sparkContext.broadcast(table)
    stamp = f"{tokenizer_path}#{tier1._jbroadcast.id() if tier1._jbroadcast is not None else id(tier1)}"

    def count(batches):
        tok = _tokenizer(tokenizer_path)
        if _LOADED.get("stamp") != stamp:   # one cache per worker, kept over tasks
            _LOADED.update(stamp=stamp, counts=PieceCache(
                lambda ps: encode_lengths(tok, [p.decode("utf-8") for p in ps]), CACHE_ENTRIES, tier1.value))
        cache = _LOADED["counts"]
        for b in batches:
            col, sizes, counts = b.column(1).to_pylist(), [], []
            for lo, hi in text_groups(col):
                texts = _utf8(col[lo:hi])
                sizes += map(len, texts)
                lists = [t.split() for t in texts]
                found = iter(cache.lookup([w for ws in lists for w in ws]))
                counts += [sum(islice(found, len(ws))) for ws in lists]
            yield pa.record_batch([b.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
                                  ["doc_id", "n_bytes", "n_tokens"])

    id_type = src.schema["doc_id"].dataType.simpleString()
    out = src.mapInArrow(count, f"doc_id {id_type}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)

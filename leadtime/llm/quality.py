"""Quality rules from cross-document line frequency.

Normalised lines are hashed, the distinct documents of each line are counted
per host, lines above the limit are removed as boilerplate, and documents
that lose most of their words are rejected, beside those that fail the base
rules (too short, or mostly repeated word windows).

Copies and near copies of one document count as one document of the host:
texts with the same words, and texts whose sets of 5-word shingles were
compared whole with those of the document they are counted as and have a
Jaccard similarity of 0.8 or more.  Candidates come from 64 minimum hashes in
16 bands.  So the lines of a much-copied document are not boilerplate, and
its copies are left to the deduplication stages, while documents that share
no more than a long footer or menu are told apart.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadtime.llm.common import mix64, packed, remove, rolling_hash, scratch_path, staged

REPEAT_WINDOW = 8
SKETCH_WINDOW = 5
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
HOST_SHARE = 0.01    # a line in more than this share of a host's documents ...
HOST_FLOOR = 10      # ... and in more than this many is boilerplate
MIN_LEFT = 0.5       # a document that keeps less than this share of its words is depleted
BANDS, BAND_ROWS = 16, 4
SAME_PERCENT = 80    # Jaccard similarity of shingle sets from which texts are one document
_RNG = np.random.default_rng(SKETCH_WINDOW)
_XOR, _ODD, _MIX = (_RNG.integers(1, 1 << 62, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
                    for n in (BANDS * BAND_ROWS, BANDS * BAND_ROWS, BAND_ROWS))
_SYMBOLS = "#*$%&|<>"
_SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def word_hashes(ws: list[bytes]) -> np.ndarray:
    import xxhash
    return np.fromiter(map(xxhash.xxh3_64_intdigest, ws), np.uint64, len(ws))


def shingles(hashes: np.ndarray) -> np.ndarray:
    """64-bit hashes of a text's 5-word shingles; a shorter text is one."""
    return rolling_hash(hashes, min(SKETCH_WINDOW, len(hashes))) if len(hashes) else hashes


def band_keys(h: np.ndarray) -> np.ndarray:
    """One key per band, of the minima of its hash functions over ``h``: texts
    of similarity s share a given key with probability s^4, and one of the
    16 with 0.9998 at s = 0.8.  No shingles, no keys."""
    if not len(h):
        return h
    low = np.full(len(_XOR), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(h), 1024):
        low = np.minimum(low, ((h[None, i:i + 1024] ^ _XOR[:, None]) * _ODD[:, None]).min(1))
    return mix64((low.reshape(BANDS, BAND_ROWS) * _MIX).sum(1) + np.arange(BANDS, dtype=np.uint64))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets of shingles (sorted, distinct) are one document's."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= SAME_PERCENT * (len(a) + len(b) - both)


def repeat_words(ws: list[bytes], hashes: np.ndarray) -> int:
    """Words in windows found twice or more."""
    if len(ws) < REPEAT_WINDOW:
        return 0
    h = rolling_hash(hashes, REPEAT_WINDOW)
    s = np.sort(h)
    if not (s[1:] == s[:-1]).any():
        return 0
    seen, again = {}, []   # equal hashes are looked at as words
    for i in np.nonzero(np.isin(h, s[1:][s[1:] == s[:-1]]))[0].tolist():
        seen.setdefault(tuple(ws[i:i + REPEAT_WINDOW]), []).append(i)
    for at in seen.values():
        again += at if len(at) > 1 else []
    cover = np.zeros(len(ws) + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, np.array(again, np.int64) + REPEAT_WINDOW, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def measure_text(text) -> tuple:
    """The base figures of a text, the hash of its words, its band keys, and
    its lines with words as hashes and numbers of words."""
    import xxhash
    text = text or ""
    digest = xxhash.xxh3_64_intdigest
    ws = text.encode("utf-8").split()
    chars = len(text) - sum(map(text.count, _SPACES))
    symbols = sum(map(text.count, _SYMBOLS))
    hashes = word_hashes(ws)
    repeated = repeat_words(ws, hashes)
    dup, seen, lines, sizes = 0, set(), [], []
    for raw in text.encode("utf-8").split(b"\n"):
        line = raw.lower().split()
        if not line:
            continue
        dup += raw in seen
        seen.add(raw)
        lines.append(digest(b" ".join(line)))
        sizes.append(len(line))
    return len(ws), chars, symbols, dup, repeated, digest(hashes.tobytes()), band_keys(shingles(hashes)), lines, sizes


def _signed(values) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _offsets(lists) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum([len(x) for x in lists])]), pa.int32())


def measured(docs: DataFrame, host: str = "source") -> DataFrame:
    """``row, doc_id, host, key, <base figures>, id, bands, lines`` per row,
    written to the shared folder; texts of the same words have the same id."""
    src = docs.select("doc_id", F.col(host).alias("host"), content_key(docs, host).alias("key"), F.col("text").alias("t"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches):
        for b in batches:
            rows = [measure_text(t.as_py()) for t in b.column(3)]
            cols = list(zip(*rows)) if rows else [()] * 9
            bands = pa.ListArray.from_arrays(_offsets(cols[6]), _signed([k for x in cols[6] for k in x]))
            line = pa.ListArray.from_arrays(
                _offsets(cols[7]),
                pa.StructArray.from_arrays([_signed([h for x in cols[7] for h in x]),
                                            pa.array([n for x in cols[8] for n in x], pa.int64())], ["h", "n"]))
            yield pa.record_batch([b.column(0), b.column(1), b.column(2),
                                   *[pa.array(c, pa.int64()) for c in cols[:5]], _signed(cols[5]), bands, line],
                                  ["doc_id", "host", "key", *names, "id", "bands", "lines"])

    types = {f.name: f.dataType.simpleString() for f in src.schema.fields}
    out = src.mapInArrow(run, f"doc_id {types['doc_id']}, host {types['host']}, key string, "
                         + ", ".join(f"{n} long" for n in names) + ", id long, bands array<long>, lines array<struct<h:long,n:long>>")
    return staged(out.withColumn("row", F.monotonically_increasing_id()), "quality-lines")


def content_key(docs: DataFrame, host: str = "source") -> Column:
    """Rows of equal host and text get equal verdicts."""
    part = [F.coalesce(F.md5(F.col(c).cast("string").cast("binary")), F.lit("-")) for c in (host, "text")]
    return F.concat_ws("|", *part)


def candidate_pairs(rows: DataFrame) -> DataFrame:
    """``id, hub``: each text with the smallest id of every band key that it
    shares.  Copies fall together first, and a key of n texts gives n - 1
    pairs."""
    texts = rows.filter(F.size("bands") > 0).groupBy("id").agg(F.first("bands").alias("bands"))
    keys = staged(texts.select("id", F.explode("bands").alias("k")), "band-keys")
    # the minima are written, so that both sides of the join are plain
    # shuffles, which adaptive execution splits at a key of many texts
    least = staged(keys.groupBy(F.col("k").alias("g")).agg(F.min("id").alias("hub"), F.count(F.lit(1)).alias("n"))
                   .filter("n > 1").drop("n"), "band-minima")
    pairs = keys.join(least.hint("merge"), F.col("k") == F.col("g")).filter("id != hub")
    return staged(pairs.select("id", "hub").distinct(), "same-candidates")


def packed_texts(docs: DataFrame) -> DataFrame:
    """``i, z``: the hash of a text's words, as in ``measured``, and the text compressed."""
    def run(batches):
        import xxhash
        import zstandard
        pack = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            texts = [(t.as_py() or "").encode("utf-8") for t in b.column(0)]
            ids = [xxhash.xxh3_64_intdigest(word_hashes(t.split()).tobytes()) for t in texts]
            yield pa.record_batch([_signed(ids), pa.array(map(pack, texts), pa.binary())], ["i", "z"])

    return docs.select("text").mapInArrow(run, "i long, z binary")


def verified_pairs(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The ``pairs`` whose sets of shingles, taken from the texts, are similar."""
    ids = pairs.select(F.explode(F.array("id", "hub")).alias("c")).distinct()
    # always by shuffle, as the candidates grow with the documents
    texts = packed_texts(docs).groupBy("i").agg(F.first("z").alias("z"))   # copies fall together before the join
    texts = staged(texts.join(ids.hint("merge"), F.col("i") == F.col("c"), "left_semi"), "candidate-texts")
    own = pairs.join(texts.hint("merge"), F.col("id") == F.col("i")).select("id", "hub", F.col("z").alias("z1"))
    both = own.join(texts.hint("merge"), F.col("hub") == F.col("i")).select("id", "hub", "z1", "z")

    def run(batches):
        import zstandard
        unpack = zstandard.ZstdDecompressor().decompress

        def grams(z):
            return np.unique(shingles(word_hashes(unpack(z).split())))

        at, hub = None, None
        for b in batches:
            ok = []
            for h, z1, z in zip(b.column(1).to_pylist(), b.column(2), b.column(3)):
                if h != at:
                    at, hub = h, grams(z.as_py())
                ok.append(similar(grams(z1.as_py()), hub))
            yield b.select(["id", "hub"]).filter(pa.array(ok, pa.bool_()))

    return staged(both.mapInArrow(run, "id long, hub long"), "same-documents")


def distinct_documents(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``i, doc``: the document that a text is counted as, where that is not
    itself.  In the order of the ids a text joins the smallest document it is
    similar to, if any, and is a document of its own otherwise, so no two are
    one through a third.

    Rounds go on until no pair is left: a hub without open pairs is a
    document and takes its texts, and pairs of texts so taken leave.  The ids
    are hashes, so the rounds are few (logarithmic).
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "open-pairs")
    open_ = staged(verified_pairs(docs, candidate_pairs(rows)), "open-pairs", path)
    parts = []
    while open_.head(1):
        waits = open_.select(F.col("id").alias("w")).distinct()
        own = open_.join(waits.hint("merge"), F.col("hub") == F.col("w"), "left_anti")
        taken = staged(own.groupBy(F.col("id").alias("i")).agg(F.min("hub").alias("doc")), "same-as")
        parts.append(taken)
        gone = taken.select("i").hint("merge")
        rest = (open_.join(gone, F.col("id") == F.col("i"), "left_anti")
                .join(gone, F.col("hub") == F.col("i"), "left_anti"))
        old, path = path, scratch_path(spark, "open-pairs")
        open_ = staged(rest, "open-pairs", path)
        remove(spark, old)
    remove(spark, path)
    if not parts:
        return spark.createDataFrame([], "i long, doc long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return staged(out, "distinct-documents")


def boilerplate(docs: DataFrame, rows: DataFrame, share: float = HOST_SHARE, floor: int = HOST_FLOOR) -> DataFrame:
    """``hs, h``: lines in more than ``floor`` documents of their host (in a
    struct, so that NULL is a host like any other) and more than ``share`` of
    them.  Every count is combined map-side."""
    names = distinct_documents(docs, rows).hint("merge")
    # copies fall together before the join, so no id is a hot key of it
    at = rows.select(F.struct("host").alias("hs"), "id", F.array_distinct(F.col("lines.h")).alias("hashes"))
    doc = F.coalesce("doc", "id").alias("doc")
    sizes = (at.select("hs", "id").distinct().join(names, F.col("id") == F.col("i"), "left").select("hs", doc).distinct()
             .groupBy("hs").agg(F.count(F.lit(1)).alias("docs")))
    seen = (at.filter(F.size("hashes") > 0).select("hs", "id", F.explode("hashes").alias("h")).distinct()
            .join(names, F.col("id") == F.col("i"), "left").select("hs", doc, "h")
            .distinct().groupBy("hs", "h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > floor))
    often = seen.join(sizes.withColumnRenamed("hs", "h0"), F.col("hs") == F.col("h0")).filter(F.col("n") > share * F.col("docs"))
    return staged(often.select("hs", "h"), "boilerplate")


def judged(docs: DataFrame, host: str = "source", share: float = HOST_SHARE, floor: int = HOST_FLOOR,
           min_left: float = MIN_LEFT) -> DataFrame:
    """Per row the base figures, ``n_left`` (words outside boilerplate lines),
    ``base_failed`` and ``kept``, with ``key`` of ``content_key``."""
    rows = measured(docs, host)
    bad = boilerplate(docs, rows, share, floor).select(F.col("hs").alias("bh"), F.col("h").alias("bl"))
    lines = rows.filter(F.size("lines") > 0).select("row", F.struct("host").alias("hs"), F.explode("lines").alias("l"))
    lost = (lines.join(bad, (F.col("hs") == F.col("bh")) & (F.col("l.h") == F.col("bl")))
            .groupBy("row").agg(F.sum("l.n").alias("lost")).withColumnRenamed("row", "r"))
    out = rows.drop("lines", "id", "bands").join(lost, F.col("row") == F.col("r"), "left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    out = out.withColumn("n_left", F.col("n_words") - F.coalesce("lost", F.lit(0))).withColumn("base_failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("n_left") >= min_left * F.col("n_words"))).drop("row", "r", "lost")


def quality_report(docs: DataFrame, **options) -> DataFrame:
    """Per row: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, n_left``.

    A NULL or empty text has no words and fails the base rules.  A NULL host
    is a host of its own; NULL ids and repeated rows get a row each; a line
    repeated in a document counts once for it; extra columns are not read; an
    empty table gives an empty result.
    """
    return judged(docs, **options).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                          "n_repeat_words", "base_failed", "kept", "n_left")


def keep_good(docs: DataFrame, host: str = "source", **options) -> DataFrame:
    """The rows of ``docs`` that the rules keep."""
    bad = staged(judged(docs, host, **options).filter(~F.col("kept")).select(F.col("key").alias("__bad")).distinct(),
                 "quality-rejected")
    # always by shuffle: the rejected keys grow with the documents
    return (packed(docs, key=content_key(docs, host)).join(bad.hint("merge"), F.col("key") == F.col("__bad"), "left_anti")
            .select("row.*"))

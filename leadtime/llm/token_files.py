"""Token-ID output in a bit-plane shuffled block format.

Documents are range-partitioned and sorted by id; each partition is one
*shard*, a stream of token ids cut into blocks of a fixed number of ids.  A
block's unsigned 32-bit ids are transposed into byte planes (plane k holds
byte k of every id) or bit planes, and each plane is compressed with
zstandard.  A Parquet row holds one block with its planes and the document
segments inside it; ``<path>/index`` is the chunk index (global start, ids
and compressed bytes of each block).  Blocks decode independently, so a
reader is as parallel as there are blocks, and CRCs of a document that spans
blocks are joined with the CRC-32 combination rule.
"""

from __future__ import annotations

import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadtime.llm.common import release_memory, scratch_path, text_groups
from leadtime.llm.token_counts import _LOADED, PieceCache, _tokenizer

BLOCK_IDS = 1 << 16
SLICE_CHARS = 1 << 21    # text whose pieces are looked up at once (one text at least)
CACHE_ENTRIES = 7 << 16  # a worker's cache keeps up to twice as many ...
CACHE_BYTES = 40 << 20   # ... and up to twice so many bytes
# Cuts are made before each run of white space, after a run that is a single
# line feed, and between a word's plain Latin beginning and ASCII punctuation
# (but not "'").  ``_cuts`` makes them on the UTF-8 bytes of many texts at once.
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_PLAIN = re.compile(rf" ?[{_LATIN}]+").fullmatch  # one pre-token
_PUNCT = np.isin(np.arange(256), np.frombuffer(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~", np.uint8))
_SPACE = np.isin(np.arange(256), np.frombuffer(b"\t\n\x0b\x0c\r ", np.uint8))
_LETTER = np.isin(np.arange(256), np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", np.uint8))
# White space beyond ASCII, by the bytes of each character.
_WIDE_SPACE = [c.encode() for c in "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"]
# Separators that Python counts as white space and Unicode does not.
_ODD_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f")

BLOCK_SCHEMA = ("shard int, block int, n_ids int, first long, planes array<binary>, doc_ids array<{id}>, "
                "doc_rows array<long>, doc_at array<long>, seg_at array<int>, seg_len array<int>")


def to_planes(ids: np.ndarray, unit: str = "byte") -> list[bytes]:
    """Transpose unsigned 32-bit ids into 4 byte planes or 32 bit planes and
    compress each."""
    import zstandard
    z = zstandard.ZstdCompressor(level=3)
    cells = np.ascontiguousarray(ids.astype("<u4")).view(np.uint8).reshape(-1, 4)
    if unit == "bit":
        planes = np.packbits(np.unpackbits(cells, axis=1, bitorder="little").T, axis=1, bitorder="little")
    else:
        planes = np.ascontiguousarray(cells.T)
    return [z.compress(p.tobytes()) for p in planes]


def from_planes(planes: list[bytes], n_ids: int) -> np.ndarray:
    """The ids of a block; 4 planes are byte planes, 32 are bit planes."""
    import zstandard
    z = zstandard.ZstdDecompressor()
    raw = np.stack([np.frombuffer(z.decompress(p), np.uint8) for p in planes]) if planes else np.empty((4, 0), np.uint8)
    if len(planes) == 32:
        bits = np.unpackbits(raw, axis=1, bitorder="little")[:, :n_ids]
        cells = np.packbits(bits.T, axis=1, bitorder="little")
    else:
        cells = raw.T
    return np.ascontiguousarray(cells).view("<u4").reshape(-1)


_POLY = 0xEDB88320


def _gf_mul(a: int, b: int) -> int:
    """Product of two polynomials modulo the CRC-32 polynomial (reflected)."""
    out = 0
    while a:
        if a & 0x80000000:
            out ^= b
        a = (a << 1) & 0xFFFFFFFF
        b = (b >> 1) ^ (_POLY if b & 1 else 0)
    return out


def crc32_join(crc_a: int, crc_b: int, bytes_b: int) -> int:
    """CRC-32 of A followed by B, from the CRCs of both and the length of B."""
    shift, power = 0x80000000, 0x00800000  # x^0, and x^8 for one byte
    while bytes_b:
        if bytes_b & 1:
            shift = _gf_mul(shift, power)
        power = _gf_mul(power, power)
        bytes_b >>= 1
    return _gf_mul(shift, crc_a) ^ crc_b


def _special_strings(tok) -> list[str]:
    return [t.content for t in tok.get_added_tokens_decoder().values()]


def _encode_pieces(tok):
    """Ids of pieces; plain words go to the BPE model directly, written in the
    splitter's own byte alphabet, the others through the whole tokenizer."""
    letters = [chr(c) for c in range(0x250) if _PLAIN(chr(c))]
    byte_names = {ord(c): tok.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in letters}
    byte_names[ord(" ")] = tok.pre_tokenizer.pre_tokenize_str(" a")[0][0][0]
    model = tok.model.tokenize

    def encode(pieces):
        out, rest = [], []
        for p in pieces:
            if _PLAIN(p):
                out.append(array("I", [t.id for t in model(p.translate(byte_names))]).tobytes())
            else:
                out.append(None)
                rest.append(p)
        found = (array("I", e.ids).tobytes() for e in tok.encode_batch_fast(rest, add_special_tokens=False))
        return [next(found) if v is None else v for v in out]

    return encode


def _cuts(raw: bytes, starts: np.ndarray) -> np.ndarray:
    """Where the pieces of the texts joined in ``raw`` begin; ``starts`` are
    the beginnings of texts that aren't empty."""
    if not raw:
        return np.zeros(1, np.int64)
    b = np.frombuffer(raw, np.uint8)
    n = len(b)
    space, letter = _SPACE[b], _LETTER[b]
    present = np.bincount(b, minlength=256) > 0
    if present[0x80:].any():
        for c in (c for c in _WIDE_SPACE if all(present[list(c)])):
            at = raw.find(c)
            while at >= 0:
                space[at:at + len(c)] = True
                at = raw.find(c, at + len(c))
        lead = np.flatnonzero((b >= 0xC3) & (b <= 0xC9))
        lead = lead[lead + 1 < n]
        nxt = b[lead + 1]
        lead = lead[np.where(b[lead] == 0xC3, (nxt != 0x97) & (nxt != 0xB7), (b[lead] < 0xC9) | (nxt < 0x90))]
        letter[lead] = letter[lead + 1] = True
    first = np.zeros(n + 1, bool)
    first[starts] = True
    first[n] = True
    before = np.concatenate([[False], space[:-1]])
    begins = space & (~before | first[:n])          # a run of white space
    cut = first.copy()
    cut[:n] |= begins
    feed = np.flatnonzero(begins & (b == 10))
    feed = feed[feed + 1 < n]
    cut[feed[~space[feed + 1]] + 1] = True
    words = np.flatnonzero(~space & (before | first[:n]) & letter)
    stops = np.flatnonzero(np.concatenate([~letter, [True]]) | first)
    if len(words):
        ends = stops[np.searchsorted(stops, words, "right")]
        ends = ends[~first[ends]]
        cut[ends[_PUNCT[b[ends]]]] = True
    return np.flatnonzero(cut)


def _encode(texts: list[str], path: str) -> list[bytes]:
    """Unsigned 32-bit ids of each text, little-endian as on every platform Spark supports.

    Texts are cut where the splitter of a byte-level BPE always cuts, so
    pieces are encoded once and kept in the worker's cache.  Texts with
    special strings or odd separators are encoded whole.
    """
    tok = _tokenizer(path)
    key = f"ids#{path}"
    if key not in _LOADED:
        encode = _encode_pieces(tok)
        _LOADED[key] = PieceCache(lambda ps: encode([p.decode("utf-8") for p in ps]), CACHE_ENTRIES, max_bytes=CACHE_BYTES)
        _LOADED[f"odd#{path}"] = [s.encode() for s in (*_ODD_SPACE, *_special_strings(tok))]
    needles = _LOADED[f"odd#{path}"]
    raws = [t.encode("utf-8") for t in texts]
    joined = b"".join(raws)
    suspects = [s for s in needles if s in joined]
    whole = [i for i, r in enumerate(raws) if any(s in r for s in suspects)] if suspects else []
    if whole:
        for i in whole:
            raws[i] = b""
        joined = b"".join(raws)
    begin = np.zeros(len(raws) + 1, np.int64)
    np.cumsum([len(r) for r in raws], out=begin[1:])
    cuts = _cuts(joined, begin[:-1][np.diff(begin) > 0])
    pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(joined)])
    # every distinct piece is looked up once; Arrow gathers the ids
    pieces = pieces.dictionary_encode()
    ids = pa.array(_LOADED[key].lookup(pieces.dictionary.to_pylist()), pa.large_binary()).take(pieces.indices)
    _, offsets, data = ids.buffers()
    ends = np.frombuffer(offsets, np.int64)[np.searchsorted(cuts, begin)].tolist()
    raw = memoryview(data) if data is not None else b""
    out = [bytes(raw[lo:hi]) for lo, hi in zip(ends, ends[1:])]
    for i in whole:
        out[i] = array("I", tok.encode(texts[i], add_special_tokens=False).ids).tobytes()
    return out


class _Shard:
    """Blocks of one shard; memory is one block and the text at hand."""

    def __init__(self, shard: int, block_ids: int, unit: str, id_type: pa.DataType):
        self.shard, self.block_ids, self.unit, self.id_type = shard, block_ids, unit, id_type
        self.block = self.total = self.rows = 0
        self._new()

    def _new(self):
        self.parts, self.have, self.segs = [], 0, []

    def _row(self):
        ids = np.concatenate(self.parts) if self.parts else np.empty(0, "<u4")
        cols = list(zip(*self.segs)) if self.segs else [()] * 5
        row = [[self.shard], [self.block], [len(ids)], [self.total - len(ids)], [to_planes(ids, self.unit)],
               *[[list(c)] for c in cols]]
        types = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.binary()), pa.list_(self.id_type),
                 pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32())]
        names = ["shard", "block", "n_ids", "first", "planes", "doc_ids", "doc_rows", "doc_at", "seg_at", "seg_len"]
        self.block += 1
        self._new()
        return pa.record_batch([pa.array(v, t) for v, t in zip(row, types)], names)

    def add(self, doc_id, ids: np.ndarray):
        at = 0
        while at < len(ids):
            take = min(len(ids) - at, self.block_ids - self.have)
            self.segs.append((doc_id, self.rows, at, self.have, take))
            self.parts.append(ids[at:at + take])
            self.have += take
            self.total += take
            at += take
            if self.have == self.block_ids:
                yield self._row()
        self.rows += 1

    def end(self):
        if self.have:
            yield self._row()


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, doc_id: str = "doc_id",
                 text: str = "text", block_ids: int = BLOCK_IDS, unit: str = "byte") -> None:
    """Encode every text, append ``end_id`` and write blocks and index below
    ``path``, in ascending id order.

    NULL ids come first, ties are ordered by the text's hash and then the
    text, and every repeated row is written.  A NULL or empty text is the
    end id alone.  Other columns are not read.  An empty table writes an
    empty block table.
    """
    src = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    id_spark = src.schema["doc_id"].dataType.simpleString()
    src = src.withColumn("h", F.xxhash64("t"))
    src = src.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "t")

    def encode(batches):
        from pyspark import TaskContext
        shard, tail = None, np.array([end_id], "<u4").tobytes()
        for b in batches:
            if shard is None:
                shard = _Shard(TaskContext.get().partitionId(), block_ids, unit, b.schema.field(0).type)
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lo, hi in text_groups(texts, SLICE_CHARS):
                for d, raw in zip(ids[lo:hi], _encode(texts[lo:hi], tokenizer_path)):
                    yield from shard.add(d, np.frombuffer(raw + tail, "<u4"))
        if shard is not None:
            yield from shard.end()
        release_memory()

    blocks = src.select("doc_id", "t").mapInArrow(encode, BLOCK_SCHEMA.format(id=id_spark))
    blocks.write.mode("overwrite").option("compression", "uncompressed").parquet(f"{path}/blocks")
    spark = docs.sparkSession
    cells = F.aggregate("planes", F.lit(0).cast("long"), lambda a, p: a + F.octet_length(p))
    b = spark.read.parquet(f"{path}/blocks").select("shard", "block", "n_ids", "first", cells.alias("n_bytes"))
    # one row per shard: as many as write tasks
    base = (b.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
            .withColumn("base", F.coalesce(F.sum("ids").over(
                Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))))
    (b.join(base.select("shard", "base"), "shard")
     .select("shard", "block", (F.col("base") + F.col("first")).alias("start"), "n_ids", "n_bytes")
     .write.mode("overwrite").parquet(f"{path}/index"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: ``doc_id, start, n_tokens, ids_crc32``."""
    blocks = spark.read.parquet(f"{path}/blocks")
    index = spark.read.parquet(f"{path}/index").select("shard", "block", "start")
    id_spark = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    keep = ["shard", "block", "n_ids", "planes", "doc_ids", "doc_rows", "doc_at", "seg_at", "seg_len"]

    def segments(batches):
        for b in batches:
            for r in b.to_pylist():
                raw = from_planes(r["planes"], r["n_ids"]).astype("<u4").tobytes()
                at, n = r["seg_at"], r["seg_len"]
                crc = [zlib.crc32(raw[4 * a:4 * (a + k)]) for a, k in zip(at, n)]
                m = len(at)
                yield pa.record_batch([
                    pa.array([r["shard"]] * m, pa.int32()), pa.array([r["block"]] * m, pa.int32()),
                    pa.array(r["doc_ids"], b.schema.field("doc_ids").type.value_type),
                    pa.array(r["doc_rows"], pa.int64()), pa.array(r["doc_at"], pa.int64()), pa.array(at, pa.int64()),
                    pa.array(n, pa.int64()), pa.array(crc, pa.int64())],
                    ["shard", "block", "doc_id", "doc_row", "doc_at", "seg_at", "n", "crc"])

    segs = blocks.select(*keep).mapInArrow(
        segments, f"shard int, block int, doc_id {id_spark}, doc_row long, doc_at long, seg_at long, n long, crc long")
    segs = segs.join(index, ["shard", "block"])
    parts = (segs.groupBy("shard", "doc_row")
             .agg(F.first("doc_id").alias("doc_id"), F.min(F.col("start") + F.col("seg_at")).alias("start"),
                  F.sum("n").alias("n_tokens"),
                  F.array_sort(F.collect_list(F.struct("doc_at", "n", "crc"))).alias("segs")))

    @F.udf("long")
    def joined(segs):
        crc = segs[0]["crc"]
        for s in segs[1:]:
            crc = crc32_join(crc, s["crc"], 4 * s["n"])
        return crc

    one = F.size("segs") == 1
    # the CRC of a document inside one block needs no joining
    whole = parts.filter(one).withColumn("ids_crc32", F.col("segs")[0]["crc"])
    split = parts.filter(~one).withColumn("ids_crc32", joined("segs"))
    cols = ["doc_id", "start", "n_tokens", "ids_crc32"]
    return whole.select(*cols).unionByName(split.select(*cols))


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int = 2, path: str | None = None,
                **options) -> DataFrame:
    """Write the token files (below the shared checkpoint folder unless
    ``path`` is given) and return what ``read_tokens`` reads from them."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    write_tokens(docs, path, tokenizer_path, end_id, **options)
    return read_tokens(spark, path)

"""Shared pieces of the training-data operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadtime.sources.io import remove_path as remove
from leadtime.sources.io import stage_path, stage_scope

# A word: a run of characters other than space and U+0009..U+000D.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return stage_path(spark, name)


def staged(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts
    lineage, and the files outlive any executor."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, every other character unchanged."""
    return F.translate(c, UPPER, LOWER)


def words(c: Column) -> Column:
    """The words of a text as an array; empty for NULL and blank texts."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), GAP), lambda w: w != "")


def packed(docs: DataFrame, **extra: Column) -> DataFrame:
    """``docs`` as one struct column ``row`` beside ``extra``, so that no
    helper column meets a column of the same name; ``select("row.*")`` undoes
    it."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(row, *[c.alias(n) for n, c in extra.items()])


def text_groups(texts: list, limit: int = 1 << 21):
    """Consecutive slices (lo, hi) of ``texts`` of about ``limit`` characters,
    one text at least, so that working memory follows the longest text and
    not the size of an Arrow batch."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) if t else 0
        if size >= limit:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def release_memory() -> None:
    """Give a worker's unused memory back to the system: workers are kept for
    later tasks, and what one stage needed would count against the next."""
    import ctypes
    import gc

    import pyarrow as pa
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):   # another C library keeps it
        pass


# The multipliers and shifts of the splitmix64 finaliser (fixed values).
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """Scramble unsigned 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


def rolling_hash(h: np.ndarray, width: int, seed: int = 1) -> np.ndarray:
    """64-bit hash of every window of ``width`` consecutive values of ``h``,
    themselves 64-bit hashes (unsigned); empty when there are fewer."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    acc = np.zeros(n, np.uint64)
    odd = np.random.default_rng(seed).integers(1, 1 << 62, width, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for j in range(width):
        acc += h[j:j + n] * odd[j]
    return mix64(acc)

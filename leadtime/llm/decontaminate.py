"""Benchmark decontamination by size-partitioned MinHash containment search.

Items are partitioned by the size n of their shingle sets (the whole part of
log2 n).  A partition's largest size gives the length of its sketches: when
at most m of n shingles may be missing, any m + 1 of them include one that
the document has, and m grows with n, so the m + 1 smallest hashes of the
largest size do for every item of the partition; a document that shares none
of them can't contain the item.  Its smallest size gives the least number of
shingles that a document must have to be probed at all.  Documents probe a
partition with all their shingles, whatever their length, so a short item
inside a long document is found.  Candidates are verified by exact
containment of shingle strings.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadtime.llm.common import LOWER, UPPER, WORD, ascii_lower, packed, staged, words

WIDTH = 5
PERCENT = 80


def _starts(w: Column, width: int) -> Column:
    return F.when(F.size(w) >= width, F.sequence(F.lit(1), F.size(w) - (width - 1)))


def _pieces(w: Column, width: int, make) -> Column:
    """``make`` of every run of ``width`` words; a shorter sequence is one
    run, and no words give NULL."""
    return (F.when(F.size(w) >= width, F.transform(_starts(w, width), lambda i: make(F.slice(w, i, width))))
            .when(F.size(w) > 0, F.array(make(w))))


def _joined(w: Column) -> Column:
    return F.concat_ws(" ", w)


def _content(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def item_shingles(benchmark: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``cls, n, need, size_part, shingle, h, rank`` -- one row per distinct
    shingle of each distinct item text; rank orders an item's hashes."""
    w = (benchmark.select(words(ascii_lower(F.col("text"))).alias("w")).filter(F.size("w") > 0)
         .select(F.md5(_joined(F.col("w")).cast("binary")).alias("cls"), "w").dropDuplicates(["cls"]))
    s = w.select("cls", F.array_distinct(_pieces(F.col("w"), width, _joined)).alias("s"))
    n = F.size("s")
    s = s.select("cls", n.alias("n"), F.floor((n * percent + 99) / 100).cast("int").alias("need"),
                 F.floor(F.log2(n.cast("double"))).cast("int").alias("size_part"), F.explode("s").alias("shingle"))
    s = s.withColumn("h", F.xxhash64(F.split("shingle", " ")))
    return s.withColumn("rank", F.row_number().over(Window.partitionBy("size_part", "cls").orderBy("h", "shingle")))


def size_partitions(items: DataFrame) -> DataFrame:
    """``part, sketch, least``: of each partition by size the length of its
    sketches and the shingles that a document must have; as many rows as the
    largest item has binary digits."""
    return (items.filter("rank = 1").groupBy(F.col("size_part").alias("part"))
            .agg((F.max(F.col("n") - F.col("need")) + 1).alias("sketch"), F.min("need").alias("least")))


def leaks(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``content, cls, n, n_shared``: distinct texts (by MD5) and item texts
    with at least ``percent`` of the item's shingles in the text."""
    items = staged(item_shingles(benchmark, width, percent), "items")
    sketch = (items.join(size_partitions(items), F.col("size_part") == F.col("part")).filter(F.col("rank") <= F.col("sketch"))
              .select("h", "cls", "least"))
    sketch = staged(sketch, "sketches")
    d = (docs.filter(F.col("text").isNotNull())
         .select(_content(F.col("text")).alias("content"), words(ascii_lower(F.col("text"))).alias("w")))
    # outer: an inner explode computes its array twice, once in an added filter
    probes = d.select("content", F.greatest(F.size("w") - (width - 1), F.lit(1)).alias("have"),
                      F.explode_outer(_pieces(F.col("w"), width, F.xxhash64)).alias("h"))
    near = staged(probes.join(sketch, "h").filter(F.col("least") <= F.col("have"))
                  .select("content", "cls").distinct(), "candidates")
    # the candidates' texts: always by shuffle, as their number grows with the documents
    keys = near.select(F.col("content").alias("c")).distinct().hint("merge")
    # and copies fall together first, so no text is a hot key of it
    texts = (docs.filter(F.col("text").isNotNull()).groupBy(_content(F.col("text")).alias("content")).agg(F.first("text").alias("text"))
             .join(keys, F.col("content") == F.col("c"), "left_semi")
             .select("content", words(ascii_lower(F.col("text"))).alias("w")))
    have = texts.select("content", F.explode_outer(F.array_distinct(_pieces(F.col("w"), width, _joined))).alias("shingle"))
    shared = (have.join(items.select("shingle", "cls"), "shingle").join(near, ["content", "cls"], "left_semi")
              .select("content", "cls", "shingle").distinct()
              .groupBy("content", "cls").agg(F.count(F.lit(1)).alias("n_shared")))
    sizes = items.filter("rank = 1").select("cls", "n", "need")
    return staged(shared.join(sizes, "cls").filter("n_shared >= need").select("content", "cls", "n", "n_shared"), "leaks")


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``doc_id, item_id, n_item, n_shared, containment`` for each document
    and benchmark item whose shingles the document contains to at least
    ``percent`` percent.

    Words are lower-cased in A-Z; an item shorter than five words is one
    shingle and is found in a document with the same words only.  NULL and
    blank texts on either side match nothing; NULL ids are carried along;
    repeated rows give repeated pairs; extra columns are not read; an empty
    table on either side gives an empty result.
    """
    found = leaks(docs, benchmark, width, percent)
    ids = (benchmark.select("item_id", words(ascii_lower(F.col("text"))).alias("w")).filter(F.size("w") > 0)
           .select("item_id", F.md5(_joined(F.col("w")).cast("binary")).alias("cls")))
    hit = docs.select("doc_id", _content(F.col("text")).alias("content")).join(found, "content")
    return hit.join(ids, "cls").select("doc_id", "item_id", F.col("n").cast("long").alias("n_item"), "n_shared",
                                       F.round(F.col("n_shared") / F.col("n"), 6).alias("containment"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose text contains no benchmark item."""
    found = leaks(docs, benchmark, width, percent).select(F.col("content").alias("__leak")).distinct()
    return (packed(docs, content=_content(F.col("text")))
            .join(found.hint("merge"), F.col("content") == F.col("__leak"), "left_anti").select("row.*"))


def sql(width: int = WIDTH, percent: int = PERCENT) -> str:
    """DuckDB SQL: exact containment by an inverted list of shingles."""
    def sh(name, key, src):
        return f"""
{name}w AS (SELECT row_number() OVER () AS r, {key} AS id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM {src}),
{name} AS (SELECT DISTINCT r, id, unnest(CASE WHEN len(w) >= {width}
    THEN list_transform(range(1, len(w) - {width - 2}), lambda i: array_to_string(w[i:i + {width - 1}], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM {name}w)"""
    return f"""
WITH {sh('d', 'doc_id', 'documents')}, {sh('b', 'item_id', 'benchmark')},
n AS (SELECT r, count(*) AS n FROM b GROUP BY r),
m AS (SELECT d.r AS dr, b.r AS br, any_value(d.id) AS doc_id, any_value(b.id) AS item_id, count(*) AS k
      FROM d JOIN b USING (s) GROUP BY d.r, b.r)
SELECT doc_id, item_id, CAST(n AS BIGINT) AS n_item, CAST(k AS BIGINT) AS n_shared, round(k / n, 6) AS containment
FROM m JOIN n ON br = n.r WHERE k >= (n * {percent} + 99) // 100
"""

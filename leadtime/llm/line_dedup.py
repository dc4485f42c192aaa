"""Line dedup with a suffix array over line ids, by distributed prefix doubling.

Lines with a word get an id; a document is a sequence of ids, and a suffix
is a (row, place) in it.  Round k ranks suffixes by their first 2^k lines:
the pair (rank of this half, rank of the half 2^(k-1) lines on) is ranked
again by a distributed sort of the distinct pairs.  A suffix whose prefix
occurs once is settled and leaves; what stays under one rank is an interval
of the suffix array whose longest common prefix is at least 2^k.  In each
interval the first suffix (by id, then row, then place) is the original and
the others are later copies; their lines, joined over places and rounds, are
the maximal repeated runs, and they are deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadtime.llm.common import GAP, remove, scratch_path, staged
from leadtime.operators.windows import row_index

MIN_LINES = 2


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    src = docs.select(F.col(doc_id).alias("doc_id"), F.split(F.coalesce(F.col(text), F.lit("")), "\n").alias("lines"))
    return staged(src.withColumn("row", F.monotonically_increasing_id()), "line-rows")


def _places(rows: DataFrame) -> DataFrame:
    """``doc_id, row, place, line_no, h1, h2``: one row per line with a word;
    the id of a line is a pair of 64-bit hashes."""
    has_word = F.filter(F.transform("lines", lambda x, i: F.struct(x.alias("x"), i.alias("i"))),
                        lambda s: F.length(F.regexp_replace(s["x"], GAP, "")) > 0)
    e = rows.select("doc_id", "row", F.posexplode(has_word).alias("place", "s"))
    return e.select("doc_id", "row", "place", F.col("s.i").alias("line_no"),
                    F.xxhash64("s.x").alias("h1"), F.xxhash64(F.reverse("s.x")).alias("h2"))


def _order():
    return F.struct(F.col("doc_id").isNull(), "doc_id", "row", "place")


def _ranked(suffixes: DataFrame, a: str, b: str, path: str) -> DataFrame:
    """Suffixes whose (a, b) occurs again, with ``rank`` in the order of the
    pairs and ``first`` (the interval's first suffix).

    Counts and minima are combined map-side; the join back has one row per
    pair on one side, so adaptive execution splits a hot pair's rows.
    """
    pairs = (suffixes.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"), F.min(_order()).alias("first"))
             .filter("n > 1").select(F.col(a).alias("pa"), F.col(b).alias("pb"), "first"))
    ranks = row_index(pairs, ["pa", "pb"], "new_rank")
    out = (suffixes.join(ranks, (F.col(a) == F.col("pa")) & (F.col(b) == F.col("pb")))
           .select("doc_id", "row", "place", F.col("new_rank").alias("rank"), (_order() != F.col("first")).alias("later")))
    return staged(out, "suffixes", path)


def suffix_intervals(places: DataFrame, min_lines: int = MIN_LINES) -> list[tuple[int, DataFrame]]:
    """For each prefix length 2^k of at least ``min_lines`` (a power of two):
    ``row, place, rank, later`` of the suffixes that share it with another;
    rank is the interval's place in the suffix array of the repeated ones,
    later says that the suffix isn't the interval's first."""
    if min_lines < 1 or min_lines & (min_lines - 1):
        raise ValueError("min_lines must be a power of two")
    spark = places.sparkSession
    found, length, path = [], 1, scratch_path(spark, "suffixes")
    cur = _ranked(places, "h1", "h2", path)
    while cur.head(1):
        half = cur.select(F.col("row").alias("r2"), (F.col("place") - length).alias("p2"), F.col("rank").alias("next"))
        old, path = path, scratch_path(spark, "suffixes")
        if length >= min_lines:
            found.append((length, cur.drop("doc_id")))
        cur = _ranked(cur.join(half, (F.col("row") == F.col("r2")) & (F.col("place") == F.col("p2"))),
                      "rank", "next", path)
        if length < min_lines:
            remove(spark, old)
        length *= 2
    remove(spark, path)
    return found


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_lines: int = MIN_LINES) -> DataFrame:
    """Per row: ``doc_id, n_lines, n_removed, longest, kept_text``; longest is
    the greatest 2^k for which 2^k lines of the document are a later copy (0:
    none).

    A line goes when it lies in a run of at least ``min_lines`` lines (lines
    with a word, compared exactly) that occurs earlier: in a smaller id, in
    an earlier row of the same id, or further up in the same text.  Runs may
    overlap and add up to maximal ones.  Lines without a word are kept and
    don't interrupt a run.  A NULL text is an empty one (one empty line);
    NULL ids come last; extra columns are not read; an empty table gives an
    empty result.
    """
    rows = _rows(docs, doc_id, text)
    places = _places(rows)
    gone = places.select("row", "place").limit(0)
    longest = places.select("row", F.lit(0).alias("length")).limit(0)
    for length, suffixes in suffix_intervals(places, min_lines):
        later = suffixes.filter("later")
        longest = longest.unionByName(later.select("row", F.lit(length).alias("length")))
        if length == min_lines:   # a longer run is the sum of its windows of this length
            gone = later.select("row", F.explode(F.sequence("place", F.col("place") + (length - 1))).alias("place"))
    hit = places.select("row", "place", "line_no").join(gone.distinct(), ["row", "place"])
    per_row = hit.groupBy(F.col("row").alias("r")).agg(F.collect_list("line_no").alias("gone"))
    runs = longest.groupBy(F.col("row").alias("r")).agg(F.max("length").alias("longest"))
    out = rows.join(per_row.join(runs, "r"), F.col("row") == F.col("r"), "left")
    all_lines = F.sequence(F.lit(0), F.size("lines") - 1)
    keep = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(
        F.transform(F.array_except(all_lines, F.coalesce("gone", F.array().cast("array<int>"))),
                    lambda i: F.element_at("lines", i + 1)))
    return out.select("doc_id", F.size("lines").cast("long").alias("n_lines"),
                      F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
                      F.coalesce("longest", F.lit(0)).cast("long").alias("longest"),
                      F.array_join(keep, "\n").alias("kept_text"))


def line_dedup_report(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """``line_dedup`` with the kept text's SHA-256 in place of the text."""
    return line_dedup(docs, min_lines=min_lines).select("doc_id", "n_lines", "n_removed", "longest",
                                   F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def sql(min_lines: int = MIN_LINES, max_lines: int = 1 << 15) -> str:
    """DuckDB SQL for the report over ``documents`` (unique ids of up to
    ``max_lines`` lines): windows of each length and the first place of each."""
    lengths, n = [], min_lines
    while n <= max_lines:
        lengths.append(n)
        n *= 2
    return rf"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
p AS (SELECT doc_id, l, list_filter(range(1, len(l) + 1), lambda i: regexp_matches(l[i], '[^\x20\x09-\x0D]')) AS n FROM d),
q AS (SELECT doc_id, l, n, unnest({lengths}) AS w FROM p),
x AS (SELECT doc_id, l, n, w, unnest(range(1, len(n) - w + 2)) AS k FROM q WHERE len(n) >= w),
g AS (SELECT doc_id, k, n, w, list_transform(n[k:k + w - 1], lambda i: l[i]) AS g FROM x),
m AS (SELECT doc_id, k, n, w, row_number() OVER (PARTITION BY w, g ORDER BY doc_id, k) > 1 AS later FROM g),
t AS (SELECT doc_id, max(w) AS longest FROM m WHERE later GROUP BY doc_id),
c AS (SELECT DISTINCT doc_id, unnest(n[k:k + w - 1]) AS i FROM m WHERE later AND w = {min_lines}),
o AS (SELECT doc_id, list(i) AS gone FROM c GROUP BY doc_id)
SELECT d.doc_id, CAST(len(l) AS BIGINT) AS n_lines, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       CAST(coalesce(longest, 0) AS BIGINT) AS longest,
       sha256(coalesce(array_to_string(list_transform(list_filter(range(1, len(l) + 1),
              lambda i: NOT list_contains(coalesce(gone, []), i)), lambda i: l[i]), chr(10)), '')) AS kept_sha256
FROM d LEFT JOIN o USING (doc_id) LEFT JOIN t USING (doc_id)
"""

"""Documents with odd rows, and benchmark items that meet them."""

from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"
MID = "/root/testdata/sf0.01"

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def make_docs(spark, rows, parts=3):
    """rows of (doc_id, text[, lang[, source]])"""
    full = [(*r, *[None] * (4 - len(r)), len(r[1]) if r[1] else None) for r in rows]
    return spark.createDataFrame(full, DOCS).repartition(parts)


PROSE = ("The quick brown fox jumps over the lazy dog while seven wizards quietly brew strange potions "
         "in the old tower near the river bank every single night before dawn breaks again")

# NULLs in every column, empty and blank texts, ties, repeated rows, odd
# characters and a very long text.
ODD = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n ", None, None), (None, PROSE, "en", "b"), (None, None, None, None),
    (4, PROSE, "en", "a"), (4, PROSE, "en", "a"), (5, PROSE.upper(), "en", "b"), (6, PROSE + " extra", "de", None),
    (7, "x", "en", "a"), (8, "x", "en", "a"), (9, "two words", "fr", "b"), (10, "a\x1cb\x0bc\x85d e\xa0 f", "en", "a"),
    (11, "Straße naïve Ünïcödé İstanbul K \U0001f600 ́x", "de", "a"), (12, "0123 456 ... !!! <|endoftext|> end", "en", "b"),
    (13, " ".join(f"w{i % 977}" for i in range(60000)), "en", "a"), (14, "\n".join([PROSE, "", "line"] * 5), "en", "a"),
    (2**62, PROSE, "en", "a"), (-3, "negative id " + PROSE, "en", "a"),
]

ITEMS = [(1, " ".join(PROSE.split()[3:20])), (2, None), (3, ""), (4, "two words"), (5, "no such passage in any text at all"),
         (6, " ".join(PROSE.split()[3:20])), (None, " ".join(f"w{i}" for i in range(40, 90))), (7, "x")]

"""Corpus pipeline: documents to token files.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and read again as the
next one's docs.  All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leadtime.llm import common as C
from leadtime.llm.decontaminate import decontaminate
from leadtime.llm.mixing import mix
from leadtime.llm.quality import keep_good
from leadtime.llm.simhash import keep_first
from leadtime.llm.token_files import token_files


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return keep_first(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left, read back per document."""
    return token_files(docs, C.tokenizer_file("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality), ("simhash_dedup", near_duplicates), ("decontaminate", benchmark_free),
          ("mix_sources", mixed), ("token_files", tokens)]

# XXH64 fingerprints and BPE have no DuckDB counterpart; tests/llm holds the
# stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what earlier stages wrote is removed."""
    docs, old = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = C.scratch_path(spark, f"pipeline-{name}")
        with C.stage_scope(spark):
            docs = C.staged(stage(spark, docs, sf_dir), name, path)
        if old:
            C.remove(spark, old)
        old = path
    return docs

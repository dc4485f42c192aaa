"""Registered queries of the training-data operators, one per operator."""

from __future__ import annotations

from leadtime.llm import common as C

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_token_counts")
def op1(spark, sf_dir):
    from leadtime.llm.token_counts import token_counts
    return token_counts(table(spark, sf_dir, "documents"), C.tokenizer_file("word_bpe_49k.json"))


@query("op3_token_files")
def op3(spark, sf_dir):
    from leadtime.llm.token_files import token_files
    return token_files(table(spark, sf_dir, "documents"), C.tokenizer_file("byte_bpe_50k.json"))


@query("op2_simhash_dedup")
def op2(spark, sf_dir):
    from leadtime.llm.simhash import simhash_classes
    return simhash_classes(table(spark, sf_dir, "documents"))


def _mixing_sql():
    from leadtime.llm.mixing import sql
    return sql()


@query("op4_mix_sources", _mixing_sql())
def op4(spark, sf_dir):
    from leadtime.llm.mixing import mix_report
    return mix_report(table(spark, sf_dir, "documents"))


def _substring_sql():
    from leadtime.llm.substring_dedup import sql
    return sql()


@query("op10_substring_dedup", _substring_sql())
def op10(spark, sf_dir):
    from leadtime.llm.substring_dedup import substring_dedup
    return substring_dedup(table(spark, sf_dir, "documents"), digest=True)


def _leak_sql():
    from leadtime.llm.decontaminate import sql
    return sql()


@query("op5_decontaminate", _leak_sql())
def op5(spark, sf_dir):
    from leadtime.llm.decontaminate import contaminated
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op8_quality_rules")
def op8(spark, sf_dir):
    from leadtime.llm.quality import quality_report
    return quality_report(table(spark, sf_dir, "documents"))


@query("op6_secret_scan")
def op6(spark, sf_dir):
    from leadtime.llm.secrets import secret_report
    return secret_report(table(spark, sf_dir, "documents"))


def _line_sql():
    from leadtime.llm.line_dedup import sql
    return sql()


@query("op7_line_dedup", _line_sql())
def op7(spark, sf_dir):
    from leadtime.llm.line_dedup import line_dedup_report
    return line_dedup_report(table(spark, sf_dir, "documents"))


def _every_line_sql():
    from leadtime.llm.line_dedup import sql
    return sql(1)


@query("op7_every_line", _every_line_sql())
def op7_every(spark, sf_dir):
    """Runs of one line count too."""
    from leadtime.llm.line_dedup import line_dedup_report
    return line_dedup_report(table(spark, sf_dir, "documents"), 1)


@query("op9_language_id")
def op9(spark, sf_dir):
    from leadtime.llm.lang_id import language_id
    return language_id(table(spark, sf_dir, "documents"))


def _trie_sql():
    from leadtime.llm.prefix_trie import sql
    return sql()


@query("op11_prefix_trie", _trie_sql())
def op11(spark, sf_dir):
    from leadtime.llm.prefix_trie import prefix_trie
    return prefix_trie(table(spark, sf_dir, "conversations"))


def _collocation_sql():
    from leadtime.llm.collocations import sql
    return sql()


@query("op12_collocations", _collocation_sql())
def op12(spark, sf_dir):
    from leadtime.llm.collocations import collocations
    return collocations(table(spark, sf_dir, "documents"))


@query("op13_license_scan")
def op13(spark, sf_dir):
    from leadtime.llm.licenses import license_report
    return license_report(table(spark, sf_dir, "documents"))


@query("pipeline")
def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)

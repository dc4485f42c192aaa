"""The pipeline against a brute-force version, stage by stage."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from brute_lines import brute_left
from llm_data import ITEMS, ODD, SMALL, make_docs
from test_operators import brute_components, brute_fingerprint, brute_leaks, brute_quality, brute_targets, library

import corpus_pipeline
from leadtime.llm import mixing, quality
from leadtime.session import checkpoint_dir

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_kept(docs):
    """Rows of (doc_id, text, lang, source, n_chars) that the rules keep."""
    left = brute_left([(d[1], d[3]) for d in docs])
    out = []
    for d, n_left in zip(docs, left):
        n, *_, failed = brute_quality(d[1])
        if not failed and n_left >= quality.MIN_LEFT * n:
            out.append(d)
    return out


def brute_first(docs):
    groups = {}
    for d, c in zip(docs, brute_components([brute_fingerprint(d[1]) for d in docs])):
        groups.setdefault(c, []).append(d)
    return groups.values()


def brute_mix(docs, seed=7):
    sizes = Counter()
    for d in docs:
        sizes[d[3]] += len(WORD.findall(d[1] or ""))
    target, out = brute_targets(dict(sizes)), []
    for d in docs:
        n = len(WORD.findall(d[1] or ""))
        rate = target[d[3]] / sizes[d[3]] if sizes[d[3]] else 0.0
        key = f"{seed}|{'null' if d[0] is None else d[0]}|{n}"
        u = int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / (1 << 52)
        out += [d] * (math.floor(rate) + (u < rate - math.floor(rate)))
    return out


@pytest.fixture(params=["odd", "small"])
def folder(request, spark, tmp_path):
    if request.param == "small":
        return SMALL
    make_docs(spark, ODD * 2).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    stage = dict(corpus_pipeline.STAGES)
    got = {}
    for name, f in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.collect()]
        docs = corpus_pipeline.C.staged(f(spark, docs, folder), "test")
        got[name] = (before, [tuple(r) for r in docs.collect()], docs.columns)
    assert list(stage) == list(got) and len(got) == 5
    columns = spark.read.parquet(f"{folder}/documents.parquet").columns
    assert all(got[n][2] == columns for n in list(got)[:-1])

    before, after, _ = got["quality_rules"]
    assert Counter(after) == Counter(brute_kept(before))

    before, after, _ = got["simhash_dedup"]
    groups = brute_first(before)
    assert len(after) == len(groups) and not Counter(after) - Counter(before)
    assert sorted((min((d[0] for d in g if d[0] is not None), default=None) for g in groups), key=repr) == sorted(
        (d[0] for d in after), key=repr)

    before, after, _ = got["decontaminate"]
    texts = dict(enumerate(d[1] for d in before))
    leaks = {i for i, *_ in brute_leaks(list(texts.items()), items)}
    assert Counter(after) == Counter(d for i, d in enumerate(before) if i not in leaks)

    before, after, _ = got["mix_sources"]
    assert Counter(after) == Counter(brute_mix(before))
    assert mixing.SHARE == 1.5 and mixing.WEIGHTS == (3, 1, 2)

    before, after, _ = got["token_files"]
    tok = library("byte_bpe_50k.json")
    want = Counter()
    for d in before:
        ids = np.array(tok.encode(d[1] or "", add_special_tokens=False).ids + [2], "<u4")
        want[d[0], len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((i, n, c) for i, _, n, c in after) == want
    assert sorted(s for _, s, _, _ in after)[:1] in ([0], [])


def test_run_gives_the_last_stage(spark):
    from urllib.parse import urlparse
    import os
    folder = urlparse(checkpoint_dir(spark)).path
    before = set(os.listdir(folder))
    got = corpus_pipeline.run(spark, SMALL)
    assert len(set(os.listdir(folder)) - before) == 1   # the result alone is left
    assert got.columns[:4] == ["doc_id", "start", "n_tokens", "ids_crc32"] and got.count() > 0
    assert corpus_pipeline.ORACLE_SQL is None


def test_oracles_match(spark):
    import duckdb

    from leadtime.llm.queries import ORACLES, QUERIES
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")

    def norm(r):
        return tuple(round(v, 6) if isinstance(v, float) else v for v in r)

    for name, sql in ORACLES.items():
        df = QUERIES[name](spark, SMALL)
        res = con.execute(sql)
        names = [c[0] for c in res.description]
        assert sorted(names) == sorted(df.columns), name
        want = sorted(map(norm, res.fetchall()), key=repr)
        assert sorted((norm(r) for r in df.select(*names).collect()), key=repr) == want, name

"""Kept documents and words left by brute force, and the recall of the
near-copy candidates."""

import random

import numpy as np
import pytest
from brute_lines import brute_left, documents_of
from llm_data import ODD, SMALL, make_docs
from test_operators import brute_quality

from leadtime.llm import quality


def made_docs():
    """Hosts with boilerplate lines, copies, near copies and depleted texts."""
    rng = random.Random(4)
    def text(n):
        return " ".join(f"t{rng.randrange(5000)}" for _ in range(n))
    out = []
    for host in ("a", "b", None):
        menu, footer = "Home  News about US", text(30)
        for i in range(40):
            body = text(rng.choice([15, 25, 60]))
            lines = [menu] * (i % 3 > 0) + [body] + [footer.upper() if i % 5 == 0 else footer] * (i % 2)
            out.append(("\n".join(lines), host))
        for _ in range(14):   # copies, and copies with a changed word
            words = out[0][0].split(" ")
            words[rng.randrange(len(words))] = "other"
            out += [(out[0][0], host), (" ".join(words), host)]
    return [(i, t, "en", h) for i, (t, h) in enumerate(out)]


@pytest.mark.parametrize("which", ["made", "odd", "small"])
def test_kept_and_left(spark, which):
    if which == "small":
        df = spark.read.parquet(f"{SMALL}/documents.parquet")
    else:
        df = make_docs(spark, made_docs() if which == "made" else ODD)
    rows = [(r.doc_id, r.text, r.source) for r in df.collect()]
    want = []
    for (i, t, _), left in zip(rows, brute_left([(t, s) for _, t, s in rows])):
        n, *_, failed = brute_quality(t)
        want.append((i, left, not failed and left >= quality.MIN_LEFT * n))
    got = [(r.doc_id, r.n_left, r.kept) for r in quality.quality_report(df).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert which != "made" or 20 < sum(k for *_, k in want) < len(want) - 20


def test_documents_are_told_apart_by_the_rule():
    names = documents_of([t for _, t, *_ in made_docs()])
    assert len(set(names)) < len(names)


@pytest.mark.parametrize("footer,least", [(0.0, 1.0), (0.5, 1.0), (0.8, 1.0), (0.9, 0.97)])
def test_recall_beside_a_long_footer(footer, least):
    """600 pairs that differ in one word, on a host whose 1,200 texts of 200
    words share their end: a text is compared with the smallest of each key."""
    rng = random.Random(7)
    end = [f"f{i}" for i in range(int(200 * footer))]
    keys, hubs, pairs = [], {}, []
    for _ in range(600):
        words = [f"w{rng.randrange(100000)}" for _ in range(200 - len(end))]
        other = list(words)
        other[rng.randrange(len(words))] = "changed"
        two = []
        for ws in (words + end, other + end):
            h = quality.word_hashes([w.encode() for w in ws])
            two.append((int(np.uint64(h.sum()).view(np.int64)), set(quality.band_keys(quality.shingles(h)).tolist())))
        pairs.append(sorted(two, key=lambda x: x[0]))
        keys += two
    for i, ks in keys:
        for k in ks:
            hubs[k] = min(hubs.get(k, i), i)
    found = sum(any(hubs[k] == a for k in kb) for (a, _), (_, kb) in pairs)
    assert found >= least * len(pairs), found

"""Prefix trie, collocations and license scans against brute force."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import pytest
from llm_data import DOCS, ODD, PROSE, SMALL, make_docs
from pyspark.sql import functions as F

from leadtime.llm import collocations as col
from leadtime.llm import licenses, prefix_trie

CONV = "conv_id long, turn long, role string, text string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def named(df, names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


# -- 11: prefix trie

TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute_convs(turns):
    out = defaultdict(list)
    for c, t, role, text in turns:
        if c is not None:
            role, text = role or "", text or ""
            d = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            out[c].append(((t is not None, t or 0), d, (role, text)))
    return {c: [x[2] for x in sorted(v)] for c, v in out.items()}


def brute_rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute_trie(convs):
    members = defaultdict(list)
    for c, s in convs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    kids = defaultdict(list)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        below = kids.get(k, [])
        leaves[k] = sum(leaves[x] for x in below) if below else 1
        own = (len(members[k]) - 1) * len(k[-1][1].encode()) if k else 0
        saved[k] = own + sum(saved[x] for x in below)
    out = []
    for k, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(convs[c]) == len(k))
        out.append((min(cs), len(k), min(members[k[:-1]]) if k else None, len(cs), len(kids.get(k, [])), leaves[k], saved[k],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def table(spark, turns):
    return spark.createDataFrame(turns, CONV).repartition(3)


def random_turns(seed, n=60, letters=3, longest=12):
    rng = random.Random(seed)
    out = []
    for c in range(-5, n):
        if rng.random() < 0.1:
            continue
        for t in range(rng.choice([1, 2, 4, longest])):
            out.append((c, t, rng.choice(["user", "assistant"]), "abcé"[rng.randrange(letters)] * rng.randint(0, 2)))
    rng.shuffle(out)
    return out


ODD_TURNS = [(None, 1, "user", "no conversation"), (1, None, "user", "first"), (1, 0, None, None), (1, 0, "", ""), (1, 2, "user", "x"),
             (1, 2, "user", "x"), (5, 0, "us", "er"), (6, 0, "u", "ser"), (7, 3, "user", PROSE * 50), (8, 1, "user", "x"), (2**61, 0, "user", "x"),
             (-1, 0, "user", "x"), (10, 5, "user", "é\U0001f600"), (11, 5, "user", "é\U0001f600")]


@pytest.mark.parametrize("rebuild", [True, False])
def test_trie(spark, rebuild):
    for turns in (ODD_TURNS, random_turns(1)):
        convs = brute_convs(turns)
        want = brute_trie(brute_rebuilt(convs) if rebuild else convs)
        assert named(prefix_trie.prefix_trie(table(spark, turns), rebuild), TRIE) == want


def test_trie_of_copies_and_long_chains(spark):
    """Thousands of equal conversations, one that is a prefix of the next, and
    a long one that many leave at different depths."""
    turns = [(c, t, "user", f"same {t}") for c in range(0, 6000, 2) for t in range(3)]
    turns += [(c, t, "user", f"chain {t}") for c in range(1, 80, 2) for t in range(c)]
    turns += [(c, t, "user", f"long {t}" if t < c - 9000 or c == 9301 else f"own {c} {t}") for c in range(9001, 9302, 30) for t in range(c - 8990)]
    want = brute_trie(brute_convs(turns))
    assert named(prefix_trie.prefix_trie(table(spark, turns), False), TRIE) == want


def test_trie_on_the_small_table(spark):
    df = spark.read.parquet(f"{SMALL}/conversations.parquet")
    convs = brute_convs([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
    assert named(prefix_trie.prefix_trie(df), TRIE) == brute_trie(brute_rebuilt(convs))


def test_trie_empty_and_clashing(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], CONV)).count() == 0
    odd = table(spark, ODD_TURNS)
    more = odd.withColumns({n: F.lit(n) for n in ("c", "s", "digest", "bytes", "id", "p", "b", "a.b", "key", "base", "n", "last")})
    assert named(prefix_trie.prefix_trie(more), TRIE) == named(prefix_trie.prefix_trie(odd), TRIE)


def test_two_fattest(spark):
    pairs = [(a, b) for a in range(40) for b in range(a + 1, 41)]
    got = spark.createDataFrame(pairs, "a long, b long").select("a", "b", prefix_trie.two_fattest("a", "b").alias("f")).collect()
    for a, b, f in got:
        assert f == max(range(a + 1, b + 1), key=lambda x: x & -x)


def test_nodes_have_their_own_handles_and_few_batches(spark):
    """Compacted: at most two nodes a string, handles differ."""
    convs = prefix_trie.sequences(prefix_trie.turn_digests(table(spark, random_turns(2, 200))))
    full = prefix_trie._prefixes(convs)
    strings = full.dropDuplicates(["last"]).withColumnRenamed("c", "s")
    nodes = prefix_trie.build(strings)
    n = nodes.count()
    assert n <= 2 * strings.count()
    assert nodes.select("handle").distinct().count() == n == nodes.select("id").distinct().count()


# -- 12: collocations

PIECE = re.compile(r"[.,;:!?\x0A-\x0D]")


def brute_phrases(docs, longest):
    f, n = defaultdict(Counter), Counter()
    for text, lang in docs:
        t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for p in PIECE.split(t):
            w = [x for x in re.split("[\x20\x09]+", p) if x]
            n[lang or "und"] += len(w)
            for k in range(1, longest + 1):
                f[lang or "und"].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    return f, n


def brute_collocations(docs, longest=3, least=10, top=2000, share=50):
    f, n = brute_phrases(docs, longest)
    out = []
    for lang, counts in f.items():
        found = {g: a for g, a in counts.items() if len(g) > 1 and a >= least}
        over = defaultdict(int)
        for g, a in found.items():
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    over[g[i:i + k]] = max(over[g[i:i + k]], a)
        kept = []
        for g, a in found.items():
            if g in over and 100 * over[g] >= share * a:
                continue
            score, _, left, r = min((1000000 * a * a // (counts[g[:k]] * counts[g[k:]]), k, counts[g[:k]], counts[g[k:]])
                                    for k in range(1, len(g)))
            kept.append((-score, -a, " ".join(g).encode(), left, r))
        for i, (s, a, p, left, r) in enumerate(sorted(kept)[:top]):
            out.append((lang, i + 1, p.decode(), -a, left, r, n[lang], -s))
    return sorted(out, key=repr)


COLLOC = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def phrase_docs():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(12)] + ["É", "It's", "\x85", "a-b", "ab", "b"]
    out = [(i, t, la) for i, (t, la) in enumerate([(None, "en"), ("", None), (" \t ", "en"), ("x", None), (PROSE * 3, "en")])]
    fixed = "one two three four five six seven"
    for i in range(200):
        w = [rng.choice(words) for _ in range(rng.randint(1, 40))]
        w[rng.randrange(len(w))] += rng.choice([".", ",\n", "!?", ":", "\x0b", "\t"])
        out.append((100 + i, " ".join(w) + rng.choice(["", ". " + fixed, " " + fixed.upper(), "\t\tnew  york city"]),
                    rng.choice(["en", "en", "de", None, "und"])))
    return out + out[-3:]


@pytest.mark.parametrize("longest,least,sizes", [(3, 10, {}), (3, 2, {"group_bytes": 700, "bucket_bytes": 900, "hot_node": 3}),
                                                 (2, 3, {"group_bytes": 500, "hot_node": 2, "bucket_bytes": 500}),
                                                 (5, 4, {"bucket_bytes": 2000, "hot_node": 1})])
def test_collocations(spark, longest, least, sizes):
    data = phrase_docs()
    got = col.collocations(make_docs(spark, data), longest, least, **sizes)
    assert named(got, COLLOC) == brute_collocations([(t, la) for _, t, la in data], longest, least)


def test_collocations_top_and_share(spark):
    data = phrase_docs()
    for top, share in ((7, 50), (2000, 100), (2000, 1)):
        got = col.collocations(make_docs(spark, data), 3, 3, top=top, inside_share=share)
        assert named(got, COLLOC) == brute_collocations([(t, la) for _, t, la in data], 3, 3, top, share)


def test_phrase_counts(spark):
    data = phrase_docs()
    f, n = brute_phrases([(t, la) for _, t, la in data], 4)
    want = [(la, len(g), " ".join(g), a) for la, c in f.items() for g, a in c.items() if a >= 2]
    want += [(la, 0, "", a) for la, a in n.items() if a]
    got = col.phrase_counts(make_docs(spark, data), 4, 2, group_bytes=600, bucket_bytes=700, hot_node=2)
    assert rows(got) == sorted(want, key=repr)


def test_compact_paths(spark):
    """Fixed passages come out whole, and a path never crosses a fork."""
    text = "a b c d e f. x a b c d e f y. " * 12 + "p q r s. p q r t. " * 11
    counts = col.phrase_counts(make_docs(spark, [(1, text, "en")]), 3, 10)
    got = {(r.phrase, r.weight, tuple(r.inner)) for r in col.compact_paths(counts, 3).collect()}
    assert ("p q r", 22, ()) in got
    by_first = {p: (w, inner) for p, w, inner in got}
    # a b (starts a piece) and e f (ends one) are no inner nodes
    assert by_first["a b c d e f"] == (24, ("b c", "c d", "d e"))
    assert by_first["q r s"] == (11, ()) and by_first["q r t"] == (11, ())


def test_long_unbroken_text(spark):
    """One piece of 30,000 words, repeated: a path of its whole length."""
    piece = " ".join(f"v{i}" for i in range(30000))
    counts = col.phrase_counts(make_docs(spark, [(i, piece, "en") for i in range(10)]), 3, 10)
    paths = [r for r in col.compact_paths(counts, 3).collect()]
    assert [(r.words, r.weight, len(r.inner)) for r in paths] == [(30000, 10, 29997)] and paths[0].phrase == piece


def test_collocations_empty_and_clashing(spark):
    assert col.collocations(spark.createDataFrame([], DOCS)).count() == 0
    docs = make_docs(spark, phrase_docs())
    more = docs.withColumns({n: F.lit(n) for n in ("t", "phrase", "f", "words", "block", "a.b", "rank", "n")})
    assert named(col.collocations(more), COLLOC) == named(col.collocations(docs), COLLOC)


def test_collocations_on_odd_rows(spark):
    want = brute_collocations([(r[1], (*r, None, None)[2]) for r in ODD], 3, 2)
    assert named(col.collocations(make_docs(spark, ODD), 3, 2), COLLOC) == want


# -- 13: licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_base(text):
    w = words_of(text)
    places = []
    for phrase, label in (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")):
        p = phrase.split()
        places += [(i, label) for i in range(len(w)) if w[i:i + len(p)] == p]
    return len(w), sorted(places)


def brute_found(text):
    """Every rule on the whole text, and every pair compared."""
    w = words_of(text)
    joined = f" {' '.join(w).encode().decode('latin-1')} "
    rules, kinds = licenses.signature_rules(), list(licenses.KINDS)
    all_found = []
    for i, (label, kind, pattern, keyword) in enumerate(rules):
        for m in re.finditer(pattern, joined):
            assert keyword in m[0], (pattern, keyword)
            all_found.append((kinds.index(kind), m.start() - m.end(), m.start(), i, m.end()))
    kept = []
    for _, _, a, i, z in sorted(all_found):
        if all(z <= a2 or z2 <= a for a2, z2, _ in kept):
            kept.append((a, z, i))
    return [(joined.count(" ", 0, a) - 1, joined.count(" ", 0, z + 1) - 1, rules[i][0], rules[i][1]) for a, z, i in sorted(kept)]


LICENSED = [
    "This work is licensed under the GNU General Public License, version 2.", "Licensed under CC BY-NC 4.0.", "Released under the MIT License.",
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "SPDX-License-Identifier: GPL-2.0-or-later", "SPDX-License-Identifier: MIT", "mit der Lizenz, by the way: cc, by post",
    "GNU General Public License, either version 3 of the License, or (at your option) any later version.",
    "gnu.general/public-license GNU GENERAL PUBLIC\nLICENSE", "https://creativecommons.org/licenses/by-sa/3.0/", "dual MIT License / Apache License, MIT license",
    "the É\xa0mit\xa0license", "mit license", "MIT\x00LICENSE", "cc by cc by cc by-nd 2.5", "x" * 100000, None, "", " ... ", "a",
    "Neither the name of the Foo Bar Inc nor the names of its contributors may be used to endorse or promote products",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
]


def license_docs(spark):
    rng = random.Random(3)
    parts = [t for t in LICENSED if t and len(t) < 1000] + ["gnu", "general public license", "version 2", "or later", "cc", "by", "licensed under the"]
    data = [(i, t) for i, t in enumerate(LICENSED)]
    data += [(100 + i, " ".join(rng.choice(parts) for _ in range(rng.randint(1, 12)))) for i in range(80)]
    return data + [(None, "mit license"), (3, "MIT License"), (3, "MIT License")]


def test_license_spans(spark):
    data = license_docs(spark)
    got = licenses.license_spans(make_docs(spark, data)).collect()
    want = [(i, brute_base(t)[0], brute_base(t)[1], brute_found(t)) for i, t in data]
    assert sorted([(r.doc_id, r.n_words, [tuple(x) for x in r.base], [tuple(x) for x in r.found]) for r in got], key=repr) == sorted(want, key=repr)


LICENSE = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def brute_report(i, text):
    n, base = brute_base(text)
    found, at = brute_found(text), [p for p, _ in base]
    score = max([0.0, *[licenses.KINDS[k] for *_, k in found], *[licenses.KINDS["family"] for _ in base]])
    return (i, n, len(base), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in base})),
            ",".join(sorted({x for _, x in base} | {x for _, _, x, _ in found})), score)


def test_license_report(spark):
    data = license_docs(spark) + [(1000 + i, (*r,)[1]) for i, r in enumerate(ODD)]
    assert named(licenses.license_report(make_docs(spark, data)), LICENSE) == sorted((brute_report(i, t) for i, t in data), key=repr)
    small = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = [brute_report(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]
    assert named(licenses.license_report(small), LICENSE) == sorted(want, key=repr)


def test_hundreds_of_rules_with_keywords():
    rules = licenses.signature_rules()
    assert len(rules) > 300
    assert all(len(r[3]) >= 3 and r[3] == r[3].strip() for r in rules)
    for label, words in {"apache-2.0": "apache license version 2.0", "gpl-3.0-or-later": "GPL 3.0 or later", "bsd-3-clause": "BSD-3-Clause license",
                         "cc-by-sa-4.0": "Creative Commons Attribution-ShareAlike 4.0 International", "mpl-2.0": "Mozilla Public License, v. 2.0"}.items():
        assert [x[2] for x in licenses.scan_text(words.encode())[2]] == [label], label


def test_many_detections_in_one_text():
    text = "licensed under the mit license gnu general public license version 2 cc by nc 4 0 mit ".encode() * 30000
    t0 = time.time()
    n, base, found = licenses.scan_text(text)
    assert n == 17 * 30000 and len(base) == 90000 and len(found) == 120000 - 1
    assert time.time() - t0 < 60


def test_license_empty_and_clashing(spark):
    assert licenses.license_report(spark.createDataFrame([], DOCS)).count() == 0
    docs = make_docs(spark, license_docs(spark))
    more = docs.withColumns({n: F.lit(n) for n in ("t", "base", "found", "labels", "score", "a.b", "n_words")})
    assert named(licenses.license_report(more), LICENSE) == named(licenses.license_report(docs), LICENSE)

"""Entropy spans against a plain version, and texts with very many of them."""

import math
import random
import re
import time
from collections import Counter

import pytest
from llm_data import ODD, make_docs

from leadtime.llm import secrets

CANDIDATE = re.compile(r"[A-Za-z0-9+/=_-]+")
PLAIN = [r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}", r"[A-Za-z0-9_-]*(/[A-Za-z_-]+){2,}/?", r"[0-9_/=+-]*", r"[A-Za-z_/=+-]*"]
HOLDER = re.compile("example|sample|dummy|placeholder|changeme|your[_-]|xxxx|1234567890|abcdefgh", re.I)


def windows(s, limit, w=20):
    """Joined spans of windows with at least ``limit`` bits, counted anew."""
    spans = []
    for i in range(len(s) - w + 1):
        bits = -sum(c / w * math.log2(c / w) for c in Counter(s[i:i + w]).values())
        if bits >= limit - 1e-9:
            if spans and i <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + w)
            else:
                spans.append((i, i + w))
    return spans


def brute_spans(text):
    base = secrets.base_spans(text)
    out = list(base)
    for m in CANDIDATE.finditer(text):
        word = m[0]
        if len(word) < 20 or any(re.fullmatch(p, word) for p in PLAIN):
            continue
        for kind, chars, limit in (("entropy_base64", r"[A-Za-z0-9+/=_-]+", 3.75), ("entropy_hex", r"[0-9A-Fa-f]+", 3.0)):
            for run in re.finditer(chars, word):
                for lo, hi in windows(run[0], limit):
                    lo, hi = run.start() + lo, run.start() + hi
                    a, z = m.start() + lo, m.start() + hi
                    parts = [(p.start(), p.end()) for p in re.finditer(r"[^/]*", word) if p.start() < hi and p.end() > lo]
                    most = max(parts, key=lambda p: min(p[1], hi) - max(p[0], lo))
                    if any(re.fullmatch(p, word[lo:hi]) for p in PLAIN) or HOLDER.search(word[max(most[0], lo - 32):min(most[1], hi + 32)]):
                        continue
                    if not any(x <= a and z <= y for x, _, y in out):
                        out.append((a, kind, z))
    return sorted(out, key=lambda s: (s[0], secrets.KINDS.index(s[1]), s[2]))


def text_of(rng):
    letters = "abcdefABCDEF0123456789"
    full = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-"
    make = [lambda: "".join(rng.choices(letters, k=rng.randint(10, 60))), lambda: "".join(rng.choices(full, k=rng.randint(10, 80))),
            lambda: "".join(rng.choices("0123456789abcdef", k=rng.randint(12, 50))), lambda: "sample/", lambda: "/", lambda: "example", lambda: "AKIA" + "Q7" * 8,
            lambda: "token=" + "".join(rng.choices(full, k=20)), lambda: "plain words here", lambda: "aaaa" * rng.randint(1, 9),
            lambda: "123e4567-e89b-12d3-a456-426614174000", lambda: "usr/local/share/documentation"]
    return "".join(rng.choice(make)() + rng.choice(["", " ", "\n", "/", "é", "-"]) for _ in range(rng.randint(1, 15)))


def test_spans_against_brute_force():
    rng = random.Random(11)
    texts = [text_of(rng) for _ in range(400)] + [r[1] for r in ODD if r[1] and len(r[1]) < 5000]
    assert sum(len(secrets.scan_text(t)) for t in texts) > 500
    for t in texts:
        assert secrets.scan_text(t) == brute_spans(t), t


def test_the_column_is_what_the_scan_finds(spark):
    rng = random.Random(12)
    texts = [text_of(rng) for _ in range(40)]
    got = {r.doc_id: r.spans for r in secrets.secret_report(make_docs(spark, list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        assert got[i] == ",".join(f"{k}:{a}:{z}" for a, k, z in brute_spans(t))


@pytest.mark.parametrize("folder", ["prod", "sample", "docs/example", "dummy-data"])
def test_a_placeholder_folder_hides_no_key(folder):
    text = f"auth/{folder}/wJalrXUtnFEMIK7MDENGbPxRfiCYz9Qk2T4"
    assert any(k == "entropy_base64" and z == len(text) for _, k, z in secrets.scan_text(text))
    assert secrets.scan_text("auth/prod/wJalrXUtnFEMIK7MDENGbPxRfiCYEXAMPLEKEY9") == []


@pytest.mark.parametrize("joiner", ["\n", "/", "=" * 40])
def test_a_text_of_100000_spans(joiner):
    """Separate candidates, one candidate cut by slashes, and one long one."""
    rng = random.Random(13)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    text = joiner.join("".join(rng.choices(letters, k=24)) for _ in range(100_000))
    t0 = time.time()
    spans = secrets.scan_text(text)
    assert time.time() - t0 < 60
    assert len(spans) > (50_000 if joiner != "/" else 0)   # windows run across slashes

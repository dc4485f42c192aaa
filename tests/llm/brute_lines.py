"""The boilerplate rule by comparing every pair of texts."""

import re

import xxhash

from leadtime.llm import quality

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingle_set(words):
    n = min(5, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if words else set()


def documents_of(texts):
    """The document that each text is counted as: texts of the same words are
    one, and in the order of their ids (signed XXH3 of the words' XXH3) a text
    joins the first document with which it shares 80 % of their shingles."""
    words, ids = [WORD.findall((t or "").encode()) for t in texts], []
    for ws in words:
        h = xxhash.xxh3_64_intdigest(b"".join(xxhash.xxh3_64_intdigest(w).to_bytes(8, "little") for w in ws))
        ids.append(h - (1 << 64) if h >> 63 else h)
    sets = {i: shingle_set(ws) for i, ws in zip(ids, words)}
    doc, firsts = {}, []
    for i in sorted(sets):
        a = sets[i]
        same = next((f for f in firsts if a and sets[f] and 100 * len(a & sets[f]) >= 80 * len(a | sets[f])), None)
        doc[i] = i if same is None else same
        firsts += [i] if same is None else []
    return [doc[i] for i in ids]


def brute_left(docs):
    """Words outside boilerplate lines, of rows (text, host)."""
    lines = [[b" ".join(WORD.findall(x.lower())) for x in (t or "").encode().split(b"\n") if WORD.search(x)] for t, _ in docs]
    hosts, seen = {}, {}
    for (_, host), name, ls in zip(docs, documents_of([t for t, _ in docs]), lines):
        hosts.setdefault(host, set()).add(name)
        for x in set(ls):
            seen.setdefault((host, x), set()).add(name)
    bad = {k for k, v in seen.items() if len(v) > quality.HOST_FLOOR and len(v) > quality.HOST_SHARE * len(hosts[k[0]])}
    return [sum(len(x.split(b" ")) for x in ls if (host, x) not in bad) for (_, host), ls in zip(docs, lines)]

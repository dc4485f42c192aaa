"""Secret scans: fixed patterns plus sliding-window Shannon entropy.

Candidate strings are long runs of token characters.  Over each character
class (hexadecimal, base64) a window slides along the candidate; the counts
of its characters change by one each step, so the entropy is updated, not
recomputed.  Windows above the class's limit are joined to spans, and spans
on the allow list (identifiers, placeholders, paths, plain sequences) are
suppressed.  A placeholder word suppresses a span only near it and in the path
segment that holds most of it, so a key below a folder named "sample" is found.
Pattern matches are never suppressed.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy_base64", "entropy_hex")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.I | re.A)
_ASSIGN_HINTS = ("passw", "secret", "token", "apikey", "api_key")
# Runs shorter than the limit fail wherever they begin, so the limit can be
# part of the pattern for these two kinds.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")

WINDOW = 20
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/=_-]{%d,}" % WINDOW)
# Kind, the class's characters, entropy limit in bits (a window of 20 has at
# most 4.32; 20 hexadecimal digits rarely exceed 3.8).
CLASSES = (("entropy_base64", re.compile(r"[A-Za-z0-9+/=_-]{%d,}" % WINDOW), 3.75),
           ("entropy_hex", re.compile(r"[0-9A-Fa-f]{%d,}" % WINDOW), 3.0))
# one more than a window: the next character is counted before the first goes
_CLOG = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 2)]

REACH = 32   # characters around a span in which a placeholder word suppresses it
PLACEHOLDER = re.compile(r"(?i)example|sample|dummy|placeholder|changeme|your[_-]|xxxx|1234567890|abcdefgh")
ALLOW = (re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}"),      # UUIDs
         re.compile(r"[A-Za-z0-9_-]*(/[A-Za-z_-]+){2,}/?"),                       # paths of plain words
         re.compile(r"[0-9_/=+-]*"),                                              # numbers and dates
         re.compile(r"[A-Za-z_/=+-]*"))                                           # words without a digit


def allowed(candidate: str) -> bool:
    """Whether all of a candidate or span is an identifier, a path of words, a
    number or a word."""
    return any(p.fullmatch(candidate) for p in ALLOW)


class _Segments:
    """The parts of a candidate between slashes."""

    def __init__(self, word: str):
        self.word = word
        self.cuts = [-1, *(m.start() for m in re.finditer("/", word)), len(word)]

    def placeholder(self, lo: int, hi: int) -> bool:
        """Whether the segment that holds most of [lo, hi) (the first such)
        has a placeholder word, in the span or at most ``REACH`` from it."""
        first, last = bisect_right(self.cuts, lo - 1), bisect_left(self.cuts, hi)
        i = max(range(first, last + 1), key=lambda k: min(self.cuts[k], hi) - max(self.cuts[k - 1] + 1, lo))
        return bool(PLACEHOLDER.search(self.word, max(self.cuts[i - 1] + 1, lo - REACH), min(self.cuts[i], hi + REACH)))


def entropy_spans(s: str, limit: float, window: int = WINDOW) -> list[tuple[int, int]]:
    """Joined spans of windows of ``s`` with at least ``limit`` bits."""
    n, spans = len(s), []
    if n < window:
        return spans
    counts: dict[str, int] = {}
    total = 0.0   # sum of c * log2(c); entropy = log2(window) - total / window
    for i, ch in enumerate(s):
        c = counts.get(ch, 0)
        counts[ch] = c + 1
        total += _CLOG[c + 1] - _CLOG[c]
        if i >= window:
            out = s[i - window]
            c = counts[out]
            counts[out] = c - 1
            total += _CLOG[c - 1] - _CLOG[c]
        if i >= window - 1 and math.log2(window) - total / window >= limit:
            lo = i - window + 1
            if spans and lo <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((lo, i + 1))
    return spans


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the fixed patterns, in text order by kind."""
    out = []
    low = text.lower()
    if any(h in low for h in _ASSIGN_HINTS):
        out += [(m.start(), "assign", m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), "access", m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), "hex", m.end()) for m in _HEX.finditer(text)]
    return out


def _inside(starts: list[int], ends: list[int], a: int, z: int) -> bool:
    """Whether [a, z) lies in one of the spans with ascending ``starts``;
    ``ends`` holds the greatest end so far."""
    i = bisect_right(starts, a)
    return i > 0 and ends[i - 1] >= z


def scan_text(text) -> list[tuple[int, str, int]]:
    """All spans of a text by start, then kind as listed, then end; entropy
    spans inside a pattern's span, or inside one of another class, are not
    reported again.  Time grows with the text, however many spans it has."""
    if not text:
        return []
    base = base_spans(text)
    base_starts = sorted(x for x, _, _ in base)
    base_ends = list(accumulate((y for _, _, y in sorted(base)), max))
    found = []
    for m in _CANDIDATE.finditer(text):
        word = m.group()
        if word.isalpha() or allowed(word):
            continue
        segments, starts, ends = _Segments(word), [], []   # spans of this candidate so far
        for kind, chars, limit in CLASSES:
            new = []
            for run in chars.finditer(word):
                for lo, hi in entropy_spans(run.group(), limit):
                    lo, hi = run.start() + lo, run.start() + hi
                    a, z = m.start() + lo, m.start() + hi
                    if not (allowed(word[lo:hi]) or segments.placeholder(lo, hi) or _inside(base_starts, base_ends, a, z)
                            or _inside(starts, ends, a, z)):
                        new.append((a, z))
            # a class's own spans never lie in one another
            found += [(a, kind, z) for a, z in new]
            both = sorted([*zip(starts, ends), *new])
            starts, ends = [a for a, _ in both], list(accumulate((z for _, z in both), max))
    return sorted(base + found, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def secret_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id`` and ``spans``, an array of (kind, start, end) in
    code points, end exclusive.

    NULL and empty texts have no spans; NULL ids and repeated rows get a row
    each; extra columns are not read; whole texts are scanned; an empty table
    gives an empty result.
    """
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t"))

    def run(batches):
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            spans = [[{"kind": k, "start": a, "end": z} for a, k, z in scan_text(t.as_py())] for t in b.column(1)]
            yield pa.record_batch([b.column(0), pa.array(spans, kind)], ["doc_id", "spans"])

    id_type = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {id_type}, spans array<struct<kind:string,start:long,end:long>>")


def _of(kind: str):
    return lambda s: s["kind"] == kind


def secret_report(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``."""
    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS[:3]))
    counts = [F.size(F.filter("spans", _of(k))).cast("long").alias(f"n_{k}") for k in KINDS[:3]]
    return secret_spans(docs).select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                                     joined(F.col("spans")).alias("spans"))

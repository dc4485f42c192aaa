"""Piece caches by bytes, and pieces cut on bytes."""

import random
import re
from sys import getsizeof

import numpy as np
import pytest

from leadtime.llm import common, token_counts, token_files

LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
PIECE = re.compile(rf"\n(?=\S)|\s*[{LATIN}]+(?=[\s!-&(-/:-@\[-`{{-~]|\Z)|\s*\S+|\s+")


def test_cache_is_bounded_by_bytes():
    limit = 200_000
    cache = token_counts.PieceCache(lambda ps: [b"v" * 40 for _ in ps], 10**9, {b"base": b"b"}, limit)
    rng = random.Random(1)
    for _ in range(300):
        batch = [rng.randbytes(rng.choice([3, 20, 64])) for _ in range(100)]
        assert cache.lookup([*batch, b"base"]) == [b"v" * 40] * 100 + [b"b"]
        held = sum(getsizeof(k) + getsizeof(v) for d in (cache.known, cache.old) for k, v in d.items())
        assert held <= 2 * limit + 100 * 300
    assert cache.old and len(cache.known) > 1


def test_long_pieces_are_never_kept():
    made = []
    cache = token_counts.PieceCache(lambda ps: [made.append(p) or len(p) for p in ps], 100)
    long = b"x" * (token_counts.KEY_BYTES + 1)
    for _ in range(3):
        assert cache.lookup([long, b"short", long]) == [len(long), 5, len(long)]
    assert made.count(long) == 3 and made.count(b"short") == 1 and long not in cache.known


def test_paragraphs_without_spaces():
    """Text of Chinese paragraphs: pieces are whole paragraphs, encoded right
    and not cached."""
    path = common.tokenizer_file("byte_bpe_50k.json")
    tok = token_files._tokenizer(path)
    rng = random.Random(2)
    texts = ["\n".join("".join(chr(rng.randrange(0x4E00, 0x5000)) for _ in range(rng.choice([1, 5, 300]))) for _ in range(4)) for _ in range(50)]
    for t, got in zip(texts, token_files._encode(texts, path)):
        assert np.frombuffer(got, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids
    cache = token_counts._LOADED[f"ids#{path}"]
    assert all(len(k) <= token_counts.KEY_BYTES for d in (cache.known, cache.old) for k in d)


@pytest.mark.parametrize("seed", range(4))
def test_cuts_are_the_pieces_of_the_pattern(seed):
    rng = random.Random(seed)
    alphabet = ["a", "Bé", "×", "÷", "ɏ", "ɐ", " ", "  ", "\n", "\n\n", "\t", "\x0b", "\x85", "\xa0", " ", "　", " ",
                "'", "'s", ".", ",", "!", "~", "1", "ß", "́", "世界", "\r\n", "_", "-", "word", " word"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 14))) for _ in range(1500)]
    raws = [t.encode() for t in texts]
    begin = np.concatenate([[0], np.cumsum([len(r) for r in raws])])
    raw = b"".join(raws)
    cuts = token_files._cuts(raw, begin[:-1][np.diff(begin) > 0])
    at = np.searchsorted(cuts, begin)
    for i, t in enumerate(texts):
        c = cuts[at[i]:at[i + 1] + 1].tolist()
        assert [raw[a:z].decode() for a, z in zip(c, c[1:])] == PIECE.findall(t), repr(t)


def test_no_text_at_all():
    assert token_files._encode([], common.tokenizer_file("byte_bpe_50k.json")) == []
    assert token_files._encode(["", ""], common.tokenizer_file("byte_bpe_50k.json")) == [b"", b""]

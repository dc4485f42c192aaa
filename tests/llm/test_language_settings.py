"""The language network as shipped, its gradients, and its sample."""

import numpy as np
import pytest
from llm_data import make_docs

from leadtime.llm import lang_id


def test_shipped_settings_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = lang_id.language_id(docs).filter("held_out").join(docs.select("doc_id", "lang", "text"), "doc_id").filter("lang IS NOT NULL").collect()
    judged = [r for r in got if r.lang_pred != "und"]
    assert len(judged) > 1000
    assert sum(r.lang_pred == r.lang for r in judged) >= 0.99 * len(judged)
    assert all(0 <= r.score <= 1 for r in got)


@pytest.mark.parametrize("name", ["ezr", "en", "uzr", "un", "bn", "w", "b"])
def test_gradients_of_every_weight(name):
    rng = np.random.default_rng(3)
    m = {k: v.astype(np.float64) for k, v in lang_id.init(3, rng).items()}
    x = rng.integers(97, 100, (5, 7)).astype(np.uint8)   # few bytes, so that their rows have gradients
    mask = np.ones((5, 7), np.float32)
    mask[1, 4:] = mask[2, 1:] = 0
    y = np.array([0, 1, 2, 0, 1])
    g = lang_id.gradients(m, x, mask, y)[1][name]
    live = np.argwhere(np.abs(g) > 1e-6)
    assert len(live) > 0
    for at in live[rng.permutation(len(live))[:12]]:
        at, step = tuple(at), 1e-2
        slopes = []
        for sign in (1, -1):
            moved = {k: v.copy() for k, v in m.items()}
            moved[name][at] += sign * step
            slopes.append(lang_id.gradients(moved, x, mask, y)[0])
        slope = (slopes[0] - slopes[1]) / (2 * step)
        assert abs(slope - g[at]) < 2e-4 + 0.02 * abs(slope), (name, at)


def test_prediction_is_the_forward_pass():
    """The faster pass for predictions gives what training's does."""
    rng = np.random.default_rng(5)
    m = {k: v * np.float32(3) for k, v in lang_id.init(4, rng).items()}
    texts = [bytes(rng.integers(32, 250, int(n)).astype(np.uint8)) for n in (1, 63, 64, 65, 500, 0, 7)]
    got = lang_id.predict(m, texts, 4, at_once=3)
    x, mask, owner = lang_id.segments(texts)
    p = lang_id.probabilities(m, lang_id.forward(m, x, mask)[0])
    for i, t in enumerate(texts):
        mine = owner == i
        want = (p[:, mine] * mask[mine].T[:, :, None]).sum(axis=(0, 1)) / max(len(t), 1)
        assert np.allclose(got[i], want, atol=1e-5)


def test_large_values_saturate():
    m = {k: v * np.float32(1e4) for k, v in lang_id.init(2, np.random.default_rng(1)).items()}
    assert np.isfinite(lang_id.predict(m, [b"abc" * 50], 2)).all()


def test_texts_without_letters_take_no_place_in_the_sample(spark):
    """Whatever their hashes: 200 rows of digits, three with words."""
    rows = [(i, "123 456", "xx") for i in range(200)] + [(1000 + i, f"wort {i}", "xx") for i in range(3)] + [(2000 + i, "some words", "yy") for i in range(9)]
    langs, x, _, y = lang_id.sample(make_docs(spark, rows), per_lang=2)
    assert langs == ["xx", "yy"] and sorted(set(y.tolist())) == [0, 1] and len(x) == len(y)

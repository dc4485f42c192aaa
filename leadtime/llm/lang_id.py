"""Language identification with a bidirectional gated recurrent network.

The network reads bytes, is trained in numpy by backpropagation through time
on a bounded sample of labelled documents, labels every byte position of
every text, and a document's probabilities are the mean over its positions.
Texts are cut into segments of a fixed number of bytes that run through the
network side by side, so the cost is the same per byte for any text length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadtime.llm.common import text_groups

SEGMENT = 64           # bytes read in one go
HIDDEN = 16            # units in each direction
DOCS_PER_LANG = 300    # the sample's bound: documents of each language ...
SEGMENTS_PER_DOC = 16  # ... and evenly spaced segments of each document
STEPS = 400
BATCH = 512
RATE = 0.02


def _sigmoid(x):
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


def init(n_out: int, rng) -> dict:
    """Weights; the first axis of most is the direction (0 forward)."""
    def g(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)
    h = HIDDEN
    return {"ezr": g(2, 256, 2 * h, scale=0.3), "en": g(2, 256, h, scale=0.3), "uzr": g(2, h, 2 * h, scale=0.25),
            "un": g(2, h, h, scale=0.25), "bn": np.zeros((2, 1, h), np.float32),
            "w": g(2, h, n_out, scale=0.25), "b": np.zeros(n_out, np.float32)}


def forward(m: dict, x: np.ndarray, mask: np.ndarray, keep: bool = False):
    """Hidden states [direction, position, segment, unit] of segments ``x``
    [segment, position]; masked positions reset the state.  With ``keep``
    also what the backward pass needs."""
    n, t_max = x.shape
    states = np.zeros((2, t_max, n, HIDDEN), np.float32)
    saved = []
    for d in (0, 1):
        h, steps = np.zeros((n, HIDDEN), np.float32), []
        for t in (range(t_max) if d == 0 else range(t_max - 1, -1, -1)):
            c = x[:, t]
            zr = _sigmoid(m["ezr"][d][c] + h @ m["uzr"][d])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            a = h @ m["un"][d] + m["bn"][d]
            new = np.tanh(m["en"][d][c] + r * a)
            nxt = (new + z * (h - new)) * mask[:, t, None]
            if keep:
                steps.append((t, h, z, r, a, new))
            states[d, t] = h = nxt
        saved.append(steps)
    return states, saved


def probabilities(m: dict, states: np.ndarray) -> np.ndarray:
    """[position, segment, class] from the states of both directions."""
    s = states[0] @ m["w"][0] + states[1] @ m["w"][1] + m["b"]
    s -= s.max(axis=2, keepdims=True)
    np.exp(s, out=s)
    s /= s.sum(axis=2, keepdims=True)
    return s


def gradients(m: dict, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
    """Mean cross-entropy over the positions and its gradients."""
    states, saved = forward(m, x, mask, keep=True)
    p = probabilities(m, states)
    live = mask.T.astype(np.float32)
    n_pos = max(float(live.sum()), 1.0)
    picked = p[:, np.arange(len(y)), y]
    loss = float(-(np.log(picked + 1e-9) * live).sum() / n_pos)
    ds = p
    ds[:, np.arange(len(y)), y] -= 1
    ds *= (live / n_pos)[:, :, None]
    g = {k: np.zeros_like(v) for k, v in m.items()}
    g["b"] = ds.sum(axis=(0, 1))
    flat = x.T.reshape(-1)
    order = np.argsort(flat, kind="stable")   # equal bytes next to each other
    seen, first = np.unique(flat[order], return_index=True)
    for d in (0, 1):
        g["w"][d] = states[d].reshape(-1, HIDDEN).T @ ds.reshape(-1, ds.shape[2])
        dh = np.zeros((len(y), HIDDEN), np.float32)
        rows = np.empty((*x.T.shape, 3 * HIDDEN), ds.dtype)   # gradients of the bytes' rows, by position
        for t, h, z, r, a, new in reversed(saved[d]):
            dh = (dh + ds[t] @ m["w"][d].T) * mask[:, t, None]
            dpre = dh * (1 - z) * (1 - new * new)
            da = dpre * r
            dzr = np.concatenate([dh * (h - new) * z * (1 - z), dpre * a * r * (1 - r)], axis=1)
            rows[t, :, :HIDDEN], rows[t, :, HIDDEN:] = dpre, dzr
            g["uzr"][d] += h.T @ dzr
            g["un"][d] += h.T @ da
            g["bn"][d] += da.sum(axis=0)
            dh = dh * z + da @ m["un"][d].T + dzr @ m["uzr"][d].T
        g["en"][d][seen] = (sums := np.add.reduceat(rows.reshape(-1, 3 * HIDDEN)[order], first))[:, :HIDDEN]
        g["ezr"][d][seen] = sums[:, HIDDEN:]
    return loss, g


def train(x: np.ndarray, mask: np.ndarray, y: np.ndarray, n_out: int, steps: int = STEPS, seed: int = 1) -> dict:
    """Adam over class-balanced batches; equal data give equal weights."""
    rng = np.random.default_rng(seed)
    m = init(n_out, rng)
    mean, var = ({k: np.zeros_like(v) for k, v in m.items()} for _ in range(2))
    by_class = [np.nonzero(y == c)[0] for c in range(n_out)]
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(ix, max(1, BATCH // n_out)) for ix in by_class])
        _, g = gradients(m, x[pick], mask[pick], y[pick])
        norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
        rate = RATE * min(1.0, 20 / step) if step > steps // 2 else RATE
        for k, v in g.items():
            v = v * np.float32(min(1.0, 5.0 / (norm + 1e-9)))
            mean[k] += 0.1 * (v - mean[k])
            var[k] += 0.01 * (v * v - var[k])
            m[k] -= (rate * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(var[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return m


def segments(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes [segment, position], mask, and each segment's text number."""
    sizes = np.array([-(-len(t) // SEGMENT) for t in texts], np.int64)
    flat = np.frombuffer(b"".join(t + bytes(-len(t) % SEGMENT) for t in texts), np.uint8).reshape(-1, SEGMENT)
    owner = np.repeat(np.arange(len(texts)), sizes)
    last = np.cumsum(sizes)[sizes > 0] - 1
    mask = np.ones(flat.shape, np.float32)
    left = np.array([len(t) for t in texts], np.int64)[sizes > 0] - (sizes[sizes > 0] - 1) * SEGMENT
    mask[last] = np.arange(SEGMENT) < left[:, None]
    return flat, mask, owner


def _states(m: dict, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """``forward`` without what only training needs: gates apart and updates in
    place.  The logistic function is 1 / (1 + exp(-v)) and tanh(v) is twice
    that of 2 v, less 1, with the signs and the 2 folded into the weights, as
    numpy's exp takes half the time of its tanh.  A large exp is infinite and
    its reciprocal 0, as it should be."""
    n, t_max = x.shape
    one, two = np.float32(1), np.float32(2)
    states = np.empty((2, t_max, n, HIDDEN), np.float32)
    columns = np.ascontiguousarray(x.T)
    full = mask.all(axis=0)
    for d in (0, 1):
        ez, er = (np.ascontiguousarray(e) for e in np.split(-m["ezr"][d], 2, axis=1))
        uz, ur = (np.ascontiguousarray(u) for u in np.split(-m["uzr"][d], 2, axis=1))
        en, un, bn = (m[k][d] * -two for k in ("en", "un", "bn"))
        h, tmp = np.zeros((n, HIDDEN), np.float32), np.empty((n, HIDDEN), np.float32)
        z, r, new = np.empty_like(h), np.empty_like(h), np.empty_like(h)
        for t in (range(t_max) if d == 0 else range(t_max - 1, -1, -1)):
            c = columns[t]
            for gate, e, u in ((z, ez, uz), (r, er, ur)):
                np.take(e, c, axis=0, out=gate, mode="clip")
                gate += np.matmul(h, u, out=tmp)
                np.exp(gate, out=gate)
                gate += one
                np.reciprocal(gate, out=gate)
            np.matmul(h, un, out=tmp)
            tmp += bn
            tmp *= r
            np.take(en, c, axis=0, out=new, mode="clip")
            new += tmp
            np.exp(new, out=new)
            new += one
            np.divide(two, new, out=new)
            new -= one
            nxt = states[d, t]
            np.subtract(h, new, out=nxt)
            nxt *= z
            nxt += new
            if not full[t]:
                nxt *= mask[:, t, None]
            h = nxt
    return states


def _pooled(m: dict, states: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """[class, segment]: probabilities summed over the positions, with the
    classes first, so that every step runs along the positions."""
    _, t_max, n, _ = states.shape
    s = sum(m["w"][d].T @ states[d].reshape(-1, HIDDEN).T for d in (0, 1)) + m["b"][:, None]
    s -= s.max(axis=0)
    np.exp(s, out=s)
    s *= mask.T.reshape(-1) / s.sum(axis=0)
    return s.reshape(-1, t_max, n).sum(axis=1)


def predict(m: dict, texts: list[bytes], n_out: int, at_once: int = 4096) -> np.ndarray:
    """[text, class]: mean probabilities over all byte positions."""
    x, mask, owner = segments(texts)
    sums = np.zeros((len(texts), n_out))
    for lo in range(0, len(x), at_once):
        part = slice(lo, lo + at_once)
        with np.errstate(over="ignore"):
            per = _pooled(m, _states(m, x[part], mask[part]), mask[part])
        for c in range(n_out):
            sums[:, c] += np.bincount(owner[part], weights=per[c], minlength=len(texts))
    return sums / np.maximum([[len(t)] for t in texts], 1)


def has_letter(text) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def held_out(doc_id):
    """crc32 of the id as text, modulo 5, is 0; False for a NULL id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, per_lang: int = DOCS_PER_LANG, per_doc: int = SEGMENTS_PER_DOC):
    """Languages, and segments, masks and labels of the training sample: of
    each language the ``per_lang`` documents (not held out, with a letter)
    whose id hashes lowest, and of each ``per_doc`` segments spread evenly
    over the whole text.  One scan picks the ids of all languages; each task
    sends at most ``per_lang`` of one."""
    open_ = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
                        & F.col("text").rlike(r"\p{L}"))
    first = Window.partitionBy("lang").orderBy("h", "doc_id")
    picked = (open_.select("lang", "doc_id", F.xxhash64("doc_id").alias("h")).distinct()
              .withColumn("n", F.row_number().over(first)).filter(F.col("n") <= per_lang))
    ids = [(r.doc_id, r.lang) for r in picked.select("doc_id", "lang").collect()]
    if not ids:
        return [], None, None, None
    langs = sorted({lang for _, lang in ids})
    spark = docs.sparkSession
    few = F.broadcast(spark.createDataFrame(ids, open_.select(F.col("doc_id").alias("i"), F.col("lang").alias("l")).schema))
    span, number = SEGMENT, per_doc

    def cut(batches):
        for b in batches:
            got = []
            for t, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not has_letter(t):
                    continue
                raw = t.encode("utf-8")
                starts = sorted({int(s) for s in np.linspace(0, max(0, len(raw) - span), number)})
                got += [(raw[s:s + span], lang) for s in starts]
            yield pa.record_batch([pa.array([r for r, _ in got], pa.binary()), pa.array([v for _, v in got], pa.string())],
                                  ["raw", "lang"])

    rows = (open_.join(few, (F.col("doc_id") == F.col("i")) & (F.col("lang") == F.col("l")))
            .groupBy("doc_id", "lang").agg(F.min("text").alias("text"))   # repeated ids: one text
            .select("text", "lang").mapInArrow(cut, "raw binary, lang string").collect())
    rows = sorted((bytes(r.raw), r.lang) for r in rows)
    langs = [x for x in langs if any(r[1] == x for r in rows)]
    if not langs:
        return [], None, None, None
    x, mask, owner = segments([r[0] for r in rows])
    y = np.array([langs.index(rows[i][1]) for i in owner], np.int64)
    return langs, x, mask, y


def language_id(docs: DataFrame, per_lang: int = DOCS_PER_LANG, steps: int = STEPS,
                per_doc: int = SEGMENTS_PER_DOC) -> DataFrame:
    """Per row: ``doc_id, held_out, lang_pred, score`` (the mean probability
    of the predicted language, 0 to 1).

    ``und`` with score 0 for a NULL text, a text without a letter, and every
    text when no labelled row can be learned from.  NULL labels are not
    learned; a NULL id is neither held out nor learned from; repeated rows
    get a row each; extra columns are not read.  The sample that reaches the
    driver holds at most ``per_lang`` documents of each language and of each
    ``per_doc`` segments of 64 bytes, spread evenly over the whole text; every
    text is read whole for its prediction.
    """
    langs, x, mask, y = sample(docs, per_lang, per_doc)
    model = train(x, mask, y, len(langs), steps) if langs else None
    shared = docs.sparkSession.sparkContext.broadcast((langs, model))
    src = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").alias("t"))

    def run(batches):
        langs, model = shared.value
        for b in batches:
            col = b.column(2).to_pylist()
            names, scores = [], []
            for lo, hi in text_groups(col, 1 << 18):
                texts = [t.encode("utf-8") if langs and has_letter(t) else b"" for t in col[lo:hi]]
                p = predict(model, texts, len(langs)) if langs else np.zeros((len(texts), 1))
                best = p.argmax(axis=1)
                names += [langs[k] if t else "und" for k, t in zip(best, texts)]
                scores += [min(1.0, float(p[i, k])) if t else 0.0 for i, (k, t) in enumerate(zip(best, texts))]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                  ["doc_id", "held_out", "lang_pred", "score"])

    id_type = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {id_type}, held_out boolean, lang_pred string, score double")

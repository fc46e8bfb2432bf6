"""The language model: counts against brute force, gradients against differences, lanes against one document at a time, shares that add up to one, and held-out texts."""

import collections
import math
import re
import zlib

import numpy as np
import pytest

from orbitlake.llm import language_model as lm

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def tokens(text):
    return [*WORDS.findall((text or "").translate(UPPER)), None]


def is_held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def brute(rows):
    """doc_id -> held_out, n_tokens, n_known, N, base_score."""
    c = collections.Counter(t for d, text in rows if not is_held(d) for t in tokens(text))
    n, v = sum(c.values()), len(c)
    base = lambda t: math.log10((c[t] + 0.1) / (n + 0.1 * (v + 1)))
    return [(d, is_held(d), len(ts := tokens(text)), sum(c[t] > 0 for t in ts), n, sum(map(base, ts))) for d, text in rows]


def same(got, want):
    key = lambda r: (repr(r[0]), r[2], r[3], round(r[5], 5))
    got, want = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)


def made(size=300, **more):
    """A vocabulary whose words are 1000, 1001, ...: those of rank r occur 5000 / r times."""
    n = (5000 / np.arange(1, size + 1)).astype(np.int64)
    shape = np.arange(size) % lm.SHAPES
    return lm.Vocabulary(np.arange(1000, 1000 + size).astype(np.uint64), shape, n, np.bincount(shape, n, lm.SHAPES), np.bincount(shape, minlength=lm.SHAPES), 40, **more)


def test_counts_and_base_scores(spark, corpus):
    rows = [(r["doc_id"], r["text"]) for r in corpus.collect()]
    same(lm.score(corpus).collect(), brute(rows))
    # few words listed, few symbols: the rest comes by the join
    few = lm.score(corpus, words=100, listed=500).collect()
    same(few, brute(rows))
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in few)


def test_odd_rows(spark, odd, docs_of):
    got = lm.score(odd).collect()
    same(got, brute([(r["doc_id"], r["text"]) for r in odd.collect()]))
    assert all(math.isfinite(r["score"]) for r in got)
    assert lm.score(odd.limit(0)).count() == 0
    alone = next(i for i in range(100) if is_held(i))
    same(got := lm.score(docs_of(["a b c"], ids=[alone])).collect(), brute([(alone, "a b c")]))
    assert got[0]["train_tokens"] == 0 and math.isfinite(got[0]["score"])


def test_shares_add_up_to_one(spark):
    known = made(100)
    net = lm.Network(known, dtype=np.float64)
    h = np.random.default_rng(1).normal(size=(lm.STATE, 5))
    every = np.arange(known.end + 1 + lm.SHAPES)
    total = sum(np.exp(net.log_shares(h, np.full(5, y))) for y in every)
    assert np.allclose(total, 1)
    # behind each shape, its words and one unseen word share its mass
    n = (5000 / np.arange(1, 301)).astype(np.int64)[100:]
    assert np.allclose(made(300, words=100).mass.sum(), (n + lm.ADDED).sum() + lm.ADDED * lm.SHAPES)


def test_gradients(spark):
    known = made(80)
    rng = np.random.default_rng(5)
    net = lm.Network(known, dtype=np.float64)
    net.flat += rng.normal(size=net.flat.shape) * 0.05
    x, y = rng.integers(0, known.end + 1 + lm.SHAPES, (2, 6, 4))
    anew = [np.flatnonzero(r == known.end) if t else np.array([1, 2]) for t, r in enumerate(x)]
    h, weight = rng.normal(size=(lm.STATE, 4)), rng.random((6, 4))
    loss = lambda: -(net.log_shares(net.states(x, h, anew)[0].reshape(lm.STATE, -1), y.ravel()) * weight.ravel()).sum()
    grad, logs, _ = net.gradients(x, y, h, anew, weight)
    assert np.isclose(-(logs * weight).sum(), loss())
    at = 0
    for name, shape in net.shapes.items():
        size = math.prod(shape)
        for i in at + rng.choice(size, min(size, 12), replace=False):
            was, step = net.flat[i], 1e-5
            net.flat[i] = was + step
            up = loss()
            net.flat[i] = was - step
            down = loss()
            net.flat[i] = was
            assert np.isclose((up - down) / (2 * step), grad[i], rtol=1e-4, atol=1e-7), name
        at += size


def test_lanes_score_like_single_documents(spark):
    known = made(100)
    rng = np.random.default_rng(2)
    net = lm.Network(known)
    docs = [np.append(rng.choice([*range(known.end), *range(known.end + 1, known.end + 1 + lm.SHAPES)], n), known.end).astype(np.uint16) for n in (0, 1, 5, 700, 40, 40, 3, 260, 0, 129)]
    together = lm.score_documents(net, docs, steps=16, lanes=4)
    for d, got in zip(docs, together):
        h, logs, before = np.zeros((lm.STATE, 1), np.float32), 0.0, known.end
        for s in d.tolist():
            h = net.states(np.array([[before]]), h, [np.array([0] if before == known.end else [], int)])[0][:, -1]
            logs += float(net.log_shares(h, np.array([s]))[0])
            before = s
        assert np.isclose(got, logs, rtol=1e-4)
    assert np.allclose(together, lm.score_documents(net, docs, steps=128, lanes=256), rtol=1e-4)


def test_training_beats_counts_on_held_out_texts(spark):
    rng = np.random.default_rng(4)
    # two languages of 60 words each, in texts of one language, with pairs of words that follow each other
    def text(k):
        out = []
        for _ in range(40):
            w = int(rng.zipf(1.4)) % 60
            out += [f"{'ab'[k]}w{w}", f"{'ab'[k]}v{w}"]
        return " ".join(out)

    df = spark.createDataFrame([(i, text(i % 2)) for i in range(1500)], "doc_id long, text string")
    held = [r for r in lm.score(df).collect() if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.75 * sum(r["base_score"] for r in held)


@pytest.mark.parametrize("texts", [[b"Ab  c,d \xc3\x9cber\tlongwordhere, \n"], [b"", b"x"], [b""]])
def test_words_and_shapes(texts):
    h, shape, bounds = lm.shaped_words(texts)
    words = [WORDS.findall(t.decode()) for t in texts]
    assert np.diff(bounds).tolist() == [len(w) for w in words] and len(h) == sum(map(len, words))
    if len(h) == 4:
        # short twice; not of ASCII; long, with a comma at the end
        assert shape.tolist() == [0, 0, 9, 7] and h[0] == lm.shaped_words([b"aB"])[0][0]

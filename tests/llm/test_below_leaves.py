"""The language model's last factor hears what stands before a token, down to the token's spot in its leaf."""

import math
import zlib

import numpy as np
import pytest

from sensorflow.llm import maxent as M
from sensorflow.llm.common import stored


def one_leaf(n):
    """Words of one ending, leaf and different spots."""
    out = {}
    for i in range(1_000_000):
        w = b"%dxq" % i
        if zlib.crc32(w) % 8 == 3:
            out.setdefault(zlib.crc32(w) // 8 % M.SPOTS, w)
            if len(out) == n:
                return list(out.values())


def learned(spark, texts):
    docs = spark.createDataFrame([(i, bytearray(t)) for i, t in enumerate(texts)], "doc_id bigint, text binary")
    m = M.classes(stored(M.count_tokens(docs), "counts"), docs.count())
    M.train_weights(docs, m)
    return m


def test_words_of_one_leaf_are_told_apart_by_the_words_before(spark):
    a, b, *_ = one_leaf(4)
    often = b" ".join(b"f%d f%d" % (i, i) for i in range(40))  # words of their own classes
    texts = [t for i in range(300) for t in (b"north " + a, b"south " + b, often)]
    m = learned(spark, texts)
    assert m.path_of(a) == m.path_of(b) and m.path_of(a) // 8 >= M.SINGLES
    found, path, index, spot, _ = M.encode_spots([[x, w] for x in (b"north", b"south") for w in (a, b)], M.Memo(m))
    last = np.flatnonzero(np.append(index[1:] != index[:-1], True)) - 1  # the token before each end
    gain = m.log_gain(found, path, spot)[last]
    share = np.log10(300 + 1) - m.log_shares()[path[last]]
    p = 10 ** (share + gain)
    assert p[0] > 0.8 and p[1] < 0.2 and p[2] < 0.2 and p[3] > 0.8


def test_the_tokens_of_a_leaf_share_its_probability(spark):
    words = one_leaf(60)
    often = b" ".join(b"f%d f%d f%d" % (i, i, i) for i in range(40))
    texts = [(often + b" ") * 30] * 3 + [b" ".join([words[i * j % 60] for j in range(1, 12)]) for i in range(60)]
    m = learned(spark, texts)
    known = sorted({w for t in texts for w in t.split()} & set(words))
    counts = {w: sum(t.split().count(w) for t in texts) for w in known}
    assert len(known) > 50
    for before in (words[1], b"f3"):
        found, path, index, spot, _ = M.encode_spots([[before, w] for w in known], M.Memo(m))
        last = np.flatnonzero(np.append(index[1:] != index[:-1], True)) - 1
        p = 10 ** (m.log_gain(found, path, spot)[last] - m.log_shares()[path[last]]) * [counts[w] + 1 for w in known]
        assert len(set(path[last])) == 1 and abs(p.sum() - (1 - 1 / m.mass[path[last][0]])) < 1e-4


def test_deep_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(0)
    m = M.Model({}, 0, {b"the": 0}, {b"ed": 31}, rng.integers(1, 90, M.LEAVES).astype(float), 5, 1 << 18, 9,
                spots=rng.integers(0, 9, (M.LEAVES, M.SPOTS)).astype(float))
    m.weights = m.first_weights().astype(np.float64)
    m.weights[:1 << m.bits] = rng.normal(size=(1 << m.bits, M.WAYS))
    found, path, _, spot, _ = M.encode_spots([b"the cat walked on the walked cat".split(), [], b"cat cat".split()], M.Memo(m))
    g, n = np.zeros_like(m.weights), np.zeros(len(m.weights), np.int64)
    M.add_gradient(g, n, m.weights, found, path, m.bits, spot)
    alone = np.zeros_like(n)
    M.add_gradient(np.zeros_like(g), alone, m.weights, found, path, m.bits)
    used = np.flatnonzero(n > alone)
    assert len(used) > 10
    for row in used[::3]:
        for j in (0, 5):
            moved = []
            for by in (1e-5, -1e-5):
                w = m.weights.copy()
                w[row, j] += by
                moved.append(-M.log_paths(w, found, path, m.bits).sum() - M.log_deep(w, found, path, spot, m.bits).sum())
            assert abs((moved[0] - moved[1]) / 2e-5 - g[row, j]) < 1e-5


def test_scores_do_not_depend_on_what_is_in_the_head(spark, monkeypatch):
    """Tail tokens get the same factor by the join; unknown ones the share of a token that occurs no time."""
    often = " ".join(f"f{i} " * (400 + 20 * i) for i in range(40))
    texts = [often] * 3 + [f"f1 w{i % 7} x{i} w{i % 5} f2" for i in range(60)] + ["w1 x3"] * 9 + [None, "", "x3 nowhere x3"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    want = {r.doc_id: r for r in M.score(docs).collect()}
    monkeypatch.setattr(M, "HEAD", 40)
    got = {r.doc_id: r for r in M.score(docs).collect()}
    assert len(got) == len(want) == len(texts)
    assert all(math.isfinite(r.score) for r in want.values()) and any(r.n_known < r.n_tokens for r in want.values())
    for i, r in want.items():
        assert got[i].score == pytest.approx(r.score, abs=1e-4) and got[i].n_known == r.n_known

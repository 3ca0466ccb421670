"""The language model works through a block of texts in stretches of tokens, with the same results."""

import numpy as np

from sensorflow.llm import maxent as M


def model(texts):
    words = [w for t in texts for w in t]
    m = M.Model({}, 0, {b"a0": 0, b"b1": 1}, {b"x2": M.SINGLES}, np.full(M.LEAVES, 3.0), len(texts), len(words) * 64, 50)
    m.weights = m.first_weights()
    m.weights[:1 << m.bits] = np.random.default_rng(1).normal(size=(1 << m.bits, M.WAYS)).astype(np.float32)
    return m


def test_stretches_give_what_the_whole_block_gives(monkeypatch):
    texts = [[b"%c%d" % (97 + (i * j) % 26, (i + 3 * j) % 10) for j in range(i % 40)] for i in range(60)]
    m = model(texts)
    found, path, _ = M.encode(texts, M.Memo(m))
    assert len(path) == sum(len(t) + 1 for t in texts)

    def results(stretch):
        monkeypatch.setattr(M, "STRETCH", stretch)
        g, n = np.zeros_like(m.weights), np.zeros(len(m.weights), np.int64)
        M.add_gradient(g, n, m.weights, found, path, m.bits)
        return M.log_paths(m.weights, found, path, m.bits), g, n

    sizes, outcomes = [], M.outcomes

    def noted(weights, rows, node, bits):
        sizes.append(len(node))
        return outcomes(weights, rows, node, bits)
    monkeypatch.setattr(M, "outcomes", noted)
    whole = results(1 << 30)
    sizes.clear()
    parts = results(100)
    assert 0 < max(sizes) <= 100
    assert np.allclose(whole[0], parts[0], atol=1e-5) and np.allclose(whole[1], parts[1], atol=1e-3) and (whole[2] == parts[2]).all()
    assert len(M.log_paths(m.weights, tuple(f[:0] for f in found), path[:0], m.bits)) == 0

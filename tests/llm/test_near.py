"""SimHash and embedding near-dedup against brute force over all pairs."""

import random

import numpy as np
import xxhash

from sensorflow.llm import embeddings, graph, simhash

DIR = "/root/testdata/sf0.001"


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def roots(ids, links):
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_fingerprint_counts_repeats_and_short_texts():
    for t in ("", "  ", "One two", "a b c d", "a b c d e a b c d e f g A B", "é x \x0bY z w q", "w " * 5000):
        assert simhash.fingerprint(t.encode()) == brute_fingerprint(t)


def test_segment_counts_bound_the_distance():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 2 ** 64, (2, 5000), dtype=np.uint64)
    bound = np.bitwise_count(simhash.segment_counts(a) ^ simhash.segment_counts(b))
    assert (bound <= np.bitwise_count(a ^ b)).all()
    counts = [[int(x) >> (2 * s) & 1 for s in range(32)] for x in a[:50]]
    assert len(counts) == 50
    s = simhash.segment_counts(a[:50])
    for x, t in zip(a[:50].tolist(), s.tolist()):
        for k in range(32):
            assert bin(x >> (2 * k) & 3).count("1") == bin(t >> (2 * k) & 3).count("1")


def fingerprint_sample(n=3000):
    rnd = random.Random(4)
    out = set()
    for c in range(40):
        centre = rnd.getrandbits(64)
        for _ in range(n // 40):
            x = centre
            for _ in range(rnd.randint(0, 7)):
                x ^= 1 << rnd.randrange(64)
            out.add(x)
    centre = rnd.getrandbits(64)
    out |= {centre ^ (m << 20) for m in range(64)}
    return sorted(out)


def test_links_find_every_component_also_through_split_cells(spark):
    fps = fingerprint_sample()
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    arr = np.array(fps, np.uint64)
    links = []
    for i in range(len(arr)):
        j = np.flatnonzero(np.bitwise_count(arr[i + 1:] ^ arr[i]) <= 4) + i + 1
        links += [(signed[i], signed[int(k)]) for k in j]
    want = roots(signed, links)
    nodes = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    for limit in (4096, 6):
        found = {r.node: r.root for r in graph.components(simhash.near_links(nodes, 4, limit)).collect()}
        assert {x: found.get(x, x) for x in signed} == want


def test_near_dedup_of_documents(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(90001, None), (90002, ""), (90003, " "), (None, "one two"), (90004, "one two"), (90004, "one two")],
                                  "doc_id bigint, text string")
    rows = docs.union(extra)
    texts = [(r.doc_id, r.text) for r in rows.collect()]
    got = simhash.near_dedup(rows.selectExpr("*", "1 AS fp", "2 AS cell", "3 AS node", "'x' AS component_id")).collect()
    assert len(got) == len(texts)
    fp = {i: brute_fingerprint(t) for i, t in texts}
    ids = sorted(i for i in fp if i is not None)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if bin(fp[a] ^ fp[b]).count("1") <= 4]
    want = roots(ids, links)
    for r in got:
        assert r.fingerprint == f"{fp[r.doc_id]:016x}"
        assert r.component_id == (want[r.doc_id] if r.doc_id is not None else 90004)
    assert simhash.near_dedup(rows.limit(0)).count() == 0
    kept = simhash.one_of_each(rows)
    assert kept.columns == ["doc_id", "text"]
    assert {r.doc_id for r in kept.collect()} - {None} == set(want.values())


def test_components_of_long_paths_and_hubs(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + k) for k in range(1, 400)] + [(2000, 2000), (1399, 5)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = roots({x for l in links for x in l}, links)
    assert got == {k: v for k, v in want.items() if k != 2000}
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def vectors():
    rng = np.random.default_rng(8)
    out = [rng.normal(size=64) for _ in range(400)]
    for k in range(12):  # near copies around some, at all distances
        for s in (0.02, 0.1, 0.2, 0.3):
            out += [out[k] + s * np.linalg.norm(out[k]) / 8 * rng.normal(size=64) for _ in range(10)]
    out += [out[5]] * 40 + [3 * out[5]]
    return [v.astype(np.float32) for v in out]


def test_embeddings_link_as_brute_force(spark):
    vs = vectors()
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vs)]
    odd = [(10_000, None), (10_001, []), (10_002, [0.0] * 64), (10_003, [float("nan")] + [1.0] * 63), (10_004, [None] + [1.0] * 63),
           (10_005, [float("inf")] * 64), (10_006, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1, "c") for i, v in rows + odd], "vec_id bigint, embedding array<float>, label int, cell string")
    m = np.stack(vs).astype(np.float64)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    near = m @ m.T >= 0.95
    np.fill_diagonal(near, False)
    for limit in (4096, 20):
        got = {r.vec_id: r for r in embeddings.near_dedup(df.repartition(4), limit=limit).collect()}
        assert len(got) == len(rows) + len(odd)
        found = sum(got[i].n_links for i in range(len(vs)))
        assert all(got[i].n_links <= near[i].sum() for i in range(len(vs)))  # none below the threshold
        assert found >= 0.95 * near.sum()
        want = roots(range(len(vs)), [(int(a), int(b)) for a, b in zip(*np.nonzero(near)) if a < b])
        same = sum(got[i].component_id == want[i] for i in range(len(vs)))
        assert same >= 0.97 * len(vs)
        for i, _ in odd:
            assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert embeddings.near_dedup(df.limit(0)).count() == 0


def test_embedding_recall_on_the_table(spark):
    got = {r.vec_id: r for r in embeddings.op5_embedding_near_dedup(spark, "/root/testdata/sf0.01").collect()}
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    ids = [r.vec_id for r in rows]
    m = np.array([r.embedding for r in rows], np.float64)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    near = m @ m.T >= 0.95
    np.fill_diagonal(near, False)
    assert sum(got[i].n_links for i in ids) >= 0.9 * near.sum()
    assert all(got[i].n_links <= n for i, n in zip(ids, near.sum(1)))


def test_estimates_are_unbiased_and_bounds_hold():
    rng = np.random.default_rng(5)
    u = rng.normal(size=(300, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    turned, code, factor = embeddings.codes(u)
    sign = (np.unpackbits(code, axis=1).astype(float) * 2 - 1) / 8
    error = sign @ turned.T / factor[:, None] - u @ u.T
    assert abs(error.mean()) < 0.01
    spread = np.sqrt(1 - factor ** 2) / factor / np.sqrt(63)
    assert (np.abs(error) <= 3.5 * spread[:, None]).mean() > 0.995


def test_planted_pairs_of_any_length_are_linked(spark):
    rng = np.random.default_rng(9)
    rows, n = [], 500
    for k, d in enumerate((64, 384, 768)):
        u = rng.normal(size=(n, d))
        u /= np.linalg.norm(u, axis=1, keepdims=True)
        v = rng.normal(size=(n, d))
        v -= (v * u).sum(1, keepdims=True) * u
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        for i, (a, b) in enumerate(zip(u, 0.951 * u + np.sqrt(1 - 0.951 ** 2) * v)):
            at = 10_000 * k + 2 * i
            rows += [(at, a.tolist()), (at + 1, b.tolist())]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = {r.vec_id: r for r in embeddings.near_dedup(df).collect()}
    for i, r in got.items():
        assert (r.component_id, r.n_links) == (i - i % 2, 1)

"""Removal of repeated strings against a dictionary of every 50-byte string."""

import hashlib
import random

import numpy as np
import pytest

from sensorflow.llm import suffixes

W = suffixes.WIDTH


def brute(docs):
    raw = [(suffixes.NO_ID if i is None else i, (t or "").encode()) for i, t in docs]
    least = {}
    for i, t in raw:
        for p in range(len(t) - W + 1):
            s = t[p:p + W]
            least[s] = min(least.get(s, i), i)
    out = []
    for i, t in raw:
        gone = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - W + 1):
            if least[t[p:p + W]] < i:
                gone[p:p + W] = True
        runs = int((np.diff(np.concatenate([[0], gone.view(np.int8)])) == 1).sum())
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((None if i == suffixes.NO_ID else i, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(spark, docs):
    df = docs if not isinstance(docs, list) else spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    s = suffixes.spans(df).collect()
    return sorted(((r.doc_id, r.n_bytes, sum(x.length for x in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest())
                   for r in s), key=repr)


def corpus(rnd, n):
    def prose(k):
        return " ".join("".join(rnd.choices("abcdeé", k=rnd.randrange(1, 8))) for _ in range(k))
    shared = [prose(rnd.randrange(8, 60)) for _ in range(12)]
    docs = []
    for i in range(n):
        parts = [rnd.choice(shared) if rnd.random() < 0.4 else prose(rnd.randrange(1, 30)) for _ in range(rnd.randrange(1, 6))]
        text = rnd.choice(["", " ", "\n"]).join(parts)
        if docs and rnd.random() < 0.2:
            text = rnd.choice(docs)[1]
        if len(text) > 80 and rnd.random() < 0.3:
            k = rnd.randrange(len(text))
            text = text[:k] + "#" + text[k + 1:]
        docs.append((rnd.randrange(10 * n) if rnd.random() < 0.9 else i, text))
    return docs


@pytest.mark.parametrize("small", [False, True])
def test_equal_to_a_dictionary_of_strings(spark, monkeypatch, small):
    if small:  # many chunks, buckets and pieces, and fingerprints beyond 64 bits
        monkeypatch.setattr(suffixes, "CHUNK_BYTES", 900)
        monkeypatch.setattr(suffixes, "BUCKET_ENTRIES", 500)
        monkeypatch.setattr(suffixes, "PIECE", 5)
        monkeypatch.setattr(suffixes, "_more_bits", lambda n: 20)
    docs = corpus(random.Random(11), 150)
    got = found(spark, docs)
    assert got == brute(docs)
    assert sum(r[2] for r in got) > 0


def test_odd_rows(spark):
    """Null and empty texts, a null id, repeated rows and ids, exact width, a very long text, one repeated letter."""
    long = "".join(random.Random(2).choices("abcdefgh ", k=300_000))
    docs = [(1, None), (2, ""), (3, "x" * 49), (4, "x" * 50), (5, "x" * 49), (6, "x" * 200), (6, "x" * 200), (7, "y" * 60), (7, "y" * 60),
            (None, "y" * 55 + "tail"), (None, "y" * 55 + "tail"), (8, "q" + "x" * 50 + "q"), (9, long), (10, "head " + long[100_000:100_050] + " end"),
            (11, "head " + long[100_000:100_049] + " end"), (12, "é" * 25), (13, "z" + "é" * 25)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 AS chunk", "2 AS n_bytes", "'a' AS kept", "3 AS ids")
    assert found(spark, df) == brute(docs)


def test_empty_table(spark):
    assert found(spark, spark.createDataFrame([], "doc_id bigint, text string")) == []


def test_on_the_table(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, suffixes.op12_suffix_dedup(spark, "/root/testdata/sf0.001")
                     .select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=repr)
    assert got == brute(docs)


def test_cover_meets_every_pair_of_places():
    for i in range(suffixes.PERIOD):
        for j in range(suffixes.PERIOD):
            assert any((i + d) % suffixes.PERIOD in suffixes.COVER and (j + d) % suffixes.PERIOD in suffixes.COVER
                       for d in range(suffixes.PERIOD))


def test_fingerprints_depend_on_every_byte():
    rng = np.random.default_rng(3)
    buf = rng.integers(0, 256, 200, dtype=np.uint8)
    for width in (30, 50):
        h = suffixes.fingerprints(buf, width)
        assert len(h) == 200 - width + 1
        for k in (0, 7, 8, 29, width - 1):
            other = buf.copy()
            other[60 + k] ^= 1
            changed = np.flatnonzero(suffixes.fingerprints(other, width) != h)
            assert changed.tolist() == list(range(60 + k - width + 1, 60 + k + 1))[:]


@pytest.mark.parametrize("top", [3, 1 << 20, 1 << 64])
def test_order_is_that_of_a_full_sort(top):
    """Keys with many ties, keys that fit beside an index, keys that share the leading bits kept of them."""
    rng = np.random.default_rng(5)
    key = rng.integers(0, top, 5000, dtype=np.uint64, endpoint=False) if top < 1 << 64 else rng.integers(0, 1 << 64, 5000, dtype=np.uint64)
    near = np.concatenate([key, key ^ np.uint64(1), key[:700], np.array([0, 2 ** 64 - 1], np.uint64)])
    tie = rng.integers(0, 3, len(near))
    for k, t in ((near, tie), (key, tie[:5000]), (key[:1], tie[:1]), (key[:0], tie[:0]), (near, np.zeros(len(near), np.int64))):
        assert suffixes._order(k).tolist() == np.argsort(k, kind="stable").tolist()
        assert suffixes._order(k, t).tolist() == np.lexsort((t, k)).tolist()


def test_fingerprints_of_some_places():
    buf = np.random.default_rng(4).integers(0, 256, 3000, dtype=np.uint8)
    for place in ([0], [2950], [0, 49, 99, 150], [7, 57, 107, 158, 900, 901, 2950], range(2951)):
        place = np.array(place)
        assert suffixes.fingerprints_at(buf, place, W, 2).tolist() == suffixes.fingerprints(buf, W, 2)[place].tolist()


def chunk(texts):
    return suffixes.Chunk(suffixes._packed(np.arange(len(texts))), suffixes._packed(np.array([len(t) for t in texts])),
                          suffixes.zstandard.compress(b"".join(texts)))


def test_answers_are_read_without_asking_again(monkeypatch):
    """The second look at a chunk packs no entries and sorts none that have nothing equal (CPU seconds of op12_suffix_dedup)."""
    c = chunk([random.Random(i).randbytes(4000) for i in range(5)])
    mask = c.suffixes(W)
    full, packed = [], []
    lexsort = np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys, **k: full.append(len(keys[0])) or lexsort(keys, **k))
    monkeypatch.setattr(suffixes, "_packed", lambda x: packed.append(len(x)))
    entries = int(mask.sum())
    for resolve in (suffixes._singles(c, mask, 0, 1)[-1], suffixes._singles(c, mask, 20, 1)[-1]):
        assert not resolve(np.zeros(entries, bool)).any()
    suffixes._pieces(c, mask, 0, 1)
    suffixes._sample(c, 40, 1)
    assert sum(full) == 0
    assert packed == []


def test_removed_runs_end_with_their_document():
    c = chunk([b"", b"abcd", b"", b"efgh", b"ij", b""])
    for covered, spans, kept in (("1111111111", [[], [(0, 4)], [], [(0, 4)], [(0, 2)], []], [b""] * 6),
                                 ("0011100110", [[], [(2, 2)], [], [(0, 1), (3, 1)], [(0, 1)], []], [b"", b"ab", b"", b"fg", b"j", b""]),
                                 ("0000000000", [[]] * 6, [b"", b"abcd", b"", b"efgh", b"ij", b""])):
        got = suffixes._cleaned(c, np.array([x == "1" for x in covered])).to_pylist()
        assert [[(x["start"], x["length"]) for x in r["spans"]] for r in got] == spans
        assert [r["kept"] for r in got] == kept
        assert [(r["doc_id"], r["n_bytes"]) for r in got] == list(enumerate([0, 4, 0, 4, 2, 0]))
    empty = suffixes._cleaned(chunk([b"", b""]), np.zeros(0, bool)).to_pylist()
    assert empty == [{"doc_id": i, "n_bytes": 0, "spans": [], "kept": b""} for i in range(2)]

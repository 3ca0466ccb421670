"""Tokenizer alignment against a walk over every byte."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from sensorflow.llm import alignment

COLS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def tokens(pair, text):
    """(id, bytes) of both tokenizers, one text at a time."""
    if not text:
        return [], []
    a = [(i, pair.bytes_a[i]) for i in pair.a.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, pair.bytes_b[i]) for i in pair.b.encode(text)]
    own = b" " + text.encode()
    return (a, b) if own == b"".join(x for _, x in a) == b"".join(x for _, x in b) else ([], [])


def brute(pair, docs):
    done = []
    for doc_id, text in docs:
        a, b = tokens(pair, text)
        owner = [[k for k, (_, x) in enumerate(t) for _ in x] for t in (a, b)]
        links = sorted(set(zip(*owner)))
        ends = [np.cumsum([len(x) for _, x in t]).tolist() for t in (a, b)]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        parts, s = [], [0, 0]
        for c in cuts:
            e = [x.index(c) + 1 for x in ends]
            parts.append("|".join(",".join(str(i) for i, _ in t[p:q]) for t, p, q in zip((a, b), s, e)))
            s = e
        done.append((doc_id, len(a), len(b), len(cuts), [(a[i][0], b[j][0]) for i, j in links], ";".join(parts)))
    count = Counter(p for d in done for p in set(d[4]))
    best = {}
    for (a, _), n in count.items():
        best[a] = max(best.get(a, 0), n)
    return sorted(((i, na, nb, g, len(ls), sum(count[p] == best[p[0]] for p in ls), sum(count[p] for p in ls),
                    hashlib.sha256(w.encode()).hexdigest() if w else "") for i, na, nb, g, ls, w in done), key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.select(*COLS).collect()), key=repr)


@pytest.fixture(scope="module")
def pair():
    return alignment.Pair(*(open(p, "rb").read() for p in alignment.default_paths()))


ODD = [(1, None), (2, ""), (3, " "), (4, "a"), (4, "a"), (None, "null id"), (5, "<|endoftext|> and </s><s><unk><0x41>"), (6, "mark ▁ here"),
       (7, "▁"), (8, "\x00\x01\x7f tab\t\r\nend  two   three    "), (9, "日本語のテキスト 😀👩‍👩‍👧 é é ﬁ"), (10, "x" * 30_000), (11, "don't we'LL I'm 12345 ...!!!"),
       (12, "\n" * 50), (13, "naïve café über Straße " * 300)]


def test_equal_to_the_walk_over_bytes(spark, pair, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_DOCS", 20)
    rnd = random.Random(8)
    parts = ["the ", "tokens", "ing ", "Überzahl ", "zxqj", "  ", "\n", "1234", " end.", "ñandú", "日本", "'s "]
    docs = ODD + [(100 + i, "".join(rnd.choices(parts, k=rnd.randrange(1, 60)))) for i in range(150)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 AS chunk", "2 AS place", "'x' AS n_a").repartition(3)
    assert rows(alignment.digest(df, alignment.default_paths())) == brute(pair, docs)


def test_ids_are_those_of_the_libraries(spark, pair):
    """Every text of a table, and odd ones, as the libraries encode them whole."""
    every = [t for _, t in ODD if t] + ["a  b", " x", "x ", "  ", "\t x\n\n  y", "it's we'LL 'd'", "x\x1cy\x85z\u2028 w\u3000v\xa0", "٣ ⅷ ½ ² １２",
                                        "Ꙁꙁ \u1e9e \U0001E6D0", "e\u0301 \u0338", "a\u200db", "12ab 3.5e-7,,;"]
    every += [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(400).collect() if r.text]
    a, b = pair.encode(every)
    for t, x, y in zip(every, a, b):
        if "▁" not in t:
            assert x == pair.a.encode(" " + t, add_special_tokens=False).ids and y == pair.b.encode(t)


def test_on_the_table(spark, pair):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert rows(alignment.op13_alignment(spark, "/root/testdata/sf0.001")) == brute(pair, docs)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert rows(alignment.digest(empty, alignment.default_paths())) == []
    assert alignment.groups(empty, alignment.default_paths()).collect() == []


def test_groups_hold_all_tokens(spark, pair):
    got = {r.doc_id: r for r in alignment.groups(spark.createDataFrame(ODD, "doc_id bigint, text string"), alignment.default_paths()).collect()}
    for doc_id, text in ODD:
        a, b = tokens(pair, text)
        r = got[doc_id]
        assert (list(r.a), list(r.b)) == ([i for i, _ in a], [i for i, _ in b])
        assert sum(r.size_a) == len(a) and sum(r.size_b) == len(b) and len(r.size_a) == len(r.size_b)
        at = [0, 0]
        for x, y in zip(r.size_a, r.size_b):
            assert b"".join(t for _, t in a[at[0]:at[0] + x]) == b"".join(t for _, t in b[at[1]:at[1] + y])
            at = [at[0] + x, at[1] + y]


def test_long_runs_are_jumped():
    """Equal ends but for a few places: few probes, and the groups are the common ends."""
    rng = np.random.default_rng(1)
    ends = np.arange(1, 200_001) * 3
    other = np.sort(np.concatenate([np.delete(ends, rng.choice(199_999, 40, replace=False)), ends[rng.choice(199_999, 40, replace=False)] - 1]))
    w = alignment.walk(ends, np.unique(other))
    common = np.intersect1d(ends, other)
    assert (ends[w.closes_a] == common).all() and (np.unique(other)[w.closes_b] == common).all()
    assert len(w.a) == len(np.union1d(ends, other))

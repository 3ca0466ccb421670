"""Ranked lexical search against the formula over all pairs."""

import math
import random
import re
from collections import Counter

import pytest

from sensorflow.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(docs, items, k=10):
    """docs, items: (id, text) rows."""
    split = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    split = [(i, c) for i, c in split if c]
    n_docs, total = len(split), sum(sum(c.values()) for _, c in split)
    df = Counter(t for _, c in split for t in c)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    wanted = {}
    for i, t in set(items):
        wanted.setdefault(i, Counter()).update(TERM.findall((t or "").translate(LOWER)))
    for i, q in wanted.items():
        found = []
        for d, c in split:
            m = 25 + 75 * sum(c.values()) * n_docs // total
            s = sum(x * w[t] * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m)) for t, x in q.items() if t in c)
            if s > 0:
                found.append((-s, (d is None, d)))
        for r, (s, d) in enumerate(sorted(found)[:k], 1):
            out.append((i, r, d[1], -s))
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def random_docs(n, rnd):
    words = ["the", "of", *(f"w{i}" for i in range(60)), "Ärger", "ärger", "naïve", "日本"]
    weight = [40, 25, *(1 + 30 / (i + 1) for i in range(60)), 2, 2, 1, 1]
    return [(i, " ".join(rnd.choices(words, weight, k=rnd.choice([1, 3, 3, 3, 8, 40])))) for i in range(n)]


@pytest.mark.parametrize("block", [7, 1 << 14])
def test_ranking_equals_the_formula(spark, monkeypatch, block):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", block)
    rnd = random.Random(3)
    docs = random_docs(400, rnd)
    items = [(i, t) for i, t in random_docs(25, rnd)]
    got = rows(lexical.search(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5),
                              spark.createDataFrame(items, "item_id bigint, text string")))
    assert got == brute(docs, items)


def test_groups_of_items_give_the_same(spark, monkeypatch):
    rnd = random.Random(5)
    docs, items = random_docs(120, rnd), random_docs(20, rnd)
    monkeypatch.setattr(lexical, "ITEM_ENTRIES", 30)
    got = rows(lexical.search(spark.createDataFrame(docs, "doc_id bigint, text string"),
                              spark.createDataFrame(items, "item_id bigint, text string")))
    assert got == brute(docs, items)


def test_odd_rows(spark):
    """Null and empty texts, null ids, repeated rows, ties, a hot text, a very long text, clashing names."""
    docs = [(1, None, 9), (2, "", 9), (3, "  ,;- ", 9), (4, "Apple pear", 9), (4, "Apple pear", 9), (None, "apple PEAR", 9),
            (5, "apple " * 300_000 + "tail", 9), (6, "a_b [c] x\x00y", 9), (7, "b", 9), *((100 + i, "same old text", 9) for i in range(60))]
    items = [(1, "apple pear apple"), (1, "apple pear apple"), (2, None), (3, ""), (4, "b Y x"), (5, "same"), (None, "tail"), (6, "zzz"),
             (7, "pear"), (7, "old")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string, score int").withColumnRenamed("score", "rank")
    q = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("item_id", "text", "1 AS doc_id", "2 AS term", "3 AS times")
    assert rows(lexical.search(d, q)) == brute([x[:2] for x in docs], items)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    items = spark.createDataFrame([("i", "a")], "item_id string, text string")
    assert rows(lexical.search(docs.limit(0), items)) == []
    assert rows(lexical.search(docs, items.limit(0))) == []
    assert lexical.search(docs, items).schema["item_id"].dataType.simpleString() == "string"


def test_blocks_that_cannot_hold_a_result_are_passed_over(spark, monkeypatch):
    """Long documents cannot beat ten short ones that say nothing but the item's word."""
    monkeypatch.setattr(lexical, "BLOCK_DOCS", 10)
    docs = [(i, "gold") for i in range(10)] + [(100 + i, "gold " + "sand " * 400) for i in range(200)]
    visited = spark.sparkContext.accumulator(0)
    plain = lexical.Best.add

    def add(self, item, score, doc):
        visited.add(len(score))
        return plain(self, item, score, doc)

    monkeypatch.setattr(lexical.Best, "add", add)
    got = lexical.search(spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1),
                         spark.createDataFrame([(1, "gold")], "item_id bigint, text string"))
    assert {r[2] for r in rows(got)} == set(range(10))
    assert 10 <= visited.value < 100  # of 210 documents, in two passes

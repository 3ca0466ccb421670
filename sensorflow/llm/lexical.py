"""Ranked lexical search over a length-stratified index.

Documents with equal normaliser m form a stratum; within it a term's postings lie by
tf, so an impact is a function of (m, tf) and is computed once for each such pair.
The index is a table of blocks: runs of whole or split strata in order of m, at most
``BLOCK_DOCS`` documents each, with every term's greatest impact in the block.

A search visits blocks by bound.  A first pass scores, in every task, an item only in
blocks whose bound beats all blocks the task has seen, which gives each item a floor:
the score of the k-th best document found so far.  The second pass visits the blocks
whose bound reaches the floor or the k-th best score of the task.  No block that can
hold a result is passed over, so the ranking is exact.

The index holds the terms that the items ask for.  Items are taken in groups of about
``ITEM_ENTRIES`` (item, term) entries, each a pass over the documents; that is the bound
of what is broadcast.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorflow.llm.common import stored, table

# Fixed by the contract.
TOP = 10
UNIT = 1_000_000_000

ITEM_ENTRIES = 1 << 18
BLOCK_DOCS, BLOCK_POSTINGS = 1 << 14, 1 << 21
TOKEN_BATCH = 1 << 22  # term occurrences that are counted at once
NO_ID = 2 ** 63 - 1  # place of a document without doc_id: behind all others

# ASCII letters and digits and all other bytes from 128 up belong to terms; A-Z become lower case.
_TERM_BYTES = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text in order, repeats included."""
    return text.translate(_TERM_BYTES).split()


@dataclass
class Items:
    """A group of items: their terms as positions in ``vocabulary``, one item after the other."""

    ids: pa.Array
    vocabulary: list[bytes]
    start: np.ndarray  # item -> first entry, and one end
    term: np.ndarray
    times: np.ndarray
    weight: np.ndarray | None = None  # by term


# items

def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, term, times).  Equal rows count once; rows that share an item_id are one item with the terms of all."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                c = Counter(terms(b.column(1)[i].as_py() or b""))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b.column(0)[i].as_py()] * len(c), b.column(0).type),
                     pa.array(list(c), pa.binary()), pa.array(list(c.values()), pa.int64())],
                    names=["item_id", "term", "times"])

    kind = items.schema[item_id].dataType.simpleString()
    rows = items.select(F.col(item_id).alias("item_id"), F.col(text).cast("binary").alias("text")).distinct()
    return (rows.mapInArrow(split, f"item_id {kind}, term binary, times bigint")
            .groupBy("item_id", "term").agg(F.sum("times").alias("times")))


def item_groups(entries: DataFrame) -> Iterator[Items]:
    """Groups of items whose entries a task can hold."""
    groups = max(1, -(-entries.count() // ITEM_ENTRIES))
    for g in range(groups):
        own = entries.where(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == g).toArrow()
        if own.num_rows:
            yield _items(own)


def _items(own: pa.Table) -> Items:
    ids = own.column("item_id").combine_chunks()
    names = ids.dictionary_encode(null_encoding="encode")
    item = names.indices.to_numpy()
    vocabulary = sorted(set(own.column("term").to_pylist()))
    at = {t: i for i, t in enumerate(vocabulary)}
    term = np.fromiter((at[t] for t in own.column("term").to_pylist()), np.int64, own.num_rows)
    order = np.lexsort((term, item))
    start = np.concatenate([[0], np.cumsum(np.bincount(item, minlength=len(names.dictionary)))])
    return Items(names.dictionary, vocabulary, start, term[order], own.column("times").to_numpy()[order])


# index

def document_terms(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """(doc_id, n, term, tf): per document its number of terms and how often it has those of the vocabulary.

    ``term`` and ``tf`` are packed int32.  Documents without any term are left out.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = {t: i for i, t in enumerate(sent.value)}
        size = len(at)
        for b in batches:
            ids, n, found = [], [], []
            held = 0

            def counted() -> pa.RecordBatch:
                lengths = np.fromiter(map(len, found), np.int64, len(found))
                term = np.fromiter((t for f in found for t in f), np.int64, int(lengths.sum()))
                key, tf = np.unique(np.repeat(np.arange(len(found)), lengths) * size + term, return_counts=True)
                cut = np.searchsorted(key, np.arange(len(found) + 1) * size)
                term, tf = (key % max(size, 1)).astype(np.int32), tf.astype(np.int32)
                return pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(n, pa.int64()),
                     pa.array([term[s:e].tobytes() for s, e in zip(cut[:-1], cut[1:])], pa.binary()),
                     pa.array([tf[s:e].tobytes() for s, e in zip(cut[:-1], cut[1:])], pa.binary())],
                    names=["doc_id", "n", "term", "tf"])

            for doc_id, text in zip(b.column(0), b.column(1)):
                words = terms(text.as_py() or b"")
                if not words:
                    continue
                ids.append(doc_id.as_py())
                n.append(len(words))
                found.append([i for i in map(at.get, words) if i is not None])
                held += len(found[-1])
                if held >= TOKEN_BATCH:
                    yield counted()
                    ids, n, found, held = [], [], [], 0
            if ids:
                yield counted()

    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
            .mapInArrow(count, "doc_id bigint, n bigint, term binary, tf binary"))


def document_frequency(counted: DataFrame, size: int) -> np.ndarray:
    """Documents holding each term of a vocabulary of ``size``."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in batches:
            for t in b.column(0):
                total[np.frombuffer(t.as_py(), np.int32)] += 1
        has = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(has), pa.array(total[has])], names=["term", "n"])

    got = (counted.select("term").mapInArrow(add, "term bigint, n bigint")
           .groupBy("term").agg(F.sum("n").alias("n")).toArrow())
    df = np.zeros(size, np.int64)
    df[got.column("term").to_numpy()] = got.column("n").to_numpy()
    return df


def impact(m: np.ndarray, tf: np.ndarray) -> np.ndarray:
    return (UNIT * tf) // (1000 * tf + 8 * m)


def blocks(counted: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """The index, one row per block of documents in order of m.

    A stratum that is larger than a block is cut by a hash of doc_id, also over tasks.
    """
    m = F.expr(f"25 + (75 * n * {n_docs}L) div {max(n_terms, 1)}L")
    rows = (counted.where(F.length("term") > 0)
            .select(m.alias("m"), F.xxhash64("doc_id").alias("part"), "doc_id", "term", "tf"))
    placed = rows.repartitionByRange("m", "part").sortWithinPartitions("m", "part")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for b in batches:
            for row in zip(*(b.column(i).to_pylist() for i in (0, 2, 3, 4))):
                held.append(row)
                size += len(row[2]) // 4
                if len(held) >= BLOCK_DOCS or size >= BLOCK_POSTINGS:
                    yield _block(held)
                    held, size = [], 0
        if held:
            yield _block(held)

    return placed.mapInArrow(build, "doc_id binary, pair_m binary, pair_tf binary, term binary, start binary, "
                                    "best binary, doc binary, pair binary")


def _block(held: list[tuple]) -> pa.RecordBatch:
    ids = np.array([NO_ID if r[1] is None else r[1] for r in held], np.int64)
    lengths = np.array([len(r[2]) // 4 for r in held])
    doc = np.repeat(np.arange(len(held), dtype=np.int32), lengths)
    term = np.frombuffer(b"".join(r[2] for r in held), np.int32)
    tf = np.frombuffer(b"".join(r[3] for r in held), np.int32).astype(np.int64)
    m = np.array([r[0] for r in held], np.int64)[doc]
    order = np.lexsort((doc, -tf, m, term))  # a term's postings: stratum by stratum, by tf within
    term, doc, tf, m = term[order], doc[order], tf[order], m[order]
    new = np.concatenate([[True], (m[1:] != m[:-1]) | (tf[1:] != tf[:-1])])
    pairs, at = np.unique(np.stack([m[new], tf[new]]), axis=1, return_inverse=True)
    pair = at.ravel()[np.cumsum(new) - 1].astype(np.int32)
    names, start = np.unique(term, return_index=True)
    best = np.maximum.reduceat(impact(pairs[0], pairs[1])[pair], start)
    ends = np.append(start, len(term))
    cols = (ids, pairs[0], pairs[1], names.astype(np.int32), ends, best, doc, pair)
    return pa.RecordBatch.from_arrays(
        [pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in cols],
        names=["doc_id", "pair_m", "pair_tf", "term", "start", "best", "doc", "pair"])


# search

class Best:
    """The k best documents of each item that one task has found."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = [np.empty(0, np.int64)] * n
        self.doc = [np.empty(0, np.int64)] * n
        self.floor = np.ones(n, np.int64)  # a result scores above 0 and at least as much as the k-th best

    def add(self, item: int, score: np.ndarray, doc: np.ndarray) -> None:
        score, doc = np.concatenate([self.score[item], score]), np.concatenate([self.doc[item], doc])
        if len(score) > 4 * self.k:  # cut by score before the exact sort; ties with the k-th stay
            keep = score >= np.partition(score, len(score) - self.k)[len(score) - self.k]
            score, doc = score[keep], doc[keep]
        first = np.lexsort((doc, -score))[:self.k]
        self.score[item], self.doc[item] = score[first], doc[first]
        if len(first) == self.k:
            self.floor[item] = max(self.floor[item], self.score[item][-1])

    def rows(self, ids: pa.Array) -> pa.RecordBatch:
        item = np.repeat(np.arange(len(self.score)), [len(s) for s in self.score])
        doc = np.concatenate([*self.doc, np.empty(0, np.int64)])
        return pa.RecordBatch.from_arrays(
            [ids.take(pa.array(item, pa.int64())), pa.array(doc, pa.int64(), mask=doc == NO_ID),
             pa.array(np.concatenate([*self.score, np.empty(0, np.int64)]), pa.int64())],
            names=["item_id", "doc_id", "score"])


def _search(index: DataFrame, sent, k: int, floors, kind: str) -> DataFrame:
    """Every task's best documents; with ``floors`` the full visit, without them the first pass."""

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = sent.value
        n = len(items.ids)
        best = Best(n, k)
        if floors is not None:
            best.floor = np.maximum(best.floor, floors.value)
        seen = np.zeros(n, np.int64)
        here = np.full(len(items.vocabulary), -1, np.int64)
        for b in batches:
            for r in range(b.num_rows):
                ids, pair_m, pair_tf, names, start, top, doc, pair = (
                    np.frombuffer(b.column(i)[r].as_py(), kind_) for i, kind_ in enumerate(
                        (np.int64, np.int64, np.int64, np.int32, np.int64, np.int64, np.int32, np.int32)))
                here[:] = -1
                here[names] = np.arange(len(names))
                at = here[items.term]
                most = items.times * items.weight[items.term] * np.where(at >= 0, top[at], 0)
                bound = np.add.reduceat(most, items.start[:-1])
                visited = bound >= best.floor
                if floors is None:
                    visited &= bound > seen
                    np.maximum(seen, bound, out=seen)
                if not visited.any():
                    continue
                impacts = impact(pair_m, pair_tf)[pair]
                for i in np.flatnonzero(visited):
                    total = np.zeros(len(ids), np.int64)
                    for e in range(items.start[i], items.start[i + 1]):
                        a = at[e]
                        if a >= 0:  # a document is at most once among a term's postings
                            s, t = start[a], start[a + 1]
                            total[doc[s:t]] += items.times[e] * items.weight[items.term[e]] * impacts[s:t]
                    good = np.flatnonzero(total >= best.floor[i])
                    if len(good):
                        best.add(i, total[good], ids[good])
        yield best.rows(items.ids)

    return index.mapInArrow(visit, f"item_id {kind}, doc_id bigint, score bigint")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    place = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` best rows of ``docs`` with a score above 0.

    Null and empty texts have no terms: such documents are in no result and count nowhere,
    such items have no rows.  Equal scores go by doc_id, a null doc_id last.  Rows of
    ``docs`` with one doc_id are documents of their own.  Equal rows of ``items`` count
    once, rows that share an item_id are one item.  Empty tables give no rows; other
    columns are ignored.
    """
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    entries = stored(item_terms(items), "items")
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    for group in item_groups(entries):
        counted = stored(document_terms(docs, group.vocabulary), "document_terms")
        n_docs, n_terms = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = document_frequency(counted, len(group.vocabulary)).tolist()
        group.weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df], np.int64)
        index = stored(blocks(counted, n_docs, n_terms), "index")
        sent = spark.sparkContext.broadcast(group)
        # at most k rows per item of the group
        first = _ranked(_search(index, sent, k, None, kind), k).where(F.col("rank") == k).select("item_id", "score").toArrow()
        floor = np.ones(len(group.ids), np.int64)
        at = {x: i for i, x in enumerate(group.ids.to_pylist())}
        for x, s in zip(first.column("item_id").to_pylist(), first.column("score").to_pylist()):
            floor[at[x]] = s
        found = stored(_search(index, sent, k, spark.sparkContext.broadcast(floor), kind), "found")
        out = out.unionByName(_ranked(found, k).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    return out


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _sql_terms(key: str, source: str) -> str:
    return (f"SELECT {key}, unnest(regexp_extract_all(translate(text, {_LETTERS}), "
            f"'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM {source}")


ORACLE = f"""
WITH dt AS ({_sql_terms('doc_id', 'documents')}),
it AS (SELECT item_id, term, count(*) AS q FROM ({_sql_terms('item_id', 'benchmark')}) GROUP BY ALL),
d AS (SELECT doc_id, term, count(*) AS tf FROM dt GROUP BY ALL),
n AS (SELECT doc_id, count(*) AS n FROM dt GROUP BY ALL),
tot AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS l FROM n),
w AS (SELECT term, CAST(floor(1000 * ln((2 * (SELECT nn FROM tot) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM d GROUP BY term),
m AS (SELECT doc_id, 25 + (75 * n * nn) // l AS m FROM n, tot),
s AS (SELECT item_id, doc_id, CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM it JOIN d USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY ALL)
SELECT item_id, CAST(r AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r FROM s WHERE score > 0) WHERE r <= 10
"""

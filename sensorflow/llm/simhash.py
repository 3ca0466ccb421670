"""SimHash near-dedup over a segment-popcount embedding.

A 64-bit fingerprint is cut into 32 segments of two bits and mapped to their bit
counts, a point of {0, 1, 2}^32.  The Manhattan distance of two points is at most
the Hamming distance of the fingerprints.  Fingerprints within 4 bits have, in
the upper 16 segments, distance at most 1, or in the lower 16 at most 2; a grid
with unit cells finds both: two points at distance 1 share the point itself or
one step down, two at distance 2 share a point one step away.  Pairs that meet in
a cell are filtered by the whole Manhattan distance and then verified by bits.

Equal fingerprints are one node throughout, so copies are never paired.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.llm.cells import LIMIT, Cols, Links, compare_cells, offset_pairs
from sensorflow.llm.common import stored, table
from sensorflow.llm.graph import components, local_roots

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
EVEN = np.uint64(0x5555555555555555)
ONE = np.uint64(1)
VOTE_ROWS = 1 << 15


def fingerprint(text: bytes, k: int = SHINGLE_WORDS) -> int:
    """Majority vote of the XXH64 bits of all k-word shingles, repeats included; no words: 0."""
    words = text.lower().split()  # bytes: only A-Z change, only \x20 \x09-\x0D part words
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n < k:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    digest = xxhash.xxh64_intdigest
    m = n - k + 1
    h = np.fromiter((digest(joined[s:e - 1], SEED) for s, e in zip(starts, ends[k - 1:])), np.uint64, m)
    votes = np.zeros(64, np.int64)
    for s in range(0, m, VOTE_ROWS):
        part = h[s:s + VOTE_ROWS]
        votes += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(len(part), 64).sum(0, dtype=np.uint32)
    return int(np.packbits(votes * 2 > m, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, k: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) of every row; fp is the 64 bits as a signed bigint.  A null text counts as empty."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py() or b"", k) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
            .mapInArrow(vote, "doc_id bigint, fp bigint"))


def segment_counts(fp: np.ndarray) -> np.ndarray:
    """The embedding, each count 0, 1, 2 written as 00, 01, 11: Manhattan distance is the bits that differ."""
    low, high = fp & EVEN, (fp >> ONE) & EVEN
    return (low | high) | ((low & high) << ONE)


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cell, fp): the grid cells in which a fingerprint can meet its neighbours, 38 on average."""
    for whole in batches:
        for at in range(0, whole.num_rows, 1 << 14):
            b = whole.slice(at, 1 << 14)
            fp = b.column(0).to_numpy().view(np.uint64)
            t = segment_counts(fp)
            cells, fps = [], []
            for half, steps in ((32, "down"), (0, "both")):
                p = (t >> np.uint64(half)) & np.uint64(0xFFFFFFFF)
                mark = np.uint64(half) << np.uint64(32)
                cells.append(p | mark)
                fps.append(fp)
                for seg in range(16):
                    lo, hi = ONE << np.uint64(2 * seg), ONE << np.uint64(2 * seg + 1)
                    for bit, valid in ((lo, (p & hi) == 0), (hi, (p & lo) != 0)):
                        if steps == "down":
                            valid = valid & ((p & bit) != 0)
                        cells.append((p[valid] ^ bit) | mark)
                        fps.append(fp[valid])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(cells).view(np.int64)),
                                              pa.array(np.concatenate(fps).view(np.int64))], names=["cell", "fp"])


def _near(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    ok = np.bitwise_count(segment_counts(a) ^ segment_counts(b)) <= bits  # never more than the Hamming distance
    ok[ok] = np.bitwise_count(a[ok] ^ b[ok]) <= bits
    return ok


def _tied(fp: np.ndarray, a: list[np.ndarray], b: list[np.ndarray]) -> Links:
    """Links between positions of fp as one row per node: the smallest position it is tied to."""
    a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (a, b))
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = nodes[local_roots(len(nodes), at[:len(a)], at[len(a):])] if len(nodes) else nodes
    own = root != nodes
    return fp[nodes[own]].view(np.int64), fp[root[own]].view(np.int64), np.ones(own.sum(), np.int64)


def near_links(nodes: DataFrame, bits: int = MAX_BITS, limit: int = LIMIT) -> DataFrame:
    """(a, b) links whose components are those of all pairs of ``nodes.fp`` within ``bits`` bits."""
    if not 0 <= bits <= 4:
        raise ValueError("the grid covers distances of 0 to 4 bits")

    def runs(cols: Cols, starts: np.ndarray, ends: np.ndarray) -> Links:
        fp = cols["fp"].view(np.uint64)
        a, b, n = [], [], 0
        for i, j in offset_pairs(starts, ends):
            ok = _near(fp[i], fp[j], bits)
            if ok.any():
                a.append(i[ok])
                b.append(j[ok])
                n += len(a[-1])
                if n > 1 << 20:  # keep a forest of what was found so far
                    x, y = np.concatenate(a), np.concatenate(b)
                    root = local_roots(len(fp), x, y)
                    own = np.flatnonzero(root != np.arange(len(fp)))
                    a, b, n = [own], [root[own]], len(own)
        return _tied(fp, a, b)

    def blocks(left: Cols, right: Cols) -> Links:
        x, y = left["fp"].view(np.uint64), right["fp"].view(np.uint64)
        both, a, b = np.concatenate([x, y]), [], []
        for i in range(len(x)):
            j = np.flatnonzero(_near(np.full(len(y), x[i]), y, bits))
            if len(j):
                a.append(np.full(len(j), i))
                b.append(len(x) + j)
        return _tied(both, a, b)

    spots = nodes.select("fp").mapInArrow(_cells, "cell bigint, fp bigint")
    return compare_cells(spots, runs, blocks, limit).select("a", "b")


def near_dedup(docs: DataFrame, k: int = SHINGLE_WORDS, bits: int = MAX_BITS, limit: int = LIMIT) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Texts without words (null, empty, blank) have fingerprint zero and link to
    each other.  component_id is the smallest doc_id of the component, null ids
    left aside.  Repeated rows share a fingerprint.  An empty table gives no
    rows; other columns are ignored.
    """
    marks = stored(fingerprints(docs, k), "fingerprints")
    nodes = stored(marks.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    tied = stored(components(near_links(nodes, bits, limit)), "components")
    own = tied.join(nodes, tied.node == nodes.fp)
    best = stored(own.groupBy("root").agg(F.min("first_id").alias("component_id")), "best")
    named = tied.join(best, "root").select(F.col("node").alias("fp"), "component_id")
    labels = stored(nodes.join(named, "fp", "left")
                    .select("fp", F.coalesce("component_id", "first_id").alias("component_id")), "labels")
    return (marks.join(labels, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, columns as they are, without those whose component bears another doc_id.

    Rows without a doc_id cannot be named as dropped and stay.
    """
    found = near_dedup(docs)
    dropped = found.where("doc_id != component_id").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(docs.columns)


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    return near_dedup(table(spark, sf_dir, "documents"))

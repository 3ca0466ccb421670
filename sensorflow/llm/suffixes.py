"""Removal of repeated byte strings by blockwise suffix sorting with a difference cover.

A suffix matters here by its first ``WIDTH`` bytes.  All suffixes of a corpus are too many
to sort at once, so they are sorted one bucket at a time: a bucket is a range of the
suffixes' fingerprints, its task sorts it and tells every chunk of documents which of its
suffixes have an equal one in a document with a smaller id.  Three rounds of such buckets
keep small what is sorted:

1. Cover sample.  Positions whose place mod 21 lies in a difference cover are sorted by
   the next 30 bytes.  Of any two equal suffixes the same offset, at most 20, is sampled in
   both, so a suffix without a sampled neighbour that is found elsewhere has no equal one.
   Only the others go on; typically a small part of the text.
2. Long ties.  Stretches of such suffixes are cut at places that their bytes choose, and
   whole pieces are sorted as one entry.  A piece that a smaller document has is settled.
3. The suffixes of all other pieces are sorted one by one.  The smallest document that has
   a string always lists it here: its piece cannot be in a smaller one.

Equal entries are told by fingerprints.  In round 1 a chance match only lets a suffix go
on; in rounds 2 and 3 the fingerprint grows with the logarithm of the number of entries, so
that the chance of one false match in the whole corpus stays below 2^-10.

Documents are held in chunks, compressed, in a table bucketed by chunk: answers are joined
to it without moving the texts again.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.llm.common import scratch, stored, table

WIDTH = 50
PERIOD, COVER = 21, (3, 6, 7, 12, 14)  # every difference mod 21 is one of two members
SAMPLE = WIDTH - PERIOD + 1
PIECE = 32  # suffixes in a piece, on average
CHUNK_BYTES, CHUNK_DOCS = 2 << 20, 1 << 15
BUCKET_ENTRIES = 4 << 20
CHUNKS_PER_FILE_BUCKET = 16
SLICE = 1 << 15  # hashed at a time: what stays in a core's own cache
NO_ID = 2 ** 63 - 1

U = np.uint64
_ODD = (U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0xD6E8FEB86659FD93), U(0xA0761D6478BD642F))


# fingerprints

def _join(a: np.ndarray, b: np.ndarray, family: int) -> np.ndarray:
    h = a * _ODD[family]
    h ^= h >> U(32)
    h += b
    h *= _ODD[family + 1]
    h ^= h >> U(29)
    return h


def _eights(buf: np.ndarray, n: int) -> np.ndarray:
    """The 8 bytes from each of the first n places."""
    return np.ndarray(n, U, buf, 0, (1,)).copy()


def fingerprints(buf: np.ndarray, width: int, family: int = 0) -> np.ndarray:
    """A 64-bit value of the ``width`` (16 to 64) bytes from every place that has them."""
    n = len(buf) - width + 1
    if n <= 0:
        return np.empty(0, U)
    out = np.empty(n, U)
    for s in range(0, n, SLICE):
        part = buf[s:min(s + SLICE, n) + width - 1]
        h, have = _eights(part, len(part) - 7), 8
        while have < width:
            step = min(have, width - have)
            h = _join(h[:-step], h[step:], family)
            have += step
        out[s:s + len(h)] = h
    return out


def fingerprints_at(buf: np.ndarray, place: np.ndarray, width: int, family: int = 0) -> np.ndarray:
    """``fingerprints`` of ascending places, without the bytes between that none of them reaches."""
    cut = np.flatnonzero(np.diff(place) >= width) + 1
    start, count = place[np.concatenate([[0], cut])], np.diff(np.concatenate([[0], cut, [len(place)]]))
    end = place[np.append(cut, len(place)) - 1] + width
    near = np.concatenate([buf[s:e] for s, e in zip(start.tolist(), end.tolist())])
    left_out = start - np.cumsum(end - start) + (end - start)
    return fingerprints(near, width, family)[place - np.repeat(left_out, count)]


# sorting

def _order(key: np.ndarray, *ties: np.ndarray) -> np.ndarray:
    """``np.lexsort((*ties, key))``, sorted by value: a word holds a key's leading bits and its index."""
    n = len(key)
    if n < 2:
        return np.arange(n)
    low, index = key.min(), U((n - 1).bit_length())
    drop = U(max(0, int(key.max() - low).bit_length() + int(index) - 64))
    word = (key - low) >> drop << index
    word |= np.arange(n, dtype=U)
    word.sort()
    order = (word & ((U(1) << index) - U(1))).view(np.int64)
    if not drop and not ties:
        return order
    word >>= index
    tied = word[1:] == word[:-1]
    differ = np.zeros(n - 1, bool)
    for x in (key, *ties):
        x = x[order]
        differ |= x[1:] != x[:-1]
    differ &= tied
    if differ.any():  # stretches of one word that are not all alike are sorted in full
        stretch = np.concatenate([[0], np.cumsum(~tied)])
        mixed = np.zeros(stretch[-1] + 1, bool)
        mixed[stretch[1:][differ]] = True
        at = np.flatnonzero(mixed[stretch])
        some = order[at]
        order[at] = some[np.lexsort((*(x[some] for x in ties), key[some]))]
    return order


# packing

def _packed(x: np.ndarray) -> bytes:
    rows = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize)
    raw = np.empty((x.itemsize, len(x)), np.uint8)
    for i in range(x.itemsize):  # many times faster than a transposed copy
        raw[i] = rows[:, i]
    return zstandard.compress(raw.tobytes(), 1)


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(size, -1)
    rows = np.empty((raw.shape[1], size), np.uint8)
    for i in range(size):
        rows[:, i] = raw[i]
    return rows.view(kind).ravel()


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of True."""
    edge = np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _pack_mask(mask: np.ndarray) -> bytes:
    return zstandard.compress(np.packbits(mask).tobytes(), 1)


def _unpack_mask(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zstandard.decompress(data), np.uint8), count=n).view(bool)


# chunks of documents

class Chunk:
    """Documents laid end to end."""

    def __init__(self, ids: bytes, sizes: bytes, text: bytes):
        self.ids = _unpacked(ids, np.int64)
        self.sizes = _unpacked(sizes, np.int64)
        self.buf = np.frombuffer(zstandard.decompress(text), np.uint8)
        self.end = np.cumsum(self.sizes)
        self.start = self.end - self.sizes

    def doc(self, place: np.ndarray) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)[place]

    def suffixes(self, width: int) -> np.ndarray:
        """Whether ``width`` bytes of the same document begin at a place, for places 0 .. len - width."""
        ok = np.ones(max(0, len(self.buf) - width + 1), bool)
        for e in self.end.tolist():
            ok[max(0, e - width + 1):e] = False
        return ok


def chunk_table(docs: DataFrame) -> tuple[DataFrame, int]:
    """The documents in compressed chunks, and their bytes."""
    spark = docs.sparkSession

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        texts: list[bytes] = []
        size, made = 0, 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId() << 32 | made], pa.int64()), pa.array([size], pa.int64()),
                 pa.array([_packed(np.array(ids, np.int64))], pa.binary()),
                 pa.array([_packed(np.array([len(t) for t in texts], np.int64))], pa.binary()),
                 pa.array([zstandard.compress(b"".join(texts), 3)], pa.binary())], names=["chunk", "size", "ids", "sizes", "text"])

        for b in batches:
            for doc_id, text in zip(b.column(0).fill_null(NO_ID).to_pylist(), b.column(1)):
                ids.append(doc_id)
                texts.append(text.as_py() or b"")
                size += len(texts[-1])
                if size >= CHUNK_BYTES or len(ids) >= CHUNK_DOCS:
                    yield row()
                    ids, texts, size, made = [], [], 0, made + 1
        if ids:
            yield row()

    packed = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
              .mapInArrow(pack, "chunk bigint, size bigint, ids binary, sizes binary, text binary"))
    name = f"suffix_chunks_{uuid.uuid4().hex[:12]}"
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    # with fewer buckets than shuffle partitions Spark would deal the texts anew for every join
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / (CHUNK_BYTES * CHUNKS_PER_FILE_BUCKET)))
    (packed.write.bucketBy(files, "chunk").sortBy("chunk").option("path", scratch(spark, name))
     .option("compression", "none").saveAsTable(name))
    return spark.table(name), total


# buckets

ASK = "bucket int, chunk bigint, keys binary, more binary, docs binary"
ASKED = "asked array<struct<bucket:int,keys:binary,more:binary,docs:binary>>"


def _dealt(key: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of sorted keys: buckets are equal ranges of the 64 bits."""
    cut = np.searchsorted(key, (np.arange(1, buckets, dtype=object) * 2 ** 64 // buckets).astype(U)) if buckets > 1 else []
    ends = [0, *np.asarray(cut, np.int64).tolist(), len(key)]
    return [(b, s, e) for b, (s, e) in enumerate(zip(ends, ends[1:])) if e > s]


def _ask(key: np.ndarray, buckets: int, more: np.ndarray | None = None, docs: np.ndarray | None = None) -> list[dict]:
    """Sorted entries of a chunk, bucket by bucket, differences of neighbours packed."""
    return [{"bucket": b, "keys": _packed(np.diff(key[s:e], prepend=U(0))),
             "more": None if more is None else _packed(more[s:e]),
             "docs": None if docs is None else _packed(docs[s:e])} for b, s, e in _dealt(key, buckets)]


def _answers(asks: DataFrame, judge: Callable) -> DataFrame:
    """(chunk, answers): for every asked entry of a chunk, in its order, what the sorted bucket says of it."""

    def work(t: pa.Table) -> pa.Table:
        rows = t.to_pylist()
        keys = [np.cumsum(_unpacked(r["keys"], U), dtype=U) for r in rows]
        more = [_unpacked(r["more"], U) for r in rows if r["more"] is not None]
        docs = [_unpacked(r["docs"], np.int64) for r in rows if r["docs"] is not None]
        size = [len(k) for k in keys]
        verdict = judge(np.concatenate(keys), np.concatenate(more) if more else None, np.concatenate(docs) if docs else None)
        ends = np.cumsum(size)
        return pa.table({"bucket": pa.array([r["bucket"] for r in rows], pa.int32()),
                         "chunk": pa.array([r["chunk"] for r in rows], pa.int64()),
                         "answer": pa.array([_pack_mask(verdict[e - s:e]) for s, e in zip(size, ends)], pa.binary()),
                         "n": pa.array(size, pa.int32())})

    said = asks.groupBy("bucket").applyInArrow(work, "bucket int, chunk bigint, answer binary, n int")
    return said.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("bucket", "answer", "n"))).alias("answers"))


def _elsewhere(key: np.ndarray, more, docs) -> np.ndarray:
    """Entries that another chunk has too; a chunk lists each once."""
    order = _order(key)
    same = key[order][1:] == key[order][:-1]
    out = np.zeros(len(key), bool)
    out[order[1:][same]] = out[order[:-1][same]] = True
    return out


def _earlier(key: np.ndarray, more: np.ndarray | None, docs: np.ndarray) -> np.ndarray:
    """Entries that a document with a smaller id has too."""
    order = _order(key) if more is None else _order(key, more)
    key, docs = key[order], docs[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    if more is not None:
        more = more[order]
        new[1:] |= more[1:] != more[:-1]
    out = np.zeros(len(key), bool)
    out[order] = docs > np.minimum.reduceat(docs, np.flatnonzero(new))[np.cumsum(new) - 1]
    return out


def _said(answers: list | None) -> np.ndarray:
    return np.concatenate([_unpack_mask(a["answer"], a["n"]) for a in answers or []] + [np.empty(0, bool)])


def _buckets(entries: int) -> int:
    return max(1, math.ceil(entries / BUCKET_ENTRIES))


def _more_bits(entries: int) -> int:
    """Bits beyond 64 that keep n entries apart: the chance of a false match among n^2 / 2 pairs below 2^-10."""
    return min(64, max(0, math.ceil(2 * math.log2(max(entries, 2)) + 9 - 64)))


def _entries(c: Chunk, place: np.ndarray, hashes: Callable[[int], np.ndarray], bits: int, buckets: int):
    """What asks for the entries at ``place`` (each distinct one with its smallest document), and what resolves the answers."""
    key, doc = hashes(0), c.ids[c.doc(place)]
    more = hashes(2) >> U(64 - bits) if bits else None
    order = _order(key, more) if bits else _order(key)
    key, doc = key[order], doc[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    if bits:
        more = more[order]
        new[1:] |= more[1:] != more[:-1]
    first = np.flatnonzero(new)
    at = np.cumsum(new) - 1
    least = np.minimum.reduceat(doc, first)

    def resolve(said: np.ndarray) -> np.ndarray:
        out = np.zeros(len(key), bool)
        out[order] = said[at] | (doc > least[at])
        return out

    return lambda: _ask(key[first], buckets, more[first] if bits else None, least), resolve


# the three rounds, seen from a chunk

def _sample(c: Chunk, bits: int, buckets: int):
    """What asks for the cover sample, and its places and what the chunk alone knows."""
    ok = c.suffixes(SAMPLE)
    covered = np.zeros(len(ok), bool)
    for r in COVER:
        covered[r::PERIOD] = True
    place = np.flatnonzero(ok & covered)
    key = (fingerprints(c.buf, SAMPLE)[place] >> U(64 - bits)) << U(64 - bits)
    order = _order(key)
    key, doc = key[order], c.doc(place)[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    first = np.flatnonzero(new)
    at = np.cumsum(new) - 1
    # stable order: a key's entries are in order of place, so its first and last document tell whether there are two
    last = np.append(first[1:], len(key)) - 1
    two = doc[first] != doc[last] if len(first) else np.empty(0, bool)
    return lambda: _ask(key[first], buckets), place[order], at, two


def _open(c: Chunk, places: np.ndarray) -> np.ndarray:
    """Suffixes with one of these samples among the next PERIOD places."""
    ok = c.suffixes(WIDTH)
    before = np.zeros(len(c.buf) + 1, np.int32)
    before[places + 1] = 1
    np.cumsum(before, out=before)
    return ok & (before[PERIOD:PERIOD + len(ok)] > before[:len(ok)])


def _pieces(c: Chunk, mask: np.ndarray, bits: int, buckets: int):
    """What asks for whole pieces of the suffixes in ``mask``, where they begin, and what resolves the answers."""
    place = np.flatnonzero(mask)
    if not len(place):
        return list, place, place, lambda said: np.empty(0, bool)
    cut = np.ones(len(place), bool)
    chosen = (_join(_eights(c.buf, len(c.buf) - 7)[place], U(0), 0) >> U(40)) % U(PIECE) == 0
    doc = c.doc(place)
    cut[1:] = (np.diff(place) > 1) | (np.diff(doc) > 0) | chosen[1:]
    first = np.flatnonzero(cut)
    within = (np.arange(len(place)) - np.repeat(first, np.diff(np.append(first, len(place))))).astype(U)

    def hashes(family: int) -> np.ndarray:
        h = _join(fingerprints_at(c.buf, place, WIDTH, family), within, family)
        return _join(np.add.reduceat(h, first), np.diff(np.append(first, len(place))).astype(U), family)

    ask, resolve = _entries(c, place[first], hashes, bits, buckets)
    return ask, place, first, resolve


def _singles(c: Chunk, mask: np.ndarray, bits: int, buckets: int):
    place = np.flatnonzero(mask)
    if not len(place):
        return list, place, lambda said: np.empty(0, bool)
    ask, resolve = _entries(c, place, lambda family: fingerprints_at(c.buf, place, WIDTH, family), bits, buckets)
    return ask, place, resolve


CLEANED = "doc_id bigint, n_bytes bigint, spans array<struct<start:bigint,length:bigint>>, kept binary"


def _cleaned(c: Chunk, covered: np.ndarray) -> pa.RecordBatch:
    """The documents of a chunk without the covered bytes."""
    border = np.zeros(len(c.buf) + 1, bool)
    border[c.start] = border[c.end] = True
    from_ = covered.copy()
    from_[1:] &= border[1:-1] | ~covered[:-1]
    to = covered.copy()
    to[:-1] &= border[1:-1] | ~covered[1:]
    from_, to = np.flatnonzero(from_), np.flatnonzero(to) + 1
    doc = c.doc(from_)
    ends = [0, *np.cumsum(np.bincount(doc, minlength=len(c.ids))).tolist()]
    spans_ = pa.StructArray.from_arrays([pa.array(from_ - c.start[doc], pa.int64()), pa.array(to - from_, pa.int64())], names=["start", "length"])
    kept = np.concatenate([[0], np.cumsum(~covered)])[np.concatenate([c.start[:1], c.end])].astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(c.ids), pa.array(c.sizes), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans_),
         pa.Array.from_buffers(pa.binary(), len(c.ids), [None, pa.py_buffer(kept), pa.py_buffer(c.buf[~covered])])],
        names=["doc_id", "n_bytes", "spans", "kept"])


# the whole

def _over(df: DataFrame, fn: Callable[[dict], dict | pa.RecordBatch], schema: str) -> DataFrame:
    """``fn`` over each row; a row is a chunk, so a task holds one at a time."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                out = fn(b.slice(i, 1).to_pylist()[0])
                yield out if isinstance(out, pa.RecordBatch) else pa.RecordBatch.from_pylist([out], schema=want)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    want = to_arrow_schema(_parse_datatype_string(schema))
    return df.mapInArrow(work, schema)


def _asks_of(rounds: DataFrame) -> DataFrame:
    return rounds.select("chunk", F.inline("asked")).select("bucket", "chunk", "keys", "more", "docs")


def spans(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row of ``docs``.

    ``spans`` are the maximal runs of bytes covered by ``WIDTH``-byte strings that also begin
    in a document with a smaller doc_id, ``kept`` the other bytes.  A null text counts as
    empty; texts shorter than ``WIDTH`` lose nothing.  Rows that share a doc_id take nothing
    from each other.  A row without doc_id stands behind all others: it loses what they
    have and takes nothing.  An empty table gives no rows; other columns are ignored.
    """
    held, total = chunk_table(docs)
    chunks = held.select("chunk", "ids", "sizes", "text")
    sampled = total * len(COVER) // PERIOD
    # chance matches only cost work here: one sample in 2^10 has one
    bits1 = min(60, 10 + math.ceil(math.log2(max(sampled, 2))))
    buckets1 = _buckets(sampled)

    def chunk(r: dict) -> Chunk:
        return Chunk(r["ids"], r["sizes"], r["text"])

    def first(r: dict) -> dict:
        return {"chunk": r["chunk"], "asked": _sample(chunk(r), bits1, buckets1)[0]()}

    said = _answers(_asks_of(_over(chunks, first, f"chunk bigint, {ASKED}")), _elsewhere)

    def opened(r: dict) -> dict:
        c = chunk(r)
        _, place, at, two = _sample(c, bits1, buckets1)
        mask = _open(c, place[(two | _said(r["answers"]))[at]] if len(place) else place)
        return {"chunk": r["chunk"], "open": _pack_mask(mask), "n": int(mask.sum())}

    open_ = stored(_over(chunks.join(said, "chunk", "left"), opened, "chunk bigint, open binary, n bigint"), "open")
    n = open_.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bits2, buckets2 = _more_bits(n), _buckets(n * 2 // PIECE)

    def second(r: dict) -> dict:
        c = chunk(r)
        mask = _unpack_mask(r["open"], max(0, len(c.buf) - WIDTH + 1))
        return {"chunk": r["chunk"], "asked": _pieces(c, mask, bits2, buckets2)[0]()}

    mine = chunks.join(open_.where("n > 0"), "chunk")
    said = _answers(_asks_of(_over(mine, second, f"chunk bigint, {ASKED}")), _earlier)

    def settled(r: dict) -> dict:
        c = chunk(r)
        mask = _unpack_mask(r["open"], max(0, len(c.buf) - WIDTH + 1))
        _, place, start, resolve = _pieces(c, mask, bits2, buckets2)
        gone = np.repeat(resolve(_said(r["answers"])), np.diff(np.append(start, len(place))))
        mask, rest = np.zeros(len(mask), bool), np.zeros(len(mask), bool)
        mask[place[gone]], rest[place[~gone]] = True, True
        return {"chunk": r["chunk"], "gone": _pack_mask(mask), "rest": _pack_mask(rest), "n": int(rest.sum())}

    left = stored(_over(mine.join(said, "chunk"), settled, "chunk bigint, gone binary, rest binary, n bigint"), "settled")
    buckets3 = _buckets(left.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])

    def third(r: dict) -> dict:
        c = chunk(r)
        return {"chunk": r["chunk"], "asked": _singles(c, _unpack_mask(r["rest"], max(0, len(c.buf) - WIDTH + 1)), bits2, buckets3)[0]()}

    said = _answers(_asks_of(_over(chunks.join(left.where("n > 0"), "chunk"), third, f"chunk bigint, {ASKED}")), _earlier)

    def finished(r: dict) -> pa.RecordBatch:
        c = chunk(r)
        covered = np.zeros(len(c.buf), bool)
        if r["gone"] is not None:
            size = max(0, len(c.buf) - WIDTH + 1)
            mask = _unpack_mask(r["gone"], size).copy()
            _, place, resolve = _singles(c, _unpack_mask(r["rest"], size), bits2, buckets3)
            mask[place[resolve(_said(r["answers"]))]] = True
            at = np.flatnonzero(mask)
            edge = np.zeros(len(c.buf) + 1, np.int32)
            edge[at] += 1
            edge[at + WIDTH] -= 1
            covered = np.cumsum(edge, dtype=np.int32)[:-1] > 0
        return _cleaned(c, covered)

    done = _over(chunks.join(left, "chunk", "left").join(said, "chunk", "left"), finished, CLEANED)
    return done.withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-byte strings that a document with a smaller id has."""
    s = spans(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, x: n + x["length"])
    return s.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
                    F.sha2("kept", 256).alias("kept_sha256"))

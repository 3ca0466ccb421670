"""Alignment of two tokenizers' tokens of the same text, by diagonal run skipping.

Both token sequences of a text spell the same bytes, so they are two rising arrays of
end offsets.  At an index shift (the difference of the two positions) runs of one-to-one
tokens are stretches of equal ends: probes of 4, 16, 64, ... ends at that shift jump them.
Where the ends part, the side that is behind steps on until both meet; every step is a
pair of overlapping tokens, the meeting closes a group, and the shift is what it is then.

The texts of a batch are laid end to end and cut at common ends into lanes that are
walked side by side, so that each probe and each step is one array operation.

Links are counted in three steps: a task writes the distinct pairs of every chunk of
documents with their document numbers, Spark sums them over the corpus, and the sums
meet the chunk again in one sorted stream.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.llm.bpe import byte_letters
from sensorflow.llm.common import stored, table

LANE_TOKENS = 256  # about this many tokens of A in a lane
BATCH_BYTES = 1 << 20  # text that is tokenised and aligned at once
CHUNK_BYTES, CHUNK_DOCS = 16 << 20, 1 << 15

# Fixed value: the split of byte-level BPE.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Letters, digits and spaces of these blocks have been the same in all Unicode versions that the libraries may have.
SETTLED = regex.compile("[\x00-\u052f\u2000-\u206f\u3040-\u30ff\u4e00-\u9fa5\uac00-\ud7a3]*")


class Pair:
    """Two tokenizers: their ids of texts, and the bytes of every token."""

    def __init__(self, spec_a: bytes, spec_b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals the work
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(spec_a.decode())
        self.a.encode_special_tokens = True  # their strings inside texts are plain text
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=spec_b)
        back = {c: n for n, c in enumerate(byte_letters())}
        vocab = json.loads(spec_a)["model"]["vocab"]
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for piece, i in vocab.items():
            self.bytes_a[i] = bytes(back[c] for c in piece)
        self.fast = self._by_ranks(spec_a)
        n = self.b.get_piece_size()
        self.bytes_b = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i)
                        else self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(n)]
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        # decimal ids with what may follow them, for the digest
        self.written_a, self.written_b = (np.array([b"%d%c" % (i, c) for c in seps for i in range(len(t))], object)
                                          for seps, t in ((b",|", self.bytes_a), (b",;", self.bytes_b)))

    def _by_ranks(self, spec_a: bytes):
        """A faster encoder of A's vocabulary, if its ids are the ranks of its merges; else none."""
        import tiktoken

        t = json.loads(spec_a)
        merges = [m if isinstance(m, list) else m.split(" ") for m in t["model"]["merges"]]
        vocab = t["model"]["vocab"]
        pre = t["pre_tokenizer"]
        if (t["normalizer"] is not None or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]
                or [vocab[x + y] for x, y in merges] != list(range(256, 256 + len(merges)))):
            return None
        ranks = {self.bytes_a[i]: i for i in range(256 + len(merges))}
        return tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        """Ids of A; texts with characters that the two libraries may class apart go to the named one."""
        out: list[list[int] | None] = [self.fast.encode_ordinary(t) if self.fast and SETTLED.fullmatch(t) else None for t in texts]
        other = [i for i, ids in enumerate(out) if ids is None]
        for i, e in zip(other, self.a.encode_batch_fast([texts[i] for i in other], add_special_tokens=False)):
            out[i] = e.ids
        return out

    def encode(self, texts: list[str | None]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both, none for a null or empty text or one that a tokenizer changes."""
        a = self.encode_a([" " + t if t else "" for t in texts])
        b = self.b.encode([t or "" for t in texts], num_threads=1)
        for i, t in enumerate(texts):
            own = b" " + t.encode() if t else None
            if own is None or b"".join(map(self.bytes_b.__getitem__, b[i])) != own \
                    or b"".join(map(self.bytes_a.__getitem__, a[i])) != own:
                a[i], b[i] = [], []
        return a, b


@lru_cache(maxsize=1)
def kept_pair(spec_a: bytes, spec_b: bytes) -> Pair:
    return Pair(spec_a, spec_b)


@dataclass
class Walk:
    """Links as positions (a, b) in no order, and for every token whether a group ends with it."""

    a: np.ndarray
    b: np.ndarray
    closes_a: np.ndarray
    closes_b: np.ndarray


def _lanes(ea: np.ndarray, eb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions behind common ends at which lanes begin, and the ends of both arrays."""
    at = np.arange(LANE_TOKENS, len(ea), LANE_TOKENS)
    to = np.searchsorted(eb, ea[at])
    while len(at):
        apart = ea[at] != eb[to]
        if not apart.any():
            break
        at[apart] = np.searchsorted(ea, eb[to[apart]])
        to[apart] = np.searchsorted(eb, ea[at[apart]])
    at = np.unique(np.concatenate([[0], at + 1, [len(ea)]]))
    return at, np.concatenate([[0], np.searchsorted(eb, ea[at[1:] - 1]) + 1])


def walk(ea: np.ndarray, eb: np.ndarray) -> Walk:
    """Aligns two rising arrays of ends whose last ends are equal."""
    closes_a, closes_b = np.zeros(len(ea), bool), np.zeros(len(eb), bool)
    if not len(ea):
        return Walk(np.empty(0, np.int64), np.empty(0, np.int64), closes_a, closes_b)
    at, to = _lanes(ea, eb)
    i, j, end = at[:-1].copy(), to[:-1].copy(), at[1:]
    pad_a, pad_b = np.concatenate([ea, [-1]]), np.concatenate([eb, [-2]])
    out_a: list[np.ndarray] = []
    out_b: list[np.ndarray] = []
    active = np.flatnonzero(i < end)
    while len(active):
        probing, width = active, 4
        while len(probing):  # jump the run at the shift j - i
            steps = np.arange(width)
            x, y = i[probing, None] + steps, j[probing, None] + steps
            inside = x < end[probing, None]
            same = inside & (pad_a[np.minimum(x, len(ea))] == pad_b[np.minimum(y, len(eb))])
            run = np.where(same.all(1), width, same.argmin(1))
            taken = steps < run[:, None]
            x, y = x[taken], y[taken]
            out_a.append(x)
            out_b.append(y)
            closes_a[x] = closes_b[y] = True
            i[probing] += run
            j[probing] += run
            probing = probing[run == width]
            width *= 4
        active = active[i[active] < end[active]]
        apart = active
        while len(apart):  # step on until both ends meet
            out_a.append(i[apart])
            out_b.append(j[apart])
            x, y = ea[i[apart]], eb[j[apart]]
            met = x == y
            closes_a[i[apart[met]]] = closes_b[j[apart[met]]] = True
            i[apart] += x <= y
            j[apart] += y <= x
            apart = apart[~met]
        active = active[i[active] < end[active]]
    return Walk(np.concatenate(out_a), np.concatenate(out_b), closes_a, closes_b)


@dataclass
class Aligned:
    """The texts of one batch, tokens one text after the other."""

    a: np.ndarray
    b: np.ndarray
    doc_a: np.ndarray  # token -> text
    doc_b: np.ndarray
    n: int
    walk: Walk

    def counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of A and of B, groups and links of each text."""
        return (np.bincount(self.doc_a, minlength=self.n), np.bincount(self.doc_b, minlength=self.n),
                np.bincount(self.doc_a[self.walk.closes_a], minlength=self.n),
                np.bincount(self.doc_a[self.walk.a], minlength=self.n))

    def written(self, pair: Pair) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each text, b"" without tokens."""
        ga, gb = (np.cumsum(c) - c for c in (self.walk.closes_a, self.walk.closes_b))
        after_a = np.concatenate([[0], np.flatnonzero(self.walk.closes_a) + 1])
        after_b = np.concatenate([[0], np.flatnonzero(self.walk.closes_b) + 1])
        parts = np.empty(len(self.a) + len(self.b), object)
        parts[np.arange(len(self.a)) + after_b[ga]] = pair.written_a[self.a + len(pair.bytes_a) * self.walk.closes_a]
        parts[np.arange(len(self.b)) + after_a[gb + 1]] = pair.written_b[self.b + len(pair.bytes_b) * self.walk.closes_b]
        whole = parts.tolist()
        n_a, n_b, _, _ = self.counts()
        ends = np.cumsum(n_a + n_b).tolist()
        return [b"".join(whole[s:e])[:-1] for s, e in zip([0, *ends], ends)]


def align(pair: Pair, texts: list[str | None]) -> Aligned:
    ids_a, ids_b = pair.encode(texts)
    sizes = [np.fromiter(map(len, x), np.int64, len(x)) for x in (ids_a, ids_b)]
    a, b = (np.fromiter((i for own in x for i in own), np.int64, int(s.sum())) for x, s in zip((ids_a, ids_b), sizes))
    doc_a, doc_b = (np.repeat(np.arange(len(texts)), s) for s in sizes)
    return Aligned(a, b, doc_a, doc_b, len(texts), walk(np.cumsum(pair.size_a[a]), np.cumsum(pair.size_b[b])))


def _batches(col: pa.Array) -> Iterator[list[str | None]]:
    out, size = [], 0
    for t in col:
        out.append(t.as_py())
        size += len(out[-1] or "")
        if size >= BATCH_BYTES:
            yield out
            out, size = [], 0
    if out:
        yield out


def default_paths() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _with_pair(df: DataFrame, paths: tuple[str, str]):
    specs = []
    for p in paths:  # vocabulary files: their size does not grow with the corpus
        with open(p, "rb") as f:
            specs.append(f.read())
    sent = df.sparkSession.sparkContext.broadcast(tuple(specs))

    def pair() -> Pair:
        from sensorflow.llm import alignment  # the module of the worker process, which keeps the pair
        return alignment.kept_pair(*sent.value)

    return pair


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def groups(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """(doc_id, a, b, size_a, size_b): both token sequences and, group by group, how many of each it takes.

    A null or empty text, or one that a tokenizer does not spell back, has empty arrays.
    """
    pair = _with_pair(docs, paths)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for texts in _batches(b.column(1)):
                x = align(pair(), texts)
                n_a, n_b, n_g, _ = x.counts()
                per = [np.diff(np.concatenate([[-1], np.flatnonzero(c)])) for c in (x.walk.closes_a, x.walk.closes_b)]
                cols = [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(v, pa.int32()))
                        for n, v in ((n_a, x.a), (n_b, x.b), (n_g, per[0]), (n_g, per[1]))]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(texts)), *cols],
                                                 names=["doc_id", "a", "b", "size_a", "size_b"])
                at += len(texts)

    return _texts(docs).mapInArrow(work, "doc_id bigint, a array<int>, b array<int>, size_a array<int>, size_b array<int>")


# counting over the corpus

def _packed(x: np.ndarray) -> bytes:
    """Numbers as planes of bytes, compressed."""
    x = np.ascontiguousarray(x)
    return zstandard.compress(x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes(), 1)


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    raw = zstandard.decompress(data)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).ravel()


DOC_COLS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_pairs")
CHUNK = ("chunk bigint, known array<boolean>, sha array<string>, "
         + ", ".join(f"{c} binary" for c in (*DOC_COLS, "pairs", "docs", "at", "times")))


class _Chunk:
    """Documents whose pairs are listed together: distinct pairs, and per document positions in that list."""

    def __init__(self, ids_b: int):
        self.ids_b = ids_b
        self.cols: dict[str, list] = {c: [] for c in DOC_COLS}
        self.known: list[bool] = []
        self.sha: list[str] = []
        self.pair: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.size = 0

    def add(self, ids: pa.Array, texts: list[str | None], x: Aligned, written: list[bytes]) -> None:
        n_a, n_b, n_groups, n_links = x.counts()
        pair = x.a[x.walk.a] * self.ids_b + x.b[x.walk.b]
        key, times = np.unique((x.doc_a[x.walk.a] << 40) | pair, return_counts=True)
        n_pairs = np.bincount(key >> 40, minlength=x.n)
        self.known += ids.is_valid().to_pylist()
        for name, col in zip(DOC_COLS, (ids.fill_null(0).to_numpy(), n_a, n_b, n_groups, n_links, n_pairs)):
            self.cols[name].append(col)
        self.sha += [hashlib.sha256(w).hexdigest() if w else "" for w in written]
        self.pair.append(key & ((1 << 40) - 1))
        self.times.append(times)
        self.size += sum(len(t or "") for t in texts)

    def full(self) -> bool:
        return self.size >= CHUNK_BYTES or len(self.sha) >= CHUNK_DOCS

    def row(self, chunk: int) -> pa.RecordBatch:
        pairs, at, docs = np.unique(np.concatenate(self.pair), return_inverse=True, return_counts=True)
        data = [np.concatenate(self.cols[c]).astype(np.int64) for c in DOC_COLS]
        data += [np.diff(pairs, prepend=0), docs.astype(np.int32), np.diff(at, prepend=0).astype(np.int32),
                 np.concatenate(self.times).astype(np.int32)]
        return pa.RecordBatch.from_arrays(
            [pa.array([chunk], pa.int64()), pa.array([self.known], pa.list_(pa.bool_())), pa.array([self.sha], pa.list_(pa.string())),
             *(pa.array([_packed(d)], pa.binary()) for d in data)],
            names=["chunk", "known", "sha", *DOC_COLS, "pairs", "docs", "at", "times"])


def chunks(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """One row per chunk of documents: what the digest needs, without tokens or texts."""
    pair = _with_pair(docs, paths)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pair()
        made, size_b = 0, len(own.bytes_b)
        c = _Chunk(size_b)
        for b in batches:
            at = 0
            for texts in _batches(b.column(1)):
                x = align(own, texts)
                c.add(b.column(0).slice(at, len(texts)), texts, x, x.written(own))
                at += len(texts)
                if c.full():
                    yield c.row(TaskContext.get().partitionId() << 32 | made)
                    made, c = made + 1, _Chunk(size_b)
        if c.sha:
            yield c.row(TaskContext.get().partitionId() << 32 | made)

    return _texts(docs).mapInArrow(work, CHUNK)


def pair_counts(chunked: DataFrame) -> DataFrame:
    """(pair, n): in how many documents of the corpus the pair of ids is linked; pair = a * ids of B + b."""
    return _chunk_pairs(chunked).groupBy("pair").agg(F.sum("n").alias("n"))


def _chunk_pairs(chunked: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                pairs = np.cumsum(_unpacked(b.column(1)[i].as_py(), np.int64))
                n = _unpacked(b.column(2)[i].as_py(), np.int32)
                for s in range(0, len(pairs), 1 << 16):
                    part = slice(s, s + (1 << 16))
                    own = np.arange(s, min(s + (1 << 16), len(pairs)), dtype=np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(own), b.column(0)[i].as_py())), pa.array(own), pa.array(pairs[part]), pa.array(n[part])],
                        names=["chunk", "place", "pair", "n"])

    return chunked.select("chunk", "pairs", "docs").mapInArrow(work, "chunk bigint, place int, pair bigint, n int")


OUT = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
       "groups_sha256 string")


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A chunk's row, then its pairs' counts by place, then the next chunk."""
    head, n, best = None, [], []

    def done() -> pa.RecordBatch:
        doc_id, n_a, n_b, n_groups, n_links, n_pairs = (_unpacked(head[c], np.int64) for c in DOC_COLS)
        at = np.cumsum(_unpacked(head["at"], np.int32), dtype=np.int64)
        times = _unpacked(head["times"], np.int32).astype(np.int64)
        count, top = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (n, best))
        end = np.concatenate([[0], np.cumsum(n_pairs)])
        sums = [np.diff(np.concatenate([[0], np.cumsum(v)])[end]) for v in (times * top[at], times * count[at])]
        ids = pa.array(doc_id, pa.int64(), mask=~np.array(head["known"], bool))
        return pa.RecordBatch.from_arrays([ids, *map(pa.array, (n_a, n_b, n_groups, n_links, *sums)), pa.array(head["sha"], pa.string())],
                                          names=[c.split()[0] for c in OUT.split(", ")])

    for b in batches:
        place = b.column("place").to_numpy()
        starts = np.flatnonzero(place < 0)
        ends = [*starts.tolist(), b.num_rows]
        for s, e in zip([0, *(starts + 1).tolist()], ends):
            if e > s:
                n.append(b.column("count").to_numpy(zero_copy_only=False)[s:e])
                best.append(b.column("best").to_numpy(zero_copy_only=False)[s:e])
            if e < b.num_rows:
                if head is not None:
                    yield done()
                head, n, best = b.slice(e, 1).to_pylist()[0], [], []
    if head is not None:
        yield done()


def digest(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """Per row of ``docs`` the sizes of its alignment, how its links stand in the corpus, and a digest of its groups.

    Null and empty texts, and texts that a tokenizer does not spell back, have no tokens:
    zeros and ''.  Rows with one doc_id are documents of their own, also in the counts; a
    null doc_id stays null.  An empty table gives no rows; other columns are ignored.
    """
    chunked = stored(chunks(docs, paths), "aligned")
    ids_b = _size_b(paths)
    counts = stored(pair_counts(chunked), "pair_counts")
    best = counts.groupBy(F.floor(F.col("pair") / ids_b).alias("a")).agg(F.max("n").alias("most"))
    judged = (counts.withColumn("a", F.floor(F.col("pair") / ids_b)).join(best, "a")
              .select("pair", F.col("n").alias("count"), (F.col("n") == F.col("most")).cast("bigint").alias("best")))
    rows = _chunk_pairs(chunked).select("chunk", "place", "pair").join(judged, "pair").select("chunk", "place", "count", "best")
    heads = chunked.select("chunk", F.lit(-1).alias("place"), F.lit(0).cast("bigint").alias("count"), F.lit(0).cast("bigint").alias("best"),
                           "known", "sha", *DOC_COLS, "at", "times")
    both = heads.unionByName(rows, allowMissingColumns=True)
    return both.repartition("chunk").sortWithinPartitions("chunk", "place").mapInArrow(_totals, OUT)


def _size_b(paths: tuple[str, str]) -> int:
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=paths[1]).get_piece_size()


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's byte-level tokens aligned with its sentence pieces."""
    return digest(table(spark, sf_dir, "documents"), default_paths())

"""Language-model scores from a hashed maximum-entropy model with a class-factored softmax.

P(token | history) = P(super-class | history) P(class | super-class, history) P(leaf | class, history) P(token | leaf, history).

All factors are softmaxes over eight outcomes each, at the nodes of a tree over the
tokens; the last one has three of them, below the leaf, down to one of 2^9 spots of a leaf.  Their logits add a bias of the node and hashed features of
the words before: the n-grams (word before) and (two words before, word before), the
skip feature (word two before), and the pair of the words' classes, which rare words
share.  A feature at a node has one row of eight weights in a table, found by hashing
the words themselves; collisions share a row.
Tokens whose hashes agree down to the spot share it by their smoothed counts.  A token
that is not known has the smoothed share of one that occurs no time in its leaf.

Training is distributed gradient descent.  The training texts are dealt into
``ROUNDS`` batches by a hash of the document.  In each round tasks take the gradient
of the batch's texts under the weights so far, Spark sums the rows' gradients, and
the driver moves every row seen by its gradient over its count.  Biases are the
tokens' shares, so that without any feature the model is the base model.

The table has a row for every ``TOKENS_PER_ROW`` training tokens, up to
2^``MOST_BITS`` rows (4 MB): what a task and the driver hold.  Token counts have no
bound: those of the ``HEAD`` most frequent tokens are sent to the tasks, all others
reach the texts by a join on the token, one row for each distinct text and token, with
what its ways below the leaf add if it is known.

Classes follow from the training counts: the most frequent tokens are classes of
their own, other tokens go by their last two bytes, and inside a class by a hash.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.llm.common import drop_path, scratch, stored, table

FOLDS, HELD_OUT = 7, 2
HEAD = 1 << 18
SINGLES, ENDINGS, SPARE = 31, 28, 4  # 63 classes of tokens and the end of a text
WAYS = 8                             # outcomes of a node
CLASSES = WAYS * WAYS
LEAVES = CLASSES * WAYS
NODES = 1 + WAYS + CLASSES           # root, super-classes, classes
PATH_BITS, SPOT_BITS, HASH_BITS = 9, 9, 32
SPOTS = 1 << SPOT_BITS               # below a leaf
END_CLASS, START_HASH = 63, 1        # START_HASH: what stands before a text
LEAST_BITS, MOST_BITS, TOKENS_PER_ROW = 10, 17, 64
ROUNDS, RATE, PRIOR = 12, 0.25, 8.0
LARGEST = 30.0                       # logits are kept within
BLOCK_BYTES = 1 << 21
STRETCH = 1 << 14                    # tokens whose arrays stay in a core's cache
FLUSH_WORDS = 400_000
MEMO_WORDS = 300_000


def ending(word: bytes) -> bytes:
    return word[-2:]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers; wraps around."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    return x


def features(words: tuple[np.ndarray, np.ndarray], classes: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, ...]:
    """Hashed features of histories, given by hash and class of the word two before and the word before:
    word before, word pair, word two before (skip), class pair."""
    def kind(x: np.ndarray, k: int) -> np.ndarray:
        return mix(x * np.uint64(8) + np.uint64(k))

    skip, before = words
    far, near = classes
    return kind(before, 1), mix(kind(before, 2) + skip), kind(skip, 3), kind(far * np.uint64(CLASSES) + near, 4)


def steps(path: np.ndarray) -> Iterator[tuple[np.ndarray | None, np.ndarray, np.ndarray]]:
    """(tokens concerned: None for all, their node, their outcome) on each level; single tokens end at their class."""
    c = path // WAYS
    yield None, np.zeros(len(path), np.int64), c // WAYS
    yield None, 1 + c // WAYS, c % WAYS
    deep = np.flatnonzero((c >= SINGLES) & (c != END_CLASS))
    yield deep, 1 + WAYS + c[deep], path[deep] % WAYS


def deep_steps(path: np.ndarray, spot: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The steps below the leaf, as :func:`steps` gives them."""
    c = path // WAYS
    deep = np.flatnonzero((c >= SINGLES) & (c != END_CLASS))
    leaf, s, first = path[deep], spot[deep], NODES
    for nodes in (1, WAYS, WAYS * WAYS):
        left = SPOTS // nodes  # spots below a node of this level
        yield deep, first + leaf * nodes + s // left, s // (left // WAYS) % WAYS
        first += LEAVES * nodes


def table_rows(found: tuple[np.ndarray, ...], which: np.ndarray | None, node: np.ndarray, bits: int) -> list[np.ndarray]:
    """Rows of the table: each hashed feature at its node.  Leaves hear the word before and the word pair alone."""
    at = mix(node.astype(np.uint64) + np.uint64(1))
    shift, out = np.uint64(64 - bits), []
    for f in found if which is None else found[:2]:
        x = (f if which is None else f[which]) + at
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x >>= shift
        out.append(x.view(np.int64))
    return out


def outcomes(weights: np.ndarray, rows: list[np.ndarray], node: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logits of the eight outcomes, their exponentials and the sum of these; biases stand behind the table."""
    x = weights[1 << bits:].take(node, 0)
    for r in rows:
        x += weights.take(r, 0)
    np.clip(x, -LARGEST, LARGEST, out=x)
    e = np.exp(x)
    return x, e, e @ np.ones(WAYS, e.dtype)


def log_paths(weights: np.ndarray, found: tuple[np.ndarray, ...], path: np.ndarray, bits: int) -> np.ndarray:
    """Natural log-probability of each token's way down to its leaf, by stretches whose arrays stay in the cache."""
    return np.concatenate([np.zeros(0), *(_log_paths(weights, tuple(f[at:at + STRETCH] for f in found), path[at:at + STRETCH], bits)
                                          for at in range(0, len(path), STRETCH))])


def _log_paths(weights: np.ndarray, found: tuple[np.ndarray, ...], path: np.ndarray, bits: int) -> np.ndarray:
    out = np.zeros(len(path))
    for which, node, outcome in steps(path):
        x, _, whole = outcomes(weights, table_rows(found, which, node, bits), node, bits)
        way = x[np.arange(len(node)), outcome] - np.log(whole)
        if which is None:
            out += way
        else:
            out[which] += way
    return out


def log_deep(weights: np.ndarray, found: tuple[np.ndarray, ...], path: np.ndarray, spot: np.ndarray, bits: int) -> np.ndarray:
    """Natural log-probability of each token's way from its leaf to its spot, by stretches as in :func:`log_paths`."""
    out = np.zeros(len(path))
    for at in range(0, len(path), STRETCH):
        own, here = tuple(f[at:at + STRETCH] for f in found), out[at:at + STRETCH]
        for which, node, outcome in deep_steps(path[at:at + STRETCH], spot[at:at + STRETCH]):
            x, _, whole = outcomes(weights, table_rows(own, which, node, bits), node, bits)
            here[which] += x[np.arange(len(node)), outcome] - np.log(whole)
    return out


def add_gradient(g: np.ndarray, n: np.ndarray, weights: np.ndarray, found: tuple[np.ndarray, ...], path: np.ndarray,
                 bits: int, spot: np.ndarray | None = None) -> None:
    """Adds to ``g`` the gradient of the negative log-likelihood of the tokens, and to ``n`` how often each row took part;
    by stretches, as :func:`log_paths` does, added up in the order of the whole block.  With ``spot``, of the steps below
    the leaves as well."""
    # two outcomes at a time: a sum of complex numbers is that of their halves
    pair = np.result_type(g.dtype, np.complex64)
    flat, ways = g.reshape(-1).view(pair), np.arange(WAYS // 2)
    stretches = range(0, len(path), STRETCH)
    own = [tuple(f[at:at + STRETCH] for f in found) for at in stretches]
    for level in zip(*(chain(steps(path[at:at + STRETCH]), () if spot is None else deep_steps(path[at:at + STRETCH], spot[at:at + STRETCH]))
                       for at in stretches)):
        made = []
        for mine, (which, node, outcome) in zip(own, level):
            rows = table_rows(mine, which, node, bits)
            _, d, whole = outcomes(weights, rows, node, bits)
            d /= whole[:, None]
            d[np.arange(len(node)), outcome] -= 1
            made.append((rows, d.reshape(-1).view(pair)))
        n += np.bincount(np.concatenate([r for rows, _ in made for r in rows]), minlength=len(n))
        for feature in range(len(made[0][0])):
            for rows, d in made:
                np.add.at(flat, (rows[feature][:, None] * (WAYS // 2) + ways).reshape(-1), d)


@dataclass
class Model:
    """What scoring needs; its size is bounded by HEAD and MOST_BITS."""

    head: dict[bytes, int]
    head_step: int  # every token of this step of counts or above is in head
    singles: dict[bytes, int]
    endings: dict[bytes, int]
    mass: np.ndarray  # counts plus one of the tokens of each leaf, plus one for unknown ones
    end_count: int
    tokens: int
    kinds: int
    weights: np.ndarray | None = None  # the table, then the biases of the nodes
    spots: np.ndarray | None = None    # counts plus one of the tokens of each spot, LEAVES x SPOTS

    def class_of(self, word: bytes) -> int:
        c = self.singles.get(word)
        if c is None:
            c = self.endings.get(ending(word))
        return SINGLES + ENDINGS + zlib.crc32(ending(word)) % SPARE if c is None else c

    def path_of(self, word: bytes) -> int:
        c = self.class_of(word)
        return c * WAYS + (0 if c < SINGLES else zlib.crc32(word) % WAYS)

    @property
    def bits(self) -> int:
        return min(MOST_BITS, max(LEAST_BITS, (self.tokens // TOKENS_PER_ROW).bit_length() - 1))

    def first_weights(self) -> np.ndarray:
        """No features yet; biases from the shares of leaves, classes and super-classes."""
        w = np.zeros(((1 << self.bits) + NODES, WAYS), np.float32)
        classes = self.mass.reshape(CLASSES, WAYS).sum(1)
        w[1 << self.bits:] = np.log(np.concatenate([classes.reshape(WAYS, WAYS).sum(1)[None], classes.reshape(WAYS, WAYS),
                                                    self.mass.reshape(CLASSES, WAYS)]))
        if self.spots is not None:
            below = [self.spots.reshape(-1, WAYS, left).sum(2) for left in (SPOTS // WAYS, WAYS, 1)]
            with np.errstate(divide="ignore"):  # a way to no token
                deep = np.log(np.concatenate([b / np.maximum(b.max(1, keepdims=True), 1) for b in below]))
            w = np.concatenate([w, np.maximum(deep, -LARGEST).astype(np.float32)])
        w[1 << self.bits:] -= w[1 << self.bits:].max(1, keepdims=True)
        return w

    def log_shares(self) -> np.ndarray:
        """log10 of what a token's count plus one is divided by as its share of its leaf, whatever stands before it;
        single tokens and ends are whole classes."""
        whole = np.arange(LEAVES) // WAYS
        return np.where((whole < SINGLES) | (whole == END_CLASS), 0.0, np.log10(self.mass))

    def log_gain(self, found: tuple[np.ndarray, ...], path: np.ndarray, spot: np.ndarray) -> np.ndarray:
        """log10 of P(token | leaf, history) over that share, for tokens that are known: their ways below the leaf, and
        their part of the spot in place of their part of the leaf.  Nothing for single tokens and ends."""
        c = path // WAYS
        deep = np.flatnonzero((c >= SINGLES) & (c != END_CLASS))
        out = log_deep(self.weights, found, path, spot, self.bits) / math.log(10)
        out[deep] += np.log10(np.maximum(self.mass[path[deep]] - 1, 1)) - np.log10(np.maximum(self.spots[path[deep], spot[deep]], 1))
        return out


class Memo(dict):
    """Hash, path and spot of a word, and whether it is in the head, as one number, kept until there are too many."""

    def __init__(self, model: Model):
        self.model = model

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        spot = zlib.crc32(word) // WAYS % SPOTS | (word in self.model.head) << SPOT_BITS
        c = self[word] = (spot << HASH_BITS | xxhash.xxh32_intdigest(word)) << PATH_BITS | self.model.path_of(word)
        return c


def encode(texts: list[list[bytes]], memo: Memo) -> tuple[tuple[np.ndarray, ...], np.ndarray, np.ndarray]:
    """(features, path, index of its text) of every token of the texts, their ends included."""
    found, path, index, _, _ = encode_spots(texts, memo)
    return found, path, index


def encode_spots(texts: list[list[bytes]], memo: Memo) -> tuple[tuple[np.ndarray, ...], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What :func:`encode` gives, the spot of every token and whether it is in the head."""
    lengths = np.array([len(t) + 3 for t in texts], np.int64)
    start = START_HASH << PATH_BITS | END_CLASS * WAYS  # a text begins where another ended
    codes = []
    for t in texts:
        codes += (start, start)
        codes += map(memo.__getitem__, t)
        codes.append(END_CLASS * WAYS)
    codes = np.fromiter(codes, np.int64, len(codes))
    first = np.cumsum(lengths) - lengths
    token = np.ones(len(codes), bool)
    token[first] = token[first + 1] = False
    at = np.flatnonzero(token)
    hashes = (codes >> PATH_BITS & ((1 << HASH_BITS) - 1)).astype(np.uint64)
    paths = codes & ((1 << PATH_BITS) - 1)
    classes = (paths // WAYS).astype(np.uint64)
    found = features((hashes[at - 2], hashes[at - 1]), (classes[at - 2], classes[at - 1]))
    spots = codes[at] >> PATH_BITS + HASH_BITS
    return found, paths[at], np.repeat(np.arange(len(texts)), lengths - 2), spots % SPOTS, spots >= SPOTS


def blocks(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(place of the first, texts) of runs of whole texts of about BLOCK_BYTES."""
    first, held, size = 0, [], 0
    for i, t in enumerate(column):
        held.append(t.as_py() or b"")
        size += len(held[-1])
        if size >= BLOCK_BYTES or len(held) >= 1000:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def count_tokens(train: DataFrame) -> DataFrame:
    """(word, n) over the texts; the ends of texts are not words and not here."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen.keys()), pa.binary()),
                                               pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

        for b in batches:
            for t in b.column(0):
                seen.update((t.as_py() or b"").lower().split())
                if len(seen) > FLUSH_WORDS:
                    yield out()
                    seen.clear()
        if seen:
            yield out()

    return train.select("text").mapInArrow(work, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def step() -> Column:
    """Counts in steps of about one percent: a few thousand steps at any size."""
    return F.floor(F.log2(F.col("n").cast("double")) * 64)


def classes(counts: DataFrame, texts: int) -> Model:
    """Classes and their totals from the training counts; ``texts``: how many ends there are."""
    # the most frequent tokens by steps of their count: whole steps, as many as HEAD holds
    room, head_step = HEAD, 0
    for r in sorted(counts.groupBy(step().alias("s")).agg(F.count("*").alias("v")).collect(), key=lambda r: -r.s):
        room -= r.v
        if room < 0:
            head_step = r.s + 1
            break
    head = sorted(((bytes(r.word), r.n) for r in counts.where(step() >= head_step).collect()), key=lambda x: (-x[1], x[0]))
    # at most one row for each two-byte ending and outcome
    by_ending = [(bytes(r.e), r.leaf, int(r.n), r.v) for r in counts.groupBy(
        F.substring("word", -2, 2).alias("e"), (F.crc32("word") % WAYS).cast("int").alias("leaf"))
        .agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()]
    singles = {w: i for i, (w, _) in enumerate(head[:SINGLES])}
    left = {(e, leaf): [n, v] for e, leaf, n, v in by_ending}
    mass = np.ones(LEAVES)
    for w, n in head[:SINGLES]:
        spot = left[ending(w), zlib.crc32(w) % WAYS]
        spot[0] -= n
        spot[1] -= 1
        mass[singles[w] * WAYS] += n
    weight: Counter[bytes] = Counter()
    for (e, _), (n, _) in left.items():
        weight[e] += n
    order = sorted(weight, key=lambda e: (-weight[e], e))
    endings = {e: SINGLES + i for i, e in enumerate(order[:ENDINGS])}
    for (e, leaf), (n, v) in left.items():
        mass[endings.get(e, SINGLES + ENDINGS + zlib.crc32(e) % SPARE) * WAYS + leaf] += n + v
    mass[END_CLASS * WAYS] += texts
    return Model(dict(head), head_step, singles, endings, mass, texts, sum(n for _, _, n, _ in by_ending) + texts,
                 sum(v for _, _, _, v in by_ending) + (texts > 0), spots=spot_masses(counts, singles, endings))


def spot_masses(counts: DataFrame, singles: dict[bytes, int], endings: dict[bytes, int]) -> np.ndarray:
    """Counts plus one of the tokens of each spot: at most one row for each of them reaches the driver."""
    end, crc = F.substring("word", -2, 2), F.crc32("word")
    c = F.lit(SINGLES + ENDINGS) + F.crc32(end) % SPARE
    for e, known in endings.items():
        c = F.when(end == F.lit(bytearray(e)), known).otherwise(c)
    rest = counts.where(~F.col("word").isin([bytearray(w) for w in singles])) if singles else counts
    got = (rest.groupBy((c * WAYS + crc % WAYS).cast("int").alias("leaf"),
                        F.expr(f"int(crc32(word) div {WAYS} % {SPOTS})").alias("spot"))
           .agg((F.sum("n") + F.count("*")).cast("double").alias("n")).toArrow())
    out = np.zeros((LEAVES, SPOTS))
    out[got.column("leaf").to_numpy(), got.column("spot").to_numpy()] = got.column("n").to_numpy()
    return out


def batch_gradient(batch: DataFrame, sent: Broadcast) -> DataFrame:
    """(row, n, g0 .. g7): rows of the table that the batch's texts use, their count and summed gradient under a model."""
    sums = [f"g{j}" for j in range(WAYS)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = sent.value
        memo, g, n = Memo(m), np.zeros_like(m.weights), np.zeros(len(m.weights), np.int64)
        for b in batches:
            for _, texts in blocks(b.column(0)):
                found, path, _, spot, _ = encode_spots([t.lower().split() for t in texts], memo)
                add_gradient(g, n, m.weights, found, path, m.bits, spot)
        used = np.flatnonzero(n)
        for at in range(0, len(used), 1 << 16):
            u = used[at:at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(u.astype(np.int32)), pa.array(n[u]),
                                              *(pa.array(np.ascontiguousarray(g[u, j])) for j in range(WAYS))],
                                             names=["row", "n", *sums])

    return (batch.select("text").mapInArrow(work, "row int, n bigint, " + ", ".join(f"{c} float" for c in sums))
            .groupBy("row").agg(F.sum("n").alias("n"), *[F.sum(c).cast("float").alias(c) for c in sums]))


def train_weights(train: DataFrame, model: Model) -> None:
    """One pass over the training texts in ROUNDS batches; each moves every row it uses by gradient over count."""
    spark = train.sparkSession
    model.weights = model.first_weights()
    path = scratch(spark, "batches")
    (train.select("text", F.expr(f"int(pmod(xxhash64(doc_id), {ROUNDS}))").alias("round"))
     .write.partitionBy("round").parquet(path))
    dealt = spark.read.schema("text binary, round int").parquet(path)
    for r in range(ROUNDS):
        sent = spark.sparkContext.broadcast(replace(model, head={}))
        got = batch_gradient(dealt.where(F.col("round") == r), sent).toArrow()
        sent.destroy()
        if not got.num_rows:
            continue
        g = np.stack([got.column(f"g{j}").to_numpy() for j in range(WAYS)], 1)
        # a row's curvature is at most a quarter of its count, and about an eighth
        model.weights[got.column("row").to_numpy()] -= RATE * g / (got.column("n").to_numpy()[:, None] / WAYS + PRIOR).astype(np.float32)
    drop_path(spark, path)


SCORED = ("doc_id bigint, k1 bigint, k2 bigint, word binary, tf bigint, n_tokens bigint, n_known bigint, "
          "base double, score double")


def _score(texts: DataFrame, model: Model) -> DataFrame:
    """Rows of texts (all but their tail tokens) and rows of tail tokens, told apart by ``word``.  The score of a tail
    token is what its occurrences in the text gain below their leaf."""
    sent = texts.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = sent.value
        memo, head, singles, shares = Memo(m), m.head, m.singles, m.log_shares()
        norm = math.log10(m.tokens + m.kinds + 1)
        end = math.log10(m.end_count + 1) - norm
        logs = {w: math.log10(n + 1) for w, n in head.items()}
        seen: set[bytes] = set()
        for whole in batches:
            for at, texts in blocks(whole.column(1)):
                b = whole.slice(at, len(texts))
                split = [t.lower().split() for t in texts]
                found, path, index, spot, known_head = encode_spots(split, memo)
                gain = m.log_gain(found, path, spot)
                ways = log_paths(m.weights, found, path, m.bits) / math.log(10) - shares[path] + np.where(known_head, gain, 0.0)
                scores = np.bincount(index, ways, len(texts)).tolist()
                starts = np.searchsorted(index, np.arange(len(texts) + 1))
                tails = np.flatnonzero(~known_head & (path != END_CLASS * WAYS))
                tail_at = np.searchsorted(tails, starts).tolist()
                places, gains = (tails - starts[index[tails]]).tolist(), gain[tails].tolist()
                keys, rows = [], []
                tail_key, tail_word, tail_n, tail_gain = [], [], [], []
                for i, (text, words, score) in enumerate(zip(texts, split, scores)):
                    key = xxhash.xxh128_digest(text)
                    own = Counter(words)
                    known, base, free = 0, 0.0, 0.0
                    tail = key not in seen
                    if len(seen) >= MEMO_WORDS:
                        seen.clear()  # a text seen before may give its tail again, which is then dropped
                    seen.add(key)
                    gained: Counter[bytes] = Counter()
                    if tail:
                        for at_word in range(tail_at[i], tail_at[i + 1]):
                            gained[words[places[at_word]]] += gains[at_word]
                    for w, n in own.items():
                        x = logs.get(w)
                        if x is not None:
                            known += n
                            base += n * x
                            if w in singles:
                                free += n * x
                        elif tail:
                            tail_key.append(key)
                            tail_word.append(w)
                            tail_n.append(n)
                            tail_gain.append(gained[w])
                    keys.append(key)
                    # a single's share of its class is 1: its count is in the base score only
                    rows.append((len(words) + 1, known + (m.end_count > 0), base - len(words) * norm + end, score + base - free))
                n1, n2 = len(rows), len(tail_n)
                halves = np.frombuffer(b"".join(keys + tail_key), np.int64).reshape(-1, 2)
                cols = list(zip(*rows)) if rows else [(), (), (), ()]
                empty = lambda kind, n: pa.nulls(n, kind)
                yield pa.RecordBatch.from_arrays([
                    pa.concat_arrays([b.column(0), empty(pa.int64(), n2)]), pa.array(halves[:, 0]), pa.array(halves[:, 1]),
                    pa.concat_arrays([empty(pa.binary(), n1), pa.array(tail_word, pa.binary())]),
                    pa.concat_arrays([empty(pa.int64(), n1), pa.array(tail_n, pa.int64())]),
                    *(pa.concat_arrays([pa.array(v, kind), empty(kind, n2)])
                      for v, kind in zip(cols, (pa.int64(), pa.int64(), pa.float64()))),
                    pa.concat_arrays([pa.array(cols[3], pa.float64()), pa.array(tail_gain, pa.float64())])],
                    names=["doc_id", "k1", "k2", "word", "tf", "n_tokens", "n_known", "base", "score"])

    return texts.select("doc_id", "text").mapInArrow(work, SCORED)


def score(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows outside the held-out fold (a null doc_id is in no fold)
    and scores all whole texts.  A null text counts as empty and is scored by its
    end alone.  Equal texts get equal scores up to rounding.  Without training rows every token
    is unknown.  An empty table gives no rows; other columns are ignored.
    """
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT, F.lit(False))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"),
                        held.alias("held_out"))
    train = texts.where("not held_out")
    counts = stored(count_tokens(train), "counts")
    model = classes(counts, train.count())
    train_weights(train, model)
    rows = stored(_score(texts, model), "scored")
    # tail tokens: not among the HEAD most frequent
    tail = rows.where("word is not null").select("word", "k1", "k2", "tf", F.col("score").alias("gain")).dropDuplicates(["word", "k1", "k2"])
    # written, so that the last join, hot where many rows have one text, is between fresh exchanges
    known = stored(tail.join(counts.where(step() < model.head_step), "word").groupBy("k1", "k2")
                   .agg(F.sum("tf").alias("tail_known"), F.sum(F.col("tf") * F.log10(F.col("n") + 1)).alias("tail"),
                        F.sum("gain").alias("tail_gain")), "tail")
    return (rows.where("word is null").join(known, ["k1", "k2"], "left")
            .select("doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT, F.lit(False)).alias("held_out"),
                    "n_tokens", (F.col("n_known") + F.coalesce("tail_known", F.lit(0))).cast("bigint").alias("n_known"),
                    F.lit(model.tokens).cast("bigint").alias("train_tokens"),
                    (F.col("base") + F.coalesce("tail", F.lit(0.0))).alias("base_score"),
                    (F.col("score") + F.coalesce(F.col("tail") + F.col("tail_gain"), F.lit(0.0))).alias("score")))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model score of every document."""
    return score(table(spark, sf_dir, "documents"))

"""Toxicity by a factorization machine over hashed terms.

A text's terms are its words and the beginnings of its words, hashed to 2^24
buckets.  The machine scores a text by a bias, a weight per bucket and the inner
products of the buckets' factors, so a pair such as an insult with the mention of
a group can count for more than the two alone.

It is fitted on at most ``FIT_ROWS`` labelled rows (per class, the first of a
seeded hash order), weighted so that both classes count the same.  The fit keeps every
bucket that ``LEAST_ROWS`` of them have, also one that tells nothing alone: it may in a
pair.  The sample bounds the model; scoring reads every whole text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.llm.common import stored, table

FOLDS, HELD_OUT = 5, 0
FIT_ROWS = {0: 16_000, 1: 8_000}
BUCKET_BITS = 24
MASK = (1 << BUCKET_BITS) - 1
STARTS = (3, 4, 5)  # lengths of word beginnings
LEAST_ROWS = 3
# A bucket tells the labels apart alone if its rows' share of label 1 is this many squared standard errors off the overall share.
STRONG = 20.0
LEAST_STEP = 0.02  # in the pass over all buckets
FACTORS = 4
EPOCHS, BATCH, RATE, DECAY, SEED = 20, 256, 0.03, 1e-4, 7
FACTOR_PACE = 0.1  # factors learn slower than weights: they add what weights cannot say
CACHE_WORDS = 200_000
SCORE_TERMS = 1 << 16  # terms whose texts are scored together

# Letters stay; ASCII punctuation, digits and control characters part words.
_PART = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))


def words(text: str) -> set[bytes]:
    return set(text.lower().encode().translate(_PART).split())


def buckets(word: bytes) -> tuple[int, ...]:
    """Hashed terms of a word: itself and its beginnings."""
    if word.isascii():
        starts = [word[:n] for n in STARTS if len(word) >= n]
    else:
        s = word.decode()
        starts = [s[:n].encode() for n in STARTS if len(s) >= n]
    return (xxhash.xxh64_intdigest(word, 1) & MASK, *(xxhash.xxh64_intdigest(t, 2) & MASK for t in starts))


@dataclass
class Machine:
    """Sorted buckets, a weight and factors for each, and a bias."""

    at: np.ndarray
    weight: np.ndarray
    factor: np.ndarray
    bias: float
    known: dict[bytes, tuple[int, ...]] = field(default_factory=dict)  # terms of words seen by this process

    def raw(self, index: np.ndarray, starts: np.ndarray, n: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of n rows (before the logistic) and their factor sums; ``index`` holds rows' terms one after the other."""
        score, sums = np.full(n, self.bias), np.zeros((n, self.factor.shape[1]))
        if len(index):
            v = self.factor[index]
            s = np.add.reduceat(v, starts)
            score[rows] += np.add.reduceat(self.weight[index], starts) + 0.5 * (
                s * s - np.add.reduceat(v * v, starts)).sum(1)
            sums[rows] = s
        return score, sums

    def score(self, texts: Iterator[str]) -> list[float]:
        """Probability of label 1 for each text."""
        known = self.known
        lookup = {b: i for i, b in enumerate(self.at.tolist())}
        out: list[float] = []
        found: list[list[int]] = []
        held = 0
        for text in texts:
            own: set[int] = set()
            for w in words(text):
                hit = known.get(w)
                if hit is None:
                    if len(known) >= CACHE_WORDS:
                        known.clear()
                    hit = known[w] = tuple(lookup[b] for b in buckets(w) if b in lookup)
                if hit:
                    own.update(hit)
            found.append(sorted(own))
            held += len(own)
            if held >= SCORE_TERMS:
                out += self._probabilities(found)
                found, held = [], 0
        return out + self._probabilities(found)

    def _probabilities(self, found: list[list[int]]) -> list[float]:
        """The same for rows of term positions."""
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        full = np.flatnonzero(sizes)
        index = np.fromiter(chain.from_iterable(found), np.int64, int(sizes.sum()))
        raw, _ = self.raw(index, np.cumsum(sizes[full]) - sizes[full], len(found), full)
        return (1 / (1 + np.exp(-np.clip(raw, -500, 500)))).tolist()


def fit(at: np.ndarray, index: np.ndarray, first: np.ndarray, label: np.ndarray, w: np.ndarray) -> Machine:
    """Fits the machine over the buckets ``at``, first those that tell the labels apart alone, then all.

    Row i has the terms at[index[first[i]:first[i + 1]]], its label and the weight w[i].
    What the first pass explains leaves no gradient, so the many buckets that tell
    nothing learn only from the rows that it cannot explain, such as those of a pair.
    """
    p = float((w * label).sum() / w.sum()) if len(label) else 0.0
    rng = np.random.default_rng(SEED)
    bias = math.log(max(p, 1e-6) / max(1 - p, 1e-6))
    m = Machine(at, np.zeros(len(at)), rng.normal(0, 0.01, (len(at), FACTORS)), bias)
    if not 0 < p < 1 or not len(at):
        return m
    seen, ones = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    for r, y in enumerate(label.tolist()):  # a row has a term once
        own = index[first[r]:first[r + 1]]
        seen[own] += 1
        if y:
            ones[own] += 1
    share = label.mean()
    strong = (ones - seen * share) ** 2 >= STRONG * seen * share * (1 - share)
    if strong.any():
        own = strong[index]
        part = Machine(at[strong], m.weight[strong], m.factor[strong], bias)
        sizes = [np.count_nonzero(own[s:e]) for s, e in zip(first[:-1], first[1:])]
        _descend(part, (np.cumsum(strong, dtype=np.int32) - 1)[index[own]],
                 np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), label, w, rng, 1e-8)
        m.weight[strong], m.factor[strong], m.bias = part.weight, part.factor, part.bias
        del own
    _descend(m, index, first, label, w, rng, LEAST_STEP)
    return m


def _descend(m: Machine, index: np.ndarray, first: np.ndarray, label: np.ndarray, w: np.ndarray,
             rng: np.random.Generator, least: float) -> None:
    """Adam on log loss; row i has the terms index[first[i]:first[i + 1]].  Gradients far below ``least`` move little."""
    n, size = len(label), len(m.at)
    params = np.concatenate([m.weight[:, None], m.factor], 1).astype(np.float32)
    pace = np.array([1.0, *[FACTOR_PACE] * FACTORS], np.float32)
    m1, m2, grad, bias1, bias2, step = np.zeros_like(params), np.zeros_like(params), np.empty_like(params), 0.0, 0.0, 0
    for _ in range(EPOCHS):
        for rows_ in np.array_split(rng.permutation(n), max(1, n // BATCH)):
            step += 1
            sizes = first[rows_ + 1] - first[rows_]
            full = np.flatnonzero(sizes)
            idx = np.concatenate([index[first[r]:first[r + 1]] for r in rows_])  # a few hundred rows at a time
            starts = np.cumsum(sizes[full]) - sizes[full]
            m.weight, m.factor = params[:, 0], params[:, 1:]
            raw, sums = m.raw(idx, starts, len(rows_), full)
            g = w[rows_] * (1 / (1 + np.exp(-np.clip(raw, -50, 50))) - label[rows_]) / len(rows_)
            by = np.repeat(np.arange(len(rows_)), sizes)
            grad[:, 0] = np.bincount(idx, weights=g[by], minlength=size)
            for f in range(FACTORS):
                grad[:, f + 1] = np.bincount(idx, weights=g[by] * (sums[by, f] - m.factor[idx, f]), minlength=size)
            grad += params * (DECAY / max(1, n // BATCH))
            m1 *= 0.9
            m1 += 0.1 * grad
            grad *= grad
            grad *= 0.01
            m2 *= 0.99
            m2 += grad
            np.divide(m2, 1 - 0.99 ** step, out=grad)
            np.sqrt(grad, out=grad)
            grad += least
            np.divide(m1, grad, out=grad)
            grad *= RATE / (1 - 0.9 ** step) * pace
            params -= grad
            gb = float(g.sum())
            bias1, bias2 = 0.9 * bias1 + 0.1 * gb, 0.99 * bias2 + 0.01 * gb * gb
            m.bias -= RATE * (bias1 / (1 - 0.9 ** step)) / (math.sqrt(bias2 / (1 - 0.99 ** step)) + 1e-8)
    m.weight, m.factor = params[:, 0].astype(float), params[:, 1:].astype(float)


def train(docs: DataFrame, labels: DataFrame) -> Machine:
    """The machine of the labelled rows outside the held-out fold; null labels are not rows."""
    usable = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()
                           & (F.crc32(F.col("doc_id").cast("string")) % FOLDS != HELD_OUT))
              .select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")))
    order = F.xxhash64(F.lit(SEED), "doc_id")
    picked = [usable.where(F.col("toxic") == y).orderBy(order, "doc_id").limit(n) for y, n in FIT_ROWS.items()]
    sample = picked[0].union(picked[1])  # at most sum(FIT_ROWS) rows of two numbers

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple[int, ...]] = {}
        for b in batches:
            if len(known) > CACHE_WORDS:
                known.clear()
            found = []
            for t in b.column(2):
                own = words(t.as_py() or "")
                for w in own.difference(known):
                    known[w] = buckets(w)
                found.append(sorted(set().union(*map(known.__getitem__, own))))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.list_(pa.int32()))],
                                             names=["doc_id", "toxic", "terms"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = stored(texts.join(F.broadcast(sample), "doc_id").select("doc_id", "toxic", "text")
                  .mapInArrow(terms, "doc_id bigint, toxic int, terms array<int>"), "terms")
    at = seen_often(rows)
    return fit(at, *_gathered(rows.mapInArrow(_places(at), "doc_id bigint, toxic int, terms array<int>")))


def _gathered(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms, where each row's begin, labels and weights of the fitted rows, in order of doc_id: at most sum(FIT_ROWS) rows.

    The terms stay 4-byte numbers, once: in the order in which they arrive until the rows are put in place.
    """
    got = rows.toArrow()
    order = np.lexsort((got.column("toxic").to_numpy(), got.column("doc_id").to_numpy()))
    label = got.column("toxic").to_numpy().astype(np.int64)[order]
    parts = got.column("terms").chunks
    del got
    sizes = np.concatenate([p.value_lengths().to_numpy() for p in parts] + [np.empty(0, np.int64)]).astype(np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    flat = np.concatenate([p.flatten().to_numpy() for p in parts] + [np.empty(0, np.int32)])
    del parts
    index = np.empty(len(flat), np.int32)
    first = np.concatenate([[0], np.cumsum(sizes[order])])
    for to, r in zip(first.tolist(), order.tolist()):
        index[to:to + sizes[r]] = flat[begins[r]:begins[r + 1]]
    per_class = np.maximum(np.bincount(label, minlength=2), 1)
    return index, first, label, len(label) / (2 * per_class[label])


def seen_often(rows: DataFrame) -> np.ndarray:
    """The buckets that LEAST_ROWS of the rows have, ascending, whichever labels they go with."""
    n, ones = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < ones < n:
        return np.empty(0, np.int64)
    often = (rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n"))
             .where(F.col("n") >= LEAST_ROWS).select("term"))
    return np.sort(often.toArrow().column("term").to_numpy()).astype(np.int64)


def _places(at: np.ndarray):
    """Terms to their positions in ``at``; the others go."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for t in b.column(2):
                terms = np.asarray(t.values)
                place = np.searchsorted(at, terms)
                found.append(place[(place < len(at)) & (at[np.minimum(place, len(at) - 1)] == terms)] if len(at) else [])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.list_(pa.int32()))],
                                             names=["doc_id", "toxic", "terms"])

    return work


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``; a null text counts as empty.

    Nothing but the text is an input.  Repeated rows get equal scores; an empty
    table gives no rows; other columns are ignored.  A null doc_id is in no fold.
    """
    sent = docs.sparkSession.sparkContext.broadcast(machine)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = sent.value.score(t.as_py() or "" for t in b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p, pa.float64())], names=["doc_id", "score"])

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT, F.lit(False))
    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
            .mapInArrow(work, "doc_id bigint, score double")
            .select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))


def clean(docs: DataFrame, machine: Machine) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text the machine does not call toxic."""
    sent = docs.sparkSession.sparkContext.broadcast(machine)

    def toxic(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([p >= 0.5 for p in sent.value.score(t.as_py() or "" for t in texts)], pa.bool_())

    return docs.where(~F.arrow_udf(toxic, "boolean")(F.col("text")))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from the labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))

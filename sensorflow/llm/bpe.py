"""BPE encoding and decoding by speculation and verification.

Greedy longest match proposes the tokens of a word.  A proposal is the word's
BPE encoding exactly if every two neighbouring tokens are what BPE makes of the
two alone: a merge across a boundary would need only what lies on both sides of
it.  All neighbours of all proposed words are checked at once against a table of
pair verdicts; only words with a failing pair undergo exact merging.

The tokenizer's rules (normaliser, split pattern, merges, vocabulary, added
tokens) are read from its file; the driver reads it once and sends its bytes,
whose size is that of the vocabulary, to the tasks.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorflow.llm.common import table

# Words kept with their tokens in a task, and bytes of text whose new words are proposed together.
CACHE_WORDS = 600_000
CHUNK_BYTES = 4 << 20
FAR = regex.compile("[\u0370-\U0010FFFF]")
UNKNOWN = regex.compile(r"\p{Cn}")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 for itself, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class WordBpe:
    """A word-level BPE tokenizer with an end-of-word mark, from its JSON file."""

    def __init__(self, spec: bytes):
        t = json.loads(spec)
        kinds = [n["type"] for n in t["normalizer"]["normalizers"]]
        split, level = t["pre_tokenizer"]["pretokenizers"]
        model = t["model"]
        if (kinds != ["NFC", "Replace", "Lowercase"] or split["type"] != "Split" or not split["invert"]
                or level["type"] != "ByteLevel" or t["decoder"] is not None or model["unk_token"] is not None):
            raise ValueError("not a word-level byte BPE tokenizer of the known kind")
        self.split = regex.compile(split["pattern"]["Regex"])
        self.mark = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {self.vocab[x] << 32 | self.vocab[y]: i for i, (x, y) in enumerate(merges)}
        self.merged = [self.vocab[x + y] for x, y in merges]
        added = {a["content"]: a["id"] for a in t["added_tokens"]}
        self.added = added
        self.added_split = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")")
        size = max([*self.vocab.values(), *added.values()]) + 1
        self.tokens = [""] * size
        for s, i in chain(self.vocab.items(), added.items()):
            self.tokens[i] = s
        self.decimal = [str(i) for i in range(size)]
        self.letters = dict(enumerate(byte_letters()))
        self.spec = spec
        self.library = None
        self.longest = max(map(len, self.vocab))
        self.words: dict[str, tuple[int, ...]] = {}
        self.pair_keys = np.empty(0, np.int64)  # sorted; verdicts beside it
        self.pair_good = np.empty(0, bool)
        self.alone: dict[int, bool] = {}

    # exact merging

    def merge(self, ids: list[int]) -> list[int]:
        """Merges the neighbours of lowest rank, leftmost first, until none can be merged."""
        rank, far = self.rank.get, len(self.merged)
        ranks = [rank(a << 32 | b, far) for a, b in zip(ids, ids[1:])]
        while ranks:
            low = min(ranks)
            if low == far:
                break
            i = ranks.index(low)
            ids[i:i + 2] = [self.merged[low]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = rank(ids[i] << 32 | ids[i + 1], far)
            if i:
                ranks[i - 1] = rank(ids[i - 1] << 32 | ids[i], far)
        return ids

    def symbols(self, letters: str) -> list[int]:
        """Ids of single letters, the last with the end-of-word mark; letters without a token fall away."""
        get = self.vocab.get
        ids = [*map(get, letters[:-1]), get(letters[-1:] + self.mark)]
        return ids if None not in ids else [i for i in ids if i is not None]

    def exact(self, word: str) -> tuple[int, ...]:
        return tuple(self.merge(self.symbols(self.spell(word))))

    # speculation

    def spell(self, word: str) -> str:
        return word if word.isascii() and word.isprintable() else "".join(map(self.letters.__getitem__, word.encode()))

    def propose(self, letters: str) -> list[int]:
        """Greedy longest match; the end-of-word mark counts as part of the last letter."""
        vocab, mark, n, out, i = self.vocab, self.mark, len(letters), [], 0
        while i < n:
            rest = letters[i:i + self.longest]
            if i + len(rest) == n and (hit := vocab.get(rest + mark)) is not None:
                out.append(hit)
                return out
            for e in range(len(rest) - (i + len(rest) == n), 0, -1):
                if (hit := vocab.get(rest[:e])) is not None:
                    out.append(hit)
                    i += e
                    break
            else:
                return []  # a letter without a token: left to exact merging
        return out

    def _parts(self, token: int) -> list[int]:
        s = self.tokens[token]
        return self.symbols(s[:-len(self.mark)]) if s.endswith(self.mark) else list(map(self.vocab.__getitem__, s))

    def _stands(self, *ids: int) -> bool:
        """Whether merging the letters of the tokens ends in these tokens."""
        return self.merge([p for i in ids for p in self._parts(i)]) == [*ids]

    def verdicts(self, keys: np.ndarray) -> np.ndarray:
        """For each left << 32 | right: whether the pair stands; new pairs are tried once and remembered."""
        new = np.setdiff1d(keys, self.pair_keys)
        if len(new):
            good = np.fromiter((self._stands(int(k) >> 32, int(k) & 0xFFFFFFFF) for k in new), bool, len(new))
            both = np.concatenate([self.pair_keys, new])
            order = np.argsort(both, kind="stable")
            self.pair_keys, self.pair_good = both[order], np.concatenate([self.pair_good, good])[order]
        return self.pair_good[np.searchsorted(self.pair_keys, keys)]

    def learn(self, words: list[str]) -> None:
        """Tokens of new words: proposals, one check of all neighbours, exact merging for those that fail."""
        proposed = [self.propose(self.spell(w)) for w in words]
        length = np.fromiter(map(len, proposed), np.int64, len(words))
        ids = np.fromiter(chain.from_iterable(proposed), np.int64, int(length.sum()))
        owner = np.repeat(np.arange(len(words)), length)
        fails = length == 0
        inside = owner[1:] == owner[:-1]
        if inside.any():
            keys = (ids[:-1][inside] << 32) | ids[1:][inside]
            kinds, at = np.unique(keys, return_inverse=True)
            fails[owner[1:][inside][~self.verdicts(kinds)[at]]] = True
        for w in np.flatnonzero(length == 1):
            t = proposed[w][0]
            if t not in self.alone:
                self.alone[t] = self._stands(t)
            fails[w] |= not self.alone[t]
        for w, p, bad in zip(words, proposed, fails.tolist()):
            self.words[w] = self.exact(w) if bad else tuple(p)

    # texts

    def pieces(self, text: str) -> Iterator[tuple[int | None, list[str]]]:
        """(added token, words after it) in order; the first entry has no added token."""
        cut = self.added_split.split(text) if "<" in text else [text]
        for k in range(0, len(cut), 2):
            part = cut[k]
            if FAR.search(part) and UNKNOWN.search(part):
                words = self.newer_pieces(part)
            else:
                # letter by letter: no special case for a sigma at a word's end
                words = self.split.findall(unicodedata.normalize("NFC", part).replace("Σ", "σ").lower())
            yield (self.added[cut[k - 1]] if k else None), words

    def newer_pieces(self, part: str) -> list[str]:
        """Words of a text with characters that Python's tables lack: the tokenizer library's tables have them."""
        from tokenizers import Tokenizer
        self.library = self.library or Tokenizer.from_str(self.spec.decode())
        back = {c: b for b, c in self.letters.items()}
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part))
        return [bytes(map(back.__getitem__, p)).decode() for p, _ in pieces]

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        cut = [list(self.pieces(t)) for t in texts]
        words = self.words
        new = list(set(chain.from_iterable(w for t in cut for _, w in t)).difference(words))
        if len(words) + len(new) > CACHE_WORDS:
            words.clear()
            new = list(set(chain.from_iterable(w for t in cut for _, w in t)))
        self.learn(new)
        for t in cut:
            ids: list[int] = []
            for special, own in t:
                if special is not None:
                    ids.append(special)
                ids.extend(chain.from_iterable(map(words.__getitem__, own)))
            yield ids

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens' strings joined by one space: this tokenizer names no decoder."""
        return " ".join(map(self.tokens.__getitem__, ids))


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _chunks(col: pa.Array) -> Iterator[list[str]]:
    out, size = [], 0
    for t in col:
        text = t.as_py() or ""
        out.append(text)
        size += len(text)
        if size >= CHUNK_BYTES:
            yield out
            out, size = [], 0
    if out:
        yield out


def _with_tokenizer(df: DataFrame, path: str):
    with open(path, "rb") as f:
        sent = df.sparkSession.sparkContext.broadcast(f.read())

    def tokenizer() -> WordBpe:
        # the module as the worker process imports it: words learnt by one task serve the next
        from sensorflow.llm import bpe
        return bpe.kept_tokenizer(sent.value)

    return tokenizer


@lru_cache(maxsize=1)
def kept_tokenizer(spec: bytes) -> WordBpe:
    return WordBpe(spec)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids array<int>) of every row; a null or empty text has no tokens.  Other columns are ignored."""
    tokenizer = _with_tokenizer(docs, path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer()
        for b in batches:
            at = 0
            for texts in _chunks(b.column(1)):
                ids = pa.array(list(bpe.encode(texts)), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(texts)), ids], names=["doc_id", "ids"])
                at += len(texts)

    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(work, "doc_id bigint, ids array<int>"))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded) of (doc_id, ids); null ids count as none."""
    tokenizer = _with_tokenizer(encoded, path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer()
        for b in batches:
            texts = [bpe.decode(i.values.to_pylist() if i.is_valid else ()) for i in b.column(1)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(work, "doc_id bigint, ids array<int>, decoded string")


def digest(docs: DataFrame, path: str) -> DataFrame:
    """Encodes and decodes every row and keeps digests: doc_id, n_tokens, ids_sha256, decoded_sha256.

    The same two steps as ``encode`` and ``decode``, in one pass, so that neither
    ids nor decoded texts leave the task.
    """
    tokenizer = _with_tokenizer(docs, path)

    def sha(s: str) -> str:
        return hashlib.sha256(s.encode()).hexdigest()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer()
        for b in batches:
            n, ids_sha, decoded_sha = [], [], []
            for texts in _chunks(b.column(1)):
                for ids in bpe.encode(texts):
                    n.append(len(ids))
                    ids_sha.append(sha(" ".join(map(bpe.decimal.__getitem__, ids))))
                    decoded_sha.append(sha(bpe.decode(ids)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(work, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded with the public word-level BPE tokenizer."""
    return digest(table(spark, sf_dir, "documents"), default_path())

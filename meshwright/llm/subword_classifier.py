"""Quality classifier: supervised subword embeddings.

Every word, every character n-gram of a word and every pair of neighbouring
words is hashed to a learned vector. A document is the average of its vectors, a
softmax layer gives the class. Vectors and layer are learned by stochastic
gradient descent in numpy on a bounded sample of labelled rows (``sample_rows``,
the lowest by a hash of the key). Since the average is linear, scoring needs
only each vector's share of the class margin: one number per bucket.

A pair of equal words has one bucket for all words, so that repetition is seen.

Cases: null and empty texts have the end-of-text feature only and get its score;
null labels and labels other than 0 and 1 are not learned from; without both
labels the score is 0.5; repeated rows score alike; other columns pass through,
and input columns named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meshwright.llm.common import small_batches

WORDS = regex.compile(r"[^\x20\x09-\x0D]+")
KEPT_WORDS, KEPT_CHARS = 400_000, 20_000_000
END, SAME, FIRST = 0, 1, 2  # the end of a text, a word that follows itself, the first hashed bucket
STEP, OTHER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Shape:
    """``bits``: the binary logarithm of the number of hash buckets; n-grams of ``shortest`` to ``longest`` characters."""

    bits: int = 17
    shortest: int = 3
    longest: int = 5

    @property
    def buckets(self) -> int:
        return FIRST + (1 << self.bits)

    def bucket(self, hashed: np.ndarray) -> np.ndarray:
        mixed = hashed ^ (hashed >> np.uint64(29))
        return (mixed * OTHER >> np.uint64(64 - self.bits)).astype(np.int64) + FIRST


class WordFeatures:
    """Hashed features of a list of words, computed on all their characters at once."""

    def __init__(self, words: list[str], shape: Shape) -> None:
        marked = [f"<{w}>" for w in words]
        codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        lengths = np.fromiter(map(len, marked), np.int64, len(marked))
        starts = np.cumsum(lengths) - lengths
        word = np.repeat(np.arange(len(marked)), lengths)
        left = np.repeat(starts + lengths, lengths) - np.arange(len(codes))  # characters from here to the word's end
        powers = np.cumprod(np.full(lengths.max(initial=0) + 1, STEP, np.uint64), dtype=np.uint64)
        self.own = shape.bucket(np.add.reduceat(codes * powers[left], starts) if len(marked) else codes)
        buckets, owners = [self.own], [np.arange(len(marked))]
        rolled = codes.copy()
        for n in range(2, shape.longest + 1):
            rolled = rolled[:-1] * STEP + codes[n - 1:] if len(rolled) > 1 else rolled[:0]
            if n >= shape.shortest:
                inside = left[:len(rolled)] >= n
                buckets.append(shape.bucket(rolled[inside] + np.uint64(n)))
                owners.append(word[:len(rolled)][inside])
        self.buckets, self.owners = np.concatenate(buckets), np.concatenate(owners)


def pair_buckets(own: np.ndarray, shape: Shape) -> np.ndarray:
    """Buckets of neighbouring words, from the words' own buckets."""
    left, right = own[:-1].astype(np.uint64), own[1:].astype(np.uint64)
    return np.where(left == right, SAME, shape.bucket(left * STEP + right * OTHER + np.uint64(1)))


def features(text: str, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a document and how often each occurs."""
    words = WORDS.findall(text)
    place = {w: k for k, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
    found = WordFeatures(list(place), shape)
    counts = np.bincount(found.buckets, np.bincount(ids, minlength=len(place))[found.owners] if len(ids) else None, shape.buckets)
    counts[END] += 1
    if len(ids) > 1:
        counts += np.bincount(pair_buckets(found.own[ids], shape), minlength=shape.buckets)
    buckets = np.flatnonzero(counts)
    return buckets, counts[buckets]


def train(texts: list[str], labels: list[int], shape: Shape, dimensions: int = 16, epochs: int = 8, least_steps: int = 8000, rate: float = 0.5,
          seed: int = 7) -> np.ndarray:
    """Each bucket's share of the margin of class 1 over class 0.

    Few rows are passed more often, so that there are ``least_steps`` steps.
    """
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dimensions, 1 / dimensions, (shape.buckets, dimensions)).astype(np.float32)
    output = np.zeros((2, dimensions), np.float32)
    if len(set(labels)) < 2:
        return np.zeros(shape.buckets, np.float32)
    rows = []
    for text in texts:
        buckets, counts = features(text, shape)
        rows.append((buckets.astype(np.int32), (counts / counts.sum()).astype(np.float32)))
    epochs = max(epochs, -(-least_steps // len(rows)))
    steps, step = epochs * len(rows), 0
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            buckets, weights = rows[k]
            chosen = vectors[buckets]
            hidden = weights @ chosen
            margin = output @ hidden
            chance = np.exp(margin - margin.max())
            chance /= chance.sum()
            chance[labels[k]] -= 1
            now = np.float32(rate * (1 - step / steps))
            back = chance @ output
            output -= now * np.outer(chance, hidden)
            # Rare features move as far as their weight times the number of features, as if each occurrence stepped alone.
            vectors[buckets] = chosen - (now * np.minimum(weights * len(buckets), 8))[:, None] * back
            step += 1
    return (vectors @ (output[1] - output[0])).astype(np.float32)


class Scorer:
    """Scores batches of texts. Words already seen are kept, up to a bound."""

    def __init__(self, shares: np.ndarray, shape: Shape) -> None:
        self.shares, self.shape = shares.astype(np.float64), shape
        self.reset()

    def reset(self) -> None:
        self.place: dict[str, int] = {}
        self.chars = 0
        self.sums, self.sizes, self.own = np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn_words(self, words: list[str]) -> None:
        found = WordFeatures(words, self.shape)
        self.sums = np.concatenate([self.sums, np.bincount(found.owners, self.shares[found.buckets], len(words))])
        self.sizes = np.concatenate([self.sizes, np.bincount(found.owners, minlength=len(words))])
        self.own = np.concatenate([self.own, found.own])
        self.place.update(zip(words, range(len(self.place), len(self.place) + len(words)), strict=True))
        self.chars += sum(map(len, words))

    def scores(self, texts: list[str]) -> list[float]:
        if len(self.place) > KEPT_WORDS or self.chars > KEPT_CHARS:
            self.reset()
        split = [WORDS.findall(t) for t in texts]
        new = list(set(chain.from_iterable(split)).difference(self.place))
        if new:
            self.learn_words(new)
        return list(map(self._score, split))

    def _score(self, words: list[str]) -> float:
        ids = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        total, size = self.shares[END] + self.sums[ids].sum(), 1 + int(self.sizes[ids].sum())
        if len(ids) > 1:
            total += self.shares[pair_buckets(self.own[ids], self.shape)].sum()
            size += len(ids) - 1
        return float(1 / (1 + np.exp(-np.clip(total / size, -60, 60))))


def training_rows(docs: DataFrame, labels: DataFrame, learn_from: Column, sample_rows: int, key: str = "doc_id",
                  text: str = "text", label: str = "quality") -> tuple[list[str], list[int]]:
    """At most ``sample_rows`` labelled texts where ``learn_from`` holds, the lowest by a hash of the key."""
    marked = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("__key"), F.col(label).alias("__label"))
    order = F.xxhash64("__key")
    chosen = marked.where(learn_from).orderBy(order, "__key", "__label").limit(sample_rows)
    rows = (docs.select(F.col(key).alias("__id"), F.col(text).alias("__text")).join(F.broadcast(chosen), F.col("__id") == F.col("__key"))
            .orderBy(order, "__key", "__label", "__text").limit(sample_rows).select("__text", "__label").collect())
    return [r[0] or "" for r in rows], [r[1] for r in rows]


def fit(docs: DataFrame, labels: DataFrame, learn_from: Column, sample_rows: int = 4000, shape: Shape | None = None) -> np.ndarray:
    """The model: one number per bucket. ``learn_from`` is a condition on ``__key``."""
    shape = shape or Shape()
    return train(*training_rows(docs, labels, learn_from, sample_rows), shape)


def score(frame: DataFrame, shares: np.ndarray, text: str = "text", output: str = "score", shape: Shape | None = None) -> DataFrame:
    """``frame`` with the chance of class 1 of each whole text."""
    shape = shape or Shape()
    model = frame.sparkSession.sparkContext.broadcast(shares)
    kept = [f.name for f in frame.schema if f.name.lower() != output.lower()]
    schema = T.StructType([*[f for f in frame.schema if f.name in kept], T.StructField(output, T.DoubleType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.value, shape)
        for batch in small_batches(batches, text):
            found = scorer.scores([x or "" for x in batch.column(text).to_pylist()])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(found, pa.float64())], names=[*kept, output])

    return frame.mapInArrow(work, schema)

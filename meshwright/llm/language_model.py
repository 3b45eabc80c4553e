"""LM scoring: a hashed maximum-entropy model with class-factored softmax.

P(word | context) = P(class | context) P(leaf | class, context) P(word | leaf).
The first two factors are softmax layers over hashed features: the previous
word, the previous two words, and the word before the previous one (a skip
feature), with a bias. The last is the word's share of its leaf.

Counts of all training tokens come from the whole corpus. Words with at least
one in ``head`` tokens, which are at most ``head`` words, get a class by the
company they keep (clusters of what precedes them) and a leaf by frequency. All
rarer words share one class, and their share of it comes from a join with the
counts. The end of a text is a class of its own.

Training goes over all training texts in ``rounds`` slices. In each, every task
runs mini-batch gradient steps from the current weights, and the tasks' updates
are averaged by their tokens, block of the weights by block.

Cases: null and empty texts have the end token only; words that training never
saw count as c = 0 and share the rare class; without training texts the layers
stay uniform; rows equal in id and text score alike; other columns of the input
are not used, and the result has its own columns only.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshwright.llm.common import small_batches
from meshwright.session import cut

END = b""  # no word is empty, so the empty word stands for the end of a text
CLASSES, LEAVES = 32, 32
RARE, STOP = CLASSES - 1, CLASSES - 2
CLUSTERS = CLASSES - 2
COMPANY = 16
ROWS_1, ROWS_2 = 1 << 14, 1 << 15
BATCH_TOKENS = 8192
BLOCK = 512  # rows of the weights that are averaged together
COUNTED_WORDS = 1_000_000
LOG_STEPS = 2.0 ** 32  # logarithms in whole steps: sums of doubles stay exact in any order, so equal texts score alike


def tokens_of(text: str | None) -> list[bytes]:
    """Words between ASCII spaces, A-Z lower-cased (bytes.lower and bytes.split do just that), then the end."""
    return [*(text or "").encode().lower().split(), END]


def count_tokens(texts: DataFrame) -> DataFrame:
    """(token, c) over all rows of ``texts``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(counts.values(), pa.int64())], names=["token", "c"])
            counts.clear()
            return out

        for batch in small_batches(batches, "text"):
            for text in batch.column("text").to_pylist():
                counts.update(tokens_of(text))
            if len(counts) > COUNTED_WORDS:
                yield flush()
        yield flush()

    return texts.mapInArrow(work, "token binary, c bigint").groupBy("token").agg(F.sum("c").alias("c"))


class Vocabulary(dict):
    """Number of each head word; all others have the number ``rare``."""

    def __init__(self, words: list[bytes]) -> None:
        super().__init__(zip(words, range(len(words)), strict=True))
        self.rare = len(words)


@dataclass
class Model:
    vocabulary: Vocabulary
    counts: np.ndarray  # of head words
    kind: np.ndarray  # class by word number, the rare number last
    leaf: np.ndarray
    share: np.ndarray  # log10 of the word's share of its leaf
    tokens: int  # N
    distinct: int  # V
    rare_tokens: int
    rare_distinct: int
    first: np.ndarray  # ROWS_1 x CLASSES
    second: np.ndarray  # ROWS_2 x LEAVES
    used: np.ndarray  # CLASSES x LEAVES: which leaves exist

    def blocks(self) -> np.ndarray:
        return np.concatenate([self.first.ravel(), self.second.ravel()]).reshape(-1, BLOCK * CLASSES)


def numbers(vocabulary: Vocabulary, split: list[list[bytes]], size: int) -> np.ndarray:
    return np.fromiter(map(vocabulary.get, chain.from_iterable(split), repeat(vocabulary.rare)), np.int64, size)


def read_ids(model: Model, texts: list[str | None]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Tokens, their numbers on end, and where each text starts."""
    split = [tokens_of(t) for t in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    return split, numbers(model.vocabulary, split, int(sizes.sum())), np.cumsum(sizes) - sizes


def context(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hashes of the features of each token: previous, previous two, skip."""
    one, two = np.empty_like(ids), np.empty_like(ids)
    one[1:], two[2:] = ids[:-1], ids[:-2]
    one[starts] = -1
    two[starts] = -1
    two[starts[starts + 1 < len(ids)] + 1] = -1
    if len(ids) > 1 and len(starts):
        two[1] = -1
    a, b = one.astype(np.uint64), two.astype(np.uint64)
    odd = np.uint64(0x9E3779B97F4A7C15)
    mix = lambda x: (x ^ (x >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return np.stack([mix(a * odd + np.uint64(1)), mix((a * odd + b) * odd + np.uint64(2)), mix(b * odd + np.uint64(3))])


def rows_1(features: np.ndarray) -> np.ndarray:
    """Rows of the class layer; row 0 is the bias."""
    return (features >> np.uint64(40)).astype(np.int64) % (ROWS_1 - 1) + 1


def rows_2(features: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Rows of the leaf layer: features together with the class; the first rows are the classes' biases."""
    mixed = (features + kind.astype(np.uint64)[None, :]) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(40)).astype(np.int64) % (ROWS_2 - CLASSES) + CLASSES


def softmax(margins: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Natural log of the chance at ``at``, and all chances."""
    margins -= margins.max(1, keepdims=True)
    chances = np.exp(margins)
    sums = chances.sum(1)
    told = margins[np.arange(len(at)), at] - np.log(sums)
    chances /= sums[:, None]
    return told, chances


def layers(model: Model, features: np.ndarray, kind: np.ndarray, leaf: np.ndarray):
    """Of a batch: (rows, told, chances) of the class layer, and the same with ``which`` tokens of the leaf layer."""
    rows = rows_1(features)
    margins = model.first.take(rows[0], 0)  # take copies rows much faster than indexing
    margins += model.first.take(rows[1], 0)
    margins += model.first.take(rows[2], 0)
    margins += model.first[0]
    margins[:, ~model.used.any(1)] = -1e30  # a class without words
    told, chances = softmax(margins, kind)
    which = np.flatnonzero(kind < CLUSTERS)
    rows2 = rows_2(features[:, which], kind[which])
    margins = model.second.take(rows2[0], 0)
    margins += model.second.take(rows2[1], 0)
    margins += model.second.take(rows2[2], 0)
    # Bias, and no chance for leaves without words.
    margins += np.where(model.used, model.second[:CLASSES], np.float32(-1e30)).take(kind[which], 0)
    told2, chances2 = softmax(margins, leaf[which])
    return (rows, told, chances), (rows2, told2, chances2, which)


def step(weights: np.ndarray, seen: np.ndarray, rows: np.ndarray, slope: np.ndarray, rate: float) -> None:
    """One gradient step on the rows of each feature, scaled by what each row has seen."""
    for feature in rows:
        order = np.argsort(feature.astype(np.uint16), kind="stable")
        sorted_rows = feature[order]
        starts = np.flatnonzero(np.concatenate([[True], sorted_rows[1:] != sorted_rows[:-1]]))
        moved = np.add.reduceat(slope.take(order, 0), starts, axis=0)
        at = sorted_rows[starts]
        seen[at] += (moved * moved).sum(1)
        weights[at] -= (rate / np.sqrt(seen[at] + 1e-6))[:, None] * moved


def learn(model: Model, texts: list[str | None], seen_1: np.ndarray, seen_2: np.ndarray, rate: float) -> int:
    """Gradient steps on ``texts``; returns the number of tokens."""
    _, ids, starts = read_ids(model, texts)
    features, kind, leaf = context(ids, starts), model.kind[ids], model.leaf[ids]
    for a in range(0, len(ids), BATCH_TOKENS):
        part = slice(a, a + BATCH_TOKENS)
        (rows, _, chances), (rows2, _, chances2, which) = layers(model, features[:, part], kind[part], leaf[part])
        chances[np.arange(len(chances)), kind[part]] -= 1
        step(model.first, seen_1, rows, chances, rate)
        step(model.first, seen_1, np.zeros((1, 1), np.int64), chances.sum(0, keepdims=True), rate)
        if len(which):
            chances2[np.arange(len(which)), leaf[part][which]] -= 1
            step(model.second, seen_2, np.concatenate([rows2, kind[part][which][None, :]]), chances2, rate)
    return len(ids)


def company(texts: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """How often each head word follows each of ``COMPANY`` hash groups of words."""
    shared = texts.sparkSession.sparkContext.broadcast(vocabulary)
    size = len(vocabulary) * COMPANY
    piece = 1 << 16

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        total = np.zeros(size, np.int64)
        for batch in small_batches(batches, "text"):
            split = [tokens_of(t) for t in batch.column("text").to_pylist()]
            ids = numbers(words, split, sum(map(len, split)))
            left = (np.concatenate([[words.rare], ids[:-1]]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(60)).astype(np.int64)
            known = ids < words.rare
            total += np.bincount(ids[known] * COMPANY + left[known], minlength=size)
        if total.any():
            parts = [total[k:k + piece] for k in range(0, size, piece)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], names=["part", "sums"])

    summed = added(texts.mapInArrow(work, "part int, sums binary"), np.int64)
    if not summed:
        return np.zeros((len(vocabulary), COMPANY), np.int64)
    return np.concatenate([summed[k] for k in sorted(summed)]).reshape(-1, COMPANY)


def added(parts: DataFrame, kind: type) -> dict[int, np.ndarray]:
    """Sum of equally long arrays by part, in two steps so that no task gets all tasks' arrays."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data in zip(batch.column("part").to_pylist(), batch.column("sums").to_pylist(), strict=True):
                values = np.frombuffer(data, kind)
                sums[part] = sums[part] + values if part in sums else values
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["part", "sums"])

    schema = "part int, sums binary"
    halfway = parts.repartition("part", F.pmod(F.xxhash64("sums"), F.lit(8))).mapInArrow(add, schema)
    return {r["part"]: np.frombuffer(r["sums"], kind) for r in halfway.repartition("part").mapInArrow(add, schema).collect()}


def clusters(shares: np.ndarray, weights: np.ndarray, k: int, turns: int = 12) -> np.ndarray:
    """Weighted k-means from spread-out frequent words."""
    if len(shares) <= k:
        return np.arange(len(shares)) % k
    centres = [shares[0]]
    near = ((shares - centres[0]) ** 2).sum(1)
    for _ in range(k - 1):
        centres.append(shares[(near * np.sqrt(weights)).argmax()])
        near = np.minimum(near, ((shares - centres[-1]) ** 2).sum(1))
    middle = np.array(centres)
    for _ in range(turns):
        found = ((shares ** 2).sum(1)[:, None] - 2 * shares @ middle.T + (middle ** 2).sum(1)).argmin(1)
        for c in range(k):
            own = found == c
            if own.any():
                middle[c] = np.average(shares[own], axis=0, weights=weights[own])
    return found


def build(texts: DataFrame, head: int) -> tuple[Model, DataFrame]:
    """Counts, classes and leaves from all training ``texts``; the layers are zero. Also the table of counts."""
    counts = cut(count_tokens(texts), "token-counts")
    tokens, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    frequent = counts.where((F.col("c") * head >= tokens) | (F.col("token") == F.lit(END))).collect()
    frequent = sorted(((r["token"], r["c"]) for r in frequent), key=lambda x: (-x[1], bytes(x[0])))
    words, numbers = [bytes(w) for w, _ in frequent], np.array([c for _, c in frequent], np.int64)
    vocabulary = Vocabulary(words)
    kept = company(texts, vocabulary) + 0.5
    shares = np.sqrt(kept / kept.sum(1, keepdims=True))
    kind = clusters(shares, numbers.astype(float), CLUSTERS) if len(words) else np.zeros(0, np.int64)
    leaf, share = np.zeros(len(words) + 1, np.int64), np.zeros(len(words) + 1)
    kind = np.concatenate([kind, [RARE]]).astype(np.int64)
    if END in vocabulary:
        kind[vocabulary[END]] = STOP
    used = np.zeros((CLASSES, LEAVES), bool)
    for c in range(CLUSTERS):
        members = np.flatnonzero(kind == c)
        if not len(members):
            continue
        # Leaves of about equal weight; a frequent word fills one alone.
        mass, at, left = 0.0, 0, float(numbers[members].sum())
        target = left / LEAVES
        for w in members:
            if mass and mass + numbers[w] > target and at < LEAVES - 1:
                left -= mass
                mass, at = 0.0, at + 1
                target = left / (LEAVES - at)
            leaf[w] = at
            mass += numbers[w]
        sums = np.bincount(leaf[members], numbers[members], LEAVES)
        share[members] = np.log10(numbers[members] / sums[leaf[members]])
        used[c] = sums > 0
    used[[STOP, RARE], 0] = True
    model = Model(vocabulary, numbers, kind, leaf, share, int(tokens), int(distinct), int(tokens - numbers.sum()), int(distinct - len(words)),
                  np.zeros((ROWS_1, CLASSES), np.float32), np.zeros((ROWS_2, LEAVES), np.float32), used)
    return model, counts


def fit(texts: DataFrame, head: int = 50_000, rounds: int = 2, rate: float = 0.3) -> tuple[Model, DataFrame]:
    """The model learned from the column ``text`` of all rows of ``texts``, and the table of counts."""
    model, counts = build(texts, head)
    for turn in range(rounds):
        shared = texts.sparkSession.sparkContext.broadcast(model)

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            start = shared.value
            own = Model(**(vars(start) | {"first": start.first.copy(), "second": start.second.copy()}))
            seen_1, seen_2, size = np.zeros(ROWS_1, np.float32), np.zeros(ROWS_2, np.float32), 0
            for batch in small_batches(batches, "text"):
                size += learn(own, batch.column("text").to_pylist(), seen_1, seen_2, rate)
            if size:
                change = ((own.blocks() - start.blocks()) * np.float32(size)).astype(np.float32)
                moved = [k for k in range(len(change)) if change[k].any()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*moved, -1], pa.int32()), pa.array([*[change[k].tobytes() for k in moved], np.float32(size).tobytes()], pa.binary())], names=["part", "sums"])

        part = texts.where(F.pmod(F.xxhash64("text"), F.lit(rounds)) == turn).select("text")
        moved = added(part.mapInArrow(work, "part int, sums binary"), np.float32)
        if -1 not in moved:
            continue
        size = float(moved.pop(-1)[0])
        blocks = model.blocks().copy()
        for k, change in moved.items():
            blocks[k] += change / size
        flat = blocks.ravel()
        model.first, model.second = flat[:ROWS_1 * CLASSES].reshape(ROWS_1, CLASSES).copy(), flat[ROWS_1 * CLASSES:].reshape(ROWS_2, LEAVES).copy()
        shared.unpersist()
    return model, counts


def score(docs: DataFrame, model: Model, counts: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, n_tokens, n_known, train_tokens, base_score and score (log10)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType.simpleString()
    whole = model.tokens + 0.1 * (model.distinct + 1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        base = np.concatenate([np.log10((own.counts + 0.1) / whole), [0.0]])
        for batch in small_batches(batches, "text"):
            texts = batch.column("text").to_pylist()
            split, ids, starts = read_ids(own, texts)
            features, kinds, leaves = context(ids, starts), own.kind[ids], own.leaf[ids]
            told = own.share[ids]
            for a in range(0, len(ids), BATCH_TOKENS):
                part = slice(a, a + BATCH_TOKENS)
                (_, first, _), (_, second, _, which) = layers(own, features[:, part], kinds[part], leaves[part])
                told[part] += first / math.log(10)
                told[a + which] += second / math.log(10)
            rare = ids == own.vocabulary.rare
            known = np.add.reduceat((~rare).astype(np.int64), starts) if len(starts) else starts
            rest = [Counter(map(words.__getitem__, np.flatnonzero(rare[a:a + len(words)]).tolist())) for words, a in zip(split, starts.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(list(map(len, split)), pa.int64()), pa.array(known, pa.int64()),
                 pa.array(np.add.reduceat(base[ids], starts) if len(starts) else [], pa.float64()),
                 pa.array(np.add.reduceat(told, starts) if len(starts) else [], pa.float64()),
                 pa.array([list(r) for r in rest], pa.list_(pa.binary())), pa.array([list(r.values()) for r in rest], pa.list_(pa.int64()))],
                names=["id", "n_tokens", "known", "base", "told", "rare", "times"])

    # Rare words meet their counts under one number of their row, fixed by writing it out: ids may repeat or be null.
    scored = cut(docs.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(
        work, f"id {kind}, n_tokens bigint, known bigint, base double, told double, rare array<binary>, times array<bigint>")
        .withColumn("row", F.monotonically_increasing_id()), "scored")
    loose = scored.where(F.size("rare") > 0).select("row", F.explode(F.arrays_zip("rare", "times")).alias("e")).select(
        "row", F.col("e.rare").alias("token"), F.col("e.times").alias("times"))
    c = F.coalesce("c", F.lit(0))
    sums = loose.join(counts, "token", "left").groupBy("row").agg(
        F.sum(F.col("times") * (c > 0).cast("bigint")).alias("seen"),
        F.sum(F.col("times") * F.rint(F.log10(c + 0.1) * LOG_STEPS)).alias("logs"))
    inside = model.rare_tokens + 0.1 * (model.rare_distinct + 1)
    rare_here = F.col("n_tokens") - F.col("known")
    add = lambda a, of: F.col(a) + F.coalesce(F.col("logs") / LOG_STEPS - rare_here * F.lit(math.log10(of)), F.lit(0.0))
    return scored.drop("rare", "times").join(sums, "row", "left").select(
        F.col("id").alias(key), "n_tokens", (F.col("known") + F.coalesce("seen", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"), add("base", whole).alias("base_score"), add("told", inside).alias("score"))


def learning_rows(docs: DataFrame, learn_from: Column, text: str = "text") -> DataFrame:
    return docs.where(learn_from).select(F.coalesce(F.col(text), F.lit("")).alias("text"))

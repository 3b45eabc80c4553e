"""Substring dedup: seed and extend over winnowed anchors.

A word is removed if it lies in a window of ``window`` words that also starts
earlier: in a document of smaller id, or earlier in the same document.

Seeds: of the ``gram``-word hashes inside a window the smallest is the window's
anchor, so equal windows have equal anchors, and about one word in seven starts
one. Documents are joined on anchors, each with the first document that holds
the anchor, never pairwise. Extension: that document sends the maximal runs of
windows around the shared anchors as words, and every window of the receiving
document that occurs in them is a repeat. A window that is not found there can
only repeat another such leftover with the same anchor, so the leftovers are
grouped among themselves, which makes the result exact. Repeats inside one
document need no join.

Windows are compared by 64-bit hashes.

Cases: null and empty texts have no words; texts of fewer words than a window
never change except through longer ones, that is, not at all; rows equal in id
and text are one document and change alike; rows that share an id but not the
text are ordered by a hash of the text; rows without an id are compared with
themselves only; other columns pass through, and input columns named like an
output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meshwright.llm.common import restored, set_aside, small_batches
from meshwright.plans.ranking import global_position
from meshwright.session import cut

KEPT_WORDS = 500_000
STEP, OTHER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) >= KEPT_WORDS:
            self.clear()
        if len(word) <= 48:
            self[word] = value
        return value


@lru_cache(maxsize=1)
def word_hashes() -> WordHashes:
    """One per Python worker."""
    return WordHashes()


def longer(one: np.ndarray, two: np.ndarray, first: int, second: int) -> np.ndarray:
    """Hashes of runs of ``first + second`` words from those of ``first`` and of ``second`` words."""
    count = max(len(two) - first, 0)
    return one[:count] * np.uint64(pow(int(STEP), second, 1 << 64)) + two[first:first + count]


def runs_of(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words, by doubling."""
    powers, size = {1: hashes}, 1
    while size * 2 <= width:
        powers[size * 2] = longer(powers[size], powers[size], size, size)
        size *= 2
    rolled, done = powers[size], size
    for step in sorted((s for s in powers if s < size), reverse=True):
        if width - done >= step:
            rolled, done = longer(rolled, powers[step], done, step), done + step
    return (rolled ^ (rolled >> np.uint64(31))) * OTHER


class Windows:
    """A text's words, the hash of each window and its anchor."""

    def __init__(self, words: list[bytes], hashes: np.ndarray, anchors: np.ndarray) -> None:
        self.words, self.hashes, self.anchors = words, hashes, anchors


def windows_of(texts: list[str | None], window: int, gram: int) -> list[Windows]:
    """The windows of each text, hashed over all texts of a batch at once."""
    split = [(t or "").encode().split() for t in texts]  # bytes.split parts at ASCII spaces only
    hashes = np.fromiter(map(word_hashes().__getitem__, chain.from_iterable(split)), np.uint64, sum(map(len, split)))
    whole, smallest, span = runs_of(hashes, window), runs_of(hashes, gram), 1
    while span < window - gram + 1 and len(whole):  # the least of ever longer spans
        step = min(span, window - gram + 1 - span)
        smallest = np.minimum(smallest[:len(smallest) - step], smallest[step:])
        span += step
    found, start = [], 0
    for words in split:
        count = max(len(words) - window + 1, 0)
        found.append(Windows(words, whole[start:start + count], smallest[start:start + count]))
        start += len(words)
    return found


def spans_of(chosen: np.ndarray) -> list[tuple[int, int]]:
    """Runs of True as (start, end)."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], chosen.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, values)]), pa.int32()), pa.array(flat, kind))


def _order(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``docs`` with __ord, a document's place in the order (null without an id).

    Ids serve as they are if no two texts share one; otherwise pairs of id and
    text hash are numbered.
    """
    rows = docs.withColumn("__version", F.xxhash64(text))
    shared = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("__version").alias("a"), F.max("__version").alias("b")).where("a != b")
    if shared.isEmpty():
        return docs.withColumn("__ord", F.col(key))
    pairs = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("__k"), F.col("__version").alias("__v")).distinct()
    placed = cut(global_position(pairs, ["__k", "__v"], "__ord"), "order")
    return rows.join(placed, (F.col(key) == F.col("__k")) & (F.col("__version") == F.col("__v")), "left").drop("__k", "__v", "__version")


def cross_repeats(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """Per __ord the hashes of its windows that an earlier document holds, as spans and as single hashes."""
    kind = texts.schema["__ord"].dataType.simpleString()

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "__text"):
            found = [np.unique(own.anchors) for own in windows_of(batch.column("__text").to_pylist(), window, gram)]
            take = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("__ord").take(take), pa.array(_signed(np.concatenate(found)), pa.int64())], names=["__ord", "anchor"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None, None)
        for batch in small_batches(batches, "__text"):
            parts = []
            for first, text, shared in zip(*(batch.column(c).to_pylist() for c in ("first", "__text", "shared")), strict=True):
                if last[0] != first:
                    own = windows_of([text], window, gram)[0]
                    once = np.zeros(len(own.hashes), bool)
                    once[np.unique(own.hashes, return_index=True)[1]] = True
                    last = (first, own, once)
                _, own, once = last
                wanted = once & np.isin(own.anchors, np.array(shared, np.int64).view(np.uint64))
                parts.append([b" ".join(own.words[a:b + window - 1]).decode() for a, b in spans_of(wanted)])
            yield pa.RecordBatch.from_arrays([batch.column("__ord"), pa.array(parts, pa.list_(pa.string()))], names=["__ord", "parts"])

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "__text"):
            spans, left = [], []
            columns = [batch.column(c).to_pylist() for c in ("__text", "parts", "shared")]
            for text, parts, shared in zip(*columns, strict=True):
                own, *sent = windows_of([text, *(p for part in parts for p in part)], window, gram)
                known = np.isin(own.hashes, np.concatenate([s.hashes for s in sent])) if sent else np.zeros(len(own.hashes), bool)
                spans.append(np.array([x for s in spans_of(known) for x in s], np.int64))
                open_ = ~known & np.isin(own.anchors, np.array([a for part in shared for a in part], np.int64).view(np.uint64))
                left.append(_signed(np.unique(own.hashes[open_])))
            yield pa.RecordBatch.from_arrays([batch.column("__ord"), _lists(spans, pa.int64()), _lists(left, pa.int64())], names=["__ord", "spans", "open"])

    seeds = cut(texts.mapInArrow(anchors, f"__ord {kind}, anchor bigint"), "anchors")
    firsts = seeds.groupBy("anchor").agg(F.min("__ord").alias("first"), F.count("*").alias("n")).where("n > 1").select("anchor", "first")
    pairs = cut(seeds.join(firsts, "anchor").where("__ord != first").groupBy("__ord", "first").agg(F.collect_list("anchor").alias("shared")), "pairs")
    sent = pairs.join(texts.select(F.col("__ord").alias("__f"), "__text"), F.col("first") == F.col("__f")).select("__ord", "first", "__text", "shared")
    parts = cut(sent.select("__ord", "first", "__text", "shared").mapInArrow(send, f"__ord {kind}, parts array<string>"), "parts")
    received = parts.groupBy("__ord").agg(F.collect_list("parts").alias("parts"))
    shared = pairs.groupBy("__ord").agg(F.collect_list("shared").alias("shared"))
    met = received.join(shared, "__ord").withColumnRenamed("__ord", "__o")
    extended = cut(met.join(texts, F.col("__o") == F.col("__ord")).select("__ord", "__text", "parts", "shared")
                   .mapInArrow(extend, f"__ord {kind}, spans array<bigint>, open array<bigint>"), "extended")
    loose = cut(extended.select("__ord", F.explode("open").alias("hash")), "loose")
    earliest = loose.groupBy("hash").agg(F.min("__ord").alias("first"), F.count("*").alias("n")).where("n > 1").select("hash", "first")
    repeats = loose.join(earliest, "hash").where("__ord != first").groupBy("__ord").agg(F.collect_list("hash").alias("repeats"))
    return extended.select("__ord", "spans").join(repeats, "__ord", "left")


def drop_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 20, gram: int = 6) -> DataFrame:
    """``docs`` with the words that are left (joined by one space) as text, n_words and n_removed."""
    kept, inner = set_aside(docs, ("n_words", "n_removed"))
    names, key, text = list(inner.values()), inner[key], inner[text]
    rows = _order(kept, key, text)
    texts = rows.select("__ord", F.col(text).alias("__text")).where("__ord is not null")
    if not texts.groupBy("__ord").count().where("count > 1").isEmpty():
        texts = cut(texts.dropDuplicates(["__ord"]), "texts")  # rows equal in id and text are one document
    found = cut(cross_repeats(texts, window, gram), "repeats").withColumnRenamed("__ord", "__o")

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text):
            bodies, counts, gone = [], [], []
            texts_, spans_, repeats_ = (batch.column(c).to_pylist() for c in (text, "spans", "repeats"))
            for own, spans, repeats in zip(windows_of(texts_, window, gram), spans_, repeats_, strict=True):
                counts.append(len(own.words))
                if not spans and not repeats and len(set(own.hashes.tolist())) == len(own.hashes):
                    bodies.append(b" ".join(own.words).decode())
                    gone.append(0)
                    continue
                again = np.ones(len(own.hashes), bool)
                again[np.unique(own.hashes, return_index=True)[1]] = False
                if repeats:
                    again |= np.isin(own.hashes, np.array(repeats, np.int64).view(np.uint64))
                for a, b in zip((spans or [])[::2], (spans or [])[1::2], strict=True):
                    again[a:b] = True
                removed = np.zeros(len(own.words) + 1, np.int64)
                for a, b in spans_of(again):
                    removed[a] += 1
                    removed[b + window - 1] -= 1
                covered = np.cumsum(removed[:-1]) > 0
                bodies.append(b" ".join(compress(own.words, (~covered).tolist())).decode())
                gone.append(int(covered.sum()))
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(bodies, pa.string()) if c == text else batch.column(c) for c in names], pa.array(counts, pa.int64()), pa.array(gone, pa.int64())],
                names=[*names, "n_words", "n_removed"])

    schema = T.StructType([*kept.schema, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    joined = rows.join(found, F.col("__ord") == F.col("__o"), "left")
    return joined.select(*names, "spans", "repeats").mapInArrow(strip, schema).select(*restored(inner), "n_words", "n_removed")

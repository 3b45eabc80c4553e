"""Byte-level BPE encoding and decoding by public ranks.

A text is cut into pre-tokens by a pattern; each pre-token's bytes are merged by
rank. Merging uses a rank queue: one bucket per merge rank holds the places of
a linked list where that merge applies, and a hierarchical bitmap over ranks
marks the buckets in use. Find-first-set picks the next rank, the lowest place
in its bucket goes first, and entries whose pair has changed meanwhile are
skipped. Every merge adds at most two entries, so a pre-token of n bytes takes
O(n log n) steps however long it is.

Short pre-tokens repeat, so each task keeps their ids in a table of bounded size.

Cases: null and empty texts have no ids, and null ids decode to no bytes; every
byte string has an encoding, because all 256 bytes are tokens; ids outside the
vocabulary raise ValueError; other columns pass through, and input columns named
like an output are replaced.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from meshwright.llm.common import small_batches

CACHE_ENTRIES, CACHE_BYTES = 500_000, 48


class Merger:
    """Merges pre-tokens by rank; the queue is empty between calls and is reused.

    The bitmap has two levels of Python integers: ``words[k]`` marks the ranks
    256k to 256k+255 whose bucket holds places, ``top`` marks the words in use.
    A bucket is a heap of places.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.words = [0] * ((max(ranks.values(), default=0) >> 8) + 1)
        self.bits = [1 << k for k in range(max(256, len(self.words)))]
        self.pairs = [slice(i, i + 2) for i in range(256)]

    def merge(self, piece: bytes) -> list[int]:
        """Token ids of one pre-token."""
        get, words, bits = self.ranks.get, self.words, self.bits
        whole = get(piece)
        if whole is not None:
            return [whole]
        size = len(piece)
        last = size - 1
        if last < 256:
            pair = list(map(get, map(piece.__getitem__, self.pairs[:last])))
        else:
            pair = [get(piece[i:i + 2]) for i in range(last)]
        after, before = list(range(1, size + 1)), list(range(-1, last))
        buckets: dict[int, list[int]] = {}
        top = 0
        for place, rank in enumerate(pair):
            if rank is not None:
                if rank in buckets:
                    buckets[rank].append(place)  # ascending places are a heap already
                else:
                    buckets[rank] = [place]
                    word = rank >> 8
                    words[word] |= bits[rank & 255]
                    top |= bits[word]
        pair.append(None)
        while top:
            # Find-first-set: the lowest word in use, then its lowest rank.
            word = (top & -top).bit_length() - 1
            marks = words[word]
            first = marks & -marks
            rank = (word << 8) + first.bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                place = heappop(bucket)
            else:
                place = bucket[0]
                del buckets[rank]
                words[word] = marks = marks ^ first
                if not marks:
                    top ^= bits[word]
            if pair[place] != rank:
                continue  # stale: this pair has changed since it was queued
            gone = after[place]
            end = after[place] = after[gone]
            pair[gone] = None
            if end < size:
                before[end] = place
                rank = pair[place] = get(piece[place:after[end]])
                if rank is not None:
                    if rank in buckets:
                        heappush(buckets[rank], place)
                    else:
                        buckets[rank] = [place]
                        word = rank >> 8
                        words[word] |= bits[rank & 255]
                        top |= bits[word]
            else:
                pair[place] = None
            place = before[place]
            if place >= 0:
                rank = pair[place] = get(piece[place:end])
                if rank is not None:
                    if rank in buckets:
                        heappush(buckets[rank], place)
                    else:
                        buckets[rank] = [place]
                        word = rank >> 8
                        words[word] |= bits[rank & 255]
                        top |= bits[word]
        ids, place = [], 0
        while place < size:
            end = after[place]
            ids.append(self.ranks[piece[place:end]])
            place = end
        return ids


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Lines of a base-64 token and its rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


class Encoder(dict):
    """Ids by pre-token. Missing ones are merged and short ones are kept.

    Two generations bound the table: when the young one is full it becomes the
    old one, and what is used again moves back.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        super().__init__()
        self.ranks, self.merge, self.cut = ranks, Merger(ranks).merge, regex.compile(pattern).findall
        self.old: dict[str, list[int]] = {}

    def __missing__(self, piece: str) -> list[int]:
        ids = self.old.get(piece)
        if ids is None:
            data = piece.encode()
            ids = self.merge(data)
            if len(data) > CACHE_BYTES:
                return ids
        if len(self) >= CACHE_ENTRIES:
            self.old = dict(self)
            self.clear()
        self[piece] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.__getitem__, self.cut(text))))


@lru_cache(maxsize=1)
def encoder(data: bytes, pattern: str) -> Encoder:
    """One per Python worker, so that tasks share its table."""
    return Encoder(read_ranks(data), pattern)


def joined(ids: list[int], pieces: dict[int, bytes]) -> bytes:
    """The bytes that ids stand for."""
    try:
        return b"".join(map(pieces.__getitem__, ids))
    except KeyError as missing:
        raise ValueError(f"id {missing} is not in the vocabulary") from None


def encode(frame: DataFrame, vocabulary: str, pattern: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``frame`` with the token ids of each whole text, without special tokens.

    ``decoded`` names a column for the bytes that these ids decode to; that
    saves the way of the ids through a second Python worker.
    """
    data = frame.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())
    made = [ids, *([decoded] if decoded else [])]
    kept = [f.name for f in frame.schema if f.name.lower() not in {m.lower() for m in made}]
    schema = T.StructType([*[f for f in frame.schema if f.name in kept], T.StructField(ids, T.ArrayType(T.IntegerType())),
                           *([T.StructField(decoded, T.BinaryType())] if decoded else [])])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(data.value, pattern)
        pieces = {rank: token for token, rank in coder.ranks.items()} if decoded else {}
        for batch in small_batches(batches, text):
            found = [coder.encode(x) if x else [] for x in batch.column(text).to_pylist()]
            values = pa.array(np.fromiter(chain.from_iterable(found), np.int32), pa.int32())
            column = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), values)
            back = [pa.array([joined(x, pieces) for x in found], pa.binary())] if decoded else []
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], column, *back], names=[*kept, *made])

    return frame.mapInArrow(work, schema)


def decode(frame: DataFrame, vocabulary: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``frame`` with the bytes that the ids stand for."""
    data = frame.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())
    kept = [f.name for f in frame.schema if f.name.lower() != decoded.lower()]
    schema = T.StructType([*[f for f in frame.schema if f.name in kept], T.StructField(decoded, T.BinaryType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = {rank: token for token, rank in read_ranks(data.value).items()}
        for batch in small_batches(batches, ids):
            found = [joined(x or [], pieces) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(found, pa.binary())], names=[*kept, decoded])

    return frame.mapInArrow(work, schema)

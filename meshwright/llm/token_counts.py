"""Token counts: lengths of greedy word-piece splits, without building the pieces.

The vocabulary is a trie over bytes. Each node has a failure link: when no edge
continues the match, the longest pieces of what has been read are popped, and
the link leads to the node of what is left. How many pieces are popped is
precomputed, so a word of n bytes takes O(n) steps and yields its number of
pieces only. First pieces and continuation pieces have a root each.

A word that the vocabulary cannot cover counts as one unknown token.

Cases: null and empty texts have no words and no tokens; other columns pass
through, and input columns named like an output are replaced.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from meshwright.llm.byte_pairs import read_ranks
from meshwright.llm.common import small_batches

KEPT_ENTRIES, KEPT_CHARS = 500_000, 48
WORDS = r"[^\x20\x09-\x0D]+"
NOWHERE = -1


class Automaton:
    """Counts the pieces of a word over ``first`` and ``rest`` pieces (byte strings)."""

    def __init__(self, first: Iterable[bytes], rest: Iterable[bytes]) -> None:
        # Node 0 is the root of first pieces, node 1 that of continuations.
        self.edges: list[dict[int, int]] = [{}, {}]
        ends: list[bool] = [False, False]
        for root, pieces in ((0, first), (1, rest)):
            for piece in pieces:
                node = root
                for byte in piece:
                    after = self.edges[node].get(byte)
                    if after is None:
                        after = self.edges[node][byte] = len(self.edges)
                        self.edges.append({})
                        ends.append(False)
                    node = after
                ends[node] = node > 1
        self.link, self.popped = [NOWHERE] * len(ends), [0] * len(ends)
        queue = deque((root, byte, node) for root in (0, 1) for byte, node in self.edges[root].items())
        while queue:
            parent, byte, node = queue.popleft()
            if ends[node]:
                self.link[node], self.popped[node] = 1, 1
            else:
                at, count = self.link[parent], self.popped[parent]
                while at != NOWHERE and byte not in self.edges[at]:
                    count += self.popped[at]
                    at = self.link[at]
                if at != NOWHERE:
                    self.link[node], self.popped[node] = self.edges[at][byte], count
            queue.extend((node, b, n) for b, n in self.edges[node].items())

    def pieces(self, word: bytes) -> int:
        """Number of pieces of the greedy split; 1 if the word is unknown, 0 if it is empty."""
        if not word:
            return 0
        edges, link, popped = self.edges, self.link, self.popped
        node, count = 0, 0
        for byte in word:
            after = edges[node].get(byte)
            while after is None:
                count += popped[node]
                node = link[node]
                if node == NOWHERE:
                    return 1
                after = edges[node].get(byte)
            node = after
        while node != 1:
            count += popped[node]
            node = link[node]
            if node == NOWHERE:
                return 1
        return count


class Counts(dict):
    """Pieces by word; short words are kept, up to a bound."""

    def __init__(self, automaton: Automaton) -> None:
        super().__init__()
        self.pieces = automaton.pieces

    def __missing__(self, word: str) -> int:
        count = self.pieces(word.encode())
        if len(word) <= KEPT_CHARS:
            if len(self) >= KEPT_ENTRIES:
                self.clear()
            self[word] = count
        return count


def byte_vocabulary(data: bytes) -> tuple[list[bytes], list[bytes]]:
    """First and continuation pieces of a byte-level vocabulary.

    Tokens that begin with a space start a word, others continue one; all single
    bytes do both, so that no word is unknown.
    """
    tokens = list(read_ranks(data))
    single = [bytes([b]) for b in range(256)]
    return [t[1:] for t in tokens if t[:1] == b" " and len(t) > 1] + single, [t for t in tokens if t[:1] != b" "] + single


@lru_cache(maxsize=1)
def _counts(data: bytes) -> Counts:
    """One per Python worker, so that tasks share its table."""
    return Counts(Automaton(*byte_vocabulary(data)))


def count_tokens(frame: DataFrame, vocabulary: str, text: str = "text", words: str = "n_words", tokens: str = "n_tokens") -> DataFrame:
    """``frame`` with the number of words and of word pieces of each whole text."""
    data = frame.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())
    kept = [f.name for f in frame.schema if f.name.lower() not in (words.lower(), tokens.lower())]
    schema = T.StructType([*[f for f in frame.schema if f.name in kept], T.StructField(words, T.LongType()), T.StructField(tokens, T.LongType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, cut = _counts(data.value), regex.compile(WORDS).findall
        for batch in small_batches(batches, text):
            found = [cut(x or "") for x in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(map(len, found), pa.int64()),
                 pa.array([sum(map(counts.__getitem__, x)) for x in found], pa.int64())], names=[*kept, words, tokens])

    return frame.mapInArrow(work, schema)

"""Phrase collocation mining after Toivonen: a sample proposes, full passes count.

A phrase is a run of words inside a piece of a text, counted per language with
overlaps. It is frequent if it occurs ``min_count`` times; then its parts are
frequent too. The pass over the sample counts all its phrases and proposes those
that reach a lowered count: half of what the share lets expect, at least two. The first full pass counts, exactly and over all
texts, every word and every longer phrase whose two parts (without the last and
without the first word) were proposed: the proposals and their negative border.
If a phrase with possible extensions turns out frequent that was not proposed,
the border has failed there, and an expansion pass counts what became possible:
phrases whose parts are frequent, or are being counted for the first time in the
same pass, and that the first pass left out. Words were all counted in the first
pass, so every phrase of frequent parts is counted in one of the two, and the
set is closed whatever the sample held.

Proposals do not travel as lists: they set bits of a map of bounded size that
every task holds. A phrase whose bit is set by another one is counted as well,
which costs a row and changes no count.

Tasks number the words of a block of texts, fold its phrases by sorting numbers
and send each distinct phrase of the block once, as text, so equal counts mean
equal words. The scores are a join of the frequent phrases with their parts.

Cases: null texts are empty, a null language is ``und``; empty texts and texts of
separators have no phrases; rows without a key take part (the key only chooses
the sample); repeated rows count each time; other columns are not read; an empty
table has no phrases.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meshwright.llm.common import small_batches
from meshwright.session import cut

STEP, OTHER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
BREAK = b"\xff"  # a byte that no UTF-8 text holds
BLOCK_WORDS = 1_000_000
SENT = 100_000  # phrases in one Arrow batch
PIECE = 4 << 20
LEAST_BITS, MOST_BITS = 20, 27  # the map of proposals has 2^27 bits (16 MB) at most
CHUNK_BITS = 16


def _fold_table() -> bytes:
    """A-Z in lower case, tabs as spaces, every mark that ends a piece as ``BREAK``."""
    table = bytearray(range(256))
    for c in range(ord("A"), ord("Z") + 1):
        table[c] = c + 32
    for c in b".,;:!?\n\x0b\x0c\r":
        table[c] = BREAK[0]
    table[ord("\t")] = ord(" ")
    return bytes(table)


FOLD = _fold_table()


def text_words(texts: list[bytes | None]) -> Iterator[list[bytes]]:
    """Words of texts in order, with ``BREAK`` between pieces and after every text, in lists of bounded size."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        folded = (text or b"").translate(FOLD)
        start = 0
        while len(folded) - start > PIECE:  # cut where a word ends
            ends = [e for e in (folded.find(b" ", start + PIECE), folded.find(BREAK, start + PIECE)) if e >= 0]
            if not ends:
                break
            yield _split([*held, folded[start:min(ends)]])
            held, size, start = [], 0, min(ends)
        held.append(folded[start:] + BREAK)
        size += len(folded) - start
        if size > PIECE:
            yield _split(held)
            held, size = [], 0
    if held:
        yield _split(held)


def _split(parts: list[bytes]) -> list[bytes]:
    return b"".join(parts).replace(BREAK, b" " + BREAK + b" ").split()


class Numbers(dict):
    """Numbers of words in order of appearance; ``BREAK`` is 0."""

    def __init__(self) -> None:
        super().__init__({BREAK: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(lang.encode() + b"\x00" + word)


def extend(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hash of phrases that are one word longer."""
    rolled = hashes * STEP + words
    return (rolled ^ (rolled >> np.uint64(31))) * OTHER


class BitMap:
    """A set of phrase hashes that may hold more than was put in."""

    def __init__(self, bits: int, data: np.ndarray) -> None:
        self.bits, self.data = bits, data

    def place(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes * OTHER) >> np.uint64(64 - self.bits)).astype(np.int64)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = self.place(hashes)
        return (self.data[at >> 3] >> (at & 7).astype(np.uint8)) & np.uint8(1) == 1


def count_block(numbers: np.ndarray, skip: int, words: list[bytes], lang: str, longest: int,
                proposed: BitMap | None, frequent: BitMap | None) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(words, phrases, counts) of a block; phrases that end within the first ``skip`` words are only context.

    Without ``proposed`` all phrases count; with it those of the first pass; with
    ``frequent`` too, those of the expansion pass.
    """
    v = len(words)
    text = pa.array([b"", *words[1:]], pa.binary()).cast(pa.string(), safe=False)
    names = np.arange(1, v)[:, None]
    own = np.array([word_hash(lang, w) for w in words], np.uint64)
    hashes = own[1:]
    key = numbers - 1  # index of the phrase that starts here, -1 for none
    before = np.ones(v - 1, bool) if proposed is None else proposed.has(hashes)
    now = before if frequent is None else frequent.has(hashes)
    if frequent is None:
        counts = np.bincount(numbers[skip:], minlength=v)[1:]
        seen = np.flatnonzero(counts)
        yield 1, text.take(pa.array(seen + 1)), counts[seen]
    for size in range(2, longest + 1):
        first, second = key[:-1], key[1:]
        open_here = (first >= 0) & (second >= 0)
        if len(now):
            open_here &= now[first] & now[second]
            if size == longest and frequent is not None:
                open_here &= ~(before[first] & before[second])
        starts = np.flatnonzero(open_here)
        if not len(starts):
            return
        found, at, inverse = np.unique(first[starts] * v + numbers[starts + size - 1], return_index=True, return_inverse=True)
        left, right = first[starts[at]], second[starts[at]]
        last = found % v
        names = np.concatenate([names[left], last[:, None]], 1)
        hashes = extend(hashes[left], own[last])
        counted = before[left] & before[right]  # in the first pass
        fresh = np.ones(len(found), bool) if frequent is None else ~counted
        counts = np.bincount(inverse[starts >= skip - size + 1], minlength=len(found))
        sent = np.flatnonzero(fresh & (counts > 0))
        if len(sent):
            yield size, pc.binary_join_element_wise(*[text.take(pa.array(names[sent, k])) for k in range(size)], " "), counts[sent]
        if size < longest:
            key = np.full(len(first), -1, np.int64)
            key[starts] = inverse
            before = counted if proposed is None else counted & proposed.has(hashes)
            now = before if frequent is None else frequent.has(hashes) | fresh


def count_phrases(texts: DataFrame, longest: int, proposed: BitMap | None = None, frequent: BitMap | None = None) -> DataFrame:
    """(lang, size, phrase, n) over (lang, body), exact for each phrase that this pass counts."""
    spark = texts.sparkSession
    maps = spark.sparkContext.broadcast((proposed, frequent))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[str, Numbers] = {}
        held: dict[str, list[np.ndarray]] = {}
        skips: dict[str, int] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            carried = {}
            for lang, parts in held.items():
                words, body = list(numbers[lang]), np.concatenate(parts)
                for length, phrases, counts in count_block(body, skips[lang], words, lang, longest, *maps.value):
                    for start in range(0, len(phrases), SENT):
                        part = phrases[start:start + SENT]
                        yield pa.RecordBatch.from_arrays(
                            [pa.repeat(pa.scalar(lang), len(part)), pa.repeat(pa.scalar(length, pa.int32()), len(part)), part,
                             pa.array(counts[start:start + SENT], pa.int64())], names=["lang", "size", "phrase", "n"])
                # A text may go on after this block: its last words are context of the next one.
                if body[-1]:
                    carried[lang] = [words[k] for k in body[len(body) - min(len(body), longest - 1):]]
            for own in (numbers, held, skips):
                own.clear()
            for lang, words in carried.items():
                numbers[lang] = Numbers()
                held[lang] = [np.array([numbers[lang][w] for w in words], np.int64)]
                skips[lang] = len(words)

        for batch in small_batches(batches, "body", size=PIECE):
            bodies: dict[str, list[bytes | None]] = {}
            for lang, body in zip(batch.column("lang").to_pylist(), batch.column("body").to_pylist(), strict=True):
                bodies.setdefault(lang, []).append(body)
            for lang, own in bodies.items():
                for words in text_words(own):
                    index = numbers.setdefault(lang, Numbers())
                    held.setdefault(lang, []).append(np.fromiter(map(index.__getitem__, words), np.int64, len(words)))
                    skips.setdefault(lang, 0)
                    size += len(words)
                    if size >= BLOCK_WORDS:
                        yield from flush()
                        size = 0
        yield from flush()

    return texts.mapInArrow(fold, "lang string, size int, phrase string, n bigint").groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))


def phrase_hashes(langs: list[str], phrases: pa.Array) -> np.ndarray:
    """Hashes of phrases as ``count_block`` rolls them up."""
    words = pc.split_pattern(phrases.cast(pa.binary()), " ")
    sizes = pc.list_value_length(words).to_numpy(zero_copy_only=False)
    of_word = [lang for lang, size in zip(langs, sizes, strict=True) for _ in range(size)]
    own = np.array(list(map(word_hash, of_word, words.flatten().to_pylist())), np.uint64)
    starts = np.cumsum(sizes) - sizes
    hashes = own[starts] if len(starts) else own
    for place in range(1, int(sizes.max(initial=0))):
        more = np.flatnonzero(sizes > place)
        hashes[more] = extend(hashes[more], own[starts[more] + place])
    return hashes


def _places(phrases: DataFrame, bits: int, missing_from: BitMap | None = None) -> DataFrame:
    """(place) of each phrase in a map of 2^bits bits; only of phrases that ``missing_from`` lacks, if given."""
    known = phrases.sparkSession.sparkContext.broadcast(missing_from)
    width = BitMap(bits, np.zeros(0, np.uint8))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = phrase_hashes(batch.column("lang").to_pylist(), batch.column("phrase"))
            if known.value is not None:
                hashes = hashes[~known.value.has(hashes)]
            yield pa.RecordBatch.from_arrays([pa.array(width.place(hashes))], names=["place"])

    return phrases.select("lang", "phrase").mapInArrow(place, "place bigint")


def bit_map(phrases: DataFrame, size: int) -> BitMap:
    """The map of ``size`` phrases: at most 2^27 bits, put together from chunks of 8 KB."""
    bits = min(MOST_BITS, max(LEAST_BITS, (16 * size).bit_length()))
    chunks = _places(phrases, bits).groupBy(F.shiftright("place", CHUNK_BITS).alias("chunk")).agg(
        F.collect_set(F.col("place").bitwiseAND((1 << CHUNK_BITS) - 1).cast("int")).alias("bits"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for held in batch.column("bits"):
                flags = np.zeros(1 << CHUNK_BITS, np.uint8)
                flags[held.values.to_numpy()] = 1
                packed.append(np.packbits(flags, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), pa.array(packed, pa.binary())], names=["chunk", "data"])

    data = np.zeros(1 << (bits - 3), np.uint8)
    width = 1 << (CHUNK_BITS - 3)
    for r in chunks.mapInArrow(pack, "chunk bigint, data binary").collect():
        data[r["chunk"] * width:(r["chunk"] + 1) * width] = np.frombuffer(r["data"], np.uint8)
    return BitMap(bits, data)


def mine_phrases(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", longest: int = 3,
                 min_count: int = 10, share: float = 0.125) -> tuple[DataFrame, DataFrame]:
    """The exact counts (lang, size, phrase, n) of all frequent phrases, and (lang, n) of all words.

    The sample is the rows whose key's hash falls into ``share`` of all hashes; it
    decides what is counted first, never what is found.
    """
    texts = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body"), F.col(key).alias("key"))
    sample = texts.where(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)))).select("lang", "body")
    texts = texts.select("lang", "body")
    extensible = F.col("size") < longest
    proposals = cut(count_phrases(sample, max(1, longest - 1)).where(F.col("n") >= max(2, int(min_count * share / 2))).select("lang", "phrase"), "proposals")
    proposed = bit_map(proposals, proposals.count())
    # Rare longer phrases end here; rare words still count as words of their language.
    counted = cut(count_phrases(texts, longest, proposed).where((F.col("n") >= min_count) | (F.col("size") == 1)), "counted")
    totals = counted.where("size = 1").groupBy("lang").agg(F.sum("n").alias("n"))
    found = counted.where(F.col("n") >= min_count)
    parts = found.where(extensible)
    failed = _places(parts, proposed.bits, missing_from=proposed)
    if not failed.isEmpty():
        more = cut(count_phrases(texts, longest, proposed, bit_map(parts, parts.count())), "expanded")
        found = found.unionByName(more.where(F.col("n") >= min_count))
    return cut(found, "frequent"), totals


def collocations(frequent: DataFrame, totals: DataFrame, top: int | None = 2000, inside: int = 50) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the frequent phrases of two words or more.

    A phrase is cut in two at each place; the lowest score floor(10^6 a^2 / (l r))
    counts, the earliest cut among equals. Phrases that lie inside a longer one
    that has at least ``inside`` percent of their count are left out. ``top`` keeps
    the first of each language.
    """
    phrases = frequent.where("size >= 2").select("lang", "size", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("words"))
    part = lambda first, length: F.array_join(F.slice("words", first, length), " ")
    cuts = phrases.select("lang", "phrase", "a", "size", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("head"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("tail"))
    heads = frequent.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    tails = frequent.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r"))
    big = lambda c: f"cast({c} as decimal(16,0))"
    score = F.expr(f"(cast(1000000 as decimal(7,0)) * ({big('a')} * {big('a')})) div ({big('l')} * {big('r')})")
    scored = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).groupBy("lang", "phrase").agg(
        F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("c"), F.first("a").alias("a"))
    # Every shorter run of two words or more inside a phrase.
    spans = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("size") - m + 1), lambda s: F.array_join(F.slice("words", s, m), " ")))))
    longer = phrases.where("size > 2").select("lang", spans.alias("phrase"), F.col("a").alias("most")).groupBy("lang", "phrase").agg(F.max("most").alias("most"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(F.coalesce(F.col("most") * 100 < F.col("a") * inside, F.lit(True)))
    rows = kept.select("lang", "phrase", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"), F.col("c.score").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.col("phrase"))
    ranked = rows.withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)  # each task keeps its own first rows of a language
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")

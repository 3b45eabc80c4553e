"""Near-duplicate texts: improved consistent weighted sampling over TF-IDF shingles.

A text's shingles are its runs of five words (fewer words make one shingle),
weighted by how often they occur in it times an inverse document frequency.
``samples`` consistent weighted samples per text collide with the probability of
the weighted Jaccard similarity; they are cut into bands, and texts that share a
band meet. Every link is verified by the exact weighted Jaccard similarity of
the whole texts.

Document frequencies are counted over all texts, equal ones once. A shingle's
frequency is that of its hash slot, as in feature hashing: 2^SLOT_BITS counts,
however many texts there are. Slots that shingles share add (mean shingles /
2^SLOT_BITS) of the texts to a frequency, a share that does not grow with the
corpus; it lifts the rarest shingles most and evens out their factors.

Equal texts are one node. In a bucket of at most ``small_bucket`` texts all are
compared. A larger one is compared with one text first, the one that meets most
others in all its buckets. The texts of buckets that still hold several classes
meet again exactly: their shingles are ordered from rare to common, and of two
similar texts the lighter one has one of its rarest shingles (the first
(1 - threshold) / (1 + threshold) of its weight) among the rarest of the other (the
first 1 - threshold). Unlike texts around a common passage share none of these.
What only one class holds is taken off the weight that two classes may share, so
copies of one text that differ too much in their own words are not compared
either. Groups under one rare shingle are compared in full, or, if large, with
centres whose number doubles each turn, until every such text was a centre or
the group is of one class: no pair of different classes that could be similar
stays untested. Only pairs whose total weights rule out the threshold are passed
over. Classes are connected components.

Cases: null texts are never copies; texts without words are copies of equal
texts only; a class is named by its smallest id, and rows without an id get a
class id only from others; repeated rows share a class; other columns pass
through, and input columns named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meshwright.llm.common import passing, sized, small_batches
from meshwright.session import cut

KEPT_WORDS = 300_000
STEP, OTHER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
TABLE_BITS = 15
SLOT_BITS = 20  # counts of shingles: 4 MB in a task
SLOT_SHIFT = np.uint64(64 - SLOT_BITS)
COUNT_BLOCK = 1 << 10  # slots whose counts travel in one row


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


def shingles(text: str | None, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted 64-bit shingle hashes of a text and how often each occurs."""
    words = (text or "").encode().split()  # bytes.split parts at ASCII spaces only
    hashes = np.fromiter(map(word_hashes().__getitem__, words), np.uint64, len(words))
    if not len(hashes):
        return hashes, np.zeros(0, np.int64)
    span = min(width, len(hashes))
    rolled = np.full(len(hashes) - span + 1, span, np.uint64)
    for k in range(span):
        rolled = rolled * STEP + hashes[k:len(hashes) - span + 1 + k]
    return np.unique((rolled ^ (rolled >> np.uint64(31))) * OTHER, return_counts=True)


def slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> SLOT_SHIFT).view(np.int64)


class Weights:
    """TF-IDF weights from a factor for each hash slot; without factors, plain counts."""

    def __init__(self, factors: np.ndarray | dict) -> None:
        self.factors = factors if len(factors) else None

    def of(self, hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        weights = counts.astype(np.float64)
        return weights if self.factors is None else weights * self.factors[slots(hashes)]


class Sampler:
    """Improved consistent weighted samples.

    The random r, c and beta of a shingle and sample come from tables, addressed
    by a hash of both; a tie goes to the smaller shingle hash. What the sampling
    value needs of them lies together, so that one look-up brings all of it.
    """

    def __init__(self, samples: int, seed: int = 1) -> None:
        rng = np.random.default_rng(seed)
        size = 1 << TABLE_BITS
        self.odd = rng.integers(0, 1 << 63, samples, np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = (np.arange(samples, dtype=np.int64) << TABLE_BITS)[:, None]
        numbers = np.empty((samples, size, 4), np.float32)
        for row in numbers:
            r, c, beta = rng.gamma(2, 1, size), rng.gamma(2, 1, size), rng.random(size)
            row[:] = np.stack([1 / r, beta, np.log(c) - r + r * beta, r], 1)
        self.numbers = numbers.view(np.complex128).ravel()

    def samples(self, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        best = np.full(len(self.odd), np.inf, np.float32)
        chosen, level = np.zeros(len(self.odd), np.uint64), np.zeros(len(self.odd), np.float32)
        rows, logs = np.arange(len(self.odd)), np.log(weights).astype(np.float32)
        for start in range(0, len(hashes), 512):
            keys = hashes[start:start + 512]
            at = (self.odd[:, None] * keys[None, :] >> np.uint64(64 - TABLE_BITS)).view(np.int64)
            at += self.base
            inverse, beta, offset, r = np.moveaxis(self.numbers.take(at).view(np.float32).reshape(*at.shape, 4), -1, 0)
            t = np.floor(logs[None, start:start + 512] * inverse + beta)
            value = offset - r * t  # the logarithm of the sampling value; the smallest wins
            first = value.argmin(1)
            found, key = value[rows, first], keys[first]
            better = (found < best) | ((found == best) & (key < chosen))
            best = np.where(better, found, best)
            chosen = np.where(better, key, chosen)
            level = np.where(better, t[rows, first], level)
        return (chosen ^ (level.astype(np.int64).view(np.uint64) * OTHER)) * STEP


@lru_cache(maxsize=1)
def sampler(samples: int) -> Sampler:
    return Sampler(samples)


def band_keys(samples: np.ndarray, rows: int) -> list[int]:
    grid = samples.reshape(-1, rows)
    keys = np.arange(len(grid), dtype=np.uint64)
    for k in range(rows):
        keys = (keys ^ (keys >> np.uint64(29))) * OTHER + grid[:, k]
    return keys.view(np.int64).tolist()


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    if not len(a[0]) or not len(b[0]):
        return 0.0
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    same = b[0][at] == a[0]
    common = np.minimum(a[1][same], b[1][at[same]]).sum()
    return float(common / (a[1].sum() + b[1].sum() - common))


def shingle_sets(texts: DataFrame, width: int) -> DataFrame:
    """``texts`` with its column text replaced by bytes: sorted shingle hashes, and their counts unless all are one."""
    kept = [f for f in texts.schema if f.name != "text"]

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            hashes, counts = [], []
            for body in batch.column("text").to_pylist():
                found, n = shingles(body, width)
                hashes.append(found.tobytes())
                counts.append(n.astype(np.int32).tobytes() if (n > 1).any() else b"")
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], pa.array(hashes, pa.binary()), pa.array(counts, pa.binary())],
                                             names=[*[f.name for f in kept], "hashes", "counts"])

    return texts.mapInArrow(sets, T.StructType([*kept, T.StructField("hashes", T.BinaryType()), T.StructField("counts", T.BinaryType())]))


def read_set(hashes: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    found = np.frombuffer(hashes, np.uint64)
    return found, np.frombuffer(counts, np.int32) if counts else np.ones(len(found), np.int32)


def one_of_equal(texts: DataFrame) -> DataFrame:
    """``texts`` (id, content, ...) with counted: true in one of equal texts, that of the smallest id."""
    copies = sized(texts.groupBy(F.col("content").alias("c")).agg(F.count("*").alias("n"), F.min("id").alias("i")).where("n > 1").drop("n"), 200_000, "copies")
    return texts.join(copies, F.col("content") == F.col("c"), "left").withColumn(
        "counted", F.col("c").isNull() | F.col("id").eqNullSafe(F.col("i"))).drop("c", "i")


def inverse_frequencies(sets: DataFrame) -> np.ndarray:
    """The factor of every slot, log(1 + texts / texts that hold the slot), over the ``sets`` marked counted."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, texts = np.zeros(1 << SLOT_BITS, np.int32), 0
        for batch in small_batches(batches, "hashes"):
            for hashes, counted in zip(batch.column("hashes").to_pylist(), batch.column("counted").to_pylist(), strict=True):
                if counted and hashes:
                    seen[slots(np.frombuffer(hashes, np.uint64))] += 1  # once for each slot
                    texts += 1
        if texts:
            blocks = seen.reshape(-1, COUNT_BLOCK)
            used = np.flatnonzero(blocks.any(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1, *used.tolist()], pa.int32()), pa.array([np.array([texts], np.int32).tobytes(), *[blocks[k].tobytes() for k in used]])], names=["block", "seen"])

    def add(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(seen, np.int32).astype(np.int64) for seen in rows.column("seen").to_pylist())
        return pa.table({"block": rows.column("block").slice(0, 1), "seen": pa.array([total.tobytes()])})

    schema = "block int, seen binary"
    found = sets.select("hashes", "counted").mapInArrow(count, schema).groupBy("block").applyInArrow(add, schema).collect()
    blocks = {r["block"]: np.frombuffer(r["seen"], np.int64) for r in found}
    texts = int(blocks.pop(-1, [0])[0])
    held = np.ones(1 << SLOT_BITS, np.int64)
    for block, seen in blocks.items():
        held[block * COUNT_BLOCK:(block + 1) * COUNT_BLOCK] = np.maximum(seen, 1)
    return np.log1p(texts / held) if texts else np.ones(len(held))


def _each_set(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in small_batches(batches, "hashes"):
        for hashes in batch.column("hashes").to_pylist():
            yield np.frombuffer(hashes, np.uint64)


def star_components(edges: DataFrame, spark: SparkSession) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b), by alternating large and small stars."""
    current = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "edges")
    state = None
    while True:
        both = current.select("u", "v").union(current.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        nearest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(nearest, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = cut(small.union(nearest.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == state:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        state = now


def near_duplicate_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with class_id and n_links (verified links of its text)."""
    kept = [f"`{c}`" for c in docs.columns if c.lower() not in ("class_id", "n_links")]
    return _classes(docs, key, text, **options).select(*kept, F.col("__class_id").alias("class_id"), F.col("__n_links").alias("n_links"))


def _classes(docs: DataFrame, key: str, text: str, width: int = 5, threshold: float = 0.8, bands: int = 16, rows: int = 4,
             small_bucket: int = 8) -> DataFrame:
    """``docs`` with __class_id, __n_links and the hashes __class_key and __content."""
    spark = docs.sparkSession
    texts = docs.select(F.col(key).alias("id"), F.unhex(F.md5(text)).alias("content"), F.col(text).alias("text")).where("content is not null")
    id_type = texts.schema["id"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw = sampler(bands * rows)
        for batch in small_batches(batches, "hashes"):
            keys, sums = [], []
            for body in zip(batch.column("hashes").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                hashes, counts = read_set(*body)
                own = weights.value.of(hashes, counts)
                keys.append(band_keys(draw.samples(hashes, own), rows) if len(hashes) else [])
                sums.append(float(own.sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("content"), pa.array(keys, pa.list_(pa.int64())), pa.array(sums, pa.float64())],
                names=["id", "content", "bands", "weight"])

    with passing(shingle_sets(one_of_equal(texts), width), "shingled") as sets:
        weights = spark.sparkContext.broadcast(Weights(inverse_frequencies(sets)))
        signed = cut(sets.mapInArrow(sign, f"id {id_type}, content binary, bands array<bigint>, weight double"), "signed")
    nodes = signed.groupBy("content").agg(F.min("id").alias("id"), F.first("bands").alias("bands"), F.first("weight").alias("weight"))
    placed = cut(nodes.select("content", "id", "weight", F.explode("bands").alias("band")), "bands")
    shared = placed.groupBy("band").agg(F.min("content").alias("centre"), F.max("content").alias("other")).where("centre != other").select("band", "centre")
    buckets = cut(placed.join(shared, "band").select("band", "content", "id", "weight"), "buckets")
    if buckets.isEmpty():
        links = spark.createDataFrame([], "a binary, b binary")
        roots = spark.createDataFrame([], "node binary, root binary")
    else:
        meeting = buckets.select(F.col("content").alias("c"), F.col("id").alias("i")).distinct()
        bodies = cut(texts.join(meeting, (texts["content"] == meeting["c"]) & texts["id"].eqNullSafe(meeting["i"]))
                     .dropDuplicates(["c", "i"]).select("content", "text"), "bodies")
        links, roots = _link(spark, buckets, bodies, weights, width, threshold, small_bucket)
    linked = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).groupBy("a").agg(F.count("*").alias("n_links"))
    classes = nodes.select("content", "id").join(roots, F.col("content") == F.col("node"), "left").select(
        "content", "id", F.coalesce("root", "content").alias("root"))
    names = classes.groupBy("root").agg(F.min("id").alias("class_id"))
    found = cut(classes.join(names, "root").join(linked, F.col("content") == F.col("a"), "left").select(
        F.col("content").alias("__own"), F.col("root").alias("__class_key"), F.col("class_id").alias("__named"), F.col("n_links").alias("__found")), "classes")
    mine = docs.select(*[f"`{c}`" for c in docs.columns], F.unhex(F.md5(text)).alias("__content"))
    return mine.join(found, F.col("__content") == F.col("__own"), "left").select(
        *[f"`{c}`" for c in docs.columns], F.when(F.col("__content").isNull(), F.col(key)).otherwise(F.col("__named")).alias("__class_id"),
        F.coalesce("__found", F.lit(0).cast("bigint")).alias("__n_links"), "__class_key", "__content")


def _link(spark: SparkSession, buckets: DataFrame, bodies: DataFrame, weights, width: int, threshold: float, small_bucket: int) -> tuple[DataFrame, DataFrame]:
    """Verified links between texts that share a bucket, and the components they make."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: tuple = (None, None)
        for batch in small_batches(batches, "text_a"):
            good = []
            for row, (name, a, b) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("b", "text_a", "text_b")), strict=True)):
                if kept[0] != name:
                    kept = (name, _weighted(b))
                if weighted_jaccard(_weighted(a), kept[1]) >= threshold - 1e-12:
                    good.append(row)
            take = pa.array(good, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("a").take(take), batch.column("b").take(take)], names=["a", "b"])

    def _weighted(body: str) -> tuple[np.ndarray, np.ndarray]:
        hashes, counts = shingles(body, width)
        return hashes, weights.value.of(hashes, counts)

    left, right = (bodies.select(F.col("content").alias(f"c{k}"), F.col("text").alias(f"text_{k}")).hint("merge") for k in "ab")
    links = roots = None

    def test(pairs: DataFrame) -> None:
        nonlocal links, roots
        pairs = cut(pairs.select(F.greatest("content", "other").alias("a"), F.least("content", "other").alias("b")).distinct(), "pairs")
        joined = pairs.join(left, F.col("a") == F.col("ca")).join(right, F.col("b") == F.col("cb")).drop("ca", "cb")
        new = cut(joined.mapInArrow(verify, "a binary, b binary"), "links")
        if not new.isEmpty():
            links = new if links is None else cut(links.union(new), "links")
            roots = star_components(links, spark)

    sizes = buckets.groupBy("band").agg(F.count("*").alias("n"))
    few = buckets.join(sizes.where(F.col("n") <= small_bucket).select("band"), "band").select("band", "content", "weight")
    many = cut(buckets.join(sizes.where(F.col("n") > small_bucket), "band").select("band", "content", "weight", "n"), "large-buckets")
    # A small bucket is compared in full: at most small_bucket / 2 pairs for each of its rows.
    pairs = few.join(few.select("band", F.col("content").alias("other"), F.col("weight").alias("heft")), "band").where("content > other")
    # A large one is compared with the text that meets most others in all its buckets: the middle of a family, if there is one.
    reach = many.groupBy("content").agg(F.sum("n").alias("reach"))
    middle = many.join(reach, "content").groupBy("band").agg(F.max(F.struct("reach", "content", "weight")).alias("m"))\
        .select("band", F.col("m.content").alias("other"), F.col("m.weight").alias("heft"))
    pairs = pairs.unionByName(many.select("band", "content", "weight").join(middle, "band").where("content != other"))
    test(pairs.where(_may_link(threshold)).select("content", "other"))
    # Texts of large buckets with several classes left meet once more, over the shingles that a link cannot do without.
    mixed = _mixed(many, roots)
    if not mixed.isEmpty():
        rest = bodies.join(mixed.groupBy("content").agg(F.first("weight").alias("weight")).hint("merge"), "content")
        with passing(shingle_sets(rest, width), "rest") as sets:
            rare = _prefixes(sets, weights, threshold)
        groups = cut(_groups(rare, roots, threshold, small_bucket), "groups")
        turn = 0
        while (pairs := _next_pairs(groups, roots, turn, threshold)) is not None:
            test(pairs)
            turn += 1
    if links is None:
        return spark.createDataFrame([], "a binary, b binary"), spark.createDataFrame([], "node binary, root binary")
    return links, roots


def _may_link(threshold: float) -> F.Column:
    """Whether the total weights allow the similarity: it is at most their ratio."""
    return F.least("weight", "heft") >= F.greatest("weight", "heft") * F.lit(threshold - 1e-9)


def _rooted(rows: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        rows = rows.withColumn("root", F.col("content"))
    else:
        rows = rows.join(roots, F.col("content") == F.col("node"), "left").withColumn("root", F.coalesce("root", "content")).drop("node")
    return cut(rows, "members")


def _mixed(rows: DataFrame, roots: DataFrame | None) -> DataFrame:
    """The rows of bands that hold several classes, with the root of each row's class."""
    rows = _rooted(rows, roots)
    mixed = rows.groupBy("band").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x != y").select("band")
    return cut(rows.join(mixed, "band"), "open")


def _prefixes(sets: DataFrame, weights, threshold: float) -> DataFrame:
    """(band, content, weight, part, low): a text under each shingle of its prefix, with the shingle's weight in it.

    Shingles are ordered from rare to common. What follows a text's prefix
    weighs less than ``threshold`` of the text, what follows its low prefix less
    than twice that over 1 + threshold. Similar texts share at least the latter
    part of the lighter one, so a shingle of the lighter one's low prefix is in
    the other's prefix. The order comes from counts in 2^SLOT_BITS hash slots:
    any order is right, a sharper one gives smaller groups.
    """
    def loaded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << SLOT_BITS, np.int64)
        for found in _each_set(batches):
            np.add.at(seen, slots(found), 1)
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(seen[used])], names=["slot", "n"])

    counted = sets.select("hashes").mapInArrow(loaded, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).where("n > 1").toArrow()
    load = np.ones(1 << SLOT_BITS, np.uint32)
    load[counted.column("slot").to_numpy()] = np.minimum(counted.column("n").to_numpy(), (1 << 32) - 1)
    loads = sets.sparkSession.sparkContext.broadcast(load)

    def prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "hashes"):
            rows, tokens, parts, lows = ([np.zeros(0, t)] for t in (np.int64, np.int64, np.float64, bool))
            for k, body in enumerate(zip(batch.column("hashes").to_pylist(), batch.column("counts").to_pylist(), strict=True)):
                hashes, counts = read_set(*body)
                own = weights.value.of(hashes, counts)
                order = np.lexsort((hashes, loads.value[slots(hashes)]))
                behind = np.cumsum(own[order][::-1])[::-1]
                take = order[behind >= (threshold - 1e-9) * own.sum()]
                rows.append(np.full(len(take), k))
                tokens.append(hashes[take].view(np.int64))
                parts.append(own[take])
                lows.append(behind[:len(take)] >= (2 * threshold / (1 + threshold) - 1e-9) * own.sum())
            take, keys, part, low = (np.concatenate(x) for x in (rows, tokens, parts, lows))
            for start in range(0, len(take), 50_000):
                end = start + 50_000
                at = pa.array(take[start:end])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[start:end]), batch.column("content").take(at), batch.column("weight").take(at), pa.array(part[start:end]), pa.array(low[start:end])],
                    names=["band", "content", "weight", "part", "low"])

    schema = "band bigint, content binary, weight double, part double, low boolean"
    return cut(sets.select("content", "weight", "hashes", "counts").mapInArrow(prefix, schema), "prefixes")


def _groups(rows: DataFrame, roots: DataFrame | None, threshold: float, small_bucket: int) -> DataFrame:
    """Groups of texts under a shingle, one of those with the same members, and what each text may share with other classes.

    Shingles that only one class holds are never shared with another: their
    weight is taken off, and texts that keep too little take no part.
    """
    rows = _rooted(rows, roots)
    facts = rows.groupBy("band").agg(F.min("root").alias("x"), F.max("root").alias("y"))
    alone = rows.join(facts.where("x = y").select("band").hint("merge"), "band").groupBy(F.col("content").alias("c")).agg(F.sum("part").alias("own"))
    able = rows.join(facts.where("x != y").select("band").hint("merge"), "band").join(alone.hint("merge"), F.col("content") == F.col("c"), "left").select(
        "band", "content", "weight", "low", (F.col("weight") - F.coalesce("own", F.lit(0.0))).alias("shared"))
    low = F.col("low") & (F.col("shared") >= F.lit(2 * threshold / (1 + threshold) - 1e-9) * F.col("weight"))
    able = cut(able.withColumn("low", low).where(F.col("shared") >= F.lit(threshold - 1e-9) * F.col("weight")).withColumn("place", _place()), "able")
    facts = able.groupBy("band").agg(
        F.count("*").alias("n"), F.count_if("low").alias("centres"), F.bit_xor(F.xxhash64("content", "low")).alias("x"),
        F.bit_xor(F.xxhash64("low", "content")).alias("y"), F.min(F.when(F.col("low"), F.col("place"))).alias("lowest"))
    one = facts.where("n > 1 and centres > 0").groupBy("n", "centres", "x", "y").agg(F.min(F.struct("band", "lowest")).alias("g")).select(
        F.col("g.band").alias("band"), "centres", F.when(F.col("n") <= small_bucket, 1.0).otherwise(F.col("g.lowest")).alias("lowest"))
    return able.join(one.hint("merge"), "band")


def _place() -> F.Column:
    """A text's place in a band's order of centres, even over 0 to 1."""
    return F.xxhash64("content", "band") / F.lit(2.0**64) + F.lit(0.5)


def _next_pairs(groups: DataFrame, roots: DataFrame | None, turn: int, threshold: float) -> DataFrame | None:
    """The centres of this turn with all texts of other classes that are not lighter; None at the end.

    Only texts under a shingle of their low prefix are centres, each once; in a
    small group all in the first turn. A pair stays if what both may share is enough.
    """
    def last(k: int) -> F.Column:  # the place of the last centre up to turn k
        return F.greatest("lowest", F.lit(2.0**k) / F.col("centres")) if k else F.col("lowest")

    rows = _mixed(groups, roots)
    waiting = rows.where("low").where(F.col("place") > last(turn - 1)) if turn else rows.where("low")
    if waiting.isEmpty():
        return None
    centres = waiting.where(F.col("place") <= last(turn)).select(
        "band", F.col("content").alias("other"), F.col("root").alias("other_root"), F.col("weight").alias("heft"), F.col("shared").alias("most"))
    enough = F.least("shared", "most") >= F.lit(threshold / (1 + threshold) - 1e-9) * (F.col("weight") + F.col("heft"))
    return rows.join(centres, "band").where("root != other_root and weight >= heft").where(enough).select("content", "other")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each class, of its smallest id (ties: the smaller text hash); rows without text all stay."""
    found = _classes(docs, key, text, **options)
    candidates = found.where(F.col("__content").isNotNull() & F.col(key).eqNullSafe(F.col("__class_id"))).dropDuplicates(["__class_key", "__content"])
    first = candidates.withColumn("__n", F.row_number().over(Window.partitionBy("__class_key").orderBy("__content"))).where("__n = 1")
    return first.drop("__n").unionByName(found.where(F.col("__content").isNull())).select(*[f"`{c}`" for c in docs.columns])

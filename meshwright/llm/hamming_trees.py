"""SimHash near-duplicates: exact Hamming joins by vantage-point trees.

A text's fingerprint has a bit for each of the 64 bits that more than half of
its shingle hashes have. Texts whose fingerprints differ in at most ``radius``
bits are linked, and a component is what links connect.

Equal fingerprints are one point. A tree over a bounded sample of points cuts
the space into shards: a node holds a vantage point and deals points by their
Hamming distance to it into shells of about equal number. Every point is stored
in one shard. By the triangle inequality a point within ``radius`` of another
differs from it by at most ``radius`` in the distance to any vantage point, so
only the shells that this interval touches are visited and all other branches
are pruned.

A shard first connects its own points, by a tree of its own. Then points go to
the other shards that their ball touches, and pairs of different local
components are tested there. Two shards whose points mostly belong to one
component (a large family of near copies) exchange only the points that do not:
a pair of different components always has a member that is sent. Shards emit one
edge per pair of components, and the components of these edges are found by
alternating stars, so neither pairs nor fingerprints of all texts meet anywhere.

Cases: a null text has no shingles; no shingles make the fingerprint zero, which
is linked like any other; repeated rows share a component; rows without an id
are linked and get a component id only from others; other columns of the input
pass through, except those named like an output.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from meshwright.llm.common import small_batches
from meshwright.llm.near_duplicates import star_components
from meshwright.session import cut

BITS = 64
SEED = 42
FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))  # A-Z to a-z
PIECE = 1 << 20  # bytes of a text that are split at once
BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
PAIRS = 1 << 18  # pairs compared at once
LEAF = 1_024  # points in a leaf of a shard's own tree
VANTAGES = 8  # candidates for a node's vantage point


def pieces(body: bytes) -> Iterator[bytes]:
    """The text in parts of about ``PIECE`` bytes that end at a space."""
    start = 0
    while start < len(body):
        stop = min(start + PIECE, len(body))
        while stop < len(body) and body[stop] not in b" \t\n\x0b\x0c\r":
            stop += 1
        yield body[start:stop]
        start = stop


def fingerprint(text: str | None, width: int = 4) -> int:
    """The fingerprint of a whole text."""
    seen = np.zeros((8, 256), np.int64)
    held: list[bytes] = []
    for part in pieces((text or "").encode().translate(FOLD)):
        held += part.split()
        if len(held) >= width:
            _count_bytes(seen, map(b" ".join, zip(*(islice(held, k, None) for k in range(width)))), len(held) - width + 1)
            held = held[len(held) - width + 1:]
    total = int(seen[0].sum())
    if not total:
        if not held:
            return 0
        _count_bytes(seen, [b" ".join(held)], 1)
        total = 1
    bits = (seen @ BYTE_BITS).ravel()  # lowest byte and lowest bit first
    return int.from_bytes(np.packbits(2 * bits > total, bitorder="little").tobytes(), "little")


def _count_bytes(seen: np.ndarray, shingles: Iterable[bytes], size: int) -> None:
    """Add the shingles' hashes to the counts of each byte value at each of the eight places."""
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), "<u8", size).view(np.uint8).reshape(-1, 8)
    for place in range(8):
        seen[place] += np.bincount(hashes[:, place], minlength=256)


def fingerprints(docs: DataFrame, text: str = "text", width: int = 4, name: str = "fingerprint") -> DataFrame:
    """``docs`` with the 64-bit fingerprint of every text, as a signed long, in place of the text."""
    kept = [c for c in docs.columns if c != text and c != name]
    schema = docs.select(*[f"`{c}`" for c in kept]).schema.add(name, LongType())

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text):
            found = np.array([fingerprint(t, width) for t in batch.column(text).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(found.view(np.int64))], names=[*kept, name])

    return docs.select(*[f"`{c}`" for c in kept], F.col(text)).mapInArrow(sign, schema)


@dataclass
class Node:
    """A leaf has a number; an inner node a vantage point, the last distance of every shell but the outermost, and children."""

    leaf: int = -1
    vantage: int = 0
    ends: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    children: list["Node"] = field(default_factory=list)


class Tree:
    """A vantage-point tree over 64-bit points; leaves are numbered from 0."""

    def __init__(self, points: np.ndarray, leaf: int, fanout: int = 3) -> None:
        self.size = 0
        self.fanout = fanout
        self.root = self._grow(np.unique(points.astype(np.uint64)), leaf)

    def _grow(self, points: np.ndarray, leaf: int) -> Node:
        best = None
        if len(points) > leaf:
            # Of a few candidates, the one whose distances spread most.
            picks = points[np.linspace(0, len(points) - 1, VANTAGES).astype(np.int64)]
            spread = [np.bitwise_count(points ^ p).astype(np.int64).var() for p in picks]
            best = picks[int(np.argmax(spread))]
        if best is None:
            self.size += 1
            return Node(leaf=self.size - 1)
        away = np.bitwise_count(points ^ best).astype(np.int64)
        cuts = np.sort(away)[[len(away) * i // self.fanout for i in range(1, self.fanout)]]
        ends = np.unique(np.minimum(cuts, away.max() - 1))
        shell = np.searchsorted(ends, away)
        return Node(vantage=int(best), ends=ends, children=[self._grow(points[shell == s], leaf) for s in range(len(ends) + 1)])

    def visits(self, points: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, indexes of the points whose ball touches it); radius 0 gives the leaf of each point."""
        waiting = [(self.root, np.arange(len(points)))]
        while waiting:
            node, index = waiting.pop()
            if not len(index):
                continue
            if node.leaf >= 0:
                yield node.leaf, index
                continue
            away = np.bitwise_count(points[index] ^ np.uint64(node.vantage)).astype(np.int64)
            low, high = np.searchsorted(node.ends, away - radius), np.searchsorted(node.ends, away + radius)
            waiting += [(child, index[(low <= s) & (s <= high)]) for s, child in enumerate(node.children)]


def near_pairs(queries: np.ndarray, points: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (query index, point index) within ``radius`` of each other."""
    tree = Tree(points, LEAF)
    homes = dict(tree.visits(points, 0))
    for leaf, asking in tree.visits(queries, radius):
        own = homes.get(leaf)
        if own is None:
            continue
        step = max(1, PAIRS // len(own))
        for start in range(0, len(asking), step):
            part = asking[start:start + step]
            q, p = np.nonzero(np.bitwise_count(queries[part][:, None] ^ points[own][None, :]) <= radius)
            if len(q):
                yield part[q], own[p]


def connect(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Component labels after links between indexes ``a`` and ``b``; a label is the smallest index of its component."""
    while True:
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            return labels
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        parent = np.arange(len(labels))
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while True:
            above = parent[parent]
            if np.array_equal(above, parent):
                break
            parent = above
        labels = parent[labels]


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).view(np.uint64)


def components(points: DataFrame, radius: int = 4, shards: int = 64, shard_points: int = 1 << 20, visits: int = 1 << 19,
               sample_points: int = 65_536, fanout: int = 3) -> DataFrame:
    """(fp, component) of the distinct 64-bit points in column ``fp``; a component is named by one of its points.

    The tree is grown on at most ``sample_points`` points in the order of a hash;
    all points are stored and asked. It has about ``shards`` leaves, more where
    these would hold over ``shard_points`` points. A task tests at most about
    ``visits`` visits to a shard.
    """
    spark = points.sparkSession
    size = points.count()
    wanted = min(sample_points, size)
    share = 1.0 if size <= sample_points else min(1.0, 2.0 * wanted / size)
    # A hash of the point keeps about the wanted number; sorting takes the rest away exactly.
    drawn = points.where(F.pmod(F.xxhash64("fp", F.lit(7)), F.lit(1 << 40)) < F.lit(int(share * (1 << 40))))
    sample = np.array([r[0] for r in drawn.orderBy(F.xxhash64("fp", F.lit(7)), "fp").limit(wanted).collect()], np.int64).view(np.uint64)
    tree = Tree(sample, max(16, wanted // max(shards, size // shard_points)), fanout)
    known = spark.sparkContext.broadcast(tree)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            home = np.zeros(batch.num_rows, np.int32)
            for leaf, index in known.value.visits(_unsigned(batch.column("fp")), 0):
                home[index] = leaf
            yield pa.RecordBatch.from_arrays([batch.column("fp"), pa.array(home)], names=["fp", "shard"])

    def inside(shard: pa.Table) -> pa.Table:
        own = np.sort(_unsigned(shard.column("fp").combine_chunks()))
        labels = np.arange(len(own))
        for a, b in near_pairs(own, own, radius):
            labels = connect(labels, a, b)
        return pa.table({"shard": shard.column("shard").combine_chunks(), "fp": own.view(np.int64), "local": own[labels].view(np.int64)})

    placed = points.select("fp").mapInArrow(place, "fp bigint, shard int")
    stored = cut(placed.groupBy("shard").applyInArrow(inside, "shard int, fp bigint, local bigint"), "shards")
    if tree.size == 1:
        return stored.select("fp", F.col("local").alias("component"))
    # The largest component of each shard: one row a shard.
    sizes = stored.groupBy("shard", "local").agg(F.count("*").alias("n"))
    most = np.zeros(tree.size, np.int64)
    filled = np.zeros(tree.size, bool)
    for r in sizes.groupBy("shard").agg(F.max(F.struct("n", "local")).alias("m")).collect():
        most[r["shard"]], filled[r["shard"]] = r["m"]["local"], True
    main = spark.sparkContext.broadcast((most, filled))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, there = main.value
        for batch in batches:
            home, own = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "local"))
            for leaf, index in known.value.visits(_unsigned(batch.column("fp")), radius):
                if not there[leaf]:
                    continue
                at = home[index]
                alike = (first[at] == first[leaf]) & (at != leaf)
                sent = index[np.where(alike, own[index] != first[leaf], at < leaf)]
                if len(sent):
                    take = pa.array(sent)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(sent), leaf, np.int32)), batch.column("fp").take(take), batch.column("local").take(take)],
                        names=["shard", "fp", "local"])

    def across(asking: pa.Table, held: pa.Table) -> pa.Table:
        found = [np.zeros((0, 2), np.int64)]
        if asking.num_rows and held.num_rows:
            (q, q_local), (p, p_local) = ((_unsigned(t.column("fp").combine_chunks()), t.column("local").to_numpy()) for t in (asking, held))
            for a, b in near_pairs(q, p, radius):
                edges = np.stack([q_local[a], p_local[b]], 1)
                found.append(np.unique(edges[edges[:, 0] != edges[:, 1]], axis=0))
        edges = np.unique(np.concatenate(found), axis=0)
        return pa.table({"a": edges[:, 0], "b": edges[:, 1]})

    asked = cut(stored.mapInArrow(ask, "shard int, fp bigint, local bigint"), "visits")
    # A shard that many points visit is asked in parts; each part meets all its points.
    parts = {r["shard"]: 1 + r["n"] // visits for r in asked.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    count = F.element_at(F.lit([parts.get(s, 1) for s in range(tree.size)]), F.col("shard") + 1)
    left = asked.withColumn("part", F.pmod(F.xxhash64("fp"), count))
    right = stored.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), count.cast("bigint") - 1)))
    edges = cut(left.groupBy("shard", "part").cogroup(right.groupBy("shard", "part")).applyInArrow(across, "a bigint, b bigint"), "edges")
    if edges.isEmpty():
        return stored.select("fp", F.col("local").alias("component"))
    roots = star_components(edges, spark)
    return stored.join(roots, F.col("local") == F.col("node"), "left").select("fp", F.coalesce("root", "local").alias("component"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4, radius: int = 4,
                    keep: list[str] | None = None, **options) -> DataFrame:
    """``docs`` (or its columns ``keep``) with fingerprint (16 hex digits) and component_id, the smallest id reachable over links."""
    outputs = ("fingerprint", "component_id")
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in outputs]
    inner = docs.select(F.col(key).alias("__id"), F.coalesce(F.col(text), F.lit("")).alias("__text"),
                        *[F.col(f"`{c}`").alias(f"__kept_{i}") for i, c in enumerate(kept)])
    signed = cut(fingerprints(inner, "__text", width, "__fp"), "fingerprints")
    points = cut(signed.groupBy(F.col("__fp").alias("fp")).agg(F.min("__id").alias("least")), "points")
    found = points.join(components(points, radius, **options), "fp")
    names = found.groupBy("component").agg(F.min("least").alias("component_id"))
    named = cut(found.join(names, "component").select("fp", "component_id"), "components")
    back = signed.join(named, signed["__fp"] == named["fp"])
    return back.select(*[F.col(f"__kept_{i}").alias(c) for i, c in enumerate(kept)],
                       F.lower(F.lpad(F.hex("__fp"), 16, "0")).alias("fingerprint"), "component_id")

"""Centroid clustering of integer vectors by progressive search in Walsh-Hadamard space.

A vector of 64 components becomes the integers floor(64 x). Their Walsh-Hadamard
transform is exact in integers and keeps distances: the squared difference of two
transforms is 64 times the squared distance. Its coefficients are ordered by
sequency, coarse before fine, and most of a distance tends to lie in few of them.

The search adds up squared coefficient differences level by level. After each
level the nearest centroid so far is finished for every vector, which bounds the
vector's least distance from above; a centroid whose sum already exceeds the
bound is strictly worse and goes. What stays is finished over all coefficients,
so the answer is the exact nearest centroid, ties to the smaller number.

Vectors are transformed where they are read, and every task sends one row of
sums per centroid: counts and component sums, never vectors. Centroids are
``k`` rows, a fixed size, whatever the number of vectors.

Cases: a vector is kept if it has exactly 64 components, none null or not finite.
Rows without an id never start a centroid; repeated rows are vectors of their
own, and with fewer vectors than ``k`` there are fewer centroids. Components
beyond 2^60 count as 2^60, and distances beyond a long as the largest long;
within 2^20 everything is in 64-bit integers, beyond it in Python's. Other
columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshwright.session import cut

SIZE = 64
SMALL = 1 << 20  # |component| up to which 64 squared coefficient differences fit in a long
LARGEST = 1 << 60
LONG = (1 << 63) - 1
LEVELS = (0, 1, 4, 16, SIZE)
BLOCK = 2_000


def walsh_hadamard(vectors: np.ndarray) -> np.ndarray:
    """Exact transform of integer rows by butterflies, coefficients in order of sequency."""
    out = vectors.copy()
    step = 1
    while step < SIZE:
        pairs = out.reshape(len(out), SIZE // (2 * step), 2, step)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(out), SIZE)
        step *= 2
    return out[:, sequency_order()]


def sequency_order() -> np.ndarray:
    """Coefficients by the number of sign changes in their row of the Hadamard matrix."""
    index = np.arange(SIZE)
    signs = np.bitwise_count(index[:, None] & index[None, :]) & 1
    return np.argsort((signs[:, 1:] != signs[:, :-1]).sum(1), kind="stable")


def search(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest centroid, squared distance, pairs finished) for integer rows of one kind of number."""
    if not len(vectors):
        return np.zeros(0, np.int64), vectors[:, 0], 0
    moved, marks = walsh_hadamard(vectors), walsh_hadamard(centroids)
    n, k = len(moved), len(marks)
    row, mark = np.repeat(np.arange(n), k), np.tile(np.arange(k), n)
    sums = np.zeros(n * k, moved.dtype)
    bound = np.full(n, None if moved.dtype == object else LONG, moved.dtype)

    def more(r: np.ndarray, m: np.ndarray, low: int, high: int) -> np.ndarray:
        gap = moved[r, low:high] - marks[m, low:high]
        return (gap * gap).sum(1)

    for low, high in zip(LEVELS[:-1], LEVELS[1:], strict=True):
        sums = sums + more(row, mark, low, high)
        if high == SIZE:
            break
        # The best so far of each vector; pairs lie in the order of vectors.
        starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        first = _lowest(sums, starts, len(row))
        full = sums[first] + more(row[first], mark[first], high, SIZE)
        owners = row[first]
        if moved.dtype == object:
            bound[owners] = [f if b is None or f < b else b for f, b in zip(full, bound[owners], strict=True)]
        else:
            bound[owners] = np.minimum(bound[owners], full)
        stay = (sums <= bound[row]).astype(bool)
        row, mark, sums = row[stay], mark[stay], sums[stay]
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    first = _lowest(sums, starts, len(row))
    return mark[first], sums[first] // SIZE, len(row)


def _lowest(values: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Index of the first smallest value of every run."""
    least = np.minimum.reduceat(values, starts)
    runs = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, size]))
    hits = np.flatnonzero((values == least[runs]).astype(bool))
    return hits[np.r_[True, np.diff(runs[hits]) > 0]]


def integers(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v) of the vectors that are kept, v as bigint components."""
    whole = (F.size(vector) == SIZE) & F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    scaled = F.transform(vector, lambda x: F.floor(
        F.greatest(F.lit(-float(LARGEST)), F.least(F.lit(float(LARGEST)), x.cast("double") * 64.0))).cast("bigint"))
    return vectors.where(F.col(vector).isNotNull() & F.coalesce(whole, F.lit(False))).select(F.col(key).alias("id"), scaled.alias("v"))


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, SIZE)


def _assigned(batch: pa.RecordBatch, centroids: list[list[int]]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, vectors, nearest centroid, squared distance) of blocks of a batch."""
    whole = _rows(batch)
    far = max((abs(x) for c in centroids for x in c), default=0)
    for start in range(0, len(whole), BLOCK):
        block = whole[start:start + BLOCK]
        kind = np.int64 if max(far, int(np.abs(block).max())) <= SMALL else object
        near, gap, _ = search(block.astype(kind), np.array(centroids, kind).reshape(-1, SIZE))
        yield start, block, near, gap


def _sums(points: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(cluster, n, c0 … c63): one row per task and cluster, then per cluster."""
    names = [f"c{i}" for i in range(SIZE)]
    kind = pa.decimal128(38, 0)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(centroids), SIZE), object)
        count = np.zeros(len(centroids), np.int64)
        for batch in batches:
            for _, block, near, _ in _assigned(batch, centroids):
                small = int(np.abs(block).max()) <= SMALL
                for c in np.unique(near):
                    own = block[near == c]
                    sums[c] += (own if small else own.astype(object)).sum(0).astype(object)
                    count[c] += len(own)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(count[used]), *[pa.array([int(x) for x in sums[used, i]], kind) for i in range(SIZE)]],
            names=["cluster", "n", *names])

    schema = ", ".join(["cluster int", "n bigint", *[f"{c} decimal(38,0)" for c in names]])
    return points.select("v").mapInArrow(fold, schema).groupBy("cluster").agg(
        F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in names])


def cluster(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 16, rounds: int = 3, seed: str = "1") -> tuple[DataFrame, list[list[int]]]:
    """(``key``, cluster, distance) of every kept vector, and the final centroids.

    The first centroids are the vectors with the smallest sha256 of
    ``seed:key``; a round assigns all vectors and moves every centroid that has
    vectors to the floor of their mean.
    """
    points = cut(integers(vectors, key, vector), "vectors")
    order: Column = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = points.where("id is not null").select(order.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    centroids = [list(r["v"]) for r in first]
    for _ in range(rounds if centroids else 0):
        for r in _sums(points, centroids).collect():  # at most k rows
            centroids[r["cluster"]] = [int(r[f"c{i}"]) // r["n"] for i in range(SIZE)]
    if not centroids:
        return points.select(F.col("id").alias(key), F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("bigint").alias("distance")), centroids
    id_type = points.schema["id"].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, block, near, gap in _assigned(batch, centroids):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(start, len(block)), pa.array(near.astype(np.int32)),
                     pa.array([min(int(g), LONG) for g in gap], pa.int64())], names=[key, "cluster", "distance"])

    return points.mapInArrow(assign, f"`{key}` {id_type}, cluster int, distance bigint"), centroids


def with_inertia(assigned: DataFrame) -> DataFrame:
    """``assigned`` with the distances summed over its cluster and over all vectors."""
    written = cut(assigned, "assigned")
    sums = written.where("cluster is not null").groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))
    found = {r["cluster"]: int(r["s"]) for r in sums.collect()}  # at most k rows
    each, whole = F.lit(None), F.lit(None)
    for number, value in found.items():
        each = F.when(F.col("cluster") == number, F.lit(min(value, LONG))).otherwise(each)
    if found:
        whole = F.lit(min(sum(found.values()), LONG))
    return written.withColumn("cluster_inertia", each.cast("bigint")).withColumn("inertia", whole.cast("bigint"))

"""Meshes of a bounded size, each worked on in one task.

Iterations and searches over one mesh need no shuffle between their steps once
its rows are together. A mesh with at most ``ROWS`` rows (a template has 7,906
vertices) is a small, bounded group; larger meshes are split off here and keep
their distributed plans, so no task ever holds an unbounded mesh.

The kernels repeat the arithmetic of the column expressions in the same order,
so both ways give the same numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from meshwright.plans.skew import attach_small
from meshwright.session import cut

ROWS = 1 << 17
DEALT = 1 << 18  # rows of a task that takes many meshes at once
LEAF = 128


def oversized(tables: list[DataFrame], limit: int | None = None, counted: bool = False) -> DataFrame | None:
    """(mesh_id) of the meshes with more than ``limit`` (``ROWS``) rows in a table, None if there are none.

    Tables carry their rows per mesh as nv; with ``counted`` rows are counted.
    The list has at most a row for every ``limit`` rows of the tables.
    """
    limit = ROWS if limit is None else limit
    found = None
    for table in tables:
        sizes = table.groupBy("mesh_id").agg(F.count(F.lit(1)).alias("nv")) if counted else table
        over = sizes.where(F.col("nv") > limit).select("mesh_id")
        found = over if found is None else found.union(over)
    found = found.distinct()
    return None if found.isEmpty() else cut(found, "oversized")


def without(table: DataFrame, meshes: DataFrame | None) -> DataFrame:
    return table if meshes is None else attach_small(table, meshes, ["mesh_id"], "left_anti")


def only(table: DataFrame, meshes: DataFrame) -> DataFrame:
    return attach_small(table, meshes, ["mesh_id"], "left_semi")


def per_mesh(left: DataFrame, right: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema) -> DataFrame:
    """``work`` on the rows of both tables that share a mesh_id: one exchange of both."""
    both = _both(left, right)

    def parts(rows: pa.Table) -> Callable[[int, int], pa.Table]:
        mine, theirs = _sides(rows)
        seconds = np.append(0, np.cumsum(rows.column("_second").to_numpy()))

        def one(start: int, end: int) -> pa.Table:
            first = end - int(seconds[end] - seconds[start])
            return work(mine.slice(start, first - start), theirs.slice(first, end - first))

        return one

    return _streamed(both, ["mesh_id"], ["_second"], parts, schema)


def _both(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of both tables, those of ``right`` marked ``_second``."""
    own = [F.col(f"`{c}`") for c in left.columns]
    other = [F.col(f"`{c}`") for c in right.columns]
    kinds = [F.struct(*own).alias("_left"), F.struct(*other).alias("_right")]
    none = [F.lit(None).cast(t.select(k).schema[0].dataType).alias(n) for t, k, n in zip((left, right), kinds, ("_left", "_right"))]
    return left.select("mesh_id", F.lit(False).alias("_second"), kinds[0], none[1]).unionByName(
        right.select("mesh_id", F.lit(True).alias("_second"), none[0], kinds[1]))


def _sides(rows: pa.Table) -> list[pa.Table]:
    return [pa.Table.from_arrays((column := rows.column(n).combine_chunks()).flatten(), names=[f.name for f in column.type]) for n in ("_left", "_right")]


def dealt(left: DataFrame, right: DataFrame, rows: int, work: Callable[[pa.Table, pa.Table], pa.Table], schema) -> DataFrame:
    """``work`` once per task on the rows of both tables, whole meshes together: one exchange, no sort.

    ``rows``, how many both tables have, sets the number of tasks. Tasks sized by
    their compressed bytes would hold more rows the larger the input is. Rows
    without a mesh_id drop out.
    """
    target = to_arrow_schema(schema)

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            table = pa.Table.from_batches(held)
            second = table.column("_second").to_numpy()
            mine, theirs = _sides(table)
            yield from work(mine.filter(pa.array(~second)), theirs.filter(pa.array(second))).select(target.names).cast(target).to_batches()

    both = _both(left, right).where(F.col("mesh_id").isNotNull())
    return both.repartition(tasks(left, rows), "mesh_id").mapInArrow(once, schema)


def tasks(frame: DataFrame, rows: int) -> int:
    """Tasks of about ``DEALT`` rows, fewer rows if cores would idle."""
    return max(min(frame.sparkSession.sparkContext.defaultParallelism, rows // 1_000), rows // DEALT + 1)


def mesh_numbers(*tables: pa.Table) -> list[np.ndarray]:
    """The mesh of every row as a number, the same in all tables."""
    names = pa.concat_arrays([t.column("mesh_id").combine_chunks() for t in tables]).dictionary_encode()
    return np.split(names.indices.to_numpy().astype(np.int64), np.cumsum([t.num_rows for t in tables])[:-1])


def ranked(*columns: pa.ChunkedArray) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """All ids in order, and of each column the ids' ranks and which are not null."""
    known, rank = np.unique(np.concatenate([pc.fill_null(c, 0).to_numpy() for c in columns]), return_inverse=True)
    ends = np.cumsum([len(c) for c in columns])[:-1]
    return known, np.split(rank, ends), [pc.is_valid(c).to_numpy() for c in columns]


def per_bin(left: DataFrame, right: DataFrame, bins: int, work: Callable[[pa.Table, pa.Table], pa.Table], schema) -> DataFrame:
    """``work`` on the rows of both tables in bins of whole meshes, for work that takes many meshes at once."""
    names = {c: f"_right_{c}" for c in right.columns}

    def meet(mine: pa.Table, other: pa.Table) -> pa.Table:
        other = other.drop_columns(["_right_bin"])
        return work(mine.drop_columns(["_bin"]), other.rename_columns([c.removeprefix("_right_") for c in other.column_names]))

    # Both sides may come from one table: new names keep their columns apart.
    other = right.withColumnsRenamed(names).withColumn("_right_bin", F.pmod(F.xxhash64("_right_mesh_id"), F.lit(bins)))
    own = left.withColumn("_bin", F.pmod(F.xxhash64("mesh_id"), F.lit(bins)))
    return own.groupBy("_bin").cogroup(other.groupBy("_right_bin")).applyInArrow(meet, schema)


def each_mesh(rows: DataFrame, work: Callable[[pa.Table], pa.Table], schema) -> DataFrame:
    """``work`` on the rows of every mesh: one exchange."""
    return each_group(rows, ["mesh_id"], [], work, schema)


def each_group(rows: DataFrame, keys: list[str], order: list[str], work: Callable[[pa.Table], pa.Table], schema) -> DataFrame:
    """``work`` on the rows that share ``keys``, in the given order: one exchange."""
    def parts(rows: pa.Table) -> Callable[[int, int], pa.Table]:
        return lambda start, end: work(rows.slice(start, end - start))

    return _streamed(rows, keys, order, parts, schema)


def _streamed(rows: DataFrame, keys: list[str], order: list[str], parts: Callable, schema) -> DataFrame:
    """Groups of sorted rows, worked on as they pass by.

    A task reads many small groups in one stream of batches, so a group costs
    what its work costs. It holds one batch and the group that a batch ends in.
    """
    target = to_arrow_schema(schema)

    def done(held: list[pa.RecordBatch], last: bool) -> tuple[list[pa.RecordBatch], list[pa.RecordBatch]]:
        """What the whole groups of the held batches give, and the rows of the group that may go on."""
        table = pa.Table.from_batches(held).combine_chunks()
        ends = np.unique(np.concatenate([pc.run_end_encode(table.column(k).combine_chunks()).run_ends.to_numpy() for k in keys]))
        starts = np.append(0, ends[:-1])
        rest = [] if last else table.slice(int(starts[-1])).to_batches()
        whole = len(ends) if last else len(ends) - 1
        if not whole:
            return [], rest
        one = parts(table.slice(0, int(ends[whole - 1])))
        found = [f for s, e in zip(starts[:whole].tolist(), ends[:whole].tolist()) if (f := one(s, e)).num_rows]
        if not found:
            return [], rest
        return pa.concat_tables([f.select(target.names).cast(target) for f in found]).combine_chunks().to_batches(), rest

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            goes_on = bool(held) and all(_same(held[0].column(k)[0], batch.column(k)[-1]) for k in keys)
            held.append(batch)
            if not goes_on:
                found, held = done(held, False)
                yield from found
        if held:
            yield from done(held, True)[0]

    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(stream, schema)


def _same(a: pa.Scalar, b: pa.Scalar) -> bool:
    return a.as_py() == b.as_py()


def floats(table: pa.Table, names: list[str]) -> np.ndarray:
    """Columns as a matrix of doubles; nulls are NaN."""
    return np.stack([table.column(n).cast(pa.float64()).to_numpy() for n in names], 1)


def blocks(points: np.ndarray, size: int = LEAF) -> list[np.ndarray]:
    """Index lists of at most ``size`` neighbouring points, by halving along the widest axis."""
    waiting, done = [np.arange(len(points))], []
    while waiting:
        index = waiting.pop()
        if len(index) <= size:
            if len(index):
                done.append(index)
            continue
        own = points[index]
        axis = int(np.argmax(own.max(0) - own.min(0)))
        order = np.argpartition(own[:, axis], len(index) // 2)
        waiting += [index[order[:len(index) // 2]], index[order[len(index) // 2:]]]
    return done


def box_gaps(low: np.ndarray, high: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """Squared distance from one box to each of many."""
    gap = np.maximum(0.0, np.maximum(lows - high, low - highs))
    return (gap * gap).sum(1)


def nearest_rows(queries: np.ndarray, targets: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query row, rank from 1, target id, squared distance) of the k nearest targets, ties to the lower id.

    Blocks of queries visit blocks of targets from the nearest box on, until the
    next box lies beyond every query's k-th distance so far.
    """
    held = blocks(targets)
    lows = np.array([targets[b].min(0) for b in held]).reshape(-1, targets.shape[1])
    highs = np.array([targets[b].max(0) for b in held]).reshape(-1, targets.shape[1])
    none = np.iinfo(np.int64).max
    parts = []
    for own in blocks(queries):
        asking = queries[own]
        best, who = np.full((len(own), k), np.inf), np.full((len(own), k), none)
        bounds = box_gaps(asking.min(0), asking.max(0), lows, highs)
        for b in np.argsort(bounds, kind="stable"):
            if bounds[b] > best[:, -1].max():
                break
            d2 = np.zeros((len(own), len(held[b])))
            for axis in range(queries.shape[1]):
                gap = asking[:, axis, None] - targets[None, held[b], axis]
                d2 += gap * gap
            best = np.concatenate([best, d2], 1)
            who = np.concatenate([who, np.broadcast_to(ids[held[b]], d2.shape)], 1)
            reach = np.partition(best, k - 1, axis=1)[:, k - 1, None]
            row, column = np.nonzero(best <= reach)
            near, name = best[row, column], who[row, column]
            order = np.lexsort((name, near, row))
            starts = np.searchsorted(row, np.arange(len(own)))
            taken = order[np.arange(len(row)) - starts[row] < k]
            best, who = near[taken].reshape(-1, k), name[taken].reshape(-1, k)
        row, place = np.nonzero(who != none)
        parts.append((own[row], place + 1, who[row, place], best[row, place]))
    if not parts:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.float64))
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def dot(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    return u[..., 0] * v[..., 0] + u[..., 1] * v[..., 1] + u[..., 2] * v[..., 2]


def triangle_distances(points: np.ndarray, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distance of every point (rows) to every triangle (columns)."""
    p = points[:, None, :]
    a, b, c = a[None], b[None], c[None]

    def side(origin: np.ndarray, end: np.ndarray) -> np.ndarray:
        along, offset = end - origin, p - origin
        length2 = dot(along, along)
        with np.errstate(divide="ignore", invalid="ignore"):
            t = np.where(length2 > 0.0, dot(offset, along) / length2, 0.0)
        gap = offset - along * np.clip(t, 0.0, 1.0)[..., None]
        return dot(gap, gap)

    ab, ac, ap = b - a, c - a, p - a
    normal = np.cross(ab, ac)
    area2 = dot(normal, normal)
    v, w = dot(np.cross(ap, ac), normal), dot(np.cross(ab, ap), normal)
    within = (area2 > 0.0) & (v >= 0.0) & (w >= 0.0) & (v + w <= area2)
    height = dot(ap, normal)
    sides = np.minimum(np.minimum(side(a, b), side(b, c)), side(c, a))
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(within, np.minimum(height * height / area2, sides), sides)


def surface_rows(points: np.ndarray, corners: np.ndarray) -> np.ndarray:
    """Distance of every point to the nearest triangle (rows of three points), by branch and bound over boxes of faces."""
    low, high = corners.min(1), corners.max(1)
    held = blocks((low + high) * 0.5, LEAF // 2)
    lows = np.array([low[b].min(0) for b in held])
    highs = np.array([high[b].max(0) for b in held])
    found = np.empty(len(points))
    for own in blocks(points, LEAF // 2):
        asking = points[own]
        best = np.full(len(own), np.inf)
        bounds = box_gaps(asking.min(0), asking.max(0), lows, highs)
        for b in np.argsort(bounds, kind="stable"):
            # Boxes and triangles round differently: leave room for that.
            if bounds[b] > best.max() * (1.0 + 1e-9):
                break
            near = corners[held[b]]
            best = np.minimum(best, triangle_distances(asking, near[:, 0], near[:, 1], near[:, 2]).min(1))
        found[own] = np.sqrt(best)
    return found


def gather(ids: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of each wanted id among the sorted ids, whether it is there)."""
    if not len(ids):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    place = np.minimum(np.searchsorted(ids, wanted), len(ids) - 1)
    return place, ids[place] == wanted

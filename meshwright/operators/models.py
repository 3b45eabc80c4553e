"""Running point models over bounded batches of a mesh's vertices.

A model sees a fixed number of points at a time. Batches cover every vertex and
overlap by votes; one batch is one small group, so a mesh of any size spreads
over as many tasks as it has batches.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meshwright.operators.crop import normalized_points, vote_average
from meshwright.operators.landmarks import NAMES, decode_heatmaps
from meshwright.plans import bounded
from meshwright.plans.meshset import KEY, MeshSet
from meshwright.plans.ranking import BLOCK_ROWS, dense_index
from meshwright.plans.skew import attach
from meshwright.session import cut

PAD = "pad"


def seeded_rank(points: DataFrame, label: str, name: str) -> DataFrame:
    """Position of each (mesh_id, nv, seed, vid) in its mesh's order for a label.

    The order is that of a digest, so it needs no state and any task can compute
    its part of it. Blocks are ranges of the digest's leading digits.
    """
    digest = F.sha2(F.concat_ws(":", F.col("seed").cast("string"), F.lit(label), F.col("vid").cast("string")), 256)
    leading = F.conv(F.substring("_order", 1, 8), 16, 10).cast("bigint")
    blocks = F.expr(f"cast(nv div {BLOCK_ROWS} as bigint) + 1")
    ordered = points.withColumn("_order", digest)
    return dense_index(
        ordered, ["mesh_id"], "_order", name, block=F.floor(leading * blocks / F.lit(float(1 << 32)))
    ).drop("_order")


def _turns(rank: str, size: int | Column) -> Column:
    """The slots a vertex takes when slots cycle through the mesh's vertices."""
    last = (F.lit(size) if isinstance(size, int) else size) - 1
    return F.when(F.col(rank) <= last, F.sequence(F.col(rank), last.cast("bigint"), F.col("nv"))).otherwise(
        F.array().cast("array<bigint>"))


def vote_batches(points: DataFrame, num_points: int, extra_passes: int) -> DataFrame:
    """(mesh_id, batch, slot, vid): a shuffled cover plus extra random batches.

    ``points`` is (mesh_id, nv, seed, vid). The last covering batch is filled up
    from a second order; a mesh with fewer vertices than a batch repeats them.
    """
    if num_points <= 0 or extra_passes < 0:
        raise ValueError("invalid voting parameters")
    base = points.select("mesh_id", F.col("nv").cast("bigint").alias("nv"), "seed", "vid")
    ranked = cut(seeded_rank(seeded_rank(base, "cover", "rank"), PAD, "fill"), "vote-ranks")
    size = F.lit(num_points).cast("bigint")
    cover = ranked.select("mesh_id", F.col("rank").alias("place"), "vid")
    missing = F.pmod(-F.col("nv"), size)
    filled = ranked.select(
        "mesh_id", F.explode(_turns("fill", missing)).alias("extra"), "vid", "nv"
    ).select("mesh_id", (F.col("nv") + F.col("extra")).alias("place"), "vid")
    plan = cover.unionByName(filled).select(
        "mesh_id", F.expr(f"place div {num_points}").alias("batch"), (F.col("place") % size).alias("slot"), "vid")
    for number in range(extra_passes):
        again = seeded_rank(base, f"pass{number}", "rank")
        plan = plan.unionByName(again.select(
            "mesh_id", F.lit(-1 - number).cast("bigint").alias("batch"),
            F.explode(_turns("rank", num_points)).alias("slot"), "vid"))
    return plan


def _with_seed(meshes: MeshSet, seeds: DataFrame) -> DataFrame:
    sized = meshes.meshes().join(seeds.select("mesh_id", "seed"), "mesh_id")
    return attach(meshes.vertices.select(*KEY, "vid"), sized, KEY)


def _failure(batch: pa.Table, columns: list[str], error: Exception) -> pa.Table:
    """One row that names a batch's mesh and what its model call raised."""
    known = {"mesh_id": batch.column("mesh_id").slice(0, 1), "error": pa.array([f"{type(error).__name__}: {error}"])}
    return pa.table([known.get(c, pa.nulls(1)) for c in columns], names=columns)


def split_errors(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of meshes without an error, and (mesh_id, error) of the others.

    Rows of a model that knows no errors have no such column.
    """
    if "error" not in rows.columns:
        return rows, rows.select("mesh_id", F.lit("").alias("error")).where(F.lit(False))
    errors = rows.where(F.col("error").isNotNull()).groupBy("mesh_id").agg(F.min("error").alias("error"))
    return rows.drop("error").join(errors.select("mesh_id"), "mesh_id", "left_anti"), errors


def crop_scores(
    meshes: MeshSet, seeds: DataFrame, score: Callable[[np.ndarray], np.ndarray], num_points: int,
    extra_passes: int, isolate: bool = False,
) -> DataFrame:
    """(mesh_id, vid, probability): the mean vote of a batch model.

    ``score`` maps the N x 3 normalized points of one batch to N probabilities.
    With ``isolate`` there is a column error: a mesh for which the model raises
    has one row without a vertex that says so, and the other meshes go on.
    """
    plan = vote_batches(_with_seed(meshes, seeds), num_points, extra_passes)
    located = plan.join(normalized_points(meshes).drop("nv"), ["mesh_id", "vid"])

    def run(batch: pa.Table) -> pa.Table:
        try:
            values = np.asarray(score(bounded.floats(batch, list("xyz")).astype(np.float32)), dtype=float)
            if values.shape != (batch.num_rows,):
                raise ValueError(f"{values.shape} probabilities for {batch.num_rows} points")
            return pa.table([batch.column("mesh_id"), batch.column("vid"), pa.array(values, from_pandas=True),
                             pa.nulls(len(values), pa.string())], names=names)
        except Exception as error:
            if not isolate:
                raise
            return _failure(batch, names, error)

    names = ["mesh_id", "vid", "probability", "error"]
    schema = T.StructType([
        located.schema["mesh_id"], T.StructField("vid", located.schema["vid"].dataType),
        T.StructField("probability", T.DoubleType()), T.StructField("error", T.StringType())])
    votes = bounded.each_group(located, ["mesh_id", "batch"], ["slot"], run, schema)
    if not isolate:
        return vote_average(votes).select("mesh_id", "vid", "probability")
    sound, errors = split_errors(cut(votes, "votes"))
    failed = errors.select("mesh_id", F.lit(None).cast(located.schema["vid"].dataType).alias("vid"),
                           F.lit(None).cast("double").alias("probability"), "error")
    return vote_average(sound).select("mesh_id", "vid", "probability", F.lit(None).cast("string").alias("error")).unionByName(failed)


def landmark_points(
    meshes: MeshSet, seeds: DataFrame, predict: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]],
    num_points: int, top_k: int, isolate: bool = False,
) -> DataFrame:
    """(mesh_id, idx, x, y, z, peak, spread) decoded from heat maps and offsets.

    ``predict`` maps N x 3 normalized points to N x 9 probabilities and
    N x 9 x 3 offsets. One random batch per mesh is predicted. With ``isolate``
    there is a column error, and a mesh for which the model raises has one row
    without a landmark that says so.
    """
    ranked = seeded_rank(_with_seed(meshes, seeds).withColumn("nv", F.col("nv").cast("bigint")), "sample", "rank")
    chosen = ranked.select("mesh_id", F.explode(_turns("rank", num_points)).alias("slot"), "vid")
    located = chosen.join(normalized_points(meshes).drop("nv"), ["mesh_id", "vid"])

    def run(batch: pa.Table) -> pa.Table:
        points = bounded.floats(batch, list("xyz")).astype(np.float32)
        try:
            heat, offset = predict(points)
            n, marks = heat.shape
            spots = np.asarray(points[:, None, :] + offset, dtype=float)
            values = np.asarray(heat, dtype=float)
            if n != batch.num_rows or spots.shape != (n, marks, 3):
                raise ValueError(f"{heat.shape} probabilities and {offset.shape} offsets for {batch.num_rows} points")
            ids = batch.column("mesh_id").take(pa.array(np.zeros(n * marks, np.int64)))
            return pa.table([ids, pa.array(np.tile(np.arange(marks, dtype=np.int32), n)), pa.array(np.repeat(batch.column("slot").to_numpy(), marks)),
                             *[pa.array(a.reshape(-1), from_pandas=True) for a in (values, *np.moveaxis(spots, 2, 0))], pa.nulls(n * marks, pa.string())], names=names)
        except Exception as error:
            if not isolate:
                raise
            return _failure(batch, names, error)

    names = ["mesh_id", "idx", "vid", "p", *"xyz", "error"]
    schema = T.StructType([
        located.schema["mesh_id"], T.StructField("idx", T.IntegerType()), T.StructField("vid", T.LongType()),
        *[T.StructField(c, T.DoubleType()) for c in ("p", "x", "y", "z")], T.StructField("error", T.StringType())])
    votes = bounded.each_group(located, ["mesh_id"], ["slot"], run, schema)
    if isolate:
        votes, errors = split_errors(cut(votes, "heat"))
    decoded = decode_heatmaps(votes, top_k)
    centre = meshes.vertices.groupBy(*KEY).agg(*[F.avg(a).alias(f"c{a}") for a in "xyz"])
    gap2 = sum((F.col(a) - F.col(f"c{a}")) * (F.col(a) - F.col(f"c{a}")) for a in "xyz")
    reach = attach(meshes.vertices, centre, KEY).groupBy(*KEY).agg(
        F.sqrt(F.max(gap2)).alias("scale"), *[F.first(f"c{a}").alias(f"c{a}") for a in "xyz"])
    found = decoded.join(reach, "mesh_id").select(
        "mesh_id", "idx", *[(F.col(a) * F.col("scale") + F.col(f"c{a}")).alias(a) for a in "xyz"],
        "peak", (F.col("spread") * F.col("scale")).alias("spread"))
    if not isolate:
        return found
    return found.withColumn("error", F.lit(None).cast("string")).unionByName(errors, allowMissingColumns=True)


def crop_adapter(score: Callable[[np.ndarray], np.ndarray]) -> Callable[..., DataFrame]:
    """A crop adapter's predict function around a batch model."""
    def predict(meshes: MeshSet, seeds: DataFrame, parameters: dict[str, Any]) -> DataFrame:
        return crop_scores(
            meshes, seeds, score, parameters.get("input.sampling.num_points", 32768),
            parameters.get("inference.extra_passes", 2), isolate=True)

    return predict


def landmark_adapter(
    model: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], native: tuple[str, ...] = NAMES
) -> Callable[..., DataFrame]:
    """A landmark adapter's predict function around a heat-map model.

    ``native`` is the model's own landmark order.
    """
    def predict(meshes: MeshSet, seeds: DataFrame, parameters: dict[str, Any]) -> DataFrame:
        order = tuple(parameters.get("output_mapping.native_order", native))
        found = landmark_points(
            meshes, seeds, model, parameters.get("input.sampling.num_points", 32768),
            parameters.get("inference.top_k", 16), isolate=True)
        return canonical_order(found, order)

    return predict


def canonical_order(landmarks: DataFrame, native: tuple[str, ...]) -> DataFrame:
    """Renumber landmarks from a model's order to the canonical one."""
    if sorted(native) != sorted(NAMES):
        raise ValueError("a model must name each of the nine landmarks once")
    target = F.array(*[F.lit(NAMES.index(n)) for n in native])
    return landmarks.withColumn("idx", F.element_at(target, F.col("idx").cast("int") + 1))

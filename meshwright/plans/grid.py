"""Exact spatial joins: block search inside bounded meshes, multi-level grids beyond.

A mesh of bounded size is searched in one task by branch and bound over boxes
of its points. In a larger mesh neighbour search proceeds in rounds with a doubling radius. In a round, a point
meets only the candidates in the cells its search box touches, at most two per
axis, and is done once its answer lies within the radius. What is left goes to
the next round, so the answer is exact and pairs stay local.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from meshwright.plans import bounded
from meshwright.plans.skew import attach, probe_join
from meshwright.session import cut, spread

AXES = ("x", "y", "z")


def cells_touched(low: dict[str, Column], high: dict[str, Column], size: Column) -> Column:
    """Array of the cells an axis-aligned box touches."""
    spans = [
        F.sequence(F.floor(low[a] / size).cast("bigint"), F.floor(high[a] / size).cast("bigint"))
        for a in AXES
    ]
    return F.flatten(
        F.transform(
            spans[0],
            lambda i: F.flatten(
                F.transform(
                    spans[1],
                    lambda j: F.transform(
                        spans[2],
                        lambda k: F.struct(i.alias("cx"), j.alias("cy"), k.alias("cz")),
                    ),
                )
            ),
        )
    )


def cell_of(point: dict[str, Column], size: Column) -> Column:
    return F.struct(
        *[F.floor(point[a] / size).cast("bigint").alias(f"c{a}") for a in AXES]
    )


def finite(*columns: str) -> Column:
    """Whether all the columns are numbers other than NaN and infinity."""
    held = F.lit(True)
    for name in columns:
        held = held & F.coalesce(F.abs(name) < F.lit(float("inf")), F.lit(False))
    return held


def start_radius(points: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Per group: point count, a first search radius and the widest extent.

    The radius expects about k points in reach on a surface-like cloud.
    """
    span = F.greatest(*[F.max(a) - F.min(a) for a in AXES])
    stats = points.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), span.alias("_span"))
    guess = F.col("_span") * F.sqrt(F.lit(float(k)) / F.col("_n"))
    return stats.withColumn("_r0", F.when(guess > 0.0, guess).otherwise(F.lit(1.0)))


def nearest(
    queries: DataFrame, targets: DataFrame, k: int, features: list[str], label: str = "knn"
) -> DataFrame:
    """The k nearest targets of each query within its mesh.

    ``queries`` and ``targets`` are (mesh_id, nv, vid, x, y, z, …features), each
    with its own table's row count per mesh as nv. Rows with a feature that is not
    finite have no neighbours and are none.
    ``features`` name the columns of the distance and start with x, y, z. The
    result is (mesh_id, vid, rank, neighbour, d2); ties go to the lower id.
    Distance over more features than position is never smaller than positional
    distance, so the positional cells still hold every candidate.
    """
    wanted = ["mesh_id", "nv", "vid", *features]
    queries, targets = (t.where(finite(*features)).select(*wanted) for t in (queries, targets))
    large = bounded.oversized([queries, targets])
    found = _nearest_in_blocks(bounded.without(queries, large), bounded.without(targets, large), k, features)
    if large is None:
        return found
    return found.unionByName(_nearest_by_grid(bounded.only(queries, large), bounded.only(targets, large), k, features, label))


def _nearest_in_blocks(queries: DataFrame, targets: DataFrame, k: int, features: list[str]) -> DataFrame:
    """``nearest`` in meshes of bounded size: one exchange of each table."""
    schema = StructType([
        queries.schema["mesh_id"], queries.schema["vid"], StructField("rank", IntegerType()),
        StructField("neighbour", targets.schema["vid"].dataType), StructField("d2", DoubleType())])
    empty = to_arrow_schema(schema).empty_table()

    def search(asking: pa.Table, held: pa.Table) -> pa.Table:
        if not asking.num_rows or not held.num_rows:
            return empty
        row, rank, name, d2 = bounded.nearest_rows(
            bounded.floats(asking, features), bounded.floats(held, features),
            held.column("vid").cast(pa.int64()).to_numpy(), k)
        take = pa.array(row)
        return pa.table([asking.column("mesh_id").take(take), asking.column("vid").take(take), pa.array(rank, pa.int32()),
                         pa.array(name).cast(empty.schema.field("neighbour").type), pa.array(d2)], names=empty.column_names)

    return bounded.per_mesh(queries.drop("nv"), targets.drop("nv"), search, schema)


def _nearest_by_grid(
    queries: DataFrame, targets: DataFrame, k: int, features: list[str], label: str
) -> DataFrame:
    """``nearest`` in rounds over a grid, for meshes of any size."""
    stats = start_radius(targets, ["mesh_id", "nv"], k)
    asked = queries.groupBy("mesh_id", "nv").agg(F.count(F.lit(1)).alias("_asked"))
    asked = asked.join(stats.drop("nv"), "mesh_id").drop("_asked")
    # Coinciding targets: only the k lowest ids at one place can be neighbours.
    place = Window.partitionBy("mesh_id", *features).orderBy("vid")
    held = targets.withColumn("_i", F.row_number().over(place)).where(F.col("_i") <= k).drop("_i")
    wanted = ["mesh_id", "nv", "vid", *features]
    held = cut(
        attach(held.select(*wanted), stats.select("mesh_id", "nv", "_r0"), ["mesh_id", "nv"]),
        f"{label}-targets",
    )
    held_rows = held.count()
    sized = attach(queries.select(*wanted), asked, ["mesh_id", "nv"])
    # The whole table first, then only what is left of it.
    pending, rows = sized, queries.count()
    done: list[DataFrame] = []
    scale = 1.0
    while True:
        radius = F.col("_r0") * F.lit(scale)
        q = {a: F.col(a) for a in AXES}
        low = {a: q[a] - radius for a in AXES}
        high = {a: q[a] + radius for a in AXES}
        probes = spread(pending, rows).withColumn(
            "_cell", F.explode(cells_touched(low, high, radius * 2.0))
        )
        stored = held.select(
            "mesh_id", F.col("vid").alias("neighbour"),
            *[F.col(f).alias(f"t_{f}") for f in features],
            cell_of(q, radius * 2.0).alias("_cell"),
        )
        d2 = sum((F.col(f) - F.col(f"t_{f}")) * (F.col(f) - F.col(f"t_{f}")) for f in features)
        reach = d2 <= radius * radius
        pairs = probe_join(probes, stored, ["mesh_id", "_cell"], held_rows).where(reach).select(
            "mesh_id", "vid", "neighbour", d2.alias("d2")
        )
        best = Window.partitionBy("mesh_id", "vid").orderBy("d2", "neighbour")
        top = (
            pairs.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= k)
            .groupBy("mesh_id", "vid")
            .agg(F.array_sort(F.collect_list(F.struct("d2", "neighbour"))).alias("_found"))
        )
        answered = cut(
            pending.select("mesh_id", "vid", "_n").join(top, ["mesh_id", "vid"], "left"),
            f"{label}-round",
        )
        enough = F.coalesce(F.size("_found"), F.lit(0)) >= F.least(F.lit(k), F.col("_n"))
        done.append(answered.where(enough).select("mesh_id", "vid", "_found"))
        left = answered.where(~enough).select("mesh_id", "vid")
        rows = left.count()
        if rows == 0:
            break
        pending = cut(sized.join(left, ["mesh_id", "vid"], "left_semi"), f"{label}-left")
        scale *= 2.0
        if scale > 1e300:
            raise ValueError(f"{rows} searches have no answer at any radius")
    found = done[0]
    for part in done[1:]:
        found = found.unionByName(part)
    return found.select("mesh_id", "vid", F.posexplode("_found").alias("_pos", "_hit")).select(
        "mesh_id", "vid", (F.col("_pos") + 1).alias("rank"),
        F.col("_hit.neighbour").alias("neighbour"), F.col("_hit.d2").alias("d2"),
    )


def box_levels(width: Column, unit: Column) -> Column:
    """Grid level whose cells are at least as wide as a box."""
    ratio = F.when(unit > 0.0, width / unit).otherwise(F.lit(1.0))
    return F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(ratio, F.lit(1.0))))).cast("int")


def level_size(unit: Column, level: Column) -> Column:
    return F.when(unit > 0.0, unit).otherwise(F.lit(1.0)) * F.pow(F.lit(2.0), level)

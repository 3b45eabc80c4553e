"""Point-to-surface distance, surface residuals and self-intersection."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from meshwright.functions.vectors import Vec
from meshwright.operators.topology import with_corners
from meshwright.plans import bounded, grid
from meshwright.plans.bounded import dot
from meshwright.plans.grid import AXES
from meshwright.plans.meshset import KEY, MeshSet
from meshwright.plans.ranking import exact_quantiles
from meshwright.plans.skew import attach, probe_join
from meshwright.session import cut, spread

EPSILON = 1.0e-10
TURNS = ((0, 1), (1, 2), (2, 0))
# The first search radius is the mean face width times two to this power.
FIRST_STEP = 0


def point_triangle_distance(p: Vec, a: Vec, b: Vec, c: Vec) -> Column:
    """Distance from a point to the closest point of a triangle.

    If the point projects into the triangle the plane distance counts, otherwise
    the nearest of the three sides. A triangle without area has only sides.
    """
    ab, ac, ap = b.minus(a), c.minus(a), p.minus(a)
    normal = ab.cross(ac)
    area2 = normal.dot(normal)

    def side(origin: Vec, end: Vec) -> Column:
        along, offset = end.minus(origin), p.minus(origin)
        length2 = along.dot(along)
        t = F.when(length2 > 0.0, offset.dot(along) / length2).otherwise(F.lit(0.0))
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
        gap = offset.minus(along.times(t))
        return gap.dot(gap)

    # Barycentric weights of the projection, scaled by area2.
    v = ap.cross(ac).dot(normal)
    w = ab.cross(ap).dot(normal)
    within = (area2 > 0.0) & (v >= 0.0) & (w >= 0.0) & (v + w <= area2)
    height = ap.dot(normal)
    sides = F.least(side(a, b), side(b, c), side(c, a))
    return F.sqrt(F.when(within, F.least(height * height / area2, sides)).otherwise(sides))


def triangle_boxes(meshes: MeshSet) -> DataFrame:
    """Corner structs, bounding box and widest side of every face."""
    corners = with_corners(meshes)
    low = [F.least(*[F.col(f"p{n}.{a}") for n in "abc"]).alias(f"lo_{a}") for a in AXES]
    high = [F.greatest(*[F.col(f"p{n}.{a}") for n in "abc"]).alias(f"hi_{a}") for a in AXES]
    boxed = corners.select(*KEY, "fid", "a", "b", "c", "pa", "pb", "pc", *low, *high)
    return boxed.withColumn("width", F.greatest(*[F.col(f"hi_{a}") - F.col(f"lo_{a}") for a in AXES]))


def size_levels(boxes: DataFrame) -> DataFrame:
    """Add each mesh's mean face width and the grid level of each face."""
    unit = boxes.groupBy(*KEY).agg(F.avg("width").alias("_unit"))
    return attach(boxes, unit, KEY, spread="fid").withColumn(
        "_level", grid.box_levels(F.col("width"), F.col("_unit"))
    )


def surface_distances(points: DataFrame, surface: MeshSet, label: str = "surface") -> DataFrame:
    """(mesh_id, vid, distance) from each point to its mesh's surface.

    A mesh of bounded size is searched in one task by branch and bound over boxes
    of faces. In a larger mesh a face lives in the grid level its size calls for,
    in at most eight cells, and a point looks into every level in use, within a
    search radius that widens until its best distance lies inside it.
    Points with a coordinate that is not finite get no row, nor do points whose
    mesh has no finite face.
    """
    # A search for a point that is not finite, or among such faces, would never end.
    points = points.where(grid.finite(*AXES))
    if surface.largest <= bounded.ROWS:
        large = bounded.oversized([points])
        over = None
    else:
        large = bounded.oversized([points, surface.vertices])
        over = bounded.oversized([surface.faces], counted=True)
    if over is not None:
        large = over if large is None else large.union(over).distinct()
    found = _distances_in_blocks(
        bounded.without(points, large),
        MeshSet(bounded.without(surface.vertices, large), bounded.without(surface.faces, large)))
    if large is None:
        return found
    rest = MeshSet(bounded.only(surface.vertices, large), bounded.only(surface.faces, large))
    return found.unionByName(_distances_by_grid(bounded.only(points, large), rest, label))


def _distances_in_blocks(points: DataFrame, surface: MeshSet) -> DataFrame:
    """``surface_distances`` in meshes of bounded size.

    Points and vertices travel together, so a face finds its corners in the task
    that searches it: one exchange of points, one of faces.
    """
    schema = points.select("mesh_id", "vid", F.lit(0.0).alias("distance")).schema
    empty = to_arrow_schema(schema).empty_table()
    kind = schema["vid"].dataType
    spots = points.select("mesh_id", F.lit(True).alias("asked"), "vid", *AXES).unionByName(
        surface.vertices.select("mesh_id", F.lit(False).alias("asked"), F.col("vid").cast(kind).alias("vid"), *AXES))

    def search(spots: pa.Table, faces: pa.Table) -> pa.Table:
        asked = spots.filter(spots.column("asked"))
        held = spots.filter(pc.invert(spots.column("asked"))).sort_by("vid")
        if not asked.num_rows or not held.num_rows or not faces.num_rows:
            return empty
        ids, places = held.column("vid").to_numpy(), bounded.floats(held, list(AXES))
        found = [bounded.gather(ids, faces.column(c).to_numpy()) for c in "abc"]
        corners = np.stack([places[at] for at, _ in found], 1)
        whole = found[0][1] & found[1][1] & found[2][1] & np.isfinite(corners).all((1, 2))
        if not whole.any():
            return empty
        distance = bounded.surface_rows(bounded.floats(asked, list(AXES)), corners[whole])
        return pa.table([asked.column("mesh_id"), asked.column("vid"), pa.array(distance)], names=empty.column_names)

    return bounded.per_mesh(spots, surface.faces.select("mesh_id", "a", "b", "c"), search, schema)


def _distances_by_grid(points: DataFrame, surface: MeshSet, label: str) -> DataFrame:
    """``surface_distances`` in rounds over a grid, for meshes of any size."""
    boxes = triangle_boxes(surface)
    boxes = cut(boxes.where(grid.finite(*[f"{end}_{a}" for end in ("lo", "hi") for a in AXES])), f"{label}-boxes")
    # A face is stored in up to eight cells.
    stored_rows = 8 * boxes.count()
    sized = size_levels(boxes)
    # A mesh uses a few dozen levels at most: one per doubling of face size.
    tops = sized.groupBy("mesh_id").agg(
        F.first("_unit").alias("_unit"), F.collect_set("_level").alias("_levels")
    )
    asked = points.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_asked")).join(tops, "mesh_id")
    pending = attach(points.select(*KEY, "vid", *AXES), asked.drop("_asked"), KEY)
    pending = cut(pending.drop("nv"), f"{label}-points")
    done: list[DataFrame] = []
    step = FIRST_STEP
    while True:
        floor_level = F.lit(step)
        radius = grid.level_size(F.col("_unit"), floor_level.cast("double"))
        stored = sized.withColumn("_at", F.greatest("_level", floor_level)).withColumn(
            "_size", grid.level_size(F.col("_unit"), F.col("_at").cast("double"))
        )
        stored = stored.withColumn(
            "_cell",
            F.explode(grid.cells_touched(
                {a: F.col(f"lo_{a}") for a in AXES}, {a: F.col(f"hi_{a}") for a in AXES},
                F.col("_size"))),
        ).select("mesh_id", "_at", "_cell", "pa", "pb", "pc",
                 *[f"{end}_{a}" for end in ("lo", "hi") for a in AXES])
        levels = F.array_distinct(F.transform("_levels", lambda n: F.greatest(n, floor_level)))
        probes = spread(pending, pending.count()).withColumn("_at", F.explode(levels)).withColumn(
            "_size", grid.level_size(F.col("_unit"), F.col("_at").cast("double"))
        )
        probes = probes.withColumn(
            "_cell",
            F.explode(grid.cells_touched(
                {a: F.col(a) - radius for a in AXES}, {a: F.col(a) + radius for a in AXES},
                F.col("_size"))),
        ).select("mesh_id", "vid", *AXES, "_at", "_cell", radius.alias("_radius"))
        gap2 = sum(
            F.pow(F.greatest(F.col(f"lo_{a}") - F.col(a), F.col(a) - F.col(f"hi_{a}"), F.lit(0.0)), F.lit(2.0))
            for a in AXES
        )
        met = probe_join(probes, stored, ["mesh_id", "_at", "_cell"], stored_rows).where(
            gap2 <= F.col("_radius") * F.col("_radius")
        )
        distance = point_triangle_distance(
            Vec(F.col("x"), F.col("y"), F.col("z")), Vec.of("pa"), Vec.of("pb"), Vec.of("pc")
        )
        best = met.groupBy("mesh_id", "vid").agg(F.min(distance).alias("distance"))
        answered = cut(pending.join(best, ["mesh_id", "vid"], "left"), f"{label}-round")
        settled = F.coalesce(F.col("distance") <= radius, F.lit(False))
        done.append(answered.where(settled).select("mesh_id", "vid", "distance"))
        pending = answered.where(~settled).drop("distance")
        if pending.isEmpty():
            break
        step += 2
    found = done[0]
    for part in done[1:]:
        found = found.unionByName(part)
    return found


def residual_summary(distances: DataFrame, prefix: str, largest: int | None) -> DataFrame:
    """Mean, median, p95 and max of a distance column per mesh."""
    plain = [F.avg("distance").alias(f"{prefix}_mean"), F.max("distance").alias(f"{prefix}_max")]
    return exact_quantiles(
        distances, ["mesh_id"], "distance", {f"{prefix}_median": 0.5, f"{prefix}_p95": 0.95},
        largest=largest, also=plain,
    )


def surface_residuals(source: MeshSet, target: MeshSet) -> DataFrame:
    """Both directions of point-to-surface distance, chamfer and Hausdorff."""
    bound = max(source.largest, target.largest)
    forward = residual_summary(
        surface_distances(source.vertices, target, "forward"), "forward", bound)
    reverse = residual_summary(
        surface_distances(target.vertices, source, "reverse"), "reverse", bound)
    return forward.join(reverse, "mesh_id").select(
        "*",
        ((F.col("forward_mean") + F.col("reverse_mean")) * 0.5).alias("chamfer"),
        F.greatest("forward_max", "reverse_max").alias("hausdorff"),
    )


def overlapping_faces(meshes: MeshSet) -> DataFrame:
    """Pairs of faces without a shared vertex whose boxes overlap.

    Each face is stored in the grid level of its size and probes that level and
    the coarser ones in use. A pair is reported by the single cell that holds
    the low corner of the boxes' overlap, so no later distinct is needed.
    """
    boxes = cut(triangle_boxes(meshes), "boxes")
    face_rows = boxes.count()
    sized = size_levels(boxes)
    tops = sized.groupBy(*KEY).agg(F.collect_set("_level").alias("_levels"))
    corner = {end: {a: F.col(f"{end}_{a}") for a in AXES} for end in ("lo", "hi")}

    def placed(level: str) -> Column:
        size = grid.level_size(F.col("_unit"), F.col(level).cast("double"))
        return F.explode(grid.cells_touched(corner["lo"], corner["hi"], size))

    columns = ["fid", "a", "b", "c", "pa", "pb", "pc",
               *[f"{end}_{axis}" for end in ("lo", "hi") for axis in AXES]]
    stored = sized.withColumn("_cell", placed("_level")).select(
        *KEY, "_unit", F.col("_level").alias("_at"), "_cell",
        *[F.col(c).alias(f"s_{c}") for c in columns],
    )
    probes = attach(size_levels(spread(boxes, face_rows)), tops, KEY, spread="fid").withColumn(
        "_at", F.explode(F.filter("_levels", lambda n: n >= F.col("_level")))
    ).withColumn("_cell", placed("_at")).select(
        "mesh_id", "_at", "_cell", F.col("_level").alias("_own"),
        *[F.col(c).alias(f"q_{c}") for c in columns],
    )
    size = grid.level_size(F.col("_unit"), F.col("_at").cast("double"))
    start = {a: F.greatest(F.col(f"s_lo_{a}"), F.col(f"q_lo_{a}")) for a in AXES}
    overlap = F.lit(True)
    for a in AXES:
        overlap = overlap & (start[a] <= F.least(F.col(f"s_hi_{a}"), F.col(f"q_hi_{a}")))
    one_order = (F.col("_own") < F.col("_at")) | (F.col("q_fid") < F.col("s_fid"))
    apart = F.lit(True)
    for left in "abc":
        for right in "abc":
            apart = apart & (F.col(f"s_{left}") != F.col(f"q_{right}"))
    here = F.col("_cell") == grid.cell_of(start, size)
    return (
        probe_join(probes, stored, ["mesh_id", "_at", "_cell"], 8 * face_rows)
        .where(one_order & apart & overlap & here)
        .select(
            *KEY,
            F.least("q_fid", "s_fid").alias("first"), F.greatest("q_fid", "s_fid").alias("second"),
            *[F.col(f"q_p{n}").alias(f"q{n}") for n in "abc"],
            *[F.col(f"s_p{n}").alias(f"s{n}") for n in "abc"],
        )
    )


def _piercing(p: np.ndarray, q: np.ndarray, t: list[np.ndarray]) -> np.ndarray:
    """Whether the segments p-q meet the triangles t.

    A segment parallel to the plane (within epsilon) does not count.
    """
    along, side1, side2, s = q - p, t[1] - t[0], t[2] - t[0], p - t[0]
    h, r = np.cross(along, side2), np.cross(s, side1)
    det = dot(side1, h)
    with np.errstate(divide="ignore", invalid="ignore"):
        u, v, at = dot(s, h) / det, dot(along, r) / det, dot(side2, r) / det
    low, high = -EPSILON, 1.0 + EPSILON
    return (np.abs(det) > EPSILON) & (u >= low) & (u <= high) & (v >= low) & (u + v <= high) & (at >= low) & (at <= high)


def _turn(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (b[:, 0] - a[:, 0]) * (c[:, 1] - a[:, 1]) - (b[:, 1] - a[:, 1]) * (c[:, 0] - a[:, 0])


def _sides_cross(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Whether two plane segments cross properly or touch within epsilon."""
    def opposite(one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return ((one > EPSILON) & (two < -EPSILON)) | ((one < -EPSILON) & (two > EPSILON))

    def touches(p: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        boxed = (p >= np.minimum(start, end) - EPSILON) & (p <= np.maximum(start, end) + EPSILON)
        return (np.abs(_turn(start, end, p)) <= EPSILON) & boxed.all(1)

    proper = opposite(_turn(a, b, c), _turn(a, b, d)) & opposite(_turn(c, d, a), _turn(c, d, b))
    return proper | touches(c, a, b) | touches(d, a, b) | touches(a, c, d) | touches(b, c, d)


def _level_meet(q: list[np.ndarray], s: list[np.ndarray], normal: np.ndarray) -> np.ndarray:
    """Whether triangles in one plane meet: without the axis the normal leans on most, first one on ties."""
    lean = np.abs(normal)
    drop_x = (lean[:, 0] >= lean[:, 1]) & (lean[:, 0] >= lean[:, 2])
    drop_y = ~drop_x & (lean[:, 1] >= lean[:, 2])

    def flat(p: np.ndarray) -> np.ndarray:
        return np.stack([np.where(drop_x, p[:, 1], p[:, 0]), np.where(drop_x | drop_y, p[:, 2], p[:, 1])], 1)

    q, s = [flat(p) for p in q], [flat(p) for p in s]
    met = np.zeros(len(normal), bool)
    for i, j in TURNS:
        for m, n in TURNS:
            met |= _sides_cross(q[i], q[j], s[m], s[n])

    def holds(point: np.ndarray, around: list[np.ndarray]) -> np.ndarray:
        turns = np.stack([_turn(around[i], around[j], point) for i, j in TURNS], 1)
        return ~((turns > EPSILON).any(1) & (turns < -EPSILON).any(1))

    return met | holds(q[0], s) | holds(s[0], q)


def triangles_meet(q: list[np.ndarray], s: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Whether triangles (three arrays of corners each) meet, and whether they lie in one plane."""
    qn, sn = np.cross(q[1] - q[0], q[2] - q[0]), np.cross(s[1] - s[0], s[2] - s[0])
    off_q = np.stack([dot(corner - q[0], qn) for corner in s], 1)
    off_s = np.stack([dot(corner - s[0], sn) for corner in q], 1)
    sound = (np.sqrt(dot(qn, qn)) > EPSILON) & (np.sqrt(dot(sn, sn)) > EPSILON)
    level = sound & (np.abs(off_q) <= EPSILON).all(1) & (np.abs(off_s) <= EPSILON).all(1)

    def one_side(offsets: np.ndarray) -> np.ndarray:
        return (offsets > EPSILON).all(1) | (offsets < -EPSILON).all(1)

    met = np.zeros(len(qn), bool)
    rows = np.flatnonzero(level)
    met[rows] = _level_meet([c[rows] for c in q], [c[rows] for c in s], qn[rows])
    rows = np.flatnonzero(sound & ~level & ~one_side(off_q) & ~one_side(off_s))
    q, s = [c[rows] for c in q], [c[rows] for c in s]
    for i, j in TURNS:
        met[rows] |= _piercing(q[i], q[j], s) | _piercing(s[i], s[j], q)
    return met, level


def intersecting_faces(pairs: DataFrame) -> DataFrame:
    """The box-overlap pairs whose triangles meet."""
    kept = [*KEY, "first", "second"]

    def points(corner: pa.StructArray) -> np.ndarray:
        return np.stack([part.to_numpy(zero_copy_only=False) for part in corner.flatten()], 1)

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q, s = ([points(batch.column(f"{side}{n}")) for n in "abc"] for side in "qs")
            with np.errstate(invalid="ignore", over="ignore"):
                met, level = triangles_meet(q, s)
            take = pa.array(np.flatnonzero(met))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).take(take) for c in kept], pa.array(level[met])], names=[*kept, "level"])

    schema = pairs.select(*kept, F.lit(True).alias("level")).schema
    corners = [F.col(f"{side}{n}") for side in "qs" for n in "abc"]
    met = cut(pairs.select(*kept, *corners).mapInArrow(test, schema), "face-hits")
    # Faces that share an id pierce as one pair.
    return met.where(~F.col("level")).select(*kept).distinct().unionByName(met.where("level").select(*kept))


def self_intersections(meshes: MeshSet) -> DataFrame:
    """The number of intersecting non-adjacent face pairs per mesh."""
    pairs = intersecting_faces(cut(overlapping_faces(meshes), "face-pairs"))
    counted = pairs.groupBy(*KEY).agg(F.count(F.lit(1)).alias("pair_count"))
    return meshes.meshes().join(counted, KEY, "left").select(
        *KEY,
        F.coalesce("pair_count", F.lit(0)).alias("pair_count"),
    )

"""Similarity alignment, symmetrization and barycentric projection."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshwright.functions.rigid import best_rotation
from meshwright.plans.meshset import KEY, MeshSet
from meshwright.plans.skew import attach, attach_small

SIZE_RATIO, LEAST_SQUARES = "size_ratio", "least_squares"
MIN_WEIGHT = 1.0e-8
LANDMARK_COUNT = 9


def similarity(
    pairs: DataFrame, rule: str = SIZE_RATIO, allow_scaling: bool = True
) -> DataFrame:
    """The transform that best maps p onto q, one row per mesh.

    ``pairs`` is (mesh_id, nv, vid, px, py, pz, qx, qy, qz[, w]). Centroids and
    the centred moments are plain sums, so a mesh of any size folds map-side;
    only a 3x3 matrix per mesh reaches the decomposition.

    ``size_ratio`` scales by the ratio of centroid sizes; ``least_squares`` by
    the weighted optimum. Weights of at most 1e-8 drop out, and if fewer than
    three remain, all pairs count equally.
    """
    if "w" in pairs.columns:
        heavy = pairs.groupBy(*KEY).agg(F.count_if(F.col("w") > MIN_WEIGHT).alias("heavy"))
        weight = F.when(F.col("heavy") < 3, 1.0).otherwise(
            F.when(F.col("w") > MIN_WEIGHT, F.col("w")).otherwise(0.0))
        weighted = attach(pairs, heavy, KEY).withColumn("w", weight).drop("heavy")
    else:
        weighted = pairs.withColumn("w", F.lit(1.0))
    w = F.col("w")
    axes = [f"{side}{a}" for side in "pq" for a in "xyz"]
    centre = weighted.groupBy(*KEY).agg(
        F.sum(w).alias("sw"),
        *[(F.sum(w * F.col(n)) / F.sum(w)).alias(f"c{n}") for n in axes])
    centred = attach(weighted, centre, KEY).select(
        *KEY, "w", "sw", *[f"c{n}" for n in axes],
        *[(F.col(n) - F.col(f"c{n}")).alias(n) for n in axes])
    moments = [
        (F.sum(w * F.col(f"p{i}") * F.col(f"q{j}"))).alias(f"m{i}{j}") for i in "xyz" for j in "xyz"
    ]
    square = {s: sum(F.col(f"{s}{a}") * F.col(f"{s}{a}") for a in "xyz") for s in "pq"}
    folded = centred.groupBy(*KEY).agg(
        *moments, F.sum(w * square["p"]).alias("pp"), F.sum(w * square["q"]).alias("qq"),
        F.first("sw").alias("sw"), F.count(F.lit(1)).alias("pairs"),
        *[F.first(f"c{n}").alias(f"c{n}") for n in axes])
    solved = folded.where((F.col("pp") > 0.0) & (F.col("qq") > 0.0)).withColumn(
        "fit", best_rotation(F.array(*[F.col(f"m{i}{j}") for i in "xyz" for j in "xyz"])))
    if not allow_scaling:
        scale = F.lit(1.0)
    elif rule == SIZE_RATIO:
        scale = F.sqrt(F.col("qq")) / F.sqrt(F.col("pp"))
    else:
        scale = F.col("fit.strength") / F.col("pp")
    scaled = solved.withColumn("scale", scale).withColumn("rotation", F.col("fit.rotation"))
    shift = [
        (F.col(f"cq{axis}") - F.col("scale") * sum(
            F.col("rotation")[3 * row + col] * F.col(f"cp{n}") for col, n in enumerate("xyz")
        )).alias(f"t{axis}")
        for row, axis in enumerate("xyz")
    ]
    return scaled.select(
        *KEY, "rotation", "scale", *shift, "pairs",
        F.sqrt(F.col("pp")).alias("source_size"),
        F.sqrt(sum(F.col(f"cp{a}") * F.col(f"cp{a}") for a in "xyz")).alias("source_offset"),
        F.col("fit.second").alias("second"),
    )


def transformed(point: tuple[str, str, str] = ("x", "y", "z")) -> list[Column]:
    """x, y, z after scale, rotation and shift columns on the same row."""
    return [
        (F.col("scale") * sum(
            F.col("rotation")[3 * row + col] * F.col(n) for col, n in enumerate(point)
        ) + F.col(f"t{axis}")).alias(axis)
        for row, axis in enumerate("xyz")
    ]


def apply(points: DataFrame, transforms: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Move every point by its mesh's transform."""
    fields = transforms.select(*KEY, "rotation", "scale", "tx", "ty", "tz")
    return attach(points, fields, KEY).select(*KEY, *(keep or ["vid"]), *transformed())


def paired(source: DataFrame, target: DataFrame, on: str = "vid") -> DataFrame:
    """Source and target points side by side under p and q names."""
    return source.select(*KEY, F.col(on).alias("vid"), *[F.col(a).alias(f"p{a}") for a in "xyz"]).join(
        target.select("mesh_id", F.col(on).alias("vid"), *[F.col(a).alias(f"q{a}") for a in "xyz"]),
        ["mesh_id", "vid"],
    )


def _spans_a_plane(side: str) -> Column:
    """Aggregate: whether points are neither one place nor on one line, at any scale.

    The second elementary symmetric function of the covariance's eigenvalues
    vanishes against the square of their sum if only one of them is left.
    """
    x, y, z = (F.col(f"{side}{a}") for a in "xyz")
    spread = F.var_pop(x) + F.var_pop(y) + F.var_pop(z)
    minors = sum(F.var_pop(u) * F.var_pop(v) - F.covar_pop(u, v) * F.covar_pop(u, v) for u, v in ((x, y), (x, z), (y, z)))
    return (spread > 0.0) & (minors > 1.0e-14 * spread * spread)


def landmark_alignment(meshes: MeshSet, landmarks: DataFrame, template: DataFrame) -> tuple[MeshSet, DataFrame]:
    """Move whole meshes by the fit of their nine landmarks onto the template's.

    ``landmarks`` is (mesh_id, idx, x, y, z); ``template`` (idx, x, y, z), nine
    rows. The report has scale, residual and whether the input was usable.
    """
    sizes = meshes.meshes()
    named = landmarks.select("mesh_id", "idx", "x", "y", "z").join(sizes, "mesh_id")
    goal = template.select("idx", *[F.col(a).alias(f"q{a}") for a in "xyz"])
    pairs = attach_small(named, goal, ["idx"], row_limit=LANDMARK_COUNT).select(
        *KEY, F.col("idx").alias("vid"), *[F.col(a).alias(f"p{a}") for a in "xyz"], "qx", "qy", "qz")
    finite = F.lit(True)
    for side in "pq":
        for a in "xyz":
            value = F.col(f"{side}{a}")
            finite = finite & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))
    usable = pairs.groupBy(*KEY).agg(
        ((F.count(F.lit(1)) == LANDMARK_COUNT) & F.bool_and(finite) & _spans_a_plane("p") & _spans_a_plane("q")).alias("usable"))
    fit = similarity(pairs.join(usable.where("usable"), KEY).drop("usable"))
    moved = pairs.join(fit.select(*KEY, "rotation", "scale", "tx", "ty", "tz"), KEY)
    placed = moved.select(*KEY, "qx", "qy", "qz", *transformed(("px", "py", "pz")))
    gap2 = sum((F.col(a) - F.col(f"q{a}")) * (F.col(a) - F.col(f"q{a}")) for a in "xyz")
    rms = placed.groupBy(*KEY).agg(F.sqrt(F.avg(gap2)).alias("landmark_rms"))
    report = sizes.join(fit.join(rms, KEY), KEY, "left").select(
        *KEY, "scale", (F.col("scale") ** 3).alias("determinant"), "landmark_rms",
        F.col("scale").isNotNull().alias("aligned"))
    return meshes.with_vertices(apply(meshes.vertices, fit)), report


def gpa_align(meshes: MeshSet, template: DataFrame) -> tuple[MeshSet, DataFrame]:
    """Similarity-align registered meshes to reference points with the same ids.

    ``template`` is either shared (vid, x, y, z) or per mesh (mesh_id, vid, …).
    """
    if "mesh_id" in template.columns:
        pairs = paired(meshes.vertices, template)
    else:
        goal = template.select("vid", *[F.col(a).alias(f"q{a}") for a in "xyz"])
        source = meshes.vertices.select(*KEY, "vid", *[F.col(a).alias(f"p{a}") for a in "xyz"])
        pairs = attach_small(source, goal, ["vid"])
    fit = similarity(pairs)
    report = fit.select(
        *KEY, "scale", (F.col("scale") ** 3).alias("determinant"),
        F.col("source_offset").alias("centroid_norm"), F.col("source_size").alias("centroid_size"))
    return meshes.with_vertices(apply(meshes.vertices, fit)), report


def euler_rotation(degrees: tuple[float, float, float]) -> list[list[float]]:
    """Row-major matrix that turns about x, then y, then z."""
    (cx, sx), (cy, sy), (cz, sz) = [
        (math.cos(math.radians(d)), math.sin(math.radians(d))) for d in degrees]
    return [
        [cz * cy, cz * sy * sx - sz * cx, cz * sy * cx + sz * sx],
        [sz * cy, sz * sy * sx + cz * cx, sz * sy * cx - cz * sx],
        [-sy, cy * sx, cy * cx],
    ]


def rotate_about_centroid(
    vertices: DataFrame, degrees: tuple[float, float, float], inverse: bool = False
) -> DataFrame:
    """Turn each mesh about its own centroid."""
    matrix = euler_rotation(degrees)
    if inverse:
        matrix = [list(column) for column in zip(*matrix)]
    centre = vertices.groupBy(*KEY).agg(*[F.avg(a).alias(f"c{a}") for a in "xyz"])
    turned = [
        (sum((F.col(n) - F.col(f"c{n}")) * F.lit(matrix[row][col]) for col, n in enumerate("xyz"))
         + F.col(f"c{axis}")).alias(axis)
        for row, axis in enumerate("xyz")
    ]
    return attach(vertices, centre, KEY).select(*KEY, "vid", *turned)


def check_involution(refindex: DataFrame) -> None:
    """Reject a mirror table (vid, ref) that is not its own inverse."""
    back = refindex.select(F.col("vid").alias("ref"), F.col("ref").alias("back"))
    wrong = refindex.join(back, "ref", "left").where(
        F.col("back").isNull() | (F.col("back") != F.col("vid")))
    if not wrong.isEmpty():
        raise ValueError("refindex must be an involution over the vertex ids")


def symmetrize(meshes: MeshSet, mirror: DataFrame) -> tuple[MeshSet, DataFrame]:
    """Average each vertex with its mirrored partner, reflected in x.

    ``mirror`` is (vid, ref) for all meshes, or (mesh_id, vid, ref). The second
    result holds each vertex's displacement.
    """
    base = meshes.vertices.select(*KEY, "vid", "x", "y", "z")
    if "mesh_id" in mirror.columns:
        linked = base.join(mirror.select("mesh_id", "vid", "ref"), ["mesh_id", "vid"])
    else:
        linked = attach_small(base, mirror.select("vid", "ref"), ["vid"])
    partner = base.select(
        "mesh_id", F.col("vid").alias("ref"), (-F.col("x")).alias("rx"), F.col("y").alias("ry"),
        F.col("z").alias("rz"))
    moved = linked.join(partner, ["mesh_id", "ref"]).select(
        *KEY, "vid", *[((F.col(a) + F.col(f"r{a}")) * 0.5).alias(a) for a in "xyz"],
        F.sqrt(sum(F.pow((F.col(f"r{a}") - F.col(a)) * 0.5, F.lit(2.0)) for a in "xyz")).alias("distance"))
    return meshes.with_vertices(moved), moved.select(*KEY, "vid", "distance")


def same_topology(meshes: MeshSet, template_faces: DataFrame) -> DataFrame:
    """Whether each mesh's face rows equal the template's, in order."""
    total = template_faces.count()
    equal = attach_small(
        meshes.faces.select(*KEY, "fid", "a", "b", "c"),
        template_faces.select("fid", *[F.col(c).alias(f"t{c}") for c in "abc"]), ["fid"], "left")
    match = (F.col("a") == F.col("ta")) & (F.col("b") == F.col("tb")) & (F.col("c") == F.col("tc"))
    return equal.groupBy(*KEY).agg(
        ((F.count(F.lit(1)) == total) & (F.count_if(match) == total)).alias("same_topology"))


def barycentric_landmarks(meshes: MeshSet, table: DataFrame) -> DataFrame:
    """Points at fixed barycentric weights inside named faces.

    ``table`` is (idx, name, fid, l1, l2, l3): l3 weighs a face's first corner,
    l2 the second, l1 the third.
    """
    spots = attach_small(meshes.faces.select(*KEY, "fid", "a", "b", "c"), table, ["fid"])
    for corner in ("a", "b", "c"):
        side = meshes.vertices.select(
            "mesh_id", F.col("vid").alias(corner), F.struct("x", "y", "z").alias(f"p{corner}"))
        spots = spots.join(side, ["mesh_id", corner])
    return spots.select(
        *KEY, "idx", "name",
        *[(F.col("l3") * F.col(f"pa.{a}") + F.col("l2") * F.col(f"pb.{a}")
           + F.col("l1") * F.col(f"pc.{a}")).alias(a) for a in "xyz"])


def check_barycentric_table(table: DataFrame, face_count: int) -> None:
    """Reject weights that do not sum to one, repeated names or unknown faces."""
    total = F.col("l1") + F.col("l2") + F.col("l3")
    row = table.agg(
        F.count(F.lit(1)), F.count_distinct("name"), F.count_if(F.trim("name") == ""),
        F.count_if(F.abs(total - 1.0) > 1.0e-6), F.count_if(~F.col("fid").between(0, face_count - 1)),
        F.count_if(F.isnan(total))).first()
    if row[0] == 0 or row[2]:
        raise ValueError("landmark names must be non-empty")
    if row[0] != row[1]:
        raise ValueError("landmark names must be unique")
    if row[5]:
        raise ValueError("landmark weights must be finite")
    if row[3]:
        raise ValueError("landmark weights must sum to one")
    if row[4]:
        raise ValueError("landmark face index is out of range")

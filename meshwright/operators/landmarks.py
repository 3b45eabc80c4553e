"""Landmark decoding, snapping and measurements."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meshwright.operators.topology import boundary_vertices
from meshwright.plans.grid import nearest
from meshwright.plans.meshset import KEY, MeshSet

# The nine landmark names in their canonical order, the pairs
# whose distances are reported, and the midline points.
NAMES = (
    "bijian", "bigen", "bixia", "wyjzuo", "nyjzuo", "nyjyou", "wyjyou", "kouzuo", "kouyou",
)
PAIRS = {
    "outer_eye_width": ("wyjzuo", "wyjyou"),
    "inner_eye_width": ("nyjzuo", "nyjyou"),
    "mouth_width": ("kouzuo", "kouyou"),
    "nose_height": ("bigen", "bixia"),
}
MIDLINE = ("bijian", "bigen", "bixia")
MIN_WEIGHT_SUM = 1.0e-8


def decode_heatmaps(candidates: DataFrame, top_k: int) -> DataFrame:
    """Weighted mean of the k strongest candidates of each landmark.

    ``candidates`` is (mesh_id, idx, vid, p, x, y, z), where x, y, z already
    include the predicted offset. The row limit is pushed below the shuffle, and
    every later window sees at most k rows.
    """
    strongest = Window.partitionBy("mesh_id", "idx").orderBy(F.col("p").desc(), "vid")
    kept = candidates.withColumn("_rank", F.row_number().over(strongest)).where(F.col("_rank") <= top_k)
    few = Window.partitionBy("mesh_id", "idx")
    weighted = kept.withColumn("w", F.col("p") / F.greatest(F.sum("p").over(few), F.lit(MIN_WEIGHT_SUM)))
    centred = weighted.select(
        "mesh_id", "idx", "p", "w", *["x", "y", "z"],
        *[F.sum(F.col("w") * F.col(a)).over(few).alias(f"m{a}") for a in "xyz"])
    gap2 = sum((F.col(a) - F.col(f"m{a}")) * (F.col(a) - F.col(f"m{a}")) for a in "xyz")
    return centred.groupBy("mesh_id", "idx").agg(
        *[F.first(f"m{a}").alias(a) for a in "xyz"],
        F.sqrt(F.sum(F.col("w") * gap2)).alias("spread"), F.max("p").alias("peak"))


def snap(landmarks: DataFrame, meshes: MeshSet) -> DataFrame:
    """Move landmarks (mesh_id, nv, idx, x, y, z) onto their nearest vertex."""
    hits = nearest(
        landmarks.withColumn("vid", F.col("idx").cast("bigint")), meshes.vertices, 1,
        ["x", "y", "z"], "snap")
    located = hits.select(
        "mesh_id", F.col("vid").alias("idx"), F.col("neighbour").alias("vid"),
        F.sqrt("d2").alias("snap_distance"))
    return located.join(meshes.vertices.select("mesh_id", "vid", "x", "y", "z"), ["mesh_id", "vid"]).select(
        "mesh_id", "idx", F.col("vid").alias("vertex_id"), "x", "y", "z", "snap_distance")


def anatomy(landmarks: DataFrame) -> DataFrame:
    """Reported distances and the midline's spread in x, one row per mesh."""
    def point(name: str):
        return F.max(F.when(F.col("name") == name, F.struct("x", "y", "z")))

    held = landmarks.groupBy("mesh_id").agg(
        *[point(n).alias(n) for n in NAMES if any(n in p for p in PAIRS.values())],
        F.max(F.when(F.col("name").isin(*MIDLINE), F.col("x"))).alias("mid_max"),
        F.min(F.when(F.col("name").isin(*MIDLINE), F.col("x"))).alias("mid_min"))

    def distance(one: str, two: str):
        return F.sqrt(sum(
            (F.col(f"{one}.{a}") - F.col(f"{two}.{a}")) * (F.col(f"{one}.{a}") - F.col(f"{two}.{a}"))
            for a in "xyz"))

    return held.select(
        "mesh_id", *[distance(*ends).alias(name) for name, ends in PAIRS.items()],
        (F.col("mid_max") - F.col("mid_min")).alias("midline_x_range"))


def prediction_metrics(landmarks: DataFrame) -> DataFrame:
    """Heatmap and snap measurements per mesh; missing diagnostics stay null."""
    return landmarks.groupBy("mesh_id").agg(
        F.min("peak").alias("peak_min"), F.avg("peak").alias("peak_mean"),
        F.avg("snap_distance").alias("snap_distance_mean"),
        F.max("snap_distance").alias("snap_distance_max"))


def boundary_distance(landmarks: DataFrame, meshes: MeshSet) -> DataFrame:
    """Shortest way from any landmark to a boundary vertex; null without boundary."""
    edge = boundary_vertices(meshes).select("mesh_id", "vid")
    rim = meshes.vertices.join(edge, ["mesh_id", "vid"], "left_semi").select(*KEY, "vid", "x", "y", "z")
    hits = nearest(
        landmarks.withColumn("vid", F.col("idx").cast("bigint")), rim, 1, ["x", "y", "z"], "rim")
    shortest = hits.groupBy("mesh_id").agg(F.sqrt(F.min("d2")).alias("distance"))
    return meshes.meshes().join(shortest, "mesh_id", "left").select(
        "mesh_id", F.col("distance").alias("minimum_distance"),
        F.when(F.col("distance").isNull(), "not_applicable").otherwise("computed").alias("compute_status"))


def contract_failures(landmarks: DataFrame, meshes: MeshSet) -> DataFrame:
    """Broken landmark contracts per mesh.

    Snapped points must lie on their vertex within max(1e-8, 1e-12 max(1, |coordinate|)).
    """
    span = meshes.vertices.groupBy(*KEY).agg(
        F.max(F.greatest(*[F.abs(a) for a in "xyz"])).alias("reach"))
    limit = F.greatest(F.lit(1e-8), F.lit(1e-12) * F.greatest(F.lit(1.0), F.col("reach")))
    finite = F.lit(True)
    for a in "xyz":
        finite = finite & ~F.isnan(F.col(a)) & (F.abs(F.col(a)) < F.lit(float("inf")))
    sound = landmarks.where(finite)
    hits = nearest(
        sound.withColumn("vid", F.col("idx").cast("bigint")), meshes.vertices, 1, ["x", "y", "z"],
        "contract")
    off = hits.groupBy("mesh_id").agg(F.max(F.sqrt("d2")).alias("off"))
    counts = landmarks.groupBy("mesh_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~finite).alias("broken"))
    joined = span.withColumn("limit", limit).join(counts, "mesh_id", "left").join(off, "mesh_id", "left")
    n, broken = F.coalesce("n", F.lit(0)), F.coalesce("broken", F.lit(0))
    return joined.select(
        "mesh_id",
        F.array_compact(F.array(
            F.when(n != len(NAMES), "contract.landmarks_complete"),
            F.when(broken > 0, "contract.landmarks_finite"),
            F.when(F.coalesce(F.col("off") > F.col("limit"), F.lit(True)),
                   "contract.landmarks_snapped_on_mesh"))).alias("failures"))


def landmark_rms(left: DataFrame, right: DataFrame) -> DataFrame:
    """Root mean square distance between two predictions of the same landmarks."""
    both = left.join(
        right.select("mesh_id", "idx", *[F.col(a).alias(f"r{a}") for a in "xyz"]), ["mesh_id", "idx"])
    gap2 = sum((F.col(a) - F.col(f"r{a}")) * (F.col(a) - F.col(f"r{a}")) for a in "xyz")
    return both.groupBy("mesh_id").agg(F.sqrt(F.avg(gap2)).alias("rms"))


def stability(diagnostics: DataFrame) -> DataFrame:
    """Worst overlap and worst landmark drift over the diagnostic runs of a mesh."""
    return diagnostics.groupBy("mesh_id").agg(
        F.min("jaccard").alias("jaccard_min"), F.max("rms").alias("rms_max"))

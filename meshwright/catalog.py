"""Named queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshwright.functions import identity
from meshwright.functions.vectors import clean
from meshwright.operators import (
    align,
    audit,
    crop,
    landmarks,
    measure,
    models,
    qc_rules,
    qc_tools,
    register as registration,
    runs,
    surface,
    topology,
)
from meshwright.operators.qc_rules import Rule, RuleSet
from meshwright.plans import derive
from meshwright.plans.meshset import KEY
from meshwright.plans.ranking import global_position
from meshwright.session import cut
from meshwright.sources import inputs
from meshwright.sources import obj

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def registered(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


@registered
def mesh_edge_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = topology.edge_statistics(derive.strip(spark, sf_dir))
    return stats.select(
        "mesh_id", "edge_count", "boundary_edge_count", "nonmanifold_edge_count",
        *[clean(F.col(c)).alias(f"{c}_mm") for c in ("mean", "median", "p05", "p95")],
    )


@registered
def mesh_edge_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = topology.edge_list(derive.scrambled(spark, sf_dir).faces)
    return edges.select("mesh_id", "lo", "hi", "k")


@registered
def mesh_edge_mad(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topology.edge_mad(derive.strip(spark, sf_dir))
    return found.select(
        "mesh_id", clean(F.col("median")).alias("median_mm"), clean(F.col("mad")).alias("mad_mm")
    )


@registered
def mesh_boundary_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topology.boundary_vertices(derive.scrambled(spark, sf_dir)).select("mesh_id", "vid")


@registered
def mesh_nonmanifold_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = topology.edge_list(derive.scrambled(spark, sf_dir).faces)
    return edges.where(F.col("k") > 2).select("mesh_id", "lo", "hi", "k")


@registered
def mesh_face_area_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = topology.face_statistics(derive.scrambled(spark, sf_dir))
    return stats.select(
        "mesh_id", "face_count", "degenerate_face_count",
        clean(F.col("zero_face_normal_fraction")).alias("zero_face_normal_fraction"),
        clean(F.col("surface_area"), 4).alias("surface_area_mm2"),
    )


@registered
def mesh_bad_triangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topology.badly_sized_vertices(derive.strip(spark, sf_dir), zscore=1.5)
    return found.select("mesh_id", "vid")


@registered
def mesh_vertex_normals(spark: SparkSession, sf_dir: str) -> DataFrame:
    normals = topology.vertex_normals(derive.scrambled(spark, sf_dir))
    return normals.select("mesh_id", "vid", *[clean(F.col(c)).alias(c) for c in ("nx", "ny", "nz")])


@registered
def mesh_duplicate_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topology.duplicate_counts(derive.quantized(spark, sf_dir)).drop("nv")


@registered
def mesh_extent_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    meshes = derive.strip(spark, sf_dir)
    joined = topology.extents(meshes).join(topology.face_statistics(meshes), ["mesh_id", "nv"], "left")
    volume = F.col("extent_x") * F.col("extent_y") * F.col("extent_z")
    return joined.select(
        "mesh_id",
        *[clean(F.col(f"extent_{a}")).alias(f"extent_{a}_mm") for a in "xyz"],
        clean(F.try_divide("nv", volume), 10).alias("vertices_per_mm3"),
        clean(F.try_divide("nv", "surface_area"), 10).alias("vertices_per_mm2"),
    )


@registered
def mesh_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    meshes = derive.scrambled(spark, sf_dir)
    labels = topology.components(
        meshes.vertices, topology.edge_list(meshes.faces), meshes.largest, 3 * meshes.face_total
    )
    return topology.component_sizes(labels).select("mesh_id", "label", "size")


@registered
def mesh_largest_component(spark: SparkSession, sf_dir: str) -> DataFrame:
    meshes = derive.scrambled(spark, sf_dir)
    labels = topology.components(
        meshes.vertices, topology.edge_list(meshes.faces), meshes.largest, 3 * meshes.face_total
    )
    return topology.largest_component(labels).select("mesh_id", "label", "size")


# --- measurements and quality rules -------------------------------------------

EXPECTED_EDGE_MM = 1.2

# Rules over the measurements that derive.measurements builds from the events.
EVENT_RULES = RuleSet(
    "event_profile", "1",
    {
        "input.edge_length": "warning",
        "crop.retention": "warning",
        "landmark.anatomy": "record_only",
        "gpa.transform": "disabled",
        "registration.deformation": "warning",
    },
    (
        Rule("edge_high", "input.edge_length.median_mm", "gt", 62.0, "mm"),
        Rule("retention_band", "crop.retention.vertex_fraction", "outside", [30.0, 70.0], "ratio"),
        Rule("nose_low", "landmark.anatomy.nose_height_mm", "lt", 45.0, "mm"),
        Rule("scale_any", "gpa.transform.scale", "gte", 0.0, "ratio"),
        Rule("deform_unit", "registration.deformation.mean_mm", "lte", 30.0, "ratio"),
        Rule("deform_high", "registration.deformation.mean_mm", "gt", 52.0, "mm", "warning", "enhanced"),
    ),
)

# The same without the rule whose unit never matches, so that verdicts differ.
STATUS_RULES = RuleSet(
    "event_status", "1", EVENT_RULES.metric_groups,
    tuple(rule for rule in EVENT_RULES.rules if rule.rule_id != "deform_unit"),
)

INPUT_RULES = RuleSet(
    "mesh_profile", "1",
    {g: "warning" for g in ("input.edge_length", "input.topology", "input.connected_components",
                            "input.extent_density")} | {"input.duplicate_geometry": "record_only"},
    (
        Rule("edge_ratio", "input.edge_length.median_to_expected_ratio", "gt", 400.0, "ratio"),
        Rule("edge_mad", "input.edge_length.mad_mm", "gt", 210.0, "mm"),
        Rule("split", "input.connected_components.count", "gt", 1.0, "count"),
        Rule("open", "input.topology.boundary_edge_fraction", "outside", [0.4, 0.6], "ratio"),
        Rule("doubles", "input.duplicate_geometry.vertex_count", "gt", 0.0, "count"),
        Rule("tall", "input.extent_density.extent_y_mm", "lt", 1390.0, "mm"),
    ),
)


@registered
def mesh_input_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All scalar input measurements of every strip mesh, in long form."""
    rows = measure.input_measurements(derive.strip(spark, sf_dir), EXPECTED_EDGE_MM)
    return rows.select(
        "output_key", "metric", clean(F.col("value_double"), 5).alias("value"), "unit",
        "compute_status",
    )


@registered
def mesh_component_vertex_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure.component_vertex_counts(derive.scrambled(spark, sf_dir))


@registered
def mesh_quality_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From raw events to a verdict: measure every mesh and judge it."""
    rows = measure.input_measurements(derive.strip(spark, sf_dir), EXPECTED_EDGE_MM)
    verdicts = qc_rules.sample_status(rows, INPUT_RULES, "standard")
    return verdicts.select(
        "output_key", "status", "qc_incomplete",
        F.concat_ws(",", "triggered_rules").alias("triggered_rules"),
    )


@registered
def qc_measurements_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = qc_tools.scalar_measurements(derive.measurements(spark, sf_dir))
    return rows.select("output_key", "metric", "value_double", "unit", "compute_status")


@registered
def qc_metric_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derive.measurements(spark, sf_dir)
    group = F.coalesce(qc_rules.metric_group_column(F.col("metric")), F.lit("none"))
    return rows.groupBy(group.alias("metric_group")).agg(F.count(F.lit(1)).alias("n"))


@registered
def qc_rule_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = qc_rules.rule_results(derive.measurements(spark, sf_dir), EVENT_RULES, "standard")
    return results.select("output_key", "rule_id", "metric", "evaluated", "passed", "triggered",
                          "severity", "reason")


@registered
def qc_rule_results_enhanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = qc_rules.rule_results(derive.measurements(spark, sf_dir), EVENT_RULES, "enhanced")
    return results.groupBy("rule_id", "severity").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("evaluated").alias("evaluated"),
        F.count_if("triggered").alias("triggered"),
    )


@registered
def qc_sample_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = qc_rules.sample_status(derive.measurements(spark, sf_dir), STATUS_RULES, "standard")
    return verdicts.select("output_key", "status", "qc_incomplete",
                           F.concat_ws(",", "triggered_rules").alias("triggered_rules"))


@registered
def qc_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = qc_rules.sample_status(derive.measurements(spark, sf_dir), STATUS_RULES, "standard")
    return qc_tools.status_counts(verdicts)


@registered
def qc_run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = qc_rules.sample_status(derive.measurements(spark, sf_dir), STATUS_RULES, "standard")
    return qc_tools.run_counts(verdicts)


@registered
def qc_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = qc_tools.metric_distributions(derive.measurements(spark, sf_dir))
    names = ["min", "p01", "p05", "median", "p95", "p99", "max"]
    return found.select("metric", "unit", "n", *[clean(F.col(c)).alias(c) for c in names])


@registered
def qc_value_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calibration distribution over every raw event value."""
    events = derive.read(spark, sf_dir, "events").select(
        F.col("event_type").alias("metric"), F.lit("mm").alias("unit"),
        F.lit("double").alias("value_kind"), F.lit("computed").alias("compute_status"),
        F.col("value").alias("value_double"),
    )
    found = qc_tools.metric_distributions(events)
    names = ["min", "p01", "p05", "median", "p95", "p99", "max"]
    return found.select("metric", "unit", "n", *[clean(F.col(c)).alias(c) for c in names])


@registered
def qc_labeled_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confusion of a length rule on documents against the reviewed labels."""
    documents = derive.read(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labels = derive.read(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("output_key"),
        F.when(F.col("quality") == 1, "acceptable").otherwise("unacceptable").alias("label"),
    )
    measured = documents.select(
        F.col("doc_id").cast("string").alias("output_key"),
        F.lit("final.geometry.vertex_count").alias("metric"), F.lit("long").alias("value_kind"),
        F.col("n_chars").cast("double").alias("value_double"),
        F.lit(None).cast("string").alias("value_string"),
        F.lit(None).cast("array<double>").alias("value_array"),
        F.lit("count").alias("unit"), F.lit("computed").alias("compute_status"),
        F.lit(None).cast("string").alias("error"),
    )
    ruleset = RuleSet("length", "1", {"final.geometry": "warning"},
                      (Rule("short", "final.geometry.vertex_count", "lt", 400.0, "count"),))
    found = qc_tools.confusion(qc_tools.labeled_predictions(measured, labels, ruleset))
    rates = ["unacceptable_detection_rate", "acceptable_warning_rate"]
    return found.select(
        "evaluable_count", "true_positive", "false_positive", "true_negative", "false_negative",
        *[clean(F.col(c)).alias(c) for c in rates],
    )


@registered
def blinded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = derive.read(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("output_key")
    )
    return qc_tools.blinded_order(documents, seed=20260730, limit=25)


# --- crop and landmarks --------------------------------------------------------

THRESHOLD = 0.5


def _marked(spark: SparkSession, sf_dir: str, keep_largest: bool = True, minimum: int = 0):
    meshes = derive.scrambled(spark, sf_dir)
    return meshes, crop.masks(
        meshes, derive.probabilities(spark, sf_dir), THRESHOLD, keep_largest, minimum)


def _strip_crop(spark: SparkSession, sf_dir: str):
    meshes = derive.strip(spark, sf_dir)
    marked = cut(crop.masks(meshes, derive.probabilities(spark, sf_dir), 0.3), "masks")
    kept = marked.where("final").select("mesh_id", "vid")
    return meshes, marked, crop.crop(meshes, kept)


@registered
def vote_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    votes = derive.probabilities(spark, sf_dir).withColumn("vid", F.expr("vid div 3"))
    found = crop.vote_average(votes)
    return found.select("mesh_id", "vid", "votes", clean(F.col("probability"), 5).alias("probability"))


@registered
def crop_smooth_two_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    meshes = derive.scrambled(spark, sf_dir)
    found = crop.smooth(meshes, derive.probabilities(spark, sf_dir), 2, 0.5)
    return found.select("mesh_id", "vid", clean(F.col("probability"), 5).alias("probability"))


@registered
def crop_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, marked = _marked(spark, sf_dir)
    return marked.select("mesh_id", "vid", "initial", "final")


@registered
def crop_mask_all_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, marked = _marked(spark, sf_dir, keep_largest=False, minimum=2)
    return marked.groupBy("mesh_id").agg(
        F.count_if("initial").alias("initial_count"), F.count_if("final").alias("final_count"))


@registered
def crop_faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cropped faces in new numbering."""
    _, _, cropped = _strip_crop(spark, sf_dir)
    return cropped.faces.select("mesh_id", "fid", "a", "b", "c", "old_fid")


@registered
def crop_reindex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept vertices with old and new ids."""
    _, _, cropped = _strip_crop(spark, sf_dir)
    return cropped.vertices.select("mesh_id", "nv", "vid", "old_vid", "x")


@registered
def crop_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = crop.crop_metrics(*_strip_crop(spark, sf_dir))
    rounded = ["retained_vertex_fraction", "retained_face_fraction", "probability_mean",
               "probability_p05", "probability_p95", "changed_fraction",
               "largest_component_fraction"]
    return found.select("mesh_id", "changed_vertices", "kept_component_count", "usable",
                        *[clean(F.col(c)).alias(c) for c in rounded])


@registered
def mask_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = derive.probabilities(spark, sf_dir)
    left = scores.select("mesh_id", "vid", (F.col("probability") >= 0.5).alias("kept"))
    right = scores.select("mesh_id", "vid", (F.col("probability") >= 0.65).alias("kept"))
    return crop.mask_jaccard(left, right).select("mesh_id", clean(F.col("jaccard")).alias("jaccard"))


@registered
def stability_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlap and drift against four diagnostic thresholds, and the worst of them."""
    scores = derive.probabilities(spark, sf_dir)
    marks = derive.landmarks(spark, sf_dir)
    base = scores.select("mesh_id", "vid", (F.col("probability") >= 0.5).alias("kept"))
    runs = None
    for step in (1, 2, 3, 4):
        other = scores.select(
            "mesh_id", "vid", (F.col("probability") >= 0.5 + 0.05 * step).alias("kept"))
        shifted = marks.select(
            "mesh_id", "idx", (F.col("x") + F.col("idx") * (0.1 * step)).alias("x"), "y", "z")
        run = crop.mask_jaccard(base, other).join(landmarks.landmark_rms(marks, shifted), "mesh_id")
        runs = run if runs is None else runs.unionByName(run)
    found = landmarks.stability(runs)
    return found.select("mesh_id", *[clean(F.col(c)).alias(c) for c in ("jaccard_min", "rms_max")])


@registered
def normalized_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = crop.normalized_points(derive.strip(spark, sf_dir))
    return found.select(
        "mesh_id", "vid", *[clean(F.col(a).cast("double"), 4).alias(a) for a in "xyz"])


@registered
def landmark_snap(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = landmarks.snap(derive.landmarks(spark, sf_dir), derive.strip(spark, sf_dir))
    return found.select("mesh_id", "idx", "vertex_id",
                        clean(F.col("snap_distance")).alias("snap_distance"))


@registered
def landmark_anatomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = landmarks.anatomy(derive.landmarks(spark, sf_dir))
    return found.select("mesh_id", *[clean(F.col(c)).alias(f"{c}_mm") for c in found.columns[1:]])


@registered
def landmark_boundary_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = landmarks.boundary_distance(
        derive.landmarks(spark, sf_dir), derive.scrambled(spark, sf_dir))
    return found.select("mesh_id", clean(F.col("minimum_distance")).alias("minimum_distance_mm"),
                        "compute_status")


@registered
def landmark_topk_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decode one landmark per event type from its 16 strongest candidates."""
    vertices = derive.event_vertices(spark, sf_dir)
    candidates = vertices.select(
        "mesh_id", F.col("event_type").alias("idx"), "vid",
        (F.col("x") / (F.col("x") + 25.0)).alias("p"), "x", "y", "z")
    found = landmarks.decode_heatmaps(candidates, 16)
    return found.select("mesh_id", F.col("idx").alias("landmark"),
                        *[clean(F.col(c), 5).alias(c) for c in ("x", "y", "z", "spread", "peak")])


@registered
def landmark_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    meshes = derive.strip(spark, sf_dir)
    found = landmarks.contract_failures(derive.landmarks(spark, sf_dir), meshes)
    return found.select("mesh_id", F.concat_ws(",", "failures").alias("failures"))


# --- alignment -----------------------------------------------------------------


def _turned(points: DataFrame) -> DataFrame:
    """A known similarity of each point: 2.5 times a quarter turn about z, shifted."""
    return points.select(
        *KEY, "vid", (F.col("y") * -2.5 + 4.0).alias("x"), (F.col("x") * 2.5 - 2.0).alias("y"),
        (F.col("z") * 2.5 + 3.0).alias("z"))


@registered
def procrustes_recover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points moved by the solved transform; the truth is the known similarity."""
    points = derive.strip(spark, sf_dir).vertices
    fit = align.similarity(align.paired(points, _turned(points)))
    moved = align.apply(points, fit)
    return moved.select("mesh_id", "vid", *[clean(F.col(a), 5).alias(a) for a in "xyz"])


@registered
def gpa_align_recover(spark: SparkSession, sf_dir: str) -> DataFrame:
    meshes = derive.strip(spark, sf_dir)
    _, report = align.gpa_align(meshes, _turned(meshes.vertices))
    return report.select("mesh_id", clean(F.col("scale")).alias("scale"),
                         clean(F.col("determinant")).alias("determinant"),
                         clean(F.col("centroid_norm"), 5).alias("centroid_norm"),
                         clean(F.col("centroid_size"), 5).alias("centroid_size"))


@registered
def gpa_scale_noisy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scale onto coarse lattice copies: a ratio of centroid sizes."""
    meshes = derive.strip(spark, sf_dir)
    _, report = align.gpa_align(meshes, derive.quantized(spark, sf_dir).vertices)
    return report.select("mesh_id", clean(F.col("scale"), 8).alias("scale"))


@registered
def landmark_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coarse alignment of each mesh by nine landmarks onto one shared set."""
    # All suppliers, folded to nine points.
    template = derive.read(spark, sf_dir, "supplier").groupBy((F.col("s_suppkey") % 9).cast("int").alias("idx")).agg(
        F.avg("s_acctbal").alias("x"), F.avg(F.col("s_nationkey") * 10.0).alias("y")).withColumn("z", F.col("idx") * 7.0)
    _, report = align.landmark_alignment(
        derive.strip(spark, sf_dir), derive.landmarks(spark, sf_dir), template)
    return report.select("mesh_id", "aligned", clean(F.col("scale")).alias("scale"))


@registered
def rotate_about_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = derive.strip(spark, sf_dir).vertices
    turned = align.rotate_about_centroid(points, (5.0, -5.0, 5.0))
    back = align.rotate_about_centroid(turned, (5.0, -5.0, 5.0), inverse=True)
    return turned.join(
        back.select("mesh_id", "vid", F.col("x").alias("back_x")), ["mesh_id", "vid"]
    ).select("mesh_id", "vid", *[clean(F.col(c), 5).alias(c) for c in ("x", "y", "z", "back_x")])


@registered
def symmetrize(spark: SparkSession, sf_dir: str) -> DataFrame:
    meshes = derive.strip(spark, sf_dir)
    mirror = meshes.vertices.select("mesh_id", "vid", (F.col("nv") - 1 - F.col("vid")).alias("ref"))
    moved, distance = align.symmetrize(meshes, mirror)
    joined = moved.vertices.join(distance.drop("nv"), ["mesh_id", "vid"])
    return joined.select("mesh_id", "vid", *[clean(F.col(c)).alias(c) for c in ("x", "y", "z", "distance")])


@registered
def symmetry_displacement(spark: SparkSession, sf_dir: str) -> DataFrame:
    meshes = derive.strip(spark, sf_dir)
    mirror = meshes.vertices.select("mesh_id", "vid", (F.col("nv") - 1 - F.col("vid")).alias("ref"))
    _, distance = align.symmetrize(meshes, mirror)
    found = surface.residual_summary(distance, "displacement", meshes.largest)
    return found.select("mesh_id", *[clean(F.col(f"displacement_{c}")).alias(c) for c in ("mean", "p95", "max")])


@registered
def barycentric_landmarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One projected point per nation row, its weights derived from the keys."""
    table = derive.read(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("idx"), F.col("n_name").alias("name"),
        F.col("n_nationkey").cast("bigint").alias("fid"),
        ((F.col("n_regionkey") + 1) / 10.0).alias("l1"), F.lit(0.25).alias("l2"),
        (F.lit(0.75) - (F.col("n_regionkey") + 1) / 10.0).alias("l3"))
    found = align.barycentric_landmarks(derive.strip(spark, sf_dir), table)
    return found.select("mesh_id", "idx", "name", *[clean(F.col(a)).alias(a) for a in "xyz"])


@registered
def template_topology(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which meshes have exactly the faces of the smallest mesh id."""
    meshes = derive.strip(spark, sf_dir)
    first = meshes.faces.agg(F.min("mesh_id")).first()[0]
    template = meshes.faces.where(F.col("mesh_id") == first)
    return align.same_topology(meshes, template).select("mesh_id", "same_topology")


# --- surfaces ------------------------------------------------------------------


@registered
def surface_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance from every moved vertex to its mesh's surface."""
    meshes = derive.strip(spark, sf_dir)
    points = meshes.vertices.select(*KEY, "vid", (F.col("x") + 7.0).alias("x"), "y", (F.col("z") * 1.5).alias("z"))
    found = surface.surface_distances(points, meshes)
    return found.select("mesh_id", "vid", clean(F.col("distance"), 5).alias("distance"))


@registered
def surface_residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both directions between the scrambled surface and a shifted strip."""
    meshes = derive.strip(spark, sf_dir)
    moved = meshes.with_vertices(meshes.vertices.select(
        *KEY, "vid", (F.col("x") + 10.0).alias("x"), F.col("y"), (F.col("z") * 1.5).alias("z")))
    found = surface.surface_residuals(derive.scrambled(spark, sf_dir), moved)
    return found.select("mesh_id", *[clean(F.col(c), 5).alias(c) for c in
                                     ("forward_median", "reverse_p95", "chamfer", "hausdorff")])


@registered
def aabb_candidate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = surface.overlapping_faces(derive.scrambled(spark, sf_dir))
    return pairs.select("mesh_id", "first", "second")


@registered
def self_intersection_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surface.self_intersections(derive.scrambled(spark, sf_dir)).select("mesh_id", "pair_count")


# --- registration --------------------------------------------------------------


def _moving(spark: SparkSession, sf_dir: str):
    """Each strip mesh, slightly scaled, turned and shifted, next to itself."""
    meshes = derive.strip(spark, sf_dir)
    start = meshes.with_vertices(meshes.vertices.select(
        *KEY, "vid", (F.col("x") * 1.02 + F.col("z") * 0.05 + 1.0).alias("x"),
        (F.col("y") * 0.99 + 2.0).alias("y"), (F.col("z") * 1.01 - F.col("x") * 0.05).alias("z")))
    return start, meshes


@registered
def mesh_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = registration.mesh_flags(derive.scrambled(spark, sf_dir), True, True, 1.5)
    return flags.groupBy("mesh_id").agg(F.sum("flag").alias("flagged"))


@registered
def knn_affinity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights to the three nearest target vertices by position and normal."""
    start, meshes = _moving(spark, sf_dir)
    found = registration.affinity(
        cut(registration.features(start), "features"), cut(registration.features(meshes), "features"), 3)
    return found.select("mesh_id", "i", "j", clean(F.col("w"), 5).alias("w"))


@registered
def knn_smoothing_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    meshes = derive.strip(spark, sf_dir)
    flags = meshes.vertices.select(
        "mesh_id", "vid", F.when(F.col("vid") % 5 == 0, 0.0).otherwise(1.0).alias("flag"))
    found = registration.smoothing_weights(meshes.vertices, flags, 8, 40.0)
    return found.select("mesh_id", "i", "j", clean(F.col("w")).alias("w"))


def _matched(spark: SparkSession, sf_dir: str):
    start, meshes = _moving(spark, sf_dir)
    moving = cut(registration.features(start), "features")
    target = cut(registration.features(meshes), "features")
    flags = meshes.vertices.select(
        *KEY, "vid", F.when(F.col("vid") % 7 == 0, 0.0).otherwise(1.0).alias("flag"))
    found = registration.correspondences(moving, target, flags, flags, 3, 0.6)
    return moving, cut(found, "matched")


@registered
def correspondence_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symmetric correspondences of every floating vertex and their flags."""
    _, found = _matched(spark, sf_dir)
    return found.select("mesh_id", "vid", *[clean(F.col(f"c{a}"), 4).alias(f"c{a}") for a in "xyz"], "flag")


@registered
def inlier_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten re-weighting passes between the strip and a displaced copy."""
    meshes = derive.strip(spark, sf_dir)
    points = meshes.vertices
    zeros = [F.lit(0.0).alias(n) for n in ("nx", "ny", "nz")]
    floating = points.select(*KEY, "vid", "x", "y", "z", *zeros)
    matched = points.select(
        "mesh_id", "vid", (F.col("x") + F.col("vid") % 5).alias("cx"),
        (F.col("y") + F.col("vid") % 3).alias("cy"), F.col("z").alias("cz"),
        *[F.lit(0.0).alias(n) for n in ("cnx", "cny", "cnz")],
        F.when(F.col("vid") % 7 == 0, 0.0).otherwise(1.0).alias("flag"))
    found = registration.inlier_weights(floating, matched, 3.0)
    return found.select("mesh_id", "vid", clean(F.col("weight")).alias("weight"))


def _field(spark: SparkSession, sf_dir: str):
    """Smoothing weights of the strips, a displacement of every vertex and its inlier weight."""
    meshes = derive.strip(spark, sf_dir)
    flags = meshes.vertices.select(
        "mesh_id", "vid", F.when(F.col("vid") % 5 == 0, 0.0).otherwise(1.0).alias("flag"))
    base = registration.smoothing_weights(meshes.vertices, flags, 8, 40.0)
    field = meshes.vertices.select(
        "mesh_id", "vid", (F.col("x") / 10.0).alias("dx"), (F.col("y") / 100.0).alias("dy"), F.col("z").alias("dz"))
    inliers = meshes.vertices.select("mesh_id", "vid", ((F.col("vid") % 10 + 1) / 10.0).alias("weight"))
    return field, base, inliers


@registered
def smooth_field_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five averagings of a displacement over eight neighbours."""
    found = registration.smooth_field(*_field(spark, sf_dir), 5)
    return found.select("mesh_id", "vid", *[clean(F.col(d)).alias(d) for d in registration.FIELD])


@registered
def diffuse_outliers_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four blendings of weak vertices with their neighbours."""
    found = registration.diffuse_outliers(*_field(spark, sf_dir), 4)
    return found.select("mesh_id", "vid", *[clean(F.col(d)).alias(d) for d in registration.FIELD])


@registered
def viscoelastic_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One deformation: three viscous, two elastic and two diffusion passes of the pull."""
    meshes = derive.strip(spark, sf_dir)
    _, _, weights = _field(spark, sf_dir)
    flags = meshes.vertices.select(
        "mesh_id", "vid", F.when(F.col("vid") % 5 == 0, 0.0).otherwise(1.0).alias("flag"))
    matched = meshes.vertices.select(
        "mesh_id", "vid", (F.col("x") + F.col("vid") % 5).alias("cx"),
        (F.col("y") + F.col("vid") % 3 * 10).alias("cy"), (F.col("z") - F.col("vid") % 7).alias("cz"))
    options = registration.RegistrationOptions(
        transform_num_neighbours=8, transform_sigma=40.0, outlier_diffusion_iterations=2)
    moved = registration.viscoelastic_step(
        cut(registration.features(meshes), "features"), meshes.faces, matched, flags, weights, 3, 2, options)
    return moved.select("mesh_id", "vid", *[clean(F.col(a)).alias(a) for a in "xyz"])


@registered
def register_rigid_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rigid iteration onto a copy that is turned by a quarter, enlarged and shifted."""
    moving = cut(registration.features(derive.strip(spark, sf_dir)), "features")
    matched = moving.select(
        "mesh_id", "vid", (F.col("y") * -1.5 + 4.0).alias("cx"), (F.col("x") * 1.5 - 2.0).alias("cy"),
        (F.col("z") * 1.5 + 3.0).alias("cz"))
    weights = moving.select("mesh_id", "vid", ((F.col("vid") % 10 + 1) / 10.0).alias("weight"))
    moved, _ = registration.rigid_step(moving, matched, weights)
    return moved.select("mesh_id", "vid", *[clean(F.col(c), 5).alias(c) for c in registration.FEATURES])


@registered
def register_rigid_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rigid iteration: match, weigh, and solve the weighted similarity."""
    moving, found = _matched(spark, sf_dir)
    weights = cut(registration.inlier_weights(moving, found, 3.0), "weights")
    moved, _ = registration.rigid_step(moving, found, weights)
    after = registration.residuals(moved, found, weights)
    return after.select("mesh_id", clean(F.col("residual_mean"), 4).alias("residual_mean"),
                        clean(F.col("inlier_weight_mean"), 4).alias("inlier_weight_mean"))


@registered
def register_nonrigid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rigid and three non-rigid iterations of every displaced sheet onto its original, with all flags on."""
    meshes = derive.sheet(spark, sf_dir)
    start = meshes.with_vertices(_moving(spark, sf_dir)[0].vertices)
    options = registration.RegistrationOptions(
        rigid_iterations=1, nonrigid_iterations=2, transform_num_viscous_iterations_start=20,
        transform_num_elastic_iterations_start=20, transform_sigma=40.0)
    done = registration.register(start, meshes, options)
    return done.trajectory.select(
        "mesh_id", "phase", "iteration", clean(F.col("residual_mean"), 4).alias("residual_mean"))


# --- identity, runs, text scans and files --------------------------------------


@registered
def stage_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four stage seeds for every document's text hash."""
    documents = derive.read(spark, sf_dir, "documents")
    digest = F.sha2("text", 256)
    return documents.select(
        "doc_id", *[identity.stage_seed(digest, s, 42).cast("string").alias(f"seed_{s.replace(':', '_').lower()}")
                    for s in ("crop", "landmark", "crop:S1", "landmark:S1")])


@registered
def output_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys from page addresses; the host part collides across pages."""
    pages = derive.read(spark, sf_dir, "pages").select(
        "page_id", "url", F.substring_index("url", "/", 4).alias("stem"),
        F.col("url").alias("relative_path"), F.sha2("url", 256).alias("geometry_sha256"))
    return identity.assign_output_keys(pages).select("page_id", "output_key")


@registered
def geometry_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    meshes = derive.strip(spark, sf_dir)
    return identity.geometry_hashes(meshes.vertices, meshes.faces)


@registered
def duplicate_geometry_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many documents share each document's exact text."""
    documents = derive.read(spark, sf_dir, "documents").select(
        "doc_id", F.sha2("text", 256).alias("geometry_sha256"))
    return runs.duplicate_sizes(documents, "geometry_sha256").select("doc_id", "group_size")


@registered
def resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against recorded line items: what a resumed run would do."""
    orders = derive.read(spark, sf_dir, "orders")
    inputs = orders.select(F.col("o_orderkey").cast("string").alias("output_key"))
    recorded = derive.read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("output_key"),
        F.when(F.col("l_linestatus") == "O", "complete").otherwise("staged").alias("commit_state"),
        F.when(F.col("l_returnflag") == "R", "failed").otherwise("passed").alias("status"),
        (F.col("l_quantity") > 2.0).alias("same_fingerprints"), "l_shipdate", "l_linenumber")
    latest = runs.current_attempts(recorded.withColumnsRenamed(
        {"l_shipdate": "committed_at", "l_linenumber": "attempt_id"}))
    actions = runs.classify(inputs, latest, retry_failed=True)
    return actions.groupBy("action").agg(F.count(F.lit(1)).alias("n"))


@registered
def privacy_scan_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.findings(derive.read(spark, sf_dir, "documents"), "doc_id")


@registered
def privacy_scan_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.findings(derive.read(spark, sf_dir, "pages"), "page_id", "html")


@registered
def path_scan_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = derive.read(spark, sf_dir, "pages").select(F.col("url"))
    found = audit.path_findings(pages, "url", ["a", "p", "docs", "build", "dist"], [".html", ".pdf"])
    return found.groupBy("rule", "detail").agg(F.count(F.lit(1)).alias("n"))


@registered
def obj_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every strip mesh as OBJ text, read the files back.

    A file holds many small meshes, so files grow with the rows and not with the
    meshes; the comment that ends each line names its mesh.
    """
    from meshwright.session import scratch_path

    meshes = derive.strip(spark, sf_dir)
    folder = scratch_path(spark, "obj")
    lines = obj.obj_lines(meshes).repartitionByRange("mesh_id", "section", "pos").sortWithinPartitions(
        "mesh_id", "section", "pos")
    named = F.concat("text", F.lit(" # "), F.coalesce(F.col("mesh_id").cast("string"), F.lit("")))
    lines.select(named.alias("value")).write.text(folder)
    text = spark.read.text(folder).select(
        F.substring_index("value", " # ", -1).try_cast("bigint").alias("path"),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("id"), "value")
    # A mesh that spans part files continues in the next file name.
    order = text.select("path", "file", "start").distinct()
    from pyspark.sql import Window

    numbered = order.withColumn("block", F.row_number().over(
        Window.partitionBy("path").orderBy("file", "start")).cast("bigint"))
    parsed = obj.parse_lines(text.join(numbered, ["path", "file", "start"]).select(
        "path", "block", "id", "value"))
    found = parsed.groupBy(F.col("path").alias("mesh_id")).agg(
        F.count_if(F.col("directive") == "v").alias("vertices"),
        F.count_if(F.col("directive") == "f").alias("faces"),
        F.sum(F.when(F.col("directive") == "v", F.col("seen") * F.col("parts")[1].try_cast("double"))).alias("checksum"))
    return found.select("mesh_id", "vertices", "faces", clean(F.col("checksum"), 4).alias("checksum"))


# --- model batches and ordering ------------------------------------------------


@registered
def vote_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of 20 vertices that cover each mesh, and two extra votes."""
    points = derive.event_vertices(spark, sf_dir).select(*KEY, F.col("mesh_id").alias("seed"), "vid")
    return models.vote_batches(points, 20, 2)


@registered
def crop_model_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean vote of a stand-in point model, a plain function of height."""
    meshes = derive.strip(spark, sf_dir)
    seeds = meshes.meshes().select("mesh_id", F.col("mesh_id").alias("seed"))
    found = models.crop_scores(meshes, seeds, lambda points: 0.5 + 0.5 * points[:, 2], 32, 1)
    return found.select("mesh_id", "vid", clean(F.col("probability"), 4).alias("probability"))


@registered
def landmark_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a landmark model leaves of the meshes: points, or the error it raised on that mesh alone."""
    meshes = derive.strip(spark, sf_dir)
    seeds = meshes.meshes().select("mesh_id", F.col("mesh_id").alias("seed"))

    def model(points):
        import numpy as np

        distinct = len(np.unique(points, axis=0))
        if distinct % 7 == 0:
            raise ValueError(f"no face in {distinct} points")
        return np.full((len(points), 9), 0.5), np.zeros((len(points), 9, 3))

    found = models.landmark_points(meshes, seeds, model, 128, 4, isolate=True)
    return found.groupBy("mesh_id").agg(F.count("idx").alias("points"), F.max("error").alias("error"))


@registered
def landmark_reorder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landmarks of a model that lists them backwards."""
    marks = derive.landmarks(spark, sf_dir)
    found = models.canonical_order(marks, tuple(reversed(landmarks.NAMES)))
    return found.select("mesh_id", "idx", clean(F.col("x")).alias("x"))


@registered
def input_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages in input order: folded name, name, content."""
    pages = derive.read(spark, sf_dir, "pages").select(
        "page_id", F.col("url").alias("path"), F.sha2("html", 256).alias("geometry_sha256"))
    keyed = pages.select("page_id", *[c.alias(f"k{n}") for n, c in enumerate(inputs.sort_key())])
    return global_position(keyed, ["k0", "k1", "k2", "page_id"], "position").select("page_id", "position")


@registered
def calibration_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seeded sample of 300 documents."""
    documents = derive.read(spark, sf_dir, "documents").select("doc_id")
    return qc_tools.seeded_sample(documents, ["doc_id"], 300, 20260730)

"""A whole run: inputs to cropped, aligned, registered and judged meshes.

All samples go through each stage together. A sample that fails a stage gets a
failure row and is left out of the later ones; it never stops the others.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import meshwright
from meshwright.adapters import Adapter
from meshwright.functions.identity import stage_seed
from meshwright.operators import align, crop, landmarks, measure, qc_rules, register, runs, surface
from meshwright.operators.models import split_errors
from meshwright.operators.measure import MEASUREMENT_COLUMNS, long_form, scalar
from meshwright.operators.qc_rules import HARD_CONTRACTS
from meshwright.plans.meshset import KEY, MeshSet
from meshwright.plans.skew import attach
from meshwright.session import cut
from meshwright.sources import assets, inputs, obj, provenance, runmeta
from meshwright.sources.config import RunConfig
from meshwright.sources.store import Store

RUN_SCHEMA = "meshwright-run-v1"
# The stages whose seconds are measured.
STAGE_CLOCKS = ("crop", "landmark", "coarse_alignment", "registration", "gpa", "total")
# What an attempt writes, each below its own name, before its marker in ``commits``.
ATTEMPT_FOLDERS = ("attempts", "meshes", "trajectory", "landmarks")
# Rotations (degrees about x, y, z) and seed stages of the four
# diagnostic repetitions of the enhanced level.
DIAGNOSTICS = (
    ((0.0, 0.0, 0.0), "S1"), ((0.0, 0.0, 0.0), "S2"), ((5.0, -5.0, 5.0), "S3"), ((5.0, -5.0, 5.0), "S4"),
)


class RunError(ValueError):
    """A run cannot start or resume."""


@dataclass(frozen=True)
class Stages:
    """The two model adapters of a run and their parameters."""

    crop: Adapter
    landmark: Adapter
    crop_parameters: dict[str, Any] = field(default_factory=dict)
    landmark_parameters: dict[str, Any] = field(default_factory=dict)
    crop_seed: int = 42
    landmark_seed: int = 42


class StageClock:
    """Wall-clock seconds of each stage of a batch; every stage ends in written tables."""

    def __init__(self) -> None:
        self.began = self.last = time.perf_counter()
        self.seconds: dict[str, float] = {}

    def lap(self, stage: str) -> None:
        now = time.perf_counter()
        self.seconds[stage] = now - self.last
        self.last = now


@dataclass(frozen=True)
class Outcome:
    """Results of the stage chain, keyed by output_key as mesh_id."""

    measurements: DataFrame
    failures: DataFrame
    final: MeshSet
    trajectory: DataFrame
    stages: dict[str, DataFrame]
    clock: StageClock


def without(meshes: MeshSet, failures: DataFrame) -> MeshSet:
    """The meshes that have not failed; one failed id per mesh at most."""
    gone = failures.select("mesh_id").distinct()
    return MeshSet(
        meshes.vertices.join(gone, "mesh_id", "left_anti"), meshes.faces.join(gone, "mesh_id", "left_anti"))


def _failure_rows(rows: DataFrame, stage: str, reason, contract=None) -> DataFrame:
    return rows.select(
        "mesh_id", F.lit(stage).alias("stage"), F.lit(reason).alias("reason") if isinstance(reason, str) else reason.alias("reason"),
        (F.array().cast("array<string>") if contract is None else contract).alias("contracts"))


def _written(meshes: MeshSet, label: str) -> MeshSet:
    return MeshSet(cut(meshes.vertices, f"{label}-vertices"), cut(meshes.faces, f"{label}-faces"))


def process(
    spark: SparkSession, meshes: MeshSet, hashes: DataFrame, config: RunConfig, stages: Stages, level: str
) -> Outcome:
    """Measure, crop, mark, align, register and normalize every mesh.

    ``hashes`` is (mesh_id, geometry_sha256).
    """
    rows: list[DataFrame] = [measure.input_measurements(meshes, config.device["expected_edge_length_mm"])]
    template = _load_template(spark, config)
    seeds = hashes.select(
        "mesh_id", "geometry_sha256", stage_seed(F.col("geometry_sha256"), "crop", stages.crop_seed).alias("seed"))
    failures: list[DataFrame] = []

    clock = StageClock()
    cropped, marked, crop_rows, errors = _crop(meshes, seeds, stages)
    rows.append(crop_rows)
    failures.append(cut(_failure_rows(errors, "crop", F.col("error")), "failures"))
    clock.lap("crop")
    every = meshes.meshes().select("mesh_id").join(errors, "mesh_id", "left_anti")
    lost = every.join(cropped.vertices.groupBy("mesh_id").count().where("count >= 3").select("mesh_id"), "mesh_id", "left_anti")
    failures.append(cut(_failure_rows(lost, "crop", "crop produced an empty or faceless mesh"), "failures"))
    cropped = _written(without(cropped, failures[-1]), "cropped")

    points, landmark_rows, errors = _landmarks(cropped, hashes, stages)
    rows.append(landmark_rows)
    failures.append(cut(_failure_rows(errors, "landmark", F.col("error")), "failures"))
    cropped = without(cropped, failures[-1])
    clock.lap("landmark")
    broken = landmarks.contract_failures(points, cropped).where(F.size("failures") > 0)
    failures.append(cut(_failure_rows(
        broken, "landmark", F.concat_ws(", ", "failures"), F.col("failures")), "failures"))
    cropped = without(cropped, failures[-1])

    goal = assets.template_landmarks(spark, config.template_landmarks)
    kept_points = points.join(cropped.meshes().select("mesh_id"), "mesh_id", "left_semi")
    aligned, report = align.landmark_alignment(cropped, kept_points, goal)
    off = report.where(~F.col("aligned"))
    failures.append(cut(_failure_rows(
        off, "coarse_alignment", "landmarks cannot be aligned", F.array(F.lit("contract.landmark_alignment"))), "failures"))
    aligned = _written(without(aligned, failures[-1]), "aligned")
    clock.lap("coarse_alignment")

    start = _written(register.expand_template(template, aligned), "start")
    done = register.register(start, aligned, register.RegistrationOptions.of(config.registration))
    rows.append(_registration_rows(done, aligned))
    clock.lap("registration")

    normal = done.meshes
    if config.template_points is not None:
        reference = cut(assets.template_points(spark, config.template_points), "template-points")
    else:
        reference = template.vertices.select("vid", "x", "y", "z")
    normal, gpa = align.gpa_align(normal, reference)
    rows.append(long_form(gpa, "mesh_id", [
        scalar("gpa.transform.scale", F.col("scale"), "ratio"),
        scalar("gpa.transform.determinant", F.col("determinant"), "ratio")]))
    if config.symmetry_enabled and config.refindex is not None:
        mirror = assets.mirror_table(spark, config.refindex, config.expected_vertices)
        align.check_involution(mirror)
        normal, _ = align.symmetrize(normal, mirror)
    normal = _written(normal, "final")
    clock.lap("gpa")
    failures.append(cut(_final_contract(normal, aligned.meshes(), config), "failures"))
    hits = surface.self_intersections(normal)
    rows.append(long_form(hits, "mesh_id", [
        scalar("final.geometry.self_intersection_count", F.col("pair_count"), "count", "long"),
        scalar("final.geometry.vertex_count", F.col("nv"), "count", "long")]))
    if level == "enhanced":
        rows.append(_stability_rows(meshes, cropped, marked, points, hashes, stages))
    every_failure = failures[0]
    for part in failures[1:]:
        every_failure = every_failure.unionByName(part)
    measured = rows[0].select(*MEASUREMENT_COLUMNS)
    for part in rows[1:]:
        measured = measured.unionByName(part.select(*MEASUREMENT_COLUMNS))
    final = without(normal, every_failure)
    kept = {
        "input": meshes.vertices, "cropped": cropped.vertices, "aligned": aligned.vertices,
        "rigid": done.rigid_end, "registered": done.meshes.vertices, "landmarks": points,
        "correspondences": done.correspondences, "weights": done.weights, "mask": marked}
    return Outcome(cut(measured, "measurements"), every_failure, final, done.trajectory, kept, clock)


def _load_template(spark: SparkSession, config: RunConfig) -> MeshSet:
    parsed = obj.read_obj(spark, str(config.template_obj))
    defect = parsed.files.select("error").first()
    if defect is None or defect[0] is not None:
        raise RunError(f"template mesh cannot be read: {defect[0] if defect else 'empty file'}")
    template = _written(parsed.meshes, "template")
    counts = template.vertices.count(), template.faces.count()
    if counts != (config.expected_vertices, config.expected_faces):
        raise RunError(f"contract.template_topology: template has {counts[0]} vertices and {counts[1]} faces")
    return template


def _crop(meshes: MeshSet, seeds: DataFrame, stages: Stages) -> tuple[MeshSet, DataFrame, DataFrame, DataFrame]:
    """The crop, its mask, its measurements, and (mesh_id, error) of meshes whose model call failed."""
    given = stages.crop_parameters
    scores, errors = split_errors(cut(stages.crop.predict(meshes, seeds, given), "scores"))
    errors = cut(errors, "crop-errors")
    meshes = without(meshes, errors)
    scores = crop.smooth(
        meshes, scores, given.get("postprocess.smooth_iterations", 0), given.get("postprocess.smooth_alpha", 0.5))
    marked = cut(crop.masks(
        meshes, scores, given.get("postprocess.probability_threshold", 0.5),
        given.get("postprocess.keep_largest_component", True),
        given.get("postprocess.min_component_vertices", 0)), "marked")
    cropped = _written(crop.crop(meshes, marked.where("final").select("mesh_id", "vid")), "crop")
    c = F.col
    rows = long_form(crop.crop_metrics(meshes, marked, cropped), "mesh_id", [
        scalar("crop.retention.vertex_fraction", c("retained_vertex_fraction"), "ratio"),
        scalar("crop.retention.face_fraction", c("retained_face_fraction"), "ratio"),
        scalar("crop.probability.mean", c("probability_mean"), "probability"),
        scalar("crop.probability.p05", c("probability_p05"), "probability"),
        scalar("crop.probability.p95", c("probability_p95"), "probability"),
        scalar("crop.postprocess_delta.vertex_count", c("changed_vertices"), "count", "long"),
        scalar("crop.postprocess_delta.vertex_fraction", c("changed_fraction"), "ratio"),
        scalar("crop.spatial_structure.kept_component_count", c("kept_component_count"), "count", "long"),
        scalar("crop.spatial_structure.largest_component_fraction", c("largest_component_fraction"), "ratio")])
    slim = MeshSet(cropped.vertices.select(*KEY, "vid", "x", "y", "z"), cropped.faces.select(*KEY, "fid", "a", "b", "c"))
    return slim, marked, rows, errors


def _predict_landmarks(
    meshes: MeshSet, hashes: DataFrame, stages: Stages, stage: str = "landmark"
) -> tuple[DataFrame, DataFrame]:
    """Predicted points, and (mesh_id, error) of meshes whose model call failed."""
    seeds = hashes.select(
        "mesh_id", "geometry_sha256", stage_seed(F.col("geometry_sha256"), stage, stages.landmark_seed).alias("seed"))
    found, errors = split_errors(cut(stages.landmark.predict(meshes, seeds, stages.landmark_parameters), "points"))
    for optional in ("peak", "spread"):
        if optional not in found.columns:
            found = found.withColumn(optional, F.lit(None).cast("double"))
    sizes = meshes.meshes()
    return cut(found.select("mesh_id", "idx", "x", "y", "z", "peak", "spread").join(sizes, "mesh_id"), "predicted"), errors


def _landmarks(meshes: MeshSet, hashes: DataFrame, stages: Stages) -> tuple[DataFrame, DataFrame, DataFrame]:
    predicted, errors = _predict_landmarks(meshes, hashes, stages)
    snapped = landmarks.snap(predicted.select(*KEY, "idx", "x", "y", "z"), meshes)
    names = F.array(*[F.lit(n) for n in landmarks.NAMES])
    points = cut(
        predicted.select(*KEY, "idx", "peak", "spread").join(snapped, ["mesh_id", "idx"])
        .withColumn("name", F.try_element_at(names, (F.col("idx") + 1).cast("int"))), "landmarks")
    c = F.col
    found = landmarks.prediction_metrics(points).join(landmarks.anatomy(points), "mesh_id").join(
        landmarks.boundary_distance(points, meshes), "mesh_id")
    available = c("peak_min").isNotNull()
    structs = [
        scalar("landmark.heatmap.peak_min", c("peak_min"), "probability", applicable=available),
        scalar("landmark.heatmap.peak_mean", c("peak_mean"), "probability", applicable=available),
        scalar("landmark.snap.distance_mean_mm", c("snap_distance_mean"), "mm"),
        scalar("landmark.snap.distance_max_mm", c("snap_distance_max"), "mm"),
        *[scalar(f"landmark.anatomy.{n}_mm", c(n), "mm") for n in landmarks.PAIRS],
        scalar("landmark.midline_symmetry.x_range_mm", c("midline_x_range"), "mm"),
        scalar("landmark.crop_boundary.minimum_distance_mm", c("minimum_distance"), "mm",
               applicable=c("minimum_distance").isNotNull())]
    rows = long_form(found, "mesh_id", structs)
    missing = c("metric").startswith("landmark.heatmap.") & (c("compute_status") == "not_applicable")
    rows = rows.withColumn("compute_status", F.when(missing, "not_available").otherwise(c("compute_status")))
    placed = points.groupBy("mesh_id").agg(
        F.array_sort(F.collect_list(F.struct("idx", "x", "y", "z"))).alias("p"))
    coordinates = placed.select(
        c("mesh_id").cast("string").alias("output_key"), F.lit("landmark.prediction.coordinates").alias("metric"),
        F.lit("array").alias("value_kind"), F.lit(None).cast("double").alias("value_double"),
        F.lit(None).cast("string").alias("value_string"),
        F.flatten(F.transform("p", lambda e: F.array(e["x"], e["y"], e["z"]))).alias("value_array"),
        F.lit("mm").alias("unit"), F.lit("computed").alias("compute_status"),
        F.lit(None).cast("string").alias("error"))
    return points, rows.select(*MEASUREMENT_COLUMNS).unionByName(coordinates), errors


def _registration_rows(done: register.Registered, aligned: MeshSet) -> DataFrame:
    gaps = surface.surface_residuals(done.meshes, aligned)
    moved = register.deformation(done, done.meshes.largest)
    last = done.trajectory.where(F.col("phase") == "nonrigid").groupBy("mesh_id").agg(
        F.max_by("residual_mean", "iteration").alias("last"))
    joined = gaps.join(moved, "mesh_id").join(last, "mesh_id")
    return long_form(joined, "mesh_id", [
        scalar("registration.surface_residual.chamfer_mm", F.col("chamfer"), "mm"),
        scalar("registration.surface_residual.hausdorff_mm", F.col("hausdorff"), "mm"),
        scalar("registration.convergence.final_residual_mean_mm", F.col("last"), "mm"),
        scalar("registration.deformation.mean_mm", F.col("deformation_mean"), "mm"),
        scalar("registration.deformation.p95_mm", F.col("deformation_p95"), "mm")])


def _final_contract(final: MeshSet, expected: DataFrame, config: RunConfig) -> DataFrame:
    """Meshes whose final geometry is missing, has the wrong size or a value that is not finite."""
    finite = F.lit(True)
    for a in "xyz":
        finite = finite & F.coalesce(F.abs(a) < F.lit(float("inf")), F.lit(False))
    points = final.vertices.groupBy("mesh_id").agg(F.count(F.lit(1)).alias("v"), F.bool_and(finite).alias("finite"))
    sides = final.faces.groupBy("mesh_id").agg(F.count(F.lit(1)).alias("f"))
    found = expected.select("mesh_id").distinct().join(points, "mesh_id", "left").join(sides, "mesh_id", "left")
    wrong = found.where(
        (F.coalesce("v", F.lit(0)) != config.expected_vertices) | (F.coalesce("f", F.lit(0)) != config.expected_faces)
        | ~F.coalesce("finite", F.lit(False)))
    return _failure_rows(wrong, "final", "final geometry is incomplete", F.array(F.lit("contract.final_geometry")))


def _stability_rows(
    meshes: MeshSet, cropped: MeshSet, marked: DataFrame, points: DataFrame, hashes: DataFrame, stages: Stages
) -> DataFrame:
    """Worst overlap and drift over four repeated predictions with new seeds.

    Crops repeat on the turned input; landmarks on the turned formal crop, whose
    result is turned back before comparison.
    """
    base = marked.select("mesh_id", "vid", F.col("final").alias("kept"))
    repeated: DataFrame | None = None
    for degrees, stage in DIAGNOSTICS:
        turned = meshes.with_vertices(align.rotate_about_centroid(meshes.vertices, degrees))
        seeds = hashes.select(
            "mesh_id", "geometry_sha256",
            stage_seed(F.col("geometry_sha256"), f"crop:{stage}", stages.crop_seed).alias("seed"))
        _, again, _, _ = _crop(turned, seeds, stages)
        overlap = crop.mask_jaccard(base, again.select("mesh_id", "vid", F.col("final").alias("kept")))
        face = cropped.with_vertices(cut(align.rotate_about_centroid(cropped.vertices, degrees), "turned"))
        marks, _ = _predict_landmarks(face, hashes, stages, f"landmark:{stage}")
        back = _turned_back(landmarks.snap(marks.select(*KEY, "idx", "x", "y", "z"), face), cropped, degrees)
        run = cut(overlap.join(landmarks.landmark_rms(points.select("mesh_id", "idx", "x", "y", "z"), back), "mesh_id"), "diagnostic")
        repeated = run if repeated is None else repeated.unionByName(run)
    return long_form(landmarks.stability(repeated), "mesh_id", [
        scalar("crop.stability.jaccard_min", F.col("jaccard_min"), "ratio"),
        scalar("landmark.stability.rms_max_mm", F.col("rms_max"), "mm")])


def _turned_back(marks: DataFrame, cropped: MeshSet, degrees: tuple[float, float, float]) -> DataFrame:
    """Undo a turn about the crop's centroid for its landmarks."""
    matrix = align.euler_rotation(degrees)
    centre = cropped.vertices.groupBy("mesh_id").agg(*[F.avg(a).alias(f"c{a}") for a in "xyz"])
    offset = [F.col(a) - F.col(f"c{a}") for a in "xyz"]
    undone = [
        (sum(offset[row] * F.lit(matrix[row][col]) for row in range(3)) + F.col(f"c{axis}")).alias(axis)
        for col, axis in enumerate("xyz")]
    return marks.join(centre, "mesh_id").select("mesh_id", "idx", *undone)


def fingerprints(records: DataFrame, config: RunConfig, stages: Stages, level: str, mode: str) -> dict[str, str]:
    """Digests of the input set, the scientific settings and the execution.

    The input set folds one digest per sample with an order-free sum of 128-bit
    parts, so the sample list never travels to the driver.
    """
    row = F.sha2(F.concat_ws("|", "output_key", "relative_path", "source_file_sha256", "geometry_sha256"), 256)
    part = [F.sum(F.conv(F.substring(row, 1 + 12 * i, 12), 16, 10).cast("decimal(20,0)")) for i in range(5)]
    folded = [str(v) for v in records.agg(F.count(F.lit(1)), *part).first()]

    def digest(payload: Any) -> str:
        text = json.dumps(payload, sort_keys=True, separators=(",", ":"), ensure_ascii=False, default=str)
        return hashlib.sha256(text.encode()).hexdigest()

    models = [
        [a.name, a.version, a.source_digest(), p, seed] for a, p, seed in (
            (stages.crop, stages.crop_parameters, stages.crop_seed),
            (stages.landmark, stages.landmark_parameters, stages.landmark_seed))]
    return {
        "input_set": digest(folded),
        "scientific": digest([config.hashes, config.registration, config.symmetry_enabled, models, level]),
        "execution": digest([meshwright.__version__, provenance.source_digest(), mode])}


@dataclass(frozen=True)
class Run:
    """A run in its store: one identity, the fingerprints it began with, tables that only grow."""

    store: Store
    run_id: str
    prints: dict[str, str]

    def event(self, kind: str, **details: Any) -> None:
        """One small file per event, named so that the names sort by time."""
        now = datetime.now(timezone.utc)
        self.store.put_json(f"events/{now:%Y%m%dT%H%M%S%f}-{kind}.json", {"event": kind, "at": now.isoformat(), "run_id": self.run_id, **details})

    def committed(self) -> list[str]:
        """Attempts whose marker was written: one per call of ``run``."""
        return [n.removesuffix(".json") for n in self.store.names("commits") if n.endswith(".json")]

    def attempts(self, spark: SparkSession) -> DataFrame | None:
        """The rows of all committed attempts; what has no marker is not seen."""
        marked = self.committed()
        return spark.read.parquet(*[self.store.at("attempts", f"attempt={a}") for a in marked]) if marked else None

    def discard_orphans(self) -> list[str]:
        """Delete what attempts without a marker left; a run has one writer at a time."""
        marked, found = set(self.committed()), []
        for folder in [*ATTEMPT_FOLDERS, *[f"diagnostics/{n}" for n in self.store.names("diagnostics")]]:
            for name in self.store.names(folder):
                attempt = name.removeprefix("attempt=")
                if name.startswith("attempt=") and attempt not in marked:
                    self.store.remove(folder, name)
                    found.append(f"{folder}/{name}")
        return found


def recorded_run(store: Store) -> Run:
    """The run that a store holds."""
    text = store.read("run_manifest.json")
    try:
        stated = json.loads(text) if text else {}
    except json.JSONDecodeError:
        stated = {}
    if (stated.get("schema"), stated.get("tool")) != (RUN_SCHEMA, "meshwright"):
        raise RunError(f"not a run folder: {store.uri}")
    return Run(store, str(stated["run_id"]), stated["fingerprints"])


def _new_run(store: Store, prints: dict[str, str]) -> Run:
    made = Run(store, str(uuid.uuid4()), prints)
    store.put_json("run_manifest.json", {
        "schema": RUN_SCHEMA, "tool": "meshwright", "run_id": made.run_id, "fingerprints": prints,
        "created_at": datetime.now(timezone.utc).isoformat()})
    return made


def begin(spark: SparkSession, output: str, prints: dict[str, str], resume: bool = False, overwrite: bool = False) -> Run:
    """The run to write to: a new one, the recorded one, or a new one beside the recorded one's renamed store."""
    store = Store(spark, output)
    match (resume, overwrite, bool(store.names())):
        case (True, True, _):
            raise RunError("resume and overwrite exclude each other")
        case (False, False, True):
            raise RunError("a non-empty output folder needs resume or overwrite")
        case (True, False, True):
            found = recorded_run(store)
            differing = sorted(k for k in {*prints, *found.prints} if prints.get(k) != found.prints.get(k))
            if differing:
                raise RunError(f"resume fingerprint mismatch: {', '.join(differing)}")
            return found
        case (False, True, True):
            recorded_run(store)  # only a run may be set aside
            store.set_aside(f"superseded.{datetime.now(timezone.utc):%Y%m%dT%H%M%S%fZ}")
    return _new_run(store, prints)


def run(
    spark: SparkSession, output: str, config: RunConfig, stages: Stages, level: str = "standard",
    input_path: str | None = None, input_manifest: str | None = None, resume: bool = False,
    overwrite: bool = False, retry_failed: bool = False, mode: str = "compact",
) -> dict[str, Any]:
    """Process every pending input and return the run's summary.

    An attempt writes meshes, then records, each into a folder of its own, and
    at last one marker. Readers see marked attempts only, so a run that dies in
    between leaves no half attempt; the next resume deletes what it left.
    """
    records, parsed = inputs.discover(spark, input_path, input_manifest)
    prints = fingerprints(records, config, stages, level, mode)
    here = begin(spark, output, prints, resume, overwrite)
    here.event("run_resume" if resume else "run_start")
    orphans = here.discard_orphans()
    if orphans:
        here.event("orphans_discarded", folders=orphans)
    provenance.record(spark, here.store, config, {
        "crop": [stages.crop.name, stages.crop.version, stages.crop_parameters, stages.crop_seed],
        "landmark": [stages.landmark.name, stages.landmark.version, stages.landmark_parameters, stages.landmark_seed],
        "level": level, "mode": mode}, config.files)
    todo = records
    committed = here.attempts(spark)
    if committed is not None:
        latest = runs.current_attempts(committed).withColumn(
            "same_fingerprints", F.col("fingerprint") == json.dumps(prints, sort_keys=True))
        todo = runs.pending(records, latest, retry_failed)
    todo = cut(todo, "todo")
    if not todo.isEmpty():
        _process_todo(spark, here, todo, parsed, config, stages, level, mode)
    return rebuild_summary(spark, here.store.uri)


def _process_todo(
    spark: SparkSession, here: Run, todo: DataFrame, parsed: obj.ObjFiles, config: RunConfig,
    stages: Stages, level: str, mode: str
) -> None:
    attempt = str(uuid.uuid4())
    now = datetime.now(timezone.utc).isoformat()
    sound = todo.where(F.col("input_error").isNull())
    names = parsed.meshes.meshes().join(sound.select(F.col("path").alias("mesh_id"), "output_key"), "mesh_id")
    meshes = _written(MeshSet(
        attach(parsed.meshes.vertices, names, KEY).select(
            F.col("output_key").alias("mesh_id"), "nv", "vid", "x", "y", "z"),
        attach(parsed.meshes.faces, names, KEY, spread="fid").select(
            F.col("output_key").alias("mesh_id"), "nv", "fid", "a", "b", "c")), "inputs")
    if meshes.vertices.isEmpty():
        measured, failed = None, None
    else:
        hashes = sound.select(F.col("output_key").alias("mesh_id"), "geometry_sha256")
        outcome = process(spark, meshes, hashes, config, stages, level)
        obj.write_obj(outcome.final, here.store.at("meshes", f"attempt={attempt}"))
        outcome.trajectory.write.parquet(here.store.at("trajectory", f"attempt={attempt}"))
        if config.phenotype is not None:
            table = assets.projection_table(spark, config.phenotype["lamda_csv"], config.phenotype["names_pp"])
            align.check_barycentric_table(table, config.expected_faces)
            spots = align.barycentric_landmarks(outcome.final, table)
            runmeta.write_landmark_csv(spots, here.store.at("landmarks", f"attempt={attempt}"))
        if mode == "full":
            for name, rows in outcome.stages.items():
                rows.write.parquet(here.store.at("diagnostics", name, f"attempt={attempt}"))
        measured = outcome.measurements.unionByName(cut(_telemetry(spark, here, sound, outcome, attempt), "telemetry"))
        failed = outcome.failures.groupBy(F.col("mesh_id").alias("output_key")).agg(
            F.first("stage").alias("stage"), F.first("reason").alias("reason"),
            F.array_distinct(F.flatten(F.collect_list("contracts"))).alias("contracts"))
    base = todo.select(
        "output_key", "sample_id", "relative_path", "source_file_sha256", "geometry_sha256", "subject_group",
        "batch_id", "user_metadata", "inventory", "duplicate_geometry_group_size", "input_error")
    if failed is None:
        failed = base.where(F.lit(False)).select(
            "output_key", F.lit("").alias("stage"), F.lit("").alias("reason"),
            F.array().cast("array<string>").alias("contracts"))
        measured = failed.select("output_key", *[F.lit(None).cast(t).alias(n) for n, t in (
            ("metric", "string"), ("value_kind", "string"), ("value_double", "double"), ("value_string", "string"),
            ("value_array", "array<double>"), ("unit", "string"), ("compute_status", "string"), ("error", "string"))])
    unreadable = F.col("input_error").isNotNull()
    hard = F.when(unreadable, F.array(F.lit("contract.obj_readable"))).otherwise(
        F.coalesce("contracts", F.array().cast("array<string>")))
    known = base.join(failed, "output_key", "left").withColumn("hard_failures", hard).withColumn(
        "failed", unreadable | F.col("stage").isNotNull())
    verdicts = qc_rules.sample_status(measured, config.rules, level, known)
    bodies = runmeta.measurement_bodies(measured)
    done = known.drop("hard_failures").join(verdicts, "output_key").join(bodies, "output_key", "left")
    state = F.create_map(*[x for c in HARD_CONTRACTS for x in (
        F.lit(c), F.when(F.array_contains("hard_failures", c), "failed").otherwise("passed"))])
    final = F.when(~F.col("failed"), F.concat(F.lit(f"meshes/attempt={attempt}/mesh_id="), F.col("output_key")))
    done.select(
        *[c for c in base.columns if c != "input_error"],
        F.coalesce("input_error", "reason").alias("error"), F.col("stage").alias("failed_stage"),
        F.when(F.col("failed"), "failed").otherwise(F.col("status")).alias("status"), "qc_incomplete",
        "triggered_rules", "hard_failures", state.alias("hard_contracts"), final.alias("final_obj"),
        F.coalesce("measurements", F.lit("{}")).alias("measurements"),
        F.lit("complete").alias("commit_state"), F.lit(now).alias("committed_at"),
        F.lit(attempt).alias("attempt_id"), F.lit(here.run_id).alias("run_id"),
        F.lit(json.dumps(here.prints, sort_keys=True)).alias("fingerprint"),
    ).write.parquet(here.store.at("attempts", f"attempt={attempt}"))
    here.store.put_json(f"commits/{attempt}.json", {"attempt_id": attempt, "run_id": here.run_id, "committed_at": now})
    here.event("sample_complete", attempt_id=attempt, samples=todo.count())


def _telemetry(spark: SparkSession, here: Run, samples: DataFrame, outcome: Outcome, attempt: str) -> DataFrame:
    """Ten measurements of how each sample was processed.

    Samples go through a stage together, so a stage's seconds are those of the
    batch and the same for all its samples. Memory and device belong to no
    sample on a cluster.
    """
    final = here.store.at("meshes", f"attempt={attempt}")
    written = samples.select("output_key").where(F.lit(False)).withColumn("final_bytes", F.lit(None).cast("bigint"))
    if not outcome.final.vertices.isEmpty():
        lines = spark.read.schema("value string, mesh_id string").text(final)
        written = lines.groupBy(F.col("mesh_id").alias("output_key")).agg(F.sum(F.octet_length("value") + 1).alias("final_bytes"))
    known = samples.select("output_key", "source_bytes").join(written, "output_key", "left")
    seconds = outcome.clock.seconds | {"total": time.perf_counter() - outcome.clock.began}
    never = F.lit(False)
    rows = long_form(known, "output_key", [
        *[scalar(f"telemetry.stage_seconds.{stage}", F.lit(seconds[stage]), "s") for stage in STAGE_CLOCKS],
        scalar("telemetry.io.source_bytes", F.col("source_bytes"), "bytes", "long", F.col("source_bytes").isNotNull()),
        scalar("telemetry.io.final_obj_bytes", F.col("final_bytes"), "bytes", "long", F.col("final_bytes").isNotNull()),
        scalar("telemetry.peak_rss.mb", F.lit(0.0), "MB", applicable=never),
        scalar("telemetry.device.kind", F.lit(0.0), "category", applicable=never)])
    missing = F.col("compute_status") == "not_applicable"
    return rows.withColumn("compute_status", F.when(missing, "not_available").otherwise(F.col("compute_status"))).select(*MEASUREMENT_COLUMNS)


def rebuild_summary(spark: SparkSession, run_dir: str) -> dict[str, Any]:
    """Recount a run from its attempts and rewrite its sample list."""
    here = recorded_run(Store(spark, run_dir))
    attempts = here.attempts(spark)
    if attempts is None:
        raise RunError(f"run has no committed samples: {here.store.uri}")
    current = cut(runs.current_attempts(attempts), "current")
    stamp = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%fZ")
    runs.summary_rows(current).orderBy("output_key").write.csv(
        here.store.at("samples_csv", stamp), header=True, lineSep="\n")
    write_records(current, here.store.at("metadata", stamp))
    counts = qc_counts(current)
    summary = {"schema": "meshwright-summary-v1", "records": f"metadata/{stamp}", **counts,
               "generated_at": datetime.now(timezone.utc).isoformat()}
    here.store.put_json("summary.json", summary)
    here.event("run_complete", **counts)
    return summary


def qc_counts(records: DataFrame) -> dict[str, Any]:
    from meshwright.operators.qc_tools import run_counts

    row = run_counts(records).first().asDict()
    return {"sample_count": row.pop("sample_count"), "counts": row}


def write_records(current: DataFrame, folder: str) -> None:
    """Current records as JSON lines; measurements stay one JSON text per sample."""
    current.write.mode("errorifexists").json(folder)


def run_measurements(spark: SparkSession, run_dir: str) -> tuple[DataFrame, DataFrame]:
    """(records, long-form measurements) of a run made by this engine."""
    here = recorded_run(Store(spark, run_dir))
    attempts = here.attempts(spark)
    if attempts is None:
        raise RunError(f"run has no committed samples: {here.store.uri}")
    current = runs.current_attempts(attempts).withColumn("run_dir", F.lit(here.store.uri))
    bodies = current.withColumn("measurements", F.from_json(
        "measurements", "map<string,string>", {"allowNonNumericNumbers": "true"}))
    return current, runmeta.record_measurements(bodies)

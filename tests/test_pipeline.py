import dataclasses
import json
import re
from unittest.mock import ANY

import pytest
from pyspark.sql import functions as F

from meshwright import adapters
from meshwright.operators.landmarks import NAMES
from meshwright.operators import qc_rules
from meshwright.operators.qc_rules import Rule, RuleSet
from meshwright.plans import pipeline
from meshwright.plans.pipeline import RunError, Stages
from meshwright.sources import provenance
from meshwright.sources.config import RunConfig
from shapes import bumpy_sheet, obj_text

MARKS = (0, 4, 24, 20, 12, 7, 18, 11, 14)


def _whole(meshes, seeds, parameters):
    return meshes.vertices.select("mesh_id", "vid", F.lit(0.9).alias("probability"))


def _fixed_vertices(meshes, seeds, parameters):
    order = F.array(*[F.lit(m) for m in MARKS])
    idx = F.array_position(order, F.col("vid").cast("int")) - 1
    return meshes.vertices.where(F.col("vid").isin(*MARKS)).select(
        "mesh_id", idx.cast("int").alias("idx"), "x", "y", "z")


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("inputs")
    template = bumpy_sheet(5)
    (root / "assets").mkdir()
    (root / "in").mkdir()
    (root / "assets" / "t.obj").write_text(obj_text(*template))
    rows = "".join(f"{n},{','.join(map(str, template[0][m]))}\n" for n, m in zip(NAMES, MARKS))
    (root / "assets" / "marks.csv").write_text("name,x,y,z\n" + rows)
    for name, scale in (("one", 2.0), ("two", 3.0)):
        moved = [(x * scale + 5, y * scale, z * scale - 1) for x, y, z in template[0]]
        (root / "in" / f"{name}.obj").write_text(obj_text(moved, template[1]))
    (root / "in" / "bad.obj").write_text("v 0 0 0\nf 1 2 3 4\n")
    return root


@pytest.fixture(scope="module")
def config(folder):
    return RunConfig(
        folder / "assets" / "t.obj", folder / "assets" / "marks.csv", 25, 32,
        {"expected_edge_length_mm": 1.2},
        RuleSet("p", "1", {"gpa.transform": "warning"},
                (Rule("big", "gpa.transform.scale", "lt", 0.9, "ratio"),)),
        registration=dict(
            rigid_iterations=0, nonrigid_iterations=0, transform_num_neighbours=4,
            transform_num_viscous_iterations_start=1, transform_num_elastic_iterations_start=1,
            outlier_diffusion_iterations=1))


@pytest.fixture(scope="module")
def stages():
    return Stages(
        adapters.Adapter("crop", "whole", "1", _whole, ("adapters.py",)),
        adapters.Adapter("landmark", "fixed", "1", _fixed_vertices, ("adapters.py",)))


def test_run_resume_and_quality(spark, folder, config, stages):
    out = str(folder / "run")
    summary = pipeline.run(spark, out, config, stages, input_path=str(folder / "in"), mode="full")
    assert summary["sample_count"] == 3
    assert summary["counts"] == {"passed": 2, "warning": 0, "failed": 1}
    records, measured = pipeline.run_measurements(spark, out)
    rows = {r["output_key"]: r for r in records.collect()}
    assert rows["bad"]["hard_failures"] == ["contract.obj_readable"]
    assert "three vertices at line 2" in rows["bad"]["error"]
    assert rows["one"]["hard_contracts"]["contract.final_geometry"] == "passed"
    values = {(r["output_key"], r["metric"]): r for r in measured.collect()}
    assert values["one", "gpa.transform.scale"]["value_double"] == pytest.approx(1.0, abs=1e-3)
    assert values["two", "registration.surface_residual.chamfer_mm"]["value_double"] < 0.05
    assert values["one", "landmark.heatmap.peak_min"]["compute_status"] == "not_available"
    assert values["one", "input.connected_components.count"]["value_kind"] == "long"
    assert len(values["one", "landmark.prediction.coordinates"]["value_array"]) == 27
    written = spark.read.text(str(folder / "run" / rows["one"]["final_obj"])).collect()
    assert sum(r[0].startswith("v ") for r in written) == 25
    assert all(re.fullmatch(r"v( -?\d+\.\d{10}){3}|f( \d+){3}", r[0]) for r in written)

    assert spark.read.parquet(str(folder / "run" / "diagnostics" / "aligned")).groupBy("mesh_id").count().count() == 2

    again = pipeline.run(spark, out, config, stages, input_path=str(folder / "in"), resume=True, mode="full")
    assert again["counts"] == summary["counts"]
    events = [json.loads(f.read_text())["event"] for f in sorted((folder / "run" / "events").glob("*.json"))]
    assert events == ["run_start", "sample_complete", "run_complete", "run_resume", "run_complete"]
    with pytest.raises(RunError, match="needs resume"):
        pipeline.run(spark, out, config, stages, input_path=str(folder / "in"))
    with pytest.raises(RunError, match="fingerprint"):
        pipeline.run(spark, out, config, stages, level="enhanced", input_path=str(folder / "in"), resume=True)


def _telling(meshes, seeds, parameters):
    """A landmark model that raises on the mesh "two"."""
    found = _fixed_vertices(meshes, seeds, parameters).withColumn("error", F.lit(None).cast("string"))
    failed = found.where("mesh_id = 'two'").select("mesh_id").distinct().withColumn("error", F.lit("ValueError: no face"))
    return found.where("mesh_id <> 'two'").unionByName(failed, allowMissingColumns=True)


def test_a_failed_model_call_fails_one_sample_and_a_dead_run_leaves_no_attempt(spark, folder, config, monkeypatch):
    stages = Stages(
        adapters.Adapter("crop", "whole", "1", _whole, ("adapters.py",)),
        adapters.Adapter("landmark", "telling", "1", _telling, ("adapters.py",)))
    config = dataclasses.replace(
        config, rules=RuleSet("p", "1", {"telemetry.io": "warning"}, (Rule("small", "telemetry.io.source_bytes", "lt", 10**9, "bytes"),)),
        files={"qc": folder / "assets" / "marks.csv"})
    out = folder / "isolated"
    # The first run dies after its meshes are written and before its records are.
    with monkeypatch.context() as broken:
        broken.setattr(pipeline.runmeta, "measurement_bodies", lambda rows: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            pipeline.run(spark, str(out), config, stages, input_path=str(folder / "in"))
    dead = [p.name for p in (out / "meshes").iterdir()]
    assert dead and not (out / "commits").exists()
    assert pipeline.recorded_run(pipeline.Store(spark, str(out))).attempts(spark) is None
    summary = pipeline.run(spark, str(out), config, stages, input_path=str(folder / "in"), resume=True)
    kept = [p.name for p in (out / "meshes").iterdir()]
    assert len(kept) == 1 and kept != dead
    assert [p.name for p in (out / "commits").glob("[!.]*")] == [kept[0].removeprefix("attempt=") + ".json"]
    assert summary["sample_count"] == 3
    records, measured = pipeline.run_measurements(spark, str(out))
    rows = {r["output_key"]: r for r in records.collect()}
    assert rows["two"]["status"] == "failed" and rows["two"]["error"] == "ValueError: no face" and rows["two"]["failed_stage"] == "landmark"
    assert rows["one"]["status"] == "passed"  # telemetry is judged, and recorded only
    judged = qc_rules.rule_results(measured.where("output_key = 'one'"), config.rules, "standard").collect()
    assert [(r["rule_id"], r["triggered"]) for r in judged] == [("small", True)]
    told = {(r["output_key"], r["metric"]): r for r in measured.where("metric like 'telemetry.%'").collect()}
    assert sum(k == "one" for k, _ in told) == sum(k == "two" for k, _ in told) == 10
    assert told["one", "telemetry.io.source_bytes"]["value_double"] == (folder / "in" / "one.obj").stat().st_size
    written = sum(p.stat().st_size for p in (out / rows["one"]["final_obj"]).glob("*.txt"))
    assert told["one", "telemetry.io.final_obj_bytes"]["value_double"] == written
    assert told["two", "telemetry.io.final_obj_bytes"]["compute_status"] == "not_available"
    assert told["one", "telemetry.stage_seconds.total"]["value_double"] >= told["one", "telemetry.stage_seconds.crop"]["value_double"] > 0
    environment, resolved = (json.loads((out / f"{n}.json").read_text()) for n in ("environment", "resolved_config"))
    assert environment["source_sha256"] == provenance.source_digest() and environment["packages"]["pyspark"]
    assert resolved["configuration"]["expected_vertices"] == 25 and resolved["models"]["landmark"][0] == "telling"
    assert (out / "config" / "qc.csv").read_text() == (folder / "assets" / "marks.csv").read_text()
    monkeypatch.setattr(provenance, "source_digest", lambda folder=None: "another source")
    with pytest.raises(RunError, match="execution"):
        pipeline.run(spark, str(out), config, stages, input_path=str(folder / "in"), resume=True)


def test_model_errors_stay_with_their_mesh(spark):
    from meshwright.operators import models
    from shapes import mesh_set

    meshes = mesh_set(spark, {"one": bumpy_sheet(5), "two": bumpy_sheet(4), "three": bumpy_sheet(3)})
    seeds = meshes.meshes().select("mesh_id", F.lit(1).alias("seed"))

    def score(points):
        if len({tuple(p) for p in points.tolist()}) == 16:
            raise ValueError("sixteen")
        return points[:, 0] * 0 + 0.5

    rows = models.crop_scores(meshes, seeds, score, 32, 1, isolate=True).collect()
    assert {(r["mesh_id"], r["error"]) for r in rows} == {("one", None), ("two", "ValueError: sixteen"), ("three", None)}
    assert sum(r["mesh_id"] == "one" for r in rows) == 25 and [r["vid"] for r in rows if r["mesh_id"] == "two"] == [None]
    with pytest.raises(Exception, match="sixteen"):
        models.crop_scores(meshes, seeds, score, 32, 1).collect()


def test_source_digest_follows_names_and_contents(tmp_path):
    (tmp_path / "a.py").write_text("x = 1\n")
    first = provenance.source_digest(tmp_path)
    assert first == provenance.source_digest(tmp_path)
    (tmp_path / "b.py").write_text("")
    second = provenance.source_digest(tmp_path)
    (tmp_path / "a.py").write_text("x = 2\n")
    assert len({first, second, provenance.source_digest(tmp_path)}) == 3


def test_overwrite_sets_the_old_run_aside(spark, tmp_path):
    prints = {"input_set": "a", "scientific": "b", "execution": "c"}
    first = pipeline.begin(spark, str(tmp_path / "r"), prints)
    second = pipeline.begin(spark, str(tmp_path / "r"), prints, overwrite=True)
    assert first.run_id != second.run_id
    assert len(list(tmp_path.glob("r.superseded.*"))) == 1
    assert pipeline.begin(spark, str(tmp_path / "r"), prints, resume=True) == pipeline.Run(ANY, second.run_id, prints)
    with pytest.raises(RunError, match="exclude"):
        pipeline.begin(spark, str(tmp_path / "r"), prints, resume=True, overwrite=True)
    with pytest.raises(RunError, match="scientific"):
        pipeline.begin(spark, str(tmp_path / "r"), prints | {"scientific": "x"}, resume=True)
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "file").write_text("x")
    with pytest.raises(RunError, match="not a run folder"):
        pipeline.begin(spark, str(tmp_path / "other"), prints, overwrite=True)


def test_stability_of_models_that_ignore_pose(spark, stages):
    from shapes import mesh_set

    meshes = mesh_set(spark, {"one": bumpy_sheet(5)})
    hashes = meshes.meshes().select("mesh_id", F.lit("abc").alias("geometry_sha256"))
    seeds = hashes.withColumn("seed", F.lit(1))
    cropped, marked, _, _ = pipeline._crop(meshes, seeds, stages)
    points, _, _ = pipeline._landmarks(cropped, hashes, stages)
    rows = pipeline._stability_rows(meshes, cropped, marked, points, hashes, stages).collect()
    assert {r["metric"]: round(r["value_double"], 9) for r in rows} == {
        "crop.stability.jaccard_min": 1.0, "landmark.stability.rms_max_mm": 0.0}

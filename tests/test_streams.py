"""Small meshes pass through tasks in streams and bins; both ways give the rows of a call for each mesh."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from shapes import TETRAHEDRON, bumpy_sheet, mesh_set

from meshwright.operators import models, register, surface
from meshwright.plans import bounded
from meshwright.plans.meshset import MeshSet
from meshwright.session import cut


def calls(spark, schema, rows):
    """What ``each_mesh`` calls its work with, in batches of three rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        def work(mesh: pa.Table) -> pa.Table:
            ids = set(mesh.column("mesh_id").to_pylist())
            return pa.table({"mesh_id": pa.array(list(ids), pa.int64()), "n": pa.array([mesh.num_rows])})

        frame = spark.createDataFrame(rows, "mesh_id bigint, vid bigint")
        return sorted(tuple(r) for r in bounded.each_mesh(frame, work, schema).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_stream_calls_once_for_each_mesh(spark):
    schema = spark.createDataFrame([], "mesh_id bigint, n bigint").schema
    rows = [(m, v) for m in range(40) for v in range(1 + m % 11)]
    assert calls(spark, schema, rows) == [(m, 1 + m % 11) for m in range(40)]


def test_small_meshes_cost_no_group_of_their_own(spark):
    sets = mesh_set(spark, {1: bumpy_sheet(5), 2: TETRAHEDRON})
    seeds = sets.meshes().select("mesh_id", F.col("mesh_id").alias("seed"))
    plans = [bounded.each_mesh(sets.vertices, lambda t: t, sets.vertices.schema),
             models.crop_scores(sets, seeds, lambda p: p[:, 0] * 0.0, 8, 1)]
    for plan in (p._jdf.queryExecution().executedPlan().toString() for p in plans):
        assert "MapInArrow" in plan and "FlatMapGroups" not in plan


def test_faces_are_tested_without_a_row_for_each_segment(spark):
    crossing = ([(0, 0, 0), (4, 0, 0), (0, 4, 0), (1, 1, -1), (1, 1, 1), (2, 2, 1)], [(0, 1, 2), (3, 4, 5)])
    level = ([(0, 0, 0), (4, 0, 0), (0, 4, 0), (1, 1, 0), (2, 1, 0), (1, 2, 0)], [(0, 1, 2), (3, 4, 5)])
    apart = ([(0, 0, 0), (4, 0, 0), (0, 4, 0), (3, 3, 0), (4, 3, 0), (3, 4, 0)], [(0, 1, 2), (3, 4, 5)])
    sets = mesh_set(spark, {1: crossing, 2: level, 3: apart})
    pairs = cut(surface.overlapping_faces(sets))
    found = surface.intersecting_faces(pairs)
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    assert {r["mesh_id"]: r["pair_count"] for r in surface.self_intersections(sets).collect()} == {1: 1, 2: 1, 3: 0}


def both_ways(spark, monkeypatch, work):
    whole = {tuple(r[:2]): r[2:] for r in work().collect()}
    monkeypatch.setattr(bounded, "ROWS", 10)
    apart = {tuple(r[:2]): r[2:] for r in work().collect()}
    assert whole.keys() == apart.keys() and len(whole) > 30
    for k in whole:
        assert np.allclose(np.array(whole[k], float), np.array(apart[k], float), atol=1e-9), k


@pytest.mark.parametrize("symmetric, equalize", [(True, False), (True, True), (False, False)])
def test_matching_in_one_task_equals_matching_by_joins(spark, monkeypatch, symmetric, equalize):
    sets = mesh_set(spark, {1: bumpy_sheet(5), 2: bumpy_sheet(4), 3: TETRAHEDRON})
    moving = cut(register.features(sets))
    target = cut(moving.withColumn("x", F.col("x") * 1.1 + 0.2))
    flags = cut(sets.vertices.where("vid != 3").select("mesh_id", "nv", "vid", (F.col("vid") % 5 > 0).cast("double").alias("flag")))
    found = lambda: register.correspondences(moving, target, flags, flags, 3, 0.6, symmetric, equalize)
    assert "Join" not in found()._jdf.queryExecution().executedPlan().toString()
    both_ways(spark, monkeypatch, found)


def test_a_viscoelastic_step_in_one_task_equals_one_by_joins(spark, monkeypatch):
    sets = mesh_set(spark, {1: bumpy_sheet(5), 2: bumpy_sheet(4), 3: TETRAHEDRON})
    sets = MeshSet(cut(sets.vertices), cut(sets.faces))
    moving = cut(register.features(sets))
    flags = cut(sets.vertices.select("mesh_id", "nv", "vid", (F.col("vid") % 4 > 0).cast("double").alias("flag")))
    matched = cut(moving.select("mesh_id", "vid", *[(F.col(n) * 1.2 + 0.1).alias(f"c{n}") for n in register.FEATURES], F.lit(1.0).alias("flag")))
    weights = cut(sets.vertices.select("mesh_id", "nv", "vid", ((F.col("vid") % 5 + 1) / 5.0).alias("weight")))
    options = register.RegistrationOptions(transform_num_neighbours=4, transform_sigma=1.5, outlier_diffusion_iterations=2)
    step = lambda: register.viscoelastic_step(moving, sets.faces, matched, flags, weights, 3, 2, options).select(
        "mesh_id", "vid", *register.FEATURES)
    both_ways(spark, monkeypatch, step)

"""Registration of small meshes in one task against the steps by tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from meshwright.operators import lockstep, register
from meshwright.operators.register import RegistrationOptions
from meshwright.plans.meshset import MeshSet
from meshwright.session import cut
from shapes import TETRAHEDRON, bumpy_sheet, mesh_set

OPTIONS = RegistrationOptions(
    rigid_iterations=0, nonrigid_iterations=1, transform_num_neighbours=7, transform_sigma=1.5, triangle_size_zscore=1.5,
    transform_num_viscous_iterations_start=4, transform_num_elastic_iterations_start=3, outlier_diffusion_iterations=2)


def pair(spark, meshes):
    targets = mesh_set(spark, meshes)
    targets = MeshSet(cut(targets.vertices), cut(targets.faces))
    return targets.with_vertices(targets.vertices.select(
        "mesh_id", "nv", "vid", (F.col("x") * 1.05 + F.col("z") * 0.1 + 0.2).alias("x"), (F.col("y") * 0.97 - 0.1).alias("y"),
        (F.col("z") + 0.1 - F.col("x") * 0.1).alias("z"))), targets


def results(done):
    tables = {"points": done.meshes.vertices, "matched": done.correspondences, "weights": done.weights, "rigid": done.rigid_end,
              "scale": done.rigid_scale, "track": done.trajectory}
    keys = ("mesh_id", "vid", "phase", "iteration")
    return {(name, *[r[k] for k in keys if k in r]): [v for k, v in r.items() if k not in keys]
            for name, table in tables.items() for r in (row.asDict() for row in table.collect())}


def same(got, want):
    assert got.keys() == want.keys()
    for key, values in want.items():
        assert np.allclose(np.array(got[key], float), np.array(values, float), atol=1e-9, equal_nan=True), key


def test_small_meshes_register_without_a_table_for_each_step(spark, monkeypatch):
    start, targets = pair(spark, {1: bumpy_sheet(5), 2: bumpy_sheet(4), 3: TETRAHEDRON})
    written, done = [], {}
    monkeypatch.setattr(register, "cut", lambda frame, label="step": written.append(label) or cut(frame, label))
    for last in (0, 3):
        done[last] = register.register(start, targets, RegistrationOptions(**{**vars(OPTIONS), "nonrigid_iterations": last}))
    assert len(written) == 2
    assert done[3].trajectory.count() == 9 and done[0].trajectory.count() == 6


def test_one_task_gives_what_the_steps_give(spark, monkeypatch):
    """A mesh over the bound and one with a value that is not a number take the steps, the others do not."""
    strange = ([(0, 0, 0), (1, 0, 0), (0, 1, 0), (1, 1, 0.2), (math.nan, 1, 1)], [(0, 1, 2), (1, 3, 2), (2, 3, 4)])
    start, targets = pair(spark, {1: bumpy_sheet(5), 2: bumpy_sheet(4), 3: TETRAHEDRON, 4: strange})
    monkeypatch.setattr(register, "DENSE_ROWS", 20)
    stepped, steps = [], register._registered_by_steps
    monkeypatch.setattr(register, "_registered_by_steps", lambda a, b, o: stepped.append(
        {r[0] for r in a.meshes().select("mesh_id").collect()}) or steps(a, b, o))
    got = results(register.register(start, targets, OPTIONS))
    assert stepped == [{1, 4}]
    same(got, results(steps(start, targets, OPTIONS)))


@pytest.mark.parametrize("options", [
    dict(correspondences_symmetric=False, rigid_use_scaling=False, flag_target_boundary=False),
    dict(correspondences_equalize_push_pull=True, correspondences_num_neighbours=9, outlier_diffusion_iterations=0)])
def test_options_hold_in_one_task(spark, options):
    start, targets = pair(spark, {1: bumpy_sheet(4), 2: TETRAHEDRON})
    options = RegistrationOptions(**{**vars(OPTIONS), "nonrigid_iterations": 0, **options})
    same(results(register.register(start, targets, options)), results(register._registered_by_steps(start, targets, options)))


def test_a_vertex_without_a_coordinate_takes_no_part(spark):
    points, faces = bumpy_sheet(4)
    whole = [f for f in faces if 15 not in f]
    _, kept = pair(spark, {1: (points, faces), 2: (points[:15], whole)})
    missing = (F.col("mesh_id") == 1) & (F.col("vid") == 15)
    targets = kept.with_vertices(kept.vertices.withColumn("x", F.when(~missing, F.col("x"))))
    start = targets.with_vertices(targets.vertices.withColumn("z", F.col("z") * 1.1 + 0.3))
    options = RegistrationOptions(**{**vars(OPTIONS), "flag_floating_boundary": False, "flag_target_boundary": False})
    found = results(register.register(start, targets, options))
    # Points and weights begin with the size of their mesh.
    one, two = ({(k[0], *k[2:]): v[k[0] in ("points", "weights"):] for k, v in found.items() if k[1] == m and k[0] != "rigid"} for m in (1, 2))
    same(one, two)
    assert found["rigid", 1, 15][1:] == [None, None, None]


def test_squares_of_a_matrix_equal_single_passes():
    rng = np.random.default_rng(3)
    matrix = rng.random((2, 9, 9))
    matrix /= matrix.sum(2, keepdims=True)
    values = rng.normal(size=(2, 9, 3))
    for passes in (0, 1, 2, 3, 40, 401):
        want = values
        for _ in range(passes):
            want = matrix @ want
        assert np.allclose(lockstep.powered(matrix.copy(), values, passes, np.empty_like(matrix)), want, atol=1e-12)


@pytest.mark.parametrize("k", [1, 3, 9, 40])
def test_near_pairs_take_the_lower_place_of_ties(k):
    d2 = np.random.default_rng(4).integers(0, 6, (3, 11, 13)).astype(float)
    d2[1, :, 5:] = np.inf
    want = {(b * 11 + i, b * 13 + j) for b in range(3) for i in range(11)
            for _, j in sorted((d, j) for j, d in enumerate(d2[b, i]) if d < np.inf)[:k]}
    row, column, gap = lockstep._near_pairs(d2.copy(), k)
    assert len(row) == len(want) and set(zip(row.tolist(), column.tolist())) == want
    assert (gap == d2[row // 11, row % 11, column % 13]).all()

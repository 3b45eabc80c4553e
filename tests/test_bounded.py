"""Bounded meshes in one task against the plans for meshes of any size, and against plain loops."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from meshwright.operators import register, surface, topology
from meshwright.plans import bounded, grid
from meshwright.plans.meshset import MeshSet
from meshwright.session import cut
from shapes import TETRAHEDRON, bumpy_sheet, mesh_set

RNG = np.random.default_rng(8)


def clouds():
    """Clusters, far outliers, coinciding points, points in a plane, one point."""
    near = RNG.normal(size=(300, 3))
    return {
        1: near, 2: np.concatenate([near * 1e-3, RNG.normal(size=(3, 3)) * 1e6]), 3: np.repeat(near[:7], 40, 0),
        4: np.round(near[:150]) * [1, 1, 0], 5: near[:1], 6: near[:4]}


def frame_of(spark, sets):
    rows = [(m, len(p), n, *map(float, q)) for m, p in sets.items() for n, q in enumerate(p)]
    return spark.createDataFrame(rows, "mesh_id bigint, nv bigint, vid bigint, x double, y double, z double").repartition(3)


def brute(queries, targets, k):
    out = set()
    for m, q in queries.items():
        for n, point in enumerate(q):
            d2 = [(sum((a - b) * (a - b) for a, b in zip(point, t)), j) for j, t in enumerate(targets.get(m, []))]
            out |= {(m, n, rank, j, d) for rank, (d, j) in enumerate(sorted(d2)[:k], 1)}
    return out


@pytest.mark.parametrize("k", [1, 3, 9])
def test_nearest_in_blocks_equals_all_pairs(spark, monkeypatch, k):
    monkeypatch.setattr(bounded, "LEAF", 16)
    targets = clouds()
    queries = {m: p[::3] + 0.25 for m, p in targets.items()} | {9: np.zeros((2, 3))}
    found = grid.nearest(frame_of(spark, queries), frame_of(spark, targets), k, ["x", "y", "z"])
    assert {tuple(r) for r in found.select("mesh_id", "vid", "rank", "neighbour", "d2").collect()} == brute(queries, targets, k)


def test_block_search_tests_few_pairs_beside_outliers():
    """With one percent of far outliers the tested pairs stay within a constant of the points."""
    tested = {}
    for n in (4_000, 16_000):
        points = np.concatenate([RNG.normal(size=(n, 3)), RNG.normal(size=(n // 100, 3)) * 1e6])
        count = 0

        class Counted(np.ndarray):
            pass

        original = np.partition

        def partition(values, *args, **kwargs):
            nonlocal count
            count += values.size
            return original(values, *args, **kwargs)

        np.partition = partition
        try:
            bounded.nearest_rows(points, points, np.arange(len(points)), 3)
        finally:
            np.partition = original
        tested[n] = count / len(points)
    assert tested[16_000] < 1.5 * tested[4_000] and tested[16_000] < 6_000


def test_meshes_over_the_bound_take_the_distributed_plans(spark, monkeypatch):
    targets = {m: p for m, p in clouds().items() if m != 2}
    queries = {m: p[::5] + 0.1 for m, p in targets.items()}
    monkeypatch.setattr(bounded, "ROWS", 100)
    found = grid.nearest(frame_of(spark, queries), frame_of(spark, targets), 3, ["x", "y", "z"])
    assert {tuple(r) for r in found.select("mesh_id", "vid", "rank", "neighbour", "d2").collect()} == brute(queries, targets, 3)
    sets = mesh_set(spark, {1: bumpy_sheet(12), 2: TETRAHEDRON, 3: bumpy_sheet(4, 2.0)})
    points = sets.vertices.withColumn("z", F.col("z") + F.col("vid") % 4)
    mixed = {(r[0], r[1]): r[2] for r in surface.surface_distances(points, sets).select("mesh_id", "vid", "distance").collect()}
    corners = sorted(map(tuple, topology.with_corners(sets).collect()))
    monkeypatch.setattr(bounded, "ROWS", 1 << 17)
    whole = {(r[0], r[1]): r[2] for r in surface.surface_distances(points, sets).select("mesh_id", "vid", "distance").collect()}
    assert mixed.keys() == whole.keys() and all(mixed[k] == pytest.approx(whole[k], abs=1e-12) for k in whole)
    assert sorted(map(tuple, topology.with_corners(sets).collect())) == corners


def test_face_table_is_exchanged_once(spark):
    sets = mesh_set(spark, {1: bumpy_sheet(6), 2: TETRAHEDRON})
    sets = MeshSet(cut(sets.vertices), cut(sets.faces))
    plan = topology.face_statistics(sets)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapCoGroupsInArrow") == 1 and "Join" not in plan


def plain_point_triangle(p, a, b, c):
    """Closest distance by a dense sweep over the triangle's sides and its plane."""
    best = math.inf
    for u, v in ((a, b), (b, c), (c, a)):
        along = v - u
        t = 0.0 if not along.any() else float(np.clip((p - u) @ along / (along @ along), 0, 1))
        best = min(best, float(np.linalg.norm(p - u - t * along)))
    normal = np.cross(b - a, c - a)
    if normal.any():
        s = np.linalg.lstsq(np.stack([b - a, c - a], 1), p - a, rcond=None)[0]
        if (s >= 0).all() and s.sum() <= 1:
            best = min(best, abs((p - a) @ normal) / float(np.linalg.norm(normal)))
    return best


def test_surface_rows_equal_a_plain_loop():
    corners = RNG.normal(size=(300, 3, 3)) * 0.3 + RNG.normal(size=(300, 1, 3)) * 5
    corners[:5, 1] = corners[:5, 0]  # no area
    corners[5:8] = corners[5:8, :1]
    points = np.concatenate([RNG.normal(size=(60, 3)) * 5, RNG.normal(size=(5, 3)) * 1e5, corners[:3, 0]])
    want = [min(plain_point_triangle(p, *t) for t in corners) for p in points]
    assert np.allclose(bounded.surface_rows(points, corners), want, rtol=1e-9, atol=1e-9)


def test_points_without_a_surface_or_not_finite_have_no_distance(spark):
    sets = mesh_set(spark, {1: TETRAHEDRON, 2: ([(0, 0, 0), (1, 0, 0), (math.nan, 0, 0)], [(0, 1, 2)])})
    points = frame_of(spark, {1: [(0, 0, 2), (math.nan, 0, 0), (math.inf, 0, 0)], 2: [(0, 0, 0)], 3: [(0, 0, 0)]})
    assert [tuple(r) for r in surface.surface_distances(points, sets).select("mesh_id", "vid", "distance").collect()] == [(1, 0, 1.0)]


def test_passes_in_one_task_equal_passes_by_joins(spark, monkeypatch):
    sets = mesh_set(spark, {1: bumpy_sheet(5), 2: bumpy_sheet(3), 3: TETRAHEDRON})
    flags = sets.vertices.select("mesh_id", "vid", (F.col("vid") % 4 != 0).cast("double").alias("flag"))
    base = register.smoothing_weights(sets.vertices, flags, 4, 1.5)
    # A vertex without a displacement, one without a weight.
    field = sets.vertices.where("not (mesh_id = 1 and vid = 7)").select("mesh_id", "vid", F.col("x").alias("dx"), F.col("y").alias("dy"), F.col("z").alias("dz"))
    inliers = sets.vertices.where("not (mesh_id = 2 and vid = 4)").select("mesh_id", "vid", ((F.col("vid") % 5 + 1) / 5.0).alias("weight"))
    rows = lambda f: {tuple(r[:2]): tuple(r[2:]) for r in f.select("mesh_id", "vid", *register.FIELD).collect()}

    def all_ways():
        return [rows(register.smooth_field(field, base, inliers, 3)), rows(register.diffuse_outliers(field, base, inliers, 2)),
                rows(register.relaxed(field, base, inliers, [2, 1], 2))]

    together = all_ways()
    monkeypatch.setattr(register, "PASS_ROWS", 40)  # mesh 1 alone is larger
    apart = all_ways()
    for a, b in zip(together, apart):
        assert a.keys() == b.keys() and len(a) > 30
        assert all(np.allclose(a[k], b[k], atol=1e-12) for k in a)
    assert register.smooth_field(field, base, inliers, 0) is field


def test_passes_run_without_an_exchange_between_them(spark):
    sets = mesh_set(spark, {1: bumpy_sheet(5)})
    flags = sets.vertices.select("mesh_id", "vid", F.lit(1.0).alias("flag"))
    base = register.smoothing_weights(sets.vertices, flags, 4, 1.5)
    field = sets.vertices.select("mesh_id", "vid", F.col("x").alias("dx"), F.col("y").alias("dy"), F.col("z").alias("dz"))
    weights = sets.vertices.select("mesh_id", "vid", F.lit(0.5).alias("weight"))
    exchanges = {n: register.relaxed(field, base, weights, [n, n], n)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
                 for n in (1, 50)}
    assert exchanges[1] == exchanges[50] <= 4


def test_inlier_weights_in_one_task_equal_those_by_sums(spark, monkeypatch):
    sets = mesh_set(spark, {1: bumpy_sheet(5), 2: bumpy_sheet(4), 3: TETRAHEDRON})
    moving = register.features(sets)
    off = F.col("vid") % 3
    matched = moving.select("mesh_id", "vid", *[(F.col(n) + off).alias(f"c{n}") for n in register.FEATURES],
                            F.when(F.col("mesh_id") == 3, 0.0).otherwise((F.col("vid") % 5 > 0).cast("double")).alias("flag"))
    got = {tuple(r[:3]): r[3] for r in register.inlier_weights(moving, matched, 3.0).collect()}
    monkeypatch.setattr(bounded, "ROWS", 10)
    want = {tuple(r[:3]): r[3] for r in register.inlier_weights(moving, matched, 3.0).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-12) for k in got)
    assert all(w == 0.0 for (m, *_), w in got.items() if m == 3)


def test_smoothing_passes_decay_geometrically():
    passes = [register.annealed(200, 1, i, 200) for i in range(201)]
    assert passes[1] == 200 and passes[200] == 1 and passes == sorted(passes, reverse=True)
    assert passes[0] == round(200 * math.exp(math.log(1 / 200) / 199) ** -1)
    assert register.annealed(1, 5, 3, 10) == 5 and register.annealed(9, 2, 4, 1) == 2

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from meshwright.operators import align, crop, landmarks, register, surface, topology
from meshwright.plans import bounded
from meshwright.operators.register import FEATURES, RegistrationOptions
from meshwright.plans import grid
from meshwright.plans.meshset import KEY, MeshSet
from shapes import TETRAHEDRON, bumpy_sheet, mesh_set


def points_of(frame, columns=("x", "y", "z"), key="vid"):
    rows = sorted(frame.collect(), key=lambda r: r[key])
    return np.array([[r[c] for c in columns] for r in rows])


def table(spark, mesh, points, name="vid"):
    return spark.createDataFrame(
        [(mesh, len(points), n, *map(float, p)) for n, p in enumerate(points)],
        f"mesh_id bigint, nv bigint, {name} bigint, x double, y double, z double")


@pytest.fixture(scope="module")
def cloud():
    return np.random.default_rng(3).normal(size=(40, 3)) * [5.0, 2.0, 1.0]


def test_similarity_recovers_a_known_transform(spark, cloud):
    turn = np.array(align.euler_rotation((10.0, -35.0, 90.0)))
    goal = 1.75 * cloud @ turn.T + [12, -4, 3.5]
    source, target = table(spark, 1, cloud), table(spark, 1, goal)
    for rule in (align.SIZE_RATIO, align.LEAST_SQUARES):
        fit = align.similarity(align.paired(source, target), rule)
        assert fit.first()["scale"] == pytest.approx(1.75)
        assert np.allclose(points_of(align.apply(source, fit)), goal)
    rigid = align.similarity(align.paired(source, target), allow_scaling=False).first()
    assert rigid["scale"] == 1.0
    mirrored = table(spark, 1, goal * [-1, 1, 1])
    turned = align.similarity(align.paired(source, mirrored)).first()["rotation"]
    assert np.linalg.det(np.array(turned).reshape(3, 3)) == pytest.approx(1.0)


def test_light_weights_drop_out_and_too_few_count_equally(spark, cloud):
    goal = cloud + [1.0, 2.0, 3.0]
    goal[:5] += 100.0
    pairs = align.paired(table(spark, 1, cloud), table(spark, 1, goal))
    kept = pairs.withColumn("w", F.when(F.col("vid") < 5, 1e-9).otherwise(2.0))
    assert align.similarity(kept, align.LEAST_SQUARES).first()["tx"] == pytest.approx(1.0)
    few = pairs.withColumn("w", F.when(F.col("vid") < 2, 1.0).otherwise(0.0))
    even = align.similarity(pairs, align.LEAST_SQUARES).first()
    assert align.similarity(few, align.LEAST_SQUARES).first()["scale"] == pytest.approx(even["scale"])


def test_landmark_alignment_needs_nine_spread_points(spark, cloud):
    meshes = mesh_set(spark, {m: (cloud, [(0, 1, 2)]) for m in (1, 2, 3)})
    marks = [(m, n, *(cloud[n] if m != 3 else [n, 0.0, 0.0])) for m in (1, 2, 3) for n in range(9 if m != 2 else 8)]
    marks = spark.createDataFrame([(m, n, *map(float, p)) for m, n, *p in marks],
                                  "mesh_id bigint, idx int, x double, y double, z double")
    template = spark.createDataFrame([(n, *map(float, cloud[n] * 2 + 1)) for n in range(9)],
                                     "idx int, x double, y double, z double")
    moved, report = align.landmark_alignment(meshes, marks, template)
    rows = {r["mesh_id"]: r for r in report.collect()}
    assert [rows[m]["aligned"] for m in (1, 2, 3)] == [True, False, False]
    assert rows[1]["scale"] == pytest.approx(2.0) and rows[1]["landmark_rms"] == pytest.approx(0.0, abs=1e-9)
    assert np.allclose(points_of(moved.vertices.where("mesh_id = 1")), cloud * 2 + 1)


@pytest.mark.parametrize("size", [1e-7, 1.0, 1e3])
def test_landmarks_on_a_line_are_not_aligned_at_any_size(spark, cloud, size):
    meshes = mesh_set(spark, {m: (cloud * size, [(0, 1, 2)]) for m in (1, 2)})
    marks = spark.createDataFrame([(m, n, *map(float, (cloud[n] if m == 1 else np.array([0.1, 0.7, 0.3]) * n) * size)) for m in (1, 2) for n in range(9)],
                                  "mesh_id bigint, idx int, x double, y double, z double")
    template = spark.createDataFrame([(n, *map(float, cloud[n])) for n in range(9)], "idx int, x double, y double, z double")
    _, report = align.landmark_alignment(meshes, marks, template)
    assert {r["mesh_id"]: r["aligned"] for r in report.collect()} == {1: True, 2: False}


def test_symmetrize_triple(spark):
    meshes = mesh_set(spark, {1: ([(-1, 0, 0), (2, 0, 0), (0.5, 1, 0)], [(0, 1, 2)])})
    mirror = spark.createDataFrame([(0, 1), (1, 0), (2, 2)], "vid bigint, ref bigint")
    align.check_involution(mirror)
    moved, _ = align.symmetrize(meshes, mirror)
    assert points_of(moved.vertices)[:, 0].tolist() == [-1.5, 1.5, 0.0]
    with pytest.raises(ValueError, match="involution"):
        align.check_involution(spark.createDataFrame([(0, 1), (1, 2), (2, 0)], "vid bigint, ref bigint"))


def test_barycentric_weights_run_from_the_last_corner(spark):
    meshes = mesh_set(spark, {1: ([(0, 0, 0), (10, 0, 0), (0, 10, 0), (10, 10, 5)], [(0, 1, 2), (1, 3, 2)])})
    rows = spark.createDataFrame([(0, "p", 0, 0.2, 0.3, 0.5), (1, "q", 1, 0.1, 0.7, 0.2)],
                                 "idx int, name string, fid bigint, l1 double, l2 double, l3 double")
    align.check_barycentric_table(rows, 2)
    spots = points_of(align.barycentric_landmarks(meshes, rows), key="idx")
    assert np.allclose(spots, [(3, 2, 0), (9, 8, 3.5)])
    for bad, message in ((rows.withColumn("l1", F.lit(0.9)), "sum to one"), (rows.withColumn("name", F.lit("p")), "unique"),
                         (rows.withColumn("fid", F.lit(2)), "range")):
        with pytest.raises(ValueError, match=message):
            align.check_barycentric_table(bad, 2)
    turned = meshes.faces.withColumn("a", F.when(F.col("fid") == 1, 3).otherwise(F.col("a")))
    assert align.same_topology(meshes, meshes.faces).first()["same_topology"]
    assert not align.same_topology(meshes, turned).first()["same_topology"]


def test_probability_mask_and_crop(spark):
    meshes = mesh_set(spark, {1: ([(0, 0, 0), (1, 0, 0), (0, 1, 0), (9, 9, 9)], [(0, 1, 2), (1, 2, 3)])})
    scores = spark.createDataFrame([(1, n, p) for n, p in enumerate([0.9, 0.8, 0.7, 0.1])],
                                   "mesh_id bigint, vid bigint, probability double")
    marked = crop.masks(meshes, scores, 0.5)
    assert [r["final"] for r in marked.orderBy("vid").collect()] == [True, True, True, False]
    cut_out = crop.crop(meshes, marked.where("final").select("mesh_id", "vid"))
    assert cut_out.vertices.count() == 3 and cut_out.faces.count() == 1
    none = crop.crop(meshes, marked.where("vid = 0").select("mesh_id", "vid"))
    assert none.vertices.count() == 0 and none.faces.count() == 0
    smoothed = crop.smooth(meshes, scores, 1, 0.5).orderBy("vid").collect()
    want = np.float32(np.float32(0.9) * 0.5 + 0.5 * (0.8 + 0.7) / 2)
    assert smoothed[0]["probability"] == pytest.approx(float(want), abs=1e-6)


def odd_meshes(spark):
    """Meshes with repeated vertices and faces, and corners, face ids and mesh ids that are null, and their scores."""
    rng = np.random.default_rng(7)
    vertices, faces, scores = [], [], []
    for m in (3, -1, 8, None, *range(20, 50)):
        ids = [*range(-2, 30), 4, 4, 11]
        vertices += [(m, len(ids), v, float(v), 0.5, None if v == 5 else 1.0) for v in ids]
        scores += [(m, v, None if v == 9 else float(rng.random())) for v in range(-2, 28)] + [(m, 7, 0.9), (m, 7, 0.1)]
        for n in range(40):
            corners = [int(v) if v < 32 else None for v in rng.integers(-2, 34, 1) + rng.integers(0, 4, 3)]
            faces.append((m, len(ids), None if n % 13 == 5 else n - 4, *corners))
    key = "mesh_id bigint, nv bigint, "
    return topology.MeshSet(
        spark.createDataFrame(vertices, key + "vid bigint, x double, y double, z double"),
        spark.createDataFrame([*faces, (99, 0, 0, 0, 1, 2)], key + "fid bigint, a bigint, b bigint, c bigint"),
    ), spark.createDataFrame(scores, "mesh_id bigint, vid bigint, probability double")


def test_crop_in_tasks_equals_joins(spark, monkeypatch):
    meshes, scores = odd_meshes(spark)
    for rows in (bounded.ROWS, 0):
        monkeypatch.setattr(bounded, "ROWS", rows)
        found = {}
        for keep_largest, least in ((True, 0), (False, 3)):
            marked = crop.masks(meshes, scores, 0.3, keep_largest, least)
            cropped = crop.crop(meshes, marked.where("final").select("mesh_id", "vid"))
            for name, table in (("marked", marked), ("vertices", cropped.vertices), ("faces", cropped.faces)):
                found[name, least] = (table.columns, sorted(map(tuple, table.collect()), key=str))
        if rows:
            first = found
    assert first == found
    assert all(len(rows) > 50 for _, rows in first.values())


def test_crop_tasks_grow_with_rows_not_bytes(spark, monkeypatch):
    # Strips compress to a few bytes a row, and AQE joined them all in as few tasks as there are cores.
    n, meshes = 50, 80
    vertices = spark.range(n * meshes).selectExpr(
        f"id div {n} as mesh_id", f"{n}L as nv", f"id % {n} as vid", "0.0d as x", "0.0d as y", "0.0d as z")
    strip = vertices.where(f"vid + 2 < {n}").selectExpr("mesh_id", "nv", "vid as fid", "vid as a", "vid + 1 as b", "vid + 2 as c")
    scores = vertices.selectExpr("mesh_id", "vid", "1.0d as probability")
    monkeypatch.setattr(bounded, "DEALT", 400)
    marked = crop.masks(topology.MeshSet(vertices, strip), scores, 0.5)
    cropped = crop.crop(topology.MeshSet(vertices, strip), marked.select("mesh_id", "vid"))
    for table in (marked, cropped.vertices):
        assert table.count() == n * meshes
        most = table.groupBy(F.spark_partition_id().alias("task")).count().agg(F.max("count")).first()[0]
        assert most <= 400 + 6 * n


def test_crop_metrics_from_many_tasks(spark, monkeypatch):
    meshes, scores = odd_meshes(spark)
    found = []
    for rows, dealt in ((bounded.ROWS, 300), (bounded.ROWS, bounded.DEALT), (0, bounded.DEALT)):
        monkeypatch.setattr(bounded, "ROWS", rows)
        monkeypatch.setattr(bounded, "DEALT", dealt)
        marked = crop.masks(meshes, scores, 0.3)
        cropped = crop.crop(meshes, marked.where("final").select("mesh_id", "vid"))
        found.append({r["mesh_id"]: r for r in crop.crop_metrics(meshes, marked, cropped).drop("probability_mean").collect()})
    assert len(found[0]) == 33 and found[0] == found[1] == found[2]


def brute_nearest(queries, targets, k):
    d2 = ((queries[:, None, :] - targets[None, :, :]) ** 2).sum(-1)
    order = np.lexsort((np.broadcast_to(np.arange(len(targets)), d2.shape), d2))[:, :k]
    return order, np.take_along_axis(d2, order, 1)


@pytest.mark.parametrize("k", [1, 3, 50])
def test_nearest_matches_brute_force(spark, cloud, k):
    targets = np.vstack([cloud, cloud[:3], [[400.0, 0, 0]]])  # copies and an outlier
    queries = np.vstack([cloud[:10] + 0.05, [[-90.0, 0, 0]]])
    hits = grid.nearest(table(spark, 1, queries), table(spark, 1, targets), k, ["x", "y", "z"]).collect()
    order, d2 = brute_nearest(queries, targets, k)
    got = {(r["vid"], r["rank"] - 1): (r["neighbour"], r["d2"]) for r in hits}
    assert len(got) == len(queries) * min(k, len(targets))
    for (row, rank), (found, gap) in got.items():
        assert gap == pytest.approx(d2[row, rank]) and found == order[row, rank]


def test_nearest_among_coinciding_points(spark):
    same = table(spark, 1, np.zeros((30, 3)))
    hits = grid.nearest(same, same, 2, ["x", "y", "z"]).collect()
    assert len(hits) == 60 and {r["neighbour"] for r in hits} == {0, 1}


def brute_distance(p, a, b, c):
    best = math.inf
    n = np.cross(b - a, c - a)
    if n @ n > 0:
        flat = p - n * ((p - a) @ n) / (n @ n)
        u = np.linalg.lstsq(np.stack([b - a, c - a], 1), flat - a, rcond=None)[0]
        if min(u) >= 0 and sum(u) <= 1:
            best = np.linalg.norm(p - flat)
    for s, e in ((a, b), (b, c), (c, a)):
        t = np.clip((p - s) @ (e - s) / max((e - s) @ (e - s), 1e-300), 0, 1)
        best = min(best, np.linalg.norm(p - s - t * (e - s)))
    return best


def test_surface_distance_matches_brute_force(spark, cloud):
    rng = np.random.default_rng(4)
    faces = rng.integers(0, 40, size=(25, 3))
    faces[0] = (1, 1, 2)  # no area
    points = np.vstack([rng.normal(size=(15, 3)) * 6, [[80.0, 0, 0]]])
    meshes = mesh_set(spark, {1: (cloud, faces)})
    got = {r["vid"]: r["distance"] for r in surface.surface_distances(table(spark, 1, points), meshes).collect()}
    for n, p in enumerate(points):
        assert got[n] == pytest.approx(min(brute_distance(p, *cloud[f]) for f in faces), abs=1e-9)


CROSSING = ([(0, 0, 0), (2, 0, 0), (0, 2, 0), (0.5, 0.5, -1), (0.5, 0.5, 1), (3, 3, 1)], [(0, 1, 2), (3, 4, 5)])
ADJACENT = ([(0, 0, 0), (1, 0, 0), (0, 1, 0), (1, 1, 0)], [(0, 1, 2), (1, 3, 2)])
COPLANAR = ([(0, 0, 0), (2, 0, 0), (0, 2, 0), (0.2, 0.2, 0), (1, 0.2, 0), (0.2, 1, 0)], [(0, 1, 2), (3, 4, 5)])
APART = ([(0, 0, 0), (2, 0, 0), (0, 2, 0), (1.9, 1.9, 0), (3, 1.9, 0), (1.9, 3, 0)], [(0, 1, 2), (3, 4, 5)])


def test_self_intersections(spark):
    meshes = mesh_set(spark, {1: CROSSING, 2: ADJACENT, 3: COPLANAR, 4: APART, 5: TETRAHEDRON})
    got = {r["mesh_id"]: r["pair_count"] for r in surface.self_intersections(meshes).collect()}
    assert got == {1: 1, 2: 0, 3: 1, 4: 0, 5: 0}
    flat = ([(0, 0, 0), (4, 0, 0), (0, 4, 0)] * 3, [(0, 1, 2), (3, 4, 5), (6, 7, 8)])
    assert surface.self_intersections(mesh_set(spark, {1: flat})).first()["pair_count"] == 3


def test_searches_end_with_values_that_are_not_finite(spark, cloud):
    nan = float("nan")
    odd = [*map(tuple, cloud[:-1]), (nan, 0.0, 0.0)]
    meshes = mesh_set(spark, {1: (cloud, [(0, 1, 2), (3, 4, 5)]), 2: (odd, [(0, 1, 2), (3, 4, len(odd) - 1)])})
    marks = spark.createDataFrame([(m, len(cloud), n, nan if (m, n) == (1, 0) else float(cloud[n][0]), float(cloud[n][1]), float(cloud[n][2]))
                                   for m in (1, 2) for n in range(9)], "mesh_id bigint, nv bigint, idx int, x double, y double, z double")
    snapped = {(r["mesh_id"], r["idx"]): r["vertex_id"] for r in landmarks.snap(marks, meshes).collect()}
    assert snapped == {(m, n): n for m in (1, 2) for n in range(9) if (m, n) != (1, 0)}
    failures = {r["mesh_id"]: r["failures"] for r in landmarks.contract_failures(marks, meshes).collect()}
    assert failures == {1: ["contract.landmarks_finite"], 2: []}
    found = surface.surface_distances(meshes.vertices, meshes).groupBy("mesh_id").count().collect()
    assert {r["mesh_id"]: r["count"] for r in found} == {1: len(cloud), 2: len(cloud) - 1}


def test_box_pairs_match_brute_force_across_sizes(spark, cloud):
    rng = np.random.default_rng(8)
    points = np.vstack([cloud, cloud * 20, cloud * 0.01])
    faces = [tuple(rng.choice(40, 3, replace=False) + 40 * int(rng.integers(0, 3))) for _ in range(60)]
    got = {(r["first"], r["second"]) for r in surface.overlapping_faces(mesh_set(spark, {1: (points, faces)})).collect()}
    low, high = points[np.array(faces)].min(1), points[np.array(faces)].max(1)
    want = {(i, j) for i in range(60) for j in range(i + 1, 60)
            if not set(faces[i]) & set(faces[j]) and (low[i] <= high[j]).all() and (low[j] <= high[i]).all()}
    assert got == want


def test_landmark_contracts(spark, cloud):
    meshes = mesh_set(spark, {m: (cloud, [(0, 1, 2)]) for m in (1, 2, 3)})
    rows = [(m, n, *map(float, cloud[n] + (0.1 if m == 2 and n == 4 else 0))) for m in (1, 2) for n in range(9)]
    rows += [(3, n, float("nan") if n == 0 else 0.0, 0.0, 0.0) for n in range(8)]
    marks = spark.createDataFrame([(m, 40, n, *p) for m, n, *p in rows],
                                  "mesh_id bigint, nv bigint, idx int, x double, y double, z double")
    got = {r["mesh_id"]: [f.split("landmarks_")[1] for f in r["failures"]]
           for r in landmarks.contract_failures(marks, meshes).collect()}
    assert got == {1: [], 2: ["snapped_on_mesh"], 3: ["complete", "finite", "snapped_on_mesh"]}


def test_annealing_rounds_half_to_even_and_starts_above():
    passes = [register.annealed(200, 1, n, 200) for n in (0, 1, 2, 100, 200)]
    assert passes == [205, 200, 195, 14, 1]
    assert register.annealed(1, 1, 5, 200) == 1 and register.annealed(200, 1, 0, 1) == 1
    with pytest.raises(ValueError, match="unknown"):
        RegistrationOptions.of({"speed": 1})


# --- one registration iteration against dense numpy -------------------------------


def dense_affinity(f, t, k):
    order, d2 = brute_nearest(f, t, k)
    w = np.zeros((len(f), len(t)))
    for i in range(len(f)):
        for j, gap in zip(order[i], d2[i]):
            w[i, j] = max((f[i, 3:] @ t[j, 3:] / 2 + 0.5) / max(gap, 1e-6), 1e-4)
    return w


def dense_match(f, t, f_flag, t_flag, threshold):
    push, pull = dense_affinity(f, t, 3), dense_affinity(t, f, 3)
    p_flag = ((pull / pull.sum(1, keepdims=True)) @ f_flag > threshold) * t_flag
    w = push + pull.T
    w /= w.sum(1, keepdims=True)
    return w @ t, ((w @ t_flag > threshold) & (w @ p_flag > threshold)) * f_flag


def dense_inliers(f, c, flag, kappa):
    w = flag.astype(float)
    d2 = ((c - f) ** 2).sum(1)
    for _ in range(10):
        sigma = min(max(math.sqrt((w * d2).sum() / w.sum()), 0.1), 10)
        density = np.exp(-d2 / (2 * sigma * sigma))
        w = w * density / (density + math.exp(-kappa * kappa / 2))
    return w * np.clip((f[:, 3:] * c[:, 3:]).sum(1) / 2 + 0.5, 0, 1)


@pytest.fixture(scope="module")
def pair(spark):
    points, faces = bumpy_sheet(5)
    moved = np.array(points) * 1.05 + [0.1, -0.1, 0.05]
    start, goal = mesh_set(spark, {1: (moved, faces)}), mesh_set(spark, {1: (points, faces)})
    return start, goal, points_of(register.features(start), FEATURES), points_of(register.features(goal), FEATURES)


def test_correspondences_weights_and_rigid_step_match_numpy(spark, pair):
    start, goal, f, t = pair
    flags = register.mesh_flags(start, True, False, 6.0)
    flag = points_of(flags, ("flag",))[:, 0]
    assert flag.sum() == 9  # a 5 x 5 sheet has a 3 x 3 interior
    moving, target = register.features(start), register.features(goal)
    found = register.correspondences(moving, target, flags, flags, 3, 0.5)
    want, want_flag = dense_match(f, t, flag, flag, 0.5)
    assert np.allclose(points_of(found, [f"c{n}" for n in FEATURES]), want, atol=1e-8)
    assert np.array_equal(points_of(found, ("flag",))[:, 0], want_flag)
    weights = register.inlier_weights(moving, found, 3.0)
    w = dense_inliers(f, want, want_flag, 3.0)
    assert np.allclose(points_of(weights, ("weight",))[:, 0], w, atol=1e-9)
    moved, fit = register.rigid_step(moving, found, weights)
    got = points_of(moved)
    assert np.linalg.norm(got - want[:, :3], axis=1).mean() < np.linalg.norm(f[:, :3] - want[:, :3], axis=1).mean()
    keep = w > 1e-8
    p, q, u = f[keep, :3], want[keep, :3], w[keep] / w[keep].sum()
    x, y = p - u @ p, q - u @ q
    scale = np.linalg.svd((x * u[:, None]).T @ y)[1].sum() / (u * (x * x).sum(1)).sum()
    assert fit.first()["scale"] == pytest.approx(scale, rel=1e-8)


def test_smoothing_and_diffusion_match_numpy(spark, pair):
    start, _, f, _ = pair
    flag = np.array([0.0 if n % 6 == 0 else 1.0 for n in range(25)])
    inlier = np.linspace(0.2, 1.0, 25)
    flags = spark.createDataFrame([(1, n, float(v)) for n, v in enumerate(flag)], "mesh_id bigint, vid bigint, flag double")
    weights = spark.createDataFrame([(1, n, float(v)) for n, v in enumerate(inlier)], "mesh_id bigint, vid bigint, weight double")
    field = np.random.default_rng(1).normal(size=(25, 3))
    moved = spark.createDataFrame([(1, n, *map(float, v)) for n, v in enumerate(field)],
                                  "mesh_id bigint, vid bigint, dx double, dy double, dz double")
    base = register.smoothing_weights(start.vertices, flags, 6, 1.5)
    order, d2 = brute_nearest(f[:, :3], f[:, :3], 6)
    e = 1e-5
    b = np.exp(-d2 / (2 * 1.5 ** 2)) * flag[order] * (1 - e) + e
    b /= b.sum(1, keepdims=True)
    s = inlier[order] * b * (1 - e) + e
    s /= s.sum(1, keepdims=True)
    want = field.copy()
    for _ in range(2):
        want = np.einsum("nk,nkd->nd", s, want[order])
    names = ("dx", "dy", "dz")
    assert np.allclose(points_of(register.smooth_field(moved, base, weights, 2), names), want, atol=1e-9)
    want = field.copy()
    for _ in range(2):
        mean = np.einsum("nk,nkd->nd", b, want[order])
        weak = inlier <= 0.8
        want[weak] = want[weak] * inlier[weak, None] + (1 - inlier[weak, None]) * mean[weak]
    assert np.allclose(points_of(register.diffuse_outliers(moved, base, weights, 2), names), want, atol=1e-9)


def test_registration_converges_and_keeps_topology(spark, pair):
    start, goal, f, t = pair
    done = register.register(start, goal, RegistrationOptions(
        rigid_iterations=0, nonrigid_iterations=0, flag_floating_boundary=False, flag_target_boundary=False,
        transform_num_neighbours=4, transform_num_viscous_iterations_start=1,
        transform_num_elastic_iterations_start=1, outlier_diffusion_iterations=1))
    after = points_of(done.meshes.vertices)
    assert np.linalg.norm(after - t[:, :3], axis=1).mean() < 0.5 * np.linalg.norm(f[:, :3] - t[:, :3], axis=1).mean()
    assert done.meshes.faces.exceptAll(start.faces).isEmpty()
    phases = {(r["phase"], r["iteration"]) for r in done.trajectory.collect()}
    assert phases == {("rigid", 0), ("nonrigid", 0)}
    assert done.rigid_scale.first()["rigid_scale"] == pytest.approx(1 / 1.05, rel=0.02)


def test_template_copies_are_the_same_with_and_without_broadcast(spark, pair, monkeypatch):
    start, _, _, _ = pair
    targets = mesh_set(spark, {m: TETRAHEDRON for m in (4, 5)})
    broadcast = register.expand_template(start, targets)
    rows = lambda m: (sorted(map(tuple, m.vertices.collect())), sorted(map(tuple, m.faces.collect())))
    want = rows(broadcast)
    assert len(want[0]) == 50 and {r[0] for r in want[0]} == {4, 5}
    shuffled = lambda rows, small, keys: rows.hint("merge").join(small, keys)
    monkeypatch.setattr(register, "attach_small", lambda *a: shuffled(*a))
    assert rows(register.expand_template(start, targets)) == want


def test_batches_cover_small_and_large_meshes(spark):
    from meshwright.operators import models

    rows = [(m, n, 7, v) for m, n in ((1, 3), (2, 8), (3, 19)) for v in range(n)]
    points = spark.createDataFrame(rows, "mesh_id bigint, nv bigint, seed bigint, vid bigint")
    plan = [tuple(r) for r in models.vote_batches(points, 8, 1).select("mesh_id", "batch", "slot", "vid").collect()]
    for mesh, size, batches in ((1, 3, 1), (2, 8, 1), (3, 19, 3)):
        mine = [r for r in plan if r[0] == mesh]
        slots = {(b, s) for _, b, s, _ in mine}
        assert len(mine) == len(slots) == 8 * (batches + 1)
        assert {v for _, b, _, v in mine if b >= 0} == set(range(size))
    with pytest.raises(ValueError):
        models.vote_batches(points, 0, 1)


def test_model_adapters_decode_points(spark, cloud):
    from meshwright.operators import models

    meshes = mesh_set(spark, {1: (cloud, [(0, 1, 2)])})
    seeds = spark.createDataFrame([(1, 5)], "mesh_id bigint, seed bigint")
    centre = cloud.mean(0)
    radius = np.linalg.norm(cloud - centre, axis=1).max()

    def heat(points):
        scores = np.tile(np.linspace(0.1, 0.9, 9), (len(points), 1)).astype(np.float32)
        return scores, -points[:, None, :] + np.arange(9)[None, :, None] * 0.1

    found = models.landmark_adapter(heat)(meshes, seeds, {"input.sampling.num_points": 30, "inference.top_k": 4})
    got = points_of(found, key="idx")
    assert np.allclose(got, centre + np.arange(9)[:, None] * 0.1 * radius, atol=1e-5)
    votes = models.crop_adapter(lambda p: np.abs(p[:, 0]))(
        meshes, seeds, {"input.sampling.num_points": 16, "inference.extra_passes": 1})
    want = np.abs((cloud - centre)[:, 0] / radius)
    assert np.allclose(points_of(votes, ("probability",))[:, 0], want, atol=1e-6)

import math
import random
from collections import Counter, deque

import pytest
from pyspark.sql import functions as F

from meshwright.operators import measure, topology
from meshwright.plans import derive, ranking
from shapes import TETRAHEDRON, mesh_set


def test_right_triangle_measurements(spark):
    side = 1.2
    meshes = mesh_set(spark, {1: ([(0, 0, 0), (side, 0, 0), (0, side, 0)], [(0, 1, 2)])})
    rows = {r["metric"]: r for r in measure.input_measurements(meshes, 1.2).collect()}
    assert len(rows) == 23
    assert rows["input.topology.boundary_edge_count"]["value_double"] == 3
    assert rows["input.degenerate_faces.count"]["value_double"] == 0
    assert rows["input.edge_length.expected_mm"]["value_double"] == 1.2
    assert rows["input.edge_length.median_mm"]["value_double"] == pytest.approx(1.2)
    assert rows["input.extent_density.vertices_per_mm3"]["compute_status"] == "not_applicable"
    assert rows["input.extent_density.vertices_per_mm3"]["value_double"] is None
    sizes = measure.component_vertex_counts(meshes).collect()
    assert [(r["size"], r["components"]) for r in sizes] == [(3, 1)]


def test_tetrahedron_is_closed(spark):
    meshes = mesh_set(spark, {1: TETRAHEDRON})
    assert topology.boundary_vertices(meshes).count() == 0
    assert {r["k"] for r in topology.edge_list(meshes.faces).collect()} == {2}
    normals = {r["vid"]: r for r in topology.vertex_normals(meshes).collect()}
    assert normals[0]["nx"] == pytest.approx(-1 / math.sqrt(3))
    flipped = topology.vertex_normals(meshes).select(
        "mesh_id", "nv", "vid", *[(-F.col(n)).alias(n) for n in ("nx", "ny", "nz")])
    turned = {r["vid"]: r for r in topology.vertex_normals(meshes, flipped).collect()}
    assert turned[0]["nx"] == pytest.approx(1 / math.sqrt(3))


def test_degenerate_faces_and_negative_zero(spark):
    points = [(0.0, 0, 0), (-0.0, 0, 0), (1, 0, 0), (0, 1, 0)]
    meshes = mesh_set(spark, {1: (points, [(0, 0, 2), (2, 3, 0), (3, 2, 0)])})
    edges = {(r["lo"], r["hi"]): r["k"] for r in topology.edge_list(meshes.faces).collect()}
    assert edges[0, 0] == 1 and edges[0, 2] == 4
    row = topology.duplicate_counts(meshes).first()
    assert (row["duplicate_vertices"], row["duplicate_faces"]) == (0, 1)


def _sizes(count, edges):
    near = {v: set() for v in range(count)}
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    seen, label = set(), {}
    for start in range(count):
        if start in seen:
            continue
        queue = deque([start])
        seen.add(start)
        while queue:
            v = queue.popleft()
            label[v] = start
            for w in near[v] - seen:
                seen.add(w)
                queue.append(w)
    return label


@pytest.mark.parametrize("chunk", [1 << 19, 16])
def test_components_match_a_search_in_small_and_split_pieces(spark, chunk):
    rng = random.Random(5)
    edges = {(min(a, b), max(a, b)) for a, b in (
        (rng.randrange(60), rng.randrange(60)) for _ in range(38)) if a != b}
    edges |= {(7, n) for n in range(30, 45)}  # one hub
    vertices = spark.createDataFrame([(1, 60, v) for v in range(60)], "mesh_id bigint, nv bigint, vid bigint")
    table = spark.createDataFrame([(1, a, b) for a, b in edges], "mesh_id bigint, lo bigint, hi bigint")
    found = topology.components(vertices, table, 60, len(edges), chunk)
    assert {r["vid"]: r["label"] for r in found.collect()} == _sizes(60, edges)


def test_largest_component_prefers_the_smallest_vertex(spark):
    labels = spark.createDataFrame(
        [(1, 6, v, label) for v, label in enumerate([0, 1, 1, 3, 3, 5])],
        "mesh_id bigint, nv bigint, vid bigint, label bigint")
    row = topology.largest_component(labels).first()
    assert (row["label"], row["size"]) == (1, 2)


def test_dense_index_is_independent_of_the_block_size(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "event_id")
    wide = ranking.dense_index(events, ["user_id"], "event_id", "vid", "nv")
    tight = ranking.dense_index(events, ["user_id"], "event_id", "vid", "nv", block_rows=7)
    assert wide.exceptAll(tight).isEmpty() and tight.exceptAll(wide).isEmpty()
    per_user = Counter(r["user_id"] for r in events.collect())
    top = {r["user_id"]: (r["m"], r["n"]) for r in tight.groupBy("user_id").agg(
        F.max("vid").alias("m"), F.first("nv").alias("n")).collect()}
    assert all(top[u] == (n - 1, n) for u, n in per_user.items())


def test_quantiles_of_hot_groups_equal_the_aggregate(spark, sf_dir):
    rows = derive.read(spark, sf_dir, "events").select("event_type", "value")
    hot = rows.unionAll(spark.range(300).select(F.lit("view").alias("event_type"), F.lit(7.0).alias("value")))
    wanted = {"p01": 0.01, "median": 0.5, "p95": 0.95, "top": 1.0}
    plain = ranking.exact_quantiles(hot, ["event_type"], "value", wanted)
    split = ranking.exact_quantiles(
        hot, ["event_type"], "value", wanted, group_limit=5, also=[F.count(F.lit(1)).alias("n")])
    assert split.agg(F.sum("n")).first()[0] == hot.count()
    want = {r["event_type"]: r for r in plain.collect()}
    for row in split.collect():
        for name in wanted:
            assert row[name] == pytest.approx(want[row["event_type"]][name], abs=1e-9)


def test_global_position_counts_every_row(spark):
    rows = spark.range(500).select(F.concat(F.lit("k"), (F.col("id") * 7919 % 500).cast("string")).alias("k"))
    placed = ranking.global_position(rows, ["k"], "at").collect()
    assert [r["k"] for r in sorted(placed, key=lambda r: r["at"])] == sorted(r["k"] for r in placed)
    assert sorted(r["at"] for r in placed) == list(range(500))

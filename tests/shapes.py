"""Small meshes for the tests."""

import math

from meshwright.plans.meshset import MeshSet

TETRAHEDRON = (
    [(0.0, 0.0, 0.0), (1.0, 0.0, 0.0), (0.0, 1.0, 0.0), (0.0, 0.0, 1.0)],
    [(0, 2, 1), (0, 1, 3), (0, 3, 2), (1, 2, 3)],
)


def mesh_set(spark, meshes):
    """MeshSet from {mesh_id: (vertices, faces)}."""
    points = [(m, n, *map(float, p)) for m, (v, _) in meshes.items() for n, p in enumerate(v)]
    sides = [(m, n, *map(int, t)) for m, (_, f) in meshes.items() for n, t in enumerate(f)]
    kind = "string" if any(isinstance(m, str) for m in meshes) else "bigint"
    return MeshSet.of(
        spark.createDataFrame(points, f"mesh_id {kind}, vid bigint, x double, y double, z double"),
        spark.createDataFrame(sides, f"mesh_id {kind}, fid bigint, a bigint, b bigint, c bigint"),
    )


def bumpy_sheet(size, lift=0.0):
    """A size x size grid of vertices over a wavy surface."""
    points = [
        (float(i), float(j), lift + math.sin(i * 0.7) + math.cos(j * 0.9) * 0.5)
        for i in range(size) for j in range(size)
    ]
    faces = []
    for i in range(size - 1):
        for j in range(size - 1):
            n = i * size + j
            faces += [(n, n + 1, n + size), (n + 1, n + size + 1, n + size)]
    return points, faces


def obj_text(vertices, faces):
    return "".join(f"v {x} {y} {z}\n" for x, y, z in vertices) + "".join(
        f"f {a + 1} {b + 1} {c + 1}\n" for a, b, c in faces)

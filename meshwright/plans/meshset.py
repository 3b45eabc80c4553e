"""The long-form mesh collection every geometry operator works on."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshwright.plans.skew import attach_sized
from meshwright.session import cut

# Every mesh-level table carries the mesh's vertex count next to its id. The
# count is a function of the id, and it sizes the salting of large meshes.
KEY = ["mesh_id", "nv"]


@dataclass(frozen=True)
class MeshSet:
    """vertices(mesh_id, nv, vid, x, y, z) and faces(mesh_id, nv, fid, a, b, c)."""

    vertices: DataFrame
    faces: DataFrame
    _bound: dict = field(default_factory=dict, repr=False, compare=False)

    @property
    def largest(self) -> int:
        """Most vertices or faces any one mesh has; counted once."""
        self._measure()
        return self._bound["rows"]

    @property
    def face_total(self) -> int:
        """Faces of all meshes together; counted once."""
        self._measure()
        return self._bound["faces"]

    @property
    def vertex_total(self) -> int:
        """Vertices of all meshes together; counted once."""
        self._measure()
        return self._bound["vertices"]

    def _measure(self) -> None:
        if "rows" not in self._bound:
            largest, count = self.vertices.agg(F.max("nv"), F.count(F.lit(1))).first()
            faces = self.faces.groupBy("mesh_id").count().agg(F.max("count"), F.sum("count")).first()
            self._bound["rows"] = int(max(largest or 0, faces[0] or 0))
            self._bound["vertices"] = int(count)
            self._bound["faces"] = int(faces[1] or 0)

    @classmethod
    def of(cls, vertices: DataFrame, faces: DataFrame) -> "MeshSet":
        """Build from tables without ``nv`` by counting each mesh's vertices."""
        sizes = cut(vertices.groupBy("mesh_id").agg(F.count(F.lit(1)).alias("nv")), "mesh-sizes")
        return cls(
            attach_sized(vertices, sizes, "mesh_id", "nv").select(*KEY, "vid", "x", "y", "z"),
            attach_sized(faces, sizes, "mesh_id", "nv").select(*KEY, "fid", "a", "b", "c"),
        )

    def with_vertices(self, vertices: DataFrame) -> "MeshSet":
        """Same topology, moved points."""
        return MeshSet(vertices.select(*KEY, "vid", "x", "y", "z"), self.faces, self._bound)

    def meshes(self) -> DataFrame:
        """One row per mesh."""
        return self.vertices.groupBy(*KEY).agg(F.count(F.lit(1)).alias("vertex_rows")).select(*KEY)

"""The 24 input-mesh measurements, in long form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshwright.operators import topology
from meshwright.plans.meshset import KEY, MeshSet
from meshwright.session import cut

COMPUTED = "computed"
NOT_APPLICABLE = "not_applicable"

MEASUREMENT_COLUMNS = [
    "output_key", "metric", "value_kind", "value_double", "value_string", "value_array",
    "unit", "compute_status", "error",
]


def scalar(metric: str, value: Column, unit: str, kind: str = "double",
           applicable: Column | None = None) -> Column:
    """One measurement struct; null and ``not_applicable`` where the condition fails."""
    number = value.cast("double")
    status = F.lit(COMPUTED)
    kind_column = F.lit(kind)
    if applicable is not None:
        number = F.when(applicable, number)
        status = F.when(applicable, COMPUTED).otherwise(NOT_APPLICABLE)
        kind_column = F.when(applicable, kind).otherwise("null")
    return F.struct(
        F.lit(metric).alias("metric"),
        kind_column.alias("value_kind"),
        number.alias("value_double"),
        F.lit(None).cast("string").alias("value_string"),
        F.lit(None).cast("array<double>").alias("value_array"),
        F.lit(unit).alias("unit"),
        status.alias("compute_status"),
        F.lit(None).cast("string").alias("error"),
    )


def long_form(per_sample: DataFrame, key: str, structs: list[Column]) -> DataFrame:
    """Explode measurement structs of one-row-per-sample tables."""
    return per_sample.select(
        F.col(key).cast("string").alias("output_key"), F.explode(F.array(*structs)).alias("m")
    ).select("output_key", "m.*")


def per_mesh_statistics(meshes: MeshSet) -> DataFrame:
    """Everything the input measurements need, one row per mesh.

    Edge lengths and face normals cost the joins, and several measurements read
    them, so both are written once. The parts meet on the mesh key, which is the
    partitioning every one of them already ends in.
    """
    lengths = cut(topology.edge_lengths(meshes), "edge-lengths")
    faces = cut(topology.face_normals(meshes), "face-normals")
    normals = topology.vertex_normals(meshes, face_level=faces)
    length = F.sqrt(F.col("nx") ** 2 + F.col("ny") ** 2 + F.col("nz") ** 2)
    zero_normals = normals.groupBy(*KEY).agg(
        F.avg((length == 0.0).cast("double")).alias("zero_normal_fraction")
    )
    edges = cut(topology.edge_statistics(meshes, lengths), "edge-statistics")
    mad = topology.edge_mad(meshes, lengths, edges.select(*KEY, "median")).select(*KEY, "mad")
    parts = [
        mad,
        topology.face_statistics(meshes, faces),
        topology.duplicate_counts(meshes),
        topology.component_summary(meshes, lengths),
        topology.extents(meshes),
        zero_normals,
    ]
    # A mesh without faces has no edges either; it keeps its row, with counts of zero.
    joined = meshes.meshes()
    for part in [edges, *parts]:
        joined = joined.join(part, KEY, "left")
    none = ("edge_count", "boundary_edge_count", "nonmanifold_edge_count", "face_count", "degenerate_face_count", "duplicate_faces", "surface_area")
    return joined.withColumns({c: F.coalesce(c, F.lit(0).cast(joined.schema[c].dataType)) for c in none})


def input_measurements(meshes: MeshSet, expected_edge_mm: float) -> DataFrame:
    """The scalar input measurements of every mesh as long-form rows."""
    c = F.col
    expected = F.lit(float(expected_edge_mm))
    volume = c("extent_x") * c("extent_y") * c("extent_z")
    has_volume, has_area = volume > 0.0, c("surface_area") > 0.0
    has_edges, has_faces = c("edge_count") > 0, c("face_count") > 0
    edges = "input.edge_length."
    structs = [
        scalar(f"{edges}expected_mm", expected, "mm"),
        scalar(f"{edges}mean_mm", c("mean"), "mm", applicable=has_edges),
        scalar(f"{edges}median_mm", c("median"), "mm", applicable=has_edges),
        scalar(f"{edges}p05_mm", c("p05"), "mm", applicable=has_edges),
        scalar(f"{edges}p95_mm", c("p95"), "mm", applicable=has_edges),
        scalar(f"{edges}mad_mm", c("mad"), "mm", applicable=has_edges),
        scalar(f"{edges}median_to_expected_ratio", c("median") / expected, "ratio", applicable=has_edges),
        scalar("input.degenerate_faces.count", c("degenerate_face_count"), "count", "long"),
        scalar("input.duplicate_geometry.vertex_count", c("duplicate_vertices"), "count", "long"),
        scalar("input.duplicate_geometry.face_count", c("duplicate_faces"), "count", "long"),
        scalar("input.connected_components.count", c("component_count"), "count", "long"),
        scalar("input.connected_components.largest_fraction",
               c("largest_size") / c("nv"), "ratio"),
        scalar("input.topology.boundary_edge_count", c("boundary_edge_count"), "count", "long"),
        scalar("input.topology.boundary_edge_fraction",
               F.try_divide(c("boundary_edge_count"), c("edge_count")), "ratio", applicable=has_edges),
        scalar("input.topology.nonmanifold_edge_count", c("nonmanifold_edge_count"),
               "count", "long"),
        scalar("input.extent_density.extent_x_mm", c("extent_x"), "mm"),
        scalar("input.extent_density.extent_y_mm", c("extent_y"), "mm"),
        scalar("input.extent_density.extent_z_mm", c("extent_z"), "mm"),
        scalar("input.extent_density.vertices_per_mm3", F.try_divide(c("nv"), volume),
               "count/mm3", applicable=has_volume),
        scalar("input.extent_density.surface_area_mm2", c("surface_area"), "mm2"),
        scalar("input.extent_density.vertices_per_mm2", F.try_divide(c("nv"), c("surface_area")),
               "count/mm2", applicable=has_area),
        scalar("input.normal_consistency.zero_normal_fraction",
               c("zero_normal_fraction"), "ratio"),
        scalar("input.normal_consistency.zero_face_normal_fraction",
               c("zero_face_normal_fraction"), "ratio", applicable=has_faces),
    ]
    return long_form(per_mesh_statistics(meshes), "mesh_id", structs)


def component_vertex_counts(meshes: MeshSet) -> DataFrame:
    """The component-size measurement, kept as (size, how many) rows.

    The list form of this measurement has one entry per component, which no
    bound limits. Its run-length form holds the same list and folds map-side.
    """
    labels = topology.components(
        meshes.vertices, topology.edge_list(meshes.faces), meshes.largest, 3 * meshes.face_total
    )
    sizes = topology.component_sizes(labels)
    return sizes.groupBy("mesh_id", "size").agg(F.count(F.lit(1)).alias("components"))

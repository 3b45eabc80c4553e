"""Edges, boundaries, normals, duplicates and connected components."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from meshwright.functions.vectors import Vec, unit
from meshwright.plans import bounded
from meshwright.plans.meshset import KEY, MeshSet
from meshwright.plans.ranking import exact_quantiles
from meshwright.plans.skew import attach
from meshwright.session import cut

DEGENERATE_DOUBLE_AREA = 1.0e-12
COMPONENT_CHUNK = 1 << 19


def edge_list(faces: DataFrame) -> DataFrame:
    """Distinct undirected edges with the number of face sides on each.

    One pass emits the three sides of a face; repeats are folded before the
    shuffle. A repeated corner yields an edge from a vertex to itself.
    """
    sides = F.array(
        *[
            F.struct(F.least(p, q).alias("lo"), F.greatest(p, q).alias("hi"))
            for p, q in (("a", "b"), ("b", "c"), ("a", "c"))
        ]
    )
    return (
        faces.select(*KEY, F.explode(sides).alias("e"))
        .groupBy(*KEY, F.col("e.lo").alias("lo"), F.col("e.hi").alias("hi"))
        .agg(F.count(F.lit(1)).alias("k"))
    )


def edge_lengths(meshes: MeshSet) -> DataFrame:
    """mesh_id, nv, lo, hi, k, length."""
    joined = edge_list(meshes.faces)
    for end, point in (("lo", "p"), ("hi", "q")):
        side = meshes.vertices.select(
            "mesh_id", F.col("vid").alias(end), F.struct("x", "y", "z").alias(point)
        )
        joined = joined.join(side, ["mesh_id", end])
    length = Vec.of("p").minus(Vec.of("q")).norm()
    return joined.select(*KEY, "lo", "hi", "k", length.alias("length"))


def edge_statistics(meshes: MeshSet, lengths: DataFrame | None = None) -> DataFrame:
    """Edge counts and the exact length distribution of each mesh.

    ``lengths`` reuses edge lengths that are already written out.
    """
    lengths = edge_lengths(meshes) if lengths is None else lengths
    counts = [
        F.count(F.lit(1)).alias("edge_count"),
        F.count_if(F.col("k") == 1).alias("boundary_edge_count"),
        F.count_if(F.col("k") > 2).alias("nonmanifold_edge_count"),
        F.avg("length").alias("mean"),
    ]
    return exact_quantiles(
        lengths, KEY, "length", {"p05": 0.05, "median": 0.5, "p95": 0.95},
        largest=3 * meshes.largest, also=counts,
    )


def edge_mad(
    meshes: MeshSet, lengths: DataFrame | None = None, median: DataFrame | None = None
) -> DataFrame:
    """Median absolute deviation of edge length: a second pass around the median."""
    lengths = edge_lengths(meshes) if lengths is None else lengths
    bound = 3 * meshes.largest
    if median is None:
        median = exact_quantiles(lengths, KEY, "length", {"median": 0.5}, largest=bound)
    deviation = attach(lengths, median, KEY, spread="lo").select(
        *KEY, F.abs(F.col("length") - F.col("median")).alias("deviation")
    )
    mad = exact_quantiles(deviation, KEY, "deviation", {"mad": 0.5}, largest=bound)
    return median.join(mad, KEY)


def boundary_vertices(meshes: MeshSet) -> DataFrame:
    """Vertices on an edge that only one face side uses."""
    return (
        edge_list(meshes.faces)
        .where(F.col("k") == 1)
        .select(*KEY, F.explode(F.array("lo", "hi")).alias("vid"))
        .distinct()
    )


def with_corners(meshes: MeshSet) -> DataFrame:
    """Faces with the points of their corners as pa, pb, pc.

    In meshes of bounded size a task holds all vertices of a mesh, many small
    meshes at a time, and looks the corners up: one exchange of faces and one of
    vertices. A larger mesh is joined corner by corner.
    """
    if meshes.largest <= bounded.ROWS:
        return _corners_in_task(meshes)
    large = bounded.oversized([meshes.vertices])
    many = bounded.oversized([meshes.faces], counted=True)
    if many is not None:
        large = many if large is None else large.union(many).distinct()
    small = MeshSet(bounded.without(meshes.vertices, large), bounded.without(meshes.faces, large))
    rest = MeshSet(bounded.only(meshes.vertices, large), bounded.only(meshes.faces, large))
    return _corners_in_task(small).unionByName(_corners_by_join(rest))


def _corners_in_task(meshes: MeshSet) -> DataFrame:
    faces = meshes.faces.select(*KEY, "fid", "a", "b", "c")
    point = F.struct(*[F.lit(0.0).alias(a) for a in "xyz"])
    schema = faces.select("*", *[point.alias(f"p{c}") for c in "abc"]).schema
    empty = to_arrow_schema(schema).empty_table()

    def look_up(faces: pa.Table, vertices: pa.Table) -> pa.Table:
        if not faces.num_rows or not vertices.num_rows:
            return empty
        meshes = pa.chunked_array([*vertices.column("mesh_id").chunks, *faces.column("mesh_id").chunks])
        mesh = meshes.dictionary_encode(null_encoding="encode").combine_chunks().indices.to_numpy().astype(np.int64)
        ids = [vertices.column("vid").to_numpy(), *[pc.fill_null(faces.column(c), -1).to_numpy() for c in "abc"]]
        known, rank = np.unique(np.concatenate(ids), return_inverse=True)
        own, *rank = np.split(rank, np.cumsum([len(i) for i in ids[:-1]]))
        own = mesh[:len(own)] * len(known) + own
        order = np.argsort(own, kind="stable")
        found = [bounded.gather(own[order], mesh[len(own):] * len(known) + r) for r in rank]
        whole = np.flatnonzero(found[0][1] & found[1][1] & found[2][1])
        faces = faces.take(pa.array(whole))
        sides = [vertices.column(a).combine_chunks() for a in "xyz"]
        fields = list(empty.schema.field("pa").type)
        corners = [pa.StructArray.from_arrays([s.take(pa.array(order[at[whole]])) for s in sides], fields=fields) for at, _ in found]
        return pa.table([*[faces.column(c) for c in empty.column_names[:6]], *corners], schema=empty.schema)

    bins = (meshes.face_total + meshes.vertex_total) // bounded.ROWS + 1
    return bounded.per_bin(faces, meshes.vertices.select("mesh_id", "vid", "x", "y", "z"), bins, look_up, schema)


def _corners_by_join(meshes: MeshSet) -> DataFrame:
    joined = meshes.faces
    for corner in ("a", "b", "c"):
        side = meshes.vertices.select(
            "mesh_id", F.col("vid").alias(corner), F.struct("x", "y", "z").alias(f"p{corner}")
        )
        joined = joined.join(side, ["mesh_id", corner])
    return joined.select(*KEY, "fid", "a", "b", "c", "pa", "pb", "pc")


def face_cross() -> Vec:
    """Cross product of a face's two sides from its first corner."""
    origin = Vec.of("pa")
    return Vec.of("pb").minus(origin).cross(Vec.of("pc").minus(origin))


def face_normals(meshes: MeshSet) -> DataFrame:
    """Corners, unnormalized normal n and doubled area of every face."""
    crossed = with_corners(meshes).select(
        *KEY, "fid", "a", "b", "c", face_cross().struct().alias("n"))
    return crossed.withColumn("double_area", Vec.of("n").norm())


def face_areas(meshes: MeshSet) -> DataFrame:
    """Doubled area of every face."""
    return face_normals(meshes).drop("n")


def face_statistics(meshes: MeshSet, normals: DataFrame | None = None) -> DataFrame:
    """Face count, degenerate faces and surface area of each mesh."""
    flat = F.col("double_area") <= DEGENERATE_DOUBLE_AREA
    areas = face_normals(meshes) if normals is None else normals
    return areas.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("face_count"),
        F.count_if(flat).alias("degenerate_face_count"),
        F.avg(flat.cast("double")).alias("zero_face_normal_fraction"),
        (F.sum("double_area") * 0.5).alias("surface_area"),
    )


def badly_sized_vertices(meshes: MeshSet, zscore: float) -> DataFrame:
    """Corners of faces whose area lies more than ``zscore`` deviations off the mean."""
    areas = face_areas(meshes).withColumn("area", F.col("double_area") * 0.5)
    moments = areas.groupBy(*KEY).agg(
        F.avg("area").alias("area_mean"), F.stddev_pop("area").alias("area_std")
    )
    away = F.abs(F.col("area") - F.col("area_mean")) / F.col("area_std")
    return (
        attach(areas, moments.where(F.col("area_std") > 0.0), KEY, spread="fid")
        .where(away > float(zscore))
        .select(*KEY, F.explode(F.array("a", "b", "c")).alias("vid"))
        .distinct()
    )


def vertex_normals(
    meshes: MeshSet, reference: DataFrame | None = None, face_level: DataFrame | None = None
) -> DataFrame:
    """Unit mean of the unit normals of the faces around each vertex.

    Faces weigh the same whatever their area. Vertices without faces get zero.
    With ``reference`` normals a mesh whose normals oppose them is flipped.
    """
    crossed = face_normals(meshes) if face_level is None else face_level
    normal = Vec.of("n")
    summed = (
        crossed.select(
            "mesh_id",
            F.explode(F.array("a", "b", "c")).alias("vid"),
            unit(normal, F.col("double_area")).struct().alias("u"),
        )
        .groupBy("mesh_id", "vid")
        .agg(*[F.sum(f"u.{axis}").alias(f"s{axis}") for axis in "xyz"])
    )
    total = Vec(*[F.coalesce(F.col(f"s{axis}"), F.lit(0.0)) for axis in "xyz"])
    parts = unit(total, total.norm())
    normals = meshes.vertices.select(*KEY, "vid").join(summed, ["mesh_id", "vid"], "left").select(
        *KEY, "vid", parts.x.alias("nx"), parts.y.alias("ny"), parts.z.alias("nz")
    )
    if reference is None:
        return normals
    paired = normals.join(
        reference.select("mesh_id", "vid", *[F.col(f"n{a}").alias(f"r{a}") for a in "xyz"]),
        ["mesh_id", "vid"],
    )
    agreement = sum(F.col(f"n{a}") * F.col(f"r{a}") for a in "xyz")
    sign = paired.groupBy(*KEY).agg(
        F.when(F.sum(agreement) < 0.0, -1.0).otherwise(1.0).alias("sign")
    )
    return attach(normals, sign, KEY).select(
        *KEY, "vid", *[(F.col(f"n{a}") * F.col("sign")).alias(f"n{a}") for a in "xyz"]
    )


def duplicate_counts(meshes: MeshSet) -> DataFrame:
    """Vertices and faces beyond the first of each distinct one.

    Vertices compare by representation, so minus zero differs from zero. Faces
    compare by corner set, so orientation does not matter. Both are folded by
    their value first, never gathered per mesh.
    """
    text = [F.col(axis).cast("string").alias(axis) for axis in "xyz"]
    points = (
        meshes.vertices.select(*KEY, *text).groupBy(*KEY, "x", "y", "z").count()
        .groupBy(*KEY).agg(F.sum(F.col("count") - 1).alias("duplicate_vertices"))
    )
    corners = F.array_sort(F.array("a", "b", "c"))
    faces = (
        meshes.faces.groupBy(*KEY, corners.alias("corners")).count()
        .groupBy(*KEY).agg(F.sum(F.col("count") - 1).alias("duplicate_faces"))
    )
    return points.join(faces, KEY, "left").select(
        *KEY, "duplicate_vertices", F.coalesce("duplicate_faces", F.lit(0)).alias("duplicate_faces")
    )


def extents(meshes: MeshSet) -> DataFrame:
    return meshes.vertices.groupBy(*KEY).agg(
        *[(F.max(axis) - F.min(axis)).alias(f"extent_{axis}") for axis in "xyz"]
    )


def lowest_reached(pair: np.ndarray, nodes: int) -> np.ndarray:
    """Smallest node each node reaches over the edges ``pair``: neighbour minimum and pointer jumping until stable."""
    label = np.arange(nodes)
    while True:
        low = np.minimum(label[pair[:, 0]], label[pair[:, 1]])
        step = label.copy()
        np.minimum.at(step, pair[:, 0], low)
        np.minimum.at(step, pair[:, 1], low)
        step = step[step]
        if np.array_equal(step, label):
            return label
        label = step


def _label_pieces(pdf: pd.DataFrame) -> pd.DataFrame:
    """Smallest vertex id each vertex reaches inside its piece of edges.

    One call holds many small pieces: nodes are numbered by (piece, vertex).
    """
    piece = pdf.groupby(["mesh_id", "_chunk", "_part"], sort=False).ngroup().to_numpy()
    ends = pdf[["lo", "hi"]].to_numpy()
    keys = np.stack([np.repeat(piece, 2), ends.reshape(-1)])
    order = np.lexsort((keys[1], keys[0]))
    keys = keys[:, order]
    fresh = np.append(True, np.any(keys[:, 1:] != keys[:, :-1], axis=0))
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.cumsum(fresh) - 1
    pair = number.reshape(-1, 2)
    label = lowest_reached(pair, int(fresh.sum()))
    vertex = keys[1][fresh]
    mesh = np.repeat(pdf["mesh_id"].to_numpy(), 2)[order][fresh]
    return pd.DataFrame({"mesh_id": mesh, "vid": vertex, "label": vertex[label]})


def components(
    vertices: DataFrame,
    edges: DataFrame,
    largest: int,
    edge_bound: int,
    chunk: int = COMPONENT_CHUNK,
) -> DataFrame:
    """Label every vertex with the smallest vertex id of its component.

    Edges are contracted in bounded pieces first, many small meshes to a task:
    ``edge_bound``, at least the number of edges, sets how many tasks. If every
    mesh is one piece the labels are final. Otherwise the contracted edges, far
    fewer than the originals, go through alternating min-neighbour rounds until
    nothing changes; no step gathers a vertex's neighbours in one place.
    """
    side = max(1, chunk // 4)
    pieces = edges.where(F.col("lo") != F.col("hi")).select(
        "mesh_id", "lo", "hi", F.expr(f"lo div {side}").alias("_chunk")
    )
    if largest <= side:
        pieces = pieces.withColumn("_part", F.lit(0))
    else:
        # A hub vertex can put many edges into one range of ids: split by count.
        counts = pieces.groupBy("mesh_id", "_chunk").agg(F.count(F.lit(1)).alias("_n"))
        parts = F.expr(f"cast(_n div {chunk} as int) + 1")
        pieces = pieces.join(counts, ["mesh_id", "_chunk"]).withColumn(
            "_part", F.pmod(F.xxhash64("hi"), parts).cast("int")
        )
    cores = vertices.sparkSession.sparkContext.defaultParallelism
    bins = max(cores, edge_bound // chunk + 1)
    binned = pieces.withColumn("_bin", F.pmod(F.xxhash64("mesh_id", "_chunk", "_part"), F.lit(bins)))
    schema = vertices.select("mesh_id", "vid", F.col("vid").alias("label")).schema
    stars = binned.groupBy("_bin").applyInPandas(_label_pieces, schema)
    if largest > side:
        stars = _merge_stars(stars)
    return vertices.select(*KEY, "vid").join(stars, ["mesh_id", "vid"], "left").select(
        *KEY, "vid", F.coalesce("label", "vid").alias("label")
    )


def _merge_stars(stars: DataFrame) -> DataFrame:
    """Large-star / small-star rounds over (vid, label) edges until stable."""
    edges = cut(stars.where(F.col("vid") != F.col("label")).distinct(), "stars")
    while True:
        both = edges.select("mesh_id", F.col("vid").alias("u"), F.col("label").alias("v")).union(
            edges.select("mesh_id", F.col("label").alias("u"), F.col("vid").alias("v"))
        )
        low = both.groupBy("mesh_id", "u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.where(F.col("v") > F.col("u")).join(low, ["mesh_id", "u"])
            .select("mesh_id", F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        large = cut(large, "large-star")
        floor = large.groupBy("mesh_id", "u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        small = (
            large.join(floor, ["mesh_id", "u"])
            .select("mesh_id", F.explode(F.array("u", "v")).alias("vid"), F.col("m").alias("label"))
            .where(F.col("vid") != F.col("label"))
            .distinct()
        )
        merged = cut(small, "small-star")
        same = merged.count() == edges.count() and merged.exceptAll(edges).isEmpty()
        edges = merged
        if same:
            return edges


def component_sizes(labels: DataFrame) -> DataFrame:
    """One row per component; ``label`` is its smallest vertex."""
    return labels.groupBy(*KEY, "label").agg(F.count(F.lit(1)).alias("size"))


def component_summary(meshes: MeshSet, edges: DataFrame | None = None) -> DataFrame:
    """Number of components and the size of the largest."""
    edges = edge_list(meshes.faces) if edges is None else edges
    labels = components(meshes.vertices, edges, meshes.largest, 3 * meshes.face_total)
    return component_sizes(labels).groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("component_count"), F.max("size").alias("largest_size")
    )


def largest_component(labels: DataFrame) -> DataFrame:
    """Per mesh the component with most vertices; ties go to the smallest vertex id."""
    best = F.min(F.struct((-F.col("size")).alias("minus"), F.col("label"))).alias("best")
    return component_sizes(labels).groupBy(*KEY).agg(best).select(
        *KEY, F.col("best.label").alias("label"), (-F.col("best.minus")).alias("size")
    )

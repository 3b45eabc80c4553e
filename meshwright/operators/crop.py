"""Turning vertex probabilities into a cropped mesh, and its metrics."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshwright.operators.topology import (
    component_sizes,
    components,
    edge_list,
    largest_component,
    lowest_reached,
)
from meshwright.plans import bounded
from meshwright.plans.meshset import KEY, MeshSet
from meshwright.plans.ranking import dense_index, exact_quantiles
from meshwright.plans.skew import attach
from meshwright.session import cut


def neighbours(edges: DataFrame) -> DataFrame:
    """(mesh_id, vid, neighbour) in both directions; a self-edge counts once."""
    both = F.array(
        F.struct(F.col("lo").alias("vid"), F.col("hi").alias("neighbour")),
        F.struct(F.col("hi").alias("vid"), F.col("lo").alias("neighbour")),
    )
    once = F.array(F.struct(F.col("lo").alias("vid"), F.col("hi").alias("neighbour")))
    ends = F.explode(F.when(F.col("lo") == F.col("hi"), once).otherwise(both)).alias("e")
    return edges.select("mesh_id", ends).select("mesh_id", "e.vid", "e.neighbour")


def vote_average(votes: DataFrame) -> DataFrame:
    """Mean of the overlapping predictions a vertex received."""
    return votes.groupBy("mesh_id", "vid").agg(
        F.avg("probability").cast("float").cast("double").alias("probability"),
        F.count("probability").alias("votes"),
    )


def smooth(
    meshes: MeshSet, values: DataFrame, iterations: int, alpha: float = 0.5
) -> DataFrame:
    """Blend each vertex's probability with its neighbours' mean, in single precision.

    All vertices of a round read the previous round, which is written out so
    that the plan does not double with each round.
    """
    alpha = min(max(float(alpha), 0.0), 1.0)
    current = values.select("mesh_id", "vid", "probability")
    if iterations <= 0:
        return current
    links = cut(neighbours(edge_list(meshes.faces)), "links")
    for _ in range(int(iterations)):
        current = cut(current, "smooth")
        around = (
            links.join(
                current.select("mesh_id", F.col("vid").alias("neighbour"), "probability"),
                ["mesh_id", "neighbour"],
            )
            .groupBy("mesh_id", "vid")
            .agg(F.avg("probability").alias("around"))
        )
        blended = F.col("probability") * (1.0 - alpha) + F.col("around") * alpha
        current = current.join(around, ["mesh_id", "vid"], "left").select(
            "mesh_id", "vid",
            F.coalesce(blended, F.col("probability")).cast("float").cast("double").alias("probability"),
        )
    return current


def masks(
    meshes: MeshSet,
    probabilities: DataFrame,
    threshold: float,
    keep_largest: bool = True,
    min_component: int = 0,
) -> DataFrame:
    """mesh_id, nv, vid, probability, initial, final, label for every vertex.

    A task labels many whole meshes of bounded size; larger ones go through joins.
    """
    if not 0.0 <= threshold <= 1.0:
        raise ValueError("threshold must be in [0, 1]")
    n = bounded.tasks(probabilities, 2 * meshes.vertex_total)
    marked = cut(
        meshes.vertices.select(*KEY, "vid").repartition(n, "mesh_id", "vid")
        .join(probabilities.repartition(n, "mesh_id", "vid"), ["mesh_id", "vid"])
        .select(*KEY, "vid", "probability", (F.col("probability") >= float(threshold)).alias("initial")),
        "marked",
    )
    least = max(1, int(min_component))
    rows = marked.count() + meshes.face_total
    large = bounded.oversized([marked, meshes.faces], counted=True)
    small = _masks_in_task(bounded.without(marked, large), bounded.without(meshes.faces, large), rows, keep_largest, least)
    if large is None:
        return small
    rest = MeshSet(bounded.only(meshes.vertices, large), bounded.only(meshes.faces, large))
    return small.unionByName(_masks_by_join(rest, bounded.only(marked, large), keep_largest, least))


def _masks_in_task(marked: DataFrame, faces: DataFrame, rows: int, keep_largest: bool, least: int) -> DataFrame:
    schema = marked.select("*", F.lit(True).alias("final"), F.col("vid").alias("label")).schema

    def choose(own: pa.Table, faces: pa.Table) -> pa.Table:
        mesh, of = bounded.mesh_numbers(own, faces)
        known, (vid, *corners), (_, *valid) = bounded.ranked(own.column("vid"), *[faces.column(c) for c in "abc"])
        initial = own.column("initial").fill_null(False).to_numpy()
        # Nodes are the initial vertices by mesh and id; a repeated vertex is one node of several rows.
        nodes, copies = np.unique(mesh[initial] * len(known) + vid[initial], return_counts=True)
        ends = [bounded.gather(nodes, of * len(known) + c) for c in corners]
        ends = [(place, there & v) for (place, there), v in zip(ends, valid, strict=True)]
        sides = [np.stack([p, q], 1)[u & v] for (p, u), (q, v) in (ends[:2], ends[1:], ends[::2])]
        label = lowest_reached(np.concatenate(sides), len(nodes))
        size = np.bincount(label, copies, len(nodes)).astype(np.int64)
        roots = np.flatnonzero(size)
        if keep_largest:
            roots = roots[np.lexsort((roots, -size[roots], nodes[roots] // len(known)))]
            roots = roots[np.unique(nodes[roots] // len(known), return_index=True)[1]]
        chosen = np.zeros(len(nodes), bool)
        chosen[roots] = size[roots] >= least
        place, there = bounded.gather(nodes, mesh * len(known) + vid)
        final, reached = np.zeros(len(vid), bool), np.zeros(len(vid), np.int64)
        final[there] = chosen[label[place[there]]]
        reached[final] = known[nodes[label[place[final]]] % len(known)]
        times = np.ones(len(vid), np.int64)
        times[final] = copies[place[final]]
        out = own.append_column("final", pa.array(final)).append_column("label", pa.array(reached, mask=~final))
        return out if times.max(initial=1) == 1 else out.take(pa.array(np.repeat(np.arange(len(vid)), times)))

    return bounded.dealt(marked, faces.select("mesh_id", "a", "b", "c"), rows, choose, schema)


def _masks_by_join(meshes: MeshSet, marked: DataFrame, keep_largest: bool, least: int) -> DataFrame:
    inside = marked.where("initial").select("mesh_id", "vid")
    edges = edge_list(meshes.faces)
    for end in ("lo", "hi"):
        edges = edges.join(inside.withColumnRenamed("vid", end), ["mesh_id", end], "left_semi")
    labels = components(
        marked.where("initial").select(*KEY, "vid"), edges, meshes.largest, 3 * meshes.face_total)
    labels = cut(labels, "mask-labels")
    if keep_largest:
        chosen = largest_component(labels)
    else:
        chosen = component_sizes(labels)
    chosen = chosen.where(F.col("size") >= least).select("mesh_id", "label")
    kept = labels.join(chosen, ["mesh_id", "label"]).select("mesh_id", "vid", "label")
    return marked.join(kept, ["mesh_id", "vid"], "left").select(
        *KEY, "vid", "probability", "initial", F.col("label").isNotNull().alias("final"), "label"
    )


def crop(meshes: MeshSet, keep: DataFrame) -> MeshSet:
    """Faces with all corners kept, the vertices they use, renumbered in order.

    ``keep`` is (mesh_id, vid). Old ids stay as ``old_vid`` and ``old_fid``.
    Meshes of bounded size are cropped in tasks that hold them whole, the others
    by joins.
    """
    rows = meshes.face_total + meshes.vertex_total
    if meshes.largest <= bounded.ROWS:
        return _crop_in_task(meshes, keep, rows)
    large = bounded.oversized([meshes.vertices])
    many = bounded.oversized([meshes.faces], counted=True)
    if many is not None:
        large = many if large is None else large.union(many).distinct()
    parts = [
        work(MeshSet(pick(meshes.vertices, large), pick(meshes.faces, large)), pick(keep, large), *more)
        for work, pick, more in ((_crop_in_task, bounded.without, [rows]), (_crop_by_join, bounded.only, []))
    ]
    return MeshSet(parts[0].vertices.unionByName(parts[1].vertices), parts[0].faces.unionByName(parts[1].faces))


def _crop_in_task(meshes: MeshSet, keep: DataFrame, rows: int) -> MeshSet:
    given = meshes.faces.select("mesh_id", "fid", "a", "b", "c")
    c, number = F.col, F.lit(None).cast("bigint")
    olds = ["old_fid", *[f"old_{e}" for e in "abc"]]
    schema = given.select(
        "mesh_id", *[number.alias(n) for n in ("nv", "fid", *"abc")],
        *[c(o.removeprefix("old_")).alias(o) for o in olds]).schema

    def crop_faces(faces: pa.Table, keep: pa.Table) -> pa.Table:
        mesh, of = bounded.mesh_numbers(faces, keep)
        known, (kept, *corners), (there, *valid) = bounded.ranked(keep.column("vid"), *[faces.column(e) for e in "abc"])
        wanted = np.unique((of * len(known) + kept)[there])
        ends = np.stack([mesh * len(known) + e for e in corners])
        whole = np.flatnonzero(np.logical_and.reduce([bounded.gather(wanted, e)[1] & v for e, v in zip(ends, valid, strict=True)]))
        faces, mesh, ends = faces.take(pa.array(whole)), mesh[whole], ends[:, whole]
        used = np.unique(ends)
        starts = np.searchsorted(used, mesh * len(known))
        found = [np.searchsorted(used, (mesh + 1) * len(known)) - starts, *(np.searchsorted(used, ends) - starts)]
        # Faces without an id come first, use vertices and take numbers, but are no rows of the result: they have no new id.
        fid = faces.column("fid")
        named = fid.is_valid().to_numpy()
        order = np.lexsort((fid.fill_null(0).to_numpy(), named, mesh))
        ids = np.empty(len(mesh), np.int64)
        ids[order] = np.arange(len(mesh)) - np.searchsorted(mesh[order], mesh[order])
        nv, *news = map(pa.array, found)
        return pa.table([faces.column("mesh_id"), nv, pa.array(ids, mask=~named), *news, *[faces.column(o.removeprefix("old_")) for o in olds]],
                        names=["mesh_id", "nv", "fid", *"abc", *olds])

    faces = cut(bounded.dealt(given, keep.select("mesh_id", "vid"), rows, crop_faces, schema), "crop-faces")
    points = meshes.vertices.select("mesh_id", "vid", "x", "y", "z")
    schema = points.select(
        "mesh_id", *[number.alias(n) for n in ("nv", "vid")], "x", "y", "z", c("vid").alias("old_vid")).schema

    def crop_vertices(points: pa.Table, faces: pa.Table) -> pa.Table:
        mesh, of = bounded.mesh_numbers(points, faces)
        known, (vid, *ends), (there, *_) = bounded.ranked(points.column("vid"), *[faces.column(f"old_{e}") for e in "abc"])
        used, first = np.unique(np.concatenate([of * len(known) + e for e in ends]), return_index=True)
        place, hit = bounded.gather(used, mesh * len(known) + vid)
        at = np.flatnonzero(hit & there)
        first = first[place[at]]
        new = np.concatenate([faces.column(e).to_numpy() for e in "abc"])[first]
        points = points.take(pa.array(at))
        return pa.table([points.column("mesh_id"), pa.array(np.tile(faces.column("nv").to_numpy(), 3)[first]), pa.array(new),
                         *[points.column(a) for a in "xyz"], points.column("vid")], names=["mesh_id", "nv", "vid", *"xyz", "old_vid"])

    vertices = bounded.dealt(points, faces.drop("fid", "old_fid"), rows, crop_vertices, schema)
    return MeshSet(vertices, faces.where(c("fid").isNotNull()).select("mesh_id", "nv", "fid", *"abc", "old_fid"))


def _crop_by_join(meshes: MeshSet, keep: DataFrame) -> MeshSet:
    faces = meshes.faces
    for corner in ("a", "b", "c"):
        faces = faces.join(
            keep.select("mesh_id", F.col("vid").alias(corner)), ["mesh_id", corner], "left_semi"
        )
    faces = cut(faces.select("mesh_id", "fid", "a", "b", "c"), "crop-faces")
    used = faces.select("mesh_id", F.explode(F.array("a", "b", "c")).alias("vid")).distinct()
    numbered = cut(dense_index(used, ["mesh_id"], "vid", "new", size="nv"), "crop-ids")
    vertices = meshes.vertices.drop("nv").join(numbered, ["mesh_id", "vid"]).select(
        "mesh_id", "nv", F.col("new").alias("vid"), "x", "y", "z", F.col("vid").alias("old_vid")
    )
    renamed = dense_index(faces, ["mesh_id"], "fid", "new_fid")
    for corner in ("a", "b", "c"):
        extra = ["nv"] if corner == "a" else []
        ids = numbered.select("mesh_id", *extra, F.col("vid").alias(corner), F.col("new").alias(f"new_{corner}"))
        renamed = renamed.join(ids, ["mesh_id", corner])
    return MeshSet(
        vertices,
        renamed.select(
            "mesh_id", "nv", F.col("new_fid").alias("fid"),
            *[F.col(f"new_{c}").alias(c) for c in "abc"], F.col("fid").alias("old_fid"),
        ),
    )


def crop_metrics(meshes: MeshSet, marked: DataFrame, cropped: MeshSet) -> DataFrame:
    """Retention, probability, post-processing and component metrics per mesh."""
    changed = F.col("initial") != F.col("final")
    plain = [
        F.avg("probability").alias("probability_mean"),
        F.count_if(changed).alias("changed_vertices"),
        F.avg(changed.cast("double")).alias("changed_fraction"),
        F.count_if("final").alias("kept"),
    ]
    base = exact_quantiles(
        marked, KEY, "probability", {"probability_p05": 0.05, "probability_p95": 0.95},
        largest=meshes.largest, also=plain,
    )
    parts = marked.where("final").groupBy(*KEY, "label").agg(F.count(F.lit(1)).alias("size"))
    parts = parts.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("components"), F.max("size").alias("largest")
    )
    counts = {
        "faces_all": meshes.faces.groupBy("mesh_id").agg(F.count(F.lit(1)).alias("faces_all")),
        "faces_kept": cropped.faces.groupBy("mesh_id").agg(F.count(F.lit(1)).alias("faces_kept")),
        "vertices_kept": cropped.vertices.groupBy("mesh_id").agg(
            F.count(F.lit(1)).alias("vertices_kept")),
    }
    joined = base.join(parts, KEY, "left")
    for table in counts.values():
        joined = joined.join(table, "mesh_id", "left")
    zero = F.lit(0)
    c = F.col
    return joined.select(
        *KEY,
        (F.coalesce(c("vertices_kept"), zero) / c("nv")).alias("retained_vertex_fraction"),
        F.try_divide(F.coalesce(c("faces_kept"), zero), c("faces_all")).alias("retained_face_fraction"),
        "probability_mean", "probability_p05", "probability_p95",
        "changed_vertices", "changed_fraction",
        F.coalesce(c("components"), zero).cast("bigint").alias("kept_component_count"),
        F.coalesce(F.try_divide(c("largest"), c("kept")), F.lit(0.0)).alias("largest_component_fraction"),
        (F.coalesce(c("vertices_kept"), zero) >= 3).alias("usable"),
    )


def mask_jaccard(left: DataFrame, right: DataFrame) -> DataFrame:
    """Overlap of two vertex masks (mesh_id, vid, kept) per mesh; 1 if both are empty."""
    both = left.select("mesh_id", "vid", F.col("kept").alias("l")).join(
        right.select("mesh_id", "vid", F.col("kept").alias("r")), ["mesh_id", "vid"])
    shared, either = F.count_if(F.col("l") & F.col("r")), F.count_if(F.col("l") | F.col("r"))
    return both.groupBy("mesh_id").agg(
        F.when(either == 0, 1.0).otherwise(F.try_divide(shared, either)).alias("jaccard")
    )


def normalized_points(meshes: MeshSet) -> DataFrame:
    """Points centred on their mean and scaled to unit radius, in single precision."""
    centre = meshes.vertices.groupBy(*KEY).agg(*[F.avg(a).alias(f"c{a}") for a in "xyz"])
    moved = attach(meshes.vertices, centre, KEY).select(
        *KEY, "vid", *[(F.col(a) - F.col(f"c{a}")).alias(a) for a in "xyz"])
    reach = F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y") + F.col("z") * F.col("z"))
    radius = moved.groupBy(*KEY).agg(F.max(reach).alias("scale")).where(F.col("scale") > 0.0)
    return attach(moved, radius, KEY).select(
        *KEY, "vid", *[(F.col(a) / F.col("scale")).cast("float").alias(a) for a in "xyz"])

"""Mesh, measurement and label tables derived from the event and document tables.

One mesh per user: events in id order are its vertices. Faces are a triangle
strip, or a scrambled pattern with degenerate faces, shared edges and many
components. All of it grows with the input tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshwright.plans.meshset import KEY, MeshSet
from meshwright.plans.ranking import dense_index
from meshwright.session import configure, cut

_written: dict[tuple[str, str], DataFrame] = {}


def forget() -> None:
    """Derive anew on the next use; called when the scratch tables are deleted."""
    _written.clear()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def index_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """mesh_id, nv, vid, x, y, z, event_type with dense vertex positions."""
    events = read(spark, sf_dir, "events").select(
        F.col("user_id").alias("mesh_id"),
        "event_id",
        F.col("value").alias("x"),
        (F.hour("ts") * 60 + F.minute("ts")).cast("double").alias("y"),
        (F.col("event_id") % 50).cast("double").alias("z"),
        "event_type",
    )
    indexed = dense_index(events, ["mesh_id"], "event_id", "vid", size="nv")
    return indexed.select(*KEY, "vid", "x", "y", "z", "event_type")


def event_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The indexed events, written once per application and scale."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _written:
        _written[key] = cut(index_events(spark, sf_dir), "vertices")
    return _written[key]


def _points(vertices: DataFrame) -> DataFrame:
    return vertices.select(*KEY, "vid", "x", "y", "z")


def strip(spark: SparkSession, sf_dir: str) -> MeshSet:
    """Triangle strip over each mesh's vertices."""
    vertices = event_vertices(spark, sf_dir)
    vid = F.col("vid")
    faces = vertices.where(vid + 2 < F.col("nv")).select(
        *KEY, vid.alias("fid"), vid.alias("a"), (vid + 1).alias("b"), (vid + 2).alias("c")
    )
    return MeshSet(_points(vertices), faces)


def sheet(spark: SparkSession, sf_dir: str) -> MeshSet:
    """Vertices in rows of eight with two triangles per square: a surface with an inside and a boundary."""
    vertices = event_vertices(spark, sf_dir)
    vid = F.col("vid")
    corner = F.explode(F.array(F.lit(0), F.lit(1)))
    squares = vertices.where((vid % 8 < 7) & (vid + 9 < F.col("nv"))).select(*KEY, "vid", corner.alias("half"))
    upper = F.col("half") == 1
    faces = squares.select(
        *KEY, (vid * 2 + F.col("half")).alias("fid"), F.when(upper, vid + 1).otherwise(vid).alias("a"),
        F.when(upper, vid + 9).otherwise(vid + 1).alias("b"), (vid + 8).alias("c"))
    return MeshSet(_points(vertices), faces)


def scrambled(spark: SparkSession, sf_dir: str) -> MeshSet:
    """Irregular faces: degenerate, duplicated, non-manifold, disconnected."""
    vertices = event_vertices(spark, sf_dir)
    vid = F.col("vid")
    faces = vertices.where(vid % 3 == 0).select(
        *KEY,
        vid.alias("fid"),
        (vid % 12).alias("a"),
        ((vid * 7 + 3) % F.col("nv")).alias("b"),
        ((vid * 11 + 5) % 9).alias("c"),
    )
    return MeshSet(_points(vertices), faces)


def quantized(spark: SparkSession, sf_dir: str) -> MeshSet:
    """Coordinates snapped to a coarse lattice, which makes vertices coincide."""
    vertices = event_vertices(spark, sf_dir)
    snapped = vertices.select(
        *KEY,
        "vid",
        F.floor(F.col("x") / 25.0).cast("double").alias("x"),
        F.floor(F.col("y") / 240.0).cast("double").alias("y"),
        (F.col("z").cast("bigint") % 4).cast("double").alias("z"),
    )
    return MeshSet(snapped, scrambled(spark, sf_dir).faces)


# Which measurement each event type stands for, and its unit.
EVENT_METRICS = [
    ("view", "input.edge_length.median_mm", "mm"),
    ("click", "crop.retention.vertex_fraction", "ratio"),
    ("signup", "landmark.anatomy.nose_height_mm", "mm"),
    ("purchase", "gpa.transform.scale", "ratio"),
    ("error", "registration.deformation.mean_mm", "mm"),
]


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long-form measurements, one sample per user and one metric per event type."""
    events = read(spark, sf_dir, "events").select("user_id", "event_type", "value")
    user, kind = F.col("user_id"), F.col("event_type")
    metric = F.coalesce(*[F.when(kind == k, F.lit(m)) for k, m, _ in EVENT_METRICS])
    unit = F.coalesce(*[F.when(kind == k, F.lit(u)) for k, _, u in EVENT_METRICS])
    status = (
        F.when((kind == "view") & (user % 11 == 0), "not_available")
        .when((kind == "error") & (user % 13 == 0), "computation_error")
        .otherwise("computed")
    )
    return (
        events.where(~((kind == "signup") & (user % 17 == 0)))
        .groupBy("user_id", "event_type")
        .agg(F.round(F.avg("value"), 6).alias("value_double"))
        .select(
            user.cast("string").alias("output_key"),
            metric.alias("metric"),
            F.lit("double").alias("value_kind"),
            "value_double",
            F.lit(None).cast("string").alias("value_string"),
            F.lit(None).cast("array<double>").alias("value_array"),
            unit.alias("unit"),
            status.alias("compute_status"),
            F.lit(None).cast("string").alias("error"),
        )
    )


def probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(mesh_id, vid, probability): a saturating score of each event's value."""
    vertices = event_vertices(spark, sf_dir)
    score = (F.col("x") / (F.col("x") + F.lit(25.0))).cast("float").cast("double")
    return vertices.select("mesh_id", "vid", score.alias("probability"))


def landmarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine named points per mesh, displaced from its first nine vertices."""
    from meshwright.operators.landmarks import NAMES

    vertices = event_vertices(spark, sf_dir).where(F.col("vid") < len(NAMES))
    idx = F.col("vid")
    names = F.array(*[F.lit(n) for n in NAMES])
    return vertices.select(
        *KEY, idx.cast("int").alias("idx"), F.element_at(names, (idx + 1).cast("int")).alias("name"),
        (F.col("x") + idx * 1.5).alias("x"), (F.col("y") - 20.0).alias("y"), (F.col("z") + 3.0).alias("z"))

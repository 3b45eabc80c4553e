"""Wavefront OBJ text as a distributed source and sink.

Files are split by the text reader like any text. Lines find their place from
the split they came from, so one large file is parsed by many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meshwright.plans.meshset import MeshSet
from meshwright.plans.skew import attach_sized
from meshwright.session import cut

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
NOT_FINITE = r"(?i)^[+-]?(nan|inf|infinity)$"
INTEGER = r"^[+-]?\d+$"
COUNTED = {
    "texture_vertices": ("vt",),
    "vertex_normals": ("vn",),
    "material_directives": ("mtllib", "usemtl"),
    "object_group_directives": ("o", "g"),
    "smoothing_directives": ("s",),
}
KNOWN = {"v", "f"} | {d for group in COUNTED.values() for d in group}
GLOB = "*.[oO][bB][jJ]"


@dataclass(frozen=True)
class ObjFiles:
    """Parsed meshes keyed by path, an inventory row per file, unknown directives.

    ``files`` has one row per readable file; ``error`` names its first defect,
    and such a file has no mesh.
    """

    meshes: MeshSet
    files: DataFrame
    unknown: DataFrame


def local_path(column: Column) -> Column:
    """A file URI as a plain path."""
    stripped = F.regexp_replace(column, "^file:(//)?(?=/)", "")
    return F.url_decode(F.replace(stripped, F.lit("+"), F.lit("%2B")))


def read_lines(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """path, block, id and text of every line, in file order by (block, id)."""
    reader = spark.read.option("pathGlobFilter", GLOB)
    return reader.text(paths).select(
        local_path(F.col("_metadata.file_path")).alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), "value")


def parse_lines(lines: DataFrame) -> DataFrame:
    """Directive, tokens and position counters of each line.

    ``seen`` counts the vertices before a line in its file. Only the counts of
    each split pass through a per-file window; lines are numbered in their split.
    """
    bare = F.regexp_replace(F.substring_index("value", "#", 1), r"^\s+|\s+$", "")
    typed = cut(
        lines.withColumn("parts", F.split(bare, r"\s+")).select(
            "path", "block", "id", F.col("parts")[0].alias("directive"),
            F.when(F.col("parts")[0].isin("v", "f"), F.col("parts")).alias("parts")),
        "obj-lines")
    is_v, is_f = F.col("directive") == "v", F.col("directive") == "f"
    counts = typed.groupBy("path", "block").agg(
        F.count(F.lit(1)).alias("_lines"), F.count_if(is_v).alias("_v"), F.count_if(is_f).alias("_f"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    offsets = counts.select("path", "block", *[
        F.coalesce(F.sum(c).over(before), zero).alias(f"{c}_before") for c in ("_lines", "_v", "_f")])
    upto = Window.partitionBy("path", "block").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    flag = {"_v": is_v.cast("bigint"), "_f": is_f.cast("bigint")}
    return typed.join(offsets, ["path", "block"]).select(
        "path", "directive", "parts",
        (F.sum(F.lit(1)).over(upto) + F.col("_lines_before")).alias("line"),
        (F.sum(flag["_v"]).over(upto) + F.col("_v_before") - flag["_v"]).alias("seen"),
        (F.sum(flag["_f"]).over(upto) + F.col("_f_before") - flag["_f"]).alias("faces_seen"))


def _corner(token: Column) -> tuple[Column, Column]:
    """Zero-based vertex of a face token, and what is wrong with it."""
    raw = F.substring_index(token, "/", 1)
    number = F.when(raw.rlike(INTEGER), raw.try_cast("bigint"))
    vertex = F.when(number > 0, number - 1).otherwise(F.col("seen") + number)
    defect = (
        F.when(raw == "", "missing vertex index")
        .when(number.isNull(), "face index is not an integer")
        .when(number == 0, "face index zero")
        .when((vertex < 0) | (vertex >= F.col("seen")), "face index out of range"))
    return vertex, defect


def read_obj(spark: SparkSession, paths: list[str] | str) -> ObjFiles:
    """Parse OBJ files: triangles only, defects reported per file, never raised."""
    parsed = cut(parse_lines(read_lines(spark, paths)), "obj-parsed")
    part = F.col("parts")
    vertex_lines = parsed.where(F.col("directive") == "v")
    tokens = [F.try_element_at(part, F.lit(i + 2)) for i in range(3)]
    number = [F.when(t.rlike(NUMBER), t.try_cast("double")) for t in tokens]
    infinite = F.lit(False)
    for token, value in zip(tokens, number):
        infinite = infinite | F.coalesce(token.rlike(NOT_FINITE), F.lit(False)) | F.coalesce(
            F.abs(value) == F.lit(float("inf")), F.lit(False))
    malformed = F.lit(False)
    for token in tokens:
        malformed = malformed | ~(F.coalesce(token.rlike(NUMBER) | token.rlike(NOT_FINITE), F.lit(False)))
    vertex_defect = (
        F.when(F.size(part) < 4, "vertex needs three coordinates")
        .when(malformed, "vertex coordinate is not a number")
        .when(infinite, "vertex coordinate is not finite"))
    vertices = vertex_lines.select(
        F.col("path").alias("mesh_id"), F.col("seen").alias("vid"),
        *[n.alias(a) for n, a in zip(number, "xyz")], "line", vertex_defect.alias("defect"))
    corners = [_corner(F.try_element_at(part, F.lit(i + 2))) for i in range(3)]
    face_defect = F.when(F.size(part) != 4, "face must have three vertices").otherwise(
        F.coalesce(*[defect for _, defect in corners]))
    faces = parsed.where(F.col("directive") == "f").select(
        F.col("path").alias("mesh_id"), F.col("faces_seen").alias("fid"),
        *[v.alias(c) for (v, _), c in zip(corners, "abc")], "line", face_defect.alias("defect"))
    first = F.min_by("defect", "line")
    line = F.min("line")
    defects = (
        vertices.select("mesh_id", "line", "defect").union(faces.select("mesh_id", "line", "defect"))
        .where(F.col("defect").isNotNull()).groupBy("mesh_id")
        .agg(F.concat(F.lit("ObjFormatError: "), first, F.lit(" at line "), line.cast("string")).alias("defect")))
    counted = parsed.groupBy(F.col("path").alias("mesh_id")).agg(
        F.count_if(F.col("directive") == "v").alias("vertices"),
        F.count_if(F.col("directive") == "f").alias("faces"),
        *[F.count_if(F.col("directive").isin(*names)).alias(label) for label, names in COUNTED.items()])
    error = F.coalesce(
        F.col("defect"),
        F.when(F.col("vertices") == 0, "ObjFormatError: no vertex"),
        F.when(F.col("faces") == 0, "ObjFormatError: no triangular face"))
    files = cut(
        counted.join(defects, "mesh_id", "left").withColumn("error", error).drop("defect"), "obj-files")
    sound = files.where(F.col("error").isNull()).select("mesh_id", F.col("vertices").alias("nv"))
    directive = F.col("directive")
    unknown = parsed.where((directive != "") & ~directive.isin(*KNOWN)).groupBy(
        F.col("path").alias("mesh_id"), "directive").agg(F.count(F.lit(1)).alias("n"))
    return ObjFiles(
        MeshSet(
            attach_sized(vertices, sound, "mesh_id", "nv").select("mesh_id", "nv", "vid", "x", "y", "z"),
            attach_sized(faces, sound, "mesh_id", "nv").select("mesh_id", "nv", "fid", "a", "b", "c")),
        files, unknown)


@F.pandas_udf(T.StringType())
def _vertex_text(x: pd.Series, y: pd.Series, z: pd.Series) -> pd.Series:
    return pd.Series([f"v {a:.10f} {b:.10f} {c:.10f}" for a, b, c in zip(x, y, z)])


def obj_lines(meshes: MeshSet) -> DataFrame:
    """mesh_id, section, pos and text of every canonical OBJ line."""
    vertices = meshes.vertices.select(
        "mesh_id", F.lit(0).alias("section"), F.col("vid").alias("pos"),
        _vertex_text("x", "y", "z").alias("text"))
    faces = meshes.faces.select(
        "mesh_id", F.lit(1).alias("section"), F.col("fid").alias("pos"),
        F.concat_ws(" ", F.lit("f"), *[(F.col(c) + 1).cast("string") for c in "abc"]).alias("text"))
    return vertices.unionByName(faces)


def check_writable(meshes: MeshSet) -> None:
    """Reject non-finite vertices and faces that point outside their mesh."""
    finite = F.lit(True)
    for a in "xyz":
        finite = finite & ~F.isnan(a) & (F.abs(a) < F.lit(float("inf")))
    if not meshes.vertices.where(~finite).isEmpty():
        raise ValueError("cannot write non-finite vertices")
    outside = F.least("a", "b", "c") < 0
    outside = outside | (F.greatest("a", "b", "c") >= F.col("nv"))
    if not meshes.faces.where(outside).isEmpty():
        raise ValueError("cannot write faces with out-of-range indices")


def write_obj(meshes: MeshSet, folder: str, checked: bool = False) -> None:
    """One folder per mesh, ``mesh_id=…``, holding its OBJ text.

    Lines are range-partitioned in output order. A mesh within one range is one
    file; a larger one becomes consecutive part files whose concatenation in
    name order is the OBJ, so no mesh has to pass through a single task.
    """
    if not checked:
        check_writable(meshes)
    ordered = obj_lines(meshes).repartitionByRange("mesh_id", "section", "pos").sortWithinPartitions(
        "mesh_id", "section", "pos")
    ordered.select("mesh_id", "text").write.mode("errorifexists").partitionBy("mesh_id").text(
        folder, lineSep="\n")

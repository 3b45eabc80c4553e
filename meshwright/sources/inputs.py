"""Discovering input files from a folder, a file or a manifest."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meshwright.functions.identity import assign_output_keys, casefold, geometry_hashes, nfc
from meshwright.sources.obj import GLOB, ObjFiles, local_path, read_obj
from meshwright.plans.skew import attach_count
from meshwright.session import cut

# Names of a manifest that are handed to the reader one by one.
NAMED_FILES = 100_000
MANIFEST_COLUMNS = ("input_obj", "sample_id", "subject_group", "batch_id")


class InputError(ValueError):
    """The request names no usable set of inputs."""


def _blank_to_null(column: Column) -> Column:
    return F.nullif(F.trim(column), F.lit(""))


def _status(spark: SparkSession, path: str) -> tuple[str, str | None]:
    """The full address of a path in its file system, and "file", "folder" or None."""
    raw = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = raw.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    full = files.makeQualified(raw)
    if not files.exists(full):
        return full.toString(), None
    return full.toString(), "folder" if files.getFileStatus(full).isDirectory() else "file"


def _literal(path: str) -> str:
    """A path that a reader takes as it is, not as a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _files(spark: SparkSession, sources: list[str]) -> DataFrame:
    """OBJ files of files and folders; rows are listings until content is asked for."""
    return spark.read.format("binaryFile").option("pathGlobFilter", GLOB).load([_literal(s) for s in sources])


def empty_files(spark: SparkSession, files: DataFrame) -> DataFrame:
    """(path) of zero-byte files, which are in a reader's listing but give no row."""
    names = files.inputFiles()
    if len(names) == files.select("path").count():
        return spark.createDataFrame([], "path string")
    listed = spark.createDataFrame([(n,) for n in names], "path string").select(local_path(F.col("path")).alias("path"))
    return listed.join(files.select(local_path(F.col("path")).alias("path")), "path", "left_anti")


def listed_path(spark: SparkSession, path: str) -> DataFrame:
    """path, relative_path and empty metadata of the files under a folder."""
    source, kind = _status(spark, path)
    if kind == "file" and not source.lower().endswith(".obj"):
        raise InputError(f"input file is not an OBJ: {source}")
    if kind is None:
        raise InputError(f"input path does not exist: {source}")
    # Only the listing is used: content is not read for a select of path.
    files = _files(spark, [source])
    name = F.element_at(F.split("path", "/"), -1)
    every = files.select(local_path(F.col("path")).alias("path"))
    return every.union(empty_files(spark, files)).select(
        "path", name.alias("relative_path"),
        *[F.lit(None).cast("string").alias(c) for c in MANIFEST_COLUMNS[1:]],
        F.expr("cast(map() as map<string,string>)").alias("user_metadata"))


def listed_manifest(spark: SparkSession, manifest: str) -> DataFrame:
    """The same from a CSV manifest; other columns become user metadata."""
    source, kind = _status(spark, manifest)
    if kind != "file":
        raise InputError(f"input manifest does not exist: {source}")
    rows = spark.read.csv(_literal(source), header=True, encoding="UTF-8", multiLine=True,
                          ignoreLeadingWhiteSpace=False)
    rows = rows.toDF(*[c.removeprefix("\ufeff") for c in rows.columns])
    if "input_obj" not in rows.columns:
        raise InputError("input manifest must contain input_obj")
    extras = [c for c in rows.columns if c not in MANIFEST_COLUMNS]
    pairs = [x for c in extras for x in (F.lit(c), F.col(f"`{c}`"))]
    metadata = F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull()) if extras else F.expr(
        "cast(map() as map<string,string>)")
    optional = [
        (_blank_to_null(F.col(c)) if c in rows.columns else F.lit(None).cast("string")).alias(c)
        for c in MANIFEST_COLUMNS[1:]
    ]
    raw = F.trim(F.coalesce("input_obj", F.lit("")))
    listed = cut(rows.select(raw.alias("relative_path"), *optional, metadata.alias("user_metadata")),
                 "manifest")
    if not listed.where(F.col("relative_path") == "").isEmpty():
        raise InputError("empty input_obj in manifest")
    base = re.sub("^file:(//)?(?=/)", "", source.rsplit("/", 1)[0])
    absolute = F.when(F.col("relative_path").rlike("^(/|[a-z][a-z0-9+.-]*:/)"), F.col("relative_path")).otherwise(
        F.concat(F.lit(base + "/"), F.regexp_replace("relative_path", r"^(\./)+", "")))
    listed = listed.withColumn("path", absolute)
    twice = listed.groupBy(casefold(nfc(F.col("path"))).alias("k")).count().where("count > 1").first()
    if twice is not None:
        raise InputError(f"duplicate input path in manifest: {twice[0]}")
    return listed


def sort_key() -> list[Column]:
    name = nfc(F.element_at(F.split("path", "/"), -1))
    return [casefold(name), name, F.col("geometry_sha256")]


def _named_sources(spark: SparkSession, listed: DataFrame, most: int = NAMED_FILES) -> list[str]:
    """What to read for a manifest: the files it names that exist, or their folders if these are very many.

    Folders are listed, never read. Spark keeps the files that it reads in a list
    on the driver, so up to ``most`` names fit there as well; beyond it the
    folders are read and joined with the names.
    """
    folders = listed.select(F.regexp_replace("path", "/[^/]*$", "").alias("f")).distinct()
    found = [full for full, kind in (_status(spark, r[0]) for r in folders.toLocalIterator()) if kind == "folder"]
    if not found:
        return []
    there = _files(spark, found)
    every = there.select(local_path(F.col("path")).alias("path")).union(empty_files(spark, there))
    names = [r[0] for r in every.join(listed.select("path"), "path", "left_semi").limit(most + 1).collect()]
    return found if len(names) > most or not names else names


def discover(
    spark: SparkSession, input_path: str | None = None, input_manifest: str | None = None
) -> tuple[DataFrame, ObjFiles]:
    """The samples table and the parsed meshes.

    Unreadable and malformed files stay in the table with ``input_error`` and a
    stand-in geometry hash. Files with equal geometry are counted, not removed.
    """
    if (input_path is None) == (input_manifest is None):
        raise InputError("exactly one of input path or input manifest is required")
    if input_path is not None:
        listed = cut(listed_path(spark, input_path), "listed")
        sources = [_status(spark, input_path)[0]]
    else:
        listed = cut(listed_manifest(spark, input_manifest), "listed")
        sources = _named_sources(spark, listed)
    if listed.isEmpty():
        raise InputError("no OBJ files found")
    if not sources:
        raise InputError("no folder of the manifest exists")
    wanted = listed.select("path")
    files = _files(spark, sources)
    content = files.select(
        local_path(F.col("path")).alias("path"), F.sha2("content", 256).alias("source_file_sha256"),
        F.col("length").alias("source_bytes"))
    nothing = hashlib.sha256(b"").hexdigest()
    content = content.union(empty_files(spark, files).select(
        "path", F.lit(nothing), F.lit(0).cast("bigint"))).join(wanted, "path", "left_semi")
    parsed = read_obj(spark, [_literal(s) for s in sources])
    keep = wanted.withColumnRenamed("path", "mesh_id")
    parsed = ObjFiles(
        type(parsed.meshes)(
            parsed.meshes.vertices.join(keep, "mesh_id", "left_semi"),
            parsed.meshes.faces.join(keep, "mesh_id", "left_semi")),
        parsed.files.join(keep, "mesh_id", "left_semi"), parsed.unknown)
    hashes = geometry_hashes(parsed.meshes.vertices, parsed.meshes.faces)
    inventory = [c for c in parsed.files.columns if c not in ("mesh_id", "error")]
    facts = parsed.files.select(
        F.col("mesh_id").alias("path"), "error", F.struct(*inventory).alias("inventory"))
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"(?<=.)\.[^.]*$", "")
    unread = F.sha2(F.concat(F.lit("unreadable:"), nfc(F.col("path"))), 256)
    file_hash = F.coalesce("source_file_sha256", unread)
    # A file without any line yields no parsed row: its content hash is known.
    error = (
        F.when(F.col("source_file_sha256").isNull(), F.concat(F.lit("FileNotFoundError: "), F.col("path")))
        .when(F.col("inventory").isNull(), F.lit("ObjFormatError: no vertex"))
        .otherwise(F.col("error")))
    broken = F.sha2(F.concat(F.lit("invalid-geometry:"), F.col("source_file_sha256")), 256)
    samples = (
        listed.join(content, "path", "left").join(facts, "path", "left")
        .join(hashes.withColumnRenamed("mesh_id", "path"), "path", "left")
        .withColumn("stem", stem)
        .withColumn("input_error", error)
        .withColumn("source_file_sha256", file_hash)
        .withColumn("geometry_sha256", F.coalesce("geometry_sha256", broken))
        .withColumn("sample_id", F.coalesce(_blank_to_null(F.col("sample_id")), F.col("stem")))
        .withColumn("relative_path", nfc(F.col("relative_path"))))
    samples = cut(samples, "samples")
    counted = attach_count(samples, "geometry_sha256", "duplicate_geometry_group_size")
    keyed = assign_output_keys(counted)
    return cut(keyed.drop("error", "stem"), "records"), parsed

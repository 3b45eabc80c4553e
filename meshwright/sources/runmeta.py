"""Recorded runs: sample records, long-form measurements and their sinks."""

from __future__ import annotations

import json
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meshwright.session import cut

# A record's open-ended measurements stay JSON text until they are exploded.
RECORD_SCHEMA = (
    "output_key string, sample_id string, status string, source_file_sha256 string, "
    "geometry_sha256 string, final_obj string, committed_at string, attempt_id string, "
    "commit_state string, fingerprints map<string,string>, hard_failures array<string>, "
    "qc struct<qc_incomplete: boolean>, measurements map<string,string>")
_NUMBER = r"^-?(\d+\.?\d*([eE][+-]?\d+)?)$"
_SPECIAL = ("NaN", "Infinity", "-Infinity")


class RecordError(ValueError):
    """A run folder's records cannot be read."""


def read_records(
    spark: SparkSession, run_dirs: list[str], tolerant: bool = False
) -> DataFrame:
    """Sample records of one or more runs, with run_dir and their file path.

    A record that is not JSON raises, or is skipped if ``tolerant``.
    """
    roots = [str(Path(d).resolve()) for d in run_dirs]
    for root in roots:
        if not (Path(root) / "metadata" / "samples").is_dir():
            raise RecordError(f"run has no sample metadata directory: {root}")
    text = spark.read.option("pathGlobFilter", "*.json").text(
        [f"{root}/metadata/samples" for root in roots], wholetext=True)
    path = F.regexp_replace("_metadata.file_path", "^file:(//)?(?=/)", "")
    loaded = text.select(path.alias("path"), F.col("value"))
    parsed = loaded.select(
        "path", "value",
        F.from_json("value", RECORD_SCHEMA + ", _bad string",
                    {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad",
                     "allowNonNumericNumbers": "true"}).alias("r"))
    parsed = cut(
        parsed.select("path", F.regexp_replace("path", "/metadata/samples/[^/]*$", "").alias("run_dir"), "r.*"),
        "records")
    bad = parsed.where(F.col("_bad").isNotNull() | F.col("measurements").isNull() & F.col("output_key").isNull())
    if not tolerant:
        first = bad.select("path").first()
        if first is not None:
            raise RecordError(f"invalid sample metadata: {first[0]}")
        return parsed.drop("_bad")
    return parsed.where(F.col("_bad").isNull()).drop("_bad")


def record_measurements(records: DataFrame) -> DataFrame:
    """Long-form measurements with typed values."""
    raw = records.select(
        "run_dir", "output_key", "sample_id", "status", F.explode("measurements").alias("metric", "body"))
    fields = F.from_json(
        "body", "value string, unit string, compute_status string, error string",
        {"allowNonNumericNumbers": "true"})
    typed = raw.select("*", fields.alias("m"), F.get_json_object("body", "$.value").alias("token"),
                       F.regexp_extract("body", r'"value"\s*:\s*("|\[|\{)?', 1).alias("opening"))
    value = F.col("m.value")
    kind = (
        F.when(value.isNull(), "null").when(F.col("opening") == '"', "string")
        .when(F.col("opening") == "[", "array").when(F.col("opening") == "{", "object")
        .when(value.isin("true", "false"), "bool").when(value.rlike(r"^-?\d+$"), "long")
        .otherwise("double"))
    number = F.when(value.isin(*_SPECIAL) | value.rlike(_NUMBER), value.try_cast("double"))
    return typed.select(
        "run_dir", "output_key", "sample_id", "status", "metric", kind.alias("value_kind"),
        F.when(kind.isin("long", "double"), number)
        .when(kind == "bool", (value == "true").cast("double")).alias("value_double"),
        F.when(kind == "string", value).alias("value_string"),
        F.when(kind == "array", F.from_json(value, "array<double>")).alias("value_array"),
        F.coalesce("m.unit", F.lit("")).alias("unit"),
        F.coalesce("m.compute_status", F.lit("computed")).alias("compute_status"), "m.error")


def measurement_bodies(measurements: DataFrame) -> DataFrame:
    """(output_key, measurements): each sample's measurements as one JSON object.

    A sample has one value per metric name, so the list is as long as the
    metric catalogue.
    """
    value = (
        F.when(F.col("value_kind") == "string", F.to_json(F.struct(F.col("value_string").alias("v"))))
        .when(F.col("value_kind") == "array", F.to_json(F.struct(F.col("value_array").alias("v"))))
        .when(F.col("value_kind") == "bool", F.to_json(F.struct((F.col("value_double") == 1.0).alias("v"))))
        .when(F.col("value_kind") == "long", F.to_json(F.struct(F.col("value_double").cast("bigint").alias("v"))))
        .when(F.col("value_kind") == "double", F.to_json(F.struct(F.col("value_double").alias("v"))))
        .otherwise(F.lit('{"v":null}')))
    rest = F.to_json(F.struct("unit", "compute_status", "error"), {"ignoreNullFields": "false"})
    body = F.concat(
        F.lit('{"value":'), F.regexp_extract(value, r"^\{\"v\":(.*)\}$", 1), F.lit(","),
        F.substring(rest, 2, 1 << 30))
    entry = F.concat(F.to_json(F.array("metric")).substr(F.lit(2), F.length(F.to_json(F.array("metric"))) - 2),
                     F.lit(":"), body)
    return measurements.select("output_key", "metric", entry.alias("entry")).groupBy("output_key").agg(
        F.concat(F.lit("{"), F.concat_ws(",", F.array_sort(F.collect_list("entry"))), F.lit("}")).alias("measurements"))


def write_csv(rows: DataFrame, folder: str) -> None:
    """CSV with columns in alphabetical order; no rows make an empty file."""
    ordered = rows.select(*sorted(rows.columns))
    empty = ordered.isEmpty()
    ordered.write.mode("errorifexists").csv(folder, header=not empty, lineSep="\n")


def fresh_output(path: str) -> Path:
    """A new or empty folder."""
    folder = Path(path).resolve()
    if folder.exists() and any(folder.iterdir()):
        raise RecordError(f"output directory must be new or empty: {folder}")
    folder.mkdir(parents=True, exist_ok=True)
    return folder


def write_json(path: Path, payload: dict) -> None:
    """A small control file, complete or absent."""
    path.parent.mkdir(parents=True, exist_ok=True)
    staged = path.with_name(f".{path.name}.tmp")
    staged.write_text(
        json.dumps(payload, ensure_ascii=False, indent=2, sort_keys=True, default=str) + "\n", encoding="utf-8")
    staged.replace(path)


@F.pandas_udf(T.StringType())
def short_number(value: pd.Series) -> pd.Series:
    """Twelve significant digits without trailing zeros."""
    return value.map(lambda v: None if v is None else f"{v:.12g}")


def landmark_rows(landmarks: DataFrame) -> DataFrame:
    """mesh_id, idx, name, x, y, z with coordinates as text."""
    return landmarks.select("mesh_id", "idx", "name", *[short_number(a).alias(a) for a in "xyz"])


def write_landmark_csv(landmarks: DataFrame, folder: str) -> None:
    """One CSV of name,x,y,z per mesh under ``mesh_id=…``."""
    rows = landmark_rows(landmarks).repartition("mesh_id").sortWithinPartitions("mesh_id", "idx")
    rows.drop("idx").write.mode("errorifexists").partitionBy("mesh_id").csv(folder, header=True, lineSep="\n")


def picked_points(landmarks: DataFrame, source: str = "mesh_id") -> DataFrame:
    """(mesh_id, document): picked-point XML, a few dozen points per mesh."""
    def escaped(column):
        text = F.col(column).cast("string")
        for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
            text = F.replace(text, F.lit(raw), F.lit(entity))
        return text

    point = F.format_string(
        ' <point name="%s" x="%s" y="%s" z="%s" active="1" />', escaped("name"), "x", "y", "z")
    lines = landmark_rows(landmarks).select("mesh_id", F.struct("idx", point.alias("line")).alias("p"))
    return lines.groupBy("mesh_id").agg(F.array_sort(F.collect_list("p")).alias("p")).select(
        "mesh_id",
        F.concat_ws(
            "\n", F.lit("<?xml version='1.0' encoding='utf-8'?>"), F.lit("<PickedPoints>"), F.lit(" <DocumentData>"),
            F.format_string('  <DataFileName name="%s" />', escaped(source)), F.lit(" </DocumentData>"),
            F.transform("p", lambda e: e["line"]), F.lit("</PickedPoints>")).alias("document"))

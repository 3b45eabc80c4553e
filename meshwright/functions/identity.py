"""Names, keys, seeds and hashes of samples."""

from __future__ import annotations

import hashlib
import struct
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meshwright.plans.skew import attach_count

# The namespace of collision keys and the characters that may not
# appear in a key.
KEY_NAMESPACE = "5c32e6659f415f9f8424aa33ad97f171"
UNSAFE = r'[<>:"/\\|?*\x00-\x1f]+'
# First bytes of every geometry digest. Pass another tag to reproduce digests
# that were recorded under it.
GEOMETRY_TAG = b"meshwright-geometry-v1\0"


@F.pandas_udf(T.StringType())
def _nfc(text: pd.Series) -> pd.Series:
    return text.map(lambda s: None if s is None else unicodedata.normalize("NFC", s))


@F.pandas_udf(T.StringType())
def _casefold(text: pd.Series) -> pd.Series:
    return text.map(lambda s: None if s is None else s.casefold())


def _only_non_ascii(text: Column, convert, plain: Column) -> Column:
    """Python sees only values that need it; plain ASCII stays in the JVM."""
    ascii_only = text.rlike(r"^[\x00-\x7F]*$")
    return F.coalesce(F.when(ascii_only, plain), convert(F.when(~ascii_only, text)), text)


def nfc(text: Column) -> Column:
    return _only_non_ascii(text, _nfc, text)


def casefold(text: Column) -> Column:
    return _only_non_ascii(text, _casefold, F.lower(text))


def sanitize_stem(stem: Column) -> Column:
    """A file stem made safe as a key; ``sample`` if nothing is left."""
    cleaned = F.regexp_replace(nfc(stem), UNSAFE, "_")
    cleaned = F.regexp_replace(cleaned, "_+", "_")
    cleaned = F.regexp_replace(cleaned, r"^[ ._]+|[ ._]+$", "")
    return F.when(cleaned == "", "sample").otherwise(cleaned)


def uuid5(namespace_hex: str, name: Column) -> Column:
    """Version-5 UUID text of a name."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace_hex)), F.encode(name, "UTF-8")))
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws(
        "-", F.substring(digest, 1, 8), F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)), F.substring(digest, 21, 12))


def assign_output_keys(records: DataFrame) -> DataFrame:
    """Add ``output_key`` from stem, relative_path and geometry_sha256.

    Stems that collide without regard to case get a suffix. A name that a third
    of all files share is counted without gathering its files.
    """
    named = records.withColumn("_stem", sanitize_stem(F.col("stem"))).withColumn(
        "_fold", casefold(F.col("_stem")))
    counted = attach_count(named, "_fold", "_same")
    identity = F.concat(nfc(F.col("relative_path")), F.lit("|"), F.col("geometry_sha256"))
    suffixed = F.concat(F.col("_stem"), F.lit("__"), uuid5(KEY_NAMESPACE, identity))
    return counted.withColumn(
        "output_key", F.when(F.col("_same") == 1, F.col("_stem")).otherwise(suffixed)
    ).drop("_stem", "_fold", "_same")


def stage_seed(geometry_hash: Column, stage: str, base_seed: int) -> Column:
    """First eight digest bytes, little-endian unsigned, as DECIMAL(20,0)."""
    digest = F.sha2(F.concat(geometry_hash, F.lit(f":{stage}:{int(base_seed)}")), 256)
    pairs = [F.substring(digest, start, 2) for start in range(15, 0, -2)]
    return F.conv(F.concat(*pairs), 16, 10).cast("decimal(20,0)")


def _hash_rows(batches: Iterator[pd.DataFrame], tag: bytes) -> Iterator[pd.DataFrame]:
    """Stream rows sorted by mesh, kind and position through one digest per mesh."""
    current, digest, kind = None, None, None
    finished: list[tuple] = []
    for batch in batches:
        for (mesh, part), rows in batch.groupby(["mesh_id", "kind"], sort=False):
            if mesh != current:
                if digest is not None:
                    finished.append((current, digest.hexdigest()))
                current, digest, kind = mesh, hashlib.sha256(tag), None
            if part != kind:
                digest.update(struct.pack("<QQ", int(rows["size"].iloc[0]), 3))
                kind = part
            if part == 0:
                points = rows[["x", "y", "z"]].to_numpy(dtype="<f8") + 0.0
                digest.update(points.tobytes(order="C"))
            else:
                digest.update(rows[["a", "b", "c"]].to_numpy(dtype="<i8").tobytes(order="C"))
        if finished:
            yield pd.DataFrame(finished, columns=["mesh_id", "geometry_sha256"])
            finished = []
    if digest is not None:
        yield pd.DataFrame([(current, digest.hexdigest())], columns=["mesh_id", "geometry_sha256"])


def geometry_hashes(
    vertices: DataFrame, faces: DataFrame, tag: bytes = GEOMETRY_TAG
) -> DataFrame:
    """(mesh_id, geometry_sha256) over the ordered vertices and faces.

    The digest of one mesh is sequential by definition, so its rows meet in one
    task; they stream through it in Arrow batches and are never held together.
    """
    sizes = faces.groupBy("mesh_id").agg(F.count(F.lit(1)).alias("size"))
    no_face = [F.lit(0).cast("bigint").alias(c) for c in "abc"]
    no_point = [F.lit(0.0).alias(c) for c in "xyz"]
    points = vertices.select(
        "mesh_id", F.lit(0).alias("kind"), F.col("vid").alias("pos"), F.col("nv").alias("size"),
        "x", "y", "z", *no_face)
    corners = faces.select("mesh_id", F.col("fid").alias("pos"), "a", "b", "c").join(
        sizes, "mesh_id").select(
        "mesh_id", F.lit(1).alias("kind"), "pos", "size", *no_point, "a", "b", "c")
    ordered = points.unionByName(corners).repartition("mesh_id").sortWithinPartitions(
        "mesh_id", "kind", "pos")
    schema = T.StructType([
        T.StructField("mesh_id", vertices.schema["mesh_id"].dataType),
        T.StructField("geometry_sha256", T.StringType())])
    return ordered.mapInPandas(lambda batches: _hash_rows(batches, tag), schema)

"""Small template assets: landmark tables, projection weights, mirror tables."""

from __future__ import annotations

import csv
import xml.etree.ElementTree as ElementTree
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshwright.operators.landmarks import NAMES


def template_landmarks(spark: SparkSession, path: str | Path) -> DataFrame:
    """(idx, name, x, y, z) of the nine template landmarks, in canonical order."""
    with Path(path).open(encoding="utf-8-sig", newline="") as handle:
        rows = list(csv.reader(handle))
    if not rows or rows[0] != ["name", "x", "y", "z"]:
        raise ValueError("landmark table header must be name,x,y,z")
    if [row[0] for row in rows[1:]] != list(NAMES):
        raise ValueError("landmark table must list the nine landmarks in canonical order")
    data = [(n, row[0], *map(float, row[1:4])) for n, row in enumerate(rows[1:])]
    return spark.createDataFrame(data, "idx int, name string, x double, y double, z double")


def projection_table(spark: SparkSession, weights: str | Path, names: str | Path) -> DataFrame:
    """(idx, name, fid, l1, l2, l3) from a headerless weight table and a name list."""
    with Path(weights).open(encoding="utf-8-sig", newline="") as handle:
        rows = [row for row in csv.reader(handle) if any(cell.strip() for cell in row)]
    if any(len(row) != 4 for row in rows):
        raise ValueError("weight rows need a face and three weights")
    points = ElementTree.parse(names).getroot().iter("point")
    titles = [p.get("name", "").strip() for p in points if p.get("name", "").strip()]
    if len(titles) != len(rows):
        raise ValueError(f"{len(titles)} names for {len(rows)} weight rows")
    data = [
        (n, title, int(float(row[0])), *map(float, row[1:]))
        for n, (title, row) in enumerate(zip(titles, rows))]
    return spark.createDataFrame(
        data, "idx int, name string, fid bigint, l1 double, l2 double, l3 double")


def mirror_table(spark: SparkSession, path: str | Path, vertices: int) -> DataFrame:
    """(vid, ref) from a text column of indices, one- or zero-based."""
    refs = [int(float(cell)) for cell in Path(path).read_text(encoding="utf-8").split()]
    if len(refs) != vertices:
        raise ValueError(f"mirror table has {len(refs)} entries for {vertices} vertices")
    if refs and min(refs) == 1 and max(refs) == len(refs):
        refs = [r - 1 for r in refs]
    if refs and not (min(refs) >= 0 and max(refs) < len(refs)):
        raise ValueError("mirror table index is out of range")
    return spark.createDataFrame(list(enumerate(refs)), "vid bigint, ref bigint")


def template_points(spark: SparkSession, path: str | Path) -> DataFrame:
    """(vid, x, y, z) from a text matrix with three numbers per line."""
    lines = spark.read.text(str(path), wholetext=False).where(F.trim("value") != "")
    parts = F.split(F.trim("value"), r"[\s,]+")
    typed = lines.coalesce(1).select(
        F.monotonically_increasing_id().alias("vid"),
        *[F.try_element_at(parts, F.lit(i + 1)).cast("double").alias(a) for i, a in enumerate("xyz")])
    return typed

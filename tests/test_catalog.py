"""Registered queries against their SQL at the smallest scale, and skew helpers."""

import math
import re
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from meshwright.plans import skew
from tools.compare import rows_of

# Queries that take long at any scale are covered by tools/compare.py.
QUICK = [
    "mesh_edge_metrics", "mesh_vertex_normals", "mesh_components", "mesh_quality_verdict", "qc_rule_results",
    "qc_calibration", "crop_metrics", "landmark_topk_mean", "procrustes_recover", "symmetrize",
    "barycentric_landmarks", "output_keys", "resume_pending", "privacy_scan_documents", "stage_seeds",
]


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_its_sql(spark, sf_dir, duck, name):
    frame = entry.queries()[name](spark, sf_dir)
    result = duck.execute(entry.oracle_sql()[name])
    want = rows_of([c[0] for c in result.description], result.fetchall())
    assert rows_of(frame.columns, [tuple(r) for r in frame.collect()]) == want


def test_entry_and_registration(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert all(re.fullmatch(r"[a-z][a-z0-9_]+", n) for n in entry.queries())


def test_counts_of_hot_keys(spark):
    rows = spark.range(90).select(F.when(F.col("id") < 60, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 10)).alias("k"))
    got = {r["k"]: r["n"] for r in skew.attach_count(rows, "k", "n", hot_rows=20).collect()}
    assert got == {"hot": 60} | {f"k{i}": 3 for i in range(10)}


def test_salted_lookup_keeps_every_row(spark):
    rows = spark.range(100).select((F.col("id") % 2).alias("mesh_id"), F.lit(50).alias("nv"), F.col("id").alias("vid"))
    one = spark.createDataFrame([(0, 50, "a"), (1, 50, "b")], "mesh_id bigint, nv int, tag string")
    got = skew.attach(rows, one, ["mesh_id", "nv"], rows_per_salt=7)
    assert {(r["vid"], r["tag"]) for r in got.collect()} == {(v, "ab"[v % 2]) for v in range(100)}
    assert math.isclose(got.count(), 100)


def test_obj_roundtrip_writes_files_by_rows_not_by_meshes(spark, tmp_path):
    from datetime import datetime
    from pathlib import Path

    from __spark_entry__ import queries
    from meshwright.session import scratch_root

    rows = [(k, k % 200, datetime(2024, 1, 1, k % 24, k % 60), "view", k / 7) for k in range(1000)]
    spark.createDataFrame(rows, "event_id bigint, user_id bigint, ts timestamp, event_type string, value double").write.parquet(
        str(tmp_path / "events.parquet"))
    kept = Path(scratch_root(spark))
    before = set(kept.rglob("obj-*/**/part-*"))
    found = {r["mesh_id"]: r for r in queries()["obj_roundtrip"](spark, str(tmp_path)).collect()}
    assert len({p.parent for p in set(kept.rglob("obj-*/**/part-*")) - before if "obj-lines" not in str(p)}) == 1
    assert len(found) == 200 and all((r["vertices"], r["faces"]) == (5, 3) for r in found.values())
    assert all(abs(r["checksum"] - sum(v * (k + 200 * v) / 7 for v in range(5))) < 1e-3 for k, r in found.items())

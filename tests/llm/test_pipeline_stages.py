"""The corpus pipeline stage by stage, and its registration."""

import __spark_entry__ as entry
import corpus_pipeline
from meshwright.session import cut


def test_stages_in_order_keep_what_they_should(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        after = cut(stage(spark, docs, sf_dir), name)
        kept = {r["doc_id"]: r["text"] for r in after.collect()}
        assert set(kept) <= set(before) and after.count() == len(kept)
        if name in ("line_dedup", "byte_pairs"):
            assert set(kept) == set(before)
        else:
            assert all(kept[k] == before[k] for k in kept) and len(kept) < len(before)
        if name != "byte_pairs":
            assert after.columns == docs.columns
        docs, before = after, kept
    assert all(r["round_trip"] and len(r["ids"]) == r["n_tokens"] for r in docs.collect())
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    # 87 labels teach a little less than all: most of the bad ones are gone.
    assert sum(labels.get(k) == 0 for k in before) <= 0.2 * sum(q == 0 for q in labels.values())


def test_registration():
    names = entry.queries()
    assert "pipeline" in names and {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in names if x.startswith("op") and x[2].isdigit()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "byte_pairs"]


def test_clashing_columns_pass(spark, sf_dir):
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumns(
        {"n_words": F.lit("mine"), "kept": F.lit(None).cast("int"), "class_id": F.lit(1.5), "ids": F.lit("x")})
    for _, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, sf_dir), "clash")
        assert {r[0] for r in docs.select("n_words").distinct().collect()} == {"mine"}
    assert docs.select("ids").distinct().collect()[0][0] == "x"


def test_pipeline_on_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, sf_dir), "none")
    assert docs.count() == 0

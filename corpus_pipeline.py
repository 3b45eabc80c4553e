"""The corpus pipeline: from raw documents to token ids.

Quality rules drop documents, line dedup takes repeated chunks of lines out of
the rest, near-duplicate detection keeps one document of each class,
decontamination drops documents that hold benchmark text, and the last stage
encodes what is left. Each stage reads what its predecessor kept; stages in
between return the columns of ``documents``, whatever they are named.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshwright.llm import byte_pairs, decontaminate, line_chunks, near_duplicates, quality_rules
from meshwright.llm.common import table
from meshwright.session import cut

KEY, TEXT = "doc_id", "text"
BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _guarded(docs: DataFrame, work: Callable[[DataFrame], DataFrame], extra: tuple[str, ...] = ()) -> DataFrame:
    """``work`` on ``docs`` with all other columns under names that no operator uses, then under their own again."""
    inner = {c: c if c in (KEY, TEXT) else f"__kept_{k}" for k, c in enumerate(docs.columns)}
    done = work(docs.select(*[F.col(f"`{c}`").alias(a) for c, a in inner.items()]))
    names = {c.lower() for c in docs.columns}
    return done.select(*[F.col(a).alias(c) for c, a in inner.items()], *[c for c in extra if c.lower() not in names])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the base rule or the learned rules reject."""
    rules = quality_rules.learn_rules(quality_rules.label_statistics(docs, table(spark, sf_dir, "labels")))
    return _guarded(docs, lambda d: quality_rules.apply_rules(quality_rules.text_statistics(d), rules).where("kept"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated chunks of lines; n_chars follows the text."""
    kept = _guarded(docs, line_chunks.drop_repeated_chunks)
    return kept.withColumn("n_chars", F.char_length(TEXT).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return _guarded(docs, near_duplicates.keep_one)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without contaminated documents."""
    benchmark = table(spark, sf_dir, "benchmark")
    return _guarded(docs, lambda d: decontaminate.decontaminate(d, benchmark).where("not contaminated"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With token ids, their number, and whether they decode to the text again."""
    def work(d: DataFrame) -> DataFrame:
        coded = byte_pairs.encode(d, BYTE_RANKS, public_tokenizers.PATTERN, decoded="decoded")
        same = F.col("decoded") == F.coalesce(F.col(TEXT), F.lit("")).cast("binary")
        return coded.withColumn("n_tokens", F.size("ids").cast("bigint")).withColumn("round_trip", same)

    return _guarded(docs, work, ("n_tokens", "ids", "round_trip"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", without_benchmark),
    ("byte_pairs", encode),
]

# Learned rules, sampling and merges by rank have no SQL; the tests hold each stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

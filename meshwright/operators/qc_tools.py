"""Summaries, re-evaluation, calibration and blinded sampling of recorded runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshwright.operators.qc_rules import RuleSet, sample_status
from meshwright.plans.ranking import exact_quantiles, global_position

DISTRIBUTION = {"p01": 0.01, "p05": 0.05, "median": 0.5, "p95": 0.95, "p99": 0.99}


def scalar_measurements(measurements: DataFrame) -> DataFrame:
    """Measurements with a single value of any status; lists and nulls drop out."""
    return measurements.where(F.col("value_kind").isin("double", "long", "bool", "string"))


def numeric_measurements(measurements: DataFrame) -> DataFrame:
    """Computed numbers; a boolean is not a number here."""
    return measurements.where(
        (F.col("compute_status") == "computed") & F.col("value_kind").isin("double", "long")
    )


def status_counts(samples: DataFrame) -> DataFrame:
    """Samples per status, unknown where none is recorded."""
    return samples.groupBy(F.coalesce("status", F.lit("unknown")).alias("status")).agg(
        F.count(F.lit(1)).alias("samples")
    )


def run_counts(samples: DataFrame) -> DataFrame:
    """All samples, and those in each of the three known statuses."""
    return samples.agg(
        F.count(F.lit(1)).alias("sample_count"),
        *[F.count_if(F.col("status") == s).alias(s) for s in ("passed", "warning", "failed")],
    )


def metric_distributions(measurements: DataFrame, largest: int | None = None) -> DataFrame:
    """Exact distribution of every (metric, unit)."""
    numbers = numeric_measurements(measurements).select(
        "metric", F.coalesce("unit", F.lit("")).alias("unit"), "value_double"
    )
    ends = [
        F.count(F.lit(1)).alias("n"),
        F.min("value_double").alias("min"),
        F.max("value_double").alias("max"),
    ]
    return exact_quantiles(
        numbers, ["metric", "unit"], "value_double", DISTRIBUTION, largest=largest, also=ends
    )


def confusion(predictions: DataFrame) -> DataFrame:
    """Counts and rates from (label, qc_status) rows; a rate without cases is null."""
    wrong = F.col("label") == "unacceptable"
    flagged = F.col("qc_status").isin("warning", "failed")
    known = predictions.where(F.col("label").isin("acceptable", "unacceptable"))
    counts = known.agg(
        F.count(F.lit(1)).alias("evaluable_count"),
        F.count_if(flagged & wrong).alias("true_positive"),
        F.count_if(flagged & ~wrong).alias("false_positive"),
        F.count_if(~flagged & ~wrong).alias("true_negative"),
        F.count_if(~flagged & wrong).alias("false_negative"),
    )
    c = F.col
    return counts.select(
        "*",
        F.try_divide(c("true_positive"), c("true_positive") + c("false_negative")).alias(
            "unacceptable_detection_rate"),
        F.try_divide(c("false_positive"), c("false_positive") + c("true_negative")).alias(
            "acceptable_warning_rate"),
    )


def labeled_predictions(
    measurements: DataFrame, labels: DataFrame, ruleset: RuleSet, samples: DataFrame | None = None
) -> DataFrame:
    """Verdict at the enhanced level next to each reviewed sample's label."""
    known = labels.where(F.col("label").isin("acceptable", "unacceptable"))
    verdicts = sample_status(measurements, ruleset, "enhanced", samples)
    keys = [c for c in ("run_dir", "output_key") if c in verdicts.columns]
    shared = [c for c in keys if c in known.columns]
    return verdicts.join(known.select(*shared, "label"), shared).select(
        *keys, "label", F.col("status").alias("qc_status"),
        F.col("status").isin("warning", "failed").alias("predicted_abnormal"),
    )


def clean_labels(rows: DataFrame) -> tuple[str, DataFrame]:
    """Pick the key and label columns of a review table and check the keys."""
    label = next((c for c in ("consensus_label", "label") if c in rows.columns), None)
    key = next((c for c in ("output_key", "sample_id") if c in rows.columns), None)
    if label is None or key is None:
        raise ValueError("labels need output_key or sample_id plus label or consensus_label")
    chosen = rows.select(
        F.trim(F.coalesce(key, F.lit(""))).alias(key),
        F.lower(F.trim(F.coalesce(label, F.lit("")))).alias("label"),
    ).where(F.col(key) != "")
    repeated = chosen.groupBy(key).count().where("count > 1").select(key).first()
    if repeated is not None:
        raise ValueError(f"duplicate label key: {repeated[0]}")
    return key, chosen


def seeded_sample(records: DataFrame, order: list[str], target: int, seed: int) -> DataFrame:
    """The first ``target`` records in the order of a seeded hash of their key columns ``order``.

    A distributed top-k: no task sees more than its own records and ``target`` others.
    """
    digest = F.sha2(F.concat_ws("|", F.lit(f"{int(seed)}:"), *[F.col(c).cast("string") for c in order]), 256)
    return records.orderBy(digest, *order).limit(max(0, int(target)))


def blinded_order(samples: DataFrame, seed: int, limit: int | None = None) -> DataFrame:
    """Samples in a seeded hash order with blind ids B00001, B00002, …

    With a limit, ``orderBy().limit`` is a distributed top-k and only the listed
    samples are numbered; without one, a range-partitioned sort numbers all.
    """
    digest = F.sha2(F.concat(F.lit(f"{int(seed)}:"), F.col("output_key")), 256)
    if limit is None:
        placed = global_position(samples.select("output_key", digest.alias("digest")), ["digest", "output_key"], "position")
        return placed.select(F.format_string("B%05d", F.col("position") + 1).alias("blind_id"), "output_key")
    top = (
        samples.select("output_key", digest.alias("digest"))
        .orderBy("digest", "output_key").limit(max(0, int(limit)))
    )
    from pyspark.sql import Window

    number = F.row_number().over(Window.orderBy("digest", "output_key"))
    return top.select(
        F.format_string("B%05d", number).alias("blind_id"), "output_key"
    )

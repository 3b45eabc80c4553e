"""Which samples of a run still have to be processed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshwright.plans.skew import attach_count

FINGERPRINTS = ("input_set", "scientific", "execution")


class ResumeError(ValueError):
    """Recorded fingerprints differ from the current run's."""


def current_attempts(attempts: DataFrame) -> DataFrame:
    """The latest committed attempt per sample.

    Attempts are never rewritten. A grouped maximum carries the current one
    map-side, so a sample with very many attempts is not gathered and there is
    one row per sample even where time and attempt are tied: then the other
    columns decide, in their order.
    """
    first = ["committed_at", "attempt_id"]
    rest = [c for c in attempts.columns if c not in ("output_key", *first)]
    # Maps have no order of their own; their text has.
    text = lambda c: F.when(F.col(f"`{c}`").isNotNull(), F.to_json(F.struct(f"`{c}`")))
    order = [text(c) if "map<" in attempts.schema[c].dataType.simpleString() else F.col(f"`{c}`") for c in rest]
    every = F.struct(*first, *[F.col(f"`{c}`") for c in rest])
    latest = attempts.groupBy("output_key").agg(F.max_by(every, F.struct(*first, *order)).alias("_n"))
    return latest.select(*[c if c == "output_key" else F.col(f"_n.`{c}`").alias(c) for c in attempts.columns])


def classify(inputs: DataFrame, recorded: DataFrame, retry_failed: bool = False) -> DataFrame:
    """(output_key, action): pending, retry, skip or mismatch for each input.

    ``recorded`` has output_key, commit_state, status and ``same_fingerprints``.
    """
    action = (
        F.when(F.col("_known").isNull(), "pending")
        .when(~F.coalesce("same_fingerprints", F.lit(False)), "mismatch")
        .when(F.coalesce("commit_state", F.lit("")) != "complete", "retry")
        .when((F.col("status") == "failed") & F.lit(retry_failed), "retry")
        .otherwise("skip"))
    known = recorded.select(
        "output_key", "commit_state", "status", "same_fingerprints", F.lit(True).alias("_known"))
    return inputs.select("output_key").join(known, "output_key", "left").select(
        "output_key", action.alias("action"))


def pending(inputs: DataFrame, recorded: DataFrame, retry_failed: bool = False) -> DataFrame:
    """Inputs to process; raises if a recorded sample belongs to another run."""
    actions = classify(inputs, recorded, retry_failed)
    wrong = actions.where(F.col("action") == "mismatch").select("output_key").first()
    if wrong is not None:
        raise ResumeError(f"resume fingerprint mismatch for sample {wrong[0]}")
    return inputs.join(actions.where(F.col("action") != "skip"), "output_key", "left_semi")


def summary_rows(records: DataFrame) -> DataFrame:
    """The eight columns of a run's sample list."""
    return records.select(
        "output_key", "sample_id", "status", "source_file_sha256", "geometry_sha256", "final_obj",
        "qc_incomplete", "committed_at")


def duplicate_sizes(records: DataFrame, column: str) -> DataFrame:
    """Rows of each value's group; one value may own a third of all rows."""
    return attach_count(records, column, "group_size")

"""The declarative quality-rule engine over long-form measurements."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The metric groups, hard contracts and telemetry groups that
# rule files and records refer to by name.
EMPIRICAL_GROUPS = (
    "input.edge_length", "input.degenerate_faces", "input.duplicate_geometry",
    "input.connected_components", "input.topology", "input.extent_density",
    "input.normal_consistency", "crop.retention", "crop.probability", "crop.spatial_structure",
    "crop.postprocess_delta", "landmark.prediction", "landmark.heatmap", "landmark.snap",
    "landmark.anatomy", "landmark.midline_symmetry", "landmark.crop_boundary",
    "registration.surface_residual", "registration.convergence", "registration.deformation",
    "gpa.transform", "final.geometry", "crop.stability", "landmark.stability",
)
HARD_CONTRACTS = (
    "contract.obj_readable", "contract.triangular_faces", "contract.finite_geometry",
    "contract.nonempty_geometry", "contract.artifact_integrity", "contract.crop_nonempty",
    "contract.landmarks_complete", "contract.landmarks_finite",
    "contract.landmarks_snapped_on_mesh", "contract.landmark_alignment",
    "contract.template_topology", "contract.final_geometry",
)
TELEMETRY_GROUPS = (
    "telemetry.stage_seconds", "telemetry.peak_rss", "telemetry.device", "telemetry.io",
)
OPERATORS = ("equals", "gt", "gte", "lt", "lte", "inside", "outside")
MODES = ("record_only", "warning", "disabled")
LEVELS = ("standard", "enhanced")
GLOBAL_ERROR_STATUSES = ("error", "computation_error", "not_computed")


@dataclass(frozen=True)
class Rule:
    rule_id: str
    metric: str
    operator: str
    threshold: Any
    unit: str
    severity: str = "warning"
    minimum_qc_level: str = "standard"


@dataclass(frozen=True)
class RuleSet:
    profile_id: str
    profile_version: str
    metric_groups: dict[str, str] = field(default_factory=dict)
    rules: tuple[Rule, ...] = ()


def metric_group(metric: str) -> str | None:
    """The longest group name that is the metric or a dotted prefix of it."""
    parts = metric.split(".")
    for count in range(len(parts), 0, -1):
        if (name := ".".join(parts[:count])) in EMPIRICAL_GROUPS:
            return name
    return None


def metric_group_column(metric: Column) -> Column:
    """The same mapping as a column: try prefixes from long to short."""
    groups = F.array(*[F.lit(g) for g in EMPIRICAL_GROUPS])
    deepest = max(g.count(".") for g in EMPIRICAL_GROUPS) + 1
    prefixes = [F.substring_index(metric, ".", n) for n in range(deepest, 0, -1)]
    return F.coalesce(*[F.when(F.array_contains(groups, p), p) for p in prefixes])


def active_rules(ruleset: RuleSet, level: str) -> list[tuple[int, Rule, str]]:
    """(position, rule, mode) of the rules that produce a result at this level."""
    if level not in LEVELS:
        raise ValueError(f"invalid QC level: {level}")
    kept = []
    for position, rule in enumerate(ruleset.rules):
        mode = ruleset.metric_groups.get(metric_group(rule.metric) or "", "record_only")
        if mode == "disabled" or (rule.minimum_qc_level == "enhanced" and level != "enhanced"):
            continue
        kept.append((position, rule, mode))
    return kept


def _text(value: Any) -> Column:
    return F.lit(None if value is None else str(value)).cast("string")


def _number(value: Any) -> Column:
    return F.lit(None if value is None else float(value)).cast("double")


def _as_number(value: Any) -> float | None:
    """The number a threshold compares as; None where it has none."""
    try:
        return float(value)
    except (TypeError, ValueError):
        return None


def _rule_literal(position: int, rule: Rule, mode: str) -> Column:
    pair = isinstance(rule.threshold, (list, tuple))
    low = rule.threshold[0] if pair and len(rule.threshold) == 2 else None
    high = rule.threshold[1] if pair and len(rule.threshold) == 2 else None
    severity = "record_only" if mode == "record_only" else rule.severity
    if rule.minimum_qc_level == "enhanced" and severity != "record_only":
        severity = "warning"
    exact = rule.threshold if isinstance(rule.threshold, str) else None
    numeric = None if pair else _as_number(rule.threshold)
    items = [float(v) for v in rule.threshold] if pair else None
    array = F.array(*[F.lit(v) for v in items]) if items else F.lit(None)
    return F.struct(
        F.lit(position).alias("rule_ord"),
        F.lit(rule.rule_id).alias("rule_id"),
        F.lit(rule.metric).alias("metric"),
        F.lit(rule.operator).alias("operator"),
        _number(numeric).alias("t_num"),
        _number(low).alias("t_lo"),
        _number(high).alias("t_hi"),
        _text(exact).alias("t_string"),
        array.cast("array<double>").alias("t_array"),
        F.lit(rule.unit).alias("unit"),
        F.lit(severity).alias("severity"),
    )


_DIGITS = r"\d+(_\d+)*"
NUMBER = rf"(?i)^[+-]?(({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})(e[+-]?{_DIGITS})?|inf|infinity|nan)$"


def sample_keys(rows: DataFrame) -> list[str]:
    """What names a sample: its output key, within its run where several runs are read."""
    return [c for c in ("run_dir", "output_key") if c in rows.columns]


def _coerced(m: Column) -> Column:
    """A measurement's value as a number: numbers, booleans and numeric text."""
    # Digits may be grouped by single underscores; suffixes and hexadecimal are not numbers.
    text = F.trim(m["value_string"])
    plain = F.when(text.rlike(NUMBER), F.regexp_replace(text, "_", ""))
    numeric_text = plain.try_cast("double")
    return F.when(m["value_kind"].isin("double", "long", "bool"), m["value_double"]).when(
        m["value_kind"] == "string", numeric_text
    )


def _matched(rule: Column, m: Column) -> Column:
    """Whether the trigger condition holds. NaN compares false, so it is outside."""
    value = _coerced(m)
    real = ~F.isnan(value)
    operator = rule["operator"]
    inside = real & (value >= rule["t_lo"]) & (value <= rule["t_hi"])
    equal = (
        F.when(m["value_kind"] == "string", F.coalesce(m["value_string"] == rule["t_string"], F.lit(False)))
        .when(m["value_kind"] == "array", F.coalesce(m["value_array"] == rule["t_array"], F.lit(False)))
        .when(m["value_kind"].isin("double", "long", "bool") & rule["t_string"].isNull(),
              F.coalesce(real & (value == rule["t_num"]), F.lit(False)))
        .otherwise(F.lit(False))
    )
    return (
        F.when(operator == "equals", equal)
        .when(operator == "gt", real & (value > rule["t_num"]))
        .when(operator == "gte", real & (value >= rule["t_num"]))
        .when(operator == "lt", real & (value < rule["t_num"]))
        .when(operator == "lte", real & (value <= rule["t_num"]))
        .when(operator == "inside", inside)
        .when(operator == "outside", ~inside)
    )


def _unmatched_reason(m: Column) -> Column:
    argument = "rule evaluation error: float() argument must be a string or a real number, not "
    return (
        F.when(m["value_kind"] == "array", F.lit(argument + "'list'"))
        .when(m["value_kind"] == "string",
              F.concat(F.lit("rule evaluation error: could not convert string to float: '"),
                       m["value_string"], F.lit("'")))
        .otherwise(F.lit(argument + "'NoneType'"))
    )


def per_sample(
    measurements: DataFrame, wanted: list[str], samples: DataFrame | None = None
) -> DataFrame:
    """One row per sample: its ruled measurements as a map, and the error scan.

    A sample's measurements are a map from metric to value, so what is gathered
    is bounded by the rule file's metrics. ``samples`` adds samples without any
    measurement and the hard failures of each.
    """
    fields = ["value_kind", "value_double", "value_string", "value_array", "unit",
              "compute_status", "error"]
    entry = F.struct(F.col("metric"), F.struct(*fields))
    ruled = F.collect_list(F.when(F.col("metric").isin(wanted), entry)) if wanted else (
        F.collect_list(F.when(F.lit(False), entry)))
    broken = F.col("compute_status").isin(*GLOBAL_ERROR_STATUSES)
    keys = sample_keys(measurements)
    grouped = measurements.groupBy(*keys).agg(
        F.map_from_entries(ruled).alias("ruled"),
        F.coalesce(F.bool_or(broken), F.lit(False)).alias("any_error"),
    )
    if samples is None:
        return grouped.withColumn("hard_failures", F.array().cast("array<string>"))
    kept = samples.select(
        *keys, F.coalesce("hard_failures", F.array().cast("array<string>")).alias("hard_failures")
    )
    joined = kept.join(grouped, keys, "left")
    return joined.withColumn("any_error", F.coalesce("any_error", F.lit(False)))


def rule_results(
    measurements: DataFrame, ruleset: RuleSet, level: str, samples: DataFrame | None = None
) -> DataFrame:
    """One row per sample and active rule.

    The active rules travel as a literal of the plan, so evaluation needs one
    shuffle on the sample and no join against the rules.
    """
    active = active_rules(ruleset, level)
    wanted = sorted({rule.metric for _, rule, _ in active})
    base = per_sample(measurements, wanted, samples)
    if not active:
        literal = F.array(_rule_literal(0, Rule("", "", "gt", 0.0, ""), "disabled"))
        exploded = base.where(F.lit(False)).withColumn("rule", F.explode(literal))
    else:
        literal = F.array(*[_rule_literal(*item) for item in active])
        exploded = base.withColumn("rule", F.explode(literal))
    rule, m = F.col("rule"), F.col("m")
    found = exploded.withColumn("m", F.try_element_at("ruled", F.col("rule.metric")))
    detail = F.coalesce(m["error"], F.lit("no detail"))
    detail = F.when(detail == "", "no detail").otherwise(detail)
    value_free = rule["operator"] == "equals"
    # Each test applies once the earlier ones have passed.
    problem = (
        F.when(m.isNull(), F.lit("measurement missing"))
        .when(F.coalesce(m["compute_status"], F.lit("computed")) != "computed",
              F.concat(F.lit("measurement "), m["compute_status"], F.lit(": "), detail))
        .when(F.coalesce(m["unit"], F.lit("")) != rule["unit"],
              F.concat(F.lit("unit mismatch: expected "), rule["unit"], F.lit(", got "),
                       F.coalesce(m["unit"], F.lit(""))))
        .when(~value_free & _coerced(m).isNull(), _unmatched_reason(m))
    )
    judged = found.withColumn("problem", problem).withColumn("matched", _matched(rule, m))
    fine = F.col("problem").isNull()
    triggered = F.when(fine, F.col("matched")).otherwise(F.lit(True))
    said = F.when(F.col("matched"), "trigger condition matched").otherwise(
        "trigger condition not matched"
    )
    return judged.select(
        *sample_keys(judged),
        rule["rule_ord"].alias("rule_ord"),
        rule["rule_id"].alias("rule_id"),
        rule["metric"].alias("metric"),
        fine.alias("evaluated"),
        F.when(fine, ~F.col("matched")).alias("passed"),
        triggered.alias("triggered"),
        F.when(fine, rule["severity"]).otherwise("warning").alias("severity"),
        F.when(fine, said).otherwise(F.col("problem")).alias("reason"),
        F.when(fine, m["value_double"]).alias("observed"),
        "any_error",
        "hard_failures",
    )


def sample_status(
    measurements: DataFrame, ruleset: RuleSet, level: str, samples: DataFrame | None = None
) -> DataFrame:
    """Verdict per sample: failed > warning > passed, with the rules that fired."""
    if not active_rules(ruleset, level):
        rows = per_sample(measurements, [], samples).select(
            *sample_keys(measurements), F.col("any_error").alias("qc_incomplete"), "hard_failures",
            F.array().cast("array<string>").alias("triggered_rules"),
            F.lit(False).alias("warned"),
        )
    else:
        results = rule_results(measurements, ruleset, level, samples)
        fired = F.collect_list(F.when(F.col("triggered"), F.struct("rule_ord", "rule_id")))
        rows = results.groupBy(*sample_keys(results)).agg(
            (F.bool_or("any_error") | F.bool_or(~F.col("evaluated"))).alias("qc_incomplete"),
            F.first("hard_failures").alias("hard_failures"),
            F.transform(F.array_sort(fired), lambda e: e["rule_id"]).alias("triggered_rules"),
            F.bool_or(F.col("triggered") & (F.col("severity") == "warning")).alias("warned"),
        )
    status = (
        F.when(F.size("hard_failures") > 0, "failed")
        .when(F.col("qc_incomplete") | F.col("warned"), "warning")
        .otherwise("passed")
    )
    return rows.select(*sample_keys(rows), status.alias("status"), "qc_incomplete",
                       "triggered_rules", "hard_failures")

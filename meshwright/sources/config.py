"""Strict YAML configuration: rule files, device profiles, validation plans, runs."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

import yaml

from meshwright.operators.qc_rules import (
    EMPIRICAL_GROUPS,
    LEVELS,
    MODES,
    OPERATORS,
    Rule,
    RuleSet,
    metric_group,
)

DIGEST = re.compile(r"[0-9a-f]{64}")
IDENTITY = {"schema_version", "profile_id", "profile_version"}
RULE_FIELDS = {"rule_id", "metric", "operator", "threshold", "unit", "severity", "minimum_qc_level"}
PLAN_FIELDS = {"schema_version", "plan_id", "sample_count_target", "sampling_seed", "stratify_by", "notes"}
DEVICE_FIELDS = IDENTITY | {
    "coordinate_unit", "expected_edge_length_mm", "acquisition_device", "acquisition_protocol"}


class ConfigError(ValueError):
    """A configuration file does not follow its schema."""


def file_digest(path: str | Path) -> str:
    with Path(path).open("rb") as handle:
        return hashlib.file_digest(handle, "sha256").hexdigest()


def check_asset(path: str | Path, expected: str) -> Path:
    """An asset file whose content has the expected digest."""
    source = Path(path).resolve()
    if not source.is_file():
        raise ConfigError(f"asset does not exist: {source}")
    if not DIGEST.fullmatch(str(expected)):
        raise ConfigError(f"not a SHA-256 digest: {expected!r}")
    if (found := file_digest(source)) != expected:
        raise ConfigError(f"digest of {source} is {found}, not {expected}")
    return source


def read_yaml(path: str | Path, label: str) -> dict[str, Any]:
    source = Path(path)
    if not source.is_file():
        raise ConfigError(f"{label} does not exist: {source}")
    try:
        payload = yaml.safe_load(source.read_text(encoding="utf-8"))
    except yaml.YAMLError as error:
        raise ConfigError(f"{label} is not valid YAML: {source}") from error
    if not isinstance(payload, dict):
        raise ConfigError(f"{label} must be a mapping: {source}")
    return payload


def exact_fields(payload: dict[str, Any], fields: set[str], label: str) -> None:
    """Every field present and none besides."""
    unknown, missing = set(payload) - fields, fields - set(payload)
    if unknown:
        raise ConfigError(f"{label} has unknown fields: {', '.join(sorted(map(str, unknown)))}")
    if missing:
        raise ConfigError(f"{label} lacks fields: {', '.join(sorted(missing))}")


def check_identity(payload: dict[str, Any], label: str) -> None:
    if payload["schema_version"] != 1 or isinstance(payload["schema_version"], bool):
        raise ConfigError(f"{label} schema_version must be 1")
    for name in ("profile_id", "profile_version"):
        if not str(payload[name]).strip():
            raise ConfigError(f"{label} {name} must not be empty")


def _is_number(value: Any) -> bool:
    return isinstance(value, (int, float)) and not isinstance(value, bool)


def _check_rule(raw: Any, position: int, groups: dict[str, str], level: str) -> Rule:
    label = f"rule {position}"
    if not isinstance(raw, dict):
        raise ConfigError(f"{label} must be a mapping")
    exact_fields(raw, RULE_FIELDS, label)
    rule = Rule(
        str(raw["rule_id"]), str(raw["metric"]), str(raw["operator"]), raw["threshold"],
        str(raw["unit"]).strip(), str(raw["severity"]), str(raw["minimum_qc_level"]))
    pair = isinstance(rule.threshold, (list, tuple)) and len(rule.threshold) == 2
    group = metric_group(rule.metric)
    enhanced = rule.minimum_qc_level == "enhanced"
    faults = {
        "unsupported operator": rule.operator not in OPERATORS,
        "threshold must be a number": (
            rule.operator in ("gt", "gte", "lt", "lte") and not _is_number(rule.threshold)),
        "threshold must be two numbers": rule.operator in ("inside", "outside") and not (
            pair and all(map(_is_number, rule.threshold))),
        "unsupported severity": rule.severity not in ("warning", "record_only"),
        "unknown minimum_qc_level": rule.minimum_qc_level not in LEVELS,
        "an enhanced-only warning needs enhanced QC": (
            level == "standard" and enhanced and rule.severity == "warning"),
        "unknown metric": group is None,
        "metric's group is not configured": group is not None and group not in groups,
        "a stability rule must require enhanced QC": (
            group in ("crop.stability", "landmark.stability") and not enhanced),
        "unit must not be empty": not rule.unit,
    }
    for fault, present in faults.items():
        if present:
            raise ConfigError(f"{fault}: {rule.rule_id}")
    return rule


def load_rules(path: str | Path, level: str) -> RuleSet:
    """A rule file, checked for use at a QC level."""
    payload = read_yaml(path, "QC configuration")
    exact_fields(payload, IDENTITY | {"metric_groups", "rules"}, "QC configuration")
    check_identity(payload, "QC configuration")
    groups = {str(k): str(v) for k, v in (payload["metric_groups"] or {}).items()}
    if unknown := sorted(set(groups) - set(EMPIRICAL_GROUPS)):
        raise ConfigError(f"unknown metric groups: {', '.join(unknown)}")
    if modes := sorted(set(groups.values()) - set(MODES)):
        raise ConfigError(f"unsupported group modes: {', '.join(modes)}")
    if not isinstance(payload["rules"], list):
        raise ConfigError("rules must be a list")
    rules = [_check_rule(raw, n, groups, level) for n, raw in enumerate(payload["rules"])]
    ids = [rule.rule_id for rule in rules]
    if repeated := sorted({i for i in ids if ids.count(i) > 1}):
        raise ConfigError(f"duplicate rule_id: {', '.join(repeated)}")
    return RuleSet(str(payload["profile_id"]), str(payload["profile_version"]), groups, tuple(rules))


def load_device(path: str | Path) -> dict[str, Any]:
    """A device profile with its expected edge length."""
    payload = read_yaml(path, "device profile")
    exact_fields(payload, DEVICE_FIELDS, "device profile")
    check_identity(payload, "device profile")
    if payload["coordinate_unit"] != "mm":
        raise ConfigError("device profile coordinate_unit must be mm")
    if not _is_number(payload["expected_edge_length_mm"]) or payload["expected_edge_length_mm"] <= 0:
        raise ConfigError("expected_edge_length_mm must be a positive number")
    return payload


def load_plan(path: str | Path) -> dict[str, Any]:
    """A validation plan."""
    payload = read_yaml(path, "validation plan")
    exact_fields(payload, PLAN_FIELDS, "validation plan")
    if int(payload["sample_count_target"]) <= 0:
        raise ConfigError("sample_count_target must be positive")
    return payload


@dataclass(frozen=True)
class RunConfig:
    """Everything a run needs besides its inputs."""

    template_obj: Path
    template_landmarks: Path
    expected_vertices: int
    expected_faces: int
    device: dict[str, Any]
    rules: RuleSet
    template_points: Path | None = None
    refindex: Path | None = None
    symmetry_enabled: bool = False
    registration: dict[str, Any] = field(default_factory=dict)
    crop: dict[str, Any] = field(default_factory=dict)
    landmark: dict[str, Any] = field(default_factory=dict)
    phenotype: dict[str, Path] | None = None
    hashes: dict[str, str] = field(default_factory=dict)
    files: dict[str, Path] = field(default_factory=dict)


GEOMETRY_FIELDS = {
    "template_obj", "template_obj_sha256", "template_landmarks", "template_landmarks_sha256",
    "template_points", "template_points_sha256", "refindex", "refindex_sha256",
    "expected_template_vertices", "expected_template_faces"}
PHENOTYPE_ASSETS = ("template_obj", "lamda_csv", "names_pp")


def _assets(base: Path, payload: dict[str, Any], names: tuple[str, ...]) -> dict[str, Path]:
    return {n: check_asset(base / str(payload[n]), str(payload[f"{n}_sha256"])) for n in names}


def load_phenotype(path: str | Path) -> dict[str, Path]:
    """The projection assets of a pipeline file."""
    source = Path(path).resolve()
    section = read_yaml(source, "pipeline configuration").get("phenotype_landmarks")
    if not isinstance(section, dict):
        raise ConfigError("pipeline configuration lacks phenotype_landmarks")
    exact_fields(section, {f for n in PHENOTYPE_ASSETS for f in (n, f"{n}_sha256")}, "phenotype_landmarks")
    return _assets(source.parent, section, PHENOTYPE_ASSETS)


def load_run(
    pipeline: str | Path, device: str | Path, rules: str | Path, level: str
) -> RunConfig:
    """Pipeline, model, device and rule files with all their assets checked."""
    from meshwright.adapters import load_model_profile
    from meshwright.operators.register import RegistrationOptions

    source = Path(pipeline).resolve()
    payload = read_yaml(source, "pipeline configuration")
    exact_fields(
        {k: v for k, v in payload.items() if k != "phenotype_landmarks"},
        IDENTITY | {"models", "geometry", "processing"}, "pipeline configuration")
    check_identity(payload, "pipeline configuration")
    geometry, processing = payload["geometry"], payload["processing"]
    exact_fields(geometry, GEOMETRY_FIELDS, "geometry")
    exact_fields(payload["models"], {"crop_profile", "landmark_profile"}, "models")
    exact_fields(processing, {"symmetry_enabled", "texture_mode", "meshmonk"}, "processing")
    if processing["texture_mode"] != "geometry_only":
        raise ConfigError("texture_mode must be geometry_only")
    RegistrationOptions.of(processing["meshmonk"] or {})
    found = _assets(source.parent, geometry, ("template_obj", "template_landmarks", "template_points", "refindex"))
    models = {
        stage: load_model_profile(source.parent / payload["models"][f"{stage}_profile"], stage)
        for stage in ("crop", "landmark")}
    digests = {"pipeline": file_digest(source), "device": file_digest(device), "qc": file_digest(rules),
               **{stage: model["digest"] for stage, model in models.items()}}
    return RunConfig(
        found["template_obj"], found["template_landmarks"], int(geometry["expected_template_vertices"]),
        int(geometry["expected_template_faces"]), load_device(device), load_rules(rules, level),
        found["template_points"], found["refindex"], bool(processing["symmetry_enabled"]),
        dict(processing["meshmonk"] or {}), models["crop"], models["landmark"],
        load_phenotype(source) if "phenotype_landmarks" in payload else None, digests,
        {"pipeline": source, "device": Path(device), "qc": Path(rules),
         **{f"{stage}_profile": source.parent / payload["models"][f"{stage}_profile"] for stage in ("crop", "landmark")}})

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from meshwright import cli
from meshwright.operators import qc_rules, qc_tools
from meshwright.operators.measure import MEASUREMENT_COLUMNS
from meshwright.operators.qc_rules import Rule, RuleSet
from meshwright.sources import config
from meshwright.sources.config import ConfigError

SCHEMA = ("output_key string, metric string, value_kind string, value_double double, value_string string, "
          "value_array array<double>, unit string, compute_status string, error string")


def measured(spark, *rows):
    full = []
    for key, metric, value, unit, *status in rows:
        kind = {bool: "bool", int: "long", float: "double", str: "string", list: "array"}.get(type(value), "null")
        full.append((
            key, metric, kind, float(value) if kind in ("bool", "long", "double") else None,
            value if kind == "string" else None, value if kind == "array" else None, unit,
            (status or ["computed"])[0], None))
    return spark.createDataFrame(full, SCHEMA).select(*MEASUREMENT_COLUMNS)


def rules(*items, **modes):
    groups = {k.replace("__", "."): v for k, v in modes.items()}
    return RuleSet("p", "1", groups, tuple(items))


def test_group_names():
    assert [len(g) for g in (qc_rules.EMPIRICAL_GROUPS, qc_rules.HARD_CONTRACTS, qc_rules.TELEMETRY_GROUPS)] == [24, 12, 4]
    assert qc_rules.metric_group("crop.stability.jaccard_min") == "crop.stability"
    assert qc_rules.metric_group("crop.stabilityx") is None


def test_operators_and_special_values(spark):
    m = "input.topology.x"
    rows = measured(spark, ("nan", m, float("nan"), "mm"), ("text", m, "2.5", "mm"), ("flag", m, True, "mm"),
                    ("list", m, [1.0, 2.0], "mm"), ("none", m, None, "mm"), ("low", m, 1.0, "mm"))
    checks = rules(
        Rule("gt", m, "gt", 2.0, "mm"), Rule("out", m, "outside", [0.5, 2.0], "mm"),
        Rule("in", m, "inside", [1.0, 2.0], "mm"), Rule("eq", m, "equals", 1, "mm"),
        Rule("eqlist", m, "equals", [1.0, 2.0], "mm"), input__topology="warning")
    got = {(r["output_key"], r["rule_id"]): r for r in qc_rules.rule_results(rows, checks, "standard").collect()}
    assert not got["nan", "gt"]["triggered"] and got["nan", "out"]["triggered"] and not got["nan", "in"]["triggered"]
    assert got["text", "gt"]["triggered"] and not got["text", "eq"]["triggered"]
    assert got["flag", "eq"]["triggered"] and got["flag", "in"]["triggered"]
    assert got["list", "eqlist"]["triggered"] and not got["list", "gt"]["evaluated"]
    assert not got["none", "gt"]["evaluated"] and got["none", "gt"]["severity"] == "warning"
    assert got["low", "in"]["triggered"] and not got["low", "out"]["triggered"]


def test_missing_disabled_record_only_and_enhanced(spark):
    rows = measured(spark, ("a", "gpa.transform.scale", 2.0, "ratio"), ("a", "crop.retention.v", 0.1, "mm"),
                    ("a", "final.geometry.n", 5, "count", "not_available"))
    checks = rules(
        Rule("missing", "landmark.snap.d", "gt", 1.0, "mm"), Rule("off", "input.topology.x", "gt", 1.0, "mm"),
        Rule("note", "gpa.transform.scale", "gt", 1.0, "ratio"), Rule("unit", "crop.retention.v", "gt", 1.0, "ratio"),
        Rule("status", "final.geometry.n", "gt", 1.0, "count"),
        Rule("deep", "gpa.transform.scale", "gt", 1.0, "ratio", "warning", "enhanced"),
        landmark__snap="record_only", input__topology="disabled", final__geometry="warning")
    got = {r["rule_id"]: r for r in qc_rules.rule_results(rows, checks, "standard").collect()}
    assert set(got) == {"missing", "note", "unit", "status"}
    assert got["missing"]["severity"] == "warning" and got["missing"]["passed"] is None
    assert got["note"]["severity"] == "record_only" and got["note"]["triggered"]
    assert got["unit"]["reason"] == "unit mismatch: expected ratio, got mm"
    assert got["status"]["reason"] == "measurement not_available: no detail"
    deep = qc_rules.rule_results(rows, checks, "enhanced").where("rule_id = 'deep'").first()
    assert deep["severity"] == "record_only"


def test_verdicts(spark):
    m = "gpa.transform.scale"
    checks = rules(Rule("big", m, "gt", 1.0, "ratio"), gpa__transform="warning")
    rows = measured(spark, ("ok", m, 0.5, "ratio"), ("warn", m, 2.0, "ratio"), ("err", m, 0.5, "ratio"),
                    ("err", "input.topology.x", None, "mm", "computation_error"), ("hard", m, 0.5, "ratio"))
    samples = spark.createDataFrame(
        [("ok", []), ("warn", None), ("err", []), ("hard", ["contract.final_geometry"]), ("bare", [])],
        "output_key string, hard_failures array<string>")
    got = {r["output_key"]: r for r in qc_rules.sample_status(rows, checks, "standard", samples).collect()}
    assert {k: r["status"] for k, r in got.items()} == {
        "ok": "passed", "warn": "warning", "err": "warning", "hard": "failed", "bare": "warning"}
    assert got["err"]["qc_incomplete"] and not got["warn"]["qc_incomplete"]
    assert got["bare"]["triggered_rules"] == ["big"]
    bare = qc_rules.sample_status(rows, rules(), "standard", samples)
    assert {r["status"] for r in bare.collect()} == {"passed", "warning", "failed"}


def test_confusion_without_cases_is_null(spark):
    rows = spark.createDataFrame([("acceptable", "passed"), ("acceptable", "warning"), ("unsure", "failed")],
                                 "label string, qc_status string")
    row = qc_tools.confusion(rows).first()
    assert (row["evaluable_count"], row["false_positive"], row["true_negative"]) == (2, 1, 1)
    assert row["unacceptable_detection_rate"] is None and row["acceptable_warning_rate"] == 0.5


def test_seeded_sample_follows_the_hash_order(spark):
    keys = [f"k{n:03d}" for n in range(50)]
    records = spark.createDataFrame([(k,) for k in keys], "output_key string")
    order = sorted(keys, key=lambda k: hashlib.sha256(f"9:|{k}".encode()).hexdigest())
    got = {r[0] for r in qc_tools.seeded_sample(records, ["output_key"], 12, 9).collect()}
    assert got == set(order[:12])
    assert qc_tools.seeded_sample(records, ["output_key"], 99, 9).count() == 50


def test_two_runs_of_the_same_inputs_stay_apart(spark):
    rules = qc_rules.RuleSet("p", "1", {"gpa.transform": "warning"}, (qc_rules.Rule("big", "gpa.transform.scale", "gt", 1.0, "mm"),))
    rows = [(run, key, "gpa.transform.scale", "double", value, None, None, "mm", "computed", None)
            for run, key, value in (("r1", "k", 0.5), ("r2", "k", 2.0), ("r1", "m", 0.5))]
    measured = spark.createDataFrame(rows, "run_dir string, output_key string, metric string, value_kind string, value_double double, "
                                     "value_string string, value_array array<double>, unit string, compute_status string, error string")
    got = {(r["run_dir"], r["output_key"]): r["status"] for r in qc_rules.sample_status(measured, rules, "standard").collect()}
    assert got == {("r1", "k"): "passed", ("r2", "k"): "warning", ("r1", "m"): "passed"}
    labels = spark.createDataFrame([("k", "unacceptable")], "output_key string, label string")
    assert qc_tools.labeled_predictions(measured, labels, rules).count() == 2


@pytest.mark.parametrize("text, number", [("1_000", 1000.0), (" -2.5e3 ", -2500.0), ("1d", None), ("0x1p3", None), ("1__0", None), ("inf", float("inf")), ("", None)])
def test_numeric_text(spark, text, number):
    row = spark.createDataFrame([("string", None, text)], "value_kind string, value_double double, value_string string")
    m = F.struct("value_kind", "value_double", "value_string")
    assert row.select(qc_rules._coerced(m)).first()[0] == number


def test_blinded_order_limits(spark):
    records = spark.createDataFrame([("a",), ("b",), ("c",)], "output_key string")
    assert qc_tools.blinded_order(records, 1, -5).count() == 0
    ids = [r["blind_id"] for r in qc_tools.blinded_order(records, 1, 2).collect()]
    assert sorted(ids) == ["B00001", "B00002"]


def test_duplicate_labels_are_rejected(spark):
    rows = spark.createDataFrame([("a ", "Acceptable"), ("", "x"), ("a", "y")], "output_key string, label string")
    with pytest.raises(ValueError, match="duplicate label key: a"):
        qc_tools.clean_labels(rows)
    key, clean = qc_tools.clean_labels(rows.limit(2))
    assert key == "output_key" and [tuple(r) for r in clean.collect()] == [("a", "acceptable")]


RULE = {"rule_id": "r", "metric": "gpa.transform.scale", "operator": "gt", "threshold": 1.5, "unit": "ratio",
        "severity": "warning", "minimum_qc_level": "standard"}


@pytest.mark.parametrize("change, message", [
    ({}, None), ({"operator": "near"}, "unsupported operator"), ({"threshold": True}, "must be a number"),
    ({"operator": "inside"}, "two numbers"), ({"severity": "failed"}, "severity"), ({"metric": "a.b"}, "unknown metric"),
    ({"unit": " "}, "unit"), ({"minimum_qc_level": "enhanced"}, "enhanced"), ({"extra": 1}, "unknown fields"),
    ({"metric": "crop.stability.jaccard_min"}, "not configured"),
])
def test_rule_files(tmp_path, change, message):
    path = tmp_path / "qc.yaml"
    path.write_text(json.dumps({
        "schema_version": 1, "profile_id": "p", "profile_version": "1",
        "metric_groups": {"gpa.transform": "warning"}, "rules": [RULE | change]}))
    if message is None:
        assert config.load_rules(path, "standard").rules[0].threshold == 1.5
    else:
        with pytest.raises(ConfigError, match=message):
            config.load_rules(path, "standard")


def _record_run(root, count=4):
    folder = root / "run" / "metadata" / "samples"
    folder.mkdir(parents=True)
    for n in range(count):
        body = {"output_key": f"s{n}", "sample_id": f"S{n}", "status": "passed", "measurements": {
            "gpa.transform.scale": {"value": 1.0 + n, "unit": "ratio", "compute_status": "computed", "error": None},
            "telemetry.device.kind": {"value": "cpu", "unit": "category", "compute_status": "computed"},
            "landmark.prediction.coordinates": {"value": [[1, 2, 3]], "unit": "mm"},
            "input.extent_density.vertices_per_mm3": {"value": None, "unit": "count/mm3", "compute_status": "not_applicable"},
            "crop.probability.mean": {"value": float("nan"), "unit": "probability"},
            "final.geometry.vertex_count": {"value": 7, "unit": "count"}}}
        (folder / f"s{n}.json").write_text(json.dumps(body, indent=2))
    qc = root / "qc.yaml"
    qc.write_text(json.dumps({
        "schema_version": 1, "profile_id": "p", "profile_version": "1",
        "metric_groups": {"gpa.transform": "warning"}, "rules": [RULE | {"threshold": 2.5}]}))
    return str(root / "run"), str(qc)


def test_quality_commands_on_recorded_samples(spark, tmp_path, capsys):
    run, qc = _record_run(tmp_path)
    before = {p: p.read_bytes() for p in (tmp_path / "run").rglob("*.json")}

    def call(*args):
        code = cli.main(["--json", *args])
        out = capsys.readouterr()
        return code, json.loads((out.out or out.err).strip().splitlines()[-1])

    code, summary = call("qc-summarize", "--run-dir", run, "--output", str(tmp_path / "sum"))
    assert code == 0 and summary["measurement_row_count"] == 16 and summary["status_counts"] == {"passed": 4}
    code, result = call("qc-evaluate", "--run-dir", run, "--qc-config", qc, "--output", str(tmp_path / "eval"))
    assert code == 0 and result["counts"] == {"passed": 2, "warning": 2, "failed": 0}
    assert before == {p: p.read_bytes() for p in (tmp_path / "run").rglob("*.json")}
    plan = tmp_path / "plan.yaml"
    plan.write_text(json.dumps({"schema_version": 1, "plan_id": "v", "sample_count_target": 3,
                                "sampling_seed": 1, "stratify_by": [], "notes": ""}))
    labels = tmp_path / "labels.csv"
    labels.write_text("﻿output_key,consensus_label\n" + "".join(
        f"s{n},{'acceptable' if n < 2 else 'Unacceptable'}\n" for n in range(4)), encoding="utf-8")
    code, report = call("qc-calibrate", "--run-dir", run, "--qc-config", qc, "--validation-plan", str(plan),
                        "--labels", str(labels), "--output", str(tmp_path / "cal"))
    assert code == 0 and report["selected_sample_count"] == 3
    assert report["labeled_performance"]["evaluable_count"] == 3
    assert report["labeled_performance"]["false_positive"] == 0
    assert "p_candidate" in (tmp_path / "cal" / "candidate_qc.yaml").read_text()
    code, shown = call("qc-render", "--run-dir", run, "--limit", "2", "--output", str(tmp_path / "blind"))
    assert code == 0 and shown["listed"] == 2
    code, _ = call("qc-summarize", "--run-dir", run, "--output", str(tmp_path / "sum"))
    assert code == 2
    (tmp_path / "run" / "metadata" / "samples" / "broken.json").write_text("{not json")
    code, error = call("qc-summarize", "--run-dir", run, "--output", str(tmp_path / "sum2"))
    assert code == 2 and "invalid sample metadata" in error["error"]

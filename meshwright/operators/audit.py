"""Scanning text for personal data, secrets and private paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns a release must not contain.
PATTERNS = {
    "windows_absolute_path":
        r"(?i)\b[A-Z]:\\(?!path\\to(?:\\|\b)|Program Files(?:\\|\b))[^\s`\"']+",
    "unix_home_path": r"/home/(?!user(?:/|\b)|path(?:/|\b))[^/\s]+",
    "email_address": r"(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b",
    "phone_number": r"(?<![0-9A-Fa-f])1[3-9][0-9]{9}(?![0-9A-Fa-f])",
    "credential_value":
        r"(?i)\b(?:api[_-]?key|access[_-]?token|password|passwd|secret)\s*[:=]\s*[\"']?([^\s\"']+)",
}
# A match needs one of these, so most texts skip the backtracking patterns.
LITERALS = {"windows_absolute_path": ":\\", "unix_home_path": "/home/", "email_address": "@"}


def findings(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, rule, detail): every match of each pattern in each whole text."""
    def matches(rule: str, pattern: str) -> Column:
        found = F.regexp_extract_all(text, F.lit(f"({pattern})"), 1)
        return F.when(F.contains(F.col(text), F.lit(LITERALS[rule])), found) if rule in LITERALS else found

    checks = F.array(*[
        F.struct(F.lit(rule).alias("rule"), matches(rule, pattern).alias("matches")) for rule, pattern in PATTERNS.items()])
    each = texts.select(key, F.explode(checks).alias("f")).select(key, F.col("f.rule").alias("rule"), F.explode("f.matches").alias("detail"))
    return each


def path_findings(paths: DataFrame, key: str, segments: list[str], suffixes: list[str]) -> DataFrame:
    """(key, rule, detail): each forbidden folder name and file suffix of each path."""
    parts = F.split(F.lower(key), "/")
    hit = F.array_sort(F.array_intersect(parts, F.array(*[F.lit(s) for s in segments])))
    folders: Column = F.transform(hit, lambda h: F.struct(F.lit("prohibited_path").alias("rule"), h.alias("detail")))
    suffix_text = F.regexp_extract(F.lower(key), r"\.[^./]+$", 0)
    suffix = F.when(suffix_text.isin(*suffixes),
                    F.struct(F.lit("prohibited_data_file").alias("rule"), suffix_text.alias("detail")))
    return paths.select(key, F.explode(F.concat(folders, F.array_compact(F.array(suffix)))).alias("f")).select(key, "f.*")

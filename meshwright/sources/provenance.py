"""What a run was made with: resolved settings, environment and source."""

from __future__ import annotations

import dataclasses
import hashlib
import importlib.metadata
import platform
from pathlib import Path
from typing import Any

import meshwright
from pyspark.sql import SparkSession

from meshwright.sources.store import Store

PACKAGES = ("pyspark", "pyarrow", "pandas", "numpy", "PyYAML")


def source_digest(folder: Path | None = None) -> str:
    """One digest over the names and contents of the package's own source files."""
    root = folder or Path(meshwright.__file__).resolve().parent
    digest = hashlib.sha256()
    for file in sorted(root.rglob("*.py")):
        digest.update(f"{file.relative_to(root).as_posix()}\0{hashlib.sha256(file.read_bytes()).hexdigest()}\n".encode())
    return digest.hexdigest()


def environment(spark: SparkSession) -> dict[str, Any]:
    """Versions and settings of the driver; nothing personal, such as names of users or folders."""
    versions = {}
    for name in PACKAGES:
        try:
            versions[name] = importlib.metadata.version(name)
        except importlib.metadata.PackageNotFoundError:
            versions[name] = None
    jvm = spark.sparkContext._jvm.System
    return {
        "python": platform.python_version(), "system": platform.system(), "machine": platform.machine(),
        "java": jvm.getProperty("java.version"), "packages": versions, "engine": meshwright.__version__,
        "source_sha256": source_digest(),
        "spark_settings": {k: spark.conf.get(k, None) for k in (
            "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.session.timeZone")}}


def _plain(value: Any) -> Any:
    if dataclasses.is_dataclass(value) and not isinstance(value, type):
        return {f.name: _plain(getattr(value, f.name)) for f in dataclasses.fields(value)}
    if isinstance(value, dict):
        return {str(k): _plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple, set, frozenset)):
        return [_plain(v) for v in (sorted(value) if isinstance(value, (set, frozenset)) else value)]
    return value if value is None or isinstance(value, (bool, int, float, str)) else str(value)


def record(spark: SparkSession, store: Store, config: Any, models: dict[str, Any], files: dict[str, Path]) -> None:
    """Write the resolved configuration, the environment and copies of the configuration files."""
    store.put_json("resolved_config.json", {"configuration": _plain(config), "models": _plain(models)})
    store.put_json("environment.json", environment(spark))
    for name, file in files.items():
        store.put(f"config/{name}{Path(file).suffix}", Path(file).read_text(encoding="utf-8"))

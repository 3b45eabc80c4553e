"""Session settings the engine relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import meshwright

# AQE re-plans joins on real sizes and splits skewed partitions. Forcing the
# skew split is worth its extra exchange: one mesh may hold a third of the rows.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings once and ship package helpers with each task.

    A setting that the caller changes afterwards stays as it is.
    """
    if spark.conf.get("spark.meshwright.configured", None):
        return spark
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    spark.conf.set("spark.meshwright.configured", "true")
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, which need no installed copy.

    Helper functions travel inside the serialized task. Objects of the package's
    classes, such as broadcast models, are loaded by name: for them Spark's file
    server hands out an archive of the package.
    """
    if spark.conf.get("spark.meshwright.shipped", None):
        return
    spark.conf.set("spark.meshwright.shipped", "true")
    cloudpickle.register_pickle_by_value(meshwright)
    folder = Path(meshwright.__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="meshwright-")) / "meshwright.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for source in sorted(folder.rglob("*.py")):
            packed.write(source, source.relative_to(folder.parent))
    spark.sparkContext.addPyFile(str(archive))


def local_session(cores: str = "*", app: str = "meshwright") -> SparkSession:
    """A single-machine session for tests, benchmarks and the command line."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for cut lineage.

    It is the one the session names in ``spark.checkpoint.dir``. Only a
    local-mode session may fall back to a folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="meshwright-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in this application's part of the shared folder."""
    application = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/meshwright/{application}/{label}-{uuid.uuid4().hex}"


def discard_scratch(spark: SparkSession) -> None:
    """Delete the tables this application cut, once its results are written."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(
        f"{scratch_root(spark)}/meshwright/{context.applicationId}")
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def cut(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written table.

    Lineage ends here, so a lost executor costs a re-read rather than a
    recomputation, and later steps read only the columns they need.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(frame: DataFrame, rows: int, rows_per_task: int = 50_000) -> DataFrame:
    """Deal rows evenly before a step that multiplies them.

    Spatial probes turn one row into many candidate tests, so bytes alone are a
    poor measure of a task's work.
    """
    if rows < 1_000:
        return frame
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame.repartition(max(min(cores, rows // 1_000), rows // rows_per_task + 1))

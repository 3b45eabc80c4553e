"""Incremental runs: process the files that arrived since the last one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshwright.sources.obj import GLOB, local_path

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def arriving_files(spark: SparkSession, folder: str, files_per_batch: int = 10_000) -> DataFrame:
    """Stream of (path, length) of OBJ files; equal geometry is kept, not dropped."""
    return (
        spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", GLOB)
        .option("maxFilesPerTrigger", files_per_batch).load(folder)
        .select(local_path(F.col("path")).alias("path"), "length"))


def process_arrivals(
    spark: SparkSession, folder: str, state: str, handle: Callable[[DataFrame, int], None]
) -> None:
    """Run ``handle(files, batch)`` over everything new, then stop.

    The query's checkpoint in ``state`` remembers finished files, so a rerun
    continues where the last one ended.
    """
    query = (
        arriving_files(spark, folder).writeStream.foreachBatch(handle)
        .option("checkpointLocation", state).trigger(availableNow=True).start())
    query.awaitTermination()

"""Small helpers that the text operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meshwright.session import cut, scratch_path, ship

SPACES = "[\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, evaluated once per row.

    A value named inside a lambda would otherwise be computed again for every
    element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def whole_text(text: str = "text") -> Column:
    """The text, or the empty text where there is none."""
    return F.coalesce(F.col(text), F.lit(""))


def space_words(text: Column) -> Column:
    """Words between spaces and control spaces, in order."""
    return F.array_remove(F.split(text, SPACES), "")


def total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("bigint"), lambda a, x: a + x)


def sized(frame: DataFrame, rows: int, label: str, size: int = 256_000_000) -> DataFrame:
    """``frame`` as a written table, marked for broadcast only if it has at most ``rows`` rows and ``size`` bytes as JSON."""
    written = cut(frame, label)
    count, length = written.agg(F.count("*"), F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()
    return F.broadcast(written) if count <= rows and (length or 0) <= size else written


def set_aside(docs: DataFrame, outputs: Iterable[str]) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` without columns named like ``outputs``, under names that no operator uses, and those names by column."""
    inner = {c: f"__kept_{k}" for k, c in enumerate(docs.columns) if c.lower() not in outputs}
    return docs.select(*[F.col(f"`{c}`").alias(a) for c, a in inner.items()]), inner


def restored(inner: dict[str, str]) -> list[Column]:
    """The columns that ``set_aside`` renamed, under their own names."""
    return [F.col(a).alias(c) for c, a in inner.items()]


@contextmanager
def passing(frame: DataFrame, label: str) -> Iterator[DataFrame]:
    """``frame`` as a written table that is deleted on leaving: what is read from it must be written before."""
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    frame.write.parquet(path)
    yield spark.read.schema(frame.schema).parquet(path)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def small_batches(batches: Iterator[pa.RecordBatch], column: str, rows: int = 500, size: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows`` rows and ``size`` bytes (or list elements), or of one row."""
    for whole in batches:
        values = whole.column(column)
        length = pc.list_value_length if pa.types.is_list(values.type) else pc.binary_length
        ends = np.cumsum(pc.fill_null(length(values), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < whole.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, min(start + rows, int(np.searchsorted(ends, done + size, "right"))))
            yield whole.slice(start, stop - start)
            start = stop

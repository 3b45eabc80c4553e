"""Joins that stay balanced when one mesh holds a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshwright.session import cut

ROWS_PER_SALT = 1 << 20


def _salt_count(size: str, rows_per_salt: int) -> Column:
    return F.expr(f"cast({size} div {int(rows_per_salt)} as int) + 1")


def attach(
    rows: DataFrame,
    per_group: DataFrame,
    keys: list[str],
    size: str = "nv",
    spread: str = "vid",
    rows_per_salt: int = ROWS_PER_SALT,
    how: str = "inner",
) -> DataFrame:
    """Join one row per group onto many rows, splitting large groups.

    Both sides carry ``size``, the group's row count. A group of n rows is cut
    into ``n / rows_per_salt`` pieces by ``spread`` and its single row is
    repeated once per piece, so small groups pay nothing and a hot group is
    spread over as many tasks as it needs. ``size`` depends on ``keys`` alone.
    """
    count = _salt_count(size, rows_per_salt)
    left = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), count).cast("int"))
    right = per_group.withColumn("_salt", F.explode(F.sequence(F.lit(0), count - 1)))
    return left.join(right.drop(size) if size not in keys else right,
                     [*keys, "_salt"], how).drop("_salt")


def attach_sized(
    rows: DataFrame, sizes: DataFrame, key: str, size: str, hot_rows: int = ROWS_PER_SALT
) -> DataFrame:
    """Join each key's row count onto its rows; keys without one drop out.

    ``sizes`` is a written table of (key, size). Keys above ``hot_rows`` are few,
    at most the total divided by it, so they are broadcast; their rows then carry
    a spread key through the join that serves all other keys.
    """
    total = sizes.agg(F.sum(size)).first()[0] or 0
    limit = max(hot_rows, total // 100_000)
    hot = F.broadcast(sizes.where(F.col(size) > limit).select(key, F.col(size).alias("_hot")))
    cold = sizes.where(F.col(size) <= limit).select(F.col(key).alias("_key"), size)
    text = F.col(key).cast("string")
    cold = cold.withColumn("_key", F.col("_key").cast("string"))
    marked = rows.join(hot, key, "left").withColumn(
        "_key",
        F.when(F.col("_hot").isNull(), text).otherwise(
            F.concat(F.lit("\u0000"), F.monotonically_increasing_id().cast("string"))))
    return marked.join(cold, "_key", "left").withColumn(
        size, F.coalesce("_hot", size)).drop("_hot", "_key").where(F.col(size).isNotNull())


def attach_count(rows: DataFrame, key: str, name: str, hot_rows: int = ROWS_PER_SALT) -> DataFrame:
    """Add to every row how many rows share its key; counting folds map-side."""
    sizes = cut(rows.groupBy(key).agg(F.count(F.lit(1)).alias(name)), "key-sizes")
    return attach_sized(rows, sizes, key, name, hot_rows)


def attach_small(
    rows: DataFrame,
    small: DataFrame,
    keys: list[str],
    how: str = "inner",
    row_limit: int = 200_000,
) -> DataFrame:
    """Join a lookup table, broadcasting it only after counting its rows."""
    counted = small.limit(row_limit + 1).count()
    side = F.broadcast(small) if counted <= row_limit else small
    return rows.join(side, keys, how)


def probe_join(
    probes: DataFrame, stored: DataFrame, keys: list[str], stored_rows: int,
    row_limit: int = 500_000,
) -> DataFrame:
    """Join multiplied probes to a stored side whose row count is known.

    The planner cannot see how far an explode multiplies rows and would rather
    broadcast the probes. A small stored side is broadcast instead; a large one
    is sort-merged, where AQE splits hot cells.
    """
    if stored_rows <= row_limit:
        return probes.join(F.broadcast(stored), keys)
    return probes.hint("merge").join(stored, keys)

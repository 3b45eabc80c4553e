"""Distributed positions and exact quantiles.

A window over a whole group puts that group into one task. The helpers here
rank inside bounded pieces of a group and add each piece's offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meshwright.session import cut

BLOCK_ROWS = 1 << 20
QUANTILE_GROUP_LIMIT = 1_000_000
SPLITS = 256


def dense_index(
    rows: DataFrame,
    group: list[str],
    order: str,
    index: str,
    size: str | None = None,
    block_rows: int = BLOCK_ROWS,
    block: Column | None = None,
) -> DataFrame:
    """Zero-based position of each row in its group by a unique order.

    The order values are cut into blocks of at most ``block_rows`` rows. Only
    the block counts pass through a per-group window; rows are numbered inside
    their block. ``size`` optionally names a column for the group's row count.
    ``block`` replaces the integer blocks for other orders; it must not decrease
    along the order.
    """
    if block is None:
        block = F.expr(f"{order} div {int(block_rows)}")
    blocked = rows.withColumn("_block", block)
    counts = blocked.groupBy(*group, "_block").agg(F.count(F.lit(1)).alias("_rows"))
    in_group = Window.partitionBy(*group)
    before = in_group.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *group,
        "_block",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"),
        *([F.sum("_rows").over(in_group).alias(size)] if size else []),
    )
    in_block = Window.partitionBy(*group, "_block").orderBy(order)
    return (
        blocked.join(offsets, [*group, "_block"])
        .withColumn(index, (F.row_number().over(in_block) - 1 + F.col("_offset")).cast("bigint"))
        .drop("_block", "_offset")
    )


def global_position(rows: DataFrame, order: list[str], index: str) -> DataFrame:
    """Zero-based position in a total order, from a range-partitioned sort."""
    placed = cut(
        rows.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()), "position"
    ).withColumn("_part", F.shiftright("_id", 33))
    # One row per sort partition: bounded by the shuffle width, not the data.
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    in_partition = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(index, (in_partition + F.col("_offset")).cast("bigint"))
        .drop("_id", "_part", "_offset")
    )


def exact_quantiles(
    rows: DataFrame,
    keys: list[str],
    value: str,
    probabilities: dict[str, float],
    largest: int | None = None,
    group_limit: int = QUANTILE_GROUP_LIMIT,
    also: list[Column] | None = None,
) -> DataFrame:
    """Linear-interpolation quantiles per group, exact at any group size.

    ``probabilities`` maps output column to probability; ``also`` are further
    aggregates to report per group. ``largest`` is a known bound on the rows of
    one group; without it the bound is counted. Groups within ``group_limit``
    use the built-in exact aggregate, in the same pass as ``also``. Beyond it,
    repeated values are folded into counts and only the value ranges that hold a
    wanted rank are sorted.
    """
    named, also = list(probabilities.items()), also or []
    if largest is None:
        largest = rows.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    if largest <= group_limit:
        picks = F.percentile(value, F.array(*[F.lit(float(p)) for _, p in named]))
        found = rows.groupBy(*keys).agg(*also, picks.alias("_q"))
        return found.select(
            *[c for c in found.columns if c != "_q"],
            *[F.col("_q")[i].alias(name) for i, (name, _) in enumerate(named)],
        )
    rows = cut(rows, "quantile-rows")
    spread = _split_quantiles(rows, keys, value, named, group_limit)
    return rows.groupBy(*keys).agg(*also).join(spread, keys) if also else spread


def _split_quantiles(
    rows: DataFrame, keys: list[str], value: str, named: list[tuple[str, float]], group_limit: int
) -> DataFrame:
    """Quantiles of groups too large for one aggregation buffer."""
    folded = cut(
        rows.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_c")),
        "folded",
    )
    totals = folded.groupBy(*keys).agg(F.sum("_c").alias("_n"))
    positions = totals.select(
        *keys,
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("name"),
                        (F.lit(float(p)) * (F.col("_n") - 1)).alias("pos"),
                    )
                    for name, p in named
                ]
            )
        ).alias("_w"),
    ).select(*keys, F.col("_w.name").alias("_name"), F.col("_w.pos").alias("_pos"))
    ends = positions.select(
        *keys, "_name", "_pos",
        F.explode(F.array(F.floor("_pos"), F.ceil("_pos"))).alias("_rank"),
    ).distinct()
    found = _values_at_ranks(folded, keys, ends.select(*keys, "_rank").distinct(), group_limit)
    low_weight = F.col("_pos") - F.floor("_pos")
    low = F.max(F.when(F.col("_rank") == F.floor("_pos"), F.col("_v")))
    high = F.max(F.when(F.col("_rank") == F.ceil("_pos"), F.col("_v")))
    per_name = (
        ends.join(found, [*keys, "_rank"])
        .groupBy(*keys, "_name")
        .agg(low.alias("_lo"), high.alias("_hi"), F.max(low_weight).alias("_t"))
        .withColumn("_q", F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_t"))
    )
    return per_name.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_name") == name, F.col("_q"))).alias(name) for name, _ in named]
    )


def _values_at_ranks(
    folded: DataFrame, keys: list[str], wanted: DataFrame, group_limit: int
) -> DataFrame:
    """Value at each wanted zero-based rank of (value, count) rows per group."""
    per_group = folded.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_d"),
        F.percentile_approx(
            "_v", F.array(*[F.lit(i / SPLITS) for i in range(1, SPLITS)]), F.lit(20 * SPLITS)
        ).alias("_splits"),
    )
    widest = per_group.agg(F.max("_d")).first()[0] or 0
    if widest <= group_limit:
        order = Window.partitionBy(*keys).orderBy("_v")
        spans = folded.withColumn("_to", F.sum("_c").over(order)).withColumn(
            "_from", F.col("_to") - F.col("_c")
        )
        hit = (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
        return spans.join(wanted, keys).where(hit).select(*keys, "_rank", "_v")
    # One row of splitters per group; AQE splits the hot group's side of the join.
    bucket = F.size(F.filter("_splits", lambda s: s < F.col("_v")))
    bucketed = cut(
        folded.join(per_group, keys).select(*keys, bucket.alias("_bucket"), "_v", "_c"),
        "bucketed",
    )
    in_group = Window.partitionBy(*keys).orderBy("_bucket")
    spans = (
        bucketed.groupBy(*keys, "_bucket").agg(F.sum("_c").alias("_n"))
        .withColumn("_to", F.sum("_n").over(in_group))
        .withColumn("_from", F.col("_to") - F.col("_n"))
    )
    hit = (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
    inside = cut(
        spans.join(wanted, keys).where(hit)
        .select(*keys, "_bucket", "_from", (F.col("_rank") - F.col("_from")).alias("_rank")),
        "ranks",
    )
    narrowed = bucketed.join(
        inside.select(*keys, "_bucket").distinct(), [*keys, "_bucket"], "left_semi"
    )
    found = _values_at_ranks(
        narrowed, [*keys, "_bucket"], inside.drop("_from"), group_limit
    )
    return found.join(inside, [*keys, "_bucket", "_rank"]).select(
        *keys, (F.col("_rank") + F.col("_from")).alias("_rank"), "_v"
    )


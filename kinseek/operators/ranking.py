"""Per-group top-K and min-max scaling that hold up when one group is most of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPREAD = 64
SCORE_DIGITS = 9


def top_k(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    k: int,
    rank: str = "rank",
    spread: int = 0,
) -> DataFrame:
    """Keep the first `k` rows of every group and number them from 1.

    Every window first prunes each input task's rows to `k` per group. With `spread` the
    survivors of the tasks are then cut down in `spread` sub-groups, by task, before the
    final ranking, so that no task ranks more than `spread * k` rows of a group, however
    many tasks there were. Which sub-group a row passes through does not affect the
    result; `order` must leave no ties.
    """
    if spread:
        inner = Window.partitionBy(*by, "_part").orderBy(*order)
        df = (
            df.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(spread)))
            .withColumn("_place", F.row_number().over(inner))
            .where(F.col("_place") <= k)
            .drop("_part", "_place")
        )
    outer = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(outer)).where(F.col(rank) <= k)


def min_max(value: Column, low: Column, high: Column) -> Column:
    """Scale to [0, 1]; a group whose values are all equal gets 0.5."""
    return F.when(high == low, F.lit(0.5)).otherwise((value - low) / (high - low))


def min_max_in_group(value: str, by: Sequence[str]) -> Column:
    """Min-max over groups already cut to a top-K, so at most K rows share a task."""
    group = Window.partitionBy(*by)
    column = F.col(value)
    return min_max(column, F.min(column).over(group), F.max(column).over(group))


def normalize_scores(
    df: DataFrame,
    value: str,
    by: Sequence[str],
    out: str,
    spread_on: str,
    spread: int = SPREAD,
) -> DataFrame:
    """Min-max per group for groups of any size.

    The range of each group comes from a partially aggregated min and max. It is joined
    back once per sub-group, so a group that holds most rows is read by `spread` tasks.
    """
    ranges = (
        df.groupBy(*by)
        .agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
        .withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    )
    parted = df.withColumn(
        "_part", F.pmod(F.xxhash64(spread_on), F.lit(spread)).cast("int")
    )
    return (
        parted.join(ranges, [*by, "_part"])
        .withColumn(out, min_max(F.col(value), F.col("_low"), F.col("_high")))
        .drop("_part", "_low", "_high")
    )

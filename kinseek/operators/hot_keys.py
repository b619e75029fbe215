"""Joins against a table with one row per key that survive very frequent keys.

A key is hot when it holds more rows than a shuffle partition should (the mean of all
partitions, and at least `FLOOR` rows), so there are never more hot keys than partitions:
the list of them is safe to broadcast whatever the size of the data. Rows of a hot key are spread over many tasks and the one
matching row is repeated for each of them. Nothing is dropped or capped.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinseek.runtime import stage

FLOOR = 200_000


@dataclass(frozen=True)
class HotKeys:
    """Hot keys with the number of tasks (`_fan`) each is spread over; None if there are none."""

    keys: tuple[str, ...]
    frame: DataFrame | None


def find_hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    weight: str | None = None,
    total: int | None = None,
) -> HotKeys:
    """Keys of `df` holding more rows than a partition should, and at least `FLOOR`.

    With `weight`, `df` has one row per key already and that column says how many rows
    the key stands for. `total` is the number of rows where it is known.
    """
    counted = df
    if weight is None:
        weight, counted = "_rows", df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    if total is None and weight == "_rows":
        total = df.count()
    elif total is None:
        total = df.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    limit = max(FLOOR, total // max(partitions, 1))
    if total <= limit:
        return HotKeys(tuple(keys), None)
    fan = F.ceil(F.col(weight) / limit).cast("int").alias("_fan")
    hot = stage(counted.where(F.col(weight) > limit).select(*keys, fan))
    return HotKeys(tuple(keys), None if hot.isEmpty() else hot)


def lookup_join(
    left: DataFrame, right: DataFrame, hot: HotKeys, how: str, spread_on: Sequence[str]
) -> DataFrame:
    """Join on the hot-key columns; `right` has at most one row per key."""
    keys = list(hot.keys)
    if hot.frame is None:
        return left.join(right, keys, how)
    listed = F.broadcast(hot.frame)
    slot = F.when(F.col("_fan").isNull(), 0).otherwise(
        F.pmod(F.xxhash64(*spread_on), F.col("_fan"))
    )
    spread_left = (
        left.join(listed, keys, "left").withColumn("_slot", slot.cast("int")).drop("_fan")
    )
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_fan"), F.lit(1)) - 1))
    spread_right = right.join(listed, keys, "left").withColumn("_slot", copies).drop("_fan")
    return spread_left.join(spread_right, [*keys, "_slot"], how).drop("_slot")

"""Connected components of links and global row numbers, both spread over all tasks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinseek.runtime import stage


class Forest:
    """Union-find over the nodes one task has met; the smaller node is the root."""

    def __init__(self) -> None:
        self.up: dict = {}

    def root(self, a):
        up, top = self.up, a
        while (above := up.get(top, top)) != top:
            top = above
        while (above := up.get(a, a)) != top:
            up[a] = top
            a = above
        return top

    def join(self, a, b) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        if b < a:
            a, b = b, a
        self.up[b] = a
        return True

    def pairs(self) -> Iterable[tuple]:
        return ((self.root(b), b) for b in list(self.up))


def components(edges: DataFrame) -> DataFrame:
    """`node`, `component` (the smallest node it can reach) for all nodes of links `a`, `b`.

    Alternating stars: every node points its larger neighbours, then its smaller ones, to
    the smallest node it knows. Few rounds, each a grouped minimum and a join whose one side
    has a row per node; large stars are left to adaptive skew handling of that join.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    now = stage(edges.where("a != b").select(high.alias("a"), low.alias("b")).distinct())
    known = _print(now)
    while known[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .where("a != b")
            .distinct()
        )
        now = stage(small)
        fresh = _print(now)
        if fresh == known:
            break
        known = fresh
    stars = now.groupBy("a").agg(F.min("b").alias("component"))
    roots = stars.select(F.col("component").alias("node"), "component").distinct()
    return stars.select(F.col("a").alias("node"), "component").union(roots)


def _print(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1000003)).first()
    return tuple(row)


def in_order(df: DataFrame, order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """`df` range-partitioned and sorted by `order`, staged, with `_part` and `_at` (place in it)."""
    count = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(count, *order).sortWithinPartitions(*order)
    number = F.monotonically_increasing_id()
    return stage(
        ranged.select("*", F.shiftright(number, 33).cast("int").alias("_part"), number.bitwiseAND((1 << 33) - 1).alias("_at"))
    )


def with_totals_before(ordered: DataFrame, **sums: str) -> DataFrame:
    """Adds the row number over all partitions as `_row`, and for each name the sum of the
    named column over all earlier rows.

    Only per-partition totals, one row for each partition, meet in one place; the sums
    inside a partition run along its own rows.
    """
    totals = ordered.groupBy("_part").agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(f"_sum_{n}") for n, c in sums.items()]
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "_part",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_row0"),
        *[F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_sum_{n}") for n in sums],
    )
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    return (
        ordered.join(F.broadcast(starts), "_part")
        .withColumn("_row", F.col("_row0") + F.col("_at"))
        .withColumns({n: F.col(f"_sum_{n}") + F.coalesce(F.sum(c).over(inside), F.lit(0)) for n, c in sums.items()})
        .drop("_row0", *[f"_sum_{n}" for n in sums])
    )


def small_enough(df: DataFrame, most: int) -> bool:
    """Whether `df` has at most `most` rows; reads no further than it must."""
    return df.limit(most + 1).count() <= most


def as_i64(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def as_u64(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values, dtype=np.int64).view(np.uint64)

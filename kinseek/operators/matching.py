"""Which key pairs found a new entity: greedy, order-first matching of two kinds of keys.

Every distinct (mrn_key, triplet) pair is an edge between two keys, ordered by its
earliest note. A pair founds an entity exactly when no earlier founder holds either of
its keys, so the founders are the greedy maximal matching in that order. A sequential
scan is not needed: a pair that is the earliest undecided one for each of its keys is a
founder whatever happens elsewhere, so all such pairs are settled at once and the pairs
they block are dropped. Rounds repeat until nothing is undecided (Blelloch, Fineman and
Shun, SPAA 2012, show few rounds suffice for random orders).

Orders that build long dependency chains would need many rounds. From round
`chain_after` on, a pair waiting for exactly one other pair is linked to it, and chains
of such links are settled by pointer doubling, in a logarithmic number of joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinseek.operators.hot_keys import HotKeys, find_hot_keys, lookup_join
from kinseek.runtime import stage

CHAIN_AFTER = 6
_SIDES = ("mrn_key", "triplet")
_PAIR = ["mrn_key", "triplet", "ord"]


def distinct_pairs(keyed: DataFrame) -> DataFrame:
    """One row per key pair: its earliest order and how many notes carry it."""
    return (
        keyed.where((F.col("mrn_key") != "") | (F.col("triplet") != ""))
        .groupBy("mrn_key", "triplet")
        .agg(F.min("ord").alias("ord"), F.count(F.lit(1)).alias("notes"))
    )


def _earliest_per_key(undecided: DataFrame, side: str) -> DataFrame:
    other = _SIDES[1 - _SIDES.index(side)]
    return (
        undecided.where(F.col(side) != "")
        .groupBy(side)
        .agg(F.min(F.struct("ord", other)).alias("first"))
        .select(side, f"first.{other}", "first.ord")
        .select(*_PAIR)
    )


def _settled_now(undecided: DataFrame) -> DataFrame:
    """Pairs that are the earliest undecided one for every key they have."""
    needed = sum(F.when(F.col(side) != "", 1).otherwise(0) for side in _SIDES)
    return (
        _earliest_per_key(undecided, "mrn_key")
        .unionByName(_earliest_per_key(undecided, "triplet"))
        .groupBy(*_PAIR)
        .agg(F.count(F.lit(1)).alias("votes"))
        .where(F.col("votes") == needed)
        .select(*_PAIR)
    )


def _position(undecided: DataFrame, side: str, hot: HotKeys) -> DataFrame:
    """Add the key's earliest order (`first_*`) and how many pairs come before this one:
    0, 1, or 2 for two or more (`before_*`)."""
    with_key = undecided.where(F.col(side) != "").select(side, "ord")
    first = with_key.groupBy(side).agg(F.min("ord").alias("first"))
    later = lookup_join(with_key, first, hot, "inner", ["ord"]).where(F.col("ord") > F.col("first"))
    second = later.groupBy(side).agg(F.min("ord").alias("second"))
    places = first.join(second, side, "left").select(
        side, F.col("first").alias(f"first_{side}"), F.col("second").alias(f"second_{side}")
    )
    before = (
        F.when((F.col(side) == "") | (F.col("ord") == F.col(f"first_{side}")), 0)
        .when(F.col("ord") == F.col(f"second_{side}"), 1)
        .otherwise(2)
    )
    return lookup_join(undecided, places, hot, "left", ["ord"]).withColumn(f"before_{side}", before)


def _settled_by_chains(undecided: DataFrame, hot: dict[str, HotKeys]) -> DataFrame:
    """Founders among the earliest pairs and among all pairs hanging on them by single links."""
    placed = undecided
    for side in _SIDES:
        placed = _position(placed, side, hot[side])
    waits = sum(F.col(f"before_{side}") for side in _SIDES)
    placed = stage(placed.withColumn("waits", waits))
    earliest = placed.where("waits = 0").select(*_PAIR)

    # Each single waiter is a founder exactly when the pair it waits for is not.
    target = F.when(F.col("before_mrn_key") == 1, F.col("first_mrn_key")).otherwise(
        F.col("first_triplet")
    )
    links = stage(
        placed.where("waits = 1").select("ord", target.alias("target"), F.lit(1).alias("flips"))
    )
    while True:
        onward = links.select(
            F.col("ord").alias("target"),
            F.col("target").alias("next"),
            F.col("flips").alias("more"),
        )
        stepped = stage(
            links.join(onward, "target", "left").select(
                "ord",
                F.coalesce("next", "target").alias("target"),
                ((F.col("flips") + F.coalesce("more", F.lit(0))) % 2).alias("flips"),
                F.col("next").isNotNull().alias("moved"),
            )
        )
        links = stepped.drop("moved")
        if stepped.where("moved").isEmpty():
            break
    chained = (
        links.where("flips = 0")
        .join(earliest.select(F.col("ord").alias("target")), "target", "left_semi")
        .select("ord")
    )
    return earliest.unionByName(undecided.join(chained, "ord", "left_semi").select(*_PAIR))


def _without_keys_of(
    undecided: DataFrame, founders: DataFrame, hot: dict[str, HotKeys]
) -> DataFrame:
    for side in _SIDES:
        taken = founders.where(F.col(side) != "").select(side)
        undecided = lookup_join(undecided, taken, hot[side], "left_anti", ["ord"])
    return undecided.select(*_PAIR)


def hot_sides(pairs: DataFrame, total: int | None = None) -> dict[str, HotKeys]:
    """The hot keys of either kind, by the number of pairs they are in."""
    return {
        side: find_hot_keys(pairs.where(F.col(side) != ""), [side], total=total)
        for side in _SIDES
    }


def founding_pairs(
    pairs: DataFrame, hot: dict[str, HotKeys] | None = None, chain_after: int = CHAIN_AFTER
) -> DataFrame:
    """The founders among `pairs` (from `distinct_pairs`), as mrn_key, triplet, ord.

    `ord` must differ between pairs and `pairs` should already be materialised: it is
    read by every key count and by the first round.
    """
    if hot is None:
        hot = hot_sides(pairs)
    found, undecided, rounds = [], pairs.select(*_PAIR), 0
    while True:
        rounds += 1
        settle = _settled_now if rounds < chain_after else lambda u: _settled_by_chains(u, hot)
        founders = stage(settle(undecided))
        found.append(founders)
        undecided = stage(_without_keys_of(undecided, founders, hot))
        if undecided.isEmpty():
            return reduce(DataFrame.unionByName, found)

"""Merging two result lists per query and fusing their scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinseek.fixed_values import K_A, LEXICAL_WEIGHT, PRESENCE_WEIGHT, W_BM25, W_DENSE
from kinseek.operators.lexical import CARRY, LEXICAL, PRESENCE
from kinseek.operators.ranking import SCORE_DIGITS, min_max_in_group, top_k

METHODS = ("weighted_sum", "ranked_logit", "ranked-logit", "rank_logit")


def merge_lists(lexical: DataFrame, dense: DataFrame, carry=CARRY) -> DataFrame:
    """Full outer union of two ranked lists (query_id, chunk_id, score, rank).

    A chunk in one list only scores 0 on the other side. Carried columns come from the
    lexical list first. Each list holds a chunk once per query.
    """
    sides = []
    for tag, frame in (("bm25", lexical), ("dense", dense)):
        names = {"score": f"s_{tag}", "rank": f"{tag}_rank"}
        names.update({c: f"_{tag}_{c}" for c in carry if c in frame.columns})
        sides.append(
            frame.select(
                "query_id", "chunk_id", *[F.col(old).alias(new) for old, new in names.items()]
            )
        )
    joined = sides[0].join(sides[1], ["query_id", "chunk_id"], "full")
    kept = []
    for c in carry:
        present = [n for n in (f"_bm25_{c}", f"_dense_{c}") if n in joined.columns]
        kept.append(F.coalesce(*present, F.lit("")).alias(c))
    return joined.select(
        "query_id",
        "chunk_id",
        F.coalesce("s_bm25", F.lit(0.0)).alias("s_bm25"),
        F.coalesce("s_dense", F.lit(0.0)).alias("s_dense"),
        "bm25_rank",
        "dense_rank",
        *kept,
    )


def merge_sides(found: DataFrame, carry=CARRY) -> DataFrame:
    """The same union when both lists come from one `lexical.search`: one small
    aggregation in place of a second scan and a join."""

    def of(side, column):
        return F.max(F.when(F.col("side") == side, F.col(column)))

    merged = found.groupBy("query_id", "chunk_id").agg(
        F.coalesce(of(LEXICAL, "hits") * LEXICAL_WEIGHT, F.lit(0.0)).alias("s_bm25"),
        F.coalesce(of(PRESENCE, "hits") * PRESENCE_WEIGHT, F.lit(0.0)).alias("s_dense"),
        of(LEXICAL, "rank").alias("bm25_rank"),
        of(PRESENCE, "rank").alias("dense_rank"),
        *[F.max(c).alias(c) for c in carry],
    )
    return merged.fillna("", list(carry))


def _logit_of_rank(score: str, list_rank: str):
    """ln(p / (1 - p)) with p = (n - rank + 0.5) / n over the query's n candidates.

    Candidates absent from a list take its last place, n.
    """
    per_query = Window.partitionBy("query_id")
    n = F.count(F.lit(1)).over(per_query)
    place = F.when(F.col(list_rank).isNull(), n).otherwise(
        F.rank().over(per_query.orderBy(F.desc(score)))
    )
    p = (n - place + 0.5) / n
    return F.ln(p / (1 - p))


def fuse(
    merged: DataFrame,
    k: int = K_A,
    method: str = "weighted_sum",
    w_bm25: float = W_BM25,
    w_dense: float = W_DENSE,
) -> DataFrame:
    """Fused score per candidate and the top `k` of every query.

    `weighted_sum` adds the min-max normalised scores; `ranked_logit` is the same thing
    under another name; `rank_logit` adds logits of the ranks. Ties go to the better
    lexical rank, then dense rank, then chunk id. A query has at most 2 k candidates, so
    its windows are small.
    """
    if method not in METHODS:
        raise ValueError(f"unknown fusion method: {method}")
    if method == "rank_logit":
        left = _logit_of_rank("s_bm25", "bm25_rank")
        right = _logit_of_rank("s_dense", "dense_rank")
    else:
        left = min_max_in_group("s_bm25", ["query_id"])
        right = min_max_in_group("s_dense", ["query_id"])
    fused = merged.withColumn("fusion_score", w_bm25 * left + w_dense * right)
    order = [
        F.round("fusion_score", SCORE_DIGITS).desc(),
        F.asc_nulls_last("bm25_rank"),
        F.asc_nulls_last("dense_rank"),
        F.asc("chunk_id"),
    ]
    return top_k(fused, ["query_id"], order, k).drop("bm25_rank", "dense_rank")

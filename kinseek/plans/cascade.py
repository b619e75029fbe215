"""The retrieval cascade: candidates, re-scoring, judging, patients of the results."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinseek.fixed_values import K_A, K_B, K_C, W_BM25, W_DENSE
from kinseek.operators import fusion, lexical, rerank
from kinseek.operators.lexical import LEXICAL, PRESENCE
from kinseek.runtime import stage
from kinseek.sources import writers


# Searches take (chunks, queries, k) and return query_id, chunk_id, score and rank; a rescorer takes
# (candidates, queries, k) and returns the candidates with s_li, rank and any other columns.
Search = Callable[[DataFrame, DataFrame, int], DataFrame]
Rescorer = Callable[[DataFrame, DataFrame, int], DataFrame]


def candidates(
    chunks: DataFrame,
    queries: DataFrame,
    k: int = K_A,
    method: str = "weighted_sum",
    w_bm25: float = W_BM25,
    w_dense: float = W_DENSE,
) -> DataFrame:
    """Lexical and presence search in one scan, fused to the top `k` of every query."""
    found = lexical.search(chunks, queries, k)
    return fusion.fuse(fusion.merge_sides(found), k, method, w_bm25, w_dense)


@dataclass(frozen=True)
class Cascade:
    """Stage outputs. All are materialised: a query has at most K rows in each."""

    found: DataFrame  # both result lists, before fusion
    candidates: DataFrame
    rescored: DataFrame
    final: DataFrame

    def write(self, path: str, fmt: str = "json") -> None:
        for name in ("candidates", "rescored", "final"):
            rows = getattr(self, name)
            writers.write_stage(rows.drop(*rerank.CHUNK_FIELDS), f"{path}/{name}", fmt)


def cascade(
    chunks: DataFrame,
    queries: DataFrame,
    links: DataFrame | None = None,
    k_a: int = K_A,
    k_b: int = K_B,
    k_c: int = K_C,
    method: str = "weighted_sum",
    w_bm25: float = W_BM25,
    w_dense: float = W_DENSE,
    rescore_depth: int | None = None,
    judge_depth: int | None = None,
    max_len: int | None = None,
    clip: bool = True,
    calibration: str = "minmax",
    labels: DataFrame | None = None,
    scorer: rerank.Scorer | None = None,
    lexical_search: Search | None = None,
    dense_search: Search | None = None,
    rescorer: Rescorer | None = None,
) -> Cascade:
    """All three stages for a batch of queries.

    Stage A finds by substrings and by the presence of terms unless other searches are
    given, such as `bm25.bm25_top_k` or a `dense.cosine_top_k` over the chunks' vectors; stage
    B counts matching words unless a `rescorer` is given.

    The chunks are scanned twice: once to search, once to fetch the texts of the
    candidates, which both later stages then carry along.
    """
    if lexical_search is None and dense_search is None:
        found = stage(lexical.search(chunks, queries, k_a))
        merged = fusion.merge_sides(found)
    else:
        first = stage((lexical_search or lexical.lexical_top_k)(chunks, queries, k_a))
        second = stage((dense_search or lexical.presence_top_k)(chunks, queries, k_a))
        rows = [
            df.select("query_id", "chunk_id", "rank", F.lit(side).alias("side"))
            for df, side in ((first, LEXICAL), (second, PRESENCE))
        ]
        found = rows[0].unionByName(rows[1])
        merged = fusion.merge_lists(first, second)
    fused = stage(fusion.fuse(merged, k_a, method, w_bm25, w_dense))
    depth = rescore_depth or k_b
    with_text = rerank.attach_chunks(fused.where(F.col("rank") <= depth), chunks)
    if rescorer is None:
        rescored = rerank.rescore(with_text, queries, k=k_b, depth=depth, max_len=max_len)
    else:
        rescored = rescorer(with_text, queries, k_b)
    rescored = stage(rescored)
    final = rerank.judge(
        rescored,
        queries,
        links=links,
        k=k_c,
        depth=judge_depth,
        clip=clip,
        calibration=calibration,
        labels=labels,
        scorer=scorer,
    )
    return Cascade(found, fused, rescored, stage(final))


def stage_counts(run: Cascade, chunks: DataFrame, queries: DataFrame) -> DataFrame:
    """Per query: chunks, both result counts, rows of each stage, patients attached."""
    linked = F.col("patient_uid").isNotNull() if "patient_uid" in run.final.columns else F.lit(False)
    sources = {
        "bm25_results": (run.found, F.col("side") == LEXICAL),
        "dense_results": (run.found, F.col("side") == PRESENCE),
        "final_candidates": (run.candidates, F.lit(True)),
        "rescored_candidates": (run.rescored, F.lit(True)),
        "final_results": (run.final, F.lit(True)),
        "patient_uid_attached": (run.final, linked),
    }
    counts = queries.select("query_id")
    for name, (frame, condition) in sources.items():
        per_query = frame.groupBy("query_id").agg(F.count_if(condition).alias(name))
        counts = counts.join(per_query, "query_id", "left")
    total = chunks.agg(F.count(F.lit(1))).first()[0]
    return counts.fillna(0).withColumn("total_chunks", F.lit(total).cast("long"))

"""Re-scoring of candidates: late interaction, cross scoring, patients of the results.

All scoring works inside the row: the query's terms and the chunk's words are arrays, and
no term-word pairs are emitted as rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinseek.fixed_values import (
    CROSS_OVERLAP_WEIGHT,
    CROSS_TERM_WEIGHT,
    EVIDENCE_ITEMS,
    INTERACTION_WEIGHT,
    K_B,
    K_C,
)
from kinseek.functions.text import contains_either_way, or_empty, tokens
from kinseek.operators.calibrate import calibrate
from kinseek.operators.query_batch import query_tokens, small_or_plain
from kinseek.operators.ranking import SCORE_DIGITS, top_k
from kinseek.runtime import stage

CHUNK_FIELDS = ("text", "offset", "source_file")
Scorer = Callable[[Iterator[tuple[pd.Series, pd.Series]]], Iterator[pd.Series]]


def attach_chunks(candidates: DataFrame, chunks: DataFrame) -> DataFrame:
    """Candidates with their chunk's text and pointers; unknown chunks drop out.

    The candidates are materialised, so their number is known: where it is small they go
    to every task and the chunks are scanned without a shuffle.
    """
    wanted = stage(candidates)
    found = chunks.select("chunk_id", *CHUNK_FIELDS)
    return found.join(small_or_plain(wanted), "chunk_id").select(*wanted.columns, *CHUNK_FIELDS)


def _with_text(candidates: DataFrame, chunks: DataFrame | None) -> DataFrame:
    if "text" in candidates.columns:
        return candidates
    if chunks is None:
        raise ValueError("candidates carry no text, so chunks must be given")
    return attach_chunks(candidates, chunks)


def interaction_count(terms: Column, words: Column) -> Column:
    """Term-word pairs in which either string contains the other."""
    return F.aggregate(
        terms,
        F.lit(0),
        lambda n, t: n + F.size(F.filter(words, lambda w: contains_either_way(t, w))),
    )


def interaction_score(terms: Column, words: Column) -> Column:
    """Weighted matches per query term, at most 1; 0 for a query without terms."""
    score = F.lit(INTERACTION_WEIGHT) * interaction_count(terms, words) / F.size(terms)
    return F.when(F.size(terms) == 0, 0.0).otherwise(F.least(score, F.lit(1.0)))


def interaction_evidence(terms: Column, words: Column, items: int = EVIDENCE_ITEMS) -> Column:
    """The first matches by term, then word position; null where there are none."""
    placed = F.transform(
        words,
        lambda w, i: F.struct(
            w.alias("token"), F.lit(INTERACTION_WEIGHT).alias("weight"), i.alias("pos")
        ),
    )
    matches = F.flatten(
        F.transform(
            terms, lambda t: F.filter(placed, lambda w: contains_either_way(t, w["token"]))
        )
    )
    return F.when(F.size(matches) > 0, F.slice(matches, 1, items))


def rescore(
    candidates: DataFrame,
    queries: DataFrame,
    chunks: DataFrame | None = None,
    k: int = K_B,
    depth: int | None = None,
    max_len: int | None = None,
    evidence: bool = True,
) -> DataFrame:
    """Late-interaction scores for each query's first `depth` candidates, best `k` kept.

    `depth` is `k` unless given. `max_len` scores only that many leading words; it is off
    unless given. Ties keep the order of the candidates.
    """
    taken = _with_text(candidates.where(F.col("rank") <= (depth or k)), chunks)
    words = tokens(F.col("text"))
    if max_len is not None:
        words = F.slice(words, 1, max_len)
    asked = small_or_plain(query_tokens(queries))
    both = taken.join(asked, "query_id").withColumn("words", words)
    scored = both.withColumn("s_li", interaction_score(F.col("terms"), F.col("words")))
    if evidence:
        scored = scored.withColumn(
            "evidence", interaction_evidence(F.col("terms"), F.col("words"))
        )
    scored = scored.withColumnRenamed("rank", "_before").drop("terms", "words")
    order = [F.round("s_li", SCORE_DIGITS).desc(), F.asc("_before")]
    return top_k(scored, ["query_id"], order, k).drop("_before")


def cross_score(terms: Column, text: Column, clip: bool = True) -> Column:
    """Present terms plus letter overlap of every term-word pair longer than 2 letters."""
    lowered = F.lower(or_empty(text))
    present = F.size(F.filter(terms, lambda t: F.contains(lowered, t)))
    letters = lambda words: F.transform(
        F.filter(words, lambda w: F.length(w) > 2), lambda w: F.array_distinct(F.split(w, ""))
    )
    of_words = letters(tokens(text))

    def overlap(a, b):
        shared = F.size(F.array_intersect(a, b))
        return shared / (F.size(a) + F.size(b) - shared)

    total = F.aggregate(
        letters(terms),
        F.lit(0.0),
        lambda s, t: s + F.aggregate(of_words, F.lit(0.0), lambda p, w: p + overlap(t, w)),
    )
    score = CROSS_TERM_WEIGHT * present + CROSS_OVERLAP_WEIGHT * total
    return F.least(score, F.lit(1.0)) if clip else score


def judge(
    rescored: DataFrame,
    queries: DataFrame,
    chunks: DataFrame | None = None,
    links: DataFrame | None = None,
    k: int = K_C,
    depth: int | None = None,
    clip: bool = True,
    calibration: str = "minmax",
    labels: DataFrame | None = None,
    scorer: Scorer | None = None,
) -> DataFrame:
    """Cross scores for each query's first `depth` results, calibrated, best `k` kept.

    `scorer` replaces the built-in formula: a function over batches of (query, text)
    pairs, called once per task so that it can load a model. `labels` (score, label) feed
    isotonic or Platt calibration. `links` attach a patient by chunk or by note.
    """
    taken = _with_text(rescored.where(F.col("rank") <= (depth or k)), chunks)
    if scorer is None:
        asked = taken.join(small_or_plain(query_tokens(queries)), "query_id")
        raw = cross_score(F.col("terms"), F.col("text"), clip)
    else:
        asked = taken.join(small_or_plain(queries.select("query_id", "query")), "query_id")
        raw = _as_udf(scorer)(or_empty(F.col("query")), or_empty(F.col("text")))
    scored = calibrate(asked.withColumn("raw_xenc_score", raw), calibration, labels)
    order = [F.round("calibrated_score", SCORE_DIGITS).desc(), F.asc("_before")]
    ranked = top_k(scored.withColumnRenamed("rank", "_before"), ["query_id"], order, k)
    results = ranked.select(
        "query_id",
        "chunk_id",
        "calibrated_score",
        "raw_xenc_score",
        "s_li",
        "fusion_score",
        or_empty(F.col("source_id")).alias("source_id"),
        F.struct(
            F.coalesce("offset", F.lit(0)).alias("chunk_offset"),
            or_empty(F.col("source_file")).alias("file"),
        ).alias("pointers"),
        "note_uid",
        "rank",
    )
    return results if links is None else attach_patients(results, links)


def _as_udf(scorer: Scorer):
    def run(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        yield from scorer(pairs)

    return F.pandas_udf(run, "double")


def attach_patients(
    results: DataFrame, links: DataFrame, order: str | None = None
) -> DataFrame:
    """Add patient_uid from links keyed by chunk_id, or by note_uid where they have none.

    The results are few and materialised, so the link table is filtered by their keys
    before anything else. Of several links with one key the last in `order` counts: that of
    the last `line` where no order is given but the links have one, else the largest uid.
    """
    if order is None and "line" in links.columns:
        order = "line"
    key = "chunk_id" if "chunk_id" in links.columns else "note_uid"
    results = stage(results)
    keys = small_or_plain(results.select(key).distinct())
    wanted = links.where(f"{key} <> '' AND patient_uid <> ''").join(keys, key, "left_semi")
    last = F.max("patient_uid") if order is None else F.max_by("patient_uid", order)
    return results.join(
        wanted.groupBy(key).agg(last.alias("patient_uid")), key, "left"
    ).select(*results.columns, "patient_uid")

"""BM25 over white-space tokens."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinseek.fixed_values import BM25_B, BM25_K1, K_A
from kinseek.functions.text import tokens
from kinseek.operators.lexical import CARRY
from kinseek.operators.query_batch import Block, blocks, distinct_terms
from kinseek.operators.ranking import SCORE_DIGITS, SPREAD, top_k
from kinseek.operators.score_blocks import (
    BestRows,
    TermWeights,
    queries_per_block,
    rows_per_block,
)
from kinseek.runtime import stage


def _asked_words(terms: list[str], carry: Sequence[str]):
    """Words of each chunk to its length and the numbers of those that a query asks for."""

    def run(batches):
        for batch in batches:
            words = batch.column("words")
            asked = pa.array(terms, words.type.value_type)
            number = pc.index_in(words.flatten(), value_set=asked)
            inside = np.concatenate([[0], np.cumsum(number.is_valid().to_numpy(False))])
            length = pc.list_value_length(words)
            ends = np.cumsum(length.to_numpy(zero_copy_only=False))
            offsets = inside[np.concatenate([[0], ends])].astype(np.int32)
            matched = pa.ListArray.from_arrays(pa.array(offsets), number.drop_null())
            kept = [batch.column(c) for c in ("chunk_id", *carry)]
            yield pa.RecordBatch.from_arrays(
                [*kept, length, matched], ["chunk_id", *carry, "length", "matched"]
            )

    return run


def _scorer(block: Block, terms, idf, average_length, k, k1, b, carry):
    number = {term: i for i, term in enumerate(terms)}
    query_ids = np.array([query_id for query_id, _ in block], dtype=np.int64)
    entries = [
        (number[term], q, times * idf.get(number[term], 0.0))
        for q, (_, words) in enumerate(block)
        for term, times in Counter(words).items()
    ]

    def run(batches):
        weights = TermWeights.build(entries, len(terms), len(block))
        best = BestRows(query_ids, k, positive=True)
        step = rows_per_block(len(block))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                length = part.column("length").to_numpy(zero_copy_only=False)
                matched = part.column("matched")
                found = matched.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                sizes = pc.list_value_length(matched).to_numpy(zero_copy_only=False)
                cells = np.repeat(np.arange(part.num_rows), sizes) * len(terms) + found
                cells, tf = np.unique(cells, return_counts=True)
                rows, term = np.divmod(cells, len(terms))
                norm = k1 * (1 - b + b * length[rows] / average_length)
                scores = weights.scores(rows, term, tf * (k1 + 1) / (tf + norm), part.num_rows)
                rows_kept = part.select(["chunk_id", *carry])
                best.add(rows_kept, np.round(scores, SCORE_DIGITS))
        yield from best.batches(pa.float64(), {})

    return run


def bm25_top_k(
    chunks: DataFrame,
    queries: DataFrame,
    k: int = K_A,
    k1: float = BM25_K1,
    b: float = BM25_B,
    carry: Sequence[str] = CARRY,
) -> DataFrame:
    """Top `k` chunks per query: score and rank.

    One pass over the texts keeps each chunk's length and those of its words that some
    query asks for; corpus statistics and scores come from that slim table. A term
    repeated in a query counts each time. Scores are rounded to 9 digits, so that equal
    chunks tie, and ties go by chunk id. `carry` names string columns to keep.
    """
    kept = ", ".join(f"{c} string" for c in ("chunk_id", *carry))
    found = []
    for block in blocks(queries, max_queries=queries_per_block(k)):
        if not block:
            continue
        terms = distinct_terms(block)
        words = chunks.select("chunk_id", *carry, tokens(F.col("text")).alias("words"))
        slim = stage(
            words.mapInArrow(
                _asked_words(terms, carry), f"{kept}, length int, matched array<int>"
            )
        )
        n, total = slim.agg(F.count(F.lit(1)), F.sum("length")).first()
        held = slim.select(F.explode(F.array_distinct("matched")).alias("term"))
        idf = {
            term: float(np.log(1 + (n - df + 0.5) / (df + 0.5)))
            for term, df in held.groupBy("term").count().collect()
        }
        average = total / n if total else 1.0
        run = _scorer(block, terms, idf, average, k, k1, b, carry)
        scored = slim.where(F.size("matched") > 0).mapInArrow(
            run, f"{kept}, query_id long, score double"
        )
        found.append(scored)
    if not found:
        empty = chunks.where("false").select("chunk_id", *carry)
        found.append(empty.selectExpr("*", "0L AS query_id", "0D AS score"))
    order = [F.desc("score"), F.asc("chunk_id")]
    return top_k(
        reduce(DataFrame.unionByName, found), ["query_id"], order, k, spread=SPREAD
    )

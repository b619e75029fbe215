"""Substring search: how often each query term occurs in each chunk's whole text.

A term may occur inside a word. Two scores come from one scan: the lexical score counts
occurrences, the presence score counts the terms that occur at all; a term repeated in
the query counts each time. Only positive scores are results.

Small batches become plain column expressions. Larger ones are matched in one pass by an
Aho-Corasick automaton of all terms.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinseek.fixed_values import K_A, LEXICAL_WEIGHT, PRESENCE_WEIGHT
from kinseek.functions.text import occurrences, or_empty, tokens
from kinseek.operators.query_batch import BLOCK_TERMS, Block, blocks, distinct_terms
from kinseek.operators.ranking import SPREAD, top_k
from kinseek.operators.score_blocks import (
    BestRows,
    TermWeights,
    queries_per_block,
    rows_per_block,
    spread,
)

try:
    import ahocorasick
except ImportError:  # large batches then take several passes of column expressions
    ahocorasick = None

INLINE_TERMS = 64
CACHED_WORDS = 200_000
CARRY = ("source_id", "note_uid")
LEXICAL, PRESENCE = "lexical", "presence"


def _inline_hits(chunks: DataFrame, block: Block, carry, sides) -> DataFrame:
    terms = distinct_terms(block)
    counted = chunks.select(
        "chunk_id", *carry, F.lower(or_empty(F.col("text"))).alias("_lowered")
    ).select(
        "chunk_id",
        *carry,
        *[occurrences(F.col("_lowered"), t).alias(f"_n{i}") for i, t in enumerate(terms)],
    )
    column = {term: F.col(f"_n{i}") for i, term in enumerate(terms)}
    hits = []
    for query_id, words in block:
        amounts = {
            LEXICAL: sum(column[w] for w in words),
            PRESENCE: sum(F.when(column[w] > 0, 1).otherwise(0) for w in words),
        }
        for side in sides:
            hit = F.struct(
                F.lit(query_id).cast("long").alias("query_id"),
                F.lit(side).alias("side"),
                amounts[side].cast("long").alias("hits"),
            )
            hits.append(F.when(amounts[side] > 0, hit))
    # Only what was found becomes a row, not each chunk with each query.
    return counted.select("chunk_id", *carry, F.inline(F.array_compact(F.array(*hits))))


def _matcher(block: Block, k: int, carry, sides):
    """A function over Arrow batches (chunk_id, carried columns, words).

    No term holds white space, so its occurrences in a text are those in the words. The
    automaton therefore only reads the distinct words of a batch.
    """
    terms = distinct_terms(block)
    number = {term: i for i, term in enumerate(terms)}
    query_ids = np.array([query_id for query_id, _ in block], dtype=np.int64)
    entries = [
        (number[word], q, times)
        for q, (_, words) in enumerate(block)
        for word, times in Counter(words).items()
    ]

    def run(batches):
        weights = TermWeights.build(entries, len(terms), len(block))
        automaton = ahocorasick.Automaton()
        for i, term in enumerate(terms):
            automaton.add_word(term, (i, len(term)))
        automaton.make_automaton()

        @lru_cache(CACHED_WORDS)
        def count(word):
            counts, used = {}, {}
            for end, (i, length) in automaton.iter(word):
                if used.get(i, -1) <= end - length:
                    counts[i] = counts.get(i, 0) + 1
                    used[i] = end
            return counts

        def occurrences_in(words: pa.ListArray):
            """Row, term and number of occurrences, one entry per row and term."""
            coded = words.flatten().dictionary_encode()
            found = [count(word) for word in coded.dictionary.to_pylist()]
            starts = np.concatenate([[0], np.cumsum([len(c) for c in found], dtype=np.int64)])
            term = np.array([i for c in found for i in c], dtype=np.int64)
            times = np.array([n for c in found for n in c.values()], dtype=np.float64)
            sizes = pc.list_value_length(words).to_numpy(zero_copy_only=False)
            at, per_word = spread(starts, coded.indices.to_numpy().astype(np.int64))
            row = np.repeat(np.repeat(np.arange(len(sizes)), sizes), per_word)
            cells, place = np.unique(row * len(terms) + term[at], return_inverse=True)
            rows, of_term = np.divmod(cells, len(terms))
            return rows, of_term, np.bincount(place, weights=times[at], minlength=len(cells))

        best = {side: BestRows(query_ids, k, positive=True) for side in sides}
        step = rows_per_block(len(block))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                rows, term, times = occurrences_in(part.column("words"))
                for side in sides:
                    values = times if side == LEXICAL else np.ones_like(times)
                    scores = weights.scores(rows, term, values, part.num_rows)
                    best[side].add(part.select(["chunk_id", *carry]), scores)
        for side in sides:
            yield from best[side].batches(pa.int64(), {"side": side})

    return run


def _matched_hits(chunks: DataFrame, block: Block, k: int, carry, sides) -> DataFrame:
    source = chunks.select("chunk_id", *carry, tokens(F.col("text")).alias("words"))
    kept = ", ".join(f"{c} string" for c in ("chunk_id", *carry))
    return source.mapInArrow(
        _matcher(block, k, carry, sides), f"{kept}, query_id long, side string, hits long"
    )


def search(
    chunks: DataFrame,
    queries: DataFrame,
    k: int = K_A,
    sides: Sequence[str] = (LEXICAL, PRESENCE),
    carry: Sequence[str] = CARRY,
    inline_terms: int = INLINE_TERMS,
) -> DataFrame:
    """Top `k` chunks of every query on each side: hits, side and rank.

    Equal scores are ranked by chunk id. `carry` names string columns of `chunks` to keep.
    """
    max_terms = inline_terms if ahocorasick is None else BLOCK_TERMS
    found = []
    for block in blocks(queries, max_terms, queries_per_block(k)):
        if not block:
            continue
        if ahocorasick is None or len(distinct_terms(block)) <= inline_terms:
            found.append(_inline_hits(chunks, block, carry, sides))
        else:
            found.append(_matched_hits(chunks, block, k, carry, sides))
    if not found:
        empty = chunks.where("false").select("chunk_id", *carry)
        found.append(
            empty.selectExpr("*", "0L AS query_id", "'' AS side", "0L AS hits")
        )
    hits = reduce(DataFrame.unionByName, found)
    order = [F.desc("hits"), F.asc("chunk_id")]
    return top_k(hits, ["query_id", "side"], order, k, spread=SPREAD)


def _scored(found: DataFrame, weight: float) -> DataFrame:
    return found.withColumn("score", F.col("hits") * weight).drop("side")


def lexical_top_k(chunks: DataFrame, queries: DataFrame, k: int = K_A, **options) -> DataFrame:
    return _scored(search(chunks, queries, k, (LEXICAL,), **options), LEXICAL_WEIGHT)


def presence_top_k(chunks: DataFrame, queries: DataFrame, k: int = K_A, **options) -> DataFrame:
    return _scored(search(chunks, queries, k, (PRESENCE,), **options), PRESENCE_WEIGHT)

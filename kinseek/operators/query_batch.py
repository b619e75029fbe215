"""Query batches: a table of queries as terms, in pieces small enough to ship to tasks.

Scoring a chunk against a batch needs the batch in every task. It is therefore collected
in blocks of bounded size, each of which takes one pass over the chunks; a batch that
fits one block, the usual case, takes a single pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinseek.functions.text import tokens

BLOCK_TERMS = 200_000
BLOCK_QUERIES = 20_000
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 256 << 20

Block = list[tuple[int, list[str]]]


def query_tokens(queries: DataFrame) -> DataFrame:
    return queries.select("query_id", tokens(F.col("query")).alias("terms"))


def blocks(
    queries: DataFrame, max_terms: int = BLOCK_TERMS, max_queries: int = BLOCK_QUERIES
) -> Iterator[Block]:
    """The queries with their terms, in blocks of about `max_terms` terms."""
    parsed = query_tokens(queries)
    count, terms = parsed.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
    parts = max(1, ceil(count / max_queries), ceil(terms / max_terms))
    for part in range(parts):
        chosen = F.pmod(F.xxhash64("query_id"), F.lit(parts)) == part
        yield _block((parsed.where(chosen) if parts > 1 else parsed).collect())


def _block(rows: list) -> Block:
    """Queries without terms find nothing and are left out."""
    return [(row["query_id"], list(row["terms"])) for row in rows if row["terms"]]


def distinct_terms(block: Block) -> list[str]:
    return sorted({term for _, terms in block for term in terms})


def small_or_plain(df: DataFrame, limit: int = BROADCAST_ROWS, most: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a materialised or cheap table for broadcast if it is small in rows and in bytes."""
    if df.limit(limit + 1).count() > limit:
        return df
    texts = [F.sum(F.octet_length(F.to_json(F.struct(c)))) for c in df.columns]
    size = sum(x or 0 for x in df.agg(*texts).first())
    return F.broadcast(df) if size <= most else df

"""Scores of a block of rows against a batch of queries, as numpy matrices inside tasks.

Only a task's best `k` rows per query leave it, so a batch of Q queries over N chunks
never turns into N x Q rows. Spark still does the scan, the partitioning and the final
ranking.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CELLS = 8_000_000  # scores held at once, per task
KEPT = 2_000_000  # best rows held at once, per task


def queries_per_block(k: int) -> int:
    """How many queries a task can hold the `k` best rows of."""
    return max(1, KEPT // k)


def spread(starts: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions starts[i] .. starts[i + 1] for every i of `index`, and how many each has."""
    counts = starts[index + 1] - starts[index]
    ends = np.cumsum(counts)
    inside = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)
    return np.repeat(starts[index], counts) + inside, counts


@dataclass(frozen=True)
class TermWeights:
    """Sparse terms x queries matrix in compressed row form."""

    starts: np.ndarray
    columns: np.ndarray
    weights: np.ndarray
    n_queries: int

    @classmethod
    def build(cls, entries: list[tuple[int, int, float]], n_terms: int, n_queries: int):
        """From (term, query, weight) entries; equal cells add up."""
        term, query, weight = (np.array(column) for column in zip(*entries)) if entries else (np.zeros(0, np.int64),) * 3
        order = np.argsort(term, kind="stable")
        starts = np.searchsorted(term[order], np.arange(n_terms + 1))
        return cls(starts, query[order].astype(np.int64), weight[order], n_queries)

    def cells(self, rows, terms, values, alive=None, block: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, query and sum of values[i] * weight[terms[i], query], where there is any.

        With `alive` (blocks of `block` rows x queries) only for the cells it allows.
        """
        at, counts = spread(self.starts, np.asarray(terms, dtype=np.int64))
        row, query = np.repeat(np.asarray(rows, dtype=np.int64), counts), self.columns[at]
        amounts = np.repeat(np.asarray(values, dtype=np.float64), counts) * self.weights[at]
        if alive is not None:
            keep = alive[row // block, query]
            row, query, amounts = row[keep], query[keep], amounts[keep]
        cells = row * self.n_queries + query
        cells, place = np.unique(cells, return_inverse=True)
        row, query = np.divmod(cells, max(1, self.n_queries))
        return row, query, np.bincount(place, weights=amounts, minlength=len(cells)).astype(np.float64)

    def scores(self, rows, terms, values, n_rows: int) -> np.ndarray:
        """rows x queries sums of values[i] * weight[terms[i], query]."""
        at, counts = spread(self.starts, np.asarray(terms, dtype=np.int64))
        cells = np.repeat(np.asarray(rows, dtype=np.int64), counts) * self.n_queries
        cells += self.columns[at]
        amounts = np.repeat(np.asarray(values, dtype=np.float64), counts) * self.weights[at]
        flat = np.bincount(cells, weights=amounts, minlength=n_rows * self.n_queries)
        return flat.reshape(n_rows, self.n_queries)


def rows_per_block(n_queries: int) -> int:
    return max(1, CELLS // max(1, n_queries))


def best_rows(scores: np.ndarray, ids: list, k: int, positive: bool) -> tuple[np.ndarray, ...]:
    """Row and query indexes of each query's `k` best rows; equal scores go by id.

    Rows that cannot be kept, and scores that are no numbers, take no place.
    """
    scores = np.where(np.isfinite(scores), scores, -np.inf)
    some = np.flatnonzero((scores > (0 if positive else -np.inf)).any(1))
    if len(some) < len(ids):
        at, query = best_rows(scores[some], [ids[i] for i in some], k, positive) if len(some) else (some, some)
        return some[at], query
    by_id = np.array(sorted(range(len(ids)), key=ids.__getitem__), dtype=np.int64)
    ordered = scores[by_id]
    keep = np.ones(ordered.shape, dtype=bool)
    if len(ids) > k:
        last = len(ids) - k
        cut = np.partition(ordered, last, axis=0)[last]
        above, level = ordered > cut, ordered == cut
        room = k - above.sum(axis=0)
        keep = above | (level & (np.cumsum(level, axis=0) <= room))
    keep &= ordered > (0 if positive else -np.inf)
    rows, queries = np.nonzero(keep)
    return by_id[rows], queries


class BestRows:
    """The `k` best rows per query over all blocks of a task.

    A row that ties with a query's k-th best is kept until ids have decided.
    """

    def __init__(self, query_ids: np.ndarray, k: int, positive: bool):
        self.query_ids, self.k, self.positive = query_ids, k, positive
        self.floor = np.full(len(query_ids), -np.inf)
        self.held: list[pa.RecordBatch] = []
        self.size = 0

    def add(self, rows: pa.RecordBatch, scores: np.ndarray) -> None:
        """`rows` carry a chunk_id; `scores` has a column per query."""
        scores = np.where(np.isfinite(scores), scores, -np.inf)
        some = np.flatnonzero((scores > (0 if self.positive else -np.inf)).any(1) & (scores >= self.floor).any(1))
        if not len(some):
            return
        rows, scores = rows.take(pa.array(some)), scores[some]
        ids = rows.column("chunk_id").to_pylist()
        at, query = best_rows(scores, ids, self.k, self.positive)
        value = scores[at, query]
        keep = value >= self.floor[query]
        at, query, value = at[keep], query[keep], value[keep]
        if not len(at):
            return
        taken = rows.take(pa.array(at))
        self.held.append(
            pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(query), pa.array(value)],
                [*rows.schema.names, "_query", "_score"],
            )
        )
        self.size += len(at)
        if self.size > 2 * max(self.k * len(self.query_ids), 10_000):
            self._prune()

    def _prune(self) -> None:
        table = pa.Table.from_batches(self.held)
        keys = [("_query", "ascending"), ("_score", "descending"), ("chunk_id", "ascending")]
        table = table.take(pc.sort_indices(table, sort_keys=keys))
        query = table.column("_query").to_numpy()
        place = np.arange(len(query)) - np.searchsorted(query, query)
        full = place == self.k - 1
        self.floor[query[full]] = table.column("_score").to_numpy()[full]
        self.held = table.filter(pa.array(place < self.k)).combine_chunks().to_batches()
        self.size = sum(batch.num_rows for batch in self.held)

    def batches(self, score_type: pa.DataType, extra: dict) -> Iterator[pa.RecordBatch]:
        """The kept rows: their own columns, query_id, the constants of `extra`, the score."""
        if not self.held:
            return
        self._prune()
        for batch in self.held:
            query, score = batch.column("_query").to_numpy(), batch.column("_score")
            constants = [pa.array([v] * batch.num_rows) for v in extra.values()]
            names = [n for n in batch.schema.names if not n.startswith("_")]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(n) for n in names],
                    pa.array(self.query_ids[query]),
                    *constants,
                    score.cast(score_type),
                ],
                [*names, "query_id", *extra, "hits" if extra else "score"],
            )

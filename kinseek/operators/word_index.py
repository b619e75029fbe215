"""A kept inverted index of chunks, in segments, and searches that skip segments by score bounds.

A segment is some thousand chunks of one scan task. Consecutive segments of a task make a
volume, which is one row: its distinct words, and packed for each segment which chunks (by place
in the segment) hold which word how often, the chunks' lengths, ids and carried columns.
Building shuffles nothing, a frequent word is in every volume and so is spread over all tasks,
and there is no row per chunk or word.

`postings` has a row for each word of a segment: its chunks and counts, next to bounds, which are
the shortest chunk for each count. It is unpacked where it is asked for; `write` keeps it beside the
volumes, its rows in their files in the order of words, so that a search for few whole words
reads those only.

A search first adds up the best score that each query can reach in each segment. The segments of
the best bounds that surely hold `k` chunks are scored first; the k-th score found is a floor, and
segments that cannot reach it are left out. In those that can, so are the blocks of `BLOCK_ROWS`
chunks whose terms' greatest values do not add up to it. What is left is scored too, so results
are exact. A task lets through only what is among the `k` best of a query that it has seen so far,
so that the rows it hands on grow with the logarithm of its segments, also where scores tie.

A term is a word (BM25) or any part of one (lexical and presence scores). For parts, the words
of a volume are matched to all terms once, in the task that reads it. How often each term occurs in
each chunk is kept for the rest of the search, so that no posting is joined or shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinseek.fixed_values import BM25_B, BM25_K1, K_A, LEXICAL_WEIGHT, PRESENCE_WEIGHT
from kinseek.functions.text import or_empty
from kinseek.operators.lexical import CARRY, LEXICAL, PRESENCE
from kinseek.operators.query_batch import Block, blocks, distinct_terms, small_or_plain
from kinseek.operators.ranking import SCORE_DIGITS, SPREAD, top_k
from kinseek.operators.score_blocks import CELLS, TermWeights, queries_per_block, spread
from kinseek.runtime import stage

try:
    import ahocorasick
except ImportError:  # terms are then looked for one by one
    ahocorasick = None

SEGMENT_ROWS = 2048
VOLUME_ROWS = 1 << 16  # chunks after which a volume ends
VOLUME_WORDS = 1 << 21  # words in its texts after which it does
MATCHED_WORDS = 1 << 16  # words that are matched to terms at once
BLOCK_ROWS = 64  # chunks of a segment that are left out together
BM25 = "bm25"
SLACK = 1e-6  # by which a bound may lie below the score it bounds, for rounding
FEW_WORDS = 200  # that reach the scan of a kept index as a filter
# Rows of megabytes: without these a row group's size is first looked at after 100 of them.
LARGE_ROWS = {"parquet.block.size": str(16 << 20), "parquet.page.size.row.check.min": "1"}
NUMBERS = ("rows", "counts", "lengths", "peak_counts", "peak_lengths")


@dataclass(frozen=True)
class WordIndex:
    """`volumes` as packed; `kept` has the rows that `write` unpacked, of an index that was loaded."""

    volumes: DataFrame
    carry: tuple[str, ...]
    kept: DataFrame | None = None

    @property
    def rows(self) -> DataFrame:
        """The postings of all segments and one row without a word for each segment."""
        return self._unpacked() if self.kept is None else self.kept

    @property
    def postings(self) -> DataFrame:
        return self.rows.where("word is not null")

    @property
    def segments(self) -> DataFrame:
        """`segment`, and per chunk its `lengths`, `ids` and carried columns."""
        rows = self._unpacked([]) if self.kept is None else self.kept
        return rows.where("word is null").select("segment", "lengths", "ids", *self.carry)

    def postings_of(self, words: list[str]) -> DataFrame:
        """Postings, of a kept index those of other words as well if `words` are many."""
        if self.kept is None:
            return self._unpacked(words).where("word is not null")
        # Few words reach the scan as a filter, so that it skips what lies between them.
        return self.postings.where(F.col("word").isin(words)) if len(words) <= FEW_WORDS else self.postings

    def _unpacked(self, words: list[str] | None = None) -> DataFrame:
        kinds = [f"{c} array<int>" for c in NUMBERS] + [f"{c} array<string>" for c in ("ids", *self.carry)]
        packed = self.volumes.select("segment", "packed")
        return packed.mapInArrow(_rows_of(self.carry, words), f"segment long, word string, {', '.join(kinds)}")

    def write(self, path: str) -> None:
        self.volumes.write.options(**LARGE_ROWS).mode("overwrite").parquet(f"{path}/volumes")
        self.rows.sortWithinPartitions("word", "segment").write.mode("overwrite").parquet(f"{path}/postings")

    def statistics(self) -> tuple[int, int]:
        """Number of chunks, and words in all of them."""
        row = self.volumes.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("chunks", "total")]).first()
        return row[0], row[1]


def load_index(spark: SparkSession, path: str) -> WordIndex:
    rows = spark.read.parquet(f"{path}/postings")
    return WordIndex(spark.read.parquet(f"{path}/volumes"), tuple(rows.columns[rows.columns.index("ids") + 1 :]), rows)


def _lists(values: np.ndarray, heads: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(heads, len(values)), pa.int32()), pa.array(values.astype(np.int32)))


def _packed(columns: Mapping[str, pa.Array | np.ndarray]) -> bytes:
    """Columns of any lengths, compressed; numbers (none below zero) as narrow as they can be."""
    arrays = []
    for values in columns.values():
        if isinstance(values, np.ndarray):
            values = pa.array(values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0)))
        arrays.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values))
    batch, sink = pa.RecordBatch.from_arrays(arrays, list(columns)), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _columns(packed: pa.Scalar) -> dict[str, pa.Array]:
    batch = pa.ipc.open_stream(packed.as_buffer()).read_next_batch()
    return {name: batch.column(i).flatten() for i, name in enumerate(batch.schema.names)}


def _numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64)


def _steps(keys: np.ndarray) -> np.ndarray:
    """Ascending keys as differences, which pack well; `np.cumsum` undoes it."""
    return np.diff(keys, prepend=0)


def _split(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The white-space tokens of lower-case texts as `tokens` finds them, and how many each text has."""
    listed = pc.utf8_split_whitespace(text)
    words, sizes = listed.flatten(), pc.list_value_length(listed).to_numpy(zero_copy_only=False)
    some = pc.not_equal(words, "")
    row = np.repeat(np.arange(len(text)), sizes)[some.to_numpy(zero_copy_only=False)]
    return words.filter(some), np.bincount(row, minlength=len(text))


def _volume(parts: list[tuple[pa.RecordBatch, pa.Array, np.ndarray]], carry: Sequence[str]) -> bytes:
    """Segments as (chunks, words, words per chunk) in one row: cells are words x chunks of a segment."""
    coded = pa.concat_arrays([words for _, words, _ in parts]).dictionary_encode()
    code, start = coded.indices.to_numpy().astype(np.int64), 0
    steps, counts = [], []
    for part, words, lengths in parts:
        row = np.repeat(np.arange(part.num_rows), lengths)
        cells, count = np.unique(code[start : start + len(words)] * part.num_rows + row, return_counts=True)
        steps.append(_steps(cells))
        counts.append(count)
        start += len(words)
    return _packed(
        {
            "words": coded.dictionary,
            "chunks": np.array([part.num_rows for part, _, _ in parts]),
            "cells": np.array([len(s) for s in steps]),
            "steps": np.concatenate(steps),
            "counts": np.concatenate(counts),
            "lengths": np.concatenate([lengths for _, _, lengths in parts]),
            **{
                name: pa.concat_arrays([part.column(column).cast(pa.string()) for part, _, _ in parts])
                for name, column in [("ids", "chunk_id"), *zip(carry, carry)]
            },
        }
    )


def _parts(volume: dict[str, pa.Array]):
    """Of each segment: word codes and chunks of its cells in that order, counts, the place of its chunks."""
    chunks, cells = _numbers(volume["chunks"]), np.append(0, np.cumsum(_numbers(volume["cells"])))
    steps, counts, start = _numbers(volume["steps"]), _numbers(volume["counts"]), 0
    for i, n in enumerate(chunks.tolist()):
        part = slice(cells[i], cells[i + 1])
        yield *np.divmod(np.cumsum(steps[part]), n), counts[part], slice(start, start + n)
        start += n


def _posting_rows(code, row, counts, lengths, words: pa.Array, number: int, texts: list[pa.Array]) -> list[pa.Array]:
    heads = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, np.int64)
    # The shortest chunk for each count of a word bounds every score that grows with the
    # count and falls with the length.
    order = np.lexsort((lengths[row], counts, code))
    first = np.append(True, (code[order][1:] != code[order][:-1]) | (counts[order][1:] != counts[order][:-1]))[: len(order)]
    peak = order[np.flatnonzero(first)]
    peak_heads = np.flatnonzero(np.append(True, code[peak][1:] != code[peak][:-1]))[: len(heads)]
    n = len(heads)

    def end(column: pa.Array) -> pa.Array:
        """The segment's own row: a list of one column over all chunks."""
        return pa.concat_arrays([pa.nulls(n, pa.list_(column.type)), pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)])

    def with_null(column: pa.ListArray) -> pa.Array:
        return pa.concat_arrays([column, pa.nulls(1, column.type)])

    return [
        pa.array(np.full(n + 1, number)),
        pa.concat_arrays([words.take(pa.array(code[heads])), pa.nulls(1, pa.string())]),
        with_null(_lists(row, heads)),
        with_null(_lists(counts, heads)),
        end(pa.array(lengths.astype(np.int32))),
        with_null(_lists(counts[peak], peak_heads)),
        with_null(_lists(lengths[row][peak], peak_heads)),
        *[end(texts) for texts in texts],
    ]


def _rows_of(carry: Sequence[str], words: list[str] | None):
    """The rows of volumes' segments, with the postings of all words or of those asked for."""

    def run(batches):
        names, asked = ["segment", "word", *NUMBERS, "ids", *carry], pa.array(words or [], pa.string())
        for batch in batches:
            for number, packed in zip(batch.column("segment").to_pylist(), batch.column("packed")):
                volume = _columns(packed)
                lengths = _numbers(volume["lengths"])
                some = None if words is None else pc.is_in(volume["words"], value_set=asked).to_numpy(zero_copy_only=False)
                for i, (code, row, counts, part) in enumerate(_parts(volume)):
                    if some is not None:
                        kept = some[code]
                        code, row, counts = code[kept], row[kept], counts[kept]
                    texts = [volume[c][part] for c in ("ids", *carry)]
                    yield pa.RecordBatch.from_arrays(_posting_rows(code, row, counts, lengths[part], volume["words"], number + i, texts), names)

    return run


def build_index(chunks: DataFrame, carry: Sequence[str] = CARRY, segment_rows: int = SEGMENT_ROWS) -> WordIndex:
    """The index of all white-space tokens of (chunk_id, text), staged; `carry` names string columns."""
    most = max(1, VOLUME_ROWS // segment_rows)

    def run(batches):
        number, parts = TaskContext.get().partitionId() << 32, []

        def volume() -> pa.RecordBatch:
            chunks, total = (sum(x) for x in zip(*[(part.num_rows, len(words)) for part, words, _ in parts]))
            return pa.RecordBatch.from_pydict({"segment": [number], "chunks": [chunks], "total": [total], "packed": [_volume(parts, carry)]})

        for batch in batches:
            for start in range(0, batch.num_rows, segment_rows):
                # Rows that are taken do not hold on to the batch they are from.
                part = batch.slice(start, segment_rows)
                part = part.take(pa.array(np.arange(part.num_rows)))
                parts.append((part.select(["chunk_id", *carry]), *_split(part.column("text"))))
                if len(parts) == most or sum(len(words) for _, words, _ in parts) >= VOLUME_WORDS:
                    yield volume()
                    number, parts = number + len(parts), []
        if parts:
            yield volume()

    # Words are split where they are coded; the text is as `tokens` would read it.
    source = chunks.select("chunk_id", *carry, F.lower(F.make_valid_utf8(or_empty(F.col("text")))).alias("text"))
    return WordIndex(stage(source.mapInArrow(run, "segment long, chunks long, total long, packed binary"), **LARGE_ROWS), tuple(carry))


# --- words to terms -----------------------------------------------------------


def _matcher(terms: list[str]) -> Callable[[list[str]], tuple[np.ndarray, ...]]:
    """A function of words: how many terms each of them holds, and these with how often they are in it."""
    width = np.array([len(term) for term in terms], np.int64)
    machine = None
    if ahocorasick is not None:
        machine = ahocorasick.Automaton()
        for i, term in enumerate(terms):
            machine.add_word(term, i)
        machine.make_automaton()

    def one_by_one(words: list[str]) -> tuple[np.ndarray, ...]:
        found = [[(i, word.count(term)) for i, term in enumerate(terms) if term in word] for word in words]
        cells = np.array([*chain.from_iterable(found)], np.int64).reshape(-1, 2)
        return np.array([len(f) for f in found], np.int64), cells[:, 0], cells[:, 1]

    def at_once(words: list[str]) -> tuple[np.ndarray, ...]:
        # Neither words nor terms hold white space, so no term reaches over the end of a word.
        ends = np.cumsum([len(word) + 1 for word in words])
        hits = np.fromiter(chain.from_iterable(machine.iter("\n".join(words))), np.int64).reshape(-1, 2)
        key = np.searchsorted(ends, hits[:, 0], "right") * len(terms) + hits[:, 1]
        order = np.argsort(key, kind="stable")  # hits of a term stay in order
        key, last = key[order], hits[order, 0]
        heads = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        word, term = np.divmod(key[heads], len(terms))
        times = np.diff(np.append(heads, len(key)))
        close = np.flatnonzero((key[1:] == key[:-1]) & (np.diff(last) < width[key[1:] % len(terms)]))
        for i in np.unique(np.searchsorted(heads, close, "right") - 1):  # occurrences that overlap
            times[i] = words[word[i]].count(terms[term[i]])
        return np.bincount(word, minlength=len(words)), term, times

    def run(words: list[str]) -> tuple[np.ndarray, ...]:
        parts = [words[start : start + MATCHED_WORDS] for start in range(0, len(words), MATCHED_WORDS)] or [[]]
        found = zip(*map(one_by_one if machine is None or not terms else at_once, parts))
        return tuple(np.concatenate(column).astype(np.int32) for column in found)

    return run


def _parts_of_words(terms: list[str]):
    """Every word that holds a term, with the terms' numbers and how often each is in it."""

    def run(batches):
        match = _matcher(terms)
        for batch in batches:
            sizes, held, times = match(batch.column("word").to_pylist())
            some = np.flatnonzero(sizes)
            heads = np.cumsum(sizes[some]) - sizes[some]
            lists = [_lists(held, heads), _lists(times, heads)]
            yield pa.RecordBatch.from_arrays([batch.column("word").take(pa.array(some)), *lists], ["word", "terms", "times"])

    return run


def _words_of(batches):
    for batch in batches:
        for packed in batch.column("packed"):
            yield pa.RecordBatch.from_arrays([_columns(packed)["words"]], ["word"])


def vocabulary(index: WordIndex, terms: list[str], whole_words: bool) -> DataFrame:
    """`word, terms, times` of all words of the corpus that are, or hold, one of `terms`."""
    if whole_words:
        rows = pa.table({"word": terms, "number": np.arange(len(terms), dtype=np.int32)})
        asked = index.volumes.sparkSession.createDataFrame(rows.to_pandas(), "word string, number int")
        return asked.select("word", F.array("number").alias("terms"), F.array(F.lit(1)).alias("times"))
    words = index.volumes.select("packed").mapInArrow(_words_of, "word string").distinct()
    return stage(words.mapInArrow(_parts_of_words(terms), "word string, terms array<int>, times array<int>"))


# --- scores -------------------------------------------------------------------


@dataclass(frozen=True)
class Scoring:
    """What a term that occurs `tf` times in a chunk of a length is worth."""

    kind: str
    k1: float = BM25_K1
    b: float = BM25_B
    average: float = 1.0

    def value(self, tf, length):
        """For numpy arrays and for columns alike."""
        if self.kind == BM25:
            return tf * (self.k1 + 1) / (tf + self.k1 * (1 - self.b + self.b * length / self.average))
        return tf if self.kind == LEXICAL else tf * 0 + 1.0


def _bounds(found: DataFrame, asked: DataFrame, scoring: Scoring) -> DataFrame:
    """`query_id, segment, bound, least`: the best score that can be there, chunks that surely match."""
    pairs = F.arrays_zip(F.col("peak_counts").alias("c"), F.col("peak_lengths").alias("l"))
    best = F.array_max(F.transform(pairs, lambda p: scoring.value(p["c"].cast("double"), p["l"])))
    per_term = found.select("segment", F.size("rows").alias("n"), best.alias("worth"), F.col("terms")[0].alias("term"))
    met = per_term.join(F.broadcast(asked), "term")
    return met.groupBy("query_id", "segment").agg(F.sum(F.col("worth") * F.col("weight")).alias("bound"), F.max("n").alias("least"))


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All values of a column of lists, and the place of every list's first one (and the end)."""
    column = column.combine_chunks()
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def _alive(weights: TermWeights, row, term, value, n_terms: int, floor: np.ndarray) -> np.ndarray:
    """Blocks x queries: where the greatest values of a block's terms can add up to the floor."""
    block = row // BLOCK_ROWS
    key = block * n_terms + term
    order = np.argsort(key, kind="stable")
    heads = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
    blocks_, terms = np.divmod(key[order][heads], n_terms)
    blocks_, query, bound = weights.cells(blocks_, terms, np.maximum.reduceat(value[order], heads))
    alive = np.zeros((int(block.max()) + 1, weights.n_queries), bool)
    alive[blocks_, query] = bound >= floor[query] - SLACK
    return alive


def _best_cells(row, query, score, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's `k` best cells; equal scores go by id."""
    best = np.lexsort((-score, query))
    first = np.searchsorted(query[best], query[best])
    place = np.arange(len(best)) - first
    last = np.minimum(first + k, np.searchsorted(query[best], query[best], "right")) - 1
    best = best[score[best] >= score[best[last]]] if len(best) else best
    if place.size and place.max() >= k:  # ties of the k-th score are settled by ids
        best = best[np.lexsort((ids[row[best]].astype(str), -score[best], query[best]))]
        best = best[np.arange(len(best)) - np.searchsorted(query[best], query[best]) < k]
    return best


class _BestSoFar:
    """Each query's `k` best cells by score and id, among those that a task has seen."""

    def __init__(self, n_queries: int, k: int) -> None:
        self.k = k
        self.query, self.score, self.ids = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, "U1")
        self.floor = np.full(n_queries, -np.inf)  # the k-th score, once there are k
        self.last = np.full(n_queries, "", object)  # and its id

    def new(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Places of the cells that can be among the best; they count from now on."""
        # Nulls sort first, as empty ids do; what ties with the last one is let through.
        ids = np.array(["" if i is None else i for i in ids], str) if len(ids) else np.zeros(0, "U1")
        floor = self.floor[query]
        found = np.flatnonzero((score > floor) | (score == floor) & (ids.astype(object) <= self.last[query]))
        if len(found):
            columns = zip((self.query, self.score, self.ids), (query[found], score[found], ids[found]))
            query, score, ids = (np.concatenate(c) for c in columns)
            order = np.lexsort((ids, -score, query))
            place = np.arange(len(order)) - np.searchsorted(query[order], query[order])
            kept = order[place < self.k]
            self.query, self.score, self.ids = query[kept], score[kept], ids[kept]
            full = order[place == self.k - 1]
            self.floor[query[full]], self.last[query[full]] = score[full], ids[full]
        return found


def _best_of(row, query, score, floor, query_ids: np.ndarray, texts: list[pa.Array], k: int, seen: _BestSoFar) -> list[pa.Array]:
    """Of a segment's scores what a task hands on: query ids, ids and carried columns, scores."""
    score = np.round(score, SCORE_DIGITS)
    keep = (score > 0) & (score >= floor[query])
    row, query, score = row[keep], query[keep], score[keep]
    ids = texts[0].to_numpy(zero_copy_only=False)
    best = _best_cells(row, query, score, ids, k)
    best = best[seen.new(query[best], score[best], ids[row[best]])]
    kept = [t.take(pa.array(row[best])) for t in texts]
    return [pa.array(query_ids[query[best]], pa.int64()), *kept, pa.array(score[best], pa.float64())]


def _scorer(weights: TermWeights, n_terms: int, query_ids: np.ndarray, scoring: Scoring, k: int, carry):
    names = ["query_id", "chunk_id", *carry, "score"]
    place_of = np.argsort(query_ids, kind="stable")
    held: dict = {}  # of the task that runs

    def best_so_far() -> _BestSoFar:
        attempt = TaskContext.get().taskAttemptId()
        if attempt not in held:
            held.clear()
            held[attempt] = _BestSoFar(len(query_ids), k)
        return held[attempt]

    def run(postings: pa.Table, segment: pa.Table) -> pa.Table:
        none = pa.table([pa.array([], pa.int64()), *[pa.array([], pa.string()) for _ in names[1:-1]], pa.array([], pa.float64())], names)
        if not postings.num_rows or not segment.num_rows:
            return none
        length = _flat(segment.column("lengths"))[0].astype(np.float64)
        asked = place_of[np.searchsorted(query_ids, _flat(segment.column("queries"))[0], sorter=place_of)]
        floor = np.full(len(query_ids), np.inf)  # queries that do not look at this segment
        seen = best_so_far()
        floor[asked] = np.maximum(_flat(segment.column("floors"))[0], seen.floor[asked])
        rows, starts = _flat(postings.column("rows"))
        counts, _ = _flat(postings.column("counts"))
        terms, heads = _flat(postings.column("terms"))
        times, _ = _flat(postings.column("times"))
        at, per = spread(starts, np.repeat(np.arange(postings.num_rows), np.diff(heads)))
        row, term, tf = rows[at].astype(np.int64), np.repeat(terms, per).astype(np.int64), counts[at] * np.repeat(times, per).astype(np.float64)
        value = scoring.value(tf, length[row])
        alive = _alive(weights, row, term, value, n_terms, floor)
        row, query, score = weights.cells(row, term, value, alive, BLOCK_ROWS)
        texts = [segment.column(c).combine_chunks().flatten() for c in ("ids", *carry)]
        return pa.table(_best_of(row, query, score, floor, query_ids, texts, k, seen), names)

    return run


def _occurrences(terms: list[str], entries, query_ids: np.ndarray, kind: str, carry: Sequence[str]):
    """Of each segment of volumes: which chunks hold a term how often, the best score that each query
    can reach there, and how many chunks surely match it."""
    texts = ("ids", *carry)

    def run(batches):
        match, weights = _matcher(terms), TermWeights.build(entries, len(terms), len(query_ids))
        for batch in batches:
            for number, packed in zip(batch.column("segment").to_pylist(), batch.column("packed")):
                volume = _columns(packed)
                sizes, held, times = match(volume["words"].to_pylist())
                starts = np.append(0, np.cumsum(sizes, dtype=np.int64))
                for i, (code, row, counts, part) in enumerate(_parts(volume)):
                    at, per = spread(starts, code)
                    if not len(at):
                        continue
                    n = part.stop - part.start
                    key, tf = held[at].astype(np.int64) * n + np.repeat(row, per), np.repeat(counts, per) * times[at]
                    order = np.argsort(key, kind="stable")  # several words may hold a term
                    heads = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
                    cells, tf = key[order][heads], np.add.reduceat(tf[order], heads)
                    value = Scoring(kind).value(tf, 1)
                    term = cells // n
                    heads = np.flatnonzero(np.append(True, term[1:] != term[:-1]))
                    chunks = np.diff(np.append(heads, len(term)))
                    _, query, bound = weights.cells(np.zeros(len(heads), np.int64), term[heads], np.maximum.reduceat(value, heads))
                    at, per = spread(weights.starts, term[heads])
                    least = np.zeros(len(query_ids), np.int64)
                    np.maximum.at(least, weights.columns[at], np.repeat(chunks, per))
                    kept = {"chunks": np.array([n]), "cells": _steps(cells), "tf": tf, **{c: volume[c][part] for c in texts}}
                    yield pa.RecordBatch.from_pydict(
                        {
                            "segment": [number + i],
                            "queries": [query_ids[query]],
                            "bounds": [bound],
                            "leasts": [least[query]],
                            "packed": [_packed(kept)],
                        }
                    )

    return run


def _best_in_segments(entries, n_terms: int, query_ids: np.ndarray, kind: str, k: int, carry, floors: np.ndarray | None = None):
    """Best chunks of segments for their `first` queries, or with `floors` for those others that can reach theirs."""
    names = ["query_id", "chunk_id", *carry, "score"]
    place_of = np.argsort(query_ids, kind="stable")

    def places(listed: pa.Scalar) -> np.ndarray:
        asked = listed.values.to_numpy() if listed.is_valid else np.zeros(0, np.int64)
        return place_of[np.searchsorted(query_ids, asked, sorter=place_of)]

    def run(batches):
        weights, seen = TermWeights.build(entries, n_terms, len(query_ids)), _BestSoFar(len(query_ids), k)
        for batch in batches:
            for i in range(batch.num_rows):
                queries, bounds, first, packed = (batch.column(c)[i] for c in ("queries", "bounds", "first", "packed"))
                floor = np.full(len(query_ids), np.inf)  # queries that do not look at this segment
                if floors is None:
                    asked = places(first)
                    floor[asked] = seen.floor[asked]
                else:
                    asked = places(queries)
                    floor[asked] = np.where(bounds.values.to_numpy() >= floors[asked] - SLACK, np.maximum(floors, seen.floor)[asked], np.inf)
                    floor[places(first)] = np.inf
                if (floor == np.inf).all():
                    continue
                kept = _columns(packed)
                n = int(_numbers(kept["chunks"])[0])
                term, row = np.divmod(np.cumsum(_numbers(kept["cells"])), n)
                value = Scoring(kind).value(_numbers(kept["tf"]).astype(np.float64), 1)
                row, query, score = _scores_above(weights, term, row, value, n, floor)
                yield pa.RecordBatch.from_arrays(
                    _best_of(row, query, score, floor, query_ids, [kept[c] for c in ("ids", *carry)], k, seen), names
                )

    return run


def _scores_above(weights: TermWeights, term, row, value, n: int, floor: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, query and score in the blocks of rows whose greatest values can add up to the query's floor.

    Cells are in the order of terms, then rows. Only what a query asks for of such a block is spread out to its rows.
    """
    n_queries, block = weights.n_queries, row // BLOCK_ROWS
    n_blocks = -(-n // BLOCK_ROWS)
    key = term * n_blocks + block
    heads = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    at, per = spread(weights.starts, term[heads])
    query, weight, run = weights.columns[at], weights.weights[at].astype(np.float64), np.repeat(np.arange(len(heads)), per)
    looked = floor[query] < np.inf
    query, weight, run = query[looked], weight[looked], run[looked]
    cell = block[heads][run] * n_queries + query
    bound = np.bincount(cell, np.maximum.reduceat(value, heads)[run] * weight, n_blocks * n_queries)
    alive = (bound.reshape(n_blocks, n_queries) >= floor - SLACK).ravel()[cell]
    query, weight, run = query[alive], weight[alive], run[alive]
    at, per = spread(np.append(heads, len(key)), run)
    cell, amount = row[at] * n_queries + np.repeat(query, per), value[at] * np.repeat(weight, per)
    if n * n_queries <= CELLS:
        score = np.bincount(cell, amount, n * n_queries)
        cell = np.flatnonzero(score)
        score = score[cell]
    else:
        cell, place = np.unique(cell, return_inverse=True)
        score = np.bincount(place, amount, len(cell))
    return *np.divmod(cell, n_queries), score


def _waves(bounds: DataFrame, k: int) -> DataFrame:
    """`query_id, segment, bound, least`, staged with whether the better bounds hold `k` chunks before it at most."""
    order = Window.partitionBy("query_id").orderBy(F.desc("bound"), "segment").rowsBetween(Window.unboundedPreceding, -1)
    return stage(bounds.withColumn("first", F.coalesce(F.sum("least").over(order), F.lit(0)) < k))


def _part_searches(index: WordIndex, terms: list[str], entries, query_ids: np.ndarray, kind: str, k: int):
    """`_waves` of terms that are parts of words, and the searches of the first wave and the rest."""
    own = set(np.unique(query_ids, return_index=True)[1].tolist())  # of queries with one id the first counts
    entries = [entry for entry in entries if entry[1] in own]
    listed = index.volumes.select("segment", "packed").mapInArrow(
        _occurrences(terms, entries, query_ids, kind, index.carry),
        "segment long, queries array<long>, bounds array<double>, leasts array<long>, packed binary",
    )
    found = stage(listed, **LARGE_ROWS)
    pairs = F.inline(F.arrays_zip("queries", "bounds", "leasts"))
    bounds = _waves(found.select("segment", pairs).toDF("segment", "query_id", "bound", "least"), k)
    firsts = stage(bounds.where("first").groupBy("segment").agg(F.collect_list("query_id").alias("first")))
    kinds = f"query_id long, {', '.join(f'{c} string' for c in ('chunk_id', *index.carry))}, score double"

    def scored(near: DataFrame, floors: np.ndarray | None = None) -> DataFrame:
        run = _best_in_segments(entries, len(terms), query_ids, kind, k, index.carry, floors)
        return near.select("queries", "bounds", "first", "packed").mapInArrow(run, kinds)

    def rest(chosen: DataFrame, floor: DataFrame) -> DataFrame:
        known = {r["query_id"]: r["floor"] for r in floor.collect()}
        floors = np.array([known.get(q, -np.inf) for q in query_ids.tolist()])
        near = found.join(small_or_plain(stage(chosen.select("segment").distinct())), "segment", "left_semi")
        return scored(near.join(small_or_plain(firsts), "segment", "left"), floors)

    return bounds, lambda: scored(found.join(small_or_plain(firsts), "segment")), rest


def _word_searches(index: WordIndex, terms: list[str], times, query_ids: np.ndarray, k: int, k1: float, b: float):
    """`_waves` of terms that are words, and the searches of the first wave and the rest."""
    spark = index.volumes.sparkSession
    found = index.postings_of(terms).join(small_or_plain(vocabulary(index, terms, whole_words=True)), "word")
    n, total = index.statistics()
    scoring = Scoring(BM25, k1, b, total / n if total else 1.0)
    held = found.groupBy(F.col("terms")[0].alias("term")).agg(F.sum(F.size("rows")).alias("df")).collect()
    idf = {r["term"]: float(np.log(1 + (n - r["df"] + 0.5) / (r["df"] + 0.5))) for r in held}
    entries = [(term, q, amount * idf[term]) for term, q, amount in times if term in idf]
    asked = pd.DataFrame({"term": [t for t, _, _ in entries], "query_id": [query_ids[q] for _, q, _ in entries], "weight": [w for _, _, w in entries]})
    asked = spark.createDataFrame(asked, "term int, query_id long, weight double")
    bounds = _waves(_bounds(found, asked, scoring), k)
    weights = TermWeights.build(entries, max(1, len(terms)), len(query_ids))
    run = _scorer(weights, max(1, len(terms)), query_ids, scoring, k, index.carry)
    kinds = ", ".join(f"{c} string" for c in ("chunk_id", *index.carry))

    def scored(pairs: DataFrame) -> DataFrame:
        listed = F.collect_list(F.struct("query_id", "floor"))
        chosen = pairs.groupBy("segment").agg(listed.alias("q")).select("segment", F.col("q.query_id").alias("queries"), F.col("q.floor").alias("floors"))
        chosen = stage(chosen)
        near = found.join(small_or_plain(chosen.select("segment")), "segment").select("segment", "rows", "counts", "terms", "times")
        own = index.segments.join(small_or_plain(chosen), "segment")
        own = own.select(*[F.col(c).alias(c) for c in own.columns])  # columns of its own, as both come from one table
        return near.groupBy("segment").cogroup(own.groupBy("segment")).applyInArrow(run, f"query_id long, {kinds}, score double")

    return bounds, lambda: scored(bounds.where("first").withColumn("floor", F.lit(float("-inf")))), lambda chosen, _: scored(chosen)


def _block_top_k(index: WordIndex, block: Block, kind: str, k: int, k1: float, b: float) -> tuple[DataFrame, DataFrame]:
    """Best chunks of a block of queries, and the bounds of all its segments with the wave they were scored in."""
    terms = distinct_terms(block)
    number = {term: i for i, term in enumerate(terms)}
    query_ids = np.array([query_id for query_id, _ in block], dtype=np.int64)
    times = [(number[w], q, float(n)) for q, (_, words) in enumerate(block) for w, n in Counter(words).items()]
    if kind == BM25:
        bounds, first, others = _word_searches(index, terms, times, query_ids, k, k1, b)
    else:
        bounds, first, others = _part_searches(index, terms, times, query_ids, kind, k)
    best = [F.desc("score"), F.asc("chunk_id")]
    wave = stage(top_k(first(), ["query_id"], best, k, spread=SPREAD))
    floor = wave.where(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
    rest = bounds.where("not first").join(F.broadcast(floor), "query_id", "left").where(f"floor is null or bound >= floor - {SLACK}")
    rest = stage(rest.select("query_id", "segment", F.coalesce("floor", F.lit(float("-inf"))).alias("floor")))
    second = others(rest, floor)
    waves = bounds.join(rest.select("query_id", "segment", F.lit(True).alias("second")), ["query_id", "segment"], "left")
    waves = waves.select("query_id", "segment", "bound", F.when(F.col("first"), 1).when(F.col("second"), 2).otherwise(0).alias("wave"))
    return wave.drop("rank").unionByName(second), waves


def search_index(
    index: WordIndex, queries: DataFrame, kind: str = BM25, k: int = K_A, k1: float = BM25_K1, b: float = BM25_B, waves: list | None = None
) -> DataFrame:
    """Top `k` chunks of every (query_id, query): query_id, chunk_id, carried columns, score, rank.

    `kind` is BM25, LEXICAL or PRESENCE; scores and ties are those of `bm25_top_k`,
    `lexical_top_k` and `presence_top_k`. A list given as `waves` gets a table of
    `query_id, segment, bound, wave` for each block of queries: wave 0 was left out.
    """
    if kind not in (BM25, LEXICAL, PRESENCE):
        raise ValueError(f"unknown score: {kind}")
    found = []
    for block in blocks(queries, max_queries=queries_per_block(k)):
        if block:
            rows, passed = _block_top_k(index, block, kind, k, k1, b)
            found.append(rows)
            if waves is not None:
                waves.append(passed)
    if not found:
        kinds = "".join(f", '' AS {c}" for c in index.carry)
        return index.volumes.sparkSession.sql(f"SELECT 0L AS query_id, '' AS chunk_id{kinds}, 0D AS score, 1 AS rank").where("false")
    best = top_k(reduce(DataFrame.unionByName, found), ["query_id"], [F.desc("score"), F.asc("chunk_id")], k, spread=SPREAD)
    weight = {BM25: None, LEXICAL: LEXICAL_WEIGHT, PRESENCE: PRESENCE_WEIGHT}[kind]
    return best if weight is None else best.withColumn("score", F.col("score") * weight)

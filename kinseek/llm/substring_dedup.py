"""Substring dedup by repeated windows: one anchored level, and doubling for the longest repeats.

A window of w words can only repeat where its sub-windows do. The first level takes windows
of half the length, and of these only the least of every w-word window (by hash), about a
quarter of all positions. Neighbouring w-word windows with the same least one are a run. A run
whose half-length window and whose words are those of another document's run repeats as a
whole. Where only the half-length window is the same, the runs' first holders are
extended to w words on the next level and compared window by window. `longest_repeats`
goes on doubling, from windows that repeat at one length alone, until none survives.

A task first combines what it holds: of all documents with a run only the smallest id goes to
the run's group, the others are known to repeat. So a passage in a third of all documents
sends a row for each batch of documents to its group, not a row for each one. Texts
are shuffled once, by id; all joins with them use the same exchange.

Defined results: a null text has no words; a row with a null id keeps all its words and
takes part in nothing; rows with equal ids are one document, so they do not repeat each
other; repeats inside one document do not count; extra columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinseek.llm import words
from kinseek.runtime import stage

HIT = "hash long, variant long, doc_id long, at long, _text long"
RUN = 13  # windows of a run at most: its first and last ones then hold all its words
NO_SPANS = "array<bigint>"


def _texts(docs: DataFrame) -> DataFrame:
    """`doc_id, _text, text`; `_text` tells rows of one id apart where their texts differ."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    given = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    hashed = given.select("doc_id", F.xxhash64("text").alias("_h")).groupBy("doc_id").agg(F.min("_h").alias("a"), F.max("_h").alias("b"))
    differ = not hashed.where("a <> b").isEmpty()
    # Not a literal: the optimizer would plan the joins on it differently, with an exchange each.
    mark = F.xxhash64("text") if differ else F.pmod("doc_id", F.lit(1)).cast("long")
    return given.select("doc_id", mark.alias("_text"), F.col("text").cast("binary").alias("text"))


def _combined(h, variant, row, a, b, ids: np.ndarray, marks: np.ndarray) -> pa.RecordBatch:
    """One batch's runs: of all ids with the same (hash, variant) the smallest stays in the
    group, marked if others share it; the others are known to repeat and, merged
    where they follow each other, get groups of their own."""
    doc = ids[row]
    order = np.lexsort((doc, variant, h))
    h, variant, row, a, b, doc = h[order], variant[order], row[order], a[order], b[order], doc[order]
    new = np.append(True, (h[1:] != h[:-1]) | (variant[1:] != variant[:-1]))
    group, at = np.cumsum(new) - 1, np.flatnonzero(new)
    least, most = doc[at], doc[np.append(at[1:], len(h)) - 1]
    later = doc != least[group]
    run = np.flatnonzero(later)
    run = run[np.lexsort((a[run], row[run]))]
    start = np.append(True, (row[run][1:] != row[run][:-1]) | (a[run][1:] > b[run][:-1] + 1))[: len(run)]
    head, tail = run[start], run[np.append(start[1:], True)[: len(run)]]
    first = np.flatnonzero(~later)
    both, last = np.concatenate([first, head]), np.concatenate([first, tail])
    alone = words.mix(h[head] ^ words.mix(doc[head].astype(np.uint64)))
    hashes = np.concatenate([h[first], alone]).view(np.int64)
    packed = (a[both] << 30) | ((b[last] - a[both]) << 2) | (((least != most)[group][both]).astype(np.int64) << 1) | later[both]
    return pa.RecordBatch.from_arrays(
        [pa.array(hashes), pa.array(variant[both].view(np.int64)), pa.array(doc[both]), pa.array(packed.astype(np.int64)), pa.array(marks[row[both]])],
        ["hash", "variant", "doc_id", "at", "_text"],
    )


def _least(h: np.ndarray, span: int) -> np.ndarray:
    """The least of every `span` neighbours."""
    out, have = h, 1
    while have < span:
        step = min(have, span - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def _rolled(hashed: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all `size` neighbouring words, across rows as well."""
    total = hashed[: len(hashed) - size + 1] * words._PLACE[0]
    for k in range(1, size):
        total = total + hashed[k : len(hashed) - size + 1 + k] * words._PLACE[k]
    return words.mix(total)


def _hashed(batch: pa.RecordBatch) -> Iterator[tuple]:
    data, offsets = words.buffers(batch.column("text"))
    for lo, hi in words.chunks(offsets):
        starts, _, counts = words.word_spans(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        yield lo, hi, counts, words.word_hashes(data[offsets[lo] : offsets[hi]], starts, fold=False)


def _anchors(window: int, half: int):
    """Runs of `window`-word windows with the same least half-length window: its hash, and
    as variant a hash of all the run's words."""

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for lo, _, counts, hashed in _hashed(batch):
                if len(hashed) < window:
                    continue
                least = _least(_rolled(hashed, half), window - half + 1)
                whole = _rolled(hashed, window)
                row = words.row_of(counts)[: len(least)]
                place = np.arange(len(least)) - (np.cumsum(counts) - counts)[row]
                inside = place + window <= counts[row]
                head = np.flatnonzero(np.append(True, (least[1:] != least[:-1]) | (row[1:] != row[:-1])) & inside)
                size = np.diff(np.append(head, len(least)))
                size = np.minimum(size, counts[row[head]] - window - place[head] + 1)
                parts = -(-size // min(RUN, window))
                step = min(RUN, window) * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
                end = np.repeat(head + size, parts)
                head = np.repeat(head, parts) + step
                last = np.minimum(head + min(RUN, window), end) - 1
                variant = words.mix(whole[head] + np.uint64(3) * whole[last] + (last - head).astype(np.uint64))
                found.append((least[head], variant, row[head] + lo, place[head], place[last]))
            if found:
                yield _combined(*[np.concatenate(c) for c in zip(*found)], batch.column("doc_id").to_numpy(), batch.column("_text").to_numpy())

    return anchors


def _windows(length: int):
    """All windows of `length` words that start in the spans `at` of their text."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column("at")))
            spans = batch.column("at")
            ends, at = np.asarray(spans.offsets), np.asarray(spans.values)
            found = []
            for lo, hi, counts, hashed in _hashed(batch):
                h, first = words.grams(hashed, counts, length)
                begin = np.cumsum(counts) - counts
                own = at[ends[lo] : ends[hi]]
                row = np.repeat(np.arange(hi - lo), np.diff(ends[lo : hi + 1]))
                keep = _marked(begin[row] + (own >> 30), begin[row] + (own >> 30) + (own >> 2 & ((1 << 28) - 1)) + 1, len(hashed))[first]
                h, first = h[keep], first[keep]
                row = words.row_of(counts)[first]
                found.append((h, np.zeros(len(h), np.uint64), row + lo, first - begin[row], first - begin[row]))
            if found and sum(len(f[0]) for f in found):
                yield _combined(*[np.concatenate(c) for c in zip(*found)], batch.column("doc_id").to_numpy(), batch.column("_text").to_numpy())

    return windows


def _marked(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Which of `size` places lie in a span."""
    marks = np.bincount(starts, minlength=size + 1) - np.bincount(np.minimum(ends, size), minlength=size + 1)
    return np.cumsum(marks)[:size] > 0


def _gathered(hits: DataFrame, later: bool) -> DataFrame:
    """Per document the spans known to repeat (`sure`; with `later`: in a smaller id), and
    those that share no more than their half-length window (`open`)."""
    same, near = Window.partitionBy("hash", "variant"), Window.partitionBy("hash")
    met = hits.withColumns({"_least": F.min("doc_id").over(same), "_most": F.max("doc_id").over(same)}).withColumns(
        {"_low": F.min("variant").over(near), "_high": F.max("variant").over(near)}
    )
    known = F.col("at").bitwiseAND(1) == 1
    again = F.col("_least") < F.col("doc_id") if later else (F.col("_least") < F.col("_most")) | (F.col("at").bitwiseAND(2) == 2)
    sure = known | again
    unsure = ~sure & (F.col("_low") < F.col("_high"))
    holder = ~known & (F.col("_low") < F.col("_high")) & (F.col("_least") == F.col("doc_id"))
    return (
        met.where(sure | unsure | holder)
        .groupBy("doc_id", "_text")
        .agg(F.collect_list(F.when(sure, F.col("at"))).alias("sure"), F.collect_list(F.when(holder | unsure, F.col("at"))).alias("open"))
    )


def _next_level(texts: DataFrame, candidates: DataFrame, length: int, later: bool) -> DataFrame:
    # A left join, as the last one is, so that both read one exchange of the texts.
    met = texts.join(candidates, ["doc_id", "_text"], "left").select("doc_id", "_text", "text", "at")
    return _gathered(met.mapInArrow(_windows(length), HIT), later).select("doc_id", "_text", F.col("sure").alias("at"))


def _repeated(texts: DataFrame, window: int, later: bool) -> tuple[DataFrame, DataFrame]:
    """Spans (`doc_id, _text, at`) of windows that repeat, in two tables."""
    runs = stage(_gathered(texts.mapInArrow(_anchors(window, -(-window // 2)), HIT), later))
    unsure = runs.select("doc_id", "_text", F.col("open").alias("at")).where(F.size("at") > 0)
    return runs.select("doc_id", "_text", F.col("sure").alias("at")), _next_level(texts, unsure, window, later)


def longest_repeats(docs: DataFrame, window: int = 13) -> DataFrame:
    """`doc_id, longest`: the greatest window * 2^k at which a document shares a window.

    Levels follow each other until no window survives one.
    """
    texts, length = _texts(docs), window
    one, two = _repeated(texts, window, later=False)
    spans = stage(one.union(two).groupBy("doc_id", "_text").agg(F.flatten(F.collect_list("at")).alias("at")).where(F.size("at") > 0))
    longest = spans.select("doc_id", F.lit(length).alias("longest"))
    while not spans.isEmpty():
        length *= 2
        spans = stage(_next_level(texts, spans, length, later=False).where(F.size("at") > 0))
        longest = longest.union(spans.select("doc_id", F.lit(length)))
    return longest.groupBy("doc_id").agg(F.max("longest").alias("longest"))


def _cutter(window: int, keep_text: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, gone, digests, texts = [], [], [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("at")):
                own = text.split()
                counts.append(len(own))
                if len(spans):
                    at = np.asarray(spans.values)
                    start = at >> 30
                    keep = ~_marked(start, start + (at >> 2 & ((1 << 28) - 1)) + window, len(own))
                    own = [own[i] for i in np.flatnonzero(keep)]
                gone.append(counts[-1] - len(own))
                kept = b" ".join(own)
                digests.append(hashlib.sha256(kept).hexdigest())
                texts.append(kept.decode("utf-8", "replace") if keep_text else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests, pa.string()), pa.array(texts, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
            )

    return cut


def dedup_substrings(docs: DataFrame, window: int = 13, keep_text: bool = True) -> DataFrame:
    """`doc_id, n_words, n_removed, kept_sha256, kept` of every row of `docs` (doc_id, text).

    A word goes when a window of `window` words covers it that starts in a document with a
    smaller id as well. `kept` has the other words, joined by one space.
    """
    texts = _texts(docs)
    one, two = _repeated(texts, window, later=True)
    none = F.array().cast(NO_SPANS)
    both = F.concat(F.coalesce("at", none), F.coalesce("_more", none))
    given = texts.join(one, ["doc_id", "_text"], "left").join(two.withColumnRenamed("at", "_more"), ["doc_id", "_text"], "left").select("doc_id", "text", both.alias("at"))
    no_id = docs.where("doc_id is null").select(
        F.lit(None).cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"), none.alias("at")
    )
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
    return given.union(no_id).mapInArrow(_cutter(window, keep_text), schema)

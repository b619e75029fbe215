"""Periodic runs: stretches of words that repeat with a period, found by an enhanced suffix array.

A run is a stretch of consecutive words with smallest period q, at least `periods` times q and
`least` words long, that no neighbouring word extends. Every text is judged whole, by itself:

1. A text in which no words of a certain number repeat in a row holds no run (`_gram`) and is
   done after one sort of hashes.
2. The others get a suffix array by doubling (only suffixes that still tie are sorted again),
   its inverse, and the lengths of common prefixes of neighbours (LCP) from the doubling's ranks.
3. An LCP interval of depth d holds all suffixes that share d words. For every suffix i of all
   its children but the largest, the inverse array says whether i + d or i - d is in the
   interval too: then a square of half d starts there, and it branches if the next words differ.
4. A run of period q ends in exactly one branching square of half q (others have multiples of
   q); it is rotated to the left as far as words agree, and squares of the same end merge.

No tree is built, and nothing meets other documents: texts are read in the tasks that scan
them, a chunk of `CHUNK` bytes (or one longer text) at a time, with memory linear in it but for
one array of ranks for each doubling.

Defined results: a null or empty text has no words and no runs; ids may be null or repeat, every
row stands for itself; an empty table gives no rows; extra columns do not matter. Words are
compared by 64-bit hashes. A text of one word repeated is one run of period 1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinseek.llm import words

LEAST, PERIODS = 24, 3
CHUNK = 2 << 20  # bytes of text looked at together
STEPS = 24  # words that all squares are rotated by together, before each goes by itself
RUNS = "array<struct<start: long, length: long, period: long>>"


def _gram(least: int, periods: int) -> int:
    """Words in a row that any run repeats: from its start and from one period on."""
    return min(max(least - q, (periods - 1) * q) for q in range(1, least + 1))


# --- suffix array -------------------------------------------------------------


def _starts_of_groups(*sorted_keys: np.ndarray) -> np.ndarray:
    """For every place of the sorted keys the first place with the same keys."""
    new = np.zeros(len(sorted_keys[0]), bool)
    new[0] = True
    for key in sorted_keys:
        new[1:] |= key[1:] != key[:-1]
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def _ranks(codes: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... words, until no two tie.

    `codes` differ between texts, and a suffix ends with its text (`ends`, exclusive). Every
    array has one more entry, -1, for the place after the last word.
    """
    size = len(codes)
    order = np.argsort(codes, kind="stable")
    first = _starts_of_groups(codes[order])
    rank = np.full(size + 1, -1, np.int32)
    rank[order] = first
    levels = [rank]
    tied = order[np.bincount(first, minlength=size)[first] > 1]
    step = 1
    while len(tied):
        ahead = tied + step
        second = np.where(ahead < ends[tied], rank[np.minimum(ahead, size)], -1).astype(np.int64)
        own = rank[tied].astype(np.int64)
        by = np.argsort(own * (size + 1) + second + 1, kind="stable")
        tied, own, second = tied[by], own[by], second[by]
        old, new = _starts_of_groups(own), _starts_of_groups(own, second)
        rank = rank.copy()
        rank[tied] = own + new - old
        levels.append(rank)
        tied = tied[np.bincount(new, minlength=len(new))[new] > 1]
        step *= 2
    return levels


def _common(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Words that the suffixes at `a` and `b` have in common."""
    a, b = a.copy(), b.copy()
    begin = a.copy()
    for k in range(len(levels) - 1, -1, -1):
        same = levels[k][a] == levels[k][b]
        a[same] += 1 << k
        b[same] += 1 << k
    return a - begin


def _bounds(lcp: np.ndarray, at: np.ndarray, way: int) -> np.ndarray:
    """For every place of `at` the nearest place before (-1) or after (1) with a smaller LCP."""
    near = np.arange(len(lcp)) + way
    open_ = at
    while len(open_):
        open_ = open_[lcp[near[open_]] >= lcp[open_]]
        near[open_] = near[near[open_]]
    return near[at]


def _branching_squares(codes: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and half length of all squares whose next word breaks them."""
    size = len(codes)
    levels = _ranks(codes, ends)
    isa = levels[-1]
    sa = np.empty(size, np.int64)
    sa[isa[:-1]] = np.arange(size)
    lcp = np.full(size + 1, -1, np.int64)
    lcp[1:size] = 0
    near = np.flatnonzero(levels[0][sa[1:]] == levels[0][sa[:-1]]) + 1
    lcp[near] = _common(levels, sa[near - 1], sa[near])
    del levels
    if not len(near):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    left, right = _bounds(lcp, near, -1), _bounds(lcp, near, 1)
    by = np.lexsort((near, right, left))
    near, left, right = near[by], left[by], right[by]
    # An interval's children lie between its ends and the places where its depth is the LCP.
    head = np.flatnonzero(np.append(True, (left[1:] != left[:-1]) | (right[1:] != right[:-1])))
    splits = np.diff(np.append(head, len(near)))
    interval = np.repeat(np.arange(len(head)), splits)
    child0 = head + np.arange(len(head))
    start, end = np.empty(len(near) + len(head), np.int64), np.empty(len(near) + len(head), np.int64)
    place = np.arange(len(near)) + interval
    start[child0], start[place + 1] = left[head], near
    end[place], end[child0 + splits] = near, right[head]
    owner = np.repeat(np.arange(len(head)), splits + 1)
    width = end - start
    largest = np.flatnonzero(width == np.maximum.reduceat(width, child0)[owner])
    _, one = np.unique(owner[largest], return_index=True)
    small = np.ones(len(width), bool)
    small[largest[one]] = False
    start, width, owner = start[small], width[small], owner[small]
    at = np.repeat(start - np.cumsum(width) + width, width) + np.arange(width.sum())
    owner = np.repeat(owner, width)
    i, depth = sa[at], lcp[near[head]][owner]
    low, high = left[head][owner], right[head][owner]

    def inside(j: np.ndarray, ok: np.ndarray) -> np.ndarray:
        number = isa[np.where(ok, j, size)]
        return ok & (number >= low) & (number < high)

    ahead = inside(i + depth, i + depth < ends[i])
    behind = inside(i - depth, i - depth >= begins[i])
    a = np.concatenate([i[ahead], (i - depth)[behind]])
    d = np.concatenate([depth[ahead], depth[behind]])
    # A square branches if it ends with its text or before another word than its middle has.
    after = a + 2 * d
    keep = (after >= ends[a]) | (codes[np.minimum(after, size - 1)] != codes[np.minimum(after - d, size - 1)])
    found = np.unique(np.stack([a[keep], d[keep]]), axis=1)
    return found[0], found[1]


# --- runs ---------------------------------------------------------------------


def _leftmost(codes: np.ndarray, a: int, d: int, low: int) -> int:
    """First word of the stretch of period `d` that `a` is in, not before `low`."""
    size = 64
    while a > low:
        begin = max(low, a - size)
        other = np.flatnonzero(codes[begin:a] != codes[begin + d : a + d])
        if len(other):
            return begin + int(other[-1]) + 1
        a, size = begin, 2 * size
    return a


def _runs(codes: np.ndarray, begins: np.ndarray, ends: np.ndarray, least: int, periods: int) -> list[tuple[int, int, int]]:
    """Start, length and period of all runs, by start and period."""
    a, d = _branching_squares(codes, begins, ends)
    need = np.maximum(least, periods * d) - 2 * d  # words that the square must rotate by
    fits = a - begins[a] >= need
    a, d, need = a[fits], d[fits], need[fits]
    for k in range(1, STEPS + 1):
        keep = need < k
        on = np.flatnonzero(~keep)
        keep[on] = codes[a[on] - k] == codes[a[on] + d[on] - k]
        a, d, need = a[keep], d[keep], need[keep]
    found: list[tuple[int, int, int]] = []
    last_end, first = -1, 0
    order = np.lexsort((d, a + 2 * d))
    for at, half in zip(a[order].tolist(), d[order].tolist()):
        end = at + 2 * half
        if end == last_end and first <= at:
            continue  # inside the run of a smaller period with the same end
        start = _leftmost(codes, at, half, int(begins[at]))
        last_end, first = end, start
        if end - start >= max(least, periods * half):
            found.append((start, end - start, half))
    return sorted(found, key=lambda r: (r[0], r[2]))


def runs_of_rows(hashes: np.ndarray, counts: np.ndarray, least: int = LEAST, periods: int = PERIODS) -> dict[int, list[tuple[int, int, int]]]:
    """Runs of every row that has any: start (word of the row), length, period."""
    gram, first = words.grams(hashes, counts, _gram(least, periods))
    if not len(gram):
        return {}
    row = words.row_of(counts)[first]
    key = words.mix(gram + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    again = np.flatnonzero(key[order][1:] == key[order][:-1])
    rows = np.unique(row[order[again]])
    if not len(rows):
        return {}
    begin = np.cumsum(counts) - counts
    size = counts[rows]
    ends = np.cumsum(size)
    begins = ends - size
    at = np.repeat(begin[rows] - begins, size) + np.arange(ends[-1])
    own = np.repeat(np.arange(len(rows)), size)
    # Numbers of the (row, word) pairs in ascending order of row, so that texts never tie.
    _, code = np.unique(hashes[at], return_inverse=True)
    codes = own * (int(code.max()) + 1) + code
    found: dict[int, list[tuple[int, int, int]]] = {}
    for start, length, period in _runs(codes, begins[own], ends[own], least, periods):
        k = int(own[start])
        found.setdefault(int(rows[k]), []).append((start - int(begins[k]), length, period))
    return found


def _dropped(runs: list[tuple[int, int, int]], size: int) -> np.ndarray:
    """Which words follow the first period of a run that holds them."""
    edge = np.zeros(size + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:-1]) > 0


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, keep: np.ndarray) -> bytes:
    raw = data.tobytes()
    return b" ".join(raw[s:e] for s, e in zip(starts[keep].tolist(), ends[keep].tolist()))


def _spaced(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """All words of every row, joined by one space."""
    keep = np.zeros(len(data) + 1, np.int8)
    keep[starts] += 1
    keep[ends] -= 1
    solid = np.cumsum(keep[:-1]).astype(bool)
    last = np.cumsum(counts)[counts > 0] - 1
    gap = np.delete(ends, last)  # the byte after every word but a row's last one
    solid[gap] = True
    body = data.copy()
    body[gap] = 0x20
    cut = np.append(0, np.cumsum(solid))[offsets]
    raw = body[solid].tobytes()
    return [raw[s:e] for s, e in zip(cut[:-1].tolist(), cut[1:].tolist())]


def _finder(least: int, periods: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.buffers(batch.column("text"))
            for lo, hi in words.chunks(offsets, CHUNK):
                part, cut = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                starts, ends, counts = words.word_spans(part, cut)
                found = runs_of_rows(words.word_hashes(part, starts, fold=False), counts, least, periods)
                texts = _spaced(part, cut, starts, ends, counts)
                first = np.cumsum(counts) - counts
                for row, runs in found.items():
                    span = slice(first[row], first[row] + counts[row])
                    texts[row] = _joined(part, starts[span], ends[span], ~_dropped(runs, int(counts[row])))
                runs = [[{"start": s, "length": n, "period": q} for s, n, q in found.get(row, ())] for row in range(hi - lo)]
                kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(counts, pa.int64()), pa.array(runs, kind), pa.array(texts, pa.binary())],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return find


def find_runs(docs: DataFrame, least: int = LEAST, periods: int = PERIODS) -> DataFrame:
    """`doc_id, n_words, runs, collapsed` of every row of `docs` (doc_id, text).

    `runs` is ordered by start, then period; `collapsed` has the words left when every run
    keeps its first period only, joined by one space. `periods` is 2 at least.
    """
    if periods < 2 or least < 2:
        raise ValueError("a run repeats its period at least twice")
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    found = given.mapInArrow(_finder(least, periods), f"doc_id long, n_words long, runs {RUNS}, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def planted(docs: DataFrame) -> DataFrame:
    """`doc_id, text` with a repeated stretch written into about one text of ten.

    With h the checksum of the id and g = h / 10, texts of n > 0 words and h % 10 = 0 have all
    words from a = g % n on replaced by repeats of the p words at a, p = 1 + (n - a) / (3 + g % 8).
    A null id has no checksum and its text stays.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    text = F.col("text").cast("string")
    split = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    given = docs.select("doc_id", text.alias("text"), h.alias("_h")).withColumn("_words", F.when(F.col("_h") % 10 == 0, split))
    n = F.size("_words")
    g = F.floor(F.col("_h") / 10)
    drawn = given.withColumn("_a", F.when(n > 0, g % n).cast("int")).withColumn(
        "_p", (1 + F.floor((n - F.col("_a")) / (3 + g % 8))).cast("int")
    )
    rest = n - F.col("_a")
    unit = F.slice("_words", F.col("_a") + 1, F.col("_p"))
    repeats = F.flatten(F.array_repeat(unit, F.ceil(rest / F.col("_p")).cast("int")))
    edited = F.array_join(F.concat(F.slice("_words", F.lit(1), F.col("_a")), F.slice(repeats, F.lit(1), rest)), " ")
    return drawn.select("doc_id", F.when(F.col("_a").isNotNull(), edited).otherwise(F.col("text")).alias("text"))


def strongest(runs: Column) -> Column:
    """Of runs ordered by start and period, the first of the greatest length to period ratio."""
    best = F.aggregate(
        runs,
        F.lit(None).cast("struct<start: long, length: long, period: long>"),
        lambda a, r: F.when(a.isNull() | (r["length"] * a["period"] > a["length"] * r["period"]), r).otherwise(a),
    )
    return best

"""Best-fit packing of tokenized documents by bin completion.

Documents are tokenized inside tasks and cut into pieces of at most `capacity` tokens. How
many pieces there are of each length is all that packing needs to know: at most `capacity`
numbers, whatever the size of the corpus. From them the driver builds patterns: around the
largest length left, the filling of the remaining room that wastes least, found from the sums that
can be reached, is used as often as its lengths last. Plain best-fit decreasing is planned as
well, and kept if no plan needs fewer sequences. While a plan needs more than a lower
bound on sequences, other fillings and uses are tried from its end back, leaving every branch
whose bound cannot get below the best plan's and every filling that is dominated (an item that
is left could take the place of smaller ones). SEARCH_NODES bounds how many are looked at; a
plan that it ends is whole, but may not be the shortest.

Pieces then learn their rank among those of their length from per-partition totals of one
range-partitioned order, and ranks fall into the intervals that patterns take.

Defined results: a null or empty text is the end token alone; equal rows are packed as
separate pieces; an empty table gives no rows; extra columns do not matter; null ids sort first.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import re
import sys
import zlib
from array import array
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, compress
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinseek.llm import graph
from kinseek.llm.words import buffers, chunks, word_hashes, word_spans
from kinseek.runtime import arrow_batches, stage

CAPACITY = 4096
END_TOKEN = 1
SEARCH_NODES = 4000  # choices looked at behind the first plan before the best plan so far is taken
CACHED_WORDS = 200_000  # in the table of a Python worker, at about 36 bytes each and as much while it grows
GROUP_BYTES = 256 << 10  # of texts whose words are looked up together
BATCH_BYTES = 4 << 20  # of texts that an executor hands to a Python worker at once


MARKS = b".,;:!?"
ENDS = re.compile(rb"(?:[A-Za-z0-9]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])\Z")  # in a letter or digit
# Fixed value: what the tokenizer cuts a lower-cased plain word into before it looks for tokens; and spaces.
PARTS = re.compile(rb"\x20|'s|'t|'re|'ve|'m|'ll|'d|(?:[a-z]|\xc3.)+|[0-9]|[^a-z0-9\xc3\x20]+", re.S)
LETTERS = "".join(map(chr, range(0xC0, 0x100)))  # of Latin-1: two bytes each, the first one 0xC3
BREAK = "\x01"  # a token of its own between words that are coded together


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words one after the other, a space behind each, and where each begins."""
    size = ends - starts
    begin = np.cumsum(size + 1) - size - 1
    out = np.full(int(size.sum()) + len(size), 0x20, np.uint8)
    to = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())
    out[to] = data[to + np.repeat(starts - begin, size)]
    return out, begin


def _lowered(words: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Joined words in lower case, and which of them are plain.

    Plain are visible ASCII and the letters of Latin-1, which the tokenizer's normalizer only lower-cases.
    """
    lead = words == 0xC3
    second = np.zeros(len(words), bool)  # of a letter of two bytes
    second[1:] = lead[:-1] & (words[1:] >= 0x80) & (words[1:] <= 0xBF) & (words[1:] != 0x97) & (words[1:] != 0xB7)
    good = (words >= 0x20) & (words <= 0x7E) | second
    good[:-1] |= lead[:-1] & second[1:]
    low = words.copy()
    low[(words >= ord("A")) & (words <= ord("Z")) | second & (words <= 0x9E)] += 0x20
    return low, np.logical_and.reduceat(good, begin)


class _Words:
    """Ids of texts, by way of a table from the 64-bit hash of a word to its ids.

    White space always ends a token of this tokenizer, and so does the end of a run of letters, of
    a digit, or of a run of marks: a text's ids are those of its words, a plain word's ids
    those of its parts, which stand in the table like words. The tokenizer's model sees parts
    that are not there yet; the whole tokenizer sees words that are not plain or name one of
    its special tokens. The table is three flat arrays; one that has grown past
    `CACHED_WORDS` starts anew with the words of the last texts.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark spreads the work
        from tokenizers import Tokenizer, pre_tokenizers

        tokenizer = Tokenizer.from_file(path)
        self.encode, self.model = tokenizer.encode, tokenizer.model
        named = [re.escape(t.content.encode()) for t in tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile(b"|".join(named) or rb"(?!)")  # tokens that text can name
        self.break_id = self.encode(BREAK, add_special_tokens=False).ids
        spelled = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(LETTERS)[0][0]
        self.spelling = {0x80 + k: c for k, c in enumerate(spelled[1::2])} | {0xC3: spelled[0]}
        self.hashes, self.flat = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after the other, and where each row's begin (one more than rows)."""
        found = []
        for row, end in chunks(offsets):
            base = offsets[row]
            starts, ends, counts = word_spans(data[base : offsets[end]], offsets[row : end + 1] - base)
            found.append((starts + base, ends + base, counts, word_hashes(data[base : offsets[end]], starts, fold=False)))
        starts, ends, counts, hashed = (np.concatenate(c) for c in zip(*found))
        distinct, first, which = np.unique(hashed, return_index=True, return_inverse=True)
        fresh = ~self._holds(distinct)
        if fresh.any():
            self._learn(distinct[fresh], *_joined(data, starts[first[fresh]], ends[first[fresh]]))
        flat, past = self._flat(np.searchsorted(self.hashes, distinct)[which])
        if len(self.hashes) > CACHED_WORDS:
            self._keep(np.searchsorted(self.hashes, distinct))
        return flat, past[np.concatenate([[0], np.cumsum(counts)])]

    def _flat(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words at these places of the table, and where each word's begin (one more)."""
        size = self.size[at].astype(np.int64)
        past = np.concatenate([[0], np.cumsum(size)])
        return self.flat[np.repeat(self.begin[at] - past[:-1], size) + np.arange(past[-1])], past

    def _holds(self, distinct: np.ndarray) -> np.ndarray:
        if len(self.hashes) == 0:
            return np.zeros(len(distinct), bool)
        at = np.minimum(np.searchsorted(self.hashes, distinct), len(self.hashes) - 1)
        return self.hashes[at] == distinct

    def _keep(self, at: np.ndarray) -> None:
        self.flat, past = self._flat(at)
        self.hashes, self.begin, self.size = self.hashes[at], past[:-1], self.size[at]

    def _add(self, hashes: np.ndarray, flat: np.ndarray, size: np.ndarray) -> None:
        """Takes in words by their hashes, with the ids of all of them and how many each has."""
        order = np.argsort(hashes, kind="stable")
        begin = len(self.flat) + np.cumsum(size, dtype=np.int64) - size
        at = np.searchsorted(self.hashes, hashes[order])
        self.hashes = np.insert(self.hashes, at, hashes[order])
        self.begin, self.size = np.insert(self.begin, at, begin[order]), np.insert(self.size, at, size[order])
        self.flat = np.concatenate([self.flat, flat.astype(np.uint32)])

    def _learn(self, hashes: np.ndarray, words: np.ndarray, begin: np.ndarray) -> None:
        """Takes in words, joined, that the table does not hold."""
        low, plain = _lowered(words, begin)
        named = [m.start() for m in self.special.finditer(words.tobytes())]
        plain[np.searchsorted(begin, named, "right") - 1] = False
        end = np.append(begin[1:], len(words)) - 1
        if not plain.all():
            self._add(hashes[~plain], *self._whole([words[i:k].tobytes() for i, k in zip(begin[~plain], end[~plain])]))
        number = {b" ": 0}
        cut = PARTS.findall(_joined(low, begin[plain], end[plain])[0].tobytes())
        which = np.fromiter((number.setdefault(p, len(number)) for p in cut), np.int64, len(cut))
        del number[b" "], cut
        if not number:
            return
        parts = b" ".join(number)
        starts = np.cumsum([0, *(len(p) + 1 for p in number)])[:-1]
        hashed = word_hashes(np.frombuffer(parts, np.uint8), starts, fold=False)
        fresh = ~self._holds(hashed)
        if fresh.any():
            self._add(hashed[fresh], *self._modelled(list(compress(number, fresh))))
        flat, past = self._flat(np.searchsorted(self.hashes, hashed)[which[which > 0] - 1])
        ends = np.flatnonzero(which == 0)
        past = past[np.append(0, ends - np.arange(len(ends)))]  # where each word's ids begin
        size = np.diff(past).astype(np.int32)
        new = ~self._holds(hashes[plain])  # others are parts that came in just now
        self._add(hashes[plain][new], flat[np.repeat(new, size)], size[new])

    def _modelled(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts of plain words, all in lower case, and the number of each one's."""
        tokens, spelling = self.model.tokenize, self.spelling
        ids, ends = array("I"), []
        for p in parts:
            ids.extend([t.id for t in tokens(p.decode("latin-1").translate(spelling))])
            ends.append(len(ids))
        return np.array(ids, np.uint32), np.diff(ends, prepend=0).astype(np.int32)

    def _whole(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words by the whole tokenizer, and the number of each one's."""
        cut = []
        for w in words:
            core = w.rstrip(MARKS)
            if not self.special.search(w) and len(core) < len(w) and ENDS.search(core):
                cut.append([core, w[len(core) :]])
            else:
                cut.append([w])
        todo, parts = list(set(chain.from_iterable(cut))), {}
        for at in range(0, len(todo), 1024):
            parts.update(self._encoded(todo[at : at + 1024]))
        coded = [b"".join(map(parts.__getitem__, own)) for own in cut]
        return np.frombuffer(b"".join(coded), "<u4"), np.array([len(c) // 4 for c in coded], np.int32)

    def _encoded(self, parts: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        texts = [w.decode("utf-8", "replace") for w in parts]
        ids = np.array(self.encode(f" {BREAK} ".join(texts), add_special_tokens=False).ids, "<u4")
        ends = np.flatnonzero(ids == self.break_id[0])
        if len(self.break_id) == 1 and len(ends) == len(parts) - 1:
            coded = [c[1:].tobytes() if k else c.tobytes() for k, c in enumerate(np.split(ids, ends))]
        else:  # a word holds the break itself
            coded = [np.array(self.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        return zip(parts, coded)


def _worker_words(path: str) -> _Words:
    """The words that this Python worker has coded, kept from task to task."""
    held = sys.modules.setdefault("_kinseek_words", ModuleType("_kinseek_words")).__dict__
    if path not in held:
        held[path] = _Words(path)
    return held[path]


def _release() -> None:
    """Gives back what earlier stages and batches have left free in this Python worker."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library can
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def _pieces(path: str, capacity: int, end: int, keep: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.collect()
        _release()
        words, tail = _worker_words(path), np.array([end], np.uint32)
        for batch in batches:
            ids, (data, offsets) = batch.column("doc_id").to_pylist(), buffers(batch.column("text"))
            for first, last in chunks(offsets, GROUP_BYTES):
                rows = []
                flat, begin = words.ids(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
                for n, doc in enumerate(ids[first:last]):
                    coded = np.concatenate([flat[begin[n] : begin[n + 1]], tail]).astype("<u4").tobytes()
                    for k, start in enumerate(range(0, len(coded), 4 * capacity)):
                        own = coded[start : start + 4 * capacity]
                        rows.append((doc, k, start // 4, len(own) // 4, zlib.crc32(own), own if keep else None))
                columns = list(zip(*rows))
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][: 6 if keep else 5]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(types)]
                )
            _release()

    return cut


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END_TOKEN, keep_ids: bool = False) -> DataFrame:
    """`doc_id, piece, start, length, ids_crc32` (and `ids`, little-endian) of all pieces of `docs`."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if keep_ids else "")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(_pieces(tokenizer, capacity, end, keep_ids), schema)


@dataclass(frozen=True)
class Pattern:
    """`times` sequences that each hold the same `lengths`."""

    lengths: tuple[int, ...]
    times: int


def _best_fit(room: int, left: list[int], counts: Counter) -> list[int]:
    filling: list[int] = []
    at = bisect_right(left, room) - 1
    while room and at >= 0:
        uses = min(counts[left[at]], room // left[at])
        filling += [left[at]] * uses
        room -= uses * left[at]
        at = min(at, bisect_right(left, room)) - 1
    return filling


def _reachable(room: int, lengths: list[int], counts: Counter) -> list[int]:
    """At k, the sums up to `room` of the `k` smallest lengths, as bits of a number."""
    mask, sums = (1 << (room + 1)) - 1, 1
    out = [sums]
    for length in lengths:
        most, step = min(counts[length], room // length), 1
        while most > 0:
            step = min(step, most)
            sums |= sums << (step * length) & mask
            most -= step
            step *= 2
        out.append(sums)
    return out


def _descend(rest: int, below: int, lengths: list[int], counts: Counter, reach: list[int]) -> list[tuple[int, int]]:
    """(place, uses) of the `below` smallest lengths that sum to `rest`, the largest multiple first."""
    taken = []
    while rest:
        below = min(below, bisect_right(lengths, rest)) - 1
        uses = min(counts[lengths[below]], rest // lengths[below])
        while not reach[below] >> (rest - uses * lengths[below]) & 1:
            uses -= 1
        if uses:
            taken.append((below, uses))
            rest -= uses * lengths[below]
    return taken


def _fillings(room: int, left: list[int], counts: Counter, least: int, after: list[int] | None = None) -> Iterator[list[int]]:
    """Fillings of `room` that sum to `least` or more: less waste first, then large items first.

    Given `after`, those behind it. Every branch ends in a filling, as sums are known beforehand.
    """
    lengths = left[: bisect_right(left, room)]
    reach = _reachable(room, lengths, counts)
    target, taken = reach[-1].bit_length() - 1, None
    if after is not None:
        target = sum(after)
        taken = [(bisect_left(lengths, k), n) for k, n in sorted(Counter(after).items(), reverse=True)]
    while target >= least:
        if taken is None:
            taken = _descend(target, len(lengths), lengths, counts, reach)
            yield [lengths[at] for at, uses in taken for _ in range(uses)]
        rest, more = 0, None
        while taken and more is None:
            at, uses = taken.pop()
            rest += lengths[at] * uses
            for fewer in range(uses - 1, -1, -1):
                own = rest - fewer * lengths[at]
                if reach[at] >> own & 1:
                    more = taken + ([(at, fewer)] if fewer else []) + _descend(own, at, lengths, counts, reach)
                    break
        if more:
            taken = more
            yield [lengths[at] for at, uses in taken for _ in range(uses)]
        else:
            target, taken = (reach[-1] & ((1 << target) - 1)).bit_length() - 1, None


def _dominated(room: int, filling: list[int], left: list[int], counts: Counter) -> bool:
    """Whether one item that is left could take the place of none, one or more of `filling`, and is larger or replaces several."""
    used = Counter(filling)
    waste = room - sum(filling)
    free = 0
    for k in left[: bisect_right(left, room)]:
        if counts[k] > used[k]:
            free |= 1 << k
    some, several = 0, 0  # sums of one or more, and of two or more items
    for k in filling:
        several |= several << k | some << k
        some |= some << k | 1 << k
    sums, width = some | 1, 1  # those sums with up to `waste` added
    while width <= waste:
        step = min(width, waste + 1 - width)
        sums |= sums << step
        width += step
    larger = (some | 1) << 1
    width = 1
    while width < waste:
        step = min(width, waste - width)
        larger |= larger << step
        width += step
    return bool(free & several) or bool(waste and free & larger)


def _lower_bound(left: list[int], counts: Counter, capacity: int) -> int:
    """Sequences that any plan needs: for each size, large items cannot share with what is over the rest."""
    if not left:
        return 0
    size = np.array(left, np.int64)
    n = np.array([counts[k] for k in left], np.int64)
    number, total = np.append(0, np.cumsum(n)), np.append(0, np.cumsum(n * size))
    half = int(np.searchsorted(size, capacity // 2, "right"))  # those from here on are alone with smaller ones
    cut = np.append(0, size[:half])
    low = np.searchsorted(size, cut, "left")
    alone = np.maximum(half, np.searchsorted(size, capacity - cut, "right"))
    room = capacity * (number[alone] - number[half]) - (total[alone] - total[half])
    over = np.maximum(0, total[half] - total[low] - room)
    return int((number[-1] - number[half] + -(-over // capacity)).max())


def _taken(left: list[int], counts: Counter, pattern: Pattern, back: bool = False) -> None:
    for k, n in Counter(pattern.lengths).items():
        if back and not counts[k]:
            insort(left, k)
        counts[k] += n * pattern.times if back else -n * pattern.times
        if not counts[k]:
            del left[bisect_left(left, k)]


def _times(counts: Counter, lengths: tuple[int, ...]) -> int:
    return min(counts[k] // n for k, n in Counter(lengths).items())


def plan_patterns(histogram: dict[int, int], capacity: int = CAPACITY, nodes: int = SEARCH_NODES) -> list[Pattern]:
    """Patterns that take exactly the lengths of `histogram`, in few sequences."""
    plain = _patterns(histogram, capacity, _best_fit)
    counts = Counter({k: v for k, v in histogram.items() if v > 0})
    if not nodes or _used(plain) == _lower_bound(sorted(counts), counts, capacity):
        return plain
    return min(plain, _completed(counts, capacity, nodes), key=_used)


def _used(patterns: list[Pattern]) -> int:
    return sum(p.times for p in patterns)


def _patterns(histogram: dict[int, int], capacity: int, fill) -> list[Pattern]:
    counts = Counter({k: v for k, v in histogram.items() if v > 0})
    left = sorted(counts)
    found = []
    while left:
        largest = left[-1]
        counts[largest] -= 1
        filling = fill(capacity - largest, left, counts)
        counts[largest] += 1
        lengths = (largest, *filling)
        found.append(Pattern(lengths, _times(counts, lengths)))
        _taken(left, counts, found[-1])
    return found


def _completed(counts: Counter, capacity: int, nodes: int) -> list[Pattern]:
    """Branch and bound over undominated fillings and how often each is used.

    The first plan takes the least waste everywhere. From its end back, all other choices are
    tried that the bound leaves, until a plan meets the bound, none is left to try, or
    `nodes` choices were looked at; then the best plan so far is taken.
    """
    counts = Counter(counts)
    left = sorted(counts)
    goal, total = _lower_bound(left, counts, capacity), sum(k * n for k, n in counts.items())
    path = _patterns(counts, capacity, lambda room, left, counts: next(_fillings(room, left, counts, 0)))
    best, used = list(path), _used(path)
    for p in path:
        _taken(left, counts, p)
    wasted = capacity * used - total
    seen = 0

    def undo() -> Pattern:
        nonlocal used, wasted
        p = path.pop()
        _taken(left, counts, p, back=True)
        used -= p.times
        wasted -= p.times * (capacity - sum(p.lengths))
        return p

    def take(lengths: tuple[int, ...], times: int) -> None:
        nonlocal used, wasted
        path.append(Pattern(lengths, times))
        _taken(left, counts, path[-1])
        used += times
        wasted += times * (capacity - sum(lengths))

    def other(last: Pattern | None) -> bool:
        """Takes the choice behind `last` (or the first one); False if there is none."""
        nonlocal seen
        seen += 1
        if last and last.times > 1:
            take(last.lengths, last.times - 1)
            return True
        largest = left[-1]
        same = path[-1] if path and path[-1].lengths[0] == largest else None
        spare = capacity * (_used(best) - 1) - total - wasted  # waste that a better plan can have
        room = capacity - largest
        counts[largest] -= 1
        found = None
        for filling in _fillings(room, left, counts, max(0, room - spare), list(last.lengths[1:]) if last else None):
            # What the sequence before could have taken once more was tried there.
            if (not same or tuple(filling) != same.lengths[1:]) and not _dominated(room, filling, left, counts):
                found = (largest, *filling)
                break
            seen += 1
            if seen >= nodes:
                break
        counts[largest] += 1
        if found:
            take(found, _times(counts, found))
        return bool(found)

    while path and _used(best) > goal and seen < nodes:
        last: Pattern | None = undo()
        while seen < nodes and other(last):
            last = None
            if not left:
                if used < _used(best):
                    best = list(path)
                break
            if used + _lower_bound(left, counts, capacity) >= _used(best):
                break
    return best


def _intervals(patterns: list[Pattern]) -> tuple[np.ndarray, ...]:
    """Sorted keys (length, first rank) with first sequence, uses in it, and offset."""
    taken: Counter = Counter()
    rows, sequence = [], 0
    for p in patterns:
        offset = 0
        for length, uses in sorted(Counter(p.lengths).items(), reverse=True):
            rows.append(((length << 40) + taken[length], sequence, uses, offset))
            taken[length] += uses * p.times
            offset += uses * length
        sequence += p.times
    rows.sort()
    return tuple(np.array(c, np.int64) for c in zip(*rows)) if rows else tuple(np.zeros(0, np.int64) for _ in range(4))


def _placer(intervals: tuple[np.ndarray, ...], before: np.ndarray):
    key, sequence, uses, offset = intervals

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, row = batch.column("length").to_numpy(), batch.column("_row").to_numpy()
            rank = row - before[length]
            at = np.searchsorted(key, (length << 40) + rank, "right") - 1
            k = (length << 40) + rank - key[at]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")],
                    pa.array(sequence[at] + k // np.maximum(uses[at], 1)),
                    pa.array(offset[at] + k % np.maximum(uses[at], 1) * length),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return place


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END_TOKEN, nodes: int = SEARCH_NODES) -> DataFrame:
    """`doc_id, piece, start, length, ids_crc32, sequence_id, offset` of all pieces of `docs`."""
    with arrow_batches(docs.sparkSession, BATCH_BYTES):
        pieces = stage(token_pieces(docs, tokenizer, capacity, end))
    ordered = graph.with_totals_before(graph.in_order(pieces, ["length", "doc_id", "piece"]))
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    before = np.zeros(capacity + 1, np.int64)  # pieces that are shorter
    for length, n in histogram.items():
        before[length + 1 :] += n
    intervals = _intervals(plan_patterns(histogram, capacity, nodes))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ordered.select("doc_id", "piece", "start", "length", "ids_crc32", "_row").mapInArrow(_placer(intervals, before), schema)

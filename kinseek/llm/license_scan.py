"""Licence scans by template-markup matching.

A template is wording with optional and replaceable regions (`license_templates`). All templates
are compiled into one automaton over words: a mandatory word is a step, an optional region may be
stepped over, a replaceable region takes any A to B words. Its sets of states are turned into
single states when a text first needs them. The automaton starts at the words where some template
can start (its first two words, looked up for all words of a batch at once) and accepts a
stretch if all mandatory wording is there, exactly and in order; of stretches that start at one
word the longest counts. Phrases are templates without regions, so every place of theirs counts.

Case of A-Z, punctuation and white space do not matter. Regions at the two ends of a template
take nothing. Nothing is shuffled; a task holds a chunk of texts at a time, whole.

Defined results: a null or empty text has no words and a score of 0; ids may be null or repeat,
every row stands for itself; overlapping matches all count; an empty table gives no rows; extra
columns do not matter. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinseek.llm import words
from kinseek.llm.license_templates import PHRASES, TEMPLATES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TAG = re.compile(r"<<(.*?)>>", re.S)
CHUNK = 2 << 20  # bytes of text looked at together
STATES = 1 << 16  # joint states kept in a task; they are built anew beyond that
ANY = -1  # a step that takes any word
OTHER = 0  # the number of all words that no template has
MATCHES = "array<struct<label: string, start: long, end: long>>"

_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x30:0x3A] = np.arange(0x30, 0x3A)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


@dataclass
class Region:
    """Optional parts, or a replaceable stretch of `least` to `most` words."""

    parts: list = field(default_factory=list)
    least: int = 0
    most: int = 0


def parse(template: str) -> list:
    """Words and regions of a template; regions at its ends are left out."""
    stack: list[list] = [[]]
    at = 0
    for tag in [*TAG.finditer(template), None]:
        end = len(template) if tag is None else tag.start()
        stack[-1] += WORD.findall(lower(template[at:end]))
        if tag is None:
            break
        at, name = tag.end(), tag.group(1).strip()
        if name == "beginOptional":
            stack.append([])
        elif name == "endOptional" and len(stack) > 1:
            parts = stack.pop()
            stack[-1].append(Region(parts))
        elif bounds := re.fullmatch(r"var(?:;[^;]*)*?;words=(\d+)\.\.(\d+)(?:;.*)?", name):
            least, most = map(int, bounds.groups())
            if not 0 <= least <= most or not most:
                raise ValueError(f"a replaceable region of {least} to {most} words")
            stack[-1].append(Region([], least, most))
        else:
            raise ValueError(f"unknown or unmatched markup: {name}")
    if len(stack) > 1:
        raise ValueError("an optional region is not closed")
    parts = stack[0]
    while parts and isinstance(parts[0], Region):
        parts.pop(0)
    while parts and isinstance(parts[-1], Region) and parts[-1].most:
        parts.pop()
    if not any(isinstance(p, str) for p in parts):
        raise ValueError("a template needs mandatory words")
    return parts


class Automaton:
    """All templates as one automaton; joint states are built when first met."""

    def __init__(self, templates: Mapping[str, str]) -> None:
        self.labels = list(templates)
        self.words: dict[str, int] = {}
        self.steps: list[list[tuple[int, int]]] = []  # of a state: (word or ANY, next state)
        self.skips: list[list[int]] = []
        self.accepts: dict[int, int] = {}
        heads = []
        for k, template in enumerate(templates.values()):
            first = self._state()
            self.accepts[self._add(first, parse(template))] = k
            heads.append(first)
        self.start = self._closed(heads)
        self.heads = self._heads()
        self._forget()

    def _state(self) -> int:
        self.steps.append([])
        self.skips.append([])
        return len(self.steps) - 1

    def _step(self, state: int, word: int) -> int:
        after = self._state()
        self.steps[state].append((word, after))
        return after

    def _add(self, state: int, parts: list) -> int:
        """The state after `parts` from `state` on."""
        for part in parts:
            if isinstance(part, str):
                state = self._step(state, self.words.setdefault(part, len(self.words) + 1))
            elif part.most:
                open_ = []
                for n in range(part.most):
                    if n >= part.least:
                        open_.append(state)
                    state = self._step(state, ANY)
                for s in open_:
                    self.skips[s].append(state)
            else:
                end = self._add(state, part.parts)
                after = self._state()
                self.skips[end].append(after)
                self.skips[state].append(after)
                state = after
        return state

    def _closed(self, states: list[int]) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for after in self.skips[todo.pop()]:
                if after not in seen:
                    seen.add(after)
                    todo.append(after)
        return frozenset(seen)

    def _after(self, states: frozenset[int], word: int) -> frozenset[int]:
        return self._closed([after for s in states for w, after in self.steps[s] if w in (word, ANY)])

    def _heads(self) -> np.ndarray:
        """All first two words of a match, as word * (number of words + 1) + word.

        A template's first word is mandatory; a second place that may be any word (or none)
        stands for all words.
        """
        size, found = len(self.words) + 1, set()
        for first in {w for s in self.start for w, _ in self.steps[s]}:
            then = self._after(self.start, first)
            seconds = {w for s in then for w, _ in self.steps[s]}
            if ANY in seconds or any(s in self.accepts for s in then):
                seconds = set(range(size))
            found |= {first * size + w for w in seconds}
        return np.array(sorted(found), np.int64)

    def _forget(self) -> None:
        self._sets, self._numbers = [self.start], {self.start: 0}
        self._moves: list[dict[int, int]] = [{}]
        self._labels: list[tuple[int, ...]] = [()]

    def _move(self, number: int, word: int) -> int:
        after = self._after(self._sets[number], word)
        if not after:
            to = -1
        elif (to := self._numbers.get(after, -1)) < 0:
            to = self._numbers[after] = len(self._sets)
            self._sets.append(after)
            self._moves.append({})
            self._labels.append(tuple(sorted(self.accepts[s] for s in after if s in self.accepts)))
        self._moves[number][word] = to
        return to

    def matches(self, ids: list[int], start: int) -> list[tuple[int, int]]:
        """Label number and end of the longest match of every label that starts at `start`."""
        if len(self._sets) > STATES:
            self._forget()
        now, found = 0, {}
        for at in range(start, len(ids)):
            to = self._moves[now].get(ids[at])
            now = self._move(now, ids[at]) if to is None else to
            if now < 0:
                break
            for label in self._labels[now]:
                found[label] = at + 1
        return sorted(found.items())


def scan_rows(machine: Automaton, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, dict[int, list[tuple[int, int, int]]]]:
    """Number of words of every row, and label number, start and end of the matches of rows with any."""
    data = _FOLD[data]
    starts, _, counts = words.word_spans(data, offsets)
    if len(starts) < 1:
        return counts, {}
    listed = _hashed(list(machine.words))
    order = np.argsort(listed)
    hashes = words.word_hashes(data, starts, fold=False)
    near = np.minimum(np.searchsorted(listed[order], hashes), len(listed) - 1)
    ids = np.where(listed[order][near] == hashes, order[near] + 1, OTHER)
    begin = np.cumsum(counts) - counts
    row = words.row_of(counts)
    pair = ids * (len(listed) + 1) + np.append(ids[1:], OTHER)
    last = begin[counts > 0] + counts[counts > 0] - 1
    pair[last] = ids[last] * (len(listed) + 1) + OTHER
    head = machine.heads
    at = np.minimum(np.searchsorted(head, pair), len(head) - 1)
    found: dict[int, list[tuple[int, int, int]]] = {}
    for place in np.flatnonzero(head[at] == pair).tolist():
        k = int(row[place])
        low = int(begin[k])
        own = found.get(k)
        if own is None:
            own = found[k] = ([], ids[low : low + int(counts[k])].tolist())
        own[0].extend((label, place - low, end) for label, end in machine.matches(own[1], place - low))
    return counts, {k: sorted(own, key=lambda m: (m[1], m[0])) for k, (own, _) in found.items() if own}


def _hashed(listed: list[str]) -> np.ndarray:
    data, offsets = words.buffers(pa.array(listed))
    return words.word_hashes(data, offsets[:-1], fold=False)


def _covered(matches: list[tuple[int, int, int]]) -> int:
    """Words in at least one match; `matches` are ordered by start."""
    total = reach = 0
    for _, start, end in matches:
        total += max(0, end - max(start, reach))
        reach = max(reach, end)
    return total


def _scanner(templates: Mapping[str, str]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Automaton(templates)
        kind = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            data, offsets = words.buffers(batch.column("text"))
            for lo, hi in words.chunks(offsets, CHUNK):
                counts, found = scan_rows(machine, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                listed = [
                    [{"label": machine.labels[m], "start": s, "end": e} for m, s, e in found.get(k, ())] for k in range(hi - lo)
                ]
                covered = [_covered(found.get(k, [])) for k in range(hi - lo)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(lo, hi - lo),
                        pa.array(counts, pa.int64()),
                        pa.array(listed, kind),
                        pa.array(covered, pa.int64()),
                    ],
                    ["doc_id", "n_words", "matches", "n_covered"],
                )

    return scan


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] | None = None) -> DataFrame:
    """`doc_id, n_words, matches, n_covered` of every row of `docs` (doc_id, text).

    `matches` holds label, first word and the word after the last, ordered by start and then
    by the templates' order; `n_covered` counts the words that are in any of them.
    """
    templates = {**PHRASES, **TEMPLATES} if templates is None else dict(templates)
    Automaton(templates)  # broken markup fails here, not in a task
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return given.mapInArrow(_scanner(templates), f"doc_id long, n_words long, matches {MATCHES}, n_covered long")


def license_summary(docs: DataFrame) -> DataFrame:
    """Places of the phrases, labels of all templates and the share of words they cover."""
    found = scan_licenses(docs)
    base = F.filter("matches", lambda m: m["label"].isin(*PHRASES))

    def labels(matches):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")

    starts = F.transform("_base", lambda m: m["start"])
    return found.withColumn("_base", base).select(
        "doc_id",
        "n_words",
        F.size("_base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(F.col("_base")).alias("base_labels"),
        labels(F.col("matches")).alias("labels"),
        F.when(F.col("n_words") > 0, F.col("n_covered") / F.col("n_words")).otherwise(F.lit(0.0)).alias("score"),
    )

"""Words, hashes and n-grams of many texts at once, on the byte buffers of Arrow batches.

A word is a run of bytes other than space and 0x09-0x0D. Hashes are 64-bit sums of random
numbers drawn per byte and position, then mixed; two different words share one with
probability about 2**-64. Nothing here loops over words in Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 512 << 10  # texts hashed at once, at 8 bytes each and more; a longer text is alone

_random = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _random.integers(1, 2**63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE[_SPACE] = 0
_FOLDED = _BYTE.copy()
_FOLDED[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_PLACE = _random.integers(1, 2**63, 64, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string or binary column; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if data is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)
    at = at[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def chunks(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `most` bytes, or one row where that alone is longer."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end
        row = end


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the number of words of every row."""
    size = len(data)
    if size == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    solid = ~_SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    cut = offsets[(offsets > 0) & (offsets < size)]
    first[cut] |= solid[cut]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    last[cut - 1] |= solid[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def word_hashes(data: np.ndarray, starts: np.ndarray, fold: bool) -> np.ndarray:
    """A 64-bit hash of every word; with `fold`, A-Z count as a-z."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    body = data[starts[0] :]
    begin = starts - starts[0]
    place = np.arange(len(body), dtype=np.int64)
    place -= np.repeat(begin, np.diff(np.append(begin, len(body))))
    # A place past 64 takes the factors of its place modulo 64 and of its block of 64.
    block, place = place >> 6, place & 63
    value = (_FOLDED if fold else _BYTE)[body] * _PLACE[place]
    far = np.flatnonzero(block)
    if len(far):
        value[far] *= mix(block[far].astype(np.uint64)) | np.uint64(1)
    return mix(np.add.reduceat(value, begin))


def grams(hashes: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of `size` words that stay in one row, and their first words."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = hashes[: len(hashes) - size + 1] * _PLACE[0]
    for k in range(1, size):
        total = total + hashes[k : len(hashes) - size + 1 + k] * _PLACE[k]
    ends = np.repeat(np.cumsum(counts), counts)
    first = np.flatnonzero(np.arange(len(total)) + size <= ends[: len(total)])
    return mix(total[first]), first


def row_of(counts: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(counts)), counts)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of every row, repeated ones included, with the number of each row's.

    A row of fewer words than `size` has all its words as its only shingle; a row
    without words has none. A-Z count as a-z.
    """
    starts, _, counts = word_spans(data, offsets)
    hashed = word_hashes(data, starts, fold=True)
    shingles, first = grams(hashed, counts, size)
    rows = row_of(counts)[first]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short) == 0:
        return shingles, np.bincount(rows, minlength=len(counts))
    begin = np.cumsum(counts) - counts
    extra = np.empty(len(short), np.uint64)
    for i, row in enumerate(short):
        own = hashed[begin[row] : begin[row] + counts[row]]
        extra[i] = mix((own * _PLACE[: len(own)]).sum(dtype=np.uint64) + mix(np.array([len(own)], np.uint64)))[0]
    order = np.argsort(np.concatenate([rows, short]), kind="stable")
    return np.concatenate([shingles, extra])[order], np.bincount(
        np.concatenate([rows, short]), minlength=len(counts)
    )

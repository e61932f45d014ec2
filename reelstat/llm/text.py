"""Whole texts as arrays: Arrow batches cut into slices of bounded size, words found and hashed without a loop over words.

A word is a maximal run of bytes outside ``\\x20`` and ``\\x09-\\x0D``; as all of these are ASCII, that equals the same rule on
characters. Every helper keeps texts whole: a slice ends between two rows, never inside one.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 21

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
_BYTE_VALUE_LOWER = _BYTE_VALUE[LOWER]


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP, _DOWN = _powers(_ODD, 2 * _STEP), _powers(_ODD_INVERSE, 2 * _STEP)


#: What modules keep between slices and drop at the end of a task.
FORGET: list[Callable[[], None]] = []


def _release() -> None:
    """Drop what modules keep and give freed memory back to the machine, where the C library can."""
    for forget in FORGET:
        forget()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A step over batches after which its worker, which waits for the next task, keeps nothing."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _release()

    return task


#: ASCII letters and all bytes of other characters.
LETTERS = np.zeros(256, bool)
LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = True


@dataclass
class Slice:
    """Some rows of a batch: their other columns, and their texts as one byte array with row offsets (null: empty)."""

    columns: dict[str, pa.Array]
    data: np.ndarray
    offsets: np.ndarray
    null: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


class HashSet:
    """Places of 64-bit hashes in a sorted list; most hashes that are not in it are told apart by their highest bits."""

    def __init__(self, keys: np.ndarray, bits: int = 20):
        self.keys, self.shift = keys, np.uint64(64 - bits)
        self.may = np.zeros(1 << bits, bool)
        self.may[keys >> self.shift] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are in the list, and where in it each of these is."""
        maybe = np.flatnonzero(self.may[hashes >> self.shift])
        at = np.minimum(np.searchsorted(self.keys, hashes[maybe]), max(len(self.keys) - 1, 0))
        hit = self.keys[at] == hashes[maybe] if len(self.keys) else np.zeros(len(maybe), bool)
        return maybe[hit], at[hit]


@dataclass
class Words:
    """All words of a slice in order: 64-bit hash, row, first byte, byte after the last; ``first[i]`` is row i's first word."""

    hash: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[Slice]:
    """Rows of at most ``most`` text bytes together; a longer text comes alone, whole."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        if pa.types.is_null(column.type):
            column = column.cast(pa.string())
        column = column.cast(pa.large_binary())
        null = column.is_null().to_numpy(zero_copy_only=False)
        lengths = np.array([0], np.int64)
        if len(column):
            offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
            raw = column.buffers()[2]
            data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
            lengths = np.diff(offsets)
        others = {n: batch.column(i) for i, n in enumerate(batch.schema.names) if n != text}
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(np.cumsum(lengths[begin:]), most, side="right")) + begin
            end = max(end, begin + 1)
            o = offsets[begin : end + 1]
            yield Slice(
                {n: c.slice(begin, end - begin) for n, c in others.items()}, data[o[0] : o[-1]], o - o[0], null[begin:end]
            )
            begin = end


def word_spans(data: np.ndarray, offsets: np.ndarray, member: np.ndarray = ~_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """First byte and byte after the last of every run of ``member`` bytes; no run reaches over a row's end."""
    inside = member[data]
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.empty(len(data), bool)
    before[0], before[1:] = False, inside[:-1]
    cut = offsets[:-1][offsets[:-1] < len(data)]
    before[cut] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = False, inside[1:]
    after[cut[cut > 0] - 1] = False
    return start, np.flatnonzero(inside & ~after) + 1


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, values: np.ndarray = _BYTE_VALUE) -> np.ndarray:
    """Polynomial hash of each span (ascending, apart from each other), modulo 2**64, finished by ``mix``.

    The powers are kept for a bounded number of positions, so the bytes are worked off in steps.
    """
    out = np.empty(len(start), np.uint64)
    done = 0
    while done < len(start):
        base = start[done]
        upto = max(int(np.searchsorted(end, base + 2 * _STEP, side="right")), done + 1)
        s, e = start[done:upto] - base, end[done:upto] - base
        if e[-1] > 2 * _STEP:  # a single span longer than the kept powers
            value = np.zeros(1, np.uint64)
            for k in range(0, int(e[-1]), 2 * _STEP):
                piece = values[data[base + k : base + min(k + 2 * _STEP, int(e[-1]))]]
                value = mix(value + np.sum(piece * _UP[: len(piece)], dtype=np.uint64, keepdims=True))
            out[done] = value[0]
        else:
            total = np.empty(int(e[-1]) + 1, np.uint64)
            total[0] = 0
            piece = values[data[base : base + e[-1]]]
            np.cumsum(piece * _UP[: e[-1]], out=total[1:], dtype=np.uint64)
            out[done:upto] = (total[e] - total[s]) * _DOWN[s]
        done = upto
    return mix(out)


def words(part: Slice, lower: bool = True) -> Words:
    """The words of all rows of a slice, A-Z lower-cased for the hash unless told otherwise."""
    start, end = word_spans(part.data, part.offsets)
    first = np.searchsorted(start, part.offsets).astype(np.int64)
    row = np.repeat(np.arange(len(part)), np.diff(first))
    return Words(span_hash(part.data, start, end, _BYTE_VALUE_LOWER if lower else _BYTE_VALUE), row, start, end, first)


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word windows, and the offsets of each row's windows. A row with fewer words, but one, has its
    whole sequence as the only shingle; a row without words has none."""
    count = np.diff(w.first)
    per_row = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    offsets = np.concatenate([[0], np.cumsum(per_row)])
    rows = np.repeat(np.arange(len(count)), per_row)
    at = np.arange(len(rows)) - offsets[rows] + w.first[:-1][rows]
    width = np.minimum(count, k)[rows]
    gram = np.zeros(len(rows), np.uint64)
    padded = np.concatenate([w.hash, np.zeros(k, np.uint64)])
    for j in range(k):
        factor = np.uint64((0xD6E8FEB86659FD93 * (2 * j + 1) + 2) % (1 << 64) | 1)
        gram += np.where(j < width, mix(padded[at + j] + np.uint64(j)) * factor, np.uint64(0))
    return mix(gram + width.astype(np.uint64)), offsets

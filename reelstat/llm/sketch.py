"""Candidates that share a key, parted by bounds on their similarity before whole sets are sent.

The sketch of a set holds one bit for each cell of its grams: whether an odd number of them falls into the cell. Sketches of two
sets differ in at most as many bits as the sets differ in grams, so a pair is left out only if it cannot reach the threshold. Unrelated
sets differ in nearly half of the cells, which are about as many as the grams; sets that are much larger than ``MOST_BITS`` pass.
A sketch folded in half is the sketch over half as many cells.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa

from reelstat.llm.blocks import grouped, unpacked
from reelstat.llm.components import forest
from reelstat.llm.text import mix, released

LEAST_BITS, MOST_BITS = 128, 1024
#: Rows of one key that are held against each other at once; more are cut into blocks, each pair of which is a unit.
MEETING_ROWS = 4096
#: Units of more rows are walked link by link, so that near copies are not all held against each other.
PAIRWISE_ROWS = 1024
PAIRS_AT_ONCE = 1 << 17
ROWS_AT_ONCE = 1 << 14


def sketch(grams: np.ndarray) -> bytes:
    """The sketch of a set of distinct grams; its length follows the size of the set."""
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (len(grams) - 1).bit_length()))
    cell = (grams & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(cell, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, hashes, nodes) sorted by bucket: (unit, node) for the nodes of each hash that more than one has.

    A unit is named by its nodes, so those that meet in many hashes are one unit however often they do. Nodes beyond ``MEETING_ROWS``
    are cut into blocks, and each two blocks are a unit.
    """
    for rows in grouped(batches):
        h = np.concatenate([unpacked(x) for _, x, _ in rows])
        node = np.concatenate([np.frombuffer(x, np.int64) for _, _, x in rows])
        order = np.argsort(h, kind="stable")
        h, node = h[order], node[order]
        same = h[1:] == h[:-1]
        met = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        h, node = h[met], node[met]
        order = np.lexsort((node, h))
        h, node = h[order], node[order]
        fresh = np.concatenate([np.ones(min(len(h), 1), bool), (h[1:] != h[:-1]) | (node[1:] != node[:-1])])
        h, node = h[fresh], node[fresh]
        first = np.flatnonzero(np.concatenate([np.ones(min(len(h), 1), bool), h[1:] != h[:-1]]))
        size = np.diff(np.append(first, len(h)))
        few = (size > 1) & (size <= MEETING_ROWS)
        if few.any():
            unit = np.add.reduceat(mix(node.view(np.uint64)), first)
            keep = np.repeat(few, size)
            yield _met(np.repeat(unit[few], size[few]), node[keep])
        for k in np.flatnonzero(size > MEETING_ROWS):
            parts = np.array_split(node[first[k] : first[k] + size[k]], -(-int(size[k]) // MEETING_ROWS))
            for j, upper in enumerate(parts):
                for lower in parts[:j]:
                    both = np.concatenate([lower, upper])
                    yield _met(np.full(len(both), np.sum(mix(both.view(np.uint64)), dtype=np.uint64)), both)


def _met(unit: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(unit.view(np.int64)), pa.array(node)], ["unit", "node"])


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by the first column, some units at a time, each whole."""
    held, count = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        unit = batch.column(0).to_numpy()
        last = held[-1].column(0)[-1].as_py() if held else None
        cut = int(np.searchsorted(unit, unit[-1]))
        if cut or unit[0] != last:
            if count + cut >= ROWS_AT_ONCE and (cut or held):
                yield pa.Table.from_batches([*held, batch.slice(0, cut)])
                held, count, batch = [], 0, batch.slice(cut)
        held.append(batch)
        count += batch.num_rows
    if held:
        yield pa.Table.from_batches(held)


class _Sketches:
    """Sketches of some rows, folded to every length, and the test whether two rows may reach the threshold."""

    def __init__(self, n: np.ndarray, held: list[bytes], threshold: Fraction):
        self.n, self.up, self.down = n, threshold.numerator, threshold.denominator
        self.level = np.array([len(x) // 8 for x in held])
        # a row for each 64 cells, zero for rows of shorter sketches
        self.words: dict[int, np.ndarray] = {}
        longer = np.zeros((2 * MOST_BITS // 64, len(held)), np.uint64)
        bits = MOST_BITS // 64
        while bits >= LEAST_BITS // 64:
            now = longer[:bits] ^ longer[bits:]
            own = np.flatnonzero(self.level == bits)
            if len(own):
                now[:, own] = np.frombuffer(b"".join(held[i] for i in own), np.uint64).reshape(-1, bits).T
            self.words[bits] = longer = now
            bits //= 2

    def may(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether rows i and j, one by one, may be linked."""
        total = self.n[i] + self.n[j]
        # the sets differ in d = x + y - 2 I grams; I / (x + y - I) >= up / down  <=>  d * (up + down) <= (x + y) * (down - up)
        out = np.abs(self.n[i] - self.n[j]) * (self.up + self.down) <= total * (self.down - self.up)
        level = np.minimum(self.level[i], self.level[j])
        for bits, words in self.words.items():
            at = np.flatnonzero(out & (level == bits))
            if len(at):
                differ = np.zeros(len(at), np.int64)
                for w in words:
                    differ += np.bitwise_count(w[i[at]] ^ w[j[at]])
                out[at] = differ * (self.up + self.down) <= total[at] * (self.down - self.up)
        return out


def _pairs(first: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of each unit, a bounded number at once."""
    row = np.arange(int(size.sum())) + np.repeat(first - (np.cumsum(size) - size), size)
    after = np.repeat(first + size, size) - row - 1
    done, ends = 0, np.cumsum(after)
    while done < len(row):
        upto = max(int(np.searchsorted(ends, (ends[done - 1] if done else 0) + PAIRS_AT_ONCE, side="right")), done + 1)
        i = np.repeat(row[done:upto], after[done:upto])
        begin = np.cumsum(after[done:upto]) - after[done:upto]
        yield i, i + 1 + np.arange(len(i)) - np.repeat(begin, after[done:upto])
        done = upto


def _walked(rows: np.ndarray, may) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links from rows to the first one of their component: rows already linked are not held against each other."""
    rest = rows
    while len(rest) > 1:
        root, front, rest = rest[0], rest[:1], rest[1:]
        while len(front) and len(rest):
            now = front[: max(1, PAIRS_AT_ONCE // len(rest))]
            hit = may(np.repeat(now, len(rest)), np.tile(rest, len(now))).reshape(len(now), -1).any(axis=0)
            found, rest = rest[hit], rest[~hit]
            front = np.concatenate([front[len(now) :], found])
            yield found, np.full(len(found), root)


def possible(threshold: Fraction):
    """(unit, node, n, sketch) sorted by unit: links between the nodes of a unit that may reach the threshold, as a forest."""

    def run(batches):
        for part in _whole(batches):
            unit, node = part.column("unit").to_numpy(), part.column("node").to_numpy()
            sketches = _Sketches(part.column("n").to_numpy(), part.column("sketch").to_pylist(), threshold)
            first = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
            size = np.diff(np.append(first, len(unit)))
            few = size <= PAIRWISE_ROWS
            a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for i, j in _pairs(first[few], size[few]):
                hit = sketches.may(i, j)
                a.append(i[hit])
                b.append(j[hit])
            for k in np.flatnonzero(~few):
                for i, j in _walked(np.arange(first[k], first[k] + size[k]), sketches.may):
                    a.append(i)
                    b.append(j)
            x, y = forest(node, np.concatenate(a), np.concatenate(b))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["a", "b"])

    return released(run)

"""Language-model scoring by context-tree weighting over bytes.

A text's bytes (A-Z lower-cased, one end byte behind) are decomposed into binary decisions, eight a byte. For every context of up
to ``DEPTH`` bytes that occurs in the training documents, and each decision in it, Krichevsky-Trofimov estimates come from counts, and
the weighting mixes the estimates of all depths by how well they code the training text. Since such block probabilities
depend on counts alone, the tree is trained by counting in any order and is exact. No context is left out: the tree grows with the input.

The tree is a table, cut by the last ``SPLIT`` bytes of a context. All contexts longer than that lie below one of these cuts, in one bucket, and are
weighted there from the deepest up; what their roots pass on meets in the few shorter contexts (at most 2**16 of two bytes, with 255 decisions
each), which the driver weighs and sends to all tasks. A text's bytes are scored by a shuffle: each chunk of text asks the buckets for
its distinct (context, byte) pairs, and the answers meet the chunk's text again, slice by slice.

Beside it stands a unigram baseline over words with exact counts. Words with at least one 2**20-th of the tokens (at most 2**20
words) are sent to every task; the other words of each slice of text go to the counts by hash, and their sums come back by
slice. No word shuffled holds more than that share, so none is hot.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstat.llm.blocks import buckets_of, grouped
from reelstat.llm.storage import Scratch, materialise, repartition_count
from reelstat.llm.text import LOWER, Slice, mix, released, slices, words

DEPTH, SPLIT = 5, 3
HOT_SHARE = 1 << 20
END = 0xFF  # no byte of UTF-8
#: Distinct keys that a task counts before it sends them on, and bytes of a chunk at most (a longer text is a chunk of its own).
HELD, CHUNK_BYTES = 1 << 20, 1 << 25
#: Buckets of contexts for each of the session's shuffle partitions.
FINER = 8


def _packed(values: np.ndarray) -> bytes:
    """Numbers in less space: their bytes by significance, as the high ones repeat, compressed behind their number."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _unpacked(held: bytes, kind: type) -> np.ndarray:
    raw = pa.decompress(held[8:], int.from_bytes(held[:8], "little"), "zstd", asbytes=True)
    return np.frombuffer(raw, np.uint8).reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind).ravel()


def _mask(depth: int) -> np.uint64:
    return np.uint64((1 << (8 * depth)) - 1)


def _symbols(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of all rows, each row ended by ``END`` and begun after ``DEPTH`` of them, context << 8 | byte; and row offsets."""
    rows = np.arange(len(part))
    lengths = np.diff(part.offsets)
    text = np.ones(len(part.data) + DEPTH * len(part) + 1, bool)
    text[-1] = False
    text[((part.offsets[:-1] + DEPTH * rows)[:, None] + np.arange(DEPTH)).ravel()] = False
    padded = np.full(len(text), END, np.uint64)
    padded[text] = LOWER[part.data]
    keys = padded[DEPTH:].copy()
    for back in range(1, DEPTH + 1):
        keys |= padded[DEPTH - back : len(padded) - back] << np.uint64(8 * back)
    text[part.offsets[1:] + DEPTH * (rows + 1)] = True  # the end behind each row
    offsets = np.concatenate([[0], np.cumsum(lengths + 1)])
    keys = keys[text[DEPTH:]]
    return keys, offsets


class _Counter:
    """Counts of keys with bounded memory: ``full`` tells when to send them."""

    def __init__(self):
        self.keys, self.counts, self.waiting = np.zeros(0, np.uint64), np.zeros(0, np.int64), []

    def add(self, keys: np.ndarray) -> None:
        self.waiting.append(np.unique(keys, return_counts=True))
        if sum(len(k) for k, _ in self.waiting) > HELD:
            self.settle()

    def settle(self) -> None:
        keys = np.concatenate([self.keys, *(k.astype(np.uint64) for k, _ in self.waiting)])
        counts = np.concatenate([self.counts, *(c for _, c in self.waiting)])
        self.keys, self.counts = _summed(keys, counts)
        self.waiting = []

    @property
    def full(self) -> bool:
        return len(self.keys) > HELD


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


_COUNTS = "bucket int, keys binary, counts binary"
GRAMS = 1 << 20  # buckets of contexts are numbered behind those of words


def _cut(bucket_hash: np.ndarray, buckets: int, *values: np.ndarray) -> tuple[np.ndarray, list[list[bytes]]]:
    """The buckets that some values fall into by hash, and the values of each, packed."""
    order = np.argsort(bucket_hash, kind="stable")
    bounds = buckets_of(bucket_hash[order], buckets)
    full = np.flatnonzero(np.diff(bounds))
    held = [v[order] for v in values]
    return full, [[_packed(v[bounds[j] : bounds[j + 1]]) for j in full] for v in held]


def _place(keys: np.ndarray) -> np.ndarray:
    """The hash that deals (context, byte) keys out: of the last bytes of the context, so a subtree stays together."""
    return mix((keys >> np.uint64(8)) & _mask(SPLIT))


def _count(buckets: int):
    """Word counts and (context, byte) counts of the training rows, by bucket."""

    def sent(base: int, buckets: int, bucket_hash: np.ndarray, c: _Counter) -> pa.RecordBatch:
        full, blobs = _cut(bucket_hash, buckets, c.keys, c.counts)
        return pa.RecordBatch.from_arrays([pa.array((full + base).astype(np.int32)), *(pa.array(x, pa.binary()) for x in blobs)], ["bucket", "keys", "counts"])

    def word_batch(c: _Counter) -> pa.RecordBatch:
        c.settle()
        return sent(0, buckets, c.keys, c)

    def gram_batch(c: _Counter) -> pa.RecordBatch:
        c.settle()
        return sent(GRAMS, buckets * FINER, _place(c.keys), c)

    def run(batches):
        word, gram = _Counter(), _Counter()
        for part in slices(batches):
            word.add(words(part).hash)
            gram.add(_symbols(part)[0])
            if word.full:
                yield word_batch(word)
                word = _Counter()
            if gram.full:
                yield gram_batch(gram)
                gram = _Counter()
        yield word_batch(word)
        yield gram_batch(gram)

    return released(run)


def _merge(batches):
    """Counts of each bucket summed, with their number and total."""
    for rows in grouped(batches):
        keys, counts = _summed(np.concatenate([_unpacked(k, np.uint64) for _, k, _ in rows]), np.concatenate([_unpacked(c, np.int64) for _, _, c in rows]))
        yield pa.RecordBatch.from_pylist(
            [{"bucket": rows[0][0], "keys": keys.tobytes(), "counts": counts.tobytes(), "n": len(keys), "total": int(counts.sum())}],
            pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("n", pa.int64()), ("total", pa.int64())]),
        )


def _frequent(least: float):
    """Words with at least so many tokens."""

    def run(batches):
        for batch in batches:
            for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                keys, counts = np.frombuffer(k, np.uint64), np.frombuffer(c, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys[counts >= least].view(np.int64)), pa.array(counts[counts >= least])], ["key", "n"])

    return run


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after eight steps up, for x of one half or more."""
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


def _log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov block probability."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0) - math.log(math.pi)


class Decisions:
    """The binary decisions of contexts of one depth, by context << 8 | decision (a one before the bits already known), ascending: how often
    each bit came, and after ``mixed_from`` the probability that the path of contexts down to here gives a one, and the weight that
    it leaves to longer contexts."""

    def __init__(self, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray):
        self.keys, self.zeros, self.ones = keys, zeros, ones
        self.block = _log_kt(zeros, ones)
        self.weighted = self.block
        self.stop = np.ones(len(keys))
        self.mixed, self.left = np.zeros(len(keys)), np.ones(len(keys))

    @classmethod
    def of(cls, keys: np.ndarray, counts: np.ndarray, depth: int) -> Decisions:
        """From (context << 8 | byte) of any greater depth and their counts."""
        context, byte = (keys >> np.uint64(8)) & _mask(depth), keys & np.uint64(0xFF)
        found = []
        for level in range(8):
            decision = np.uint64(1 << level) | (byte >> np.uint64(8 - level))
            bit = ((byte >> np.uint64(7 - level)) & np.uint64(1)).astype(float)
            found.append((context << np.uint64(8) | decision, counts * (1 - bit), counts * bit))
        k, zeros, ones = (np.concatenate(x) for x in zip(*found, strict=True))
        names, index = np.unique(k, return_inverse=True)
        return cls(names, np.bincount(index, zeros, len(names)), np.bincount(index, ones, len(names)))

    def weigh(self, below: np.ndarray) -> None:
        """Mix the own estimate with what all longer contexts give together (logarithms of block probabilities)."""
        self.weighted = np.logaddexp(self.block, below) - math.log(2)
        self.stop = np.exp(self.block - self.weighted - math.log(2))

    def passed_on(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """For contexts of ``depth`` bytes: the keys of those one byte shorter, and the sums of the weighted logarithms below them."""
        shorter = ((self.keys >> np.uint64(8)) & _mask(depth - 1)) << np.uint64(8) | (self.keys & np.uint64(0xFF))
        names, index = np.unique(shorter, return_inverse=True)
        return names, np.bincount(index, self.weighted, len(names))

    def mixed_from(self, above: Decisions | None, depth: int) -> None:
        """Follow the path of contexts from the one a byte shorter, which occurs wherever this one does."""
        estimate = (self.ones + 0.5) / (self.zeros + self.ones + 1)
        if above is None:
            mixed, left = np.zeros(len(self.keys)), np.ones(len(self.keys))
        else:
            shorter = ((self.keys >> np.uint64(8)) & _mask(depth - 1)) << np.uint64(8) | (self.keys & np.uint64(0xFF))
            at = np.searchsorted(above.keys, shorter)
            mixed, left = above.mixed[at], above.left[at]
        self.mixed, self.left = mixed + left * self.stop * estimate, left * (1 - self.stop)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are here, and where."""
        if not len(self.keys):
            return np.zeros(len(keys), bool), np.zeros(len(keys), int)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[at] == keys, at


def _weighed(levels: list[Decisions], lowest: int) -> None:
    """Weigh consecutive depths, given from the shallowest, ``lowest`` the depth of the last one, whose weights are known."""
    for k in range(len(levels) - 2, -1, -1):
        names, below = levels[k + 1].passed_on(lowest - (len(levels) - 2 - k))
        levels[k].weigh(below[np.searchsorted(names, levels[k].keys)])


class ContextTree:
    """log10 probabilities of bytes after contexts, from the shorter contexts (``top``: depths 0 to SPLIT - 1) and a bucket's counts."""

    def __init__(self, top: list[Decisions], keys: np.ndarray, counts: np.ndarray):
        self.keys = keys
        lower = self.subtrees(keys, counts)
        above = top[-1] if top else None
        for k, own in enumerate(lower):
            own.mixed_from(above, SPLIT + k)
            above = own
        self.levels = [*top, *lower]
        self.known = self._log10(keys)

    @staticmethod
    def subtrees(keys: np.ndarray, counts: np.ndarray) -> list[Decisions]:
        """The decisions of the contexts of SPLIT to DEPTH bytes, weighed."""
        levels = [Decisions.of(keys, counts.astype(float), d) for d in range(SPLIT, DEPTH + 1)]
        _weighed(levels, DEPTH)
        return levels

    @staticmethod
    def top(keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray) -> list[Decisions]:
        """The depths 0 to SPLIT - 1, from the decisions of the longest of these (ascending) and what their subtrees give."""
        levels = [Decisions(keys, zeros, ones)]
        levels[0].weigh(below)
        for d in range(SPLIT - 2, -1, -1):
            own = levels[0]
            shorter = ((own.keys >> np.uint64(8)) & _mask(d)) << np.uint64(8) | (own.keys & np.uint64(0xFF))
            names, index = np.unique(shorter, return_inverse=True)
            levels.insert(0, Decisions(names, np.bincount(index, own.zeros, len(names)), np.bincount(index, own.ones, len(names))))
            levels[0].weigh(own.passed_on(d + 1)[1])
        above = None
        for d, own in enumerate(levels):
            own.mixed_from(above, d)
            above = own
        return levels

    def _log10(self, keys: np.ndarray) -> np.ndarray:
        context, byte = keys >> np.uint64(8), keys & np.uint64(0xFF)
        total = np.zeros(len(keys))
        for level in range(8):
            decision = np.uint64(1 << level) | (byte >> np.uint64(8 - level))
            one = np.full(len(keys), 0.5)
            rest = np.arange(len(keys))  # those for which every shorter context is known
            for depth, own in enumerate(self.levels):
                hit, at = own.find((context[rest] & _mask(depth)) << np.uint64(8) | decision[rest])
                rest, at = rest[hit], at[hit]
                # what is left goes to a context that never occurred, whose estimate is even
                one[rest] = own.mixed[at] + (own.left[at] * 0.5 if depth < DEPTH else 0)
            bit = (byte >> np.uint64(7 - level)) & np.uint64(1)
            total += np.log10(np.where(bit == 1, one, 1 - one))
        return total

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """For (context << 8 | byte) keys; those that were met in training are looked up."""
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        met = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        out = np.empty(len(keys))
        out[met] = self.known[at[met]]
        out[~met] = self._log10(keys[~met])
        return out


def _roots(batches):
    """For each decision of the contexts just above the cut, what a bucket's subtrees hold and give."""
    for batch in batches:
        for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            roots = ContextTree.subtrees(np.frombuffer(k, np.uint64), np.frombuffer(c, np.int64))[0]
            names, below = roots.passed_on(SPLIT)
            shorter = ((roots.keys >> np.uint64(8)) & _mask(SPLIT - 1)) << np.uint64(8) | (roots.keys & np.uint64(0xFF))
            index = np.searchsorted(names, shorter)
            sums = [np.bincount(index, x, len(names)) for x in (roots.zeros, roots.ones)]
            yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), *map(pa.array, sums), pa.array(below)], ["key", "zeros", "ones", "below"])


_SCORED = "kind int, chunk long, slice long, bucket int, a binary, b binary, c binary, d binary, e binary, f binary, g binary"
#: Rows of ``_SCORED``: in a bucket its counts come first, in a chunk the answers.
COUNTS, GRAM_ASK, WORD_ASK, GRAM_ANSWER, WORD_ANSWER, TEXT = range(6)


def _scored(**columns) -> pa.RecordBatch:
    types = {"kind": pa.int32(), "chunk": pa.int64(), "slice": pa.int64(), "bucket": pa.int32()}
    n = len(columns["kind"])
    names = [x.split()[0] for x in _SCORED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(columns.get(c, [None] * n), types.get(c, pa.binary())) for c in names], names)


def _score(model, buckets: int):
    """TEXT, a row for each slice: ids, held out, tokens, known tokens, logarithms of the frequent words, bytes, offsets. WORD_ASK: the other
    words of the slice by bucket: hashes and rows. GRAM_ASK: the distinct keys of a chunk of slices by bucket."""

    def asked(chunk: int, gram: _Counter) -> pa.RecordBatch:
        gram.settle()
        full, (blobs,) = _cut(_place(gram.keys), buckets * FINER, gram.keys)
        return _scored(kind=[GRAM_ASK] * len(full), chunk=[chunk] * len(full), bucket=full + GRAMS, a=blobs)

    def run(batches):
        hot, hot_logs, end_log, end_known = model.value
        number = chunk = TaskContext.get().partitionId() << 32
        gram, size = _Counter(), 0
        for part in slices(batches):
            if gram.full or (size and size + len(part.data) > CHUNK_BYTES):
                yield asked(chunk, gram)
                chunk, gram, size = chunk + 1, _Counter(), 0
            gram.add(_symbols(part)[0])
            size += len(part.data)
            w = words(part)
            at = np.minimum(np.searchsorted(hot, w.hash), max(len(hot) - 1, 0))
            frequent = hot[at] == w.hash if len(hot) else np.zeros(len(w.hash), bool)
            logs = np.bincount(w.row[frequent], hot_logs[at[frequent]], len(part)) + end_log
            known = np.bincount(w.row[frequent], minlength=len(part)) + end_known
            ids = part.columns["doc_id"].cast(pa.int64())
            blob = lambda x: [np.ascontiguousarray(x).tobytes()]
            yield _scored(
                kind=[TEXT],
                chunk=[chunk],
                slice=[number],
                a=[_ipc(ids)],
                b=blob(part.columns["held_out"].to_numpy(zero_copy_only=False).astype(np.uint8)),
                c=blob(np.diff(w.first).astype(np.int64) + 1),
                d=blob(known.astype(np.int64)),
                e=blob(logs.astype(np.float64)),
                f=[_packed(part.data)],
                g=blob(part.offsets.astype(np.int64)),
            )
            full, (hashes, rows) = _cut(w.hash[~frequent], buckets, w.hash[~frequent], w.row[~frequent].astype(np.uint32))
            n = len(full)
            yield _scored(kind=[WORD_ASK] * n, chunk=[chunk] * n, slice=[number] * n, bucket=full, a=hashes, b=rows)
            number += 1
        yield asked(chunk, gram)

    return released(run)


def _ipc(array: pa.Array) -> bytes:
    """An array with its nulls as bytes."""
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([array], ["x"])
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _look_up(top):
    """Per bucket the counts come first, then what one chunk or slice after another asks. Words: those known, and logarithms by row;
    (context, byte) keys: the keys and their logarithms."""

    def run(batches):
        bucket, keys, logs, tree = None, np.zeros(0, np.uint64), np.zeros(0), None
        for batch in batches:
            for kind, chunk, number, b, a, second in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if b != bucket:
                    bucket, keys, logs, tree = b, np.zeros(0, np.uint64), np.zeros(0), None
                if kind == COUNTS:
                    keys, counts = np.frombuffer(a, np.uint64), np.frombuffer(second, np.int64)
                    if b < GRAMS:
                        logs = np.log10(counts + 1.0)
                    else:
                        tree = ContextTree(top.value, keys, counts)
                elif kind == WORD_ASK:
                    h, row = _unpacked(a, np.uint64), _unpacked(second, np.uint32)
                    at = np.minimum(np.searchsorted(keys, h), max(len(keys) - 1, 0))
                    known = keys[at] == h if len(keys) else np.zeros(len(h), bool)
                    rows, index = np.unique(row[known], return_inverse=True)
                    n_known, found = np.bincount(index, minlength=len(rows)).astype(np.int64), np.bincount(index, logs[at[known]], len(rows))
                    yield _scored(kind=[WORD_ANSWER], chunk=[chunk], slice=[number], a=[rows.tobytes()], b=[n_known.tobytes()], c=[found.tobytes()])
                else:
                    tree = tree or ContextTree(top.value, np.zeros(0, np.uint64), np.zeros(0, np.int64))
                    answer = tree.log10(_unpacked(a, np.uint64)).astype(np.float32)
                    yield _scored(kind=[GRAM_ANSWER], chunk=[chunk], a=[a], b=[_packed(answer)])

    return released(run)


_RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, logs double, score double"


def _looked_up(asked: np.ndarray, keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The values of some (context, byte) keys, all of which are in the ascending ``keys``: looked up in ascending order, a run at a time
    whose keys and places fit 64 bits together, as numbers are sorted far faster than places."""
    spare = np.uint64(64 - 8 * (DEPTH + 1))
    out = np.empty(len(asked))
    for begin in range(0, len(asked), 1 << int(spare)):
        run = asked[begin : begin + (1 << int(spare))]
        both = np.sort(run << spare | np.arange(len(run), dtype=np.uint64))
        place = (both & np.uint64((1 << int(spare)) - 1)).astype(np.int64)
        out[begin + place] = values[np.searchsorted(keys, both >> spare)]
    return out


def _gathered(batches):
    """The answers to a chunk come first, then its slices: the sums over the words and bytes of each row."""
    now, keys, logs, of_words = None, [], [], {}
    for batch in batches:
        for chunk, kind, number, a, b, c, d, e, f, g in zip(*(batch.column(i).to_pylist() for i in range(10)), strict=True):
            if chunk != now:
                now, keys, logs, of_words = chunk, [], [], {}
            if kind == GRAM_ANSWER:
                keys.append(_unpacked(a, np.uint64))
                logs.append(_unpacked(b, np.float32))
                continue
            if kind == WORD_ANSWER:
                of_words.setdefault(number, []).append((a, b, c))
                continue
            if isinstance(keys, list):  # all answers are here
                keys, logs = np.concatenate([np.zeros(0, np.uint64), *keys]), np.concatenate([np.zeros(0, np.float32), *logs])
                order = np.argsort(keys, kind="stable")
                keys, logs = keys[order], logs[order].astype(np.float64)
            ids = pa.ipc.open_stream(a).read_next_batch().column(0)
            known, base = np.frombuffer(d, np.int64).copy(), np.frombuffer(e, np.float64).copy()
            for rows, n, found in of_words.pop(number, []):
                at = np.frombuffer(rows, np.uint32)
                known[at] += np.frombuffer(n, np.int64)
                base[at] += np.frombuffer(found, np.float64)
            offsets = np.frombuffer(g, np.int64)
            asked, bounds = _symbols(Slice({}, _unpacked(f, np.uint8), offsets, np.zeros(len(offsets) - 1, bool)))
            total = np.concatenate([[0.0], np.cumsum(_looked_up(asked, keys, logs))])
            score = total[bounds[1:]] - total[bounds[:-1]]
            held = pa.array(np.frombuffer(b, np.uint8).astype(bool))
            columns = [ids, held, pa.array(np.frombuffer(c, np.int64)), pa.array(known), pa.array(base), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in _RESULT.split(", ")])


def scored(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score for each row of ``docs``.

    The models learn from the rows whose ``held_out`` is not true. ``score`` is the log10 probability of the whole text (null:
    empty) with its end under context-tree weighting: its code length in bits is ``-score * log2(10)``. Tokens are the words and one end; ``base_score`` sums log10((c + 1) / (N + V + 1)) over them, where c is the token's count,
    N all and V distinct training tokens. Equal rows are counted and scored alike, a row with a null doc_id like any other;
    other columns are ignored; an empty table gives an empty result, and without training rows every estimate is even.
    """
    with Scratch(docs.sparkSession) as scratch:
        return _scores(docs, held_out, scratch)


def _scores(docs: DataFrame, held_out: Column, scratch: Scratch) -> DataFrame:
    spark, buckets = docs.sparkSession, repartition_count(docs)
    text = F.col("text").cast("string").alias("text")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text, F.coalesce(held_out, F.lit(False)).alias("held_out"))
    training = docs.where("not held_out")
    sent = training.select("text").mapInArrow(_count(buckets), _COUNTS)
    dealt = sent.repartition(buckets * FINER, "bucket").sortWithinPartitions("bucket")
    counts = scratch.keep(dealt.mapInArrow(released(_merge), f"{_COUNTS}, n long, total long"), "counts")
    scratch.clean()
    word, gram = counts.where(F.col("bucket") < GRAMS), counts.where(F.col("bucket") >= GRAMS)
    ends = training.count()
    sums = word.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    distinct, tokens = sums[0] + (ends > 0), sums[1] + ends
    hot = word.select("keys", "counts").mapInArrow(_frequent(tokens / HOT_SHARE), "key long, n long").toArrow()
    keys = hot["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    logs = np.log10(hot["n"].to_numpy()[order] + 1.0)
    model = spark.sparkContext.broadcast((keys[order], logs, math.log10(ends + 1), int(ends > 0)))

    roots = gram.select("keys", "counts").mapInArrow(released(_roots), "key long, zeros double, ones double, below double")
    roots = roots.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "below")]).orderBy("key").toArrow()
    # at most 2**(8 * (SPLIT - 1)) contexts with 255 decisions each, however many texts
    top = spark.sparkContext.broadcast(ContextTree.top(roots["key"].to_numpy().view(np.uint64), *(roots[c].to_numpy() for c in ("zeros", "ones", "below"))))

    found = scratch.keep(docs.mapInArrow(_score(model, buckets), _SCORED), "scored")
    none = F.lit(None).cast("long")
    lists = counts.select(F.lit(COUNTS).alias("kind"), none.alias("chunk"), none.alias("slice"), "bucket", F.col("keys").alias("a"), F.col("counts").alias("b"))
    asked = lists.union(found.where(F.col("kind") != TEXT).select("kind", "chunk", "slice", "bucket", "a", "b"))
    asked = asked.repartition(buckets * FINER, "bucket").sortWithinPartitions("bucket", "kind")
    answered = scratch.keep(asked.mapInArrow(_look_up(top), _SCORED), "answers")
    scratch.discard("counts")  # all are answered: they go before the last shuffle, as the questions' shuffle does
    texts = found.where(F.col("kind") == TEXT)
    chunks = texts.select("chunk").distinct().count()
    parts = texts.union(answered).select("chunk", "kind", "slice", "a", "b", "c", "d", "e", "f", "g")
    # a task gathers about one chunk, however many there are
    rows = parts.repartition(max(buckets, 2 * chunks), "chunk").sortWithinPartitions("chunk", "kind", "slice").mapInArrow(released(_gathered), _RESULT)
    result = rows.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * math.log10(tokens + distinct + 1)).alias("base_score"),
        "score",
    )
    return materialise(result, "scores")

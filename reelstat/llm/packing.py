"""Vector best-fit packing of tokenised documents into sequences.

A piece of a document is an item with three sizes: tokens, one document, and attention cost (tokens squared). A sequence is
a bin with a capacity in each of them. Items go from the largest to the smallest into the open bin that every capacity
admits and that a weighted residual norm (or dot product) prefers.

Items of equal length are alike, and so are bins of equal residual capacities. The plan is therefore made on the histogram of
lengths, at most ``capacity`` rows however large the corpus is: it says which ranks of a length go to which range of bins.
Each piece finds its place from its rank among the pieces of its length; ranks come from counts by task and length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelstat.llm.storage import Scratch, bounded_batches, materialise
from reelstat.llm.text import LOWER, Slice, mix, released, slices, span_hash, word_spans

END = 0
#: Words remembered by one task at most; the memory starts afresh beyond, which changes no result.
REMEMBERED = 1 << 20
#: A control character that is one token, and the number of words encoded as one text.
MARK = b"\x01"
TOGETHER = 4096


_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_TAIL = np.zeros(256, bool)
_TAIL[33:127] = True
_TAIL &= ~_ALNUM
_TAIL[39] = False  # an apostrophe may begin a contraction


def _stems_and_tails(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words cut before their closing ASCII punctuation where a letter or digit stands before it, as the tokenizer cuts there too."""
    if not len(start):
        return start, end
    place = np.arange(len(data))
    stem = np.maximum(np.maximum.accumulate(np.where(_TAIL[data], -1, place))[end - 1] + 1, start)
    last, lead = data[np.maximum(stem - 1, 0)], data[np.maximum(stem - 2, 0)]
    # the letters of two bytes from C3 80 to C3 BF are all but the signs of multiplication and division
    letter = _ALNUM[last] | ((lead == 0xC3) & (last >= 0x80) & (last <= 0xBF) & (last != 0x97) & (last != 0xB7) & (stem - 2 >= start))
    cut = (stem > start) & (stem < end) & letter
    return np.sort(np.concatenate([start, stem[cut]])), np.sort(np.concatenate([stem[cut], end]))


class WordEncoder:
    """Token ids of texts for a tokenizer that drops white space: a text's ids are those of its words one after another, so
    each distinct word is encoded once. The tokenizer also lower-cases, and parts words at closing punctuation, so words that
    differ in these only are encoded together. Words are recognised by a 64-bit hash."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        (self.mark,) = self.tokenizer.encode(MARK.decode(), add_special_tokens=False).ids
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.first, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, part: Slice, hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        raw = part.data.tobytes()
        spans = list(zip(start.tolist(), end.tolist(), strict=True))
        ids, length = self._ids([raw[s:e] for s, e in spans])
        first = np.cumsum(length) - length + len(self.ids)
        order = np.argsort(np.concatenate([self.known, hashes]), kind="stable")
        self.known = np.concatenate([self.known, hashes])[order]
        self.first = np.concatenate([self.first, first])[order]
        self.length = np.concatenate([self.length, length])[order]
        self.ids = np.concatenate([self.ids, ids])

    def _ids(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words and how many each has. Many words are encoded as one text, with a mark of one id between them;
        words that hold the mark themselves go one by one."""
        length = np.zeros(len(texts), np.int64)
        plain = [i for i, t in enumerate(texts) if MARK not in t]
        joined = [plain[i : i + TOGETHER] for i in range(0, len(plain), TOGETHER)]
        between = b" " + MARK + b" "
        found = self._batch([(between.join([texts[i] for i in group]) + between).decode("utf-8") for group in joined])
        parts: dict[int, np.ndarray] = {}
        flat = np.concatenate(found) if found else np.zeros(0, np.uint32)
        stops = np.flatnonzero(flat == self.mark)
        length[plain] = np.diff(np.concatenate([[-1], stops])) - 1
        flat = flat[flat != self.mark]
        odd = [i for i, t in enumerate(texts) if MARK in t]
        if not odd:
            return flat, length
        for i, own in zip(odd, self._batch([texts[i].decode("utf-8") for i in odd]), strict=True):
            parts[i] = own
        pieces = np.split(flat, np.cumsum(length[plain])[:-1]) if plain else []
        parts |= dict(zip(plain, pieces, strict=True))
        for i in odd:
            length[i] = len(parts[i])
        return np.concatenate([parts[i] for i in range(len(texts))]), length

    def _batch(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, part: Slice) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the slice's rows, each row ended by ``END``, and where each row begins and ends."""
        if b"<|" in part.data.tobytes():  # may be a special token, which is matched as it is written
            start, end = word_spans(part.data, part.offsets)
            hashes = mix(span_hash(part.data, start, end) + np.uint64(1))
        else:
            part = Slice(part.columns, LOWER[part.data], part.offsets, part.null)
            start, end = _stems_and_tails(part.data, *word_spans(part.data, part.offsets))
            hashes = span_hash(part.data, start, end)
        first_piece = np.searchsorted(start, part.offsets)
        if len(self.known) > REMEMBERED:
            self._forget()
        distinct, example, index = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, distinct)
        new = at == len(self.known)
        new[~new] = self.known[at[~new]] != distinct[~new]
        if new.any():
            e = example[new]
            self._learn(part, distinct[new], start[e], end[e])
            at = np.searchsorted(self.known, distinct)
        # every row's words, then the end as a word of one id behind the others
        entry = np.insert(at[index], first_piece[1:], -1)
        first, length = np.append(self.first, len(self.ids)), np.append(self.length, 1)
        count, source = length[entry], first[entry]
        stop = np.cumsum(count)
        ids = np.append(self.ids, np.uint32(END))[np.repeat(source - (stop - count), count) + np.arange(stop[-1] if len(stop) else 0)]
        bounds = np.concatenate([[0], stop])[np.concatenate([[0], first_piece[1:] + np.arange(1, len(part) + 1)])]
        return ids, bounds


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


_PIECE = "doc_id long, piece int, start long, length int, ids binary, task int, rank long"


def _cut(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = _encoder(path), TaskContext.get().partitionId()
        met = np.zeros(capacity + 1, np.int64)
        for part in slices(batches):
            ids, bounds = encoder.encode(part)
            total = np.diff(bounds)
            pieces = -(-total // capacity)
            row = np.repeat(np.arange(len(part)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(total[row] - start, capacity)
            order = np.argsort(length, kind="stable")
            kinds, begin, count = np.unique(length[order], return_index=True, return_counts=True)
            rank = np.empty(len(row), np.int64)
            rank[order] = np.arange(len(row)) - np.repeat(begin, count) + met[length[order]]
            met[kinds] += count
            raw, at = ids.astype("<u4").tobytes(), 4 * (bounds[:-1][row] + start)
            blobs = [raw[a : a + 4 * n] for a, n in zip(at.tolist(), length.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.columns["doc_id"].cast(pa.int64()).take(pa.array(row)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(start),
                    pa.array(length.astype(np.int32)),
                    pa.array(blobs, pa.binary()),
                    pa.array(np.full(len(row), task, np.int32)),
                    pa.array(rank),
                ],
                [x.split()[0] for x in _PIECE.split(", ")],
            )

    return released(run)


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048) -> DataFrame:
    """The token ids of each row's whole text (doc_id, text; null text is empty), ended by id 0 and cut into pieces of at most
    ``capacity``: doc_id, piece, start, length, ids (little-endian unsigned 32-bit), and the rank of the piece among those
    of its length in its task. ``tokenizer`` is the path of a file that drops white space between words, lower-cases them, and keeps letters apart from
    other signs."""
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_cut(tokenizer, capacity), _PIECE)


def plan_bins(
    histogram: dict[int, int],
    capacity: int = 2048,
    documents: int | None = None,
    attention: int | None = None,
    weights: Sequence[float] = (1.0, 1.0, 1.0),
    rule: str = "norm",
) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit, decreasing, of ``histogram`` (pieces of each length). Rows (length, first rank, end rank, first bin, pieces per bin,
    offset of the first): rank r of a length lies in bin ``first + (r - first rank) // per bin``.

    A piece takes its tokens, one document and its attention cost, the square of its tokens; the capacities for these default to ``capacity``,
    ``capacity`` and its square, which the tokens' capacity implies, but all three weigh in the choice. ``rule`` "norm" prefers the bin whose
    residual capacities, as shares weighted by ``weights``, are least after placing; "dot" the one whose residuals have the largest weighted product with the piece's sizes.
    """
    limits = np.array([capacity, documents or capacity, attention or capacity**2], float)
    weight = np.asarray(weights, float)
    residual = np.zeros((0, 3))
    ranges: list[list[tuple[int, int]]] = []
    index: dict[tuple, int] = {}
    plan, bins = [], 0

    def add(state: np.ndarray, first: int, count: int) -> None:
        nonlocal residual
        key = tuple(state)
        if key not in index:
            index[key] = len(ranges)
            ranges.append([])
            residual = np.vstack([residual, state])
        ranges[index[key]].append((first, count))

    for length in sorted(histogram, reverse=True):
        size, left, rank = np.array([length, 1, length**2], float), histogram[length], 0
        if (size > limits).any():
            raise ValueError(f"a piece of {length} tokens exceeds a capacity")
        while left:
            open_ = np.array([bool(r) for r in ranges], bool)
            fits = np.flatnonzero(open_ & (residual >= size).all(axis=1)) if len(ranges) else []
            if len(fits):
                after = (residual[fits] - size) / limits
                score = (weight * after**2).sum(axis=1) if rule == "norm" else -(weight * (size / limits) * (residual[fits] / limits)).sum(axis=1)
                best = fits[int(np.argmin(score))]
                state = residual[best].copy()
                first, count = ranges[best].pop()
            else:
                state, first = limits.copy(), bins
                per = int(np.floor(state / size).min())
                count = math.ceil(left / per)
                bins += count
            per = int(np.floor(state / size).min())
            full = min(count, left // per)
            offset = int(limits[0] - state[0])
            if full:
                plan.append((length, rank, rank + full * per, first, per, offset))
                add(state - per * size, first, full)
                rank, left = rank + full * per, left - full * per
            if full < count and left and left < per:
                plan.append((length, rank, rank + left, first + full, left, offset))
                add(state - left * size, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            if full < count:
                add(state, first + full, count - full)
    return plan


def pack(pieces: DataFrame, capacity: int = 2048, **options) -> DataFrame:
    """``pieces`` (with length, task and rank, as written by ``token_pieces``) with their place: sequence_id and offset.

    Every piece is placed once; offsets of a sequence are gapless from 0. Equal rows are separate items. An empty table stays
    empty. ``options`` go to ``plan_bins``. ``pieces`` must be a stored table, as it is read twice.
    """
    with Scratch(pieces.sparkSession) as scratch:
        return _placed(pieces, capacity, scratch, options)


def _placed(pieces: DataFrame, capacity: int, scratch: Scratch, options: dict) -> DataFrame:
    spark = pieces.sparkSession
    counts = pieces.groupBy("task", "length").agg(F.count("*").alias("count"))
    counts = scratch.keep(counts, "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    plan = plan_bins(histogram, capacity, **options)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("task", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    # bounded: its size depends on the number of lengths and of ways to fill a bin, not on the pieces
    rows = spark.createDataFrame(plan, "length int, low long, high long, first long, per long, at long")
    ranked = pieces.join(base, ["task", "length"]).withColumn("r", F.col("rank") + F.col("base"))
    placed = ranked.join(F.broadcast(rows), (ranked["length"] == rows["length"]) & F.col("r").between(F.col("low"), F.col("high") - 1))
    step = F.col("r") - F.col("low")
    result = placed.select(
        *(pieces[c] for c in pieces.columns if c not in ("task", "rank")),
        (F.col("first") + F.floor(step / F.col("per"))).alias("sequence_id"),
        (F.col("at") + F.pmod(step, F.col("per")) * pieces["length"]).alias("offset"),
    )
    return materialise(result, "packed")

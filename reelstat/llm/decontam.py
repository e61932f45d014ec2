"""Benchmark decontamination by spaced-seed hashing.

A mask fixes which words of a window count; words at its other places may differ. Windows of documents and of benchmark items
with equal hashes under a mask are joined, and around each hit the two word sequences are compared along the hit's
diagonal, substitutions allowed: the longest stretch with the least share of equal words counts. The masks are chosen so that
every overlap holds a window that agrees under one of them, at any places of its substitutions.

Scale: the documents are scanned once. A bit set of fixed size, made from the benchmark's hashes, holds back windows that
cannot hit, so only the neighbourhoods of possible hits are shuffled; the join itself is an equi-join of any size on either side.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.llm.storage import Scratch, bitmap, in_bitmap, materialise
from reelstat.llm.text import Words, mix, released, slices, words

#: One of these hits in every stretch of 13 words or more of which four fifths agree (tested over all places of substitutions).
MASKS = ("11101011", "11001000111", "1101011001", "111111")
LOSSLESS = 13, Fraction(4, 5)
BITS = 24


def _masks(length: int, shortest: int, identity: Fraction) -> tuple[str, ...]:
    """The masks that find every overlap with an item of so many words."""
    if min(shortest, length) >= LOSSLESS[0] and identity >= LOSSLESS[1]:
        return MASKS
    # e substitutions leave a run of one (e + 1)-th of the other words; stretches twice as long hold a shorter one
    least, runs = max(min(shortest, length), 1), []
    for n in range(least, min(2 * least - 1, length) + 1):
        equal = max(math.ceil(identity * n), 1)
        runs.append(math.ceil(equal / (n - equal + 1)))
    return ("1" * min(runs),) if runs else ()


def _windows(w: Words, masks: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first word and mask of every window under every mask that lies in one row."""
    hashes, at, by = [], [], []
    last = w.first[1:][w.row] if len(w.row) else np.zeros(0, np.int64)
    for m, mask in enumerate(masks):
        begin = np.flatnonzero(np.arange(len(w.hash)) + len(mask) <= last)
        total = np.full(len(begin), m + 1, np.uint64)
        for j, care in enumerate(mask):
            if care == "1":
                total = total * np.uint64(0xD6E8FEB86659FD93) + w.hash[begin + j]
        hashes.append(mix(total))
        at.append(begin)
        by.append(np.full(len(begin), m))
    return np.concatenate(hashes), np.concatenate(at), np.concatenate(by)


def _seeds(by_length: dict[int, tuple[str, ...]], masks: tuple[str, ...]):
    def run(batches):
        for part in slices(batches):
            w = words(part)
            h, at, by = _windows(w, masks)
            row = w.row[at]
            length = np.diff(w.first)
            own = np.array([[m in by_length[n] for m in masks] for n in length.tolist()], bool).reshape(len(length), len(masks))
            keep = own[row, by]
            h, at, row = h[keep], at[keep], row[keep]
            columns = pa.array(h.view(np.int64)), part.columns["item"].take(pa.array(row)), pa.array(at - w.first[row]), pa.array(length[row])
            yield pa.RecordBatch.from_arrays([*columns], ["hash", "item", "item_at", "n"])

    return released(run)


def _item_words(batches):
    for part in slices(batches):
        w = words(part)
        blobs = [w.hash[a:b].tobytes() for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([part.columns["item"], part.columns["item_id"], pa.array(blobs, pa.binary())], ["item", "item_id", "item_words"])


_GROUP = "group long, doc_id long, begin long, words binary, hashes array<long>, at array<long>"


def _neighbourhoods(held: np.ndarray, bits: int, masks: tuple[str, ...], reach: int):
    """Groups of windows that may hit, each with ``reach`` words around it; positions count from the row's first word."""
    low = np.uint64((1 << bits) - 1)

    def run(batches):
        number = TaskContext.get().partitionId() << 40
        for part in slices(batches):
            w = words(part)
            h, at, _ = _windows(w, masks)
            may = in_bitmap(held, h & low)
            h, at = h[may], at[may]
            if not len(h):
                continue
            order = np.lexsort((h, at))
            h, at = h[order], at[order]
            row = w.row[at]
            new = np.concatenate([[True], (np.diff(at) > reach) | (np.diff(row) > 0)])
            first = np.flatnonzero(new)
            stop = np.append(first[1:], len(at))
            begin = np.maximum(at[first] - reach, w.first[row[first]])
            end = np.minimum(at[stop - 1] + reach, w.first[row[first] + 1])
            base = w.first[row[first]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(number + np.arange(len(first))),
                    part.columns["doc_id"].cast(pa.int64()).take(pa.array(row[first])),
                    pa.array(begin - base),
                    pa.array([w.hash[a:b].tobytes() for a, b in zip(begin, end, strict=True)], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.append(first, len(at)).astype(np.int32)), pa.array(h.view(np.int64))),
                    pa.ListArray.from_arrays(pa.array(np.append(first, len(at)).astype(np.int32)), pa.array(at - w.first[row])),
                ],
                [x.split()[0] for x in _GROUP.split(", ")],
            )
            number += len(first)

    return released(run)


def _longest_stretch(same: np.ndarray, identity: Fraction) -> tuple[int, int]:
    """The longest stretch of which at least the share ``identity`` is equal; of several the one with most equal words."""
    equal = np.concatenate([[0], np.cumsum(same, dtype=np.int64)])
    total = equal * identity.denominator - np.arange(len(equal)) * identity.numerator
    highest = np.maximum.accumulate(total[::-1])[::-1]  # from here on
    end = np.searchsorted(-highest, -total, side="right") - 1
    length = end - np.arange(len(end))
    start = np.flatnonzero(length == length.max())
    start = int(start[np.argmax(equal[end[start]] - equal[start])])
    return start, int(end[start])


_OVERLAP = "doc_id long, item_id long, start long, item_start long, length long, matched long"


def _verify(shortest: int, identity: Fraction):
    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                a, b = np.frombuffer(r["words"], np.uint64), np.frombuffer(r["item_words"], np.uint64)
                shift = r["diagonal"] - r["begin"]  # place in a of the item's first word
                low, high = max(shift, 0), min(len(a), len(b) + shift)
                same = a[low:high] == b[low - shift : high - shift]
                s, e = _longest_stretch(same, identity)
                matched = int(same[s:e].sum())
                if matched and e - s >= min(shortest, len(b)):
                    out.append((r["doc_id"], r["item_id"], r["begin"] + low + s, low - shift + s, e - s, matched))
            columns = list(zip(*out, strict=True)) or [()] * 6
            names = [x.split()[0] for x in _OVERLAP.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return released(run)


def benchmark_overlaps(docs: DataFrame, benchmark: DataFrame, shortest: int = 13, identity: float = 0.8) -> DataFrame:
    """The longest verified overlap of each document (doc_id, text) and benchmark item (item_id, text) that have one.

    Columns: doc_id, item_id, first word in the document and in the item (from 0), length in words, matched words. An overlap has
    ``shortest`` words or more (the whole item, if that has fewer), of which at least the share ``identity`` agree (A-Z
    lower-cased) at equal distances; words that differ may stand at its ends. Nulls and empty texts have none. Equal rows count once; rows
    without an id are reported under a null id. Other columns are ignored; an empty table on either side gives no rows.
    """
    with Scratch(docs.sparkSession) as scratch:
        return _overlaps(docs, benchmark, shortest, identity, scratch)


def _overlaps(docs: DataFrame, benchmark: DataFrame, shortest: int, identity: float, scratch: Scratch) -> DataFrame:
    items = (
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
        .distinct()
        .withColumn("item", F.xxhash64("item_id", "text"))
    )
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    identity = Fraction(str(identity))
    texts = scratch.keep(items.mapInArrow(released(_item_words), "item long, item_id long, item_words binary"), "items")
    lengths = [r.n for r in texts.select((F.length("item_words") / 8).cast("int").alias("n")).distinct().collect()]
    by_length = {n: _masks(n, shortest, identity) for n in lengths}
    masks = tuple(sorted({m for x in by_length.values() for m in x}))
    if not masks:
        masks = MASKS  # no item has a word
    seeds = scratch.keep(items.select("item", "text").mapInArrow(_seeds(by_length, masks), "hash long, item long, item_at long, n long"), "seeds")
    held = bitmap(seeds, "hash", BITS, hashed=True)
    groups = scratch.keep(docs.mapInArrow(_neighbourhoods(held, BITS, masks, max(lengths, default=0)), _GROUP), "hits")
    hits = groups.select("group", F.explode(F.arrays_zip("hashes", "at")).alias("hit")).select("group", "hit.hashes", "hit.at")
    candidates = (
        hits.join(seeds, F.col("hashes") == F.col("hash"))
        .select("group", "item", "n", (F.col("at") - F.col("item_at")).alias("diagonal"))
        .distinct()
    )
    # only the words beside the item go on
    first = F.greatest(F.col("diagonal") - F.col("begin"), F.lit(0)).cast("int")
    size = (F.col("diagonal") - F.col("begin") + F.col("n")).cast("int") - first
    pairs = (
        candidates.join(groups.select("group", "doc_id", "begin", "words"), "group")
        .select("doc_id", (F.col("begin") + first).alias("begin"), F.col("words").substr(8 * first + 1, 8 * size).alias("words"), "item", "diagonal")
        .join(texts, "item")
    )
    checked = pairs.select("doc_id", "begin", "words", "item_id", "item_words", "diagonal").mapInArrow(_verify(shortest, identity), _OVERLAP)
    best = F.max(F.struct("length", "matched", (-F.col("start")).alias("s"), (-F.col("item_start")).alias("i"))).alias("best")
    found = checked.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", (-F.col("best.s")).alias("start"), (-F.col("best.i")).alias("item_start"), "best.length", "best.matched"
    )
    return materialise(found, "overlaps")

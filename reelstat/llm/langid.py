"""Language identification as multilingual mixture inference.

Each language is a distribution over byte trigrams within words. A document is a mixture of languages: every word is drawn
from one of them, and expectation-maximisation estimates the proportions from the words' n-gram likelihoods. Among the nested
sets of the most likely languages, up to all of them, the one with the best likelihood, less a penalty for each language, is
selected. A row is done once the likelihood of the full mixture, which bounds that of any set, cannot pay for one more language.

Scale: training is one aggregate of trigram counts over all training documents, combined in the task; the model has 2**16 cells
for each language. Prediction is a scan without a shuffle.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstat.llm.text import LETTERS, LOWER, SLICE_BYTES, Slice, slices, word_spans

CELLS = 1 << 16
SMOOTHING = 0.1
#: Log-likelihood, in units of log(words) / 2, that a further language must add.
PENALTY = 4.0
#: Expectation-maximisation ends for a row once no proportion moves by more.
TOLERANCE = 1e-5
UNKNOWN = "und"


def _trigrams(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cell of the trigram around each byte of each letter run, the runs' bounds in that list, and their rows. A run is
    taken with a space on either side; ASCII and Latin-1 capitals are lower-cased."""
    data = LOWER[part.data]
    capital = np.zeros(len(data), bool)
    capital[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    data = data + (capital * 0x20).astype(np.uint8)
    start, end = word_spans(data, part.offsets, LETTERS)
    size = end - start
    stop = np.cumsum(size)
    inside = np.flatnonzero(LETTERS[data])
    code = data.astype(np.uint32)
    first, last = np.zeros(len(data), bool), np.zeros(len(data), bool)
    first[start], last[end - 1] = True, True
    before = np.where(first[inside], 32, code[np.maximum(inside - 1, 0)])
    after = np.where(last[inside], 32, code[np.minimum(inside + 1, max(len(data) - 1, 0))])
    whole = (before << np.uint32(16)) | (code[inside] << np.uint32(8)) | after
    cell = (whole * np.uint32(0x9E3779B1)) >> np.uint32(16)
    row = np.searchsorted(part.offsets, start, side="right") - 1
    return cell, stop - size, stop, row


def _counted(batches):
    """Trigram counts by language over a whole task."""
    total: dict[str, np.ndarray] = {}
    for part in slices(batches):
        cell, begin, stop, row = _trigrams(part)
        coded = part.columns["lang"].cast(pa.string()).dictionary_encode()
        lang = coded.indices.to_numpy(zero_copy_only=False)[row].astype(np.int64)
        flat = np.repeat(lang, stop - begin) * CELLS + cell
        counts = np.bincount(flat, minlength=len(coded.dictionary) * CELLS).reshape(-1, CELLS)
        for name, own in zip(coded.dictionary.to_pylist(), counts, strict=True):
            total[name] = total.get(name, 0) + own
    for name, own in total.items():
        cells = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(cells), pa.string()), pa.array(cells), pa.array(own[cells])], ["lang", "cell", "n"])


class LanguageModel:
    """Log probabilities of cells by language."""

    def __init__(self, languages: list[str], logs: np.ndarray):
        self.languages, self.logs = languages, logs.astype(np.float32)

    @staticmethod
    def fit(docs: DataFrame) -> LanguageModel:
        """From (text, lang) rows; every language with a letter in its texts is learned."""
        counts = docs.mapInArrow(_counted, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
        table = counts.toArrow()  # at most 2**16 rows for each language
        names = sorted(set(table["lang"].to_pylist()))
        place = {n: i for i, n in enumerate(names)}
        total = np.zeros((CELLS, len(names)))
        if names:
            total[table["cell"].to_numpy(), [place[x] for x in table["lang"].to_pylist()]] = table["n"].to_numpy()
        total += SMOOTHING
        return LanguageModel(names, np.log(total / total.sum(axis=0)))

    @staticmethod
    def _mixture(likely: np.ndarray, count: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Proportions by row from the given ones on, and the log-likelihood of the words beyond their largest term; ``count``
        has the words of each row."""
        share = share / share.sum(axis=1, keepdims=True)
        words, sizes, now, at = likely, count, share.copy(), np.arange(len(count))
        while len(at):
            joint = words * np.repeat(now, sizes, axis=0)
            joint /= np.maximum(joint.sum(axis=1, keepdims=True), 1e-30)
            share[at] = np.add.reduceat(joint, np.cumsum(sizes) - sizes, axis=0) / sizes[:, None]
            moves = np.abs(share[at] - now).max(axis=1) > TOLERANCE
            # rows end one by one, whatever other rows are in the slice
            words, sizes, at = words[np.repeat(moves, sizes)], sizes[moves], at[moves]
            now = share[at]
        total = np.log(np.maximum((likely * np.repeat(share, count, axis=0)).sum(axis=1), 1e-30))
        return share, np.add.reduceat(total, np.cumsum(count) - count)

    def predict(self, part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By row: the language (-1: none), its share in the mixture of all languages, and the shares of the selected set."""
        n, languages = len(part), len(self.languages)
        best, score, shares = np.full(n, -1), np.zeros(n), np.zeros((n, languages))
        cell, begin, _, word_row = _trigrams(part)
        if not len(cell) or not languages:
            return best, score, shares
        words = np.add.reduceat(self.logs[cell], begin, axis=0).astype(np.float64)
        top = words.max(axis=1, keepdims=True)
        likely = np.exp(words - top)
        first = np.flatnonzero(np.concatenate([[True], word_row[1:] != word_row[:-1]]))
        there = word_row[first]  # rows with letters
        count = np.diff(np.append(first, len(word_row)))
        full, bound = self._mixture(likely, count, np.ones((len(first), languages)))
        single = np.add.reduceat(words - top, first, axis=0)
        leader = single.argmax(axis=1)
        at = np.arange(len(first))
        chosen = np.zeros((len(first), languages))
        chosen[at, leader] = 1
        cost = PENALTY * np.log(count + 1) / 2
        value = single[at, leader] - cost
        ranked = full.copy()
        ranked[at, leader] = 2  # the sets are nested: the best single language, then by proportion
        order = np.argsort(-ranked, axis=1, kind="stable")
        for size in range(2, languages + 1):
            # half a language's cost of slack for what the full mixture lacks at the tolerance
            left = np.flatnonzero(bound - (size - 0.5) * cost > value)
            if not len(left):
                break
            inside = np.zeros((len(first), languages), bool)
            np.put_along_axis(inside, order[:, :size], True, axis=1)
            own = np.repeat(np.isin(at, left), count)
            share, total = self._mixture(likely[own], count[left], (inside * (full + 1e-3))[left])
            total = total - size * cost[left]
            better = total > value[left]
            chosen[left[better]], value[left[better]] = share[better], total[better]
        best[there] = chosen.argmax(axis=1)
        score[there] = full[at, chosen.argmax(axis=1)]
        shares[there] = chosen
        return best, score, shares


def _no_letter(part: Slice) -> np.ndarray:
    """Rows without any letter: those without an ASCII one are read as characters."""
    ascii_letter = LETTERS[part.data] & (part.data < 128)
    total = np.concatenate([[0], np.cumsum(ascii_letter)])
    none = total[part.offsets[1:]] == total[part.offsets[:-1]]
    for i in np.flatnonzero(none):
        none[i] = not any(c.isalpha() for c in part.text(i).decode("utf-8"))
    return none


def identified(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, lang_pred, score and languages (the selected set, by falling share) for each row of ``docs``.

    The model learns from the rows with a lang whose ``held_out`` is not true; predictions use the whole text only. ``score`` is the
    predicted language's proportion in the mixture of all languages. Null texts and texts without a letter get ``und``, score
    0 and an empty set, as does every text if nothing was learned; ties go to the first language by name. Equal rows are treated
    alike, a row with a null doc_id like any other; other columns are ignored; an empty table gives an empty result.
    """
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
    )
    model = LanguageModel.fit(docs.where("not held_out and lang is not null and text is not null").select("text", "lang"))
    names = np.array([*model.languages, UNKNOWN], dtype=object)
    most = max(1 << 16, min(SLICE_BYTES, 8 * SLICE_BYTES // max(len(model.languages), 1)))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part in slices(batches, most=most):
            best, score, shares = shared.value.predict(part)
            none = _no_letter(part) | (best < 0)
            best, score = np.where(none, len(names) - 1, best), np.where(none, 0.0, np.clip(score, 0.0, 1.0))
            sets = [[] if e else [names[j] for j in np.argsort(-s, kind="stable") if s[j] > 0] for e, s in zip(none, shares, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.columns["doc_id"], part.columns["held_out"], pa.array(names[best], pa.string()), pa.array(score), pa.array(sets, pa.list_(pa.string()))],
                ["doc_id", "held_out", "lang_pred", "score", "languages"],
            )

    scan = docs.select("doc_id", "text", "held_out")
    return scan.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, languages array<string>")

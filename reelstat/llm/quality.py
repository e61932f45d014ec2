"""Quality classifier from weak labels: overlapping heuristic labellers, a label model, and a hashed linear scorer.

The labellers vote or abstain on every document; expectation-maximisation (``rules.RuleModel``) estimates their accuracies from the
counts of vote patterns, and gives each document a posterior probability of being good. These soft labels train a logistic
regression over hashed shapes and words, whose score replaces the votes: it also ranks documents on which all abstain.

Scale: two scans, no shuffle of texts. Vote patterns are at most 3 ** labellers rows; the scorer learns from a sample of
bounded size chosen by hash, and has ``BUCKETS`` weights.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.llm.rules import RuleModel
from reelstat.llm.text import Slice, Words, mix, shingles, slices, span_hash, word_spans, words

BUCKETS = 1 << 14
#: Documents that the scorer learns from: all, or a hash-chosen sample of about this size.
SAMPLE = 6_000

_CLASS = np.full(256, ord("a"), np.uint8)  # all bytes of other characters count as small letters
_CLASS[33:127] = np.arange(33, 127)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58] = ord("A"), ord("a"), ord("0")
_STOP, _SYMBOL, _UPPER, _SPACE = (np.zeros(256, bool) for _ in range(4))
_STOP[list(b".?!")] = _SYMBOL[list(b"#*$%&|<>")] = _UPPER[65:91] = _SPACE[list(b" \t\n\x0b\x0c\r")] = True


def _row_sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeats(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How often the hash occurs in its row, for each place."""
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((hashes, row))
    h, r = hashes[order], row[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(len(h), 1), bool), (h[1:] != h[:-1]) | (r[1:] != r[:-1])]))
    count = np.diff(np.append(first, len(h)))
    out = np.empty(len(h), np.int64)
    out[order] = np.repeat(count, count)
    return out


LABELLERS = ("symbols", "capitals", "phrases", "lines", "variety", "length", "stops", "tables")


def _votes(part: Slice, w: Words) -> np.ndarray:
    """Votes of the labellers by row: 1 good, -1 bad, 0 abstains. All abstain on texts of fewer than ten words."""
    n = np.diff(w.first)
    some = np.maximum(n, 1)
    chars = np.maximum(_row_sums(~_SPACE[part.data], part.offsets), 1)
    gram, gram_offsets = shingles(w, 3)
    again = _row_sums(_repeats(gram, gram_offsets) > 1, gram_offsets) / np.maximum(np.diff(gram_offsets), 1)
    distinct = _row_sums(1 / _repeats(w.hash, w.first), w.first) / some
    not_feed = np.ones(256, bool)
    not_feed[10] = False
    start, end = word_spans(part.data, part.offsets, not_feed)  # lines that are not empty
    line = np.searchsorted(start, part.offsets)
    doubled = _row_sums(1 - 1 / _repeats(span_hash(part.data, start, end), line), line) / np.maximum(np.diff(line), 1)
    symbols = _row_sums(_SYMBOL[part.data], part.offsets) / some
    upper = _row_sums(_UPPER[part.data], part.offsets) / chars
    stops = _row_sums(_STOP[part.data], part.offsets) / some
    bars = _row_sums(part.data == ord("|"), part.offsets) / some
    length = chars / some
    measured = [  # bad, good
        (symbols > 0.25, symbols < 0.05),
        (upper > 0.4, upper < 0.15),
        (again > 0.45, again < 0.1),
        ((doubled > 0.3) & (np.diff(line) >= 5), (doubled < 0.1) & (np.diff(line) >= 2)),
        (distinct < 0.2, distinct > 0.4),
        ((length < 2.5) | (length > 12), (length >= 3.5) & (length <= 9)),
        ((stops < 0.01) | (stops > 0.5), (stops > 0.03) & (stops < 0.3)),
        (bars > 0.1, bars == 0),
    ]
    return np.stack([np.where(n >= 10, good.astype(int) - bad.astype(int), 0) for bad, good in measured], axis=1)


def _features(part: Slice, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, value): shapes of words, words, and how often phrases recur; values are roots of shares of the row's words."""
    shape = _CLASS[part.data]
    same = np.zeros(len(shape), bool)
    same[1:] = shape[1:] == shape[:-1]
    same[w.start] = False
    kept = np.concatenate([[0], np.cumsum(~same)])
    shapes = span_hash(shape[~same], kept[w.start], kept[w.end])
    gram, gram_offsets = shingles(w, 3)
    # phrases that occur once say nothing; the others by the magnitude of their number
    times = _repeats(gram, gram_offsets)
    recur = np.flatnonzero(times > 1)
    gram_row = np.repeat(np.arange(len(part)), np.diff(gram_offsets))
    level = mix(np.log2(times[recur]).astype(np.uint64) + np.uint64(0x7265))
    h = np.concatenate([mix(shapes + np.uint64(1)), w.hash, level])
    row = np.concatenate([w.row, w.row, gram_row[recur]])
    pair, n = np.unique(row * np.int64(BUCKETS) + (h & np.uint64(BUCKETS - 1)).astype(np.int64), return_counts=True)
    row = pair // BUCKETS
    return row, pair % BUCKETS, np.sqrt(n / np.maximum(np.diff(w.first), 1)[row])


def _voted(batches):
    """Vote patterns counted within a slice."""
    for part in slices(batches):
        patterns, n = np.unique(_votes(part, words(part, lower=False)), axis=0, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(patterns.astype(np.int32).tolist(), pa.list_(pa.int32())), pa.array(n)], ["votes", "n"])


def _sampled(batches):
    """Votes and features of each row."""
    for part in slices(batches):
        w = words(part, lower=False)
        row, bucket, value = _features(part, w)
        offsets = pa.array(np.searchsorted(row, np.arange(len(part) + 1)).astype(np.int32))
        votes = pa.array(_votes(part, w).astype(np.int32).tolist(), pa.list_(pa.int32()))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (bucket.astype(np.int32), value.astype(np.float32))]
        yield pa.RecordBatch.from_arrays([votes, *lists], ["votes", "buckets", "values"])


class LinearScorer:
    """Logistic regression over hashed features, trained on soft labels."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def score(self, row: np.ndarray, bucket: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
        total = np.bincount(row, self.weights[bucket] * value, rows) if len(row) else np.zeros(rows)
        return 1 / (1 + np.exp(-np.clip(total + self.bias, -40, 40)))

    @staticmethod
    def fit(row: np.ndarray, bucket: np.ndarray, value: np.ndarray, good: np.ndarray, rounds: int = 150) -> LinearScorer:
        """Gradient steps with momentum on the penalised likelihood."""
        scorer = LinearScorer(np.zeros(BUCKETS), 0.0)
        moments = [np.zeros(BUCKETS + 1) for _ in range(2)]
        for t in range(1, rounds + 1):
            error = (scorer.score(row, bucket, value, len(good)) - good) / len(good)
            gradient = np.append(np.bincount(bucket, error[row] * value, BUCKETS) + 1e-5 * scorer.weights, error.sum())
            moments[0] = 0.9 * moments[0] + 0.1 * gradient
            moments[1] = 0.99 * moments[1] + 0.01 * gradient**2
            step = 0.1 * (moments[0] / (1 - 0.9**t)) / (np.sqrt(moments[1] / (1 - 0.99**t)) + 1e-8)
            scorer = LinearScorer(scorer.weights - step[:-1], scorer.bias - step[-1])
        return scorer


def fit_quality(docs: DataFrame, sample: int = SAMPLE) -> tuple[RuleModel, LinearScorer] | None:
    """The label model from the votes on all documents, and the scorer from about ``sample`` of them; None without words."""
    text = docs.select("doc_id", "text").where(F.col("text").rlike("[^ \t\n\x0b\f\r]"))
    counts = text.select("text").mapInArrow(_voted, "votes array<int>, n long").groupBy("votes").agg(F.sum("n").alias("n")).collect()
    if not counts:
        return None
    model = RuleModel.fit(sorted((tuple(r["votes"]), r["n"]) for r in counts), len(LABELLERS))
    total = sum(r["n"] for r in counts)
    # every document has the same chance, by hash, so a third attempt of a task draws the same ones
    share = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)) < int((1 << 40) * min(1.0, sample / total))
    rows = text.where(share).select("text").mapInArrow(_sampled, "votes array<int>, buckets array<int>, values array<float>").toArrow()
    if not rows.num_rows:
        return None
    good = np.array([model.posterior(v)[0] for v in rows["votes"].to_pylist()])
    lists = rows["buckets"].combine_chunks()
    row = np.repeat(np.arange(len(good)), np.diff(lists.offsets.to_numpy()))
    bucket, value = lists.flatten().to_numpy(), rows["values"].combine_chunks().flatten().to_numpy().astype(np.float64)
    return model, LinearScorer.fit(row, bucket.astype(np.int64), value, good)


def scored_quality(docs: DataFrame, cut: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """doc_id, n_words, weak_label (posterior of good under the label model), score of the classifier and kept for each row of ``docs``.

    ``kept``: a score of ``cut`` or more. Null, empty and wordless texts score 0 and are not kept; on very short texts all
    labellers abstain, and the classifier alone decides. Whole texts count. Equal rows are scored alike, a row with a null doc_id
    like any other; other columns are ignored; an empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    fitted = fit_quality(docs, sample)

    def run(batches):
        posterior: dict[tuple, float] = {}
        for part in slices(batches):
            w = words(part, lower=False)
            n = np.diff(w.first)
            score, weak = np.zeros(len(part)), np.zeros(len(part))
            if fitted is not None:
                model, scorer = fitted
                patterns, index = np.unique(_votes(part, w), axis=0, return_inverse=True)
                for p in map(tuple, patterns.tolist()):
                    if p not in posterior:
                        posterior[p] = model.posterior(p)[0]
                weak = np.array([posterior[p] for p in map(tuple, patterns.tolist())])[index.reshape(-1)]
                score = scorer.score(*_features(part, w), len(part))
            score, weak = np.where(n > 0, score, 0.0), np.where(n > 0, weak, 0.0)
            yield pa.RecordBatch.from_arrays(
                [part.columns["doc_id"], pa.array(n), pa.array(weak), pa.array(score), pa.array((score >= cut) & (n > 0))],
                ["doc_id", "n_words", "weak_label", "score", "kept"],
            )

    return docs.mapInArrow(run, "doc_id long, n_words long, weak_label double, score double, kept boolean")

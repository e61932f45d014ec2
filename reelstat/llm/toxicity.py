"""Toxicity by cumulative-link ordinal regression over sparse text features.

Grades 0 (clean) to 3 share one weight vector: P(grade <= k) = sigmoid(threshold_k - w . x). The features are whole words and the
first four bytes of words, chosen by how much more often labelled toxic documents hold them. Labels say toxic or not; the grade
of a toxic one comes from how often it uses such features, cut at the thirds of the labelled toxic documents.

Scale: the model is fitted on a bounded sample of labelled rows, chosen by hash, that is joined to the documents by broadcast; so
documents are scanned and never shuffled, and the model sent to the tasks has at most ``FEATURES`` weights.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.llm.storage import Scratch
from reelstat.llm.text import LETTERS, LOWER, HashSet, Slice, mix, released, slices, span_hash, word_spans

#: Labelled rows of either class that the model learns from at most, and features it may use.
SAMPLE = 10_000
FEATURES = 4096
GRADES = 4


def _features(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every feature occurrence: each word, and the beginning of each word of four bytes or more."""
    data = LOWER[part.data]
    start, end = word_spans(data, part.offsets, LETTERS)
    row = np.searchsorted(part.offsets, start, side="right") - 1
    long_ = end - start >= 4
    prefix = mix(span_hash(data, start[long_], start[long_] + 4) + np.uint64(0x70726566))
    return np.concatenate([span_hash(data, start, end), prefix]), np.concatenate([row, row[long_]])


def _frequencies(batches):
    """Documents of either class with each feature, counted within a slice."""
    for part in slices(batches):
        h, row = _features(part)
        order = np.lexsort((row, h))
        h, row = h[order], row[order]
        first = np.concatenate([np.ones(min(len(h), 1), bool), (h[1:] != h[:-1]) | (row[1:] != row[:-1])])
        h, toxic = h[first], part.columns["toxic"].to_numpy()[row[first]]
        key, index = np.unique(h, return_inverse=True)
        both = [pa.array(np.bincount(index[toxic == c], minlength=len(key))) for c in (0, 1)]
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *both], ["key", "clean", "toxic"])


def _counts(part: Slice, chosen: HashSet) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature and number of occurrences of the chosen features."""
    h, row = _features(part)
    hit, feature = chosen.find(h)
    pair, n = np.unique(row[hit] * np.int64(FEATURES) + feature, return_counts=True)
    return pair // FEATURES, pair % FEATURES, n


def _occurrences(keys: np.ndarray):
    def run(batches):
        chosen = HashSet(keys)
        for part in slices(batches):
            row, feature, n = _counts(part, chosen)
            ids = part.columns["doc_id"].take(pa.array(row))
            yield pa.RecordBatch.from_arrays([ids, pa.array(feature.astype(np.int32)), pa.array(n)], ["doc_id", "feature", "n"])

    return released(run)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class OrdinalModel:
    """Weights of features and ascending thresholds. Features enter as 1 + log(occurrences)."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    @staticmethod
    def value(n: np.ndarray) -> np.ndarray:
        return 1 + np.log(n)

    def probabilities(self, score: np.ndarray) -> np.ndarray:
        """Of each grade, by row."""
        below = _sigmoid(self.thresholds[None, :] - score[:, None])
        edges = np.concatenate([np.zeros((len(score), 1)), below, np.ones((len(score), 1))], axis=1)
        return np.diff(edges, axis=1)

    @staticmethod
    def fit(row: np.ndarray, feature: np.ndarray, n: np.ndarray, grade: np.ndarray, weight: np.ndarray, features: int, rounds: int = 400) -> OrdinalModel:
        """Penalised maximum likelihood by gradient steps with momentum; thresholds are a first one and positive gaps."""
        x = OrdinalModel.value(n)
        w, first, gaps = np.zeros(features), 1.0, np.zeros(GRADES - 2)
        weight = weight / weight.sum()
        moments = [np.zeros(features + GRADES - 1) for _ in range(2)]
        for t in range(1, rounds + 1):
            thresholds = first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
            score = np.bincount(row, w[feature] * x, len(grade))
            below = _sigmoid(thresholds[None, :] - score[:, None])
            edges = np.concatenate([np.zeros((len(grade), 1)), below, np.ones((len(grade), 1))], axis=1)
            at = np.arange(len(grade))
            p = np.maximum(edges[at, grade + 1] - edges[at, grade], 1e-12)
            slope = np.concatenate([np.zeros((len(grade), 1)), below * (1 - below), np.zeros((len(grade), 1))], axis=1)
            up, down = slope[at, grade + 1] / p, slope[at, grade] / p
            d_score = weight * (up - down)  # of the negative log-likelihood
            d_thresholds = np.zeros(GRADES - 1)
            for k in range(GRADES - 1):
                d_thresholds[k] = -(weight * up)[grade == k].sum() + (weight * down)[grade == k + 1].sum()
            tail = np.cumsum(d_thresholds[::-1])[::-1]
            gradient = np.concatenate([np.bincount(feature, d_score[row] * x, features) + 1e-5 * w, [tail[0]], tail[1:] * np.exp(gaps)])
            moments[0] = 0.9 * moments[0] + 0.1 * gradient
            moments[1] = 0.99 * moments[1] + 0.01 * gradient**2
            step = 0.1 * (moments[0] / (1 - 0.9**t)) / (np.sqrt(moments[1] / (1 - 0.99**t)) + 1e-8)
            w, first, gaps = w - step[:features], first - step[features], gaps - step[features + 1 :]
        return OrdinalModel(w, first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))]))


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, OrdinalModel]:
    """Feature hashes (ascending) and the model, from at most ``sample`` labelled documents of either class."""
    with Scratch(docs.sparkSession) as scratch:
        return _fit(docs, labels, sample, scratch)


def _fit(docs: DataFrame, labels: DataFrame, sample: int, scratch: Scratch) -> tuple[np.ndarray, OrdinalModel]:
    labels = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    labels = scratch.keep(labels.agg(F.max(F.col("toxic").cast("int")).alias("toxic")), "labels")
    of = {r["toxic"]: r["n"] for r in labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    by_hash = [labels.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for c in (0, 1)]
    chosen = by_hash[0].union(by_hash[1])  # at most 2 * sample rows
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.join(F.broadcast(chosen), "doc_id").where("text is not null")
    # copies teach nothing new, and would make every word of theirs stand out
    rows = scratch.keep(rows.groupBy("text").agg(F.max("toxic").alias("toxic"), F.min("doc_id").alias("doc_id")), "labelled")

    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    clean, toxic = n.get(0, 0), n.get(1, 0)
    none = np.zeros(0, np.uint64), OrdinalModel(np.zeros(0), np.array([30.0, 31.0, 32.0]))
    if not toxic:
        return none
    frequency = rows.select("text", "toxic").mapInArrow(released(_frequencies), "key long, clean long, toxic long")
    frequency = frequency.groupBy("key").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where(F.col("toxic") >= max(3, 0.002 * toxic))
    share = (F.col("clean") + F.col("toxic")) / (clean + toxic)
    gap = F.col("toxic") / toxic - F.col("clean") / max(clean, 1)
    z = gap / F.sqrt(share * (1 - share) * (1 / toxic + 1 / max(clean, 1)) + 1e-12)
    # a feature of toxic texts, and at least ten times as frequent there
    marked = frequency.where((z > 4) & (F.col("toxic") / toxic > 10 * F.col("clean") / max(clean, 1))).orderBy(z.desc(), "key").limit(FEATURES)
    keys = np.sort(np.array([r["key"] for r in marked.collect()], np.int64).view(np.uint64))
    if not len(keys):
        return none
    found = rows.select("doc_id", "text").mapInArrow(_occurrences(keys), "doc_id long, feature int, n long").toArrow()
    known = rows.select("doc_id", "toxic").toArrow()
    ids, label = known["doc_id"].to_numpy(), known["toxic"].to_numpy()
    order = np.argsort(ids)
    ids, label = ids[order], label[order]
    row, feature, times = np.searchsorted(ids, found["doc_id"].to_numpy()), found["feature"].to_numpy(), found["n"].to_numpy()
    hits = np.bincount(row, times, len(ids))
    cuts = np.quantile(hits[label == 1], [1 / 3, 2 / 3])
    grade = np.where(label == 1, 1 + (hits[:, None] > cuts).sum(axis=1), 0)
    weight = np.where(label == 1, of[1] / toxic, of.get(0, 0) / max(clean, 1))
    return keys, OrdinalModel.fit(row, feature, times, grade, weight, len(keys))


def graded(docs: DataFrame, labels: DataFrame, cut: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """doc_id, severity (expected grade), grade (the likeliest), p_toxic and toxic for each row of ``docs``.

    ``toxic``: a grade above 0 has probability ``cut`` or more. The whole text counts; null, empty and wordless texts have no
    features and so the severity of a text without signs. ``labels`` (doc_id, toxic 0 or 1) are reduced to one row an id, the
    larger value winning, nulls ignored; without toxic labels nothing is toxic. Equal rows are graded alike, other columns ignored;
    an empty table gives an empty result.
    """
    keys, model = fit_toxicity(docs, labels, sample)

    def run(batches):
        chosen = HashSet(keys)
        for part in slices(batches):
            row, feature, n = _counts(part, chosen)
            score = np.bincount(row, model.weights[feature] * model.value(n), len(part)) if len(row) else np.zeros(len(part))
            p = model.probabilities(score)
            severity = p @ np.arange(GRADES)
            yield pa.RecordBatch.from_arrays(
                [part.columns["doc_id"], pa.array(severity), pa.array(p.argmax(axis=1)), pa.array(1 - p[:, 0]), pa.array(1 - p[:, 0] >= cut)],
                ["doc_id", "severity", "grade", "p_toxic", "toxic"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(released(run), "doc_id long, severity double, grade long, p_toxic double, toxic boolean")


def without_toxic(docs: DataFrame, labels: DataFrame, cut: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that ``graded`` does not call toxic, as they are and with all their columns, in the same scan."""
    keys, model = fit_toxicity(docs, labels, sample)

    def run(batches):
        chosen = HashSet(keys)
        for batch in batches:
            keep = [np.zeros(0, bool)]
            for part in slices(iter([batch])):
                row, feature, n = _counts(part, chosen)
                score = np.bincount(row, model.weights[feature] * model.value(n), len(part)) if len(row) else np.zeros(len(part))
                keep.append(1 - model.probabilities(score)[:, 0] < cut)
            yield batch.filter(pa.array(np.concatenate(keep)))

    return docs.mapInArrow(released(run), docs.schema)

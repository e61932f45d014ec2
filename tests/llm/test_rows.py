"""Operators that judge or score one document at a time, against brute force, held-out accuracy or their own definition."""

import math
import os
import random
import re
import zlib
from collections import Counter
from functools import cache

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reelstat.llm import ctw
from reelstat.llm.ctw import ContextTree, scored
from reelstat.llm.langid import LanguageModel, identified
from reelstat.llm.quality import scored_quality
from reelstat.llm.rules import RuleModel, default_rules, judged
from reelstat.llm.text import slices
from reelstat.llm.toxicity import OrdinalModel, graded, without_toxic
from reelstat.session import shared_dir

from .conftest import sentence, text_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_id(rows):
    return {r.doc_id: r for r in rows if r.doc_id is not None}


def part_of(*texts):
    return next(slices(iter([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])])))


# --- quality rules


def test_measures_equal_brute_force(spark, awkward, texts):
    found = judged(awkward).collect()
    assert len(found) == len(texts)
    got = by_id(found)
    for i, t in texts:
        if i is None:
            continue
        w, at = WORD.findall(t or ""), {}
        for k in range(len(w) - 2):
            at.setdefault(tuple(w[k : k + 3]), []).append(k)
        covered = {k + j for ks in at.values() if len(ks) > 1 for k in ks for j in range(3)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        expected = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered))
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected, i
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
        assert r.kept == (not r.base_failed and r.quality >= 0.5)


def test_rules_find_junk_of_several_kinds(spark):
    names = list(default_rules())
    good = tuple(1 for _ in names)
    junk = [tuple(-1 if n in kinds else 1 for n in names) for kinds in (("symbols",), ("upper", "stops"), ("repeats", "variety"))]
    odd = tuple(-1 if n == "stops" else 1 for n in names)
    model = RuleModel.fit([(good, 9000), *[(j, 300) for j in junk], (odd, 30)], len(names))
    assert model.posterior(good)[0] > 0.95 and all(model.posterior(j)[0] < 0.2 for j in junk)
    assert model.posterior(tuple(0 for _ in names))[0] == pytest.approx(model.share[0])


# --- quality classifier


def test_classifier_follows_the_weak_labels(spark):
    rng = random.Random(1)
    good = [(i, text_of(rng, rng.randint(3, 7))) for i in range(160)]
    junk = [(1000 + i, " ".join(w + "%%%" for w in sentence(rng, 60).split())) for i in range(12)]
    junk += [(2000 + i, text_of(rng, 4).upper().replace(" ", "!! ")) for i in range(12)]
    rows = [*good, *junk, (3000, None), (3001, ""), (3002, "short one"), (None, good[0][1])]
    found = scored_quality(spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, score int")).collect()
    got = by_id(found)
    assert len(found) == len(rows) and not any(got[i].kept for i, _ in junk) and all(got[i].kept for i, _ in good)
    assert not got[3000].kept and got[3001].score == 0 and got[3002].kept
    assert all(0 <= r.score <= 1 and 0 <= r.weak_label <= 1 for r in found)


# --- toxicity


def test_severity_of_planted_documents(spark, awkward):
    rng = random.Random(2)
    insults = ["blockhead", "nitwit", "dullard"]

    def rude(n):
        w = text_of(rng, 6).split(" ")
        for _ in range(n):
            w.insert(rng.randrange(len(w)), rng.choice(insults))
        return " ".join(w)

    rows = [(i, text_of(rng, 6), 0) for i in range(150)] + [(1000 + i, rude(1 + i % 6), 1) for i in range(60)]
    plain = [(5000 + i, text_of(rng, 6)) for i in range(20)]
    planted = [(6000 + i, rude(n)) for i, n in enumerate((1, 2, 6, 9))]
    docs = spark.createDataFrame([*[r[:2] for r in rows], *plain, *planted, (None, rude(3)), (7000, None), (7001, "")], "doc_id long, text string")
    docs = docs.withColumn("toxic", F.lit("x")).withColumn("feature", F.lit(1))
    labels = spark.createDataFrame([*[(i, y, 1) for i, _, y in rows], (1000, 0, 1), (None, 1, 1), (3, None, 1)], "doc_id long, toxic int, n int")
    found = graded(docs, labels).collect()
    got = by_id(found)
    assert len(found) == docs.count()
    assert all(got[i].toxic for i, _ in planted) and not any(got[i].toxic for i, _ in [*plain, (7000, 0), (7001, 0)])
    assert got[6000].severity < got[6003].severity and got[6003].grade == 3
    kept = without_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in found if not r.toxic)
    none = graded(awkward, labels.where("toxic = 0"))
    assert not any(r.toxic for r in none.collect()) and none.count() == awkward.count()


def test_ordinal_gradient_reaches_ordered_grades():
    row, feature = np.arange(300), np.arange(300) % 3
    grade = np.array([0, 1, 3])[feature]
    model = OrdinalModel.fit(row, feature, np.ones(300), grade, np.ones(300), 3)
    p = model.probabilities(model.weights)
    assert p.argmax(axis=1).tolist() == [0, 1, 3] and np.allclose(p.sum(axis=1), 1) and (np.diff(model.thresholds) > 0).all()


# --- language


def test_languages_and_mixtures(spark):
    rng = random.Random(3)
    vocabulary = {"aa": "bana kolo tami suri", "bb": "xerq zwik qrup vyx", "cc": "ñoñé çaé öüß éàç"}
    draw = lambda lang, n: " ".join(rng.choice(vocabulary[lang].split()) + rng.choice(["", "s", "t"]) for _ in range(n))
    rows = [(i, draw(lang := rng.choice("abc") * 2, rng.randint(2, 60)), lang) for i in range(200)]
    mixed = [(900, draw("aa", 60) + " " + draw("bb", 40), "aa"), (901, draw("cc", 50).upper(), "cc")]
    blank = [(902, None, "aa"), (903, "", "aa"), (904, "12 34 ... 5", "aa"), (905, "… — 7", "aa"), (906, draw("bb", 20), None), (None, draw("bb", 9), "bb")]
    docs = spark.createDataFrame([(*r, 7) for r in [*rows, *mixed, *blank]], "doc_id long, text string, lang string, score int")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    found = identified(docs, held).collect()
    got = by_id(found)
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in got)
    assert all(got[i].lang_pred == lang for i, _, lang in rows)
    assert got[900].lang_pred == "aa" and got[900].languages == ["aa", "bb"] and 0.5 < got[900].score < 0.7
    assert got[901].lang_pred == "cc" and got[906].lang_pred == "bb"
    assert all(got[i].lang_pred == "und" and got[i].score == 0 and got[i].languages == [] for i in (902, 903, 904, 905))
    assert {r.lang_pred for r in identified(docs.withColumn("lang", F.lit(None).cast("string")), held).collect()} == {"und"}


def test_documents_in_four_and_five_languages(spark):
    rng = random.Random(7)
    vocabulary = {"aa": "bana kolo tami suri", "bb": "xerq zwik qrup vyx", "cc": "ñoñé çaé öüß éàç", "dd": "hjlm fgdw cpth", "ee": "uoi aiue oueia"}
    draw = lambda lang, n: " ".join(rng.choice(vocabulary[lang].split()) for _ in range(n))
    rows = [(i, draw(lang := rng.choice("abcde") * 2, 30), lang) for i in range(150)]
    sizes = {900: [160, 60, 40, 25, 0], 901: [50, 0, 50, 50, 50], 902: [200, 90, 60, 40, 20], 903: [40, 0, 0, 0, 0]}
    mixed = [(i, " ".join(draw(lang, n) for lang, n in zip(vocabulary, own, strict=True) if n), None) for i, own in sizes.items()]
    found = by_id(identified(spark.createDataFrame([*rows, *mixed], "doc_id long, text string, lang string"), F.lit(False)).collect())
    for i, own in sizes.items():
        assert sorted(found[i].languages) == [lang for lang, n in zip(vocabulary, own, strict=True) if n]
    assert found[902].languages == ["aa", "bb", "cc", "dd", "ee"] and found[902].score == pytest.approx(200 / 410, abs=0.02)


def test_mixtures_end_where_no_proportion_moves():
    rng = np.random.default_rng(6)
    likely, count = rng.random((90, 4)), np.array([20, 1, 69])
    share, total = LanguageModel._mixture(likely, count, np.ones((3, 4)))
    again, same = LanguageModel._mixture(likely, count, share.copy())
    assert np.allclose(again.sum(axis=1), 1) and (same >= total - 1e-9).all() and (same < total + 1e-3).all()
    alone, _ = LanguageModel._mixture(likely[21:], count[2:], np.ones((1, 4)))
    assert (alone[0] == share[2]).all()


# --- language model


def test_base_scores_equal_brute_force(spark, awkward, texts, monkeypatch):
    found = scored(awkward, F.crc32(F.col("doc_id").cast("string")) % 7 == 2).collect()
    rows = [(i, [w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())]) for i, t in texts]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    count = Counter()
    for i, w in rows:
        if not held(i):
            count.update([*w, "end"])
    n, v = sum(count.values()), len(count)
    got = by_id(found)
    assert len(found) == len(rows)
    for i, w in rows:
        if i is not None:
            r = got[i]
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), len(w) + 1, sum(count[x] > 0 for x in [*w, "end"]), n)
            assert r.base_score == pytest.approx(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in [*w, "end"]), rel=1e-9)


def sequential_weighting(train: bytes, text: bytes) -> float:
    """log10 probability of ``text`` after ``train``, with a tree for each decision updated bit by bit and then frozen."""
    deep = ctw.DEPTH
    counts: dict = {}
    for i in range(deep, len(train)):
        for level in range(8):
            node, bit = train[i] >> (8 - level) | 1 << level, train[i] >> (7 - level) & 1
            for depth in range(deep + 1):
                counts.setdefault((node, train[i - depth : i]), [0, 0])[bit] += 1

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    @cache
    def weighted(node, context):
        own = kt(*counts[node, context])
        if len(context) == deep:
            return own
        below = sum(weighted(node, bytes([c]) + context) for c in range(256) if (node, bytes([c]) + context) in counts)
        return np.logaddexp(own, below) - math.log(2)

    def predict(node, past, depth):
        context = past[len(past) - depth :]
        if (node, context) not in counts:
            return 0.5
        a, b = counts[node, context]
        if depth == deep:
            return (b + 0.5) / (a + b + 1)
        share = math.exp(kt(a, b) - weighted(node, context) - math.log(2))
        return share * (b + 0.5) / (a + b + 1) + (1 - share) * predict(node, past, depth + 1)

    total = 0.0
    for i in range(deep, len(text)):
        for level in range(8):
            node, bit = text[i] >> (8 - level) | 1 << level, text[i] >> (7 - level) & 1
            one = predict(node, text[i - deep : i], 0)
            total += math.log10(one if bit else 1 - one)
    return total


def tree_of(keys, counts):
    """A tree whose subtrees are all in one bucket."""
    roots = next(ctw._roots(iter([pa.RecordBatch.from_arrays([pa.array([keys.tobytes()]), pa.array([counts.tobytes()])], ["keys", "counts"])])))
    top = ContextTree.top(roots.column(0).to_numpy().view(np.uint64), *(roots.column(i).to_numpy() for i in (1, 2, 3)))
    return ContextTree(top, keys, counts)


def test_context_tree_equals_sequential_weighting():
    train = "the cat and the hat. the bat sat on the mat, and that cat ate"
    keys, _ = ctw._symbols(part_of(train))
    tree = tree_of(*np.unique(keys, return_counts=True))
    pad = b"\xff" * ctw.DEPTH
    seen = ["the cat", "that hat", "cat and the", "a", "", "Zebra é", train]
    asked, offsets = ctw._symbols(part_of(*seen))
    got = np.add.reduceat(tree.log10(asked), offsets[:-1])
    for t, score in zip(seen, got, strict=True):
        assert score == pytest.approx(sequential_weighting(pad + train.encode() + b"\xff", pad + t.lower().encode() + b"\xff"), rel=1e-9)
    every = (asked[5] & ~np.uint64(0xFF)) | np.arange(256, dtype=np.uint64)
    assert (10.0 ** tree.log10(every)).sum() == pytest.approx(1)


def test_scores_equal_sequential_weighting(spark, monkeypatch):
    """Several texts, tasks, chunks and buckets: as one tree over the training texts, which begin afresh each."""
    rng = random.Random(12)
    rows = [(i, text_of(rng, 1, 5)) for i in range(12)] + [(20, ""), (21, None), (22, "É new 漢字"), (3, "again")]
    found = scored(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), F.col("doc_id") % 4 == 3).collect()
    pad = b"\xff" * ctw.DEPTH
    train = b"".join(pad + (t or "").lower().encode() for i, t in rows if i % 4 != 3)
    keys = np.concatenate([ctw._symbols(part_of(t))[0] for i, t in rows if i % 4 != 3])
    tree = tree_of(*np.unique(keys, return_counts=True))
    want = sorted((i, round(float(tree.log10(ctw._symbols(part_of(t))[0]).sum()), 3)) for i, t in rows)
    assert sorted((r.doc_id, round(r.score, 3)) for r in found) == want and train


def test_no_context_is_left_out():
    rng = np.random.default_rng(1)
    part = part_of(*(bytes(rng.integers(97, 123, 400).astype(np.uint8)).decode() for _ in range(20)))
    keys, counts = np.unique(ctw._symbols(part)[0], return_counts=True)
    for k, own in enumerate(ContextTree.subtrees(keys, counts)):
        met = np.unique((keys >> np.uint64(8)) & ctw._mask(ctw.SPLIT + k))
        assert (np.unique(own.keys >> np.uint64(8)) == met).all()


def test_known_texts_cost_less(spark):
    rng = random.Random(4)
    rows = [(i, text_of(rng, 5)) for i in range(120)] + [(900, "zq xjv qqz " * 30)]
    found = by_id(scored(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") >= 100).collect())
    bits = {i: -r.score / math.log10(2) / (len(rows[i][1].encode()) + 1) for i, r in found.items() if i < 120}
    assert max(bits.values()) < 3.5 and -found[900].score / math.log10(2) / 331 > 5


def test_empty_tables(spark, nothing):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    never = F.lit(False)
    assert judged(nothing).count() == scored_quality(nothing).count() == graded(nothing, labels).count() == 0
    assert identified(nothing, never).count() == scored(nothing, never).count() == without_toxic(nothing, labels).count() == 0


def test_counts_of_contexts_are_gone_before_the_last_shuffle(spark, monkeypatch):
    held, write = [], ctw.materialise
    names = lambda: set(os.listdir(shared_dir(spark).removeprefix("file:")))

    def seen(df, name):
        held.append({n.rsplit("-", 1)[0] for n in names() - before})
        return write(df, name)

    docs = spark.createDataFrame([(i, f"some words of text {i % 7}") for i in range(40)], "doc_id long, text string")
    shared_dir(spark)
    before = names()
    monkeypatch.setattr(ctw, "materialise", seen)
    found = scored(docs, F.col("doc_id") % 5 == 2).collect()
    assert len(found) == 40 and all(r.score < 0 for r in found)
    assert len(held) == 1 and "answers" in held[0] and "counts" not in held[0]


def test_contexts_and_texts_of_a_language_take_little_room():
    """What tasks send: keys that share their last bytes, small counts, and text."""
    rng = np.random.default_rng(6)
    text = " ".join(rng.choice(["the", "of", "and", "thing", "other", "over", "under", "again"], 20_000)).encode()
    keys, counts = np.unique(ctw._symbols(part_of(text.decode()))[0], return_counts=True)
    full, (sent, times) = ctw._cut(ctw._place(keys), 4, keys, counts)
    assert sorted(np.concatenate([ctw._unpacked(x, np.uint64) for x in sent]).tolist()) == keys.tolist()
    assert sum(ctw._unpacked(x, np.int64).sum() for x in times) == counts.sum()
    assert sum(map(len, sent)) < 0.6 * keys.nbytes
    assert len(ctw._packed(np.frombuffer(text, np.uint8))) < 0.4 * len(text)
    assert len(ctw._unpacked(ctw._packed(keys[:0]), np.uint64)) == 0


def test_values_of_keys_come_back_in_their_places():
    rng = np.random.default_rng(7)
    asked = rng.integers(0, 1 << 48, 1000, dtype=np.uint64)[rng.integers(0, 1000, 150_000)]  # more than one run
    keys = np.unique(np.append(asked, rng.integers(0, 1 << 48, 1000, dtype=np.uint64)))
    values = rng.random(len(keys))
    assert (ctw._looked_up(asked, keys, values) == values[np.searchsorted(keys, asked)]).all()
    assert len(ctw._looked_up(asked[:0], keys, values)) == 0

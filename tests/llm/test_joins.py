import random
import re
import time
import tracemalloc
from collections import defaultdict
from fractions import Fraction
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from reelstat.llm import blocks, decontam, jaccard, lines
from reelstat.llm.components import components
from reelstat.llm.decontam import benchmark_overlaps
from reelstat.llm.jaccard import jaccard_classes
from reelstat.llm.lines import edit_distances, repeated_lines, tolerance, without_repeated_lines
from reelstat.llm.storage import Scratch

from .conftest import sentence, text_of

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


class Union(dict):
    def root(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def link(self, x, y):
        x, y = self.root(x), self.root(y)
        self[max(x, y)] = min(x, y)


def sets_of(texts, k):
    out = {}
    for i, t in texts:
        w = WORD.findall((t or "").encode().lower())
        out[i] = {tuple(w[j : j + k]) for j in range(max(len(w) - k + 1, 1))} if w else set()
    return out


def brute_classes(texts, k, t):
    sets, union = sets_of(texts, k), Union()
    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j]:
                shared = len(sets[i] & sets[j])
                if shared * t.denominator >= t.numerator * len(sets[i] | sets[j]):
                    union.link(i, j)
    return {i: (len(s), union.root(i)) for i, s in sets.items()}


@pytest.mark.parametrize(("k", "t"), [(3, Fraction(9, 10)), (5, Fraction(4, 5))])
def test_jaccard_classes_equal_brute_force(spark, awkward, texts, k, t):
    rng = random.Random(9)
    base = text_of(rng, 10).split()
    copies = []
    for i in range(40):  # a family of near copies, more or less alike
        own = list(base)
        for _ in range(rng.randint(1, 6)):
            own[rng.randrange(len(own))] = "other"
        copies.append((500 + i, " ".join(own)))
    docs = awkward.select("doc_id", "text", "n", "node", "class", "kind").unionByName(spark.createDataFrame(copies, "doc_id long, text string"), True)
    found = jaccard_classes(docs, k, t).collect()
    known = [(i, x) for i, x in [*texts, *copies] if i is not None]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found if r.doc_id is not None} == brute_classes(known, k, t)
    assert len(found) == len(texts) + len(copies)
    # rows without an id: one joins its copy's class, the others stand alone
    assert sorted(r.component_id or -1 for r in found if r.doc_id is None) == [-1, -1, 6]


def test_a_family_larger_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 7)
    rng = random.Random(2)
    base = text_of(rng, 6).split()
    rows = [(i, " ".join([*base[:i], f"w{i}", *base[i + 1 :]])) for i in range(60)]
    found = {r.doc_id: r.component_id for r in jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string"), 3, Fraction(9, 10)).collect()}
    assert found == {i: c for i, (_, c) in brute_classes(rows, 3, Fraction(9, 10)).items()}


def test_every_linked_pair_agrees_in_a_block():
    rng = np.random.default_rng(1)
    for t in (Fraction(9, 10), Fraction(4, 5), Fraction(1, 2)):
        classes = jaccard.SizeClasses(t, 2000)
        for n in (2, 3, 8, 9, 10, 27, 60, 200, 1500):
            x = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            for _ in range(8):
                drop = int(n * (1 - t) / 2) + 1
                y = np.unique(np.concatenate([rng.choice(x, n - rng.integers(0, drop + 1), replace=False), rng.integers(0, 1 << 63, rng.integers(0, drop + 1), dtype=np.uint64)]))
                shared = len(np.intersect1d(x, y))
                if len(y) > 1 and shared * t.denominator >= t.numerator * (len(x) + len(y) - shared):
                    keys = [set(np.concatenate(jaccard._agreements(s, classes)).tolist()) for s in (x, y)]
                    assert keys[0] & keys[1]


def test_unrelated_sets_share_no_key():
    rng = np.random.default_rng(2)
    for t in (Fraction(9, 10), Fraction(4, 5)):
        classes = jaccard.SizeClasses(t, 2000)
        for n in (60, 245, 470, 870):
            keys = [np.unique(np.concatenate(jaccard._agreements(np.sort(rng.integers(0, 1 << 63, n, dtype=np.uint64) * 2), classes))) for _ in range(60)]
            assert np.unique(np.concatenate(keys), return_counts=True)[1].max() == 1


def test_sets_that_fill_few_blocks_still_agree():
    rng = np.random.default_rng(3)
    classes = jaccard.SizeClasses(Fraction(4, 5), 2000)
    for n in (5, 20, 100, 400):
        crowded = np.unique(rng.integers(0, 1 << 40, n, dtype=np.uint64))  # all in the first block
        for _ in range(20):
            y = rng.choice(crowded, len(crowded) - len(crowded) // 5, replace=False)
            keys = [set(np.concatenate(jaccard._agreements(np.sort(s), classes)).tolist()) for s in (crowded, y)]
            assert keys[0] & keys[1]


def test_large_sets_with_single_grams_in_common_share_no_key():
    """Texts of one language share a few grams by chance; pairs that meet by those grow with the square of the input."""
    rng = np.random.default_rng(4)
    classes = jaccard.SizeClasses(Fraction(4, 5), 2000)
    for n in (870, 1900):
        pool = np.unique(rng.integers(0, 1 << 63, n * n // 8, dtype=np.uint64)) * np.uint64(2)  # eight in common with each other set
        keys = [np.unique(np.concatenate(jaccard._agreements(np.sort(rng.choice(pool, n, replace=False)), classes))) for _ in range(60)]
        assert np.unique(np.concatenate(keys), return_counts=True)[1].max() == 1


def test_large_sets_that_are_just_linked_agree():
    rng = np.random.default_rng(5)
    for t in (Fraction(4, 5), Fraction(9, 10)):
        classes = jaccard.SizeClasses(t, 5000)
        for n in (300, 362, 453, 886, 1000, 4000):
            for grown in (False, True):  # a subset, or as many grams in the place of others
                for _ in range(10):
                    x = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
                    left = int(np.ceil(2 * t * n / (1 + t))) if grown else int(np.ceil(t * n))
                    more = rng.integers(0, 1 << 63, n - left if grown else 0, dtype=np.uint64) * np.uint64(2)
                    y = np.unique(np.concatenate([rng.choice(x, left, replace=False), more]))
                    keys = [set(np.concatenate(jaccard._agreements(s, classes)).tolist()) for s in (x, y)]
                    assert keys[0] & keys[1]


def test_hashes_that_differ_in_high_bits_do_not_meet():
    h = np.array([5, 5 + (1 << 32), 5 + (1 << 47), 5, 9], np.uint64)
    nodes = np.arange(1, 6)
    batch = pa.RecordBatch.from_arrays([pa.array([0, 0]), *(pa.array([f(x[:2]), f(x[2:])]) for x, f in ((h, blocks.packed), (nodes, np.ndarray.tobytes)))], ["bucket", "hashes", "nodes"])
    (edges,) = blocks.meeting(iter([batch]))
    assert edges.to_pylist() == [{"a": 4, "b": 1}]


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(330)] + [(1000 + i, 1001 + i) for i in range(70)] + [(5, 5), (None, 3)]
    union = Union()
    for a, b in edges:
        if a is not None and a != b:
            union.link(a, b)
    with Scratch(spark) as scratch:
        found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), scratch).collect()}
        assert found == {x: union.root(x) for x in list(union)}
        assert components(spark.createDataFrame([], "a long, b long"), scratch).count() == 0
        assert len(scratch.paths) == 2


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_banded_edit_distance():
    rng = random.Random(3)
    pairs = []
    for _ in range(1200):
        a = [rng.choice("abc") for _ in range(rng.randint(0, 14))]
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            at = rng.randint(0, len(b))
            if rng.random() < 0.5:
                b.insert(at, rng.choice("abcd"))
            elif at < len(b):
                b[at : at + 1] = rng.choice([[], ["x"]])
        pairs.append((a, b))
    arrays = [tuple(np.array([ord(c) for c in x], np.uint32) for x in p) for p in pairs]
    for most in (1, 2, 4):
        assert edit_distances(arrays, most).tolist() == [min(distance(a, b), most + 1) for a, b in pairs]


def brute_lines(texts, least=16):
    at, union = defaultdict(set), Union()
    for i, t in texts:
        for k, line in enumerate((t or "").split("\n")):
            if len(line) >= least and WORD.search(line.encode()):
                at[line].add((i, k))
    lines = sorted(at, key=len)
    for j, b in enumerate(lines):
        for a in lines[:j]:
            if len(b) - len(a) <= tolerance(len(a)) and tolerance(len(a)) and distance(a, b) <= tolerance(len(a)):
                union.link(a, b)
    groups = defaultdict(set)
    for line, places in at.items():
        groups[union.root(line)] |= places
    lost = defaultdict(list)
    for places in groups.values():
        for i, k in sorted(places)[1:]:
            lost[i].append(k)
    return {i: sorted(lost[i]) for i, _ in texts}


def test_repeated_lines_equal_brute_force(spark):
    rng = random.Random(8)
    line = [sentence(rng, n) for n in (3, 4, 6, 9, 16, 25, 40)]
    altered = [x[:7] + "q" + x[8:] for x in line] + [x[:-4] + x[-3:] for x in line] + ["ab" + x for x in line] + [x[3:] for x in line]
    texts = [(i, "\n".join(rng.choice([*line, *altered, "", "short"]) for _ in range(rng.randint(1, 6)))) for i in range(40)]
    texts += [(50, None), (51, ""), (52, "\n\n"), (53, "Un " * 30), (54, "日本語の長い行がここにありますのでどうぞよろしく😀\n" * 2)]
    docs = spark.createDataFrame([(i, t, 0) for i, t in [*texts, texts[0], (None, texts[0][1])]], "doc_id long, text string, removed int")
    found = repeated_lines(docs).collect()
    expected = brute_lines(texts)
    assert {r.doc_id: r.removed for r in found if r.doc_id is not None} == expected and len(found) == len(texts) + 2
    assert {r.doc_id: r.n_lines for r in found}[52] == 3
    kept = without_repeated_lines(docs)
    assert kept.columns == docs.columns
    by_id = {r.doc_id: r.text for r in kept.collect()}
    for i, t in texts:
        left = None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in expected[i])
        if expected[i] and not left.strip():
            assert i not in by_id
        else:
            assert by_id[i] == left
    assert by_id[None] == texts[0][1]


def test_benchmark_overlaps(spark, awkward):
    rng = random.Random(6)
    items = [(i, text_of(rng, 2, 16)) for i in range(12)] + [(20, "too short an item"), (21, None), (22, "")]
    changed = items[3][1].split()
    changed[5], changed[19] = "other", "else"
    host = text_of(rng, 6).split("\n")
    rows = [
        (900, "\n".join([*host[:3], items[2][1], *host[3:]]), 1),
        (901, " ".join([*host[0].split(), *changed, *host[1].split()]).upper(), 1),
        (902, items[4][1], 1),
        (902, items[4][1], 1),
        (903, " ".join(items[5][1].split()[:8]), 1),  # less than the shortest overlap
        (904, items[6][1] + " " + items[7][1], 1),
        (None, items[8][1], 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id int").unionByName(awkward.select("doc_id", "text", "item", "group"), True)
    bench = spark.createDataFrame([(i, t, 5) for i, t in [*items, items[2]]], "item_id int, text string, doc_id int")
    found = {(r.doc_id, r.item_id): r for r in benchmark_overlaps(docs, bench).collect()}
    assert set(found) == {(900, 2), (901, 3), (902, 4), (904, 6), (904, 7), (None, 8)}
    assert found[901, 3].length == 32 and found[901, 3].matched == 30 and found[901, 3].start == 14
    assert found[900, 2].matched == found[900, 2].length == 32 and found[900, 2].item_start == 0


def test_longest_stretch_equals_brute_force():
    rng = np.random.default_rng(4)
    for t in (Fraction(4, 5), Fraction(9, 10), Fraction(1, 2)):
        for n in (1, 2, 7, 13, 30):
            for _ in range(60):
                same = rng.random(n) < rng.random()
                spans = [(e - s, int(same[s:e].sum()), -s) for s in range(n) for e in range(s, n + 1) if same[s:e].sum() >= t * (e - s)]
                s, e = decontam._longest_stretch(same, t)
                assert (e - s, int(same[s:e].sum())) == max(spans)[:2]


def test_overlaps_at_all_places_of_substitutions(spark):
    items, rows = [], []
    for k, (n, changes) in enumerate([(13, 2), (15, 3), (16, 3), (12, 2), (9, 1), (5, 1), (3, 0)]):
        item = [f"w{k}x{j}" for j in range(n)]
        items.append((k, " ".join(item)))
        for places in combinations(range(n), changes):
            i = len(rows)
            own = [f"other{i}" if j in places else w for j, w in enumerate(item)]
            rows.append((i, " ".join([f"before{i}", f"a{i}", *own, f"b{i}", f"after{i}"]), k, n, changes))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    found = benchmark_overlaps(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id, r.start, r.item_start, r.length, r.matched) for r in found} == {(i, k, 2, 0, n, n - c) for i, _, k, n, c in rows}


def test_a_mask_hits_at_all_places_of_substitutions():
    for n in range(13, 26):
        changes = n - -(-4 * n // 5)
        places = np.array(list(combinations(range(n), changes)))
        changed = (1 << places).sum(axis=1)
        hit = np.zeros(len(changed), bool)
        for mask in decontam.MASKS:
            for at in range(n - len(mask) + 1):
                hit |= changed & sum(1 << (at + j) for j, c in enumerate(mask) if c == "1") == 0
        assert hit.all()


def test_empty_tables(spark, nothing, awkward):
    assert jaccard_classes(nothing).count() == 0
    assert repeated_lines(nothing).count() == 0 and without_repeated_lines(nothing).columns == nothing.columns
    bench = spark.createDataFrame([(1, "x")], "item_id int, text string")
    assert benchmark_overlaps(nothing, bench).count() == 0 and benchmark_overlaps(awkward, bench.where("false")).count() == 0


def test_rows_of_one_id_with_different_texts_keep_their_links(spark):
    rng = random.Random(31)
    a, b = (" ".join(text_of(rng, 8).split()) for _ in range(2))
    for rows in ([(1, a), (1, b), (2, a + " more"), (3, b + " more")], [(7, b), (7, a), (2, a + " more"), (3, b + " more"), (7, a)]):
        found = jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 3, Fraction(9, 10)).collect()
        got = {(r.doc_id, r.component_id) for r in found}
        assert len(found) == len(rows)
        assert got == ({(1, 1), (2, 1), (3, 1)} if rows[0][0] == 1 else {(7, 2), (7, 3), (2, 2), (3, 3)})


def test_rows_of_one_id_with_different_texts_keep_their_own_lines(spark):
    same, other = "this very line is here and in another document too", "a line that occurs nowhere else at all, and is kept"
    rows = [(1, f"{same}\nsomething of the first text alone"), (1, f"{other}\n{same}"), (0, same), (1, f"{other}\n{same}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(r.text for r in without_repeated_lines(docs).collect()) == sorted([same, "something of the first text alone", other, other])
    assert sorted((r.doc_id, r.removed) for r in repeated_lines(docs).collect()) == [(0, []), (1, [0]), (1, [1]), (1, [1])]


def test_a_text_of_many_repeated_lines_is_cut_in_one_walk(spark):
    lines = [f"line {k:05d} of one that stands twice" for k in range(40_000)]
    rows = [(1, "\n".join(lines)), (2, "\n".join([*lines, "and one more line of its own"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    cut = without_repeated_lines(docs)
    start = time.time()
    assert {r.doc_id: r.text for r in cut.collect()} == {1: rows[0][1], 2: "and one more line of its own"}
    assert time.time() - start < 10


def test_lines_are_scanned_in_slices_of_little_memory():
    """Four megabytes of text in one batch: what numpy holds at once stays below 100 MB."""
    text = "\n".join(f"line number {i} of a text that is long enough to be cut into two segments" for i in range(500))
    n = (4 << 20) // len(text)
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(range(n)), pa.array([f"{text} {i}" for i in range(n)])], ["doc_id", "digest", "text"])
    tracemalloc.start()
    try:
        rows = sum(x.num_rows for x in lines._scan(16, 4)(iter([batch])) if x.column(0)[0].as_py() == 0)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == n and most < 100e6

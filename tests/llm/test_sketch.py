import random
from fractions import Fraction
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reelstat.llm import blocks, jaccard, sketch
from reelstat.llm.jaccard import jaccard_classes

from .test_joins import Union, brute_classes


def grams(rng, n):
    return np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1) + rng.integers(0, 2, n, dtype=np.uint64))


def may(sets, t):
    held = sketch._Sketches(np.array([len(s) for s in sets]), [sketch.sketch(s) for s in sets], t)
    i, j = (np.array(x) for x in zip(*combinations(range(len(sets)), 2), strict=True))
    return held.may(i, j)


@pytest.mark.parametrize("t", [Fraction(1, 3), Fraction(4, 5), Fraction(9, 10)])
def test_sets_that_are_just_linked_pass(t):
    rng = np.random.default_rng(1)
    for n in (2, 3, 20, 36, 115, 128, 129, 150, 250, 257, 500, 512, 520, 1000, 1100, 3000):
        for _ in range(20):
            x = grams(rng, n)
            subset = rng.choice(x, int(np.ceil(t * len(x))), replace=False)
            left = int(np.ceil(2 * t * len(x) / (1 + t)))
            other = np.concatenate([rng.choice(x, left, replace=False), grams(rng, len(x) - left)])
            assert may([x, subset], t).all() and may([x, other], t).all()


def test_unrelated_sets_do_not_pass():
    rng = np.random.default_rng(2)
    for t in (Fraction(4, 5), Fraction(9, 10)):
        for n in (36, 100, 207, 300, 700, 1500):
            common = grams(rng, n // 8)  # some grams in common, as texts of one language have
            sets = [np.unique(np.concatenate([common, grams(rng, n - len(common))])) for _ in range(40)]
            assert may(sets, t).mean() < 0.01


def met(rows, at=7):
    """Rows of (unit, node) for (bucket, hash, nodes)."""
    hashes = [np.repeat(np.uint64(h), len(nodes)) for _, h, nodes in rows]
    columns = [pa.array([b for b, _, _ in rows]), pa.array([blocks.packed(h) for h in hashes]), pa.array([np.array(nodes, np.int64).tobytes() for _, _, nodes in rows])]
    batch = pa.RecordBatch.from_arrays(columns, ["bucket", "hashes", "nodes"])
    units = {}
    for out in sketch.meetings(iter([batch.slice(0, at), batch.slice(at)])):
        for unit, node in zip(*(c.to_pylist() for c in out.columns), strict=True):
            units.setdefault(unit, []).append(node)
    return units


def test_meetings(monkeypatch):
    rows = [(0, 5, [1, 2]), (0, 6, [3]), (0, 5, [2]), (0, 7, [2]), (0, 7, [1]), (1, 5, [9]), (1, 8, [4, -5, 6])]
    # who meets in two hashes is one unit; hashes of other buckets, of one node only or of the same node again are none
    assert sorted(sorted(set(x)) for x in met(rows, 2).values()) == [[-5, 4, 6], [1, 2]]
    monkeypatch.setattr(sketch, "MEETING_ROWS", 10)
    units = met([(0, 5, range(95)), (0, 6, range(200, 210))])
    assert max(map(len, units.values())) <= 20
    pairs = {p for x in units.values() for p in combinations(sorted(x), 2)}
    assert pairs == {*combinations(range(95), 2), *combinations(range(200, 210), 2)}


@pytest.mark.parametrize("pairwise", [1, 6, 1024])
def test_possible_links_equal_all_pairs(monkeypatch, pairwise):
    """Units over several batches, walked or pair by pair, a few pairs at once."""
    rng = np.random.default_rng(3)
    monkeypatch.setattr(sketch, "PAIRWISE_ROWS", pairwise)
    monkeypatch.setattr(sketch, "PAIRS_AT_ONCE", 50)
    monkeypatch.setattr(sketch, "ROWS_AT_ONCE", 16)
    sets, rows = {}, []
    for unit, members in ((-7, 2), (-2, 40), (0, 1), (4, 9), (11, 33), (12, 2)):
        base = [grams(rng, int(n)) for n in (30, 130, 260, 1200)]
        for _ in range(members):
            x = base[rng.integers(0, 4)]
            x = np.unique(np.concatenate([rng.choice(x, int(len(x) * rng.uniform(0.85, 1)), replace=False), grams(rng, len(x) // 20)]))
            sets[len(sets)] = unit, x
            rows.append((unit, len(sets) - 1, len(x), sketch.sketch(x)))
    t, want = Fraction(4, 5), Union()
    for a, b in combinations(sets, 2):
        if sets[a][0] == sets[b][0] and may([sets[a][1], sets[b][1]], t)[0]:
            want.link(a, b)
    table = pa.Table.from_pylist([dict(zip(("unit", "node", "n", "sketch"), r, strict=True)) for r in rows])
    found = Union()
    for out in sketch.possible(t)(iter(table.to_batches(max_chunksize=7))):
        for a, b in zip(*(c.to_pylist() for c in out.columns), strict=True):
            found.link(a, b)
    assert [found.root(i) for i in sets] == [want.root(i) for i in sets]


def test_texts_that_share_single_shingles_form_no_family(spark, monkeypatch):
    """Noise of four symbols: every text shares shingles with many others, so all were one family, and each of its rows was sent once
    for each block of it."""
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["###", "%%%", "$$$", "&&&"]) for _ in range(40))) for i in range(600)]
    for i in range(20):  # and a near copy of some
        words = rows[i][1].split()
        rows.append((1000 + i, " ".join([*words[:-1], "@@@"])))
    largest = []
    cut = jaccard.units

    def seen(members, *more):
        largest.append(members.groupBy("family").count().agg(F.max("count")).first()[0])
        return cut(members, *more)

    monkeypatch.setattr(jaccard, "units", seen)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == brute_classes(rows, 5, Fraction(4, 5))
    assert all(found[1000 + i][1] == i for i in range(20))
    assert largest[0] <= 4

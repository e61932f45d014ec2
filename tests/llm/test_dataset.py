"""Vector codes, the Merkle manifest and shards, against brute force; the registered queries against their contracts and SQL."""

import math
import os
import random
import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from checks.compare import actual, expected
from reelstat.llm import merkle, sharding
from reelstat.llm.codes import Codebooks, compressed
from reelstat.llm.merkle import LEAF, manifest, without_breaks
from reelstat.llm.oracle import ORACLES
from reelstat.llm.ranking import positions, ranked
from reelstat.llm.sharding import longest_first, sharded, write_shards
from reelstat.llm.storage import Scratch

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
here = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@here
@pytest.mark.parametrize("name", [n for n in ORACLES if n in entry_point.queries()])
def test_query_equals_its_sql(spark, name):
    assert actual(entry_point.queries()[name](spark, SF)) == expected(SF, ORACLES[name])


# --- vector codes


def brute_codes(rows, parts, entries, rounds):
    kept = [(i, label, [math.floor(1024 * x) for x in v]) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for *_, v in kept), default=0) // parts) * parts
    size = width // parts
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, np.array(r[2], "<i4").tobytes()))
    kept = [(i, label, v + [0] * (width - len(v))) for i, label, v in kept]
    books = [[v[p * size : (p + 1) * size] for _, _, v in kept[:entries]] for p in range(parts)]

    def nearest(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v[p * size : (p + 1) * size], e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            own = [nearest(p, v)[1] for *_, v in kept]
            for k in range(len(books[p])):
                members = [v[p * size : (p + 1) * size] for (*_, v), o in zip(kept, own, strict=True) if o == k]
                if members:
                    books[p][k] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    out = []
    for i, label, v in kept:
        found = [nearest(p, v) for p in range(parts)]
        out.append((i, label, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    total = {}
    for _, label, _, e in out:
        total[label] = total.get(label, 0) + e
    text = ",".join(str(x) for p in books for e in p for x in e)
    return sorted(((i, label, c, e, total[label]) for i, label, c, e in out), key=str), sha256(text.encode()).hexdigest()


VECTORS = "vec_id long, embedding array<float>, label int"


def vectors(n, width, seed=1):
    rng = random.Random(seed)
    rows = [(k, [rng.choice([-1, 1]) * rng.randint(0, 40) / 64 for _ in range(width)], rng.choice([None, 1, 2])) for k in range(n)]
    nan, inf = float("nan"), float("inf")
    return [
        *rows,
        (rows[0][0], rows[1][1], 7),  # an id again with another vector
        rows[2],
        rows[2],
        (None, rows[3][1], 2),
        (900, None, 1),
        (901, [nan] + [0.5] * (width - 1), 1),
        (902, [None] + [0.5] * (width - 1), 1),
        (903, [0.1] * (width - 1) + [-inf], 1),
        (904, [0.25], 1),
        (905, [], 1),
        (-7, [0.00001, -0.00001] * (width // 2), None),
    ]


@pytest.mark.parametrize(("n", "width", "entries"), [(60, 8, 16), (5, 6, 256)])
def test_codes_equal_brute_force(spark, n, width, entries):
    rows = vectors(n, width)
    table = spark.createDataFrame(rows, VECTORS).repartition(3).withColumn("cells", F.lit(1)).withColumn("code", F.lit("x"))
    codes, books = compressed(table, entries=entries)
    want, digest = brute_codes(rows, 4, entries, 4)
    got = sorted((tuple(r) for r in codes.collect()), key=str)
    assert got == want
    assert books.sha256 == digest


def test_codes_decode_to_their_error(spark):
    rows = [r for r in vectors(80, 8) if r[1] is not None and len(r[1]) == 8]
    codes, books = compressed(spark.createDataFrame(rows, VECTORS), entries=32)
    by_id = {r.vec_id: r for r in codes.collect()}
    for i, v, _ in rows[:80]:
        if i in (0, 2):
            continue
        entry = np.array([[int(by_id[i].code[k : k + 2], 16) for k in range(0, 8, 2)]])
        cells = np.floor(1024 * np.array(v)).astype(int)
        assert ((books.decode(entry)[0] - cells) ** 2).sum() == by_id[i].error


def test_codes_of_nothing_and_of_huge_components(spark):
    codes, books = compressed(spark.createDataFrame([], VECTORS))
    assert codes.count() == 0 and books.entries.size == 0
    codes, books = compressed(spark.createDataFrame([(1, [3e38, -3e38, 0.0, 1.0], None), (2, [3e38, -3e38, 0.0, 2.0], None)], VECTORS))
    assert {r.error for r in codes.collect()} == {0} and abs(books.entries).max() == 1 << 27


def test_distances_in_wide_integers_equal_narrow_ones():
    rng = np.random.default_rng(3)
    cells = rng.integers(-500, 500, (700, 8))
    far = cells.copy()
    far[0, 0] = 1 << 26
    books = Codebooks(rng.integers(-500, 500, (2, 16, 4)), 8)
    for a, b in zip(list(books.distances(cells)), list(books.distances(far)), strict=True):
        assert (a[1:] == b[1:]).all() and b.dtype == np.int64
    narrow = next(books.distances(cells))
    assert narrow.dtype == np.int32 and narrow[5, 3] == ((cells[5, :4] - books.entries[0, 3]) ** 2).sum()


# --- Merkle manifest


def H(text):
    return sha256(text.encode()).hexdigest()


def brute_tree(nodes):
    """(root, proof of each node as level texts) of one tree."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H("".join(levels[-1][i : i + 3])) for i in range(0, len(levels[-1]), 3)])
    paths = []
    for at in range(len(nodes)):
        path = []
        for level in levels[:-1]:
            run = at // 3 * 3
            path.append(("".join(level[run:at]), "".join(level[at + 1 : run + 3])))
            at //= 3
        paths.append(path)
    return levels[-1][0], paths


def brute_manifest(rows):
    def leaf(values):
        return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        members = sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((members, brute_tree([leaf(r) for r in members])))
    root, above = brute_tree([sub for _, (sub, _) in trees])
    out = []
    for (members, (sub, paths)), upper in zip(trees, above, strict=True):
        for r, own in zip(members, paths, strict=True):
            path = [*own, *upper]
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
            node = leaf((*r[:4], r[4].replace("\n", ""))) if changed else leaf(r)
            copies = []
            for a, b in path:
                node = H(a + node + b)
                copies.append(node)
            out.append((r[0], leaf(r), sub, root, H("".join(a + b for a, b in path)), copies if changed else None, node, [a + b for a, b in path], node == root))
    return sorted(out, key=str)


DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def check_manifest(spark, rows, extra=()):
    table = spark.createDataFrame(rows, DOCS).repartition(5)
    for name in extra:
        table = table.withColumn(name, F.lit(1))
    got = manifest(table, without_breaks(table), proofs=True).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_manifest(rows)
    return got


def test_manifest_of_awkward_rows(spark):
    rows = [(k, f"s{k % 3}", "en", k, f"text {k}\nmore") for k in range(25)]
    rows += [(3, "s0", "en", 3, "text 3\nmore"), (3, "s0", "en", 3, "text 3\nmore"), (3, "s0", None, None, None)]
    rows += [(None, "s0", "en", 1, "x\ny"), (None, None, None, None, None), (None, None, None, None, None), (-5, None, "é", 2, "漢\n字")]
    rows += [(40, "", "", 0, ""), (41, "-", "-", 0, "-"), (42, "=", "", 0, "\n\n"), (43, "é", "", 0, "x" * 300_000 + "\n"), (44, "~", "", 0, None)]
    got = check_manifest(spark, rows, ("tree", "at", "digest", "block", "path", "root", "tampered", "leaf"))
    assert {r.verified for r in got} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 27, merkle.BLOCK - 1, merkle.BLOCK, merkle.BLOCK + 1, 2 * merkle.BLOCK + 1])
def test_manifest_at_the_bounds_of_blocks(spark, n):
    check_manifest(spark, [(k, "one", None, 1, f"{k}\n") for k in range(n)])


def test_manifest_of_a_hot_source_among_many(spark):
    """More sources than a block holds, one of three blocks, and a third of the rows equal."""
    rows = [(k, f"s{k}", None, 1, "a\nb") for k in range(merkle.BLOCK + 40)]
    rows += [(k, "hot", None, 1, f"a\n{k}") for k in range(merkle.BLOCK)] + [(7, "hot", None, 1, "same\n")] * 900
    check_manifest(spark, rows)


def test_manifest_without_tampering_or_rows(spark):
    plain = spark.createDataFrame([(k, "s", "en", 1, "a\nb") for k in range(10)], DOCS)
    got = manifest(plain).collect()
    assert all(r.verified and r.copied is None for r in got) and "proof" not in got[0].asDict()
    nothing = plain.where("false")
    assert manifest(nothing, without_breaks(nothing)).count() == 0


def test_a_leaf_tells_columns_and_nulls_apart(spark):
    rows = [(1, "ab", "c", 1, "x"), (1, "a", "bc", 1, "x"), (1, None, "c", 1, "x"), (1, "-", "c", 1, "x"), (1, "", "c", 1, "x")]
    table = spark.createDataFrame(rows, DOCS)
    assert table.select(merkle.leaf({c: F.col(c) for c in LEAF})).distinct().count() == len(rows)


def test_ranks_of_a_group_over_partitions(spark):
    rows = [("a" if k % 3 else "b", (k * 7919) % 1000) for k in range(1000)]
    with Scratch(spark) as scratch:
        got = ranked(spark.createDataFrame(rows, "g string, v long").repartition(6), "g", ["v"], "rank", scratch).collect()
    for g in "ab":
        mine = sorted((r.v, r["rank"]) for r in got if r.g == g)
        assert [k for _, k in mine] == list(range(len(mine)))


def test_positions_of_groups_in_several_partitions(spark):
    table = spark.range(500).selectExpr("id", "id % 3 as g").repartition(7).sortWithinPartitions("g")
    with Scratch(spark) as scratch:
        got = positions(table, "g", "place", scratch).collect()
    for g in range(3):
        assert sorted(r.place for r in got if r.g == g) == list(range(sum(1 for r in got if r.g == g)))


# --- sharding


def check_shards(rows, got, shards):
    assert len(got) == len(rows)
    text = dict(enumerate(t for _, t in rows))
    where, load, slots = {}, [0] * shards, [[] for _ in range(shards)]
    for r in got:
        where.setdefault(text[r.row] or "", set()).add(r.shard)
        load[r.shard] += len((text[r.row] or "").encode()) + 1
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in where.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    return load


def brute_load(rows, shards):
    weight = {}
    for _, t in rows:
        weight[t or ""] = weight.get(t or "", 0) + len((t or "").encode()) + 1
    load = [0] * shards
    for w in sorted(weight.values(), reverse=True):
        load[load.index(min(load))] += w
    return load


def test_shards_of_awkward_texts_equal_one_heap(spark, awkward, texts):
    rows = [(*r, k, "x", 0) for k, r in enumerate(awkward.collect())]
    schema = awkward.schema.add("row", "integer").add("Shard", "string").add("_h1", "integer")
    numbered = spark.createDataFrame(rows, schema).repartition(4)
    given = [r[:2] for r in rows]
    assert len(given) == len(texts)
    got = sharded(numbered, 5)
    assert "Shard" not in got.columns and set(numbered.columns) - {"Shard"} == set(got.columns) - {"shard", "slot"}
    load = check_shards(given, got.collect(), 5)
    # all groups are large here, so there is one heap only
    assert sorted(load) == sorted(brute_load(given, 5))


def test_shards_of_many_small_groups_are_near_equal(spark, tmp_path):
    rng = random.Random(2)
    rows = [(k, "x" * rng.randint(1, 60) + str(k)) for k in range(60_000)]
    rows += [(0, "copy " * 400)] * 300 + [(1, None)] * 50 + [(2, "")] * 50
    table = spark.createDataFrame([(k, i, t) for k, (i, t) in enumerate(rows)], "row long, doc_id long, text string").repartition(6)
    found = sharded(table, 4, keep=["row"])
    load = check_shards(rows, found.collect(), 4)
    total = sum(load)
    assert max(load) - min(load) <= total // (sharding.BUCKETS * sharding.BINS) + 2000
    assert max(load) <= total / 4 * 1.001
    write_shards(found, f"{tmp_path}/shards")
    assert spark.read.parquet(f"{tmp_path}/shards").groupBy("shard").count().count() == 4


def test_a_group_beyond_its_share_has_a_shard_alone(spark):
    rows = [(k, "all the same text here") for k in range(2000)] + [(k, f"other {k}") for k in range(1000)]
    table = spark.createDataFrame([(k, i, t) for k, (i, t) in enumerate(rows)], "row long, doc_id long, text string").repartition(5)
    load = check_shards(rows, sharded(table, 3, keep=["row"]).collect(), 3)
    assert sorted(load) == sorted(brute_load(rows, 3))


def test_shards_of_nothing(spark, nothing):
    assert sharded(nothing, 8).count() == 0


def test_the_heap_takes_the_least_loaded_bin():
    assert longest_first([9, 8, 7, 6, 5, 4], 3) == [0, 1, 2, 2, 1, 0]
    assert longest_first([], 3) == []


# --- contracts


@here
def test_contract_of_op13(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    found = entry_point.queries()["op13_sharding"](spark, SF)
    assert dict(found.dtypes) | {"shard": "int", "slot": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string"} == dict(found.dtypes)
    got = found.collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    where, load = {}, [0] * 8
    for r in got:
        raw = (docs[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        where.setdefault(raw, set()).add(r.shard)
        load[r.shard] += r["size"]
    assert all(len(s) == 1 for s in where.values())
    assert sorted(load) == sorted(brute_load(list(docs.items()), 8))


@here
def test_contract_of_op12(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(*LEAF).collect()]
    found = entry_point.queries()["op12_merkle_manifest"](spark, SF)
    got = sorted((tuple(r) for r in found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)
    assert got == sorted(((r[0], r[1], r[2], r[3], r[4], r[6], r[8]) for r in brute_manifest(rows)), key=str)


@here
def test_contract_of_op11(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").limit(300).collect()]
    want, digest = brute_codes(rows, 4, 16, 1)
    codes, books = compressed(spark.createDataFrame(rows, VECTORS), entries=16, rounds=1)
    assert sorted((tuple(r) for r in codes.collect()), key=str) == want and books.sha256 == digest

"""The cell index: exact answers from few cells, updates without refitting, recall of the approximate form."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelstat.operators import vector_index
from reelstat.operators.vector_index import VectorIndex
from reelstat.plans import embeddings

ROW = "uri string, embedding array<double>"
WIDTH = 12


def clustered(groups, per, seed=1, noise=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, WIDTH))
    return [(f"{g:02d}/{i:03d}", (centres[g] + noise * rng.normal(size=WIDTH)).tolist()) for g in range(groups) for i in range(per)]


def brute(rows, queries, k):
    kept = sorted((i, np.array(v)) for i, v in rows if v is not None and len(v) == WIDTH and np.isfinite(v).all() and np.any(v))
    m = np.array([v / np.linalg.norm(v) for _, v in kept])
    out = {}
    for name, q in queries:
        if q is None or len(q) != WIDTH or not np.any(q):
            continue
        s = np.round(m @ (np.array(q) / np.linalg.norm(q)), 12)
        out[name] = [(kept[j][0], s[j]) for j in np.lexsort((range(len(s)), -s))[:k]]
    return out


def answers(best):
    out = {}
    for r in sorted(best.collect(), key=lambda r: (r["query"], r["rank"])):
        out.setdefault(r["query"], []).append((r["uri"], r["similarity"]))
    return out


def same(a, b):
    assert {q: [i for i, _ in rows] for q, rows in a.items()} == {q: [i for i, _ in rows] for q, rows in b.items()}
    for q in a:
        assert np.allclose([s for _, s in a[q]], [s for _, s in b[q]], atol=1e-9)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """An index built from half of the rows and brought up to date with the others, odd ones among them."""
    rows = clustered(30, 20)
    rows += [("zero", [0.0] * WIDTH), ("short", [1.0]), ("none", None), ("nan", [float("nan")] * WIDTH)]
    rows += [(f"same{k}", rows[7][1]) for k in range(5)]
    table = spark.createDataFrame(rows, ROW).repartition(4)
    index = VectorIndex(spark, str(tmp_path_factory.mktemp("index")), "uri")
    index.build(table.where(F.col("uri").substr(5, 1) < "5"), 30, seed=3)
    before = {p: index.rows.commit_info()["paths"].count(p) for p in index.rows.commit_info()["paths"]}
    index.add(index.missing(table))
    assert index.missing(table).count() == 0 and set(before) <= set(index.rows.commit_info()["paths"])
    return index, rows


def test_the_answer_is_exact_and_reads_few_cells(spark, built):
    index, rows = built
    queries = [(i, v) for k, (i, v) in enumerate(rows) if k % 7 == 0] + [("far", [1.0] * WIDTH)]
    best, read = index.search(spark.createDataFrame(queries, "query string, embedding array<double>"), 5, "query")
    same(answers(best), brute(rows, queries, 5))
    seen = {r["query"]: r.cells_read for r in read.collect()}
    clear = [n for q, n in seen.items() if "/" in q]
    assert np.mean(clear) <= 4 and max(seen.values()) <= 30 and len(index.cells()) <= 30


def test_recall_of_the_approximate_form(spark, built):
    index, rows = built
    queries = [r for k, r in enumerate(rows) if k % 5 == 0 and "/" in r[0]]
    asked = spark.createDataFrame(queries, "query string, embedding array<double>")
    exact = {q: {i for i, _ in found} for q, found in brute(rows, queries, 5).items()}
    best, read = index.search(asked, 5, "query", probes=2)
    got = answers(best)
    recall = sum(len(exact[q] & {i for i, _ in got[q]}) for q in exact) / sum(map(len, exact.values()))
    assert recall >= 0.9 and {r.cells_read for r in read.collect()} == {2}


def test_queries_without_a_usable_vector(spark, built):
    index, _ = built
    odd = [("none", None), ("zero", [0.0] * WIDTH), ("short", [1.0, 2.0])]
    best, read = index.search(spark.createDataFrame(odd, "query string, embedding array<double>"), 3, "query")
    assert best.count() == 0 and {r.cells_read for r in read.collect()} == {0}


def test_more_asked_than_there_is(spark, tmp_path):
    rows = clustered(3, 4)
    index = VectorIndex(spark, str(tmp_path), "uri")
    index.build(spark.createDataFrame(rows, ROW), 3)
    best, read = index.search(spark.createDataFrame(rows[:2], "query string, embedding array<double>"), 100, "query")
    same(answers(best), brute(rows, rows[:2], 100))
    assert {r.cells_read for r in read.collect()} == {len(index.cells())}


def test_a_crowded_cell_is_dealt_out(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(vector_index, "SHARE_ROWS", 64)
    rows = clustered(4, 10) + [(f"same{k:04d}", clustered(4, 10)[0][1]) for k in range(1500)]
    index = VectorIndex(spark, str(tmp_path), "uri")
    index.build(spark.createDataFrame(rows, ROW).repartition(6), 4)
    queries = rows[:40:4]
    best, _ = index.search(spark.createDataFrame(queries, "query string, embedding array<double>"), 7, "query")
    same(answers(best), brute(rows, queries, 7))


def test_an_index_of_nothing(spark, tmp_path):
    index = VectorIndex(spark, str(tmp_path), "uri")
    index.build(spark.createDataFrame([("a", None), ("b", [0.0])], ROW), 4)
    best, read = index.search(spark.createDataFrame([("q", [1.0, 2.0])], "query string, embedding array<double>"), 3, "query")
    assert best.count() == 0 and [r.cells_read for r in read.collect()] == [0]
    assert index.rows.read().count() == 2


def test_only_the_wanted_cells_are_read(spark, built):
    index, rows = built
    plan = index._best(
        spark.createDataFrame([("q", rows[0][1], 1)], "query string, vector array<double>, cell int"), WIDTH, index.cells(), 3
    )._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower() or "PartitionFilters: [isnotnull(cell" in plan


def test_eligible_embeddings_go_to_the_index(spark, tmp_path):
    names = "array<struct<name:string,value:string>>"
    meta = [{"name": n, "value": "1"} for n in ("post_id", "timestamp", "publisher_user_id")]
    schema = f"uri string, metadata {names}, {embeddings.VECTOR} array<double>, nsfw_ec string, nsfw_gore string, is_nsfw boolean"
    rows = [(i, meta, v, "", "", False) for i, v in clustered(3, 5)]
    table = spark.createDataFrame([*rows, ("bare", meta[:1], rows[0][2], "", "", False)], schema)
    index = VectorIndex(spark, str(tmp_path), "uri")
    index.build(embeddings.index_rows(table.limit(9), WIDTH), 3)
    for _ in range(2):
        embeddings.update_cell_index(index, table, WIDTH)
    assert sorted(r["uri"] for r in index.rows.read().collect()) == [i for i, *_ in rows]

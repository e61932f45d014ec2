from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelstat.operators import aggregates, filters, joins, ordering, vectors, windows
from reelstat.operators.merge import CARDINALITY_MESSAGE, merge
from tests.conftest import rows


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


# --- merge -------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def sides(spark):
    t = frame(spark, "k string, v int, note string", ("a", 1, "x"), ("b", 2, "y"), (None, 3, "z"))
    s = frame(spark, "k string, v int", ("b", 20), ("c", 30), (None, 40))
    return t, s


def test_upsert_never_matches_null_keys(sides):
    t, s = sides
    out = merge(t, s, ["k"], set="*", insert="*")
    assert out.columns == t.columns
    assert rows(out, "v") == [
        {"k": "a", "v": 1, "note": "x"},
        {"k": None, "v": 3, "note": "z"},
        {"k": "b", "v": 20, "note": "y"},
        {"k": "c", "v": 30, "note": None},
        {"k": None, "v": 40, "note": None},
    ]


def test_upsert_of_the_same_batch_twice_changes_nothing_more(sides):
    t, s = sides
    known = s.where("k IS NOT NULL")
    once = merge(t, known, ["k"], set="*", insert="*")
    assert rows(merge(once, known, ["k"], set="*", insert="*"), "v") == rows(once, "v")


def test_insert_only_keeps_source_duplicates(spark, sides):
    t, _ = sides
    s = frame(spark, "k string, v int", ("a", 9), ("c", 5), ("c", 5))
    assert [r["v"] for r in rows(merge(t, s, ["k"], insert="*"), "v")] == [1, 2, 3, 5, 5]


def test_right_hand_sides_see_the_row_before_the_merge(spark):
    t = frame(spark, "k string, a int, b int", ("x", 1, 10))
    s = frame(spark, "k string, a int", ("x", 5))
    assert rows(merge(t, s, ["k"], set={"a": "s.a", "b": "t.a + 100"})) == [{"k": "x", "a": 5, "b": 101}]


def test_two_source_rows_for_one_target_row_are_an_error(spark, sides):
    t, _ = sides
    s = frame(spark, "k string, v int", ("b", 1), ("b", 2), ("c", 1), ("c", 2))
    with pytest.raises(Exception, match=CARDINALITY_MESSAGE):
        merge(t, s, ["k"], set="*").collect()
    unmatched = s.where("k = 'c'")
    assert merge(t, unmatched, ["k"], set="*", insert="*").count() == 5


def test_update_only_and_default_fill(sides):
    t, s = sides
    assert [r["v"] for r in rows(merge(t, s, ["k"], set={"v": "s.v"}), "v")] == [1, 3, 20]
    filled = merge(t, s, ["k"], set={"v": "s.v"}, not_matched_by_source={"note": "none", "v": -1})
    assert [(r["v"], r["note"]) for r in rows(filled, "v", "k")] == [(-1, "none"), (-1, "none"), (20, "y")]


def test_singleton_merge(spark):
    schema = "n int, m int"
    t, s, none = frame(spark, schema, (1, 2)), frame(spark, schema, (10, 20)), frame(spark, schema)
    clauses = {"set": {"n": "t.n + s.n"}, "insert": "*"}
    assert rows(merge(t, s, True, **clauses)) == [{"n": 11, "m": 2}]
    assert rows(merge(none, s, True, **clauses)) == [{"n": 10, "m": 20}]
    assert rows(merge(t, none, True, **clauses)) == [{"n": 1, "m": 2}]
    with pytest.raises(Exception, match="single row"):
        merge(t, s.union(s), True, **clauses).collect()


def test_staged_merge_gives_the_same_rows(sides):
    t, s = sides
    assert rows(merge(t, s, ["k"], set="*", insert="*", stage=True), "v") == rows(merge(t, s, ["k"], set="*", insert="*"), "v")


# --- joins -------------------------------------------------------------------------------------------------------


def test_frequent_keys_are_all_found(spark):
    data = [("hot",)] * 400 + [(f"k{i}",) for i in range(600)] + [(None,)] * 300
    found = joins.frequent_keys(frame(spark, "k string", *data), "k")
    assert "hot" in found and len(found) <= 64


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("hot", [None, [], ["hot", "absent"]])
def test_skew_join_equals_the_plain_join(spark, how, hot):
    left = frame(
        spark,
        "k string, i int",
        *[("hot", i) for i in range(300)],
        *[(f"k{i}", i) for i in range(50)],
        *[(None, i) for i in range(40)],
    )
    right = frame(spark, "k string, r int", ("hot", 1), *[(f"k{i}", i) for i in range(25)], (None, 7), ("k3", 33))
    got = joins.skew_join(left, right, "k", how, hot=hot)
    assert rows(got, "k", "i", "r") == rows(left.join(right, "k", how), "k", "i", "r")


def test_skew_join_spreads_a_hot_key(spark):
    left = spark.range(20_000).select(F.lit("hot").alias("k"), "id")
    right = frame(spark, "k string, r int", ("hot", 1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = joins.skew_join(left, right, "k").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) > 4 and max(r["count"] for r in sizes) < 8_000


def test_salts_ignore_floating_point_columns(spark):
    df = frame(spark, "k string, v string, x double", ("a", "b", 1.0), ("a", "b", 2.0))
    assert len({r[0] for r in df.select(joins.row_hash(df, ["k"])).collect()}) == 1


def test_join_default_fills_misses_and_nulls(spark):
    left = frame(spark, "k string", ("a",), ("b",), ("c",))
    right = frame(spark, "k string, v double", ("a", 5.0), ("b", None))
    assert [r["v"] for r in rows(joins.join_default(left, right, "k", {"v": 1.0}), "k")] == [5.0, 1.0, 1.0]


@pytest.mark.parametrize("left", [["a", "b", None], ["a", "b"]])
@pytest.mark.parametrize("right", [["a"], ["a", None], [None], [], ["a", "a", "x"]])
def test_drop_known_is_not_in(spark, left, right):
    a, b = frame(spark, "k string", *[(x,) for x in left]), frame(spark, "k string", *[(x,) for x in right])
    a.createOrReplaceTempView("left_side"), b.createOrReplaceTempView("right_side")
    want = spark.sql("SELECT k FROM left_side WHERE k NOT IN (SELECT k FROM right_side)")
    assert rows(joins.drop_known(a, b, "k"), "k") == rows(want, "k")


def test_existence_flag_never_multiplies(spark):
    df = frame(spark, "k string", ("a",), ("b",), (None,))
    keys = frame(spark, "k string", ("a",), ("a",), (None,))
    assert [(r["k"], r["f"]) for r in rows(joins.existence_flag(df, keys, "k", "f"), "k")] == [(None, False), ("a", True), ("b", False)]


def test_with_constants_of_an_empty_table_leaves_nothing(spark):
    df, stats = frame(spark, "k int", (1,), (2,)), frame(spark, "m int", (5,))
    assert joins.with_constants(df, stats).count() == 2
    assert joins.with_constants(df, stats.where("m > 9")).count() == 0


# --- windows, ordering, aggregates -------------------------------------------------------------------------------


def test_latest_per_key_with_ties_nulls_and_nested_columns(spark):
    schema = "k string, t int, tie int, p struct<a:int, b:array<string>>"
    df = frame(
        spark, schema, ("a", 1, 1, (1, ["x"])), ("a", 2, 1, (2, ["y"])), ("a", 2, 2, (3, None)), ("b", None, 1, (4, [])), (None, 1, 1, None)
    )
    out = rows(windows.latest_per_key(df, ["k"], ["t"], ["tie"]), "k")
    assert out == [
        {"k": None, "t": 1, "tie": 1, "p": None},
        {"k": "a", "t": 2, "tie": 2, "p": {"a": 3, "b": None}},
        {"k": "b", "t": None, "tie": 1, "p": {"a": 4, "b": []}},
    ]


def test_zscore_by_group_treats_null_as_a_group(spark):
    df = frame(spark, "g string, k int, x double", ("a", 1, 1.0), ("a", 2, 3.0), (None, 3, 10.0), (None, 4, 30.0), ("b", 5, 7.0))
    out = {r["k"]: r["z_x"] for r in rows(windows.zscore(df, ["x"], "flat", ["g"]))}
    half = 0.5**0.5
    assert out == pytest.approx({1: -half, 2: half, 3: -half, 4: half, 5: 0.0})


def test_global_zscore_needs_no_single_partition_for_rows(spark):
    df = spark.range(1000).select("id", (F.col("id") % 17).cast("double").alias("x"))
    plan = windows.zscore(df, ["x"], "zero")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "BroadcastNestedLoopJoin" in plan


def test_top_k_ties(spark):
    df = frame(spark, "g string, k string, s double", ("x", "b", 1.0), ("x", "a", 1.0), ("y", "c", 0.5), ("y", "d", None))
    assert [r["k"] for r in ordering.top_k(df, "s", 3, tie=["k"]).collect()] == ["a", "b", "c"]
    assert [r["k"] for r in rows(ordering.top_k(df, "s", 1, by=["g"], tie=["k"]), "g")] == ["a", "c"]


def test_latest_n_falls_back_to_the_first_column(spark):
    df = frame(spark, "a int, event_timestamp int", (1, 5), (2, 4), (3, 3))
    assert [r["a"] for r in ordering.latest_n(df, 2).collect()] == [1, 2]
    assert [r["a"] for r in ordering.latest_n(df.drop("event_timestamp"), 2).collect()] == [3, 2]


def test_cap_takes_the_smallest_keys(spark):
    df = frame(spark, "k string", ("c",), ("a",), ("b",))
    assert [r["k"] for r in rows(ordering.cap(df, 2, "k"), "k")] == ["a", "b"]


def test_distinct_users_ignore_null_and_keep_empty_days(spark):
    day1, day2 = datetime(2024, 1, 1, 5), datetime(2024, 1, 2, 5)
    df = frame(spark, "u string, t timestamp_ntz", ("a", day1), ("a", day1), ("b", day1), (None, day2))
    assert aggregates.distinct_users(df, "u").first()[0] == 2
    assert [r["daily_users"] for r in rows(aggregates.distinct_users(df, "u", "t", by_day=True), "event_date")] == [2, 0]
    assert aggregates.distinct_users(df, "u", approx=True).first()[0] == 2


def test_rate_skips_null_flags_and_share_counts_them_as_zero(spark):
    df = frame(spark, "k string, f boolean", ("a", True), ("a", None))
    assert aggregates.rate_by(df, ["k"], "f", "r").first()["r"] == 1.0
    assert df.agg(F.avg(aggregates.flag_share("f"))).first()[0] == 0.5


def test_filters(spark):
    df = frame(spark, "k string, v string", ("x-BOT", "100"), ("x-bot", "100.5"), (None, "many"), ("BOT-", None))
    assert [r["k"] for r in rows(filters.suffix_filter(df, "k", "-BOT"))] == ["x-BOT"]
    assert [r["v"] for r in rows(filters.max_value(df, "v", 100))] == ["100"]
    assert filters.require_keys(df, "k", "v").count() == 2


# --- vectors -----------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vector_table(spark):
    rng = np.random.default_rng(7)
    data = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(300)]
    return frame(spark, "i int, embedding array<double>", *data), {i: np.array(v) for i, v in data}


def test_vector_search_is_exact(spark, vector_table):
    table, values = vector_table
    q = values[5]
    cosine = {i: float(v @ q / np.linalg.norm(v) / np.linalg.norm(q)) for i, v in values.items()}
    want = sorted(cosine, key=lambda i: -cosine[i])[:7]
    odd = frame(spark, "i int, embedding array<double>", (900, None), (901, [0.0] * 6), (902, [1.0]))
    got = vectors.vector_search(table.unionByName(odd), list(q), 7, tie=["i"]).collect()
    assert [r["i"] for r in got] == want
    assert [r["similarity"] for r in got] == pytest.approx([cosine[i] for i in want])


def test_probing_all_cells_is_exact_and_few_cells_find_most(spark, vector_table, tmp_path):
    table, values = vector_table
    cells = vectors.build_cells(table, str(tmp_path / "cells"), cells=6, max_iter=8)
    index = spark.read.parquet(cells.path)
    assert index.count() == 300
    q = [float(x) for x in values[11]]
    exact = [r["i"] for r in vectors.vector_search(table, q, 10, tie=["i"]).collect()]
    assert [r["i"] for r in vectors.probe_cells(index, cells, q, 10, probes=6, tie=["i"]).collect()] == exact
    probed = vectors.probe_cells(index, cells, q, 10, probes=3, tie=["i"])
    assert len({r["i"] for r in probed.collect()} & set(exact)) >= 5
    assert "PartitionFilters: [cell" in probed._jdf.queryExecution().executedPlan().toString().replace("isnotnull(", "")


def test_cells_of_given_centres_come_from_one_python_function(spark, vector_table, tmp_path, monkeypatch):
    _, values = vector_table
    odd = [(900, None), (901, [0.0] * 6), (902, [1.0]), (903, [float("nan")] + [1.0] * 5)]
    table = frame(spark, "i int, embedding array<double>", *[(i, [float(x) for x in v]) for i, v in values.items()], *odd)
    centers = [*(values[i] for i in range(8)), values[3]]  # the last one ties with the fourth
    plans, write = [], vectors._write_cells

    def seen(assigned, *rest):
        plans.append(assigned._jdf.queryExecution().executedPlan().toString())
        return write(assigned, *rest)

    monkeypatch.setattr(vectors, "_write_cells", seen)
    path = str(tmp_path / "given")
    made = vectors.assign_cells(table, path, [list(map(float, c)) for c in centers])
    assert plans[0].count("ArrowEvalPython") == 1  # a worker for each would be kept by every task
    unit = np.stack([c / np.linalg.norm(c) for c in centers])
    want = {i: int((unit @ v).argmax()) for i, v in values.items()} | {900: -1, 901: -1, 902: -1, 903: -1}
    want |= {3: 3}
    assert {r["i"]: r["cell"] for r in spark.read.parquet(path).collect()} == want and len(made.centers) == 9


# --- hot and missing keys ----------------------------------------------------------------------------------------


def test_joins_spread_hot_and_missing_keys(spark):
    """Half of the rows under one key, a quarter under NULL: results as without, and no task gets more than a fraction of them."""
    data = [("hot" if k % 2 else None if k % 4 else f"k{k % 97}", k) for k in range(8000)]
    df = spark.createDataFrame(data, "k string, v int").repartition(8)
    right = spark.createDataFrame([("hot", 1), ("k0", 2), ("k4", 3), ("k4", 4), ("gone", 5)], "k string, w int")
    known = {"hot", "k0", "k4", "gone"}

    def seen(out, *columns):
        return sorted((tuple(r[c] for c in columns) for r in out.collect()), key=str)

    def want(rows_):
        return sorted(rows_, key=str)

    assert seen(joins.existence_flag(df, right, "k", "f"), "k", "v", "f") == want([(k, v, k in known) for k, v in data])
    assert seen(joins.keep_known(df, right, "k"), "k", "v") == want([(k, v) for k, v in data if k in known])
    assert seen(joins.drop_known(df, right, "k"), "k", "v") == want([(k, v) for k, v in data if k is not None and k not in known])
    assert seen(joins.drop_known(df, right, "k", null_aware=False), "k", "v") == want([(k, v) for k, v in data if k not in known])
    latest = {"hot": 1, "k0": 2, "k4": 4}
    assert seen(joins.attach_latest(df, right, "k", ["w"], ["w"]), "k", "v", "w") == want([(k, v, latest.get(k)) for k, v in data])

    hot = joins.frequent_keys(df, "k")
    assert "hot" in hot and len(hot) <= 64
    for how in ("left", "left_semi", "left_anti", "inner"):
        plain = right.dropDuplicates(["k"])
        spread = joins.skew_join(df, plain.hint("shuffle_hash"), "k", how, hot)
        assert seen(spread, *spread.columns) == seen(df.join(plain, "k", how), *spread.columns)
    with pytest.raises(ValueError, match="skew_join supports"):
        joins.skew_join(df, right, "k", "outer")


def test_salts_spread_the_rows_of_a_hot_key_evenly(spark):
    df = spark.createDataFrame([("hot" if k % 2 else None, k) for k in range(8000)], "k string, v int")
    salted = df.withColumn("s", joins._spread(df, ["k"], joins.SALTS))
    held = [r["count"] for r in salted.groupBy("k", "s").count().collect()]
    assert len(held) == 2 * joins.SALTS and max(held) < 3 * 8000 / len(held)


def test_sketched_users_over_days(spark):
    rows_ = [(u, datetime(2024, 1, 1) + timedelta(days=d, hours=u % 24)) for d in range(40) for u in range(d * 50, d * 50 + 400)]
    events = spark.createDataFrame(rows_, "user long, ts timestamp_ntz")
    kept = aggregates.daily_sketches(events, "user", "ts")
    for days in (1, 7, 28):
        exact = {}
        for u, t in rows_:
            for n in range(days):
                exact.setdefault((t + timedelta(days=n)).date(), set()).add(u)
        got = {r["event_date"]: r["users"] for r in aggregates.users_over_days(kept, days).collect()}
        assert set(got) == {t.date() for _, t in rows_}
        assert all(abs(n - len(exact[d])) <= 4 * 1.04 / 64 * len(exact[d]) for d, n in got.items())

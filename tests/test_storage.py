from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from reelstat.functions.timex import lookback
from reelstat.operators.filters import read_events
from reelstat.operators.merge import MergeCardinalityError, merge, merge_into
from reelstat.plans import chain, graph
from reelstat.session import materialise, shared_dir
from reelstat.sources import serving, tables
from reelstat.sources.snapshots import CommitConflict, SnapshotTable
from reelstat.streaming import states, upserts
from tests.conftest import at, rows


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


def test_written_stages_lie_in_the_shared_folder(spark):
    folder = shared_dir(spark)
    assert folder == shared_dir(spark)
    assert folder == (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()).rstrip("/")
    stage = materialise(spark.range(3), "stage")
    assert stage.count() == 3 and all(folder.removeprefix("file:") in f for f in stage.inputFiles())


# --- snapshots ---------------------------------------------------------------------------------------------------


def test_snapshot_versions_and_reading_while_replacing(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    assert not table.exists() and table.commit_info() == {}
    with pytest.raises(FileNotFoundError):
        table.read()
    table.replace(spark.range(3))
    table.replace(table.read().withColumn("id", F.col("id") + 10), stream=("s", 4))
    assert [r["id"] for r in rows(table.read(), "id")] == [10, 11, 12]
    assert [r["id"] for r in rows(table.read(0), "id")] == [0, 1, 2]
    assert table.commit_info()["streams"] == {"s": 4}
    table.replace(spark.range(1))
    assert table.commit_info()["streams"] == {"s": 4}  # a batch run in between does not forget the stream
    before = table.read(1)
    table.vacuum(keep=1)
    assert before.count() == 3  # superseded a moment ago: a reader may still need it
    table.vacuum(keep=1, older_than=0)
    assert table.versions() == [2] and table.read().count() == 1 and len([p for p in (tmp_path / "t").iterdir() if "=" in p.name]) == 1


def test_snapshot_with_date_partitions(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), partition_ts="t", cluster=["k"])
    df = frame(spark, "k string, t timestamp_ntz", ("b", at("01 10:00")), ("a", at("01 11:00")), ("c", at("02 10:00")), ("d", None))
    table.replace(df)
    assert rows(table.read(), "k") == rows(df, "k")
    names = {p.name for p in (tmp_path / "t").glob("_w=*/*") if p.name.startswith("dt=")}
    assert names == {"dt=2024-01-01", "dt=2024-01-02", "dt=__HIVE_DEFAULT_PARTITION__"}


def test_failed_write_leaves_the_current_version(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.replace(frame(spark, "k string, v int", ("a", 1)))
    twice = frame(spark, "k string, v int", ("a", 2), ("a", 3))
    with pytest.raises(MergeCardinalityError):
        table.replace(merge(table.read(), twice, ["k"], set="*"))
    assert rows(table.read()) == [{"k": "a", "v": 1}]


def test_create_or_merge_dispatch_and_replayed_batches(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))

    def run(n, batch_id=None):
        return table.create_or_merge(lambda: spark.range(n), lambda current: current.union(spark.range(n)), None if batch_id is None else ("s", batch_id))

    assert [run(0), run(2, 0), run(3, 1), run(3, 1), run(3, 0)] == ["created", "created", "merged", "skipped", "skipped"]
    assert table.read().count() == 5


def test_catalog_create_or_merge(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS made LOCATION '{tmp_path}/made'")
    try:
        def run():
            return tables.create_or_merge(spark, "made.t", lambda: spark.range(2), lambda t: t.union(spark.range(3)))

        assert [run(), run()] == ["created", "merged"] and spark.table("made.t").count() == 5
    finally:
        spark.sql("DROP DATABASE made CASCADE")


def test_core_chain_runs_twice(spark, raw, tmp_path):
    def act(u, v, **more):
        return {"user_id": u, "video_id": v, "publisher_user_id": v, **more}

    first = [
        ("video_duration_watched", act("u", "a", percentage_watched=50), "01 10:00"),
        ("video_duration_watched", act("v", "b", percentage_watched=70), "01 11:00"),
        ("video_duration_watched", act("u", "b", percentage_watched=10), "01 12:00"),
        ("like_video", act("u", "a"), "01 10:30"),
        ("mp_user_followed", act("u", "a"), "01 10:30"),
        ("mp_video_reported", act("u", "a"), "01 10:30"),
        ("video_upload_successful", act("u", "c", country="X-BOT"), "01 10:30"),
    ]
    second = [("video_duration_watched", act("w", "a", percentage_watched=90), "02 10:00"), ("video_report_banned", act("u", "b"), "02 09:59")]
    scores = frame(spark, "video_id string, probability double, nsfw_ec string", ("a", 0.9, "x"))
    built = chain.Chain(spark, str(tmp_path))
    done = built.run(chain.Inputs(raw(*first), scores), at("02 10:00"))
    assert set(done.values()) == {"created", "replaced"}
    assert built.sync(chain.Inputs(raw(*first), scores), at("02 10:00"))["excluded_videos"] == 1
    later = chain.Inputs(raw(*first, *second), scores)
    done = built.run(later, at("02 10:05"))
    assert set(done.values()) == {"merged", "replaced"}
    counts = {name: built.read(name).count() for name in done}
    assert counts == {
        "user_video_relation": 4, "user_video_metrics": 3, "video_statistics": 2, "global_video_stats": 1,
        "video_statistics_normalized": 2, "follower_graph": 1, "bot_uploaded_content": 1, "video_reports": 1, "excluded_videos": 2,
        "daily_event_counts": 5, "global_popular_videos_l90d": 2,
    }
    sent = built.sync(later, at("02 10:05"))
    assert sent["excluded_videos"] == 2 and sent["video_nsfw_agg"] == 1 and "ai_ugc" not in sent
    assert built.view("excluded_videos").count() == 2 and built.view("user_video_relation").count() == 4
    plan = built._rankings(later, at("02 10:05"))["global_popular_videos_l90d"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


# --- tables ------------------------------------------------------------------------------------------------------


def test_shards_of_different_columns(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "users_1"))
    spark.range(2, 3).withColumn("extra", F.lit("x")).write.parquet(str(tmp_path / "users_2"))
    out = tables.read_shards(spark, f"{tmp_path}/users_*")
    assert [(r["id"], r["extra"]) for r in rows(out, "id")] == [(0, None), (1, None), (2, "x")]


def test_event_scan_is_pushed_to_the_files(spark, tmp_path):
    path = str(tmp_path / "events")
    frame(spark, "event string, params string, timestamp timestamp_ntz", ("a", "{}", at("01 10:00"))).write.parquet(path)
    scan = read_events(spark.read.parquet(path), ("a", "b"), since=at("01 00:00"))
    scan = lookback(scan, "timestamp", at("02 00:00"), timedelta(days=1)).select("event")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "In(event" in pushed and "GreaterThanOrEqual(timestamp" in pushed
    assert "params" not in pushed[pushed.index("ReadSchema") :].splitlines()[0]


# --- serving -----------------------------------------------------------------------------------------------------

ROW = "k string, v int, t timestamp_ntz"


def test_incremental_sync(spark, tmp_path):
    copy = SnapshotTable(spark, str(tmp_path / "serving"))
    old = frame(spark, ROW, ("a", 1, at("01 10:00")), ("b", 1, at("02 10:00")))
    assert serving.append_batch(old, copy, datetime(2024, 1, 3), "t") == 2
    source = frame(spark, ROW, ("a", 2, at("01 10:00")), ("b", 2, at("02 09:30")), ("c", 2, at("05 10:00")))
    sent = serving.sync_incremental(source, copy, "t", timedelta(hours=1), datetime(2024, 1, 6))
    assert sent == 2  # b lies within the overlap, a does not
    view = serving.current_view(copy.read(), ["k"])
    assert [(r["k"], r["v"]) for r in rows(view, "k")] == [("a", 1), ("b", 2), ("c", 2)]
    again = serving.sync_incremental(source, copy, "t", timedelta(hours=1), datetime(2024, 1, 7))
    plain = lambda df: rows(df.drop("_updated_at"), "k")
    assert again == 1 and plain(serving.current_view(copy.read(), ["k"])) == plain(view)
    assert serving.append_batch(old.limit(1), copy, datetime(2024, 1, 7), "t") == 1  # the same version time again
    kept = rows(serving.current_view(copy.read(), ["k"], tie=["v"]), "k")
    serving.compact(copy, ["k"], tie=["v"])
    assert rows(copy.read(), "k") == kept and serving.require_bootstrap(copy) == at("05 10:00")


def test_equal_versions_are_decided_by_the_tie(spark):
    both = frame(spark, "k string, why string, _updated_at timestamp", ("a", "banned", at("02 00:00")), ("a", "reported", at("02 00:00")))
    assert [r["why"] for r in serving.current_view(both, ["k"], tie=["why"]).collect()] == ["reported"]
    assert serving.current_view(both, ["k", "why"]).count() == 2


def test_sync_of_nothing_returns_zero(spark, tmp_path):
    copy = SnapshotTable(spark, str(tmp_path / "serving"))
    serving.append_batch(frame(spark, ROW, ("a", 1, at("01 10:00"))), copy, datetime(2024, 1, 3), "t")
    assert serving.sync_incremental(frame(spark, ROW), copy, "t", timedelta(0), datetime(2024, 1, 4)) == 0


def test_sync_needs_a_bootstrap(spark, tmp_path):
    missing, empty, nulls = (SnapshotTable(spark, str(tmp_path / n)) for n in ("missing", "empty", "nulls"))
    serving.append_batch(frame(spark, ROW), empty, ts="t")
    serving.append_batch(frame(spark, ROW, ("a", 1, None)), nulls, ts="t")
    source = frame(spark, ROW, ("a", 1, at("01 10:00")))
    for copy in (missing, empty, nulls):
        with pytest.raises(serving.BootstrapMissing):
            serving.sync_incremental(source, copy, "t", timedelta(0), on_error="raise")
        assert serving.sync_incremental(source, copy, "t", timedelta(0)) is None


def test_full_sync_replaces_even_with_nothing(spark, tmp_path):
    target = SnapshotTable(spark, str(tmp_path / "bridge"))
    assert serving.sync_full(frame(spark, ROW, ("a", 1, None), ("b", 1, None)), target, at("01 00:00")) == 2
    assert serving.sync_full(frame(spark, ROW), target, at("02 00:00")) == 0
    assert target.read().count() == 0 and "_updated_at" in target.read().columns


# --- streams -----------------------------------------------------------------------------------------------------

EVENT = "k string, t timestamp_ntz, v int"


def feed(spark, folder, *files):
    for data in files:
        frame(spark, EVENT, *data).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(folder)


def test_streamed_counts_equal_the_batch_over_several_batches(spark, tmp_path):
    folder, table = str(tmp_path / "in"), SnapshotTable(spark, str(tmp_path / "t"))

    def run():
        counted = states.daily_counts(stream(spark, folder), "t", "k", "2 days")
        states.upsert_changes(counted, table, str(tmp_path / "cp"), ["event_date", "event_name"]).awaitTermination()
        return {(r["event_date"].day, r["event_name"]): r["event_count"] for r in table.read().collect()}

    feed(spark, folder, [("a", at("01 10:00"), 1), ("b", at("01 11:00"), 1)], [("a", at("01 12:00"), 1), ("a", at("02 10:00"), 1)])
    assert run() == {(1, "a"): 2, (1, "b"): 1, (2, "a"): 1}
    feed(spark, folder, [("a", at("01 23:00"), 1), ("c", at("03 10:00"), 1)])  # a late row within the lateness
    assert run() == {(1, "a"): 3, (1, "b"): 1, (2, "a"): 1, (3, "c"): 1}


def test_streamed_latest_state(spark, tmp_path):
    folder, table = str(tmp_path / "in"), SnapshotTable(spark, str(tmp_path / "t"))
    feed(spark, folder, [("a", at("01 10:00"), 1), ("b", at("01 11:00"), 1)], [("a", at("01 09:00"), 2)], [("b", at("02 10:00"), 3)])
    states.latest_state(stream(spark, folder), table, str(tmp_path / "cp"), ["k"], "t").awaitTermination()
    assert [(r["k"], r["v"]) for r in rows(table.read(), "k")] == [("a", 1), ("b", 3)]


def test_latest_state_is_kept_by_the_table_alone(spark, tmp_path):
    """Many micro-batches: no state in the stream, older late rows change nothing, ties go to the larger column, and a merge writes few files."""
    folder, table = str(tmp_path / "in"), SnapshotTable(spark, str(tmp_path / "t"), keys=("k",), buckets=32)
    feed(spark, folder, [(f"k{n}", at("02 10:00"), n) for n in range(200)])

    def run():
        query = states.latest_state(stream(spark, folder), table, str(tmp_path / "cp"), ["k"], "t", ["v"])
        query.awaitTermination()
        assert all(not p.stateOperators for p in query.recentProgress)
        return {r["k"]: r["v"] for r in table.read().collect()}

    assert run() == {f"k{n}": n for n in range(200)}
    before = files(tmp_path / "t")
    for late in ([("k1", at("01 10:00"), -1)], [("k2", at("02 10:00"), 1)], [("k3", at("02 10:00"), 9)], [("k4", at("03 10:00"), -4), ("k4", at("03 09:00"), -5)]):
        feed(spark, folder, late)
    expected = {f"k{n}": n for n in range(200)} | {"k3": 9, "k4": -4}
    assert run() == expected and not (tmp_path / "cp" / "state").exists()
    assert len(files(tmp_path / "t") - before) <= 4


def test_streamed_changes_take_the_watermark_from_the_marker(spark, raw, tmp_path, monkeypatch):
    def follow(event, a, t):
        return (event, {"user_id": a, "publisher_user_id": "p"}, t)

    folder = str(tmp_path / "in")
    table = SnapshotTable(spark, str(tmp_path / "t"), partition_ts="last_updated_timestamp")
    batches = [
        raw(follow(graph.FOLLOWED, "a", "01 10:00"), follow(graph.FOLLOWED, "b", "02 10:00")),
        raw(follow(graph.UNFOLLOWED, "a", "03 10:00"), follow(graph.UNFOLLOWED, "b", "01 09:00")),
    ]
    monkeypatch.setattr("reelstat.sources.snapshots.high_watermark", None)  # no scan of the table for its maximum
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(folder)
        source = spark.readStream.schema(batch.schema).parquet(folder)
        upserts.changes(source, table, str(tmp_path / "cp"), graph.follower_graph, graph.follower_graph_change).awaitTermination()
    assert [(r["follower_id"], r["active"]) for r in rows(table.read(), "follower_id")] == [("a", False), ("b", True)]


def test_lookback_upsert_takes_late_rows_within_the_window_only(spark, tmp_path):
    folder, table = str(tmp_path / "in"), SnapshotTable(spark, str(tmp_path / "t"))

    def run():
        upserts.lookback_upsert(
            stream(spark, folder), table, str(tmp_path / "cp"), ["k"], "t", timedelta(hours=1)
        ).awaitTermination()
        return [(r["k"], r["v"]) for r in rows(table.read(), "k")]

    feed(spark, folder, [("a", at("01 10:00"), 1), ("b", at("01 10:10"), 1), ("old", at("01 08:00"), 1)])
    assert run() == [("a", 1), ("b", 1)]
    feed(spark, folder, [("b", at("01 09:30"), 2), ("c", at("01 08:30"), 2)])
    assert run() == [("a", 1), ("b", 2)]  # last write wins for b, c is too late


def test_streamed_increments_equal_the_batch(spark, raw, tmp_path):
    def follow(event, a, b, t):
        return (event, {"user_id": a, "publisher_user_id": b}, t)

    folder, table = str(tmp_path / "in"), SnapshotTable(spark, str(tmp_path / "t"))
    batches = [
        raw(follow(graph.FOLLOWED, "a", "b", "01 10:00"), follow(graph.FOLLOWED, "b", "c", "01 11:00")),
        raw(follow(graph.UNFOLLOWED, "a", "b", "02 10:00")),
        raw(follow(graph.FOLLOWED, "c", "a", "03 10:00")),
    ]
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(folder)
        source = spark.readStream.schema(batch.schema).parquet(folder)
        upserts.incremental(
            source, table, str(tmp_path / "cp"), graph.follower_graph, graph.follower_graph_increment
        ).awaitTermination()
    whole = graph.follower_graph(batches[0].union(batches[1]).union(batches[2]))
    assert rows(table.read(), "follower_id") == rows(whole, "follower_id")


# --- commits -----------------------------------------------------------------------------------------------------


def files(path):
    return {str(p) for p in path.rglob("part-*.parquet")}


def test_a_losing_writer_harms_nothing(spark, tmp_path):
    first, second = (SnapshotTable(spark, str(tmp_path / "t")) for _ in range(2))
    first.replace(spark.range(2))
    late = second._next()  # both writers see version 0
    first.append(spark.range(5))
    second._next = lambda: late
    with pytest.raises(CommitConflict):
        second.replace(spark.range(100))
    assert first.read().count() == 7


def test_merges_write_only_what_they_touch(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), partition_ts="t", cluster=["k"])
    row = "k string, t timestamp_ntz, v int"
    table.replace(frame(spark, row, ("a", at("01 10:00"), 1), ("b", at("01 11:00"), 1), ("c", at("02 10:00"), 1), ("d", at("03 10:00"), 1), ("n", None, 1)))
    before = files(tmp_path)
    source = frame(spark, row, ("a", at("02 12:00"), 2), ("e", at("03 12:00"), 2), ("n", None, 2))
    table.merge(source, ["k"], set="*", insert="*")
    found = {r["k"]: (r["t"], r["v"]) for r in table.read().collect()}
    assert {k: v for k, (_, v) in found.items()} == {"a": 2, "b": 1, "c": 1, "d": 1, "e": 2, "n": 2}
    assert found["a"][0] == at("02 12:00") and table.read().count() == 6
    current = {f"/{f.removeprefix('file:').lstrip('/')}" for f in table.read().inputFiles()}
    untouched = {f for f in before if "dt=2024-01-02" in f or "dt=2024-01-03" in f}
    assert untouched <= current and not {f for f in before - untouched} & current
    pruned = lookback(table.read(dates=True), "t", at("03 20:00"), timedelta(hours=12))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "dt#" in plan[plan.index("PartitionFilters") :].split("]")[0] and {r["k"] for r in pruned.collect()} == {"d", "e"}


def test_insert_only_merges_append(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.replace(frame(spark, "k string, v int", ("a", 1), ("b", 1)))
    before = files(tmp_path)
    table.merge(frame(spark, "k string, v int", ("b", 2), ("c", 2)), ["k"], insert="*")
    assert [(r["k"], r["v"]) for r in rows(table.read(), "k")] == [("a", 1), ("b", 1), ("c", 2)] and before <= files(tmp_path)


def test_merge_clauses_of_a_catalog_table():
    class Recorder:
        def __init__(self):
            self.calls = []

        def __getattr__(self, name):
            return lambda *a: self.calls.append((name, *a)) or self

    source = Recorder()
    merge_into(source, "cat.db.t", ["k"], set="*", insert="*")
    names = [c[0] for c in source.calls]
    assert names == ["alias", "mergeInto", "whenMatched", "updateAll", "whenNotMatched", "insertAll", "merge"]
    assert source.calls[1][1] == "cat.db.t t"
    other = Recorder()
    merge_into(other, "t", ["k", "d"], set={"v": "t.v + s.v"}, not_matched_by_source={"v": 0})
    assert [c[0] for c in other.calls] == ["alias", "mergeInto", "whenMatched", "update", "whenNotMatchedBySource", "update", "merge"]
    assert set(other.calls[3][1]) == set(other.calls[5][1]) == {"v"}


def test_fresh_and_second_streams_lose_nothing(spark, tmp_path):
    folder, table = str(tmp_path / "in"), SnapshotTable(spark, str(tmp_path / "t"))

    def run(checkpoint, source=folder):
        newest = stream(spark, source).select("k", "t", "v")
        upserts.lookback_upsert(newest, table, str(tmp_path / checkpoint), ["k"], "t", timedelta(days=9)).awaitTermination()
        return {r["k"]: r["v"] for r in table.read().collect()}

    feed(spark, folder, [("a", at("01 10:00"), 1)], [("b", at("01 11:00"), 1)])
    assert run("cp1") == {"a": 1, "b": 1}
    table.replace(table.read().where("k <> 'b'"))  # a batch run between two micro-batches
    feed(spark, folder, [("c", at("01 12:00"), 1)])
    assert run("cp1") == {"a": 1, "c": 1}  # batches taken before are not taken again
    other = str(tmp_path / "other")
    feed(spark, other, [("d", at("01 13:00"), 1)])
    assert run("cp2", other) == {"a": 1, "c": 1, "d": 1}  # its batch 0 is another stream's
    assert run("cp3") == {"a": 1, "b": 1, "c": 1, "d": 1}  # a fresh checkpoint reads everything again


def test_a_cluster_has_to_name_its_shared_folder(monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": lambda self, key, default: default})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())

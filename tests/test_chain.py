"""The chain of tables over several runs: what is written, what is read, what is parsed."""

import json
import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from reelstat.operators.merge import merge
from reelstat.plans import chain, graph, ingest, metrics, moderation, relation, uploads
from reelstat.sources.snapshots import CommitConflict, SnapshotTable
from tests.conftest import at, rows

RAW = "event string, params string, timestamp timestamp_ntz"
DOCUMENTS = "data string, publish_time timestamp_ntz"


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


def files(path):
    return {str(p) for p in path.rglob("part-*.parquet")}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files_read(df):
    """Files of the scans of a plan without exchange, after it ran."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    leaves = execution.executedPlan().collectLeaves()
    found = [leaves.apply(i).metrics() for i in range(leaves.size())]
    return sum(m.apply("numFiles").value() for m in found if m.contains("numFiles"))


# --- the second run ----------------------------------------------------------------------------------------------


def day(n, minute=0):
    return datetime(2024, 1, 1) + timedelta(days=n, hours=10, minutes=minute)


def event(name, moment, **params):
    return (name, json.dumps(params), moment)


def document(video, moment):
    data = {"event": uploads.UPLOAD_SUCCESS, "video_id": video, "upload_type": "camera", "region": "r", "type_ext": uploads.AI_VIDEO}
    return (json.dumps({"event_data": data, "timestamp": f"{moment.isoformat()}+00:00"}), moment)


def happenings():
    rng = random.Random(4)
    events, documents, shards = [], [], []
    for k in range(3000):
        user, video, moment = f"u{rng.randrange(300)}", f"v{rng.randrange(300)}", day(k % 30, k % 600)
        pair = {"user_id": user, "video_id": video, "publisher_user_id": video}
        events.append(event(relation.WATCH, moment, percentage_watched=rng.randrange(101), **pair))
        if k % 7 == 3:
            events.append(event(relation.LIKE, moment, **pair))
            events.append(event(graph.FOLLOWED, moment, **pair))
            events.append(event(moderation.REPORTED, moment, **pair))
        if k % 7 == 0:
            events.append(event(uploads.UPLOAD_DONE, moment, video_id=f"up{k}", country="X-BOT", user_id=user))
            documents.append(document(f"up{k}", moment))
    for k in range(300):
        shards.append((f"u{k}", 20240101 + k % 20, (f"r{k % 3}",)))
    return events, documents, shards


@pytest.fixture(scope="module")
def two_runs(spark, tmp_path_factory):
    """A chain after a run over a month and one over 1 % more; the files before and after, and what was done."""
    root = tmp_path_factory.mktemp("chain")
    events, documents, shards = happenings()
    scores = frame(spark, "video_id string, probability double, nsfw_ec string", *[(f"v{k}", 0.9, "x") for k in range(300)])
    received = SnapshotTable(spark, str(root / "received"), partition_ts="publish_time")
    received.replace(frame(spark, DOCUMENTS, *documents))
    built = chain.Chain(spark, str(root / "tables"))

    def inputs(more=()):
        people = frame(spark, "user_id string, last_updated_date long, geo struct<region:string>", *shards, *([("u5", 20240131, ("r",))] if more else []))
        return chain.Inputs(frame(spark, RAW, *events, *more), scores, received.read(dates=True), people)

    first = built.run(inputs(), day(30))
    before = {name: files(root / "tables" / name) for name in first}
    moment = day(30, 5)
    pair = {"user_id": "u1", "video_id": "v1", "publisher_user_id": "v1"}
    known = next(json.loads(p) for e, p, t in events if e == relation.WATCH and t == day(12, 12))
    more = [
        event(relation.WATCH, moment, percentage_watched=50, **pair),
        event(relation.WATCH, moment, **known),
        event(graph.FOLLOWED, moment, **{**pair, "publisher_user_id": "new"}),
        event(moderation.REPORTED, moment, **pair),
        event(uploads.UPLOAD_DONE, moment, video_id="up9999", country="X-BOT", user_id="u1"),
        event(relation.WATCH, day(29, 590), percentage_watched=10, user_id="late", video_id="late"),
    ]
    received.append(frame(spark, DOCUMENTS, document("up9999", moment)))
    second = built.run(inputs(more), day(30, 10))
    return built, root / "tables", first, second, before, (events, more, received, documents)


def test_a_second_run_writes_only_what_it_touches(two_runs):
    built, root, first, second, before, _ = two_runs
    merged = {name for name, what in second.items() if what == "merged"}
    assert merged >= {"user_video_relation", "user_video_metrics", "video_statistics", "video_statistics_normalized", "follower_graph"}
    assert merged >= {"video_reports", "excluded_videos", "bot_uploaded_content", "daily_event_counts", "video_upload_stats", "ai_ugc", "user_base_facts"}
    for name in merged - {"global_video_stats"}:  # that one has a single row
        written = files(root / name) - before[name]
        assert 0 < len(written) < 0.1 * len(before[name]), (name, len(written), len(before[name]))


def test_the_second_run_equals_increments_over_the_whole_tables(spark, two_runs):
    built, _, _, _, _, (events, more, _, documents) = two_runs
    old, late = relation.user_video_relation(frame(spark, RAW, *events)), frame(spark, RAW, *events, *more)
    whole = relation.user_video_relation_increment(old, late)
    assert rows(built.read("user_video_relation"), "user_id", "video_id") == rows(whole, "user_id", "video_id")
    follows = graph.follower_graph_increment(graph.follower_graph(frame(spark, RAW, *events)), late)
    assert rows(built.read("follower_graph"), *graph.KEYS) == rows(follows, *graph.KEYS)
    ups = {r["video_id"] for r in built.read("video_upload_stats").collect()}
    assert "up9999" in ups and built.read("video_upload_stats").count() == len(ups) == len(documents) + 1
    assert built.read("bot_uploaded_content").count() == len(documents) + 1 and built.read("ai_ugc").where("video_id = 'up9999'").count() == 1


def test_late_events_are_ingested_once(two_runs):
    built, _, _, _, _, (events, more, *_) = two_runs
    assert built.read("events").count() == len(events) + len(more)
    assert built.read("events").where("fields.user_id = 'late'").count() == 1


def test_watermarks_come_from_the_markers(two_runs, monkeypatch):
    built, *_ = two_runs
    expected = {n: built.read(n).agg(F.max(t)).first()[0] for n, t in (("user_video_relation", "last_watched_timestamp"), ("video_statistics", "last_update_timestamp"))}
    monkeypatch.setattr("reelstat.sources.snapshots.high_watermark", None)
    for name, newest in expected.items():
        assert built.table(name).newest() == newest


def test_only_new_documents_are_read(two_runs):
    built, _, _, _, _, (_, _, received, documents) = two_runs
    at_ = datetime.fromisoformat(built.table("video_upload_stats").commit_info()["position"])
    assert at_ == day(30, 5)
    from reelstat.functions.timex import lookback

    recent = uploads.video_upload_stats(lookback(received.read(dates=True), chain.RECEIVED, at_, timedelta(0)))
    everything = uploads.video_upload_stats(received.read(dates=True))
    assert files_read(recent) == 1 and files_read(everything) >= 30


def test_retracting_runs_equal_a_rebuild(spark, tmp_path):
    """Three runs that watch pairs again: users and videos are as if built from the relation, which the published form double counts."""
    rng = random.Random(6)
    batches = [
        [
            event(n, day(d, k), user_id=f"u{rng.randrange(9)}", video_id=f"v{rng.randrange(7)}", publisher_user_id="p", percentage_watched=rng.randrange(101))
            for k in range(60)
            for n in (relation.WATCH, *([relation.LIKE] if rng.random() < 0.3 else []), *([relation.SHARE] if rng.random() < 0.2 else []))
        ]
        for d in range(3)
    ]
    scores = frame(spark, "video_id string, probability double, nsfw_ec string", ("v1", 0.9, "x"))
    chains = [chain.Chain(spark, str(tmp_path / str(r)), buckets=4, retract=r) for r in (True, False)]
    for n in range(1, 4):
        happened = [e for b in batches[:n] for e in b]
        for built in chains:
            built.run(chain.Inputs(frame(spark, RAW, *happened), scores), day(n))

    def plain(df, *order):
        return rows(df.select(*[F.round(c, 9).alias(c) if t == "double" else c for c, t in df.dtypes]), *order)

    built, published = chains
    pairs = built.read("user_video_relation")
    users = metrics.user_video_metrics(pairs)
    videos = metrics.video_statistics(pairs, users)
    assert plain(built.read("user_video_metrics"), "user_id") == plain(users, "user_id")
    assert plain(built.read("video_statistics"), "video_id") == plain(videos, "video_id")
    total = metrics.global_video_stats(videos)
    assert plain(built.read("video_statistics_normalized"), "video_id") == plain(metrics.video_statistics_normalized(videos, total), "video_id")
    twice = published.read("user_video_metrics").agg(F.sum("total_watches")).first()[0]
    assert pairs.count() == built.read("user_video_metrics").agg(F.sum("total_watches")).first()[0] < twice


def test_objects_are_embedded_once_and_indexed(spark, tmp_path):
    names = "array<struct<name:string,value:string>>"
    whole = [{"name": n, "value": "1"} for n in ("post_id", "timestamp", "publisher_user_id")]
    calls = tmp_path / "calls"
    calls.mkdir()

    def model(batches):
        for batch in batches:
            for uri in batch["uri"]:
                (calls / uri).touch(exist_ok=False)  # a second call for an object fails
            yield batch["uri"].map(lambda uri: [float(len(uri)), 1.0])

    def inputs(n):
        listed = frame(spark, f"uri string, metadata {names}", *[(f"o{k}", whole if k % 3 else whole[:1]) for k in range(n)])
        nsfw = frame(spark, "gcs_video_id string, is_nsfw boolean, nsfw_ec string, nsfw_gore string", *[(f"o{k}", False, "a", "b") for k in range(0, n, 2)])
        scores = frame(spark, "video_id string, probability double, nsfw_ec string", ("v1", 0.9, "x"))
        events = frame(spark, RAW, event(relation.WATCH, day(0), user_id="u", video_id="v", percentage_watched=5))
        return chain.Inputs(events, scores, objects=chain.Objects(listed, nsfw, model, dim=2))

    built = chain.Chain(spark, str(tmp_path / "tables"), buckets=4)
    assert built.run(inputs(10), day(1))["video_index"] == "created"
    done = built.run(inputs(16), day(2))
    assert done["video_embeddings"] == done["video_index"] == "merged"
    assert {r["uri"] for r in built.read("video_embeddings").collect()} == {f"o{k}" for k in range(0, 16, 2)} == {p.name for p in calls.iterdir()}
    assert sorted(r["uri"] for r in built.read("video_index").collect()) == sorted(f"o{k}" for k in range(0, 16, 2) if k % 3)


# --- typed events ------------------------------------------------------------------------------------------------

ODD = [
    '{"user_id": "u", "video_id": "v", "percentage_watched": 1.50}',
    '{"user_id": 12, "video_id": null, "percentage_watched": "70"}',
    '{"user_id": "{\\"a\\": 1}", "video_id": "[x", "percentage_watched": 1e1}',
    '{"user_id": {"a": 1}, "video_id": ["v"], "percentage_watched": 5}',
    '{"user_id": "w", "video_id": "v", "percentage_watched": 20, "deep": {"x": [1]}, "more": "text", "flag": true}',
    "not json",
    "",
    None,
]


def odd_events(spark):
    moment = datetime(2024, 1, 3)
    names = (relation.WATCH, relation.LIKE, graph.FOLLOWED, moderation.REPORTED, uploads.UPLOAD_DONE)
    return frame(spark, RAW, *[(n, p, moment + timedelta(minutes=k)) for k, p in enumerate(ODD) for n in names], (None, ODD[0], moment))


def test_plans_over_typed_events_equal_those_over_raw_ones(spark, tmp_path):
    events, table = odd_events(spark), SnapshotTable(spark, str(tmp_path / "events"), partition_ts="timestamp")
    table.replace(ingest.typed_events(events))
    typed = table.read(dates=True)
    for plan in (relation.user_video_relation, graph.follower_graph, moderation.video_reports, uploads.bot_uploaded_content):
        assert sorted(map(str, plan(typed).collect())) == sorted(map(str, plan(events).collect())), plan
        text = plan_of(plan(typed))
        assert "from_json" not in text.lower() and "jsontostructs" not in text.lower() and "parse_json" not in text.lower()
    schema = plan_of(relation.user_video_relation(typed)).split("ReadSchema")[1].splitlines()[0]
    assert "percentage_watched" in schema and "country" not in schema and "params" not in schema


def test_each_document_is_read_once_by_the_ingest(spark):
    text = plan_of(ingest.typed_events(odd_events(spark))).lower()
    assert text.count("from_json(") == 1


def test_other_fields_come_from_the_variant(spark):
    fields = {"more": "$.more", "x": "$.deep.x", "flag": "$.flag"}
    typed = rows(ingest.event_fields(ingest.typed_events(odd_events(spark)), fields, "event", "timestamp"), "timestamp", "event")
    assert typed == rows(ingest.event_fields(odd_events(spark), fields, "event", "timestamp"), "timestamp", "event")


def test_new_events_count_repeated_ones(spark):
    one, two = ("a", '{"user_id": "u"}', at("02 10:00")), ("a", '{"user_id": "u"}', at("02 10:30"))
    old = ("a", "{}", at("01 00:00"))
    typed = ingest.typed_events(frame(spark, RAW, old, one, one, two))
    seen = frame(spark, RAW, old, old, one, one, one, two, ("b", None, at("02 10:00")), ("a", "{}", at("03 00:00")))
    got = rows(ingest.new_events(typed, seen, at("02 10:30")), "timestamp", "event")
    assert [(r["event"], r["params"], r["timestamp"]) for r in got] == [one, ("b", None, at("02 10:00")), ("a", "{}", at("03 00:00"))]


# --- tables laid out by key --------------------------------------------------------------------------------------

ROW = "k string, j long, v int, t timestamp_ntz"


def test_merges_into_buckets_equal_merges_into_the_whole(spark, tmp_path):
    data = [(f"k{n}", n % 7, n, at("01 10:00")) for n in range(500)] + [(None, 1, 1, None), (None, 1, 2, None)]
    batch = frame(spark, ROW, ("k1", 1, -1, at("02 10:00")), ("k2", 99, -2, at("02 11:00")), (None, 1, -3, at("02 12:00")), ("new", 0, -4, None))
    for clauses in ({"set": "*", "insert": "*"}, {"set": {"v": "t.v + s.v"}}, {"insert": "*"}, {"set": {"v": "s.v"}, "insert": "*", "not_matched_by_source": {"v": 0}}):
        table = SnapshotTable(spark, str(tmp_path / f"t{len(clauses)}{clauses.get('set') == '*'}{'insert' in clauses}"), keys=("k", "j"), buckets=32, time="t")
        table.replace(frame(spark, ROW, *data))
        before = files(tmp_path)
        table.merge(batch, ["k", "j"], **clauses)
        assert sorted(map(str, table.read().collect())) == sorted(map(str, merge(frame(spark, ROW, *data), batch, ["k", "j"], **clauses).collect()))
        assert table.read().columns == ["k", "j", "v", "t"]
        if "not_matched_by_source" not in clauses:
            assert len(files(tmp_path) - before) <= 4
        if "insert" in clauses and "not_matched_by_source" not in clauses:
            assert table.newest() == at("02 12:00")


def test_a_layout_is_by_date_or_by_key(spark):
    with pytest.raises(ValueError, match="not by several"):
        SnapshotTable(spark, "t", partition_ts="t", keys=("k",), buckets=4)


def test_folders_before_a_time_are_skipped(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), keys=("k",), buckets=4, time="t")
    assert not table.exists()
    table.replace(frame(spark, "k string, t timestamp", *[(f"k{n}", at("01 10:00")) for n in range(50)]))
    table.append(frame(spark, "k string, t timestamp", ("x", at("05 10:00")), ("y", None)))
    assert table.newest() == at("05 10:00")
    assert {r["k"] for r in table.read(since=at("05 00:00")).collect()} <= {"x", "y"} and table.read().count() == 52
    assert table.read(since=at("06 00:00")).count() == 0


# --- markers -----------------------------------------------------------------------------------------------------


def test_a_marker_is_never_seen_half_written(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.replace(spark.range(3))
    commits = tmp_path / "t" / "_commits"
    (commits / "00000001").touch()  # as a writer that died between creating and writing its marker would leave
    (commits / ".00000002-aside").write_text('{"paths"')  # one at work
    assert table.read().count() == 3 and table.commit_info()["paths"]
    assert table.append(spark.range(2)) == 2 and table.read().count() == 5
    table.vacuum(keep=1, older_than=0)
    assert table.read().count() == 5


def test_an_unreadable_first_marker_is_no_table(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    (tmp_path / "t" / "_commits").mkdir(parents=True)
    (tmp_path / "t" / "_commits" / "00000000").touch()
    assert not table.exists()
    assert table.create_or_merge(lambda: spark.range(4), lambda t: t) == "created" and table.read().count() == 4


def test_two_writers_of_one_version(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.replace(spark.range(1))
    with pytest.raises(CommitConflict):
        table._commit(0, [], "id long", {})
    assert not [p for p in (tmp_path / "t" / "_commits").iterdir() if "-" in p.name and not p.name.endswith(".crc")]


def test_folders_of_dead_writers_go(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), partition_ts="t")
    table.replace(frame(spark, "t timestamp_ntz", (at("01 10:00"),)))
    table._write(frame(spark, "t timestamp_ntz", (at("02 10:00"),)))  # its writer died before the marker
    kept = {p.name for p in (tmp_path / "t").glob("_w=*")}
    assert len(kept) == 2
    table.vacuum()
    assert {p.name for p in (tmp_path / "t").glob("_w=*")} == kept  # it may still be at work
    time.sleep(1.1)
    table.vacuum(orphans_older_than=1)
    assert len(list((tmp_path / "t").glob("_w=*"))) == 1 and table.read().count() == 1


def test_vacuum_drops_folders_within_a_write(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), partition_ts="t", cluster=["v"])
    table.replace(frame(spark, "t timestamp_ntz, v int", (at("01 10:00"), 1), (at("02 10:00"), 1)))
    table.overwrite_dates(frame(spark, "t timestamp_ntz, v int", (at("02 11:00"), 2)), ["2024-01-02"])
    assert len(list((tmp_path / "t").glob("_w=*/dt=*"))) == 3
    table.vacuum(keep=1, older_than=0)
    assert len(list((tmp_path / "t").glob("_w=*/dt=*"))) == 2 and rows(table.read(), "v")[1]["v"] == 2


def test_batches_of_merges_are_not_left_behind(spark, tmp_path):
    from pathlib import Path

    from reelstat.session import shared_dir

    folder = Path(shared_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    table = SnapshotTable(spark, str(tmp_path / "t"), keys=("k",), buckets=4)
    table.replace(frame(spark, "k string, v int", ("a", 1)))
    table.merge(frame(spark, "k string, v int", ("a", 2)), ["k"], set="*", insert="*")
    assert set(folder.iterdir()) == before


def test_the_first_run_query_returns_rows_beside_its_summaries(spark, monkeypatch):
    """The normalized statistics come with their values, not as a count alone."""
    from checks import queries

    events, documents, shards = happenings()
    raw_events = frame(spark, RAW, *events)
    scores = frame(spark, "video_id string, is_nsfw boolean, nsfw_ec string, nsfw_gore string, probability double", *[(f"v{k}", False, "x", "g", 0.9) for k in range(300)])
    people = frame(spark, "user_id string, last_updated_date long, geo struct<region:string>", *shards).withColumn("occurrence_date", F.col("last_updated_date"))
    approved = frame(spark, "video_id string, post_id string, canister_id string, user_id string, is_approved boolean", ("a", "p", "c", "u", True))
    inputs = chain.Inputs(raw_events, scores, frame(spark, DOCUMENTS, *documents), people, approved)
    monkeypatch.setattr(queries, "_inputs", lambda *_, **__: inputs)
    found = rows(queries.QUERIES["chain_first_run"](spark, ""))
    pairs = relation.user_video_relation(raw_events)
    videos = metrics.video_statistics(pairs, metrics.user_video_metrics(pairs))
    want = queries.comparable(metrics.video_statistics_normalized(videos, metrics.global_video_stats(videos)))
    own = [{c: r[c] for c in want.columns} for r in found if r["video_id"] is not None]
    assert sorted(own, key=lambda r: r["video_id"]) == rows(want, "video_id") and len(own) == 300
    assert {r["name"]: r["rows"] for r in found}["video_statistics_normalized"] == 300

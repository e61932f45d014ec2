import json
import math
from datetime import date, datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from reelstat.operators.merge import CARDINALITY_MESSAGE
from reelstat.plans import counts, embeddings, graph, ingest, metrics, moderation, popularity, relation, uploads, users
from tests.conftest import at, rows

W, L, S = relation.WATCH, relation.LIKE, relation.SHARE


def act(user, video, **more):
    return {"user_id": user, "video_id": video, **more}


# --- relation ----------------------------------------------------------------------------------------------------


def test_relation_of_watches_likes_and_shares(raw):
    events = raw(
        (W, act("u", "a", percentage_watched=50), "01 10:00"),
        (W, act("u", "a", percentage_watched="100"), "02 10:00"),
        (W, act("u", "a", percentage_watched=100.5), "03 10:00"),  # out of range
        (W, act("u", "a", percentage_watched="much"), "04 10:00"),  # unreadable
        (L, act("u", "a"), "05 10:00"),
        (L, act("u", "b"), "05 10:00"),  # never watched
        (W, act("u", "c", percentage_watched=0), "01 10:00"),
        (S, act("u", "c"), "06 10:00"),
        ("other", act("u", "d", percentage_watched=1), "01 10:00"),
    )
    assert rows(relation.user_video_relation(events), "video_id") == [
        {
            "user_id": "u", "video_id": "a", "last_watched_timestamp": at("02 10:00"), "mean_percentage_watched": 0.75,
            "last_liked_timestamp": at("05 10:00"), "liked": True, "last_shared_timestamp": None, "shared": False,
        },
        {
            "user_id": "u", "video_id": "c", "last_watched_timestamp": at("01 10:00"), "mean_percentage_watched": 0.0,
            "last_liked_timestamp": None, "liked": False, "last_shared_timestamp": at("06 10:00"), "shared": True,
        },
    ]


def test_pairs_without_a_key_keep_their_watch_but_join_no_like(raw):
    events = raw(
        (W, {"video_id": "a", "percentage_watched": 10}, "01 10:00"),
        (L, {"video_id": "a"}, "02 10:00"),
        (W, None, "01 11:00"),
        (W, "not json", "01 12:00"),
    )
    (row,) = rows(relation.user_video_relation(events))
    assert (row["user_id"], row["video_id"], row["liked"], row["last_liked_timestamp"]) == (None, "a", False, None)


def test_relation_increment_keeps_flags_and_replaces_the_rest(raw):
    first = raw((W, act("u", "a", percentage_watched=20), "01 10:00"), (L, act("u", "a"), "01 09:00"))
    target = relation.user_video_relation(first)
    later = first.union(
        raw(
            (W, act("u", "a", percentage_watched=80), "02 10:00"),
            (S, act("u", "a"), "02 11:00"),
            (L, act("v", "a"), "02 11:00"),  # liked without a watch in the batch
            (W, act("v", "b", percentage_watched=5), "01 09:30"),  # late: before the last watch
            (W, act("w", "b", percentage_watched=5), "02 10:30"),
        )
    )
    out = {(r["user_id"], r["video_id"]): r for r in rows(relation.user_video_relation_increment(target, later))}
    assert set(out) == {("u", "a"), ("w", "b")}
    merged = out["u", "a"]
    assert merged["mean_percentage_watched"] == 0.8 and merged["last_watched_timestamp"] == at("02 10:00")
    assert merged["liked"] and merged["last_liked_timestamp"] is None  # sticky flag, timestamp of the batch
    assert merged["shared"] and merged["last_shared_timestamp"] == at("02 11:00")


def test_empty_target_means_initial_build(raw):
    events = raw((W, act("u", "a", percentage_watched=20), "01 10:00"))
    empty = relation.user_video_relation(events).where("false")
    assert relation.user_video_relation_increment(empty, events).count() == 1


# --- statistics --------------------------------------------------------------------------------------------------

REL = (
    "user_id string, video_id string, last_watched_timestamp timestamp_ntz, mean_percentage_watched double,"
    "last_liked_timestamp timestamp_ntz, liked boolean, last_shared_timestamp timestamp_ntz, shared boolean"
)


@pytest.fixture(scope="module")
def rel(spark):
    def build(*data):
        return spark.createDataFrame([(u, v, at(t), m, None, lk, None, sh) for u, v, t, m, lk, sh in data], REL)

    return build


def test_user_metrics(rel):
    out = rows(
        metrics.user_video_metrics(
            rel(("u", "a", "01 10:00", 0.5, True, False), ("u", "b", "02 10:00", 1.0, None, False), ("v", "a", "03 10:00", 0.2, True, True))
        ),
        "user_id",
    )
    u, v = out
    assert (u["user_like_avg"], u["total_likes"], u["total_watches"]) == (0.5, 1, 2)
    assert u["user_like_stddev"] == pytest.approx(math.sqrt(0.5))
    assert u["user_normalized_like_avg"] == 0.25
    assert u["user_normalized_watch_percentage_stddev"] == pytest.approx(0.25 * math.sqrt(0.125))
    assert v["user_like_stddev"] is None and v["user_normalized_share_avg"] == 0.0  # a single pair has no deviation
    assert list(u) == metrics.USER_COLUMNS and len(u) == 17


def test_user_metrics_increment_as_published_and_fresh(rel):
    old = [("u", "a", "01 10:00", 0.5, True, False), ("u", "b", "01 11:00", 1.0, False, False)]
    new = [("u", "c", "02 10:00", 0.0, True, False), ("u", "d", "02 11:00", 0.2, True, True)]
    target, whole = metrics.user_video_metrics(rel(*old)), metrics.user_video_metrics(rel(*old, *new))
    (want,) = rows(whole)
    (fresh,) = rows(metrics.user_video_metrics_increment(target, rel(*old, *new), fresh=True))
    assert {k: fresh[k] for k in want} == {k: pytest.approx(v) if isinstance(v, float) else v for k, v in want.items()}
    (stale,) = rows(metrics.user_video_metrics_increment(target, rel(*old, *new)))
    assert stale["user_like_avg"] == pytest.approx(0.75)
    assert stale["user_normalized_like_avg"] == 0.25  # from the average before the merge


def test_single_pair_batch_loses_the_deviation_unless_counted_as_zero(rel):
    old = [("u", "a", "01 10:00", 0.5, True, False), ("u", "b", "01 11:00", 1.0, False, False)]
    both = rel(*old, ("u", "c", "02 10:00", 0.0, True, False))
    target = metrics.user_video_metrics(rel(*old))
    (row,) = rows(metrics.user_video_metrics_increment(target, both))
    assert row["user_like_stddev"] is None and row["total_watches"] == 3
    (row,) = rows(metrics.user_video_metrics_increment(target, both, single_as_zero=True))
    assert row["user_like_stddev"] == pytest.approx(math.sqrt(1 / 3))


def test_video_statistics_weigh_users_down(rel):
    pairs = rel(
        ("u", "a", "01 10:00", 0.5, True, False), ("u", "b", "02 10:00", 1.0, False, False), ("x", "a", "03 10:00", 0.9, True, True)
    )
    per_user = metrics.user_video_metrics(pairs.where("user_id = 'u'"))  # x has no metrics and contributes 0
    out = {r["video_id"]: r for r in rows(metrics.video_statistics(pairs, per_user))}
    assert out["a"]["user_normalized_like_perc"] == 0.25 and out["a"]["total_impressions"] == 2
    assert out["b"]["user_normalized_watch_percentage_perc"] == 0.25
    unknown = rel((None, "a", "01 10:00", 0.5, True, False))
    assert rows(metrics.video_statistics(unknown, per_user))[0]["total_impressions"] == 0


def test_global_increment_without_news_changes_nothing(rel):
    pairs = rel(("u", "a", "01 10:00", 0.5, True, False), ("v", "b", "02 10:00", 1.0, False, False))
    statistics = metrics.video_statistics(pairs, metrics.user_video_metrics(pairs))
    total = metrics.global_video_stats(statistics)
    assert rows(metrics.global_video_stats_increment(total, statistics)) == rows(total)


def test_normalized_uses_the_deviation_floor_and_one_global_row(spark, rel):
    pairs = rel(("u", "a", "01 10:00", 0.5, True, False), ("u", "b", "02 10:00", 1.0, False, False))
    statistics = metrics.video_statistics(pairs, metrics.user_video_metrics(pairs))
    total = metrics.global_video_stats(statistics)
    out = {r["video_id"]: r for r in rows(metrics.video_statistics_normalized(statistics, total))}
    assert out["a"]["normalized_share_perc"] == 0.0  # all equal: deviation 0 counts as 0.01
    z = [out["a"][f"normalized_{m}_perc"] + 120 for m in ("like", "share", "watch")]
    assert out["a"]["ds_quality_score"] == pytest.approx(3 * z[0] * z[1] * z[2] / sum(z))
    single = metrics.global_video_stats(statistics.where("video_id = 'a'"))
    assert rows(metrics.video_statistics_normalized(statistics, single))[0]["ds_quality_score"] is None


def test_normalized_increment_is_one_step_stale(rel):
    old = [("u", "a", "01 10:00", 0.5, True, False), ("u", "b", "01 11:00", 1.0, False, False), ("v", "a", "01 12:00", 0.1, False, True)]
    s0 = metrics.video_statistics(rel(*old), metrics.user_video_metrics(rel(*old)))
    g0 = metrics.global_video_stats(s0)
    n0 = metrics.video_statistics_normalized(s0, g0)
    r1 = rel(*old, ("w", "a", "02 10:00", 0.9, True, False), ("w", "b", "02 11:00", 0.1, False, False))
    s1 = metrics.video_statistics_increment(s0, r1, metrics.user_video_metrics(r1))
    g1 = metrics.global_video_stats_increment(g0, s1)
    before = {r["video_id"]: r for r in rows(n0)}["a"]
    out = {r["video_id"]: r for r in rows(metrics.video_statistics_normalized_increment(n0, s1, g1))}["a"]
    (g,) = rows(g1)
    sd = max(g["global_stddev_user_normalized_likes"], 0.01)
    assert out["normalized_like_perc"] == pytest.approx((before["like_percentage_un"] - g["global_avg_user_normalized_likes"]) / sd)
    assert out["ds_quality_score"] == pytest.approx(
        (lambda z: 3 * z[0] * z[1] * z[2] / sum(z))([before[f"normalized_{m}_perc"] + 120 for m in ("like", "share", "watch")])
    )
    fresh = {r["video_id"]: r for r in rows(metrics.video_statistics_normalized_increment(n0, s1, g1, fresh=True))}["a"]
    assert fresh["like_percentage_un"] == out["like_percentage_un"]
    assert fresh["normalized_like_perc"] == pytest.approx((out["like_percentage_un"] - g["global_avg_user_normalized_likes"]) / sd)


# --- popularity --------------------------------------------------------------------------------------------------

AS_OF = datetime(2024, 1, 31)


def test_flat_rates_fail_without_a_guard(rel):
    pairs = rel(("u", "a", "30 10:00", 0.5, True, False), ("u", "b", "30 10:00", 0.5, True, False))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        popularity.popular_videos(pairs, AS_OF).collect()
    guarded = popularity.popular_videos(pairs, AS_OF, guard="zero")
    assert [r["global_popularity_score"] for r in rows(guarded)] == pytest.approx([1 + 1e-9] * 2)
    single = popularity.popular_videos(pairs.where("video_id = 'a'"), AS_OF)
    assert rows(single)[0]["global_popularity_score"] is None


def test_window_of_days_includes_its_start(rel):
    pairs = rel(
        ("u", "a", "24 00:00", 0.5, True, False), ("u", "b", "23 23:59", 0.1, False, False), ("u", "c", "30 10:00", 0.9, False, False)
    )
    assert [r["video_id"] for r in rows(popularity.popular_videos(pairs, AS_OF, 7), "video_id")] == ["a", "c"]


def test_unknown_viewers_form_a_region(spark, rel):
    pairs = rel(
        ("u", "a", "30 10:00", 0.5, True, False),
        ("u", "b", "30 10:00", 0.1, False, False),
        ("x", "a", "30 10:00", 0.9, False, False),
        (None, "b", "30 10:00", 0.3, True, False),
    )
    places = spark.createDataFrame([("u", ("north",))], "user_id string, geo struct<region:string>")
    out = {(r["video_id"], r["region"]): r for r in rows(popularity.local_popular_videos(pairs, places, AS_OF))}
    assert set(out) == {("a", "north"), ("b", "north"), ("a", None), ("b", None)}
    assert out["a", "north"]["local_popularity_score"] == pytest.approx(1.0)  # both z-scores lead by the same gap
    assert out["a", None]["normalized_watch_perc"] > 0 > out["a", None]["normalized_like_perc"]


def test_region_ranking_equals_the_fan_out_join(spark, rel):
    pairs = rel(
        ("u", "a", "30 10:00", 0.5, True, False),
        ("v", "a", "30 10:00", 0.7, False, False),
        ("u", "b", "30 10:00", 0.1, False, False),
        ("u", "c", "30 10:00", 0.2, True, False),
    )
    ups = spark.createDataFrame(
        [("a", "n"), ("a", "n"), ("a", "s"), ("b", "n"), ("c", None), (None, "n")], "video_id string, region string"
    )
    fanned = (
        pairs.join(ups, "video_id").where("region IS NOT NULL").groupBy("video_id", "region").agg(
            F.avg(F.col("liked").cast("int")).alias("l"), F.avg("mean_percentage_watched").alias("w")
        )
    )
    stats = fanned.agg(F.avg("l"), F.stddev("l"), F.avg("w"), F.stddev("w")).first()
    for r in rows(popularity.region_popular_videos(pairs, ups, AS_OF)):
        x = fanned.where((F.col("video_id") == r["video_id"]) & (F.col("region") == r["region"])).first()
        zl, zw = (x["l"] - stats[0]) / stats[1], (x["w"] - stats[2]) / stats[3]
        assert r["normalized_like_perc_p"] == pytest.approx(zl - min(zl, zw) + 1)
        assert r["normalized_watch_perc_p"] == pytest.approx(zw - min(zl, zw) + 1)
    assert popularity.region_popular_videos(pairs, ups, AS_OF).count() == 3


def test_enrichment(spark, rel):
    pairs = rel(("u", "a", "30 10:00", 0.5, True, False), ("u", "b", "30 10:00", 0.1, False, False), ("u", "c", "30 10:00", 0.2, True, False))
    nsfw = spark.createDataFrame(
        [("a", True, "x", "y", 0.9), ("b", False, "neutral", "y", 0.1), ("b", False, "neutral", "z", 0.2)],
        "video_id string, is_nsfw boolean, nsfw_ec string, nsfw_gore string, probability double",
    )
    ups = spark.createDataFrame(
        [("a", "old", at("01 10:00")), ("a", "new", at("02 10:00"))], "video_id string, upload_type string, timestamp timestamp_ntz"
    )
    bots = spark.createDataFrame([("b",), ("b",)], "video_id string")
    approved = spark.createDataFrame([("a", True), ("b", False), ("b", None)], "video_id string, is_approved boolean")
    out = rows(popularity.popular_videos_enriched(pairs, nsfw, ups, bots, approved, AS_OF), "video_id", "nsfw_gore")
    got = [(r["video_id"], r["nsfw_gore"], r["upload_type"], r["is_bot_uploaded"], r["user_uploaded_ai_content"]) for r in out]
    assert got == [("a", "y", "new", False, True), ("b", "y", None, True, False), ("b", "z", None, True, False)]


# --- graph, uploads, moderation, users, counts -------------------------------------------------------------------


def follow(a, b):
    return {"user_id": a, "publisher_user_id": b}


def test_follower_graph_latest_state_and_late_events(raw):
    events = raw(
        (graph.FOLLOWED, follow("a", "b"), "01 10:00"),
        (graph.UNFOLLOWED, follow("a", "b"), "02 10:00"),
        (graph.FOLLOWED, follow("b", "a"), "01 10:00"),
        (graph.FOLLOWED, follow("a", None), "03 10:00"),
        (graph.UNFOLLOWED, follow("c", "a"), "01 12:00"),
        (graph.FOLLOWED, follow("c", "a"), "01 12:00"),  # same instant: the follow wins
    )
    target = graph.follower_graph(events)
    assert [(r["follower_id"], r["active"]) for r in rows(target, "follower_id")] == [("a", False), ("b", True), ("c", True)]
    more = events.union(
        raw(
            (graph.FOLLOWED, follow("a", "b"), "04 10:00"),
            (graph.UNFOLLOWED, follow("b", "a"), "01 11:00"),  # late: not after the latest state
            (graph.FOLLOWED, follow("d", "a"), "04 11:00"),
        )
    )
    out = graph.follower_graph_increment(target, more)
    assert [(r["follower_id"], r["active"]) for r in rows(out, "follower_id")] == [("a", True), ("b", True), ("c", True), ("d", True)]


@pytest.fixture(scope="module")
def documents(spark):
    def build(*data):
        rows_ = [(json.dumps(d), at(t)) for d, t in data]
        return spark.createDataFrame(rows_, "data string, publish_time timestamp_ntz")

    return build


def test_upload_stats_and_increment(documents):
    def doc(video, stamp, event=uploads.UPLOAD_SUCCESS):
        data = {"event": event, "video_id": video, "$device_id": "d1", "is_creator": False, "device": {"x": 1}}
        return {"event_data": data, "timestamp": stamp}

    docs = documents((doc("a", "2024-01-01T10:00:00.123456+00:00"), "01 10:00"), (doc("b", "2024-01-01T10:00:00Z", "x"), "01 10:00"))
    target = uploads.video_upload_stats(docs)
    (row,) = rows(target.select("device_id", "device", "is_creator", "video_id", F.unix_micros("timestamp").alias("t")))
    assert row == {"device_id": "d1", "device": None, "is_creator": "false", "video_id": "a", "t": 1704103200123456}
    assert len(target.columns) == 26
    more = docs.union(documents((doc("c", "2024-01-01T15:40:00+05:30"), "01 10:10"), (doc("d", "2024-01-01T09:00:00+00:00"), "01 09:00")))
    out = uploads.video_upload_stats_increment(target, more)
    assert [r["video_id"] for r in rows(out, "video_id")] == ["a", "c"]  # d is late


def test_bots(raw):
    done = uploads.UPLOAD_DONE
    events = raw(
        (done, {"video_id": "a", "country": "XX-BOT"}, "01 10:00"),
        (done, {"video_id": "b", "country": "XX-bot"}, "01 10:00"),
        (done, {"video_id": "c"}, "01 10:00"),
        ("other", {"video_id": "d", "country": "XX-BOT"}, "01 10:00"),
    )
    target = uploads.bot_uploaded_content(events)
    assert [r["video_id"] for r in rows(target)] == ["a"]
    more = events.union(raw((done, {"video_id": "e", "country": "Y-BOT"}, "02 10:00"), (done, {"video_id": "f", "country": "Y-BOT"}, "01 10:00")))
    assert [r["video_id"] for r in rows(uploads.bot_uploaded_content_increment(target, more), "video_id")] == ["a", "e"]


def ai(video, **more):
    return {"event_data": {"event": uploads.UPLOAD_SUCCESS, "type_ext": uploads.AI_VIDEO, "video_id": video, **more}, "timestamp": "t"}


def test_ai_ugc_unnests_rows_and_falls_back_to_the_document(documents, raw):
    batch = {
        "event_data": {
            "canister_id": "from-doc",
            "type_ext": uploads.AI_VIDEO,
            "rows": [ai("b"), {"event_data": {"event": uploads.UPLOAD_SUCCESS, "video_id": '"c"'}}, ai("z", type_ext="other")],
        },
        "timestamp": "doc-time",
    }
    docs = documents((ai("a", user_id="u", type="k"), "30 10:00"), (batch, "30 11:00"), ({"event_data": {"type": "x"}}, "30 12:00"))
    done = raw(*[(uploads.UPLOAD_DONE, {"video_id": v, "post_id": 7, "canister_id": "up"}, "30 10:05") for v in "abcz"])
    out = {r["video_id"]: r for r in rows(uploads.ai_ugc(docs, done))}
    assert set(out) == {"a", "b", "c"}
    assert out["a"]["user_id"] == "u" and out["a"]["event_type"] == "k" and out["a"]["post_id"] == "7"
    assert out["b"]["ai_canister_id"] == "from-doc" and out["b"]["event_timestamp_str"] == "t"
    assert out["c"]["event_timestamp_str"] == "doc-time" and out["c"]["type_ext"] == uploads.AI_VIDEO
    assert json.loads(out["b"]["event_json_data"])["video_id"] == "b"
    assert tuple(out["a"]) == uploads.AI_COLUMNS


def test_ai_ugc_increment_window_and_cardinality(documents, raw):
    docs = documents((ai("a"), "30 10:00"), (ai("b"), "30 09:00"))
    done = raw((uploads.UPLOAD_DONE, {"video_id": "a"}, "30 10:05"), (uploads.UPLOAD_DONE, {"video_id": "b"}, "30 10:05"))
    empty = uploads.ai_ugc(docs, done).where("false")
    now = at("30 10:35")
    target = uploads.ai_ugc_increment(empty, docs, done, now)
    assert [r["video_id"] for r in rows(target)] == ["a"]
    twice = done.union(raw((uploads.UPLOAD_DONE, {"video_id": "a", "country": "late"}, "30 10:10")))
    with pytest.raises(Exception, match=CARDINALITY_MESSAGE):
        uploads.ai_ugc_increment(target, docs, twice, now).collect()
    (row,) = rows(uploads.ai_ugc_increment(target, docs, twice, now, keep_latest=True))
    assert row["country"] == "late"


def test_reports_with_a_missing_key_are_inserted_again(raw):
    def report(video, user, **more):
        return (moderation.REPORTED, {"video_id": video, "user_id": user, **more}, "30 10:00")

    events = raw(report("a", "u", report_reason="x"), report("a", None))
    target = moderation.video_reports(events)
    out = moderation.video_reports_increment(target, raw(report("a", "u", report_reason="y"), report("a", None)), at("30 10:20"))
    assert [(r["reporter_user_id"], r["report_reason"]) for r in rows(out, "reporter_user_id")] == [(None, None), (None, None), ("u", "y")]


def test_exclusions(spark, raw):
    def seen(event, video, t):
        return (event, {"video_id": video}, t)

    rep, ban = moderation.REPORTED, moderation.BANNED
    events = raw(
        seen(rep, "a", "30 10:00"), seen(rep, "a", "30 09:00"), seen(ban, "a", "30 11:00"), seen(rep, "b", "30 10:00"),
        seen(rep, "c", "30 10:00"), seen(rep, None, "30 10:00"), seen(ban, "d", "30 10:00"),
    )
    scores = spark.createDataFrame(
        [("a", 0.4, "neutral"), ("a", 0.5, "neutral"), ("b", 0.39, "neutral"), ("c", None, "gore")],
        "video_id string, probability double, nsfw_ec string",
    )
    out = rows(moderation.excluded_videos(events, scores), "video_id", "exclusion_reason")
    assert [(r["video_id"], r["exclusion_reason"], r["excluded_at"]) for r in out] == [
        ("a", "banned", at("30 11:00")),
        ("a", "reported_nsfw", at("30 09:00")),
        ("c", "reported_nsfw", at("30 10:00")),
        ("d", "banned", at("30 10:00")),
    ]
    target = moderation.excluded_videos(events, scores).where("video_id <> 'a'")
    later = raw(seen(rep, "c", "30 12:00"), seen(rep, "a", "30 12:00"), seen(ban, "a", "30 12:01"), seen(ban, "e", "30 11:00"))
    out = moderation.excluded_videos_increment(target, later, scores, at("30 12:05"))
    assert [(r["video_id"], r["exclusion_reason"], r["excluded_at"]) for r in rows(out, "video_id")] == [
        ("a", "banned", at("30 12:01")),
        ("c", "reported_nsfw", at("30 12:00")),
        ("d", "banned", at("30 10:00")),
    ]


@pytest.mark.parametrize("kind", ["int", "string"])
def test_user_facts(spark, kind):
    schema = f"user_id string, geo struct<region:string>, last_updated_date {kind}"
    cast = int if kind == "int" else str
    day1 = spark.createDataFrame([("u", ("n",), cast(20240101)), ("v", ("n",), cast(20240101))], schema)
    day2 = spark.createDataFrame([("u", ("s",), cast(20240104)), ("w", ("s",), cast(20240104)), ("v", ("s",), cast(20231230))], schema)
    target = users.user_base_facts(day1)
    out = rows(users.user_base_facts_increment(target, day1.union(day2), date(2024, 1, 6)), "user_id")
    assert [(r["user_id"], r["geo"]["region"], r["last_updated_date"].day) for r in out] == [("u", "s", 4), ("v", "n", 1), ("w", "s", 4)]


def test_daily_counts_keep_the_latest_dates(spark):
    data = [(datetime(2024, 1, 1) + timedelta(days=d, hours=h), "e") for d in range(5) for h in range(d + 1)]
    events = spark.createDataFrame(data, "timestamp timestamp_ntz, event string")
    out = counts.daily_event_counts(events, n_dates=2)
    assert [(r["event_date"].day, r["event_count"]) for r in rows(out, "event_date")] == [(4, 4), (5, 5)]
    updated = counts.daily_event_counts_update(out.withColumn("event_count", F.lit(0).cast("bigint")), events, date(2024, 1, 5))
    assert [(r["event_date"].day, r["event_count"]) for r in rows(updated, "event_date")] == [(4, 0), (5, 5)]


# --- embeddings, ingestion ---------------------------------------------------------------------------------------


def lengths(batches):
    for batch in batches:
        yield pd.Series([[float(len(u)), 1.0] for u in batch["uri"]])


def test_embed_new_videos_caps_each_run(spark):
    meta = "array<struct<name:string,value:string>>"
    objects = spark.createDataFrame([(f"o{i}", []) for i in range(9)] + [("unscored", [])], f"uri string, metadata {meta}")
    nsfw = spark.createDataFrame([(f"o{i}", False, "n", "g") for i in range(9)], "gcs_video_id string, is_nsfw boolean, nsfw_ec string, nsfw_gore string")
    made = embeddings.embed_new_videos(objects, nsfw, objects.where("uri = 'o0'"), lengths, limit=5)
    assert [r["uri"] for r in rows(made, "uri")] == ["o1", "o2", "o3", "o4", "o5"]
    assert made.first()[embeddings.VECTOR] == [2.0, 1.0]
    second = embeddings.embed_new_videos(objects, nsfw, objects.where("uri = 'o0'").unionByName(made.select("uri", "metadata")), lengths, limit=5)
    assert [r["uri"] for r in rows(second, "uri")] == ["o6", "o7", "o8"]


def batch_sizes(batches):
    """One segment a text, whose end is the number of characters of the batch it came in."""
    for batch in batches:
        size = float(batch["text"].str.len().sum())
        yield pd.Series([[(0.0, size, [float(len(t))])] for t in batch["text"]])


def test_segments_are_found_in_batches_bounded_by_bytes(spark):
    own = spark.newSession()  # other tests bound the batches of theirs
    texts = own.range(200, numPartitions=1).select(F.concat(F.lit("o"), "id").alias("uri"), F.repeat(F.lit("x"), 100_000).alias("text"))
    made = embeddings.embed_segments(texts, batch_sizes, ("text",)).collect()
    assert len({r["uri"] for r in made}) == len(made) == 200 and {r[embeddings.VECTOR][0] for r in made} == {100_000.0}
    assert max(r["end"] for r in made) <= 8 << 20


def test_index_and_backfills(spark):
    schema = "uri string, metadata array<struct<name:string,value:string>>, ml_generate_embedding_result array<double>, nsfw_ec string, nsfw_gore string, is_nsfw boolean"
    full = [("post_id", "1"), ("timestamp", "2"), ("publisher_user_id", "3")]
    made = spark.createDataFrame(
        [("a", full, [1.0, 2.0], "n", "g", False), ("b", full[:2], [1.0, 2.0], "n", "g", False), ("c", full, [1.0], "n", "g", False)], schema
    )
    index = embeddings.index_rows(made, dim=2)
    assert rows(index.select("uri", "post_id", "timestamp", "canister_id", "publisher_user_id")) == [
        {"uri": "a", "post_id": "1", "timestamp": "2", "canister_id": None, "publisher_user_id": "3"}
    ]
    objects = spark.createDataFrame([("b", [("publisher_user_id", "9")]), ("a", [("publisher_user_id", "8")])], schema.split(", ml")[0])
    fixed = embeddings.backfill_metadata_key(made, objects, "publisher_user_id")
    assert [r["publisher_user_id"] for r in rows(embeddings.update_video_index(index, fixed, dim=2), "uri")] == ["3", "9"]
    nsfw = spark.createDataFrame(
        [("a", "x", "gx", True), ("a", "y", "gy", False)], "gcs_video_id string, nsfw_ec string, nsfw_gore string, is_nsfw boolean"
    )
    out = rows(embeddings.backfill_nsfw(made, nsfw, embeddings.EMBEDDING_DEFAULTS).select("uri", "nsfw_ec", "is_nsfw"), "uri")
    assert [(r["nsfw_ec"], r["is_nsfw"]) for r in out] == [("y", False), ("UNKNOWN", True), ("UNKNOWN", True)]


def test_latest_events_copy_creates_then_appends(spark, tmp_path):
    events = spark.range(250).select("id", F.parse_json(F.concat(F.lit('{"n":'), "id", F.lit("}"))).alias("data"))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS copies LOCATION '{tmp_path}/copies'")
    try:
        modes = [ingest.latest_events_copy(events, "copies.latest") for _ in range(2)]
        table = spark.table("copies.latest")
        assert modes == ["overwrite", "append"] and table.count() == 200
        assert table.agg(F.min("id")).first()[0] == 150 and table.where("id = 249").first()["data"] == '{"n":249}'
    finally:
        spark.sql("DROP DATABASE copies CASCADE")

"""User x video relation: what each user did with each video."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.functions.numeric import to_double
from reelstat.functions.timex import high_watermark, since_watermark
from reelstat.operators.filters import read_events
from reelstat.operators.merge import Change
from reelstat.plans.ingest import event_fields

KEYS = ("user_id", "video_id")
# Event names.
WATCH, LIKE, SHARE = "video_duration_watched", "like_video", "share_video"
MAX_PERCENTAGE = 100.0


def user_video_relation(events: DataFrame) -> DataFrame:
    """One row per (user, video) with a valid watch, with its likes and shares.

    One scan and one shuffle: the three kinds of events are aggregated side by side and pairs without a valid watch are
    dropped afterwards, which equals joining likes and shares to watches. A pair with a NULL key would not have joined, so
    its likes and shares are blanked.
    """
    fields = {"user_id": "$.user_id", "video_id": "$.video_id", "pct": "$.percentage_watched"}
    flat = event_fields(read_events(events, (WATCH, LIKE, SHARE)), fields, "event", "timestamp")
    flat = flat.withColumn("pct", to_double(F.col("pct")))
    ts = F.col("timestamp")
    watched = (F.col("event") == WATCH) & (F.col("pct") <= MAX_PERCENTAGE)
    liked, shared = F.col("event") == LIKE, F.col("event") == SHARE
    pairs = flat.groupBy(*KEYS).agg(
        F.max(F.when(watched, ts)).alias("last_watched_timestamp"),
        (F.avg(F.when(watched, F.col("pct"))) / 100).alias("mean_percentage_watched"),
        F.max(F.when(liked, ts)).alias("last_liked_timestamp"),
        F.count_if(liked).alias("_likes"),
        F.max(F.when(shared, ts)).alias("last_shared_timestamp"),
        F.count_if(shared).alias("_shares"),
        F.count_if(watched).alias("_watches"),
    )
    joins = F.col("user_id").isNotNull() & F.col("video_id").isNotNull()
    return pairs.where(F.col("_watches") > 0).select(
        *KEYS,
        "last_watched_timestamp",
        "mean_percentage_watched",
        F.when(joins, F.col("last_liked_timestamp")).alias("last_liked_timestamp"),
        (joins & (F.col("_likes") > 0)).alias("liked"),
        F.when(joins, F.col("last_shared_timestamp")).alias("last_shared_timestamp"),
        (joins & (F.col("_shares") > 0)).alias("shared"),
    )


def user_video_relation_change(events: DataFrame, last: datetime) -> Change:
    """The events after ``last``, to be merged into the relation.

    Likes and shares stay set once set; their timestamps and the watch percentage are those of the new batch.
    """
    batch = user_video_relation(since_watermark(events, "timestamp", last))
    assignments = {c: f"s.{c}" for c in batch.columns if c not in KEYS}
    assignments.update(liked="t.liked OR s.liked", shared="t.shared OR s.shared")
    return Change(batch, KEYS, assignments)


def user_video_relation_increment(target: DataFrame, events: DataFrame, last: datetime | None = None) -> DataFrame:
    """``target`` with the events after its last watch merged in."""
    last = last or high_watermark(target, "last_watched_timestamp")
    return user_video_relation(events) if last is None else user_video_relation_change(events, last).onto(target)

"""Follower graph: the latest follow state of each pair of users."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.functions.timex import high_watermark, since_watermark
from reelstat.operators.filters import read_events, require_keys
from reelstat.operators.merge import Change
from reelstat.operators.windows import latest_per_key
from reelstat.plans.ingest import event_fields

KEYS = ("follower_id", "following_id")
UPDATED = "last_updated_timestamp"
# Event names.
FOLLOWED, UNFOLLOWED = "mp_user_followed", "mp_user_unfollowed"


def follow_states(events: DataFrame) -> DataFrame:
    """Follow and unfollow events of known pairs as (pair, active, time)."""
    fields = {"follower_id": "$.user_id", "following_id": "$.publisher_user_id"}
    flat = event_fields(read_events(events, (FOLLOWED, UNFOLLOWED)), fields, "event", "timestamp")
    return require_keys(flat, *KEYS).select(
        *KEYS, (F.col("event") == FOLLOWED).alias("active"), F.col("timestamp").alias(UPDATED)
    )


def follower_graph(events: DataFrame) -> DataFrame:
    """Latest state per pair; of events at the same instant a follow wins."""
    return latest_per_key(follow_states(events), KEYS, [UPDATED], tie=["active"])


def follower_graph_change(events: DataFrame, last: datetime | None) -> Change:
    """The states of events after ``last``; earlier late arrivals are ignored."""
    return Change(follower_graph(since_watermark(events, "timestamp", last)), KEYS, "*")


def follower_graph_increment(target: DataFrame, events: DataFrame) -> DataFrame:
    """``target`` with the states of events after its latest one merged in."""
    return follower_graph_change(events, high_watermark(target, UPDATED)).onto(target)

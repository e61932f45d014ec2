"""Reports by viewers and the list of excluded videos."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.functions.timex import lookback
from reelstat.operators.filters import read_events, require_keys
from reelstat.operators.merge import Change
from reelstat.plans.ingest import event_fields

# Event names, reasons, thresholds.
REPORTED, BANNED = "mp_video_reported", "video_report_banned"
REASON_REPORTED, REASON_BANNED = "reported_nsfw", "banned"
NSFW_PROBABILITY = 0.4
CLEAN_CLASS = "neutral"
REPORT_LOOKBACK = timedelta(minutes=35)
EXCLUSION_LOOKBACK = timedelta(minutes=10)

REPORT_KEYS = ("video_id", "reporter_user_id", "report_timestamp")


def video_reports(events: DataFrame) -> DataFrame:
    """One row per report."""
    fields = {
        "video_id": "$.video_id",
        "publisher_user_id": "$.publisher_user_id",
        "canister_id": "$.canister_id",
        "report_reason": "$.report_reason",
        "reporter_user_id": "$.user_id",
        "reporter_country": "$.country",
    }
    return event_fields(read_events(events, (REPORTED,)), fields, F.col("timestamp").alias("report_timestamp"))


def video_reports_change(events: DataFrame, as_of: datetime) -> Change:
    """The reports of the last 35 minutes, to be upserted."""
    return Change(video_reports(lookback(events, "timestamp", as_of, REPORT_LOOKBACK)), REPORT_KEYS, "*", source_unique=False)


def video_reports_increment(target: DataFrame, events: DataFrame, as_of: datetime) -> DataFrame:
    """Upsert the reports of the last 35 minutes."""
    return video_reports_change(events, as_of).onto(target)


def excluded_videos(events: DataFrame, nsfw_agg: DataFrame) -> DataFrame:
    """Videos reported and not clean, and videos banned; a video that is both has two rows.

    Both kinds of events are read and aggregated in one pass, to a row a video.
    """
    unclean = nsfw_agg.where((F.col("probability") >= F.lit(NSFW_PROBABILITY)) | (F.col("nsfw_ec") != CLEAN_CLASS))
    flat = event_fields(read_events(events, (REPORTED, BANNED)), {"video_id": "$.video_id"}, "event", "timestamp")
    first = {kind: F.min(F.when(F.col("event") == kind, F.col("timestamp"))).alias(kind) for kind in (REPORTED, BANNED)}
    seen = require_keys(flat, "video_id").groupBy("video_id").agg(*first.values())
    # several scores of one video count once
    scored = seen.join(unclean.groupBy("video_id").agg(F.lit(True).alias("unclean")), "video_id", "left")
    rows = F.array(
        F.when(F.col("unclean"), F.struct(F.col(REPORTED).alias("excluded_at"), F.lit(REASON_REPORTED).alias("exclusion_reason"))),
        F.struct(F.col(BANNED).alias("excluded_at"), F.lit(REASON_BANNED).alias("exclusion_reason")),
    )
    return scored.select("video_id", F.explode(rows).alias("row")).where("row.excluded_at is not null").select("video_id", "row.*")


def excluded_videos_change(events: DataFrame, nsfw_agg: DataFrame, as_of: datetime) -> Change:
    """The exclusions of the last 10 minutes, to be upserted; of a video both reported and banned, the ban counts."""
    batch = excluded_videos(lookback(events, "timestamp", as_of, EXCLUSION_LOOKBACK), nsfw_agg)
    # 'banned' sorts before 'reported_nsfw'
    chosen = batch.groupBy("video_id").agg(
        F.min_by("excluded_at", "exclusion_reason").alias("excluded_at"), F.min("exclusion_reason").alias("exclusion_reason")
    )
    return Change(chosen, ["video_id"], "*")


def excluded_videos_increment(target: DataFrame, events: DataFrame, nsfw_agg: DataFrame, as_of: datetime) -> DataFrame:
    """Upsert the exclusions of the last 10 minutes."""
    return excluded_videos_change(events, nsfw_agg, as_of).onto(target)

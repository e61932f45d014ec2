"""Popularity rankings over a recent window: global, by viewer region, by uploader region."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.functions.numeric import popularity_score, shift_to_one
from reelstat.functions.timex import lookback
from reelstat.operators.joins import existence_flag, skew_join
from reelstat.operators.windows import latest_per_key, zscore

WATCHED = "last_watched_timestamp"


def _recent(relation: DataFrame, as_of: datetime, days: int) -> DataFrame:
    return lookback(relation, WATCHED, as_of, timedelta(days=days))


def _rates(pairs: DataFrame, *keys: str) -> DataFrame:
    return pairs.groupBy(*keys).agg(
        F.avg(F.col("liked").cast("int")).alias("like_perc"),
        F.avg("mean_percentage_watched").alias("watch_perc"),
    )


def _scored(rates: DataFrame, keys: Sequence[str], guard: str, score: str, by: Sequence[str] = (), shifted: bool = False):
    z = zscore(rates, ["like_perc", "watch_perc"], guard, by)
    like, watch = F.col("z_like_perc"), F.col("z_watch_perc")
    if shifted:
        outputs = [
            shift_to_one(like, watch).alias("normalized_like_perc_p"),
            shift_to_one(watch, like).alias("normalized_watch_perc_p"),
        ]
    else:
        outputs = [like.alias("normalized_like_perc"), watch.alias("normalized_watch_perc")]
    return z.select(*keys, *outputs, popularity_score(like, watch).alias(score))


def popular_videos(
    relation: DataFrame, as_of: datetime, days: int = 90, guard: str = "none", shifted: bool = False
) -> DataFrame:
    """Global popularity: harmonic mean of the like and watch z-scores shifted to one."""
    rates = _rates(_recent(relation, as_of, days), "video_id")
    return _scored(rates, ["video_id"], guard, "global_popularity_score", shifted=shifted)


def popular_videos_enriched(
    relation: DataFrame,
    nsfw: DataFrame,
    uploads: DataFrame,
    bots: DataFrame,
    approvals: DataFrame,
    as_of: datetime,
    days: int = 7,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Global popularity of moderated videos, with their upload type and origin flags.

    ``tie`` names further ``uploads`` columns that decide between uploads of the same time.
    """
    ranked = popular_videos(relation, as_of, days, guard="zero", shifted=True)
    moderation = nsfw.select("video_id", "is_nsfw", "nsfw_ec", "nsfw_gore", F.col("probability").alias("nsfw_probability"))
    columns = list(dict.fromkeys(["video_id", "upload_type", "timestamp", *tie]))
    uploaded = latest_per_key(uploads.select(*columns), ["video_id"], ["timestamp"], tie)
    out = ranked.join(moderation, "video_id").join(uploaded.select("video_id", "upload_type"), "video_id", "left")
    out = existence_flag(out, bots, "video_id", "is_bot_uploaded", hot=())  # a row a video: none is hot
    return existence_flag(out, approvals.where(F.col("is_approved")), "video_id", "user_uploaded_ai_content", hot=())


def local_popular_videos(
    relation: DataFrame, users: DataFrame, as_of: datetime, days: int = 7, hot: Sequence | None = None
) -> DataFrame:
    """Popularity within each viewer region (viewers of unknown region form their own).

    ``users`` has ``user_id`` and ``geo.region``; ``hot`` names users who own much of ``relation``.
    """
    regions = users.select("user_id", F.col("geo.region").alias("region"))
    pairs = _recent(relation, as_of, days).select("user_id", "video_id", "liked", "mean_percentage_watched")
    rates = _rates(skew_join(pairs, regions, "user_id", "left", hot=hot), "video_id", "region")
    return _scored(rates, ["video_id", "region"], "flat", "local_popularity_score", by=["region"])


def region_popular_videos(relation: DataFrame, uploads: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """Popularity by uploader region, standardised over the whole table.

    Within one (video, region) every watch is repeated once per upload row, which leaves the averages unchanged. So the
    watches are averaged per video first and joined to the distinct (video, region) pairs: no fan-out, and no row of a
    popular video travels more than once.
    """
    rates = _rates(_recent(relation, as_of, days).where(F.col("video_id").isNotNull()), "video_id")
    places = uploads.where(F.col("region").isNotNull() & F.col("video_id").isNotNull()).select("video_id", "region").distinct()
    joined = rates.join(places, "video_id")
    return _scored(joined, ["video_id", "region"], "flat", "within_region_popularity_score", shifted=True)

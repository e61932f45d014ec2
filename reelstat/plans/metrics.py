"""Statistics per user, per video and over all videos, with pooled incremental merges."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstat.functions.numeric import STDDEV_FLOOR, floor_at, pooled_mean, pooled_stddev, quality_score
from reelstat.functions.timex import high_watermark, since_watermark
from reelstat.operators.aggregates import flag_share, moments
from reelstat.operators.joins import join_default, single_row
from reelstat.operators.merge import Change

METRICS = ("like", "share", "watch_percentage")
UPDATED = "last_update_timestamp"
WATCHED = "last_watched_timestamp"

USER_COLUMNS = [
    "user_id",
    *[
        f"user_{prefix}{metric}_{stat}" if stat else f"total_{metric}s"
        for metric in ("like", "share")
        for prefix, stat in (("", "avg"), ("", "stddev"), ("normalized_", "avg"), ("normalized_", "stddev"), ("", ""))
    ],
    "user_watch_percentage_avg",
    "user_watch_percentage_stddev",
    "user_normalized_watch_percentage_avg",
    "user_normalized_watch_percentage_stddev",
    "total_watches",
    UPDATED,
]


def _normalized(avg: Column, stddev: Column) -> tuple[Column, Column]:
    return avg * (1 - avg), (1 - avg) * stddev


def user_video_metrics(relation: DataFrame) -> DataFrame:
    """Habits of each user: mean and deviation of likes, shares and watched share, and their damped forms."""
    liked, shared = flag_share("liked"), flag_share("shared")
    base = relation.groupBy("user_id").agg(
        *moments(liked, "user_like"),
        F.sum(liked).alias("total_likes"),
        *moments(shared, "user_share"),
        F.sum(shared).alias("total_shares"),
        *moments(F.col("mean_percentage_watched"), "user_watch_percentage"),
        F.count("mean_percentage_watched").alias("total_watches"),
        F.max(WATCHED).alias(UPDATED),
    )
    damped = {}
    for m in METRICS:
        avg, stddev = _normalized(F.col(f"user_{m}_avg"), F.col(f"user_{m}_stddev"))
        damped[f"user_normalized_{m}_avg"], damped[f"user_normalized_{m}_stddev"] = avg, stddev
    return base.withColumns(damped).select(*USER_COLUMNS)


def user_video_metrics_change(relation: DataFrame, last: datetime, fresh: bool = False, single_as_zero: bool = False) -> Change:
    """The pairs watched after ``last``, to be pooled into the user statistics.

    As published, the damped columns are computed from the averages before the merge (``fresh`` uses those after it),
    and a batch of one pair has no deviation and makes the pooled one NULL (``single_as_zero`` counts it as 0).
    """
    batch = user_video_metrics(since_watermark(relation, WATCHED, last, None))
    n1, n2 = F.col("t.total_watches"), F.col("s.total_watches")

    def deviation(side: str, m: str) -> Column:
        sd = F.col(f"{side}.user_{m}_stddev")
        single = F.col(f"{side}.total_watches") == 1
        return F.when(sd.isNull() & single, F.lit(0.0)).otherwise(sd) if single_as_zero else sd

    assignments: dict[str, str | Column] = {UPDATED: f"s.{UPDATED}", "total_watches": n1 + n2}
    for total in ("total_likes", "total_shares"):
        assignments[total] = f"t.{total} + s.{total}"
    for m in METRICS:
        a1, a2 = F.col(f"t.user_{m}_avg"), F.col(f"s.user_{m}_avg")
        avg, sd = pooled_mean(a1, n1, a2, n2), pooled_stddev(a1, deviation("t", m), n1, a2, deviation("s", m), n2)
        damped = _normalized(avg, sd) if fresh else _normalized(a1, F.col(f"t.user_{m}_stddev"))
        assignments[f"user_{m}_avg"], assignments[f"user_{m}_stddev"] = avg, sd
        assignments[f"user_normalized_{m}_avg"], assignments[f"user_normalized_{m}_stddev"] = damped
    return Change(batch, ["user_id"], assignments)


def user_video_metrics_increment(
    target: DataFrame, relation: DataFrame, fresh: bool = False, single_as_zero: bool = False
) -> DataFrame:
    """Pool the pairs watched since the last run into the user statistics."""
    last = high_watermark(target, UPDATED)
    return user_video_metrics(relation) if last is None else user_video_metrics_change(relation, last, fresh, single_as_zero).onto(target)


VIDEO_MEANS = [f"user_normalized_{m}_perc" for m in METRICS]


def weighted_reactions(relation: DataFrame, metrics: DataFrame, hot: Sequence | None = None, colocated: bool = False) -> DataFrame:
    """Each pair with its user's reactions, weighted down by how often the user reacts anyway; see ``video_statistics``."""
    averages = [f"user_{m}_avg" for m in METRICS]
    pairs = relation.select("user_id", "video_id", "liked", "shared", "mean_percentage_watched", WATCHED)
    known, defaults = metrics.select("user_id", *averages), {a: 1.0 for a in averages}
    if colocated:
        joined = pairs.join(known.hint("merge"), "user_id", "left").fillna(defaults)
    else:
        joined = join_default(pairs, known, "user_id", defaults, hot=hot)
    reactions = (F.col("liked").cast("int"), F.col("shared").cast("int"), F.col("mean_percentage_watched"))
    weighted = [((1 - F.col(a)) * x).alias(out) for a, x, out in zip(averages, reactions, VIDEO_MEANS, strict=True)]
    return joined.select("user_id", "video_id", WATCHED, *weighted)


def video_statistics(relation: DataFrame, metrics: DataFrame, hot: Sequence | None = None, colocated: bool = False) -> DataFrame:
    """Reaction to each video, each user weighted down by how often they react anyway.

    A user without metrics contributes 0. ``hot`` names users who own much of ``relation`` (None: look them up). ``colocated`` joins
    tables bucketed by user as they lie, without a shuffle; a user's rows are then in one bucket.
    """
    return weighted_reactions(relation, metrics, hot, colocated).groupBy("video_id").agg(
        *[F.avg(c).alias(c) for c in VIDEO_MEANS],
        F.count("user_id").alias("total_impressions"),
        F.max(WATCHED).alias(UPDATED),
    )


def video_statistics_change(relation: DataFrame, metrics: DataFrame, last: datetime, hot: Sequence | None = None) -> Change:
    """The pairs watched after ``last``, to be weighted into the video statistics by impressions."""
    batch = video_statistics(since_watermark(relation, WATCHED, last, None), metrics, hot)
    n1, n2 = F.col("t.total_impressions"), F.col("s.total_impressions")
    assignments: dict[str, str | Column] = {c: pooled_mean(F.col(f"t.{c}"), n1, F.col(f"s.{c}"), n2) for c in VIDEO_MEANS}
    assignments.update({"total_impressions": n1 + n2, UPDATED: f"s.{UPDATED}"})
    return Change(batch, ["video_id"], assignments)


def video_statistics_increment(
    target: DataFrame, relation: DataFrame, metrics: DataFrame, hot: Sequence | None = None
) -> DataFrame:
    """Weight the pairs watched since the last run into the video statistics by impressions."""
    last = high_watermark(target, UPDATED)
    return video_statistics(relation, metrics, hot) if last is None else video_statistics_change(relation, metrics, last, hot).onto(target)


# metric column of video_statistics, name part in the global table, name part in the normalized table
GLOBAL_NAMES = (
    ("user_normalized_like_perc", "user_normalized_likes", "like"),
    ("user_normalized_share_perc", "user_normalized_shares", "share"),
    ("user_normalized_watch_percentage_perc", "user_normalized_watch_percentage", "watch"),
)


def global_video_stats(statistics: DataFrame) -> DataFrame:
    """One row: mean and deviation over videos, each video counting once."""
    return statistics.agg(
        *[
            f(column).alias(f"global_{stat}_{name}")
            for column, name, _ in GLOBAL_NAMES
            for stat, f in (("avg", F.avg), ("stddev", F.stddev_samp))
        ],
        F.sum("total_impressions").alias("total_impressions"),
        F.max(UPDATED).alias(UPDATED),
    )


def global_video_stats_change(statistics: DataFrame, last: datetime) -> Change:
    """The videos updated after ``last``, to be pooled into the global row; without new videos it stays as it is."""
    recent = since_watermark(statistics, UPDATED, last, None).where(F.col("total_impressions").isNotNull())
    batch = global_video_stats(recent)
    n1, n2 = F.col("t.total_impressions"), F.col("s.total_impressions")
    assignments: dict[str, str | Column] = {}
    for _, name, _ in GLOBAL_NAMES:
        mean, sd = f"global_avg_{name}", f"global_stddev_{name}"
        m1, m2 = F.col(f"t.{mean}"), F.col(f"s.{mean}")
        assignments[mean] = F.coalesce(pooled_mean(m1, n1, m2, n2), m1)
        assignments[sd] = F.coalesce(pooled_stddev(m1, F.col(f"t.{sd}"), n1, m2, F.col(f"s.{sd}"), n2), F.col(f"t.{sd}"))
    assignments["total_impressions"] = F.coalesce(n1, F.lit(0)) + F.coalesce(n2, F.lit(0))
    assignments[UPDATED] = F.coalesce(F.col(f"s.{UPDATED}"), F.col(f"t.{UPDATED}"))
    return Change(batch, True, assignments)


def global_video_stats_increment(target: DataFrame, statistics: DataFrame) -> DataFrame:
    """Pool the videos updated since the last run into the global row."""
    last = high_watermark(target, UPDATED)
    return global_video_stats(statistics) if last is None else global_video_stats_change(statistics, last).onto(target)


NORMALIZED_COLUMNS = [
    "video_id",
    *[f"{m}_percentage_un" for _, _, m in GLOBAL_NAMES],
    *[f"normalized_{m}_perc" for _, _, m in GLOBAL_NAMES],
    "total_impressions",
    UPDATED,
    "ds_quality_score",
]


def _z(value: Column, mean: Column, sd: Column) -> Column:
    return (value - mean) / sd


def _with_global(statistics: DataFrame, global_stats: DataFrame) -> DataFrame:
    """Per-video values next to the global means and floored deviations, and their z-scores and quality."""
    constants = [F.col(f"global_avg_{name}").alias(f"_mean_{m}") for _, name, m in GLOBAL_NAMES]
    constants += [floor_at(F.col(f"global_stddev_{name}"), STDDEV_FLOOR).alias(f"_sd_{m}") for _, name, m in GLOBAL_NAMES]
    joined = statistics.crossJoin(F.broadcast(single_row(global_stats).select(*constants)))
    scored = joined.withColumns(
        {f"normalized_{m}_perc": _z(F.col(c), F.col(f"_mean_{m}"), F.col(f"_sd_{m}")) for c, _, m in GLOBAL_NAMES}
        | {f"{m}_percentage_un": F.col(c) for c, _, m in GLOBAL_NAMES}
    )
    return scored.withColumn("ds_quality_score", quality_score(*[F.col(f"normalized_{m}_perc") for _, _, m in GLOBAL_NAMES]))


def video_statistics_normalized(statistics: DataFrame, global_stats: DataFrame) -> DataFrame:
    """z-scores of each video against the global row and a quality score."""
    return _with_global(statistics, global_stats).select(*NORMALIZED_COLUMNS)


def video_statistics_normalized_change(statistics: DataFrame, global_stats: DataFrame, last: datetime, fresh: bool = False) -> Change:
    """The videos updated after ``last``, to be weighted into the normalized table.

    As published, the z-scores use the percentages before the merge and the quality score uses the z-scores before it;
    ``fresh`` uses the merged values throughout.
    """
    batch = _with_global(since_watermark(statistics, UPDATED, last, None), global_stats)
    names = [m for _, _, m in GLOBAL_NAMES]
    # a missing z-score is stored as 0, the quality of a new video is computed before that
    batch = batch.withColumns({f"normalized_{m}_perc": F.coalesce(f"normalized_{m}_perc", F.lit(0.0)) for m in names})
    n1, n2 = F.col("t.total_impressions"), F.col("s.total_impressions")
    assignments: dict[str, str | Column] = {"total_impressions": n1 + n2, UPDATED: f"s.{UPDATED}"}
    z_new = {}
    for m in names:
        un = f"{m}_percentage_un"
        assignments[un] = pooled_mean(F.col(f"t.{un}"), n1, F.col(f"s.{un}"), n2)
        base = assignments[un] if fresh else F.col(f"t.{un}")
        z_new[m] = F.coalesce(_z(base, F.col(f"s._mean_{m}"), F.col(f"s._sd_{m}")), F.lit(0.0))
        assignments[f"normalized_{m}_perc"] = z_new[m]
    assignments["ds_quality_score"] = quality_score(
        *[z_new[m] if fresh else F.col(f"t.normalized_{m}_perc") for m in names]
    )
    return Change(batch, ["video_id"], assignments, {c: f"s.{c}" for c in NORMALIZED_COLUMNS})


def video_statistics_normalized_increment(
    target: DataFrame, statistics: DataFrame, global_stats: DataFrame, fresh: bool = False
) -> DataFrame:
    """Weight newly updated videos into the normalized table."""
    last = high_watermark(target, UPDATED)
    if last is None:
        return video_statistics_normalized(statistics, global_stats)
    return video_statistics_normalized_change(statistics, global_stats, last, fresh).onto(target)

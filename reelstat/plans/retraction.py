"""Increments that equal a rebuild: what a pair gave before is taken back before it gives its new share.

The published increments add a pair that is watched again as if it were a new one. Here the rows of the pairs before the batch are
subtracted, as counts, sums and sums of squares, and those after it are added. Global statistics and z-scores have one row a video below them,
so they are built anew from the corrected ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstat.operators.aggregates import flag_share
from reelstat.operators.merge import Change
from reelstat.plans.metrics import METRICS, UPDATED, VIDEO_MEANS, WATCHED, _normalized, weighted_reactions

_SIGN = "_sign"
KEYS = ("user_id", "video_id")


def _both(before: DataFrame, after: DataFrame) -> DataFrame:
    return before.withColumn(_SIGN, F.lit(-1)).unionByName(after.withColumn(_SIGN, F.lit(1)))


def pairs_before(relation: DataFrame, changed: DataFrame) -> DataFrame:
    """The rows of ``relation`` of the pairs in ``changed``."""
    return relation.join(changed.select(*KEYS).distinct(), list(KEYS), "left_semi")


def _statistics(n: Column, total: Column, squares: Column) -> tuple[Column, Column]:
    """Mean and sample deviation from count, sum and sum of squares; NULL for none, and the deviation for one."""
    mean = total / F.nullif(n, F.lit(0))
    variance = F.greatest(squares - n * mean * mean, F.lit(0.0)) / F.nullif(n - 1, F.lit(0))
    return mean, F.sqrt(variance)


def user_video_metrics_change(before: DataFrame, after: DataFrame) -> Change:
    """The habits of the users in a batch, where ``after`` holds the relation's rows that the batch made or changed and ``before`` the same pairs'
    rows as they were. Merged, they equal the metrics of the whole relation after the batch; damped columns are those of the merged averages.
    """
    values = {"like": flag_share("liked"), "share": flag_share("shared"), "watch_percentage": F.col("mean_percentage_watched")}
    sign = F.col(_SIGN)
    sums = [F.sum(sign).alias("_n"), F.max(F.when(sign > 0, F.col(WATCHED))).alias(UPDATED)]
    for m, x in values.items():
        sums += [F.sum(sign * x).alias(f"_{m}_1"), F.sum(sign * x * x).alias(f"_{m}_2")]
    delta = _both(before, after).groupBy("user_id").agg(*sums)

    def columns(side: str, n0: Column, stored: bool) -> dict[str, Column]:
        n = n0 + F.col(f"{side}_n")
        out = {"total_watches": n, UPDATED: F.col(f"{side}{UPDATED}")}
        for m in METRICS:
            avg, sd = (F.col(f"t.user_{m}_{s}") if stored else F.lit(0.0) for s in ("avg", "stddev"))
            total = avg * n0 + F.col(f"{side}_{m}_1")
            squares = F.coalesce(sd * sd, F.lit(0.0)) * (n0 - 1) + n0 * avg * avg + F.col(f"{side}_{m}_2")
            mean, deviation = _statistics(n, total, squares)
            out[f"user_{m}_avg"], out[f"user_{m}_stddev"] = mean, deviation
            out[f"user_normalized_{m}_avg"], out[f"user_normalized_{m}_stddev"] = _normalized(mean, deviation)
            if m != "watch_percentage":
                out[f"total_{m}s"] = (F.col(f"t.total_{m}s") if stored else F.lit(0)) + F.col(f"{side}_{m}_1")
        return out

    fresh = columns("", F.lit(0), stored=False)
    source = delta.select("user_id", *[c for c in delta.columns if c.startswith("_")], *[c.alias(name) for name, c in fresh.items()])
    return Change(source, ["user_id"], columns("s.", F.col("t.total_watches"), stored=True))


def video_statistics_change(before: DataFrame, metrics_before: DataFrame, after: DataFrame, metrics_after: DataFrame) -> Change:
    """The reaction to the videos of a batch's users, where ``before`` and ``after`` hold ALL rows of these users in the relation as it was and as it is:
    a user's new averages weigh on every video they watched. Pairs without a user are left as they were.
    """
    known = [df.where("user_id is not null") for df in (before, after)]
    weighed = _both(weighted_reactions(known[0], metrics_before, ()), weighted_reactions(known[1], metrics_after, ()))
    sign = F.col(_SIGN)
    delta = weighed.groupBy("video_id").agg(
        F.sum(sign).alias("total_impressions"),
        F.max(F.when(sign > 0, F.col(WATCHED))).alias(UPDATED),
        *[F.sum(sign * F.col(c)).alias(f"_{c}") for c in VIDEO_MEANS],
    )
    source = delta.withColumns({c: F.col(f"_{c}") / F.nullif(F.col("total_impressions"), F.lit(0)) for c in VIDEO_MEANS})
    n = F.col("t.total_impressions") + F.col("s.total_impressions")
    assignments: dict[str, str | Column] = {
        c: (F.col(f"t.{c}") * F.col("t.total_impressions") + F.col(f"s._{c}")) / F.nullif(n, F.lit(0)) for c in VIDEO_MEANS
    }
    assignments |= {"total_impressions": n, UPDATED: F.greatest(f"t.{UPDATED}", f"s.{UPDATED}")}
    return Change(source, ["video_id"], assignments)


def rows_of_users(relation: DataFrame, users: DataFrame) -> DataFrame:
    """The rows of ``relation`` of the users in ``users``."""
    return relation.join(users.select("user_id").distinct(), "user_id", "left_semi")

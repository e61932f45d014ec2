"""Aggregations. All of them combine map-side before the shuffle, so hot groups stay cheap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstat.functions.arrays import struct_array_has


#: Registers of a sketch of distinct values, as a power of two: 4096 of them, 1.6 % standard error, 4 KB.
SKETCH_LG_K = 12


def flag_share(flag: str) -> Column:
    """Flag as 1 or 0 with NULL as 0 (unlike a cast, which keeps NULL out of an average)."""
    return F.when(F.col(flag), F.lit(1)).otherwise(F.lit(0))


def moments(x: Column, name: str) -> list[Column]:
    """Mean and sample standard deviation (NULL for a single row)."""
    return [F.avg(x).alias(f"{name}_avg"), F.stddev_samp(x).alias(f"{name}_stddev")]


def rate_by(df: DataFrame, keys: Sequence[str], flag: str, name: str) -> DataFrame:
    """Share of true values; NULL flags do not count."""
    return df.groupBy(*keys).agg(F.avg(F.col(flag).cast("int")).alias(name))


def daily_counts(df: DataFrame, ts: str, name: str) -> DataFrame:
    """Rows per UTC day and event name."""
    return df.groupBy(F.to_date(ts).alias("event_date"), F.col(name).alias("event_name")).agg(
        F.count(F.lit(1)).alias("event_count")
    )


def distinct_users(
    df: DataFrame, user: str, ts: str | None = None, by_day: bool = False, approx: bool = False, rsd: float = 0.02
) -> DataFrame:
    """Distinct users over everything or per day. Exact by de-duplicating (user, day) pairs; ``approx`` trades
    exactness for a sketch that needs no shuffle of the users."""
    keys = [F.to_date(ts).alias("event_date")] if by_day else []
    if approx:
        return df.groupBy(*keys).agg(F.approx_count_distinct(user, rsd).alias("daily_users"))
    pairs = df.select(*keys, F.col(user).alias("_user")).distinct()
    return pairs.groupBy(*(["event_date"] if by_day else [])).agg(F.count("_user").alias("daily_users"))


def daily_sketches(df: DataFrame, user: str, ts: str, lg_k: int = SKETCH_LG_K) -> DataFrame:
    """One mergeable sketch of the distinct users of each UTC day, to be kept: days that are over are not read again."""
    return df.groupBy(F.to_date(ts).alias("event_date")).agg(F.hll_sketch_agg(user, lg_k).alias("users"))


def users_over_days(sketches: DataFrame, days: int) -> DataFrame:
    """Distinct users of the ``days`` days up to each day that has a sketch, with a relative standard error of 1.04 / 2**(lg_k / 2).

    A row a day is joined to itself through the days it counts for: no event is read, and the work is days times ``days``.
    """
    ends = sketches.select("event_date").distinct()
    counts_for = sketches.select(
        "users", F.explode(F.sequence("event_date", F.date_add("event_date", days - 1))).alias("event_date")
    )
    merged = counts_for.join(ends, "event_date", "left_semi").groupBy("event_date").agg(F.hll_union_agg("users").alias("users"))
    return merged.select("event_date", F.hll_sketch_estimate("users").alias("users"))


def coverage(df: DataFrame, arr: str, name: str) -> DataFrame:
    """How many rows lack the entry ``name`` in their struct array, of how many, and the percentage."""
    missing = F.count_if(~struct_array_has(F.col(arr), name))
    total = F.count(F.lit(1))
    return df.agg(
        missing.alias("missing"),
        total.alias("total"),
        (missing * F.lit(100.0) / F.nullif(total, F.lit(0))).alias("missing_percentage"),
    )

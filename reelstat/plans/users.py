"""User facts from daily shards, and active users."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.functions.timex import on_day, parse_compact_date
from reelstat.operators.aggregates import distinct_users
from reelstat.operators.merge import Change
from reelstat.operators.windows import latest_per_key

UPDATED = "last_updated_date"
USER_LOOKBACK = timedelta(days=2)


def user_base_facts(shards: DataFrame, tie: Sequence[str] = (), drop: Sequence[str] = ()) -> DataFrame:
    """Latest row of each user over all shards, with the compact date parsed."""
    latest = latest_per_key(shards, ["user_id"], [UPDATED], tie)
    return latest.drop(*drop).withColumn(UPDATED, parse_compact_date(F.col(UPDATED)))


def user_base_facts_change(shards: DataFrame, as_of: date, tie: Sequence[str] = (), drop: Sequence[str] = ()) -> Change:
    """The users updated in the last two days, to be upserted. The compact date compares like a date, so the stored column is
    compared as it is and the condition reaches the file scan."""
    bound = (as_of - USER_LOOKBACK).strftime("%Y%m%d")
    recent = shards.where(F.col(UPDATED) >= F.lit(bound).cast(shards.schema[UPDATED].dataType))
    return Change(user_base_facts(recent, tie, drop), ["user_id"], "*")


def user_base_facts_increment(
    target: DataFrame, shards: DataFrame, as_of: date, tie: Sequence[str] = (), drop: Sequence[str] = ()
) -> DataFrame:
    """Upsert the users updated in the last two days."""
    return user_base_facts_change(shards, as_of, tie, drop).onto(target)


def daily_active_users(events: DataFrame, user: str, ts: str, day: date | datetime | None = None, approx: bool = False):
    """Distinct users per day, of one day if given."""
    return distinct_users(on_day(events, ts, day) if day else events, user, ts, by_day=True, approx=approx)

"""Events per day and name."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.functions.timex import on_day
from reelstat.operators.aggregates import daily_counts
from reelstat.operators.merge import Change
from reelstat.operators.ordering import recent_dates

KEYS = ("event_date", "event_name")


def daily_event_counts(events: DataFrame, ts: str = "timestamp", name: str = "event", n_dates: int | None = None) -> DataFrame:
    """Counts of all dates, or of the ``n_dates`` latest that occur. Counting comes first, so the list of dates and the
    restriction to it work on the small result."""
    counts = daily_counts(events, ts, name)
    if n_dates is None:
        return counts
    dates = recent_dates(counts, "event_date", n_dates)
    return counts.join(F.broadcast(dates), "event_date", "left_semi")  # at most n_dates rows


def daily_event_counts_change(events: DataFrame, day: date, ts: str = "timestamp", name: str = "event") -> Change:
    """The counts of one day, to be upserted."""
    return Change(daily_counts(on_day(events, ts, day), ts, name), KEYS, {"event_count": "s.event_count"})


def daily_event_counts_update(
    target: DataFrame, events: DataFrame, day: date, ts: str = "timestamp", name: str = "event"
) -> DataFrame:
    """Upsert the counts of one day."""
    return daily_event_counts_change(events, day, ts, name).onto(target)

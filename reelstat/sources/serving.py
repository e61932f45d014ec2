"""Keeping a serving copy of a derived table up to date.

The copy grows by appends: each sync adds a batch of rows stamped with one version time, and a reader takes the newest
version of each key. ``compact`` drops the superseded versions now and then.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstat.functions.timex import EPOCH, time_literal
from reelstat.operators.windows import latest_per_key
from reelstat.sources.snapshots import SnapshotTable

logger = logging.getLogger(__name__)
VERSION = "_updated_at"

# Overlap of each incremental sync with what was already copied (fixed values).
OVERLAPS = {
    "follower_graph": timedelta(hours=1),
    "ai_ugc": timedelta(hours=2),
    "user_video_relation": timedelta(hours=2),
    "excluded_videos": timedelta(hours=2),
    "bot_uploaded_content": timedelta(hours=6),
    "video_statistics": timedelta(hours=6),
}


class BootstrapMissing(RuntimeError):
    """The serving copy was never loaded, or holds no timestamp to continue from."""


def _version_literal(as_of: datetime) -> Column:
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp")


def stamp(df: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Add the version time, one value for the whole batch."""
    return df.withColumn(VERSION, _version_literal(as_of or datetime.now(timezone.utc)))


def current_view(df: DataFrame, keys: Sequence[str], version: str = VERSION, tie: Sequence[str] = ()) -> DataFrame:
    """Newest version of each key; among equal versions the row with the largest ``tie`` columns."""
    return latest_per_key(df, keys, [version], tie)


def append_batch(df: DataFrame, target: SnapshotTable, as_of: datetime | None = None, ts: str | None = None) -> int:
    """Stamp and append a batch and return its size.

    Size and newest ``ts`` are taken from the batch's own files. The marker keeps the newest of all batches, so no later run has to
    look for it in the ever-growing copy.
    """
    newest = F.unix_micros(F.max(F.col(ts)).cast("timestamp")) if ts else F.lit(None).cast("bigint")
    before = target.commit_info().get("newest")

    def mark(written: DataFrame) -> dict:
        rows, last = written.agg(F.count(F.lit(1)), newest).first()
        return {"newest": max([x for x in (before, last) if x is not None], default=None), "rows": rows}

    target.append(stamp(df, as_of), info=mark)
    return target.commit_info()["rows"]


def require_bootstrap(target: SnapshotTable) -> datetime:
    """Newest timestamp that was copied, from the marker; an error if the copy is missing or holds none."""
    if not target.exists() or not target.commit_info()["paths"]:
        raise BootstrapMissing("the serving copy is empty; load it in full first")
    newest = target.commit_info().get("newest")
    if newest is None:
        raise BootstrapMissing("the serving copy has no timestamp to continue from")
    return EPOCH + timedelta(microseconds=newest)


def compact(target: SnapshotTable, keys: Sequence[str], tie: Sequence[str] = ()) -> int:
    """Replace the copy by its current view: what readers see stays the same, superseded versions go. Returns the version."""
    return target.replace(current_view(target.read(), keys, tie=tie))


def changed_since(source: DataFrame, ts: str, newest: datetime, overlap: timedelta) -> DataFrame:
    """Source rows from ``newest - overlap`` on, with the bound floored to a millisecond and not before 1970."""
    millis = (newest - EPOCH) // timedelta(milliseconds=1) - overlap // timedelta(milliseconds=1)
    return source.where(F.col(ts) >= time_literal(source, ts, EPOCH + timedelta(milliseconds=max(millis, 0))))


def sync_incremental(
    source: DataFrame,
    target: SnapshotTable,
    ts: str,
    overlap: timedelta,
    as_of: datetime | None = None,
    on_error: str = "log",
) -> int | None:
    """Append the recently changed rows to the serving copy; returns how many.

    ``on_error="log"`` reports a failure and returns None (the next run's overlap catches up); ``"raise"`` re-raises.
    """
    try:
        return append_batch(changed_since(source, ts, require_bootstrap(target), overlap), target, as_of, ts)
    except Exception:
        if on_error == "raise":
            raise
        logger.exception("sync to %s failed; a later run has to catch up", target.path)
        return None


def sync_full(
    source: DataFrame, target: SnapshotTable, as_of: datetime | None = None, stamped: bool = True, on_error: str = "raise"
) -> int | None:
    """Replace the whole serving copy and return its number of rows; an empty source leaves it empty. Readers never see it half
    loaded."""
    try:
        target.replace(stamp(source, as_of) if stamped else source)
        return target.read().count()
    except Exception:
        if on_error == "raise":
            raise
        logger.exception("reload of %s failed", target.path)
        return None

"""Streaming aggregates whose changed rows are upserted into a snapshot table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reelstat.operators.windows import latest_per_key
from reelstat.sources.snapshots import SnapshotTable
from reelstat.streaming.upserts import event_time, start_merge


def daily_counts(stream: DataFrame, ts: str, name: str, lateness: str) -> DataFrame:
    """Running counts per UTC day and event name; days that end more than ``lateness`` before the newest
    row of a batch are closed after the next batch, and rows that arrive for them later do not count."""
    timed = event_time(stream, ts).withWatermark(ts, lateness)
    counted = timed.groupBy(F.window(ts, "1 day"), F.col(name).alias("event_name")).agg(F.count(F.lit(1)).alias("event_count"))
    return counted.select(F.to_date("window.start").alias("event_date"), "event_name", "event_count")


def latest_state(
    stream: DataFrame, table: SnapshotTable, checkpoint: str, keys: Sequence[str], ts: str, tie: Sequence[str] = (), **options
) -> StreamingQuery:
    """Keep the latest row per key of a stream in ``table``, ties to the largest ``tie`` columns; an older row that arrives late changes nothing.

    The stream has no state: each micro-batch is reduced to its latest rows, and merged where they are newer than those of the
    table. Rows are kept by the table alone, whose layout by key lets a merge touch few of them.
    """
    order = [ts, *tie]
    newer = F.struct(*[f"s.{c}" for c in order]) > F.struct(*[f"t.{c}" for c in order])
    values = {c: F.when(newer, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")) for c in stream.columns if c not in keys}

    def latest(batch: DataFrame) -> DataFrame:
        return latest_per_key(batch, keys, [ts], tie)

    return start_merge(stream, table, checkpoint, latest, upsert=latest, keys=keys, set=values, **options)


def upsert_changes(
    aggregate: DataFrame, table: SnapshotTable, checkpoint: str, keys: Sequence[str], **options
) -> StreamingQuery:
    """Write only the groups changed in each micro-batch (update mode) and merge them into ``table``."""
    return start_merge(
        aggregate,
        table,
        checkpoint,
        lambda batch: batch,
        upsert=lambda batch: batch,
        keys=keys,
        output_mode="update",
        **options,
    )

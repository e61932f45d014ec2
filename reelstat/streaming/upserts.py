"""Streams that keep snapshot tables up to date.

Every micro-batch is merged into the table by the same operators as a batch run. The table records the last batch it took of each
stream, so a batch replayed after a failure is skipped. ``available_now`` drains what is there and stops, which is how a
scheduled incremental run works.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reelstat.functions.timex import high_watermark, lookback
from reelstat.operators.merge import Change
from reelstat.operators.windows import latest_per_key
from reelstat.session import materialise
from reelstat.sources.snapshots import SnapshotTable


def start_merge(
    stream: DataFrame,
    table: SnapshotTable,
    checkpoint: str,
    build_initial: Callable[[DataFrame], DataFrame],
    build_increment: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
    upsert: Callable[[DataFrame], DataFrame] | None = None,
    keys: Sequence[str] = (),
    change: Callable[[DataFrame, datetime | None], Change] | None = None,
    set: str | Mapping = "*",
    available_now: bool = True,
    processing_time: str = "5 minutes",
    output_mode: str = "append",
    keep: int = 3,
) -> StreamingQuery:
    """Merge each micro-batch into ``table``: ``build_initial(batch)`` at first, then one of

    * ``upsert(batch)``, one row a key, merged by ``SnapshotTable.merge`` with the clause ``set``, which writes only what it touches;
    * ``change(batch, newest)``, what a plan changes since the table's newest time, which its marker knows; merged likewise;
    * ``build_increment(table, batch)`` as the whole new content.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        mark = (stream_id(batch, checkpoint), batch_id)
        merges = table.exists() and not table.taken(mark) and not (change is not None and table.read().isEmpty())
        if upsert is not None and merges:
            table.merge(upsert(batch), keys, set=set, insert="*", stream=mark, source_unique=True)
        elif change is not None and merges:
            table.apply(change(batch, table.newest()), mark)
        else:
            table.create_or_merge(lambda: build_initial(batch), lambda current: build_increment(current, batch), mark)
        table.vacuum(keep)

    trigger = {"availableNow": True} if available_now else {"processingTime": processing_time}
    writer = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).foreachBatch(apply).start()


def stream_id(batch: DataFrame, checkpoint: str) -> str:
    """The id a stream keeps with its checkpoint; a fresh checkpoint has a new one, and its batches count from 0 again."""
    spark = batch.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/metadata")
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())["id"]
    finally:
        stream.close()


def lookback_upsert(
    stream: DataFrame, table: SnapshotTable, checkpoint: str, keys: Sequence[str], ts: str, window: timedelta, **options
) -> StreamingQuery:
    """Upsert the latest row per key, ignoring rows more than ``window`` older than the newest seen so far.

    Rows arriving late within the window still count and the last write of a key wins. An event-time watermark would
    not do this: without a stateful operator it filters nothing. A table that keeps the bounds of ``ts`` is not scanned for its newest time.
    """

    def recent(batch: DataFrame) -> DataFrame:
        rows = materialise(batch, "batch")  # read twice below
        known = [] if not table.exists() else [table.newest()] if table.time == ts else [high_watermark(table.read(), ts)]
        marks = [m for m in (high_watermark(rows, ts), *known) if m is not None]
        return latest_per_key(lookback(rows, ts, max(marks), window) if marks else rows, keys, [ts])

    return start_merge(stream, table, checkpoint, recent, upsert=recent, keys=keys, **options)


def incremental(
    stream: DataFrame, table: SnapshotTable, checkpoint: str, build_initial: Callable, build_increment: Callable, **options
) -> StreamingQuery:
    """Any (initial, increment) pair of a plan over a stream of raw events; the table is written as a whole."""
    return start_merge(stream, table, checkpoint, build_initial, build_increment, **options)


def changes(
    stream: DataFrame, table: SnapshotTable, checkpoint: str, build_initial: Callable, change: Callable, **options
) -> StreamingQuery:
    """Any (initial, change) pair of a plan over a stream of raw events: ``change(batch, newest time)``. Watermarks come from the table's
    marker, and only touched folders are written; the table must keep the bounds of its time column."""
    return start_merge(stream, table, checkpoint, build_initial, change=change, **options)


def event_time(df: DataFrame, ts: str) -> DataFrame:
    """Zone-less timestamps as instants: event-time watermarks accept only those."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))

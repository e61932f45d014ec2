"""Ingest: raw events to a typed table that every plan reads, and the copy of the latest events to a processed table.

``typed_events`` reads each document once. The fields that the plans use become text columns of a struct, of which a plan's scan reads
only its own; the whole document is kept as VARIANT for any other. Laid out by date and appended to, the table is parsed as documents
arrive and never again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelstat.functions.jsonx import document_scalar, extract_json, json_columns_to_string, path_steps, with_document
from reelstat.functions.timex import DATE, lookback
from reelstat.operators.ordering import latest_n
from reelstat.sources.tables import append_or_create

#: The document fields that the plans read.
EVENT_FIELDS = (
    "canister_id",
    "country",
    "display_name",
    "percentage_watched",
    "post_id",
    "publisher_user_id",
    "report_reason",
    "user_id",
    "video_id",
)
FIELDS, DOCUMENT, DOCUMENT_ID = "fields", "params", "document_id"
#: How far back of the newest ingested event late ones are looked for; the longest lookback of the plans.
LATENESS = timedelta(minutes=35)


def typed_events(events: DataFrame) -> DataFrame:
    """Raw events (event, params text, timestamp) with their fields as columns, the document as VARIANT (NULL where unreadable), and a hash that
    identifies the event among those of its time."""
    paths = [f"$.{name}" for name in EVENT_FIELDS]
    parsed = with_document(events, DOCUMENT, paths, "_doc")
    fields = F.struct(*[document_scalar("_doc", path).alias(name) for path, name in zip(paths, EVENT_FIELDS, strict=True)])
    return parsed.select(
        "event", "timestamp", fields.alias(FIELDS), F.try_parse_json(DOCUMENT).alias(DOCUMENT), _document_id().alias(DOCUMENT_ID)
    )


def _document_id() -> Column:
    return F.xxhash64(F.col("event").isNull(), F.col("event"), F.col(DOCUMENT).isNull(), F.col(DOCUMENT))


def new_events(typed: DataFrame, events: DataFrame, newest: datetime, lateness: timedelta = LATENESS) -> DataFrame:
    """The raw events that ``typed`` does not hold yet, among those up to ``lateness`` older than its newest and all later ones.

    Equal events are told apart by their number, so a repeated one is taken as often as it occurs. Nothing is parsed to find them: times and
    hashes of the overlap are compared. Events without a time are taken by the first ingest only.
    """

    def numbered(df: DataFrame) -> DataFrame:
        same = Window.partitionBy("timestamp", DOCUMENT_ID).orderBy(F.lit(0))
        return df.withColumn("_copy", F.row_number().over(same))

    held = numbered(lookback(typed, "timestamp", newest, lateness).select("timestamp", DOCUMENT_ID))
    seen = numbered(lookback(events, "timestamp", newest, lateness).withColumn(DOCUMENT_ID, _document_id()))
    return seen.join(held, ["timestamp", DOCUMENT_ID, "_copy"], "left_anti").drop("_copy", DOCUMENT_ID, DATE)


def event_fields(events: DataFrame, fields: Mapping[str, str], *keep: str | Column) -> DataFrame:
    """``keep`` columns plus one text column for each entry of ``fields`` (output name to path): columns of typed events, or parsed from raw ones."""
    if FIELDS not in events.columns or not isinstance(events.schema[FIELDS].dataType, T.StructType):
        return extract_json(events, DOCUMENT, fields, *keep)
    return events.select(*[_typed(path).alias(name) for name, path in fields.items()], *keep)


def _typed(path: str) -> Column:
    steps = path_steps(path)
    if len(steps) == 1 and steps[0] in EVENT_FIELDS:
        return F.col(FIELDS)[steps[0]]
    found = F.try_variant_get(F.col(DOCUMENT), path, "variant")
    container = F.schema_of_variant(found).rlike("^(OBJECT|ARRAY)")
    return F.when(container, F.lit(None)).otherwise(F.try_variant_get(F.col(DOCUMENT), path, "string"))


def latest_events(source: DataFrame, n: int = 100, tie: Sequence[str] = ()) -> DataFrame:
    """The latest ``n`` rows with native JSON columns as text."""
    return json_columns_to_string(latest_n(source, n, tie=tie))


def latest_events_copy(source: DataFrame, table: str, n: int = 100, tie: Sequence[str] = ()) -> str:
    """Append them to ``table``, which is created on the first run; returns the write mode used."""
    return append_or_create(latest_events(source, n, tie), table)

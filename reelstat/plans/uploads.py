"""Upload tables: upload statistics, uploads by bots, AI-generated uploads."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.functions.jsonx import document_scalar, document_text, extract_json, json_query, with_document
from reelstat.functions.timex import DATE, high_watermark, lookback, parse_offset_timestamp, since_watermark
from reelstat.operators.filters import read_events, suffix_filter
from reelstat.operators.joins import skew_join
from reelstat.operators.merge import Change, new_rows
from reelstat.operators.windows import latest_per_key
from reelstat.plans.ingest import event_fields
from reelstat.session import materialise

# Event names, types and field names.
UPLOAD_SUCCESS = "video_upload_success"
UPLOAD_DONE = "video_upload_successful"
AI_VIDEO = "ai_video"
BOT_SUFFIX = "-BOT"
AI_LOOKBACK = timedelta(minutes=35)
DEVICE_FIELDS = ("device_id", "os", "user_id")
UPLOAD_FIELDS = (
    "btc_balance_e8s",
    "city",
    "country",
    "creator_commision_percentage",
    "custom_device_id",
    "device",
    "distinct_id",
    "event",
    "game_type",
    "ip",
    "ip_addr",
    "is_creator",
    "is_game_enabled",
    "is_logged_in",
    "is_nsfw_enabled",
    "principal",
    "region",
    "sats_balance",
    "user_agent",
    "video_id",
    "visitor_id",
    "upload_type",
)


def video_upload_stats(analytics: DataFrame) -> DataFrame:
    """Successful uploads with 25 text fields of the event document, read in one pass, and the parsed time."""
    fields = {name: f"$.event_data['${name}']" for name in DEVICE_FIELDS}
    fields.update({name: f"$.event_data.{name}" for name in UPLOAD_FIELDS})
    flat = extract_json(analytics, "data", {**fields, "timestamp": "$.timestamp"})
    return flat.where(F.col("event") == UPLOAD_SUCCESS).withColumn(
        "timestamp", parse_offset_timestamp(F.col("timestamp"))
    )


def parsed_uploads(analytics: DataFrame) -> DataFrame:
    """The ingest step of upload documents: read once as they arrive and kept as a table laid out by the date of ``timestamp``
    (``SnapshotTable(..., partition_ts="timestamp")``, appended to). The statistics then read only the dates they need."""
    return video_upload_stats(analytics)


def new_upload_stats(target: DataFrame, parsed: DataFrame) -> DataFrame:
    """The uploads of the ingest table after the latest of ``target`` that it does not hold yet."""
    batch = since_watermark(parsed, "timestamp", high_watermark(target, "timestamp")).drop(DATE)
    return new_rows(target, materialise(batch, "batch"), ["timestamp", "video_id"], "*")


def video_upload_stats_increment(target: DataFrame, analytics: DataFrame) -> DataFrame:
    """``target`` plus the uploads in raw documents after its latest one that it does not hold yet."""
    return target.unionByName(new_upload_stats(target, video_upload_stats(analytics)))


BOT_FIELDS = ("user_id", "publisher_user_id", "canister_id", "video_id", "post_id", "country", "display_name")


def bot_uploaded_content(events: DataFrame) -> DataFrame:
    """Uploads whose country carries the bot suffix."""
    fields = {name: f"$.{name}" for name in BOT_FIELDS}
    flat = event_fields(read_events(events, (UPLOAD_DONE,)), fields, "timestamp")
    return suffix_filter(flat, "country", BOT_SUFFIX)


def bot_content_change(events: DataFrame, last: datetime | None) -> Change:
    """The bot uploads after ``last``; those that the table does not hold yet are added."""
    return Change(bot_uploaded_content(since_watermark(events, "timestamp", last)), ["video_id", "timestamp"])


def bot_uploaded_content_increment(target: DataFrame, events: DataFrame) -> DataFrame:
    """``target`` plus the bot uploads after its latest one that it does not hold yet."""
    return bot_content_change(events, high_watermark(target, "timestamp")).onto(target)


# output name to path inside an analytics document, or inside one of its rows
AI_FIELDS = {
    "event": "$.event_data.event",
    "video_id": "$.event_data.video_id",
    "publisher_user_id": "$.event_data.publisher_user_id",
    "user_id": "$.event_data.user_id",
    "ai_canister_id": "$.event_data.canister_id",
    "event_timestamp_str": "$.timestamp",
    "event_type": "$.event_data.type",
    "type_ext": "$.event_data.type_ext",
}
AI_COLUMNS = (
    "video_id",
    "publisher_user_id",
    "user_id",
    "ai_canister_id",
    "event_timestamp_str",
    "publish_time",
    "received_timestamp",
    "event_json_data",
    "event_type",
    "type_ext",
    "upload_timestamp",
    "post_id",
    "upload_canister_id",
    "country",
    "display_name",
)


ROWS = "$.event_data.rows"


def unnest_analytics(analytics: DataFrame) -> DataFrame:
    """One row per event of the analytics documents.

    A document holds one event, or a list of rows each holding one; a field a row lacks is taken from its document.
    Each document and each row is parsed once.
    """
    docs = with_document(analytics, "data", [*AI_FIELDS.values(), ROWS], "doc")
    docs = docs.where(document_text("doc", ROWS).isNotNull() | document_text("doc", AI_FIELDS["event"]).isNotNull())
    rows = docs.select("*", F.explode_outer(F.from_json(document_text("doc", ROWS), "array<string>")).alias("row"))
    both = with_document(rows, "row", AI_FIELDS.values(), "row_doc")
    return both.select(
        *[
            F.coalesce(document_scalar("row_doc", path), document_scalar("doc", path)).alias(name)
            for name, path in AI_FIELDS.items()
        ],
        F.coalesce(json_query(F.col("row"), "$.event_data"), json_query(F.col("data"), "$.event_data")).alias("event_json_data"),
        "publish_time",
    )


def ai_ugc(analytics: DataFrame, events: DataFrame) -> DataFrame:
    """AI-generated uploads joined to the events that report the upload done.

    The uploads are stored first: looking up hot videos then reads one column of them and parses no document again.
    """
    uploads = unnest_analytics(analytics).where((F.col("event") == UPLOAD_SUCCESS) & (F.col("type_ext") == AI_VIDEO))
    uploads = uploads.withColumns(
        {"video_id": F.replace(F.col("video_id"), F.lit('"'), F.lit("")), "received_timestamp": F.col("publish_time")}
    )
    fields = {name: f"$.{name}" for name in ("video_id", "post_id", "country", "display_name")}
    done = event_fields(
        read_events(events, (UPLOAD_DONE,)), {**fields, "upload_canister_id": "$.canister_id"}, F.col("timestamp").alias("upload_timestamp")
    )
    uploads = materialise(uploads.drop("event"), "ai_uploads")
    return skew_join(uploads, done, "video_id", "inner").select(*AI_COLUMNS)


def ai_ugc_change(
    analytics: DataFrame, events: DataFrame, as_of: datetime, keep_latest: bool = False, tie: Sequence[str] = ()
) -> Change:
    """The uploads whose document and event both lie in the last 35 minutes, to be upserted.

    Several rows of one video are an error; ``keep_latest`` keeps the one with the latest upload time instead.
    """
    batch = ai_ugc(
        lookback(analytics, "publish_time", as_of, AI_LOOKBACK), lookback(events, "timestamp", as_of, AI_LOOKBACK)
    )
    if keep_latest:
        batch = latest_per_key(batch, ["video_id"], ["upload_timestamp"], tie)
    return Change(batch, ["video_id"], "*", source_unique=keep_latest)


def ai_ugc_increment(
    target: DataFrame, analytics: DataFrame, events: DataFrame, as_of: datetime, keep_latest: bool = False,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Upsert the uploads of the last 35 minutes."""
    return ai_ugc_change(analytics, events, as_of, keep_latest, tie).onto(target)

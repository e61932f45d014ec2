"""The supplied test tables seen through the engine's input schemas.

Every frame maps a whole table. Event kinds, keys and attributes come from the columns of the test tables; params and
documents are real JSON text, so the plans parse what they would parse in production.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstat.session import shared_path


AS_OF = datetime(2024, 1, 31)
SPLIT = datetime(2024, 1, 16)  # first batch: before; second: from here on
OVERLAP_END = SPLIT + timedelta(days=2)  # end of the first batch where batches overlap
SHARD_DAY = date(2000, 1, 3)
LONG_WATCH = 30.0  # value above which analytics events travel in grouped documents
AI_VALUE = 20.0
VECTOR_DIM = 64
LATE_VALUE = 20.0  # events of higher value arrive last in a stream
LATENESS = "2 days"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def before(df: DataFrame, ts: str, moment: datetime) -> DataFrame:
    return df.where(F.col(ts) < F.lit(str(moment)).cast("timestamp_ntz"))


def spread(df: DataFrame) -> DataFrame:
    """The supplied tables are one file each, which is one split: their rows are dealt out before they are parsed."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def _renamed(column: str, names: dict[str, str], other: str) -> Column:
    out = None
    for value, name in names.items():
        out = F.when(F.col(column) == value, name) if out is None else out.when(F.col(column) == value, name)
    return out.otherwise(other)


def flat_events(spark: SparkSession, sf: str) -> DataFrame:
    e = spread(table(spark, sf, "events"))
    return e.select(
        "event_id",
        "ts",
        "event_type",
        "value",
        F.col("user_id").cast("string").alias("user_id"),
        F.get_json_object("props", "$.k").alias("video_id"),
    )


def user_region(spark: SparkSession, sf: str) -> DataFrame:
    customer, nation, region = (table(spark, sf, t) for t in ("customer", "nation", "region"))
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").cast("string").alias("user_id"),
            F.col("r_name").alias("region"),
            F.when(F.col("r_regionkey") == 0, F.concat("n_name", F.lit("-BOT"))).otherwise(F.col("n_name")).alias("country"),
        )
    )


def located_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with a region and country by user. Nation and region have 25 and 5 rows at every scale."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey",
        F.col("r_name").alias("region"),
        F.when(F.col("r_regionkey") == 0, F.concat("n_name", F.lit("-BOT"))).otherwise(F.col("n_name")).alias("country"),
    )
    events = flat_events(spark, sf).withColumn("n_nationkey", (F.col("user_id").cast("bigint") % 25).cast("int"))
    return events.join(F.broadcast(places), "n_nationkey").drop("n_nationkey")


def engagement_events(spark: SparkSession, sf: str) -> DataFrame:
    """Watches, likes, shares, follows and unfollows."""
    names = {
        "view": "video_duration_watched",
        "click": "like_video",
        "purchase": "share_video",
        "signup": "mp_user_followed",
    }
    params = F.struct(
        "user_id", "video_id", F.col("value").alias("percentage_watched"), F.col("video_id").alias("publisher_user_id")
    )
    return flat_events(spark, sf).select(
        _renamed("event_type", names, "mp_user_unfollowed").alias("event"),
        F.to_json(params).alias("params"),
        F.col("ts").alias("timestamp"),
    )


def moderation_events(spark: SparkSession, sf: str) -> DataFrame:
    """Reports (errors) and bans (signups of high value)."""
    event = (
        F.when(F.col("event_type") == "error", "mp_video_reported")
        .when((F.col("event_type") == "signup") & (F.col("value") > 100), "video_report_banned")
        .otherwise(F.col("event_type"))
    )
    reason = F.when(F.col("value") > 50, "Spam").otherwise("Nudity / Porn")
    params = F.struct(
        "video_id",
        "user_id",
        F.concat(F.lit("u"), "video_id").alias("publisher_user_id"),
        F.concat(F.lit("c"), "video_id").alias("canister_id"),
        reason.alias("report_reason"),
        "country",
    )
    joined = located_events(spark, sf)
    return joined.select(event.alias("event"), F.to_json(params).alias("params"), F.col("ts").alias("timestamp"))


def upload_events(spark: SparkSession, sf: str) -> DataFrame:
    """Finished uploads (signups); each upload is a video of its own."""
    names = {"signup": "video_upload_successful"}
    params = F.struct(
        "user_id",
        F.col("user_id").alias("publisher_user_id"),
        F.concat(F.lit("c"), "video_id").alias("canister_id"),
        F.concat(F.lit("v"), "event_id").alias("video_id"),
        F.col("event_id").cast("string").alias("post_id"),
        "country",
        F.concat(F.lit("user "), "user_id").alias("display_name"),
    )
    joined = located_events(spark, sf)
    return joined.select(
        _renamed("event_type", names, "other").alias("event"), F.to_json(params).alias("params"), F.col("ts").alias("timestamp")
    )


def _document() -> Column:
    event = F.when(F.col("event_type") == "signup", "video_upload_success").otherwise(F.col("event_type"))
    data = F.struct(
        event.alias("event"),
        F.concat(F.lit("v"), "event_id").alias("video_id"),
        F.col("user_id"),
        F.col("user_id").alias("publisher_user_id"),
        F.concat(F.lit("c"), "video_id").alias("canister_id"),
        F.lit("upload").alias("type"),
        F.when(F.col("value") > AI_VALUE, "ai_video").otherwise("user_video").alias("type_ext"),
        F.concat(F.lit("d"), "user_id").alias("$device_id"),
        F.when(F.col("value") > 50, "android").otherwise("ios").alias("$os"),
        F.col("region"),
        (F.col("value") > 40).alias("is_creator"),
        F.col("event_id").alias("sats_balance"),
        F.when(F.col("value") > 10, "camera").otherwise("gallery").alias("upload_type"),
    )
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    return F.struct(data.alias("event_data"), stamp.alias("timestamp"))


def analytics_events(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of one event each, and documents listing the events of a group.

    A group holds the events of high value out of eight consecutive ids, so no document grows with the data.
    """
    joined = located_events(spark, sf)
    singles = joined.where(F.col("value") <= LONG_WATCH).select(
        F.to_json(_document()).alias("data"), F.col("ts").alias("publish_time")
    )
    groups = (
        joined.where(F.col("value") > LONG_WATCH)
        .groupBy(F.floor(F.col("event_id") / 8).alias("batch"))
        .agg(F.collect_list(_document()).alias("rows"), F.max("ts").alias("publish_time"))
        .select(F.to_json(F.struct(F.struct("rows").alias("event_data"))).alias("data"), "publish_time")
    )
    return singles.unionByName(groups)


def nsfw_agg(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "labels").select(
        F.col("doc_id").cast("string").alias("video_id"),
        (F.col("toxic") == 1).alias("is_nsfw"),
        F.when(F.col("quality") == 1, "neutral").otherwise("explicit").alias("nsfw_ec"),
        F.lit("UNKNOWN").alias("nsfw_gore"),
        F.when(F.col("toxic") == 1, F.lit(0.9)).otherwise(F.lit(0.1)).alias("probability"),
    )


def uploads_by_video(spark: SparkSession, sf: str) -> DataFrame:
    """Many uploads per video, with the uploader's region."""
    joined = located_events(spark, sf).where(F.col("event_type") == "signup")
    return joined.select(
        "video_id",
        F.col("ts").alias("timestamp"),
        "event_id",
        "region",
        "country",
        F.when(F.col("value") > 40, "ai").when(F.col("value") > 10, "camera").otherwise("gallery").alias("upload_type"),
    )


def approvals(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("video_id"),
        F.concat(F.lit("p"), "doc_id").alias("post_id"),
        F.col("source").alias("canister_id"),
        F.col("lang").alias("user_id"),
        (F.col("lang") == "en").alias("is_approved"),
    )


def user_shards(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").withColumn("user_id", F.col("o_custkey").cast("string"))
    joined = orders.join(user_region(spark, sf), "user_id", "left")
    day = F.date_format("o_orderdate", "yyyyMMdd").cast("int")
    return joined.select(
        "user_id",
        F.struct(F.col("o_orderstatus").alias("category")).alias("device"),
        F.struct("region", "country").alias("geo"),
        day.alias("occurrence_date"),
        day.alias("last_updated_date"),
        "o_orderkey",
    )


def users(spark: SparkSession, sf: str) -> DataFrame:
    return user_region(spark, sf).select("user_id", F.struct("region").alias("geo"))


def _entry(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"))


def video_objects(spark: SparkSession, sf: str) -> DataFrame:
    """Object listing of the vectors; every object carries its publisher."""
    metadata = F.array(_entry("post_id", F.col("vec_id")), _entry("publisher_user_id", F.col("label")))
    return table(spark, sf, "embeddings").select(F.concat(F.lit("vec_"), "vec_id").alias("uri"), metadata.alias("metadata"))


def video_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors with metadata: some labels lack the publisher, some the timestamp."""
    none = F.array().cast("array<struct<name:string,value:string>>")
    metadata = F.concat(
        F.array(_entry("post_id", F.col("vec_id"))),
        F.when(F.col("label") <= 6, F.array(_entry("timestamp", F.col("label") * 1000))).otherwise(none),
        F.when(F.col("label") >= 3, F.array(_entry("publisher_user_id", F.col("label")))).otherwise(none),
    )
    joined = table(spark, sf, "embeddings").join(table(spark, sf, "labels"), F.col("vec_id") == F.col("doc_id"), "left")
    return joined.select(
        F.concat(F.lit("vec_"), "vec_id").alias("uri"),
        metadata.alias("metadata"),
        F.col("embedding").alias("ml_generate_embedding_result"),
        F.when(F.col("quality") == 1, "neutral").otherwise("explicit").alias("nsfw_ec"),
        F.lit("UNKNOWN").alias("nsfw_gore"),
        F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("is_nsfw"),
    )


def video_nsfw(spark: SparkSession, sf: str) -> DataFrame:
    """Two scores per labelled object."""
    score = F.explode(F.array(F.lit("a_neutral"), F.lit("z_explicit")))
    return table(spark, sf, "labels").select(
        F.concat(F.lit("vec_"), "doc_id").alias("gcs_video_id"),
        score.alias("nsfw_ec"),
        F.when(F.col("quality") == 1, "low").otherwise("high").alias("nsfw_gore"),
        (F.col("toxic") == 1).alias("is_nsfw"),
    )


def pair_stats(spark: SparkSession, sf: str, condition: Column) -> DataFrame:
    """Values per (user, video), the two sides of the merge checks."""
    return (
        flat_events(spark, sf)
        .where(condition)
        .groupBy("user_id", "video_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("sd"),
            F.bool_or(F.col("event_type") == "click").alias("clicked"),
            F.max("ts").alias("last_ts"),
        )
    )


def stream_of(spark: SparkSession, *batches: DataFrame) -> DataFrame:
    """A stream whose micro-batches are the given tables, one file each."""
    folder = shared_path(spark, "batches")
    for k, batch in enumerate(batches):
        batch.coalesce(1).write.parquet(f"{folder}/{k:03d}")
    reader = spark.readStream.schema(batches[0].schema).option("maxFilesPerTrigger", 1)
    return reader.parquet(f"{folder}/*")


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events in two micro-batches."""
    events = table(spark, sf, "events")
    split = F.lit(str(SPLIT)).cast("timestamp_ntz")
    return stream_of(spark, events.where(F.col("ts") < split), events.where(F.col("ts") >= split))

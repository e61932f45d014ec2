"""Video embeddings, the searchable index over them, and one-off backfills."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelstat.functions.arrays import struct_array_get, struct_array_has, struct_array_put
from reelstat.operators.filters import index_eligible
from reelstat.operators.joins import drop_known, keep_known
from reelstat.operators.merge import merge
from reelstat.operators.ordering import cap
from reelstat.operators.vector_index import VectorIndex
from reelstat.operators.windows import first_per_key
from reelstat.session import bounded_batches

# Vector length and metadata names of the published pipeline.
EMBEDDING_DIM = 1408
VECTOR = "ml_generate_embedding_result"
REQUIRED_METADATA = ("timestamp", "post_id", "publisher_user_id")
INDEX_METADATA = ("post_id", "timestamp", "canister_id", "publisher_user_id")
NSFW_COLUMNS = ("nsfw_ec", "nsfw_gore", "is_nsfw")

ModelFn = Callable[[Iterator[pd.DataFrame]], Iterator[pd.Series]]


def embed(objects: DataFrame, model_fn: ModelFn, columns: Sequence[str] = ("uri",)) -> DataFrame:
    """Add the model's vector to each row.

    ``model_fn`` gets an iterator of batches of ``columns`` and yields one series of vectors per batch, so a model is
    loaded once per task. Batches are bounded by bytes, so that texts of any length are not held by the thousand.
    """
    bounded_batches(objects.sparkSession)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def infer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        yield from model_fn(batches)

    return objects.withColumn(VECTOR, infer(F.struct(*columns)))


SEGMENT = "struct<start:double,end:double,vector:array<double>>"


def embed_segments(objects: DataFrame, model_fn: ModelFn, columns: Sequence[str] = ("uri",)) -> DataFrame:
    """One row for each segment the model finds in an object: start, end and the vector.

    ``model_fn`` yields, for each batch of ``columns``, one series of lists of (start, end, vector), as many as the object has
    segments. An object without segments gives no row. Batches are bounded as in ``embed``.
    """
    bounded_batches(objects.sparkSession)

    @F.pandas_udf(f"array<{SEGMENT}>")
    def infer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for found in model_fn(batches):
            yield found.map(lambda own: [{"start": s, "end": e, "vector": v} for s, e, v in own or []])

    segments = objects.withColumn("_segment", F.explode(infer(F.struct(*columns))))
    return segments.select(*objects.columns, "_segment.start", "_segment.end", F.col("_segment.vector").alias(VECTOR))


def embed_new_videos(
    objects: DataFrame,
    nsfw: DataFrame,
    existing: DataFrame,
    model_fn: ModelFn,
    limit: int | None = None,
    columns: Sequence[str] = ("uri",),
    tasks: int | None = None,
) -> DataFrame:
    """Embeddings of moderated objects that have none yet, all of them or at most ``limit`` per run, to be appended to ``existing``."""
    new = drop_known(keep_known(objects, nsfw, "uri", "gcs_video_id", hot=()), existing, "uri", hot=())  # objects have a row a uri
    if limit is not None:
        # a limited result is one partition; inference has to be spread again
        tasks = tasks or objects.sparkSession.sparkContext.defaultParallelism
        new = cap(new, limit, "uri").repartition(tasks)
    moderation = nsfw.select(F.col("gcs_video_id").alias("uri"), "is_nsfw", "nsfw_ec", "nsfw_gore")
    return embed(new, model_fn, columns).join(moderation, "uri")


def index_rows(embeddings: DataFrame, dim: int = EMBEDDING_DIM, vec: str = VECTOR) -> DataFrame:
    """Embeddings fit for the index: right vector length and complete metadata."""
    fit = index_eligible(embeddings, vec, dim, "metadata", REQUIRED_METADATA)
    metadata = [struct_array_get(F.col("metadata"), name).alias(name) for name in INDEX_METADATA]
    return fit.select("uri", *metadata, F.col(vec).alias("embedding"), *NSFW_COLUMNS)


def update_video_index(index: DataFrame, embeddings: DataFrame, dim: int = EMBEDDING_DIM, vec: str = VECTOR) -> DataFrame:
    """``index`` plus the eligible embeddings it does not hold yet."""
    return merge(index, index_rows(embeddings, dim, vec), ["uri"], insert="*")


def update_cell_index(index: VectorIndex, embeddings: DataFrame, dim: int = EMBEDDING_DIM, vec: str = VECTOR) -> None:
    """Add the eligible embeddings that a cell index does not hold yet; its cells stay, and no file is written again."""
    index.add(index.missing(index_rows(embeddings, dim, vec)))


def backfill_nsfw(target: DataFrame, nsfw: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Set the moderation columns of every row from the first score of its object, or to ``defaults``."""
    scores = first_per_key(nsfw, ["gcs_video_id"], ["nsfw_ec"], tie=["nsfw_gore", "is_nsfw"])
    source = scores.withColumnRenamed("gcs_video_id", "uri")
    return merge(
        target, source, ["uri"], set={c: f"s.{c}" for c in NSFW_COLUMNS}, not_matched_by_source=defaults, source_unique=True
    )


EMBEDDING_DEFAULTS = {"nsfw_ec": "UNKNOWN", "nsfw_gore": "UNKNOWN", "is_nsfw": True}
INDEX_DEFAULTS = {"nsfw_ec": "", "nsfw_gore": "", "is_nsfw": False}


def backfill_metadata_key(embeddings: DataFrame, objects: DataFrame, key: str) -> DataFrame:
    """Add metadata entry ``key`` from the object listing to the embeddings that lack it."""
    lacking = embeddings.where(~struct_array_has(F.col("metadata"), key)).select("uri", "metadata")
    having = objects.where(struct_array_has(F.col("metadata"), key)).select("uri", F.col("metadata").alias("listed"))
    source = lacking.join(having, "uri").select(
        "uri", struct_array_put(F.col("metadata"), F.col("listed"), key).alias("updated_metadata")
    )
    return merge(embeddings, source, ["uri"], set={"metadata": "s.updated_metadata"})

"""Sharding by longest processing time: groups that must stay together, the largest first, go to the least-loaded shard.

There are as many groups as different texts, so one heap cannot see them all. Groups of at least a ``LARGE``-th of all bytes are
``LARGE`` at most and go to the last heap as they are. All others are dealt by hash into buckets; in each a heap deals them, the
largest first, to the bucket's ``BINS`` bins, while sorted rows stream by. Bins are then nearly equal, and the last heap, on the driver,
deals large groups and bins, the largest first, to the shards: at most ``LARGE + BUCKETS * BINS`` items, at any size of input. The
rest of a shard's load beside the others' is about one bin, a 2048th of a shard of eight.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.llm.ranking import positions
from reelstat.llm.storage import Scratch, fresh, materialise

LARGE = 1 << 15
BUCKETS, BINS = 1 << 10, 1 << 4


def longest_first(sizes: Iterable[int], bins: int) -> list[int]:
    """The bin of each size (descending): the least-loaded one at its turn, of equal ones the first."""
    heap = [(0, b) for b in range(bins)]
    out = []
    for size in sizes:
        load, b = heap[0]
        heapq.heapreplace(heap, (load + size, b))
        out.append(b)
    return out


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, weight, h1, h2), sorted by bucket and descending weight, to (h1, h2, bin, weight): a heap for each bucket."""
    now, heap = None, []
    for batch in batches:
        bins = []
        for bucket, weight in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if bucket != now:
                now, heap = bucket, [(0, b) for b in range(BINS)]
            load, b = heap[0]
            heapq.heapreplace(heap, (load + weight, b))
            bins.append(bucket * BINS + b)
        arrays = [batch.column(2), batch.column(3), pa.array(bins, pa.int64()), batch.column(1)]
        yield pa.RecordBatch.from_arrays(arrays, ["h1", "h2", "bin", "weight"])


def _last_heap(large: list, bins: list, shards: int) -> tuple[pa.Table, pa.Table]:
    """Shards of the large groups (weight, h1, h2) and of the bins (weight, bin), dealt together."""
    items = sorted([(-w, 0, h1, h2) for w, h1, h2 in large] + [(-w, 1, b, 0) for w, b in bins])
    dealt = list(zip(items, longest_first((-i[0] for i in items), shards), strict=True))
    groups = [(i[2], i[3], s) for i, s in dealt if i[1] == 0]
    small = [(i[2], s) for i, s in dealt if i[1] == 1]

    def column(rows: Sequence, k: int, kind=None) -> pa.Array:
        return pa.array([r[k] for r in rows], kind or pa.int64())

    return (
        pa.table({"h1": column(groups, 0), "h2": column(groups, 1), "shard": column(groups, 2, pa.int32())}),
        pa.table({"bin": column(small, 0), "shard": column(small, 1, pa.int32())}),
    )


def sharded(docs: DataFrame, shards: int = 8, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Every row with its ``shard`` (from 0) and its ``slot`` there (from 0, gapless); the shards' sizes are as near equal as rows of equal
    text, which stay together, allow.

    A row's size is the UTF-8 length of its text plus 1. ``keep`` names the columns to carry (default: all). A null text counts as an empty
    one, and all of these are one group. A group of more than its share of all bytes has a shard to itself as long as others are
    less loaded. Ties in size follow the text's hash. Repeated rows get slots of their own; an empty table gives an empty one.
    A carried column called ``shard`` or ``slot`` (in any case) gives way to the result's.
    """
    spark = docs.sparkSession
    carried = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("shard", "slot")]
    h1, h2, size = (fresh(n, carried) for n in ("_h1", "_h2", "_size"))
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        *[F.col(f"`{c}`") for c in carried],
        F.xxhash64(whole).alias(h1),
        F.xxhash64(F.lit(1), whole).alias(h2),
        (F.octet_length(whole).cast("long") + 1).alias(size),
    )
    with Scratch(spark) as scratch:
        rows = scratch.keep(rows, "rows")
        groups = rows.groupBy(F.col(h1).alias("h1"), F.col(h2).alias("h2")).agg(F.sum(size).alias("weight"))
        groups = scratch.keep(groups, "groups")
        total = groups.agg(F.sum("weight")).first()[0] or 0
        least = -(-total // LARGE)
        # each holds a LARGE-th of all bytes or more, so there are LARGE at most
        large = [(r.weight, r.h1, r.h2) for r in groups.where(F.col("weight") >= least).collect()]
        small = groups.where(F.col("weight") < least).select(F.pmod("h1", F.lit(BUCKETS)).alias("bucket"), "weight", "h1", "h2")
        small = small.repartition("bucket").sortWithinPartitions("bucket", F.desc("weight"), "h1", "h2")
        small = scratch.keep(small.mapInArrow(_dealt, "h1 long, h2 long, bin long, weight long"), "bins")
        bins = [(r.weight, r.bin) for r in small.groupBy("bin").agg(F.sum("weight").alias("weight")).collect()]  # BUCKETS * BINS at most
        of_groups, of_bins = (spark.createDataFrame(t) for t in _last_heap(large, bins, shards))

        # bounded as above; the rows of a large group, however many, are not shuffled, and a small one's are a LARGE-th at most
        of_small = small.join(F.broadcast(of_bins), "bin").select(F.col("h1").alias(h1), F.col("h2").alias(h2), "shard")
        of_groups = F.broadcast(of_groups.select(F.col("h1").alias(h1), F.col("h2").alias(h2), "shard"))
        placed = rows.join(of_groups, [h1, h2]).unionByName(rows.join(of_groups, [h1, h2], "left_anti").join(of_small, [h1, h2]))
        result = positions(placed.drop(h1, h2, size).sortWithinPartitions("shard"), "shard", "slot", scratch)
        return materialise(result.select(*[F.col(f"`{c}`") for c in carried], "shard", "slot"), "shards")


def write_shards(rows: DataFrame, path: str) -> None:
    """The rows of ``sharded`` as Parquet files in one folder for each shard. Every task writes its own files: a shard is never gathered."""
    rows.write.partitionBy("shard").parquet(path)

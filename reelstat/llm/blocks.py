"""Families of candidates cut into units of work, and batches streamed unit by unit."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstat.llm.storage import Scratch

BLOCK_ROWS = 1024
BLOCK_SIZE = 1 << 20


def units(members: DataFrame, size_class: Column, payload: str, into: Scratch) -> DataFrame:
    """Every member (family, node, n, payload) once for each unit of work it belongs to: (unit, node, payload).

    Only members of equal or adjacent size classes can match. A family of at most ``BLOCK_ROWS`` rows, with at most ``BLOCK_SIZE``
    as sum of n, is one unit. A larger one is cut by size class, a class into row blocks by hash, and each pair of row
    blocks of equal or adjacent classes is a unit; so a unit is bounded, and every possible pair shares one. The cuts, a row for each family, are
    kept in ``into``: their size is known then, and where they are few the members and their payload are not shuffled to meet them.
    """
    members = members.withColumn("c", size_class.cast("int"))

    def need(rows: Column, size: Column) -> Column:
        return F.greatest(F.ceil(rows / F.lit(BLOCK_ROWS)), F.ceil(size / F.lit(BLOCK_SIZE))).cast("int")

    by_class = members.groupBy("family", "c").agg(F.count("*").alias("rows"), F.sum("n").alias("size"))
    cuts = by_class.groupBy("family").agg(
        need(F.sum("rows"), F.sum("size")).alias("whole"),
        F.map_from_entries(F.collect_list(F.struct("c", need(F.col("rows"), F.col("size")).alias("m")))).alias("m"),
    )
    cuts = into.keep(cuts, "cuts")
    own = F.coalesce(F.col("m")[F.col("c")], F.lit(1))
    at = F.pmod(F.xxhash64("node"), own).cast("int")

    def unit(low: Column, high: Column, i: Column, j: Column) -> Column:
        return F.concat_ws("/", F.col("family"), low, high, i, j)

    def blocks_of(c: Column) -> Column:
        return F.when(F.col("m")[c].isNotNull(), F.sequence(F.lit(0), F.coalesce(F.col("m")[c], F.lit(1)) - 1)).otherwise(
            F.array().cast("array<int>")
        )

    c = F.col("c")
    # a block meets itself in every unit it is part of, and needs one of its own only if there is no other
    alone = (own == 1) & F.col("m")[c + 1].isNull() & F.col("m")[c - 1].isNull()
    others = F.filter(blocks_of(c), lambda j: (j != at) | alone)
    inner = F.transform(others, lambda j: unit(c, c, F.least(at, j), F.greatest(at, j)))
    above = F.transform(blocks_of(c + 1), lambda j: unit(c, c + 1, at, j))
    below = F.transform(blocks_of(c - 1), lambda j: unit(c - 1, c, j, at))
    named = F.when(F.col("whole") <= 1, F.array(F.col("family").cast("string"))).otherwise(F.concat(inner, above, below))
    return members.join(cuts, "family").select(F.explode(named).alias("unit"), "node", payload)


def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows that agree in the first column, for batches sorted by it, whole even across batches."""
    now, held = None, []
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True):
            if row[0] != now and held:
                yield held
                held = []
            now = row[0]
            held.append(row)
    if held:
        yield held


def meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, hashes, nodes) sorted by bucket: an edge (a, b) from every node to the first node of the same hash.

    Rows that meet by chance are verified like all others; ``packed`` hashes are long enough to make them few.
    """
    for rows in grouped(batches):
        h = np.concatenate([unpacked(x) for _, x, _ in rows])
        node = np.concatenate([np.frombuffer(x, np.int64) for _, _, x in rows])
        a, b, _ = stars(h, node)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def packed(h: np.ndarray) -> bytes:
    """The lowest 48 bits of hashes in six bytes each. Pairs that meet by chance grow with the square of the input, and each joins two
    families: with 32 bits within a bucket they are thousands a GB, with 48 none up to some 100 GB."""
    return h.astype(np.uint32).tobytes() + (h >> np.uint64(32)).astype(np.uint16).tobytes()


def unpacked(held: bytes) -> np.ndarray:
    n = len(held) // 6
    return np.frombuffer(held, np.uint32, n).astype(np.uint64) | np.frombuffer(held, np.uint16, n, 4 * n).astype(np.uint64) << np.uint64(32)


def stars(h, node):
    """Distinct edges from the nodes of each hash to its first node, and the places of one entry for each hash, by hash."""
    order = np.argsort(h, kind="stable")
    h, node = h[order], node[order]
    lead = np.concatenate([np.ones(min(len(h), 1), bool), h[1:] != h[:-1]])
    leader = node[np.flatnonzero(lead)[np.cumsum(lead) - 1]]
    more = ~lead & (node != leader)
    pairs = np.unique(np.stack([node[more], leader[more]]), axis=1)
    return pairs[0], pairs[1], order[lead]


def buckets_of(h, buckets: int):
    """Bounds of the buckets of ascending hashes: bucket j holds the places from bound j up to bound j + 1."""
    cuts = np.searchsorted(h, (np.arange(1, buckets, dtype=np.float64) * (2.0**64 / buckets)).astype(np.uint64))
    return np.concatenate([[0], cuts, [len(h)]])

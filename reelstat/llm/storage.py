"""Intermediate tables in the folder the cluster shares, and small fixed-size sets passed to tasks."""

from __future__ import annotations

import gc

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstat.session import bounded_batches, materialise, shared_path

__all__ = ["Scratch", "bitmap", "bounded_batches", "fresh", "in_bitmap", "materialise", "repartition_count", "shared_path"]

BITMAP_BITS = 23

class Scratch:
    """Tables written to the shared folder for the time of one computation, and deleted at its end, also if it fails.

    What an operator returns is written as a table of its own before (``result``): it reads none of the others.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []
        self.names: dict[str, str] = {}
        bounded_batches(spark)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.drop()

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = shared_path(self.spark, name)
        self.paths.append(path)
        self.names[name] = path
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def discard(self, name: str) -> None:
        """Delete the table last kept under this name."""
        path = self.names.pop(name)
        self.paths.remove(path)
        self._delete([path])

    def drop(self, keep: int = 0) -> None:
        """Delete all tables, but the newest ``keep``."""
        gone, self.paths = self.paths[: len(self.paths) - keep], self.paths[len(self.paths) - keep :]
        self._delete(gone)

    def _delete(self, gone: list[str]) -> None:
        for name in gone:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        if gone:
            self.clean()

    def clean(self) -> None:
        """Let the driver find that the shuffles of finished steps are of no more use: their files go from the executors' disks only
        when the driver's memory is cleaned, which a large heap may not need for a long time."""
        gc.collect()
        self.spark._jvm.System.gc()


def bitmap(keys: DataFrame, column: str, bits: int = BITMAP_BITS, hashed: bool = False) -> np.ndarray:
    """A bit set of fixed size (2**bits bits) with one bit for each key: a filter that may let others pass, never loses one.

    A key that is a hash already (``hashed``) takes the slot of its lowest bits, any other that of its ``xxhash64``. The set is aggregated by 64-bit words, so at most 2**(bits - 6) rows come to the driver, however many keys there are.
    """
    slot = F.col(column).bitwiseAND((1 << bits) - 1) if hashed else F.pmod(F.xxhash64(column), F.lit(1 << bits))
    found = (
        keys.select(slot.alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("held"))
    )
    out = np.zeros(1 << (bits - 6), np.int64)
    for batch in found.toArrow().to_batches():
        out[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return out.view(np.uint64)


def in_bitmap(held: np.ndarray, slot: np.ndarray) -> np.ndarray:
    """Whether each slot is set."""
    slot = slot.astype(np.uint64)
    return (held[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) > 0


def repartition_count(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def fresh(name: str, taken: list[str]) -> str:
    """``name``, with underscores before it until no column is called so."""
    while name.lower() in {c.lower() for c in taken}:
        name = f"_{name}"
    return name

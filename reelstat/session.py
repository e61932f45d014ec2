"""Session construction and the shared folder for written intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Safe on any cluster: sizes and counts stay with the cluster's own defaults.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # records the Python line of every Column call, which takes longer than planning for wide expressions
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "reelstat", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach. The cluster names it in ``spark.checkpoint.dir``; only where that is
    unset on one machine (``local`` master, as in tests) a temporary folder is made and set for the rest of the session."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="reelstat-"))
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Bytes of an Arrow batch where the session names no bound of its own: texts of any number of rows would come at once.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Bound the batches that tasks exchange with Python, unless the session does so already. It stays set: results are often read later."""
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def materialise(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors, and lets
    later steps read single columns of it."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged(df: DataFrame, name: str = "stage") -> Iterator[DataFrame]:
    """``df`` as written to the shared folder for the time of the block, and deleted after it. What is made from it has to be
    written or collected within the block."""
    path = shared_path(df.sparkSession, name)
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        place = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(place, True)

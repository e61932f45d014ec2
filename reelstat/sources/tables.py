"""Table scans and catalog writes."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_shards(spark: SparkSession, *paths: str, schema: StructType | str | None = None) -> DataFrame:
    """Union by name of all files matching the globs; columns a shard lacks are NULL. With the ``schema`` given no footer has
    to be read beforehand; without it every file's is, to merge them."""
    if schema is not None:
        return spark.read.schema(schema).parquet(*paths)
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def union_shards(*shards: DataFrame) -> DataFrame:
    """Union by name of shards at hand; columns a shard lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), shards)


def append_or_create(df: DataFrame, table: str, **options: str) -> str:
    """Append to a catalog table, or create it if absent; returns the mode used."""
    mode = "append" if df.sparkSession.catalog.tableExists(table) else "overwrite"
    df.write.mode(mode).options(**options).saveAsTable(table)
    return mode


def create_or_replace(df: DataFrame, table: str, **options: str) -> None:
    """Full rebuild of a catalog table."""
    df.write.mode("overwrite").options(**options).saveAsTable(table)


def write_by_date(df: DataFrame, path: str, ts: str, cluster: Sequence[str], mode: str = "overwrite") -> None:
    """Files partitioned by the UTC date of ``ts`` and sorted by the clustering columns within each file.

    The rebalancing exchange gathers each date into files of the advisory size: small dates do not scatter over many
    files, and a date holding much of the table is split over many tasks.
    """
    laid_out = df.withColumn("dt", F.to_date(ts)).hint("rebalance", "dt")
    laid_out.sortWithinPartitions("dt", *cluster).write.mode(mode).partitionBy("dt").parquet(path)


def create_or_merge(
    spark: SparkSession, table: str, build_initial: Callable[[], DataFrame], build_increment: Callable[[DataFrame], DataFrame]
) -> str:
    """Initial build of a catalog table when it is absent or empty, else its increment from the current content.

    A table cannot be overwritten by a query that reads it, so the new content is written beside it first.
    """
    from reelstat.session import materialise

    if spark.catalog.tableExists(table):
        current = spark.table(table)
        if not current.isEmpty():
            create_or_replace(materialise(build_increment(current), table.replace(".", "_")), table)
            return "merged"
    create_or_replace(build_initial(), table)
    return "created"

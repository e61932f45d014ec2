"""Tables bucketed by key: joins and groupings by the key read matching buckets side by side and shuffle neither side.

One shuffle when a table is written serves all later jobs. A table keeps a file for each bucket, written by one task, and is known to a
session's catalog under a name of its own; the files can be registered again by any session that knows the layout.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


class BucketedTable:
    """Rows below ``path`` by hash of ``keys`` in ``buckets`` files, each sorted by key.

    Two tables meet without a shuffle if their buckets are equally many and the join or grouping is by the same keys. All rows of a
    key lie in one bucket: choose keys of which none holds more than a bucket's share, and buckets that fit a task.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), tuple(keys), buckets
        self.name: str | None = None

    def write(self, df: DataFrame) -> BucketedTable:
        """Write ``df``, which must not read this table; the rows are dealt out by the buckets' own hash first, so there is a file for each."""
        self.drop()
        self.name = f"bucketed_{uuid.uuid4().hex}"
        dealt = df.repartition(self.buckets, *self.keys).write.bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
        dealt.format("parquet").mode("overwrite").option("path", self.path).saveAsTable(self.name)
        return self

    def register(self, schema: str) -> BucketedTable:
        """Make files that another session wrote known to this one."""
        self.drop()
        self.name = f"bucketed_{uuid.uuid4().hex}"
        keys = ", ".join(f"`{k}`" for k in self.keys)
        self.spark.sql(
            f"CREATE TABLE {self.name} ({schema}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.path}'"
        )
        return self

    def read(self) -> DataFrame:
        if self.name is None:
            raise FileNotFoundError(f"the table below {self.path} is neither written nor registered")
        return self.spark.table(self.name)

    def drop(self) -> None:
        """Forget the name; the files stay."""
        if self.name is not None:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
            self.name = None

"""Row filters shared by the plans."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstat.functions.arrays import struct_array_has, vector_has_dim
from reelstat.functions.numeric import to_double
from reelstat.functions.timex import time_literal


def read_events(
    events: DataFrame, types: Sequence[str], since: datetime | None = None, event: str = "event", ts: str = "timestamp"
) -> DataFrame:
    """Events of the given types, optionally from ``since`` on. Both conditions are plain comparisons on stored
    columns and reach the file scan."""
    out = events.where(F.col(event) == types[0]) if len(types) == 1 else events.where(F.col(event).isin(*types))
    return out.where(F.col(ts) >= time_literal(out, ts, since)) if since is not None else out


def require_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Rows in which no key is NULL."""
    return df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


def suffix_filter(df: DataFrame, column: str, suffix: str) -> DataFrame:
    """Rows whose text ends in ``suffix`` (case-sensitive)."""
    return df.where(F.col(column).endswith(suffix))


def max_value(df: DataFrame, column: str, bound: float) -> DataFrame:
    """Rows whose value, read as a number, is at most ``bound``; missing and unreadable values are dropped."""
    return df.where(to_double(F.col(column)) <= F.lit(float(bound)))


def where_array_has(df: DataFrame, arr: str, name: str, negate: bool = False) -> DataFrame:
    """Rows whose struct array has (or lacks) an entry called ``name``."""
    has = struct_array_has(F.col(arr), name)
    return df.where(~has if negate else has)


def index_eligible(df: DataFrame, vec: str, dim: int, metadata: str, names: Sequence[str]) -> DataFrame:
    """Rows with a vector of the right length and all required metadata entries."""
    conditions = [vector_has_dim(F.col(vec), dim), *(struct_array_has(F.col(metadata), n) for n in names)]
    return df.where(reduce(lambda a, b: a & b, conditions))


def run_sql(spark: SparkSession, text: str, **args: object) -> DataFrame:
    """SQL text with named parameters (``:name``), bound as literals."""
    return spark.sql(text, args=args)

"""Ordering, limits and set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, score: str, k: int, by: Sequence[str] = (), tie: Sequence[str] = ()) -> DataFrame:
    """The ``k`` rows of highest score, overall or per group; ties go to the smaller ``tie`` columns.

    Stored tables carry no order: ranking happens at read. Per group the planner limits each map task to ``k`` rows of
    a group before the shuffle.
    """
    order = [F.col(score).desc_nulls_last(), *[F.col(c) for c in tie]]
    if not by:
        return df.orderBy(*order).limit(k)
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.where(F.col("_rank") <= k).drop("_rank")


def latest_n(
    df: DataFrame, n: int = 100, order_candidates: Sequence[str] = ("timestamp", "event_timestamp"), tie: Sequence[str] = ()
) -> DataFrame:
    """The ``n`` latest rows by the first candidate column that exists, else by the first column."""
    column = next((c for c in order_candidates if c in df.columns), df.columns[0])
    return df.orderBy(F.col(column).desc(), *[F.col(c).desc() for c in tie]).limit(n)


def ordered(df: DataFrame, *cols: str) -> DataFrame:
    """Sorted output for a reader that needs an order."""
    return df.orderBy(*cols)


def recent_dates(df: DataFrame, date: str, n: int = 100) -> DataFrame:
    """The ``n`` latest distinct dates."""
    return df.select(date).distinct().orderBy(F.col(date).desc()).limit(n)


def cap(df: DataFrame, n: int, order_by: str) -> DataFrame:
    """At most ``n`` rows per run, smallest ``order_by`` first so that reruns take the same ones."""
    return df.orderBy(order_by).limit(n)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()

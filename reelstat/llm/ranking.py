"""Positions in an order over all rows, without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelstat.llm.storage import Scratch, fresh


def positions(df: DataFrame, group: str, name: str, scratch: Scratch) -> DataFrame:
    """``df`` with the place (from 0, gapless) of each row in its ``group``, which must not be null.

    ``df`` has to hold a group's rows next to each other within a partition; places follow the partitions in order. The
    rows are written once with their number in their partition, so that all later steps see the same order. What is counted is one row for each
    partition and group in it; a group's window is as long as it has partitions.
    """
    at, part, shift = fresh("_at", df.columns), fresh("_part", df.columns), fresh("_shift", df.columns)
    kept = scratch.keep(df.withColumn(at, F.monotonically_increasing_id()), "ordered")
    kept = kept.withColumn(part, F.shiftright(at, 33))
    found = kept.groupBy(part, group).agg(F.min(at).alias("first"), F.count("*").alias("rows"))
    earlier = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    shifts = found.select(part, group, (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias(shift))
    return kept.join(shifts, [part, group]).withColumn(name, F.col(at) + F.col(shift)).drop(at, part, shift)


def ranked(df: DataFrame, group: str, order: Sequence[str], name: str, scratch: Scratch) -> DataFrame:
    """``df`` with each row's rank (from 0) in its group by ``order``, nulls first; both are range-partitioned together, so a group of any
    size is spread. ``order`` should tell rows apart: equal ones meet in one partition."""
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    return positions(df.repartitionByRange(*keys).sortWithinPartitions(*keys), group, name, scratch)

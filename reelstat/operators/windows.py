"""Row selection per key and standardisation, written so that no task holds a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.functions.numeric import standardise
from reelstat.operators.joins import hold, join_group_stats


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """The row of each key that is largest in ``order_by`` (NULLs count as smallest), ties broken by ``tie``.

    The same rows as ``ROW_NUMBER() ... ORDER BY ... DESC = 1``, but as an aggregate: each map task sends one row
    per key, so a hot key does not gather in one sort.
    """
    payload = [c for c in df.columns if c not in keys]
    order = F.struct(*order_by, *tie)
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*payload), order).alias("_row"))
        .select(*[F.col(c) if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns])
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """One row per key by a non-time order (descending)."""
    return latest_per_key(df, keys, order_by, tie)


def zscore(df: DataFrame, cols: Sequence[str], guard: str, by: Sequence[str] = ()) -> DataFrame:
    """Add ``z_<col>`` for each column, standardised over the whole table or per group (NULL is a group).

    Equivalent to ``AVG/STDDEV() OVER (...)``. A window without partitioning runs in one task and one partitioned by a
    coarse key gathers whole groups; moments by aggregation plus a join do neither.
    """
    aggs = [f(c).alias(f"_{p}_{c}") for c in cols for p, f in (("mean", F.avg), ("sd", F.stddev_samp))]
    if by:
        joined = join_group_stats(hold(df), df.groupBy(*by).agg(*aggs), list(by))
    else:
        joined = hold(df).crossJoin(F.broadcast(df.agg(*aggs)))  # a global aggregate is exactly one row
    scored = {f"z_{c}": standardise(F.col(c), F.col(f"_mean_{c}"), F.col(f"_sd_{c}"), guard) for c in cols}
    return joined.withColumns(scored).drop(*[f"_{p}_{c}" for c in cols for p in ("mean", "sd")])

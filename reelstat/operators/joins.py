"""Joins with the semantics and skew behaviour the plans need."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SALTS = 64
SUPPORT = 1 / 64


def any_null(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, [c.isNull() for c in columns])


def frequent_keys(df: DataFrame, key: str, support: float = SUPPORT) -> list:
    """Every key that holds at least ``support`` of the rows of ``df`` (and possibly a few others).

    One pass over one column with a bounded number of counters, so at most ``1/support`` values reach the driver.
    """
    found = df.where(F.col(key).isNotNull()).select(key).stat.freqItems([key], support).first()[0]
    return sorted(found or [])


# Values that may differ in the last bit when a lost task is computed again, or that cannot be hashed.
_NO_SALT = (T.DoubleType, T.FloatType, T.ArrayType, T.MapType, T.StructType, T.VariantType)


def row_hash(df: DataFrame, exclude: Sequence[str] = ()) -> Column:
    """A hash of a row's stable columns. Salts must not come from floating-point results: a recomputed task could then
    send a row to another partition than before, and it would be lost or doubled."""
    stable = [f.name for f in df.schema.fields if not isinstance(f.dataType, _NO_SALT)]
    return F.xxhash64(*([c for c in stable if c not in exclude] or stable or [F.lit(0)]))


def _spread(df: DataFrame, exclude: Sequence[str], salts: int) -> Column:
    return F.pmod(row_hash(df, exclude), F.lit(salts)).cast("int")


def hold(df: DataFrame) -> DataFrame:
    """``df`` behind a one-element explode, which conditions are not pushed through.

    For a frame used twice in one plan: a condition pushed into only one of the uses would make the shuffles below them
    differ, and the whole input would be read and shuffled twice instead of the shuffle being reused.
    """
    return df.select(F.explode(F.array(F.struct(*df.columns))).alias("_held")).select("_held.*")


def skew_join(
    left: DataFrame, right: DataFrame, on: str, how: str = "left", hot: Sequence | None = None, salts: int = SALTS
) -> DataFrame:
    """Left, inner, semi or anti equi-join in which ``left`` may hold most of its rows under a few keys, or under NULL.

    Rows of frequent keys are spread over ``salts`` sub-keys and only the right-hand rows of those keys are copied
    to each sub-key. NULL keys match nothing and are spread as well. ``hot`` names the frequent keys; None looks
    them up in ``left`` (one pass over the key column), so ``left`` should be stored, or cheap to read twice.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError("skew_join supports left, inner, left_semi and left_anti joins")
    hot = frequent_keys(left, on) if hot is None else list(hot)
    key = F.col(on)
    spread_rows = key.isNull() | key.isin(*hot) if hot else key.isNull()
    salted_left = left.withColumn("_salt", F.when(spread_rows, _spread(left, [on], salts)).otherwise(F.lit(0)))
    if hot:
        copies = F.when(key.isin(*hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        salted_right = right.withColumn("_salt", F.explode(copies))
    else:
        salted_right = right.withColumn("_salt", F.lit(0))
    return salted_left.join(salted_right, [on, "_salt"], how).drop("_salt")


def join_group_stats(df: DataFrame, stats: DataFrame, keys: Sequence[str], salts: int = 32) -> DataFrame:
    """Attach one-row-per-group ``stats`` to ``df``; NULL is a group of its own.

    A group may be a third of ``df``, so the few stats rows are copied per sub-key and the groups are spread; when
    the stats turn out small at run time the adaptive planner broadcasts them instead.
    """
    renamed = stats.select(
        *[F.col(k).alias(f"_g_{k}") for k in keys], *[c for c in stats.columns if c not in keys]
    ).withColumn("_g_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    left = df.withColumn("_salt", _spread(df, keys, salts))
    condition = reduce(
        lambda a, b: a & b,
        [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys],
        F.col("_salt") == F.col("_g_salt"),
    )
    return left.join(renamed, condition).drop("_salt", "_g_salt", *[f"_g_{k}" for k in keys])


def join_default(
    left: DataFrame, right: DataFrame, on: str, defaults: Mapping[str, object], hot: Sequence | None = None
) -> DataFrame:
    """Left join that fills the named columns where the right side has no (or a NULL) value."""
    joined = skew_join(left, right, on, "left", hot=hot)
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def existence_flag(df: DataFrame, keys_df: DataFrame, on: str, name: str, hot: Sequence | None = None) -> DataFrame:
    """Boolean column telling whether the key occurs in ``keys_df``; rows of ``df`` are never multiplied. ``hot`` as in ``skew_join``, here and
    below."""
    hits = keys_df.select(on).where(F.col(on).isNotNull()).distinct().withColumn(name, F.lit(True))
    return skew_join(df, hits, on, "left", hot).withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def attach_latest(
    df: DataFrame, right: DataFrame, on: str, order_by: Sequence[str], columns: Sequence[str], hot: Sequence | None = None
) -> DataFrame:
    """Left join to the latest right-hand row of each key."""
    from reelstat.operators.windows import latest_per_key

    latest = latest_per_key(right.select(on, *{*columns, *order_by}), [on], order_by).select(on, *columns)
    return skew_join(df, latest, on, "left", hot)


def keep_known(df: DataFrame, keys_df: DataFrame, on: str, key: str | None = None, hot: Sequence | None = None) -> DataFrame:
    """``on IN (SELECT key ...)``."""
    return skew_join(df, keys_df.select(F.col(key or on).alias(on)), on, "left_semi", hot)


def drop_known(
    df: DataFrame, keys_df: DataFrame, on: str, key: str | None = None, null_aware: bool = True, hot: Sequence | None = None
) -> DataFrame:
    """``on NOT IN (SELECT key ...)``.

    Null-aware: one NULL key on the right leaves no rows, a NULL on the left qualifies only against an empty right
    side. The planner's own null-aware join would broadcast the whole right side; here it is an ordinary anti join
    plus one row of facts about the right side.
    """
    keys = keys_df.select(F.col(key or on).alias(on))
    rest = skew_join(df, keys, on, "left_anti", hot)
    if not null_aware:
        return rest
    facts = keys.agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col(on).isNull()).alias("_nulls"))
    qualifies = (F.col("_n") == 0) | ((F.col("_nulls") == 0) & F.col(on).isNotNull())
    return rest.crossJoin(F.broadcast(facts)).where(qualifies).drop("_n", "_nulls")


def single_row(df: DataFrame) -> DataFrame:
    """``df`` reduced by an aggregate to the one row it holds (none if empty); more than one row is an error.

    The result is at most one row whatever the input, so it is safe to broadcast.
    """
    row = df.agg(F.any_value(F.struct(*df.columns)).alias("r"), F.count(F.lit(1)).alias("n"))
    too_many = F.raise_error(F.lit("expected a table of a single row")).cast("boolean")
    return row.where(F.when(F.col("n") > 1, too_many).otherwise(F.col("n") == 1)).select("r.*")


def with_constants(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row table to every row."""
    return df.crossJoin(F.broadcast(single_row(one_row)))


def restrict_dates(df: DataFrame, dates: DataFrame, on: str) -> DataFrame:
    """Rows whose date is in the list."""
    return df.join(dates, on, "left_semi")

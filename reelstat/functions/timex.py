"""Time literals and bounds.

Bounds are computed on the driver and enter the plan as literals of the column's own type, so that comparisons
need no cast on the column and reach the file scan.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH = datetime(1970, 1, 1)
#: Partition column of tables laid out by date: the UTC date of the row's time. Bounds on time bound it as well.
DATE = "dt"


def time_literal(df: DataFrame, column: str, value: datetime) -> Column:
    """``value`` (UTC) as a literal of the type of ``df[column]``."""
    if value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    text = value.isoformat(sep=" ")
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return F.lit(text).cast("timestamp_ntz")
    return F.lit(text + "+00:00").cast("timestamp")


def _from_date(df: DataFrame, start: datetime) -> DataFrame:
    """``df`` without the date partitions that lie before ``start`` as a whole."""
    if DATE not in df.columns or not isinstance(df.schema[DATE].dataType, T.DateType):
        return df
    if start.tzinfo is not None:
        start = start.astimezone(timezone.utc)
    return df.where(F.col(DATE) >= F.lit(start.date().isoformat()).cast("date"))


def lookback(df: DataFrame, ts: str, as_of: datetime, interval: timedelta) -> DataFrame:
    """Rows of the last ``interval`` before ``as_of``; the lower bound is included."""
    return _from_date(df, as_of - interval).where(F.col(ts) >= time_literal(df, ts, as_of - interval))


def on_day(df: DataFrame, ts: str, day: date) -> DataFrame:
    """Rows of one UTC day, as a half-open range rather than a date function over the column."""
    start = datetime(day.year, day.month, day.day)
    if DATE in df.columns and isinstance(df.schema[DATE].dataType, T.DateType):
        df = df.where(F.col(DATE) == F.lit(day.isoformat()).cast("date"))
    return df.where(
        (F.col(ts) >= time_literal(df, ts, start)) & (F.col(ts) < time_literal(df, ts, start + timedelta(days=1)))
    )


def high_watermark(df: DataFrame, ts: str) -> datetime | None:
    """Largest timestamp in ``df`` as a naive UTC datetime (one row travels to the driver), or None."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):  # a zone-less value is read as UTC
        text = df.agg(F.max(ts).cast("string").alias("m")).first()["m"]
        return None if text is None else datetime.fromisoformat(text)
    micros = df.agg(F.unix_micros(F.max(ts)).alias("m")).first()["m"]
    return None if micros is None else EPOCH + timedelta(microseconds=micros)


def since_watermark(df: DataFrame, ts: str, watermark: datetime | None, default: datetime | None = EPOCH) -> DataFrame:
    """Rows strictly later than the watermark.

    Without a watermark the default applies; with neither, nothing qualifies (a comparison with NULL).
    """
    bound = watermark if watermark is not None else default
    if bound is None:
        return df.where(F.lit(False))
    return _from_date(df, bound).where(F.col(ts) > time_literal(df, ts, bound))


def parse_offset_timestamp(col: Column) -> Column:
    """ISO text with fraction and UTC offset to a timestamp; unreadable text gives NULL."""
    return col.try_cast("timestamp")


def parse_compact_date(col: Column) -> Column:
    """``yyyymmdd`` as text or number to a date."""
    return F.to_date(col.cast("string"), "yyyyMMdd")

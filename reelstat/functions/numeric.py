"""Numeric expressions: NULL-propagating least, guarded z-scores, pooled moments, popularity and quality scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the score definitions.
EPSILON = 1e-9
STDDEV_FLOOR = 0.01
QUALITY_OFFSET = 120
FLAT_STDDEV = 100

GUARDS = ("none", "zero", "flat")


def to_double(col: Column) -> Column:
    """Text to double; unreadable text gives NULL."""
    return col.try_cast("double")


def least_or_null(a: Column, b: Column) -> Column:
    """Smaller value, NULL if either is NULL (built-in ``least`` skips NULLs)."""
    return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b))


def floor_at(col: Column, bound: float) -> Column:
    """Raise small values to ``bound``; NULL stays NULL (built-in ``greatest`` would turn it into the bound)."""
    return F.when(col < bound, F.lit(bound)).otherwise(col)


def standardise(x: Column, mean: Column, stddev: Column, guard: str) -> Column:
    """z-score. ``none``: a zero deviation is an error; ``zero``: the score is then 0; ``flat``: the deviation
    counts as 100 when it is zero or missing."""
    if guard == "none":
        return (x - mean) / stddev
    if guard == "zero":
        return F.coalesce((x - mean) / F.nullif(stddev, F.lit(0.0)), F.lit(0.0))
    if guard == "flat":
        return (x - mean) / F.coalesce(F.nullif(stddev, F.lit(0.0)), F.lit(float(FLAT_STDDEV)))
    raise ValueError(f"guard must be one of {GUARDS}, not {guard!r}")


def shift_to_one(z: Column, other: Column) -> Column:
    """Shift a pair of z-scores so that the smaller becomes 1; returns the shifted ``z``."""
    return z - least_or_null(z, other) + 1


def popularity_score(z_like: Column, z_watch: Column) -> Column:
    """Harmonic mean of the two shifted z-scores."""
    like, watch = (shift_to_one(z_like, z_watch) + EPSILON, shift_to_one(z_watch, z_like) + EPSILON)
    return F.lit(2.0) / (F.lit(1.0) / like + F.lit(1.0) / watch)


def quality_score(like: Column, share: Column, watch: Column) -> Column:
    parts = [z + QUALITY_OFFSET for z in (like, share, watch)]
    return F.lit(3.0) * parts[0] * parts[1] * parts[2] / (parts[0] + parts[1] + parts[2])


def pooled_mean(mean1: Column, n1: Column, mean2: Column, n2: Column) -> Column:
    return (mean1 * n1 + mean2 * n2) / (n1 + n2)


def pooled_stddev(mean1: Column, sd1: Column, n1: Column, mean2: Column, sd2: Column, n2: Column) -> Column:
    """Sample standard deviation of two disjoint samples from their moments.

    Counts are taken as doubles: their product leaves the 64-bit range for large tables.
    """
    a, b = n1.cast("double"), n2.cast("double")
    between = a * b / (a + b) * F.pow(mean1 - mean2, F.lit(2.0))
    within = (a - 1) * F.pow(sd1, F.lit(2.0)) + (b - 1) * F.pow(sd2, F.lit(2.0))
    return F.sqrt((within + between) / (a + b - 1))

"""Numeric expressions that never raise: bad text becomes null, no division by zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(c: Column) -> Column:
    """Double, null where the text is not a number."""
    return c.try_cast("double")


def to_integer(c: Column) -> Column:
    """Integer, also from ``'12.0'``; null where the text is not a whole number."""
    number = c.try_cast("double")
    return F.when(number == F.floor(number), number.try_cast("int"))


def binary_flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it fails or is null."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def guarded_ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, 0.0 unless ``whole`` is positive."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def rate_per(count: Column, base: Column, per: float = 1000.0) -> Column:
    """Count per ``per`` units of ``base``, null unless ``base`` is positive."""
    return F.when(base > 0, count / (base / F.lit(per)))


def finite(c: Column) -> Column:
    """The value, null where it is NaN or infinite."""
    return F.when(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), c)


def percent_of_range(value: Column, lo: Column, hi: Column, invert: bool = False) -> Column:
    """Position in ``[lo, hi]`` as 0..100, clamped; 0 without a finite value or for an empty range."""
    value = finite(value)
    share = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (value - lo) / F.nullif(hi - lo, F.lit(0.0))))
    shown = (F.lit(1.0) - share) if invert else share
    return F.when(value.isNull() | (hi == lo), F.lit(0.0)).otherwise(shown * 100)


def score_tier(score: Column, good: float = 66.0, warn: float = 33.0) -> Column:
    """``good`` / ``warn`` / ``bad``, ``n/a`` without a finite score."""
    score = finite(score.cast("double"))
    return (
        F.when(score.isNull(), "n/a")
        .when(score >= good, "good")
        .when(score >= warn, "warn")
        .otherwise("bad")
    )

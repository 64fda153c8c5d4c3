"""Aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quantile(c: Column, p: float, accuracy: int = 1000) -> Column:
    """Mergeable quantile sketch; the returned value is one of the inputs."""
    return F.percentile_approx(c, F.lit(p), F.lit(accuracy))


def pair_correlation(a: Column, b: Column) -> Column:
    """Pearson r over rows where both are present; null when it is undefined.

    Written from sums of squares because ``corr`` divides by zero on a constant column in ANSI
    mode. They skip rows where either value is missing.
    """
    spread = F.sqrt(F.regr_sxx(a, b)) * F.sqrt(F.regr_syy(a, b))
    return F.regr_sxy(a, b) / F.nullif(spread, F.lit(0.0))


def plus_zero(c: Column) -> Column:
    """Turns ``-0.0`` into ``0.0``."""
    return c + F.lit(0.0)

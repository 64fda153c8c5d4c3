"""On which side of a line a point lies, exactly.

The sign of a difference of two products of differences is right whenever its size exceeds a bound on what
rounding can have done. Only where it does not is the sign taken from an exact sum: the six products of
coordinates are split into two doubles each, without error, and added up as a list of doubles that do
not overlap, so that the last one that is not zero has the sign of the whole. Coordinates beyond about
1e150 or products below about 1e-290 are outside the range in which products split without error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPSILON = 2.0**-53
#: Largest rounding error of the difference, as a share of the sum of the sizes of both products.
BOUND = (3 + 16 * _EPSILON) * _EPSILON
_SPLITTER = 2.0**27 + 1


def _halves(a: Column) -> tuple[Column, Column]:
    """Two doubles of half the digits whose sum is ``a``."""
    scaled = a * F.lit(_SPLITTER)
    high = scaled - (scaled - a)
    return high, a - high


def product_parts(a: Column, b: Column) -> list[Column]:
    """A product as two doubles: what rounding lost, and the rounded product."""
    rounded = a * b
    (a1, a2), (b1, b2) = _halves(a), _halves(b)
    return [a2 * b2 - (((rounded - a1 * b1) - a2 * b1) - a1 * b2), rounded]


def exact_sign(terms: Column) -> Column:
    """The sign of the exact sum of an array of doubles."""

    def carry(state: Column, part: Column) -> Column:
        # The running total takes in one more part; what rounding loses stays behind as a part of its own.
        total = state["total"] + part
        back = total - state["total"]
        lost = (state["total"] - (total - back)) + (part - back)
        return F.struct(total.alias("total"), F.concat(state["parts"], F.array(lost)).alias("parts"))

    def add(parts: Column, term: Column) -> Column:
        empty = F.array().cast("array<double>")
        taken = F.aggregate(parts, F.struct(term.alias("total"), empty.alias("parts")), carry)
        return F.concat(taken["parts"], F.array(taken["total"]))

    parts = F.aggregate(terms, F.array().cast("array<double>"), add)
    last = F.try_element_at(F.filter(parts, lambda p: p != 0), F.lit(-1))
    return F.coalesce(F.signum(last), F.lit(0.0))


def orientation(x1: Column, y1: Column, x2: Column, y2: Column, x: Column, y: Column) -> Column:
    """1 when (x, y) lies left of the line from (x1, y1) to (x2, y2), -1 right of it, 0 on it."""
    left, right = (x2 - x1) * (y - y1), (y2 - y1) * (x - x1)
    rough = left - right
    terms = F.array(
        *product_parts(x1, y2), *product_parts(-y1, x2), *product_parts(x2, y), *product_parts(-y2, x),
        *product_parts(y1, x), *product_parts(-x1, y),
    )
    sure = F.abs(rough) > F.lit(BOUND) * (F.abs(left) + F.abs(right))
    return F.when(sure, F.signum(rough)).otherwise(exact_sign(F.filter(terms, lambda t: t != 0)))

"""Values at given positions of a sorted column, without sorting it.

A histogram tells in which bin a position falls, and how many values lie below that bin; the next pass looks
at that bin alone. The first bins are steps of the logarithm, so that values of any size part, all later
ones have equal widths between the smallest and the largest value that was found. Both orders of bins
follow the order of the values, even where rounding shifts a border, so the result is exact. A pass at least
parts the smallest from the largest value of a bin, and it ends for a position when both are the same; a few
passes do, whether the values are all different or one fills the column.

Each pass reads the values where they lie and shuffles partial counts of bins only: no row moves, and a group
with most of the rows costs each task no more than its bins.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from areascore.functions import finite
from areascore.scratch import materialize

BINS = 1 << 16


def _step(value: Column) -> Column:
    """Half powers of two, from the most negative to the largest."""
    size = F.floor((F.log2(F.abs(value)) + 1075) * 2) + 1
    return F.when(value > 0, size).when(value < 0, -size).otherwise(0).cast("long")


def _bin(value: Column, lo: Column, hi: Column, bins: int) -> Column:
    return F.least(F.floor((value - lo) / (hi - lo) * bins), F.lit(bins - 1)).cast("long")


def _bins_of(met: DataFrame, keys: Sequence[str], number: Column) -> DataFrame:
    """``(keys, n, least, most, up_to)``: the values in each bin and those in all bins up to it."""
    value = F.col("value")
    counted = met.groupBy(*keys, number.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.min(value).alias("least"), F.max(value).alias("most")
    )
    # At most as many rows as bins in a window.
    return counted.withColumn("up_to", F.sum("n").over(Window.partitionBy(*keys).orderBy("bin")))


def _first_bins(values: DataFrame, positions: Callable[[Column], Column], group: str) -> DataFrame:
    """``(group, label, at, below, lo, hi)``: each position with the bounds of its bin and the values below it."""
    placed = _bins_of(values, [group], _step(F.col("value")))
    sizes = placed.groupBy(group).agg(F.max("up_to").alias("size"))
    targets = sizes.select(F.col(group).alias("_group"), F.explode(positions(F.col("size"))).alias("p"))
    targets = targets.select("_group", "p.label", F.col("p.at").cast("long").alias("at"))
    below = F.col("up_to") - F.col("n")
    holds = (F.col(group) == F.col("_group")) & (F.col("at") >= below) & (F.col("at") < F.col("up_to"))
    return placed.join(targets, holds).select(
        group, "label", "at", below.alias("below"), F.col("least").alias("lo"), F.col("most").alias("hi")
    )


def _narrowed(values: DataFrame, targets: DataFrame, group: str, bins: int) -> DataFrame:
    """``targets`` with the bounds of the bins that hold them."""
    # One row for each range that a target is still in, and ranges do not overlap: a row meets one at most.
    ranges = targets.filter("lo < hi").select(F.col(group).alias("_group"), "lo", "hi").distinct()
    value = F.col("value")
    met = values.join(F.broadcast(ranges), (F.col(group) == F.col("_group")) & value.between(F.col("lo"), F.col("hi")))
    placed = _bins_of(met, ["_group", "lo", "hi"], _bin(value, F.col("lo"), F.col("hi"), bins))
    placed = placed.withColumnsRenamed({"lo": "_lo", "hi": "_hi"})
    at = F.col("at") - F.col("below")
    same = (F.col(group) == F.col("_group")) & (F.col("lo") == F.col("_lo")) & (F.col("hi") == F.col("_hi"))
    held = targets.join(placed, same & (at < F.col("up_to")) & (at >= F.col("up_to") - F.col("n")), "left")
    return held.select(
        group,
        "label",
        "at",
        F.coalesce(F.col("below") + F.col("up_to") - F.col("n"), F.col("below")).alias("below"),
        F.coalesce("least", "lo").alias("lo"),
        F.coalesce("most", "hi").alias("hi"),
    )


def values_at(
    long: DataFrame, positions: Callable[[Column], Column], group: str = "metric", bins: int = BINS
) -> DataFrame:
    """``(group, label, value)``: for each group, the finite values at some positions of their order.

    ``positions`` makes from the number of values an array of ``struct(label, at)``, ``at`` counted from 0;
    a few for each group, as they are sent to every task. Nulls, NaN and infinities have no position. A
    group without values has no rows.
    """
    values = long.select(group, finite(F.col("value").cast("double")).alias("value")).filter("value is not null")
    values = values.withColumn("value", F.col("value") + F.lit(0.0))  # -0.0 is 0.0
    targets = _first_bins(values, positions, group)
    while True:
        seen = Observation()
        targets = materialize(targets.observe(seen, F.count_if(F.col("lo") < F.col("hi")).alias("open")), "positions")
        if not seen.get["open"]:
            return targets.select(group, "label", F.col("lo").alias("value"))
        targets = _narrowed(values, targets, group, bins)


def exact_quantiles(long: DataFrame, shares: Sequence[float], group: str = "metric") -> DataFrame:
    """``(group, share, value)``: the smallest value that at least that share of a group's values does not exceed."""

    def positions(n: Column) -> Column:
        return F.array(
            *[F.struct(F.lit(p).alias("label"), F.greatest(F.ceil(F.lit(p) * n) - 1, F.lit(0)).alias("at")) for p in shares]
        )

    return values_at(long, positions, group).withColumnRenamed("label", "share")

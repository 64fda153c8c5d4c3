"""Tables behind the map and the dashboard."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areascore.functions import finite, percent_of_range, score_tier
from areascore.operators.order_statistics import values_at
from areascore.operators.scoring import attach_row


def quantile_breaks(long: DataFrame, key: str | None = None, n: int = 7) -> DataFrame:
    """``(metric, break_index, break_value)``: the ``n - 1`` class breaks of each metric.

    Break ``i`` is the sorted value at position ``floor(i / n * count)``, counted from 0. Rows are
    not sorted, so ``key`` has no say any more; callers may still name it.
    """

    def positions(count: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.lit(n - 1)),
            lambda i: F.struct(i.alias("label"), F.least(F.floor(i / F.lit(float(n)) * count), count - 1).alias("at")),
        )

    return values_at(long, positions).withColumnsRenamed({"label": "break_index", "value": "break_value"})


def choropleth_class(long: DataFrame, breaks: DataFrame) -> DataFrame:
    """Adds ``class_index``: how many breaks of its metric lie below the value; null unless it is finite."""
    # n - 1 breaks per metric, one row per metric.
    per_metric = breaks.groupBy("metric").agg(F.collect_list("break_value").alias("_breaks"))
    return (
        long.join(F.broadcast(per_metric), "metric", "left")
        .withColumn(
            "class_index",
            F.when(
                finite(F.col("value")).isNotNull(),
                F.size(F.filter("_breaks", lambda b: F.col("value") > b)).cast("int"),
            ),
        )
        .drop("_breaks")
    )


def metric_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(metric, lo, hi)`` per column; finite values only, 0..1 for a column without any."""
    extremes = []
    for name in columns:
        value = finite(F.col(name).cast("double"))
        extremes += [F.min(value).alias(f"lo_{name}"), F.max(value).alias(f"hi_{name}")]
    rows = [
        F.struct(
            F.lit(name).alias("metric"),
            F.coalesce(f"lo_{name}", F.lit(0.0)).alias("lo"),
            F.coalesce(f"hi_{name}", F.lit(1.0)).alias("hi"),
        )
        for name in columns
    ]
    return df.agg(*extremes).select(F.inline(F.array(*rows)))


def add_percent_of_range(
    df: DataFrame, inverted: Mapping[str, bool], suffix: str = "_pct"
) -> DataFrame:
    """Adds ``<column>_pct``, the bar length of each column; ``True`` turns the bar round.

    Reads ``df`` twice: once for the ranges, as a scalar subquery, and once for the rows.
    """
    extremes = []
    for name in inverted:
        value = finite(F.col(name).cast("double"))
        extremes += [
            F.coalesce(F.min(value), F.lit(0.0)).alias(f"lo_{name}"),
            F.coalesce(F.max(value), F.lit(1.0)).alias(f"hi_{name}"),
        ]
    ranges = df.agg(*extremes)
    bars = {
        f"{name}{suffix}": percent_of_range(
            F.col(name).cast("double"), F.col(f"lo_{name}"), F.col(f"hi_{name}"), invert
        )
        for name, invert in inverted.items()
    }
    return attach_row(df, ranges).withColumns(bars).drop(*ranges.columns)


def add_score_tier(df: DataFrame, score: str, tier: str = "tier") -> DataFrame:
    """Adds the colour tier of a 0–100 score."""
    return df.withColumn(tier, score_tier(F.col(score)))


def polygon_attributes(features: DataFrame, scores: DataFrame, code: str, name: str) -> DataFrame:
    """Every polygon with the scores of its area, null where there are none.

    ``features`` comes from ``sources.read_features`` with the map's aliases.
    """
    areas = features.select("ord", F.col("area_code").alias(code), F.col("area_name").alias(name))
    return areas.join(scores.drop(name), code, "left")


def group_order(boxes: DataFrame, directions: DataFrame, group: str) -> DataFrame:
    """``(metric, group, median, position)``: groups from best to worst median, null last.

    Works on box statistics, one row per metric and group.
    """
    signed = boxes.join(F.broadcast(directions), "metric").withColumn(
        "_goodness", F.when(F.col("higher_is_better"), F.col("median")).otherwise(-F.col("median"))
    )
    window = Window.partitionBy("metric").orderBy(F.desc_nulls_last("_goodness"), F.asc(group))
    return signed.select(
        "metric", group, "median", F.row_number().over(window).alias("position")
    )


def pivot_matrix(long: DataFrame, row: str, column: str, value: str, names: Sequence[str]) -> DataFrame:
    """Long cells as a square matrix: one row per name, one column per name, in the given order."""
    order = F.create_map(*[part for i, n in enumerate(names) for part in (F.lit(n), F.lit(i))])
    return (
        long.filter(F.col(row).isin(*names))
        .groupBy(row)
        .pivot(column, list(names))
        .agg(F.first(value))
        .withColumn("position", F.try_element_at(order, F.col(row)))
        .select("position", row, *names)
    )


def ols_line(fits: DataFrame) -> DataFrame:
    """``(feature, x, y)``: both end points of each fitted line."""
    ends = F.array(
        *[
            F.struct(
                F.col(end).alias("x"),
                (F.col("slope") * F.col(end) + F.col("intercept")).alias("y"),
            )
            for end in ("x_min", "x_max")
        ]
    )
    return fits.filter(F.col("x_min").isNotNull() & F.col("x_max").isNotNull()).select(
        "feature", F.inline(ends)
    )


def summary_strip(summary: DataFrame, count: str = "n_areas") -> DataFrame:
    """Header cards of the dashboard: count, median and range per metric."""
    return summary.select("metric", "label", "unit", count, "median", "min", "max")

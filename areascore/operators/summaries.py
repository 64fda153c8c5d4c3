"""Result tables over scored areas: summaries, histograms, boxes, correlations, fits.

Per-metric tables start from one long frame ``(metric, …, value)`` (``reshape.long_metrics``)
instead of one query per metric.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areascore.functions import finite, pair_correlation, quantile
from areascore.operators.ranking import global_rank, ntile_of


@dataclass(frozen=True)
class Metric:
    """A displayed metric."""

    key: str
    column: str
    label: str
    unit: str
    higher_is_better: bool


def metric_table(spark: SparkSession, metrics: Sequence[Metric]) -> DataFrame:
    """Metric metadata as a frame, one row per metric."""
    rows = [
        F.struct(
            F.lit(m.key).alias("metric"),
            F.lit(m.column).alias("column"),
            F.lit(m.label).alias("label"),
            F.lit(m.unit).alias("unit"),
            F.lit(m.higher_is_better).alias("higher_is_better"),
        )
        for m in metrics
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*rows)))


def metric_map(metrics: Sequence[Metric]) -> dict[str, str]:
    """Metric key -> column."""
    return {m.key: m.column for m in metrics}


def metric_summary(
    long: DataFrame, metadata: DataFrame, accuracy: int = 1000, count: str = "n_areas"
) -> DataFrame:
    """Mean, median, range, population deviation and count per metric, with its metadata.

    A metric without values keeps its row, with nulls and a zero count; NaN and infinities are no values.
    """
    stats = _known(long).groupBy("metric").agg(
        F.avg("value").alias("mean"),
        quantile(F.col("value"), 0.5, accuracy).alias("median"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.stddev_pop("value").alias("std"),
        F.count("value").alias(count),
    )
    return metadata.join(stats, "metric", "left").fillna(0, subset=[count])


def _known(long: DataFrame) -> DataFrame:
    """Rows with a finite value."""
    return long.filter(finite(F.col("value").cast("double")).isNotNull())


def metric_bounds(long: DataFrame) -> DataFrame:
    """``(metric, lo, hi, n)`` of the finite values."""
    return _known(long).groupBy("metric").agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"), F.count("value").alias("n")
    )


def histogram(long: DataFrame, bins: int = 24, dense: bool = False) -> DataFrame:
    """``(metric, bin_center, bin_lo, bin_hi, count)`` in equal-width bins.

    The top edge belongs to the last bin. Empty bins are left out unless ``dense``.
    A metric with a single value gives one bin of width zero. NaN and infinities are in no bin.
    """
    long = _known(long)
    # One row per metric.
    bounds = F.broadcast(metric_bounds(long).withColumn("width", (F.col("hi") - F.col("lo")) / bins))
    spread = F.col("hi") > F.col("lo")
    index = F.least(
        F.lit(bins - 1),
        F.floor((F.col("value") - F.col("lo")) / F.nullif(F.col("width"), F.lit(0.0))),
    )
    counted = (
        long.join(bounds, "metric")
        .withColumn("bin", F.when(spread, index).otherwise(F.lit(0)).cast("int"))
        .groupBy("metric", "bin", "lo", "hi", "width")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    if dense:
        last = F.when(spread, F.lit(bins - 1)).otherwise(F.lit(0))
        frame = bounds.select(
            "metric", "lo", "hi", "width", F.explode(F.sequence(F.lit(0), last)).alias("bin")
        )
        counted = frame.join(
            counted.select("metric", "bin", "count"), ["metric", "bin"], "left"
        ).fillna(0, subset=["count"])
    lo = F.col("lo") + F.col("bin") * F.col("width")
    hi = F.when(spread, F.col("lo") + (F.col("bin") + 1) * F.col("width")).otherwise(F.col("hi"))
    edges = counted.withColumn("bin_lo", lo).withColumn("bin_hi", hi)
    return edges.select(
        "metric",
        ((F.col("bin_lo") + F.col("bin_hi")) / 2).alias("bin_center"),
        "bin_lo",
        "bin_hi",
        "count",
    )


def box_stats(long: DataFrame, group: str, accuracy: int = 1000) -> DataFrame:
    """Quartiles and whiskers per metric and group; whiskers end within the data."""
    quartiles = F.percentile_approx("value", F.array(*map(F.lit, (0.25, 0.5, 0.75))), F.lit(accuracy))
    stats = (
        long.groupBy("metric", group)
        .agg(quartiles.alias("q"), F.min("value").alias("lo"), F.max("value").alias("hi"))
        .select(
            "metric",
            group,
            F.get("q", F.lit(0)).alias("q1"),
            F.get("q", F.lit(1)).alias("median"),
            F.get("q", F.lit(2)).alias("q3"),
            "lo",
            "hi",
        )
    )
    reach = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    return stats.select(
        "metric",
        group,
        "q1",
        "median",
        "q3",
        F.greatest(F.col("lo"), F.col("q1") - reach).alias("lowerfence"),
        F.least(F.col("hi"), F.col("q3") + reach).alias("upperfence"),
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature_row, feature_col, r)`` for all ordered pairs, in one pass over ``df``.

    Each pair uses the rows where both values are present. The diagonal is 1; r is NaN
    where it is undefined.
    """
    names = list(columns)
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1, len(names))]
    one_pass = df.agg(
        *[
            pair_correlation(F.col(names[i]).cast("double"), F.col(names[j]).cast("double")).alias(
                f"r_{i}_{j}"
            )
            for i, j in pairs
        ]
    )
    cells = []
    for i, row in enumerate(names):
        for j, column in enumerate(names):
            r = F.lit(1.0)
            if i != j:
                r = F.coalesce(F.col(f"r_{min(i, j)}_{max(i, j)}"), F.lit(float("nan")))
            cells.append(
                F.struct(
                    F.lit(row).alias("feature_row"), F.lit(column).alias("feature_col"), r.alias("r")
                )
            )
    return one_pass.select(F.inline(F.array(*cells)))


def xy_points(df: DataFrame, predictors: Sequence[str], y: str, ids: Sequence[str]) -> DataFrame:
    """``(feature, ids…, x, y)`` for every predictor, rows with both values only."""
    wide = df.filter(F.col(y).isNotNull()).select(
        *ids,
        F.col(y).cast("double").alias("y"),
        *[F.col(name).cast("double").alias(f"x_{name}") for name in predictors],
    )
    long = wide.unpivot([*ids, "y"], [f"x_{name}" for name in predictors], "feature", "x")
    return long.filter(F.col("x").isNotNull()).select(
        F.expr("substring(feature, 3)").alias("feature"), *ids, "x", "y"
    )


def decile_bins(
    points: DataFrame,
    key: str,
    k: int = 10,
    accuracy: int = 1000,
    outcome: str = "rent",
    count: str = "n_areas",
    pieces: int | None = None,
) -> DataFrame:
    """Median x and quartiles of y in ``k`` equal-count bins of x, per feature; ties go by key."""
    order = [F.asc("x"), F.asc(key)]
    ranked = global_rank(points.select("feature", key, "x", "y"), "feature", order, pieces=pieces)
    binned = ranked.withColumn("bin_index", ntile_of(F.col("rn"), F.col("n"), k))
    return binned.groupBy("feature", "bin_index").agg(
        quantile(F.col("x"), 0.5, accuracy).alias("x_mid"),
        quantile(F.col("y"), 0.5, accuracy).alias(f"{outcome}_median"),
        quantile(F.col("y"), 0.25, accuracy).alias(f"{outcome}_q1"),
        quantile(F.col("y"), 0.75, accuracy).alias(f"{outcome}_q3"),
        F.count(F.lit(1)).alias(count),
    )


def ols_fit(points: DataFrame, accuracy: int = 1000) -> DataFrame:
    """Least-squares line of y on x per feature, from moments.

    Slope 0 when x does not vary; r is NaN when undefined.
    """
    nan = F.lit(float("nan"))
    moments = points.groupBy("feature").agg(
        F.avg("x").alias("mx"),
        F.avg("y").alias("my"),
        F.stddev_pop("x").alias("sx"),
        F.stddev_pop("y").alias("sy"),
        F.covar_pop("x", "y").alias("cov"),
        F.min("x").alias("x_min"),
        F.max("x").alias("x_max"),
        quantile(F.col("x"), 0.5, accuracy).alias("x_example_median"),
    )
    r = F.coalesce(F.col("cov") / F.nullif(F.col("sx") * F.col("sy"), F.lit(0.0)), nan)
    slope = F.when(F.col("sx") == 0, F.lit(0.0)).otherwise(
        F.col("pearson_r") * F.col("sy") / F.nullif(F.col("sx"), F.lit(0.0))
    )
    return (
        moments.withColumn("pearson_r", r)
        .withColumn("slope", slope)
        .withColumn("intercept", F.col("my") - F.col("slope") * F.col("mx"))
        .select(
            "feature",
            "slope",
            "intercept",
            "pearson_r",
            (F.col("pearson_r") * F.col("pearson_r")).alias("r2"),
            "x_min",
            "x_max",
            "x_example_median",
            (F.col("slope") * F.col("x_example_median") + F.col("intercept")).alias(
                "y_example_predicted"
            ),
        )
    )

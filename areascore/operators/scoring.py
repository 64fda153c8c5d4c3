"""Z-scores, sub-scores, weighted composite, gate and 0–100 rescale.

Whole-column statistics enter as one scalar subquery: Spark computes it first and hands every task
the values, without a join and without a trip through Python. The input is read
twice, so hand in a table, or a frame that ``scratch.materialize`` has written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from areascore.functions import finite, plus_zero


@dataclass(frozen=True)
class ScoreSpec:
    """What is scored and how.

    directions  feature -> +1 (higher is better) or -1
    subscores   sub-score -> features whose z-scores it averages
    weights     sub-score -> weight in the composite
    gate_measure, gate_count, gate_min
                an area without the measure and with fewer than ``gate_min`` counts gets no score
    """

    directions: Mapping[str, int]
    subscores: Mapping[str, Sequence[str]]
    weights: Mapping[str, float]
    gate_measure: str
    gate_count: str
    gate_min: int
    composite: str = "score"
    available: str = "score_available"
    rescaled: str = "score_100"


def column_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with mean ``mu_<c>`` and population deviation ``sd_<c>`` of each column."""
    aggregates = []
    for name in columns:
        value = F.col(name).cast("double")
        aggregates += [F.avg(value).alias(f"mu_{name}"), F.stddev_pop(value).alias(f"sd_{name}")]
    return df.agg(*aggregates)


def attach_row(df: DataFrame, row: DataFrame) -> DataFrame:
    """Adds the columns of a one-row frame, such as global aggregates, to every row.

    The row is a scalar subquery unpacked by a generator. Used directly, each mention of
    a statistic would plan its own copy of the subquery.
    """
    packed = row.select(F.struct(*row.columns).alias("row")).scalar()
    return df.select("*", F.inline(F.array(packed)))


def add_zscores(
    df: DataFrame, directions: Mapping[str, int], stats: DataFrame | None = None
) -> DataFrame:
    """Adds ``z_<feature>``: mean-imputed, signed so that higher is better.

    A feature without spread, or without any value, scores 0 everywhere.
    """
    if stats is None:
        stats = column_stats(df, list(directions))
    zscores = {}
    for name, direction in directions.items():
        mean, spread = F.col(f"mu_{name}"), F.col(f"sd_{name}")
        base = F.coalesce(F.col(name).cast("double"), mean)
        flat = spread.isNull() | F.isnan(spread) | (spread == 0)
        z = (base - mean) / F.nullif(spread, F.lit(0.0)) * F.lit(float(direction))
        zscores[f"z_{name}"] = plus_zero(F.when(flat, F.lit(0.0)).otherwise(z))
    return attach_row(df, stats).withColumns(zscores).drop(*stats.columns)


def add_subscores(df: DataFrame, subscores: Mapping[str, Sequence[str]]) -> DataFrame:
    """Adds each sub-score, the mean of its features' z-scores."""
    means = {}
    for name, features in subscores.items():
        total = F.col(f"z_{features[0]}")
        for feature in features[1:]:
            total = total + F.col(f"z_{feature}")
        means[name] = total / F.lit(float(len(features)))
    return df.withColumns(means)


def add_composite(df: DataFrame, weights: Mapping[str, float], composite: str) -> DataFrame:
    """Adds the weighted sum of the sub-scores."""
    total = None
    for name, weight in weights.items():
        term = F.lit(weight) * F.col(name)
        total = term if total is None else total + term
    return df.withColumn(composite, total)


def gate_scores(df: DataFrame, spec: ScoreSpec) -> DataFrame:
    """Takes the score from areas with too little data, before any rescale sees it."""
    count = F.col(spec.gate_count)
    starved = F.col(spec.gate_measure).isNull() & (count.isNull() | (count < spec.gate_min))
    return df.withColumn(spec.available, ~starved).withColumn(
        spec.composite, F.when(F.col(spec.available), F.col(spec.composite))
    )


def minmax_rescale(df: DataFrame, column: str, rescaled: str, flat: float = 50.0) -> DataFrame:
    """Adds ``column`` rescaled to 0–100, ``flat`` where there is no range.

    What is not finite has no part in the range and becomes null, as null does.
    """
    value = finite(F.col(column).cast("double"))
    bounds = df.agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    lo, hi = F.col("_lo"), F.col("_hi")
    scaled = F.lit(100.0) * (value - lo) / F.nullif(hi - lo, F.lit(0.0))
    return (
        attach_row(df, bounds)
        .withColumn(
            rescaled,
            F.when(value.isNull(), F.lit(None).cast("double"))
            .when(hi == lo, F.lit(flat))
            .otherwise(scaled),
        )
        .drop("_lo", "_hi")
    )


def score_areas(features: DataFrame, spec: ScoreSpec) -> DataFrame:
    """Features to scores: z-scores, sub-scores, composite, gate, rescale."""
    scored = add_zscores(features, spec.directions)
    scored = add_subscores(scored, spec.subscores)
    scored = add_composite(scored, spec.weights, spec.composite)
    scored = gate_scores(scored, spec)
    return minmax_rescale(scored, spec.composite, spec.rescaled)


def top_scores(df: DataFrame, score: str, key: str, n: int = 10, best: bool = True) -> DataFrame:
    """The ``n`` highest (or lowest) scores; ties go by key."""
    order = F.desc(score) if best else F.asc(score)
    return df.filter(F.col(score).isNotNull()).orderBy(order, F.asc(key)).limit(n)


def score_diagnostics(
    scored: DataFrame, key: str, score: str, available: str, n: int = 10
) -> DataFrame:
    """``(kind, rank, key, score)``: the best and worst ``n`` areas, and every area without a score, unranked."""
    sides = []
    for kind, order in (("top", F.desc(score)), ("bottom", F.asc(score))):
        first = top_scores(scored, score, key, n, kind == "top").select(key, score)
        rank = F.row_number().over(Window.orderBy(order, F.asc(key)))  # n rows by now
        sides.append(first.select(F.lit(kind).alias("kind"), rank.alias("rank"), key, score))
    unscored = scored.filter(~F.col(available)).select(
        F.lit("unscored").alias("kind"), F.lit(None).cast("int").alias("rank"), key, score
    )
    return sides[0].unionAll(sides[1]).unionAll(unscored)

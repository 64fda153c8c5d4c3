"""A first look at raw data: counts, distinct values, numeric profiles, schemas."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areascore.functions import quantile
from areascore.operators.reshape import long_metrics, union_all


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column."""
    return df.select(column).distinct()


def counts_per_key(df: DataFrame, key: str, condition: Column | None = None) -> DataFrame:
    """Rows per key, most frequent first; optionally only rows that meet a condition."""
    rows = df if condition is None else df.filter(condition)
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), key)


def flag_distribution(df: DataFrame, flag: str) -> DataFrame:
    """Rows per value of a flag."""
    return df.groupBy(flag).agg(F.count(F.lit(1)).alias("count"))


def record_counts(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """``(dataset, records)``."""
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("records")).select(
                F.lit(name).alias("dataset"), "records"
            )
            for name, df in datasets.items()
        ]
    )


def approx_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float], relative_error: float = 0.001
) -> DataFrame:
    """``(probability, value)`` with a bounded rank error."""
    wanted = F.array(*[F.lit(p) for p in probabilities])
    sketch = F.percentile_approx(column, wanted, F.lit(round(1 / relative_error)))
    return (
        df.agg(sketch.alias("values"))
        .select(F.explode(F.arrays_zip(wanted.alias("probability"), F.col("values").alias("value"))).alias("q"))
        .select("q.*")
    )


def numeric_mode(long: DataFrame) -> DataFrame:
    """``(metric, mode)``: the most frequent value per metric, the smallest one on a tie.

    Counts per value first: the ``mode`` aggregate would hold every distinct value in one task.
    """
    counted = long.groupBy("metric", "value").agg(F.count(F.lit(1)).alias("_n"))
    return counted.groupBy("metric").agg(
        F.min_by("value", F.struct(-F.col("_n"), F.col("value"))).alias("mode")
    )


def profile_numeric(
    df: DataFrame, columns: Sequence[str], valid: Column | None = None, relative_error: float = 0.001
) -> DataFrame:
    """Count, mean, median, mode, sample deviation and range per column, over the valid rows."""
    rows = df if valid is None else df.filter(valid)
    long = long_metrics(rows, [], {name: name for name in columns})
    stats = long.groupBy("metric").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        quantile(F.col("value"), 0.5, round(1 / relative_error)).alias("median"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    # One row per profiled column.
    return stats.join(F.broadcast(numeric_mode(long)), "metric")


def schema_survey(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """``(dataset, position, column, type, nulls, records)``, one pass per dataset."""
    surveys = []
    for name, df in datasets.items():
        fields = df.schema.fields
        counts = df.agg(
            F.count(F.lit(1)).alias("records"),
            *[
                F.count_if(F.col(f"`{field.name}`").isNull()).alias(f"nulls_{i}")
                for i, field in enumerate(fields)
            ],
        )
        rows = [
            F.struct(
                F.lit(name).alias("dataset"),
                F.lit(i).alias("position"),
                F.lit(field.name).alias("column"),
                F.lit(field.dataType.simpleString()).alias("type"),
                F.col(f"nulls_{i}").alias("nulls"),
                F.col("records"),
            )
            for i, field in enumerate(fields)
        ]
        surveys.append(counts.select(F.inline(F.array(*rows))))
    return union_all(surveys)

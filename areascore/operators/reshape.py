"""Wide to long, latest row per key, union."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areascore.functions import to_double


def melt(
    df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str
) -> DataFrame:
    """One row per id and value column; rows without a value are dropped.

    Values become doubles before the reshape: monthly columns read from text may
    differ in type.
    """
    wide = df.select(
        *[F.col(f"`{c}`") for c in ids], *[to_double(F.col(f"`{c}`")).alias(c) for c in values]
    )
    long = wide.unpivot(list(ids), list(values), name, value)
    return long.filter(F.col(value).isNotNull())


def long_metrics(df: DataFrame, ids: Sequence[str], metrics: Mapping[str, str]) -> DataFrame:
    """``(ids…, metric, value)`` for metric key -> column; rows without a value are dropped."""
    wide = df.select(
        *ids, *[F.col(column).cast("double").alias(f"m_{key}") for key, column in metrics.items()]
    )
    long = wide.unpivot(list(ids), [f"m_{key}" for key in metrics], "metric", "value")
    return long.filter(F.col("value").isNotNull()).withColumn(
        "metric", F.expr("substring(metric, 3)")
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The row with the greatest ``order`` per key; equal ones are settled by the other columns.

    An aggregate rather than a window: each task keeps one row per key before the
    shuffle, so a key with very many rows costs no more than the others.
    """
    rest = [name for name in df.columns if name not in keys]
    payload = F.struct(order, *[name for name in rest if name != order])
    best = df.groupBy(*keys).agg(F.max(payload).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.`{name}`").alias(name) for name in rest])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name."""
    return reduce(lambda left, right: left.unionByName(right), frames)

"""Lookup tables: built by plurality, joined by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areascore.functions import extract_zip


def modal_lookup(
    df: DataFrame, key: str, categories: Sequence[str], distinct: str | None = None
) -> DataFrame:
    """The most frequent category of each key; the smaller category wins a tie.

    Counts rows, or distinct values of ``distinct``. Two aggregates, both partial before
    their shuffle, so a key holding most rows still arrives as a few counts.
    """
    count = F.count(F.lit(1)) if distinct is None else F.count_distinct(distinct)
    counted = df.groupBy(key, *categories).agg(count.alias("_n"))
    chosen = F.min_by(F.struct(*categories), F.struct(-F.col("_n"), *categories))
    return (
        counted.groupBy(key)
        .agg(chosen.alias("_best"))
        .select(key, *[F.col(f"_best.{name}").alias(name) for name in categories])
    )


def zip_to_area(
    points: DataFrame,
    zip_column: str,
    code: str,
    name: str,
    pad: bool = False,
    distinct: str | None = None,
) -> DataFrame:
    """Area holding most of the points of each ZIP."""
    placed = points.withColumn(zip_column, extract_zip(F.col(zip_column), pad)).filter(
        (F.col(zip_column) != "") & F.col(code).isNotNull()
    )
    return modal_lookup(placed, zip_column, [code, name], distinct)


def lookup_join(df: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Left join onto a lookup with unique keys.

    No hint: Spark broadcasts the lookup while its size stays below the threshold
    and shuffles beyond it.
    """
    return df.join(lookup, key, "left")


def hit_rate(df: DataFrame, column: str) -> DataFrame:
    """``(total, hits, hit_pct)`` where a hit is a non-null ``column``."""
    total, hits = F.count(F.lit(1)), F.count(column)
    return df.agg(
        total.alias("total"),
        hits.alias("hits"),
        (F.lit(100.0) * hits / F.greatest(total, F.lit(1))).alias("hit_pct"),
    )

"""Registry of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
_SCHEMAS: dict[str, StructType] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name``, with the SQL that gives the same rows."""

    def register(build):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test bed; its schema is read from a footer the first time only."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def rounded(c: Column | str, digits: int = 6) -> Column:
    """Rounded, without negative zero; sums of doubles differ in their last digits otherwise."""
    column = F.col(c) if isinstance(c, str) else c
    return F.round(column, digits) + F.lit(0.0)


def round_columns(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({name: rounded(name, digits) for name in names})


def r(expression: str, name: str | None = None, digits: int = 6) -> str:
    """The SQL of :func:`rounded`."""
    return f"(round({expression}, {digits}) + 0.0) AS {name or expression}"

"""Row-wise cleaning: projections, null and sentinel filters, normalisation, flags.

All of it is narrow, so a cleaning stage is one pass over its feed without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areascore.functions import binary_flag, normalize_text


@dataclass(frozen=True)
class CleanSpec:
    """How one feed is cleaned.

    columns     raw column name -> output name, in output order
    required    output columns that must not be null
    upper       output columns to trim and upper-case
    sentinels   output column -> values that stand for "unknown" (null never passes)
    flags       new 0/1 column -> condition
    """

    columns: Mapping[str, str]
    required: Sequence[str]
    upper: Sequence[str] = ()
    sentinels: Mapping[str, Sequence[str]] = field(default_factory=dict)
    flags: Mapping[str, Column] = field(default_factory=dict)


def project_rename(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Keep and rename columns, in the order given; names may hold spaces."""
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in columns.items()])


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of ``columns``."""
    return df.dropna(subset=list(columns))


def normalize_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Trim and upper-case text keys."""
    return df.withColumns({name: normalize_text(F.col(f"`{name}`")) for name in columns})


def drop_sentinels(df: DataFrame, sentinels: Mapping[str, Sequence[str]]) -> DataFrame:
    """Drop rows whose column holds one of its sentinels, or null."""
    for name, values in sentinels.items():
        column = F.col(f"`{name}`")
        df = df.filter(column.isNotNull())
        if values:
            df = df.filter(~column.isin(*values))
    return df


def add_flags(df: DataFrame, flags: Mapping[str, Column]) -> DataFrame:
    """Add 0/1 columns; a null condition gives 0."""
    return df.withColumns({name: binary_flag(condition) for name, condition in flags.items()})


def keep_categories(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Keep rows whose category is allowed."""
    return df.filter(F.col(column).isin(*allowed))


def clean_events(df: DataFrame, spec: CleanSpec) -> DataFrame:
    """Apply a :class:`CleanSpec`."""
    df = drop_missing(project_rename(df, spec.columns), spec.required)
    df = drop_sentinels(normalize_columns(df, spec.upper), spec.sentinels)
    return add_flags(df, spec.flags)


def keep_region(
    df: DataFrame, city_column: str, city: str, pattern_columns: Sequence[str], pattern: str
) -> DataFrame:
    """Keep rows of one city, or whose region text matches ``pattern`` in any case.

    Pattern columns that the frame does not have are ignored: feeds differ in them.
    """
    condition = F.col(city_column) == city
    for name in pattern_columns:
        if name in df.columns:
            condition = condition | F.col(name).rlike(f"(?i){pattern}")
    return df.filter(condition)


def measure_columns(df: DataFrame) -> list[str]:
    """Columns named like a date, i.e. starting with four digits."""
    return [name for name in df.columns if re.match(r"[0-9]{4}", name)]

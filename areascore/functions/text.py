"""Text expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_text(c: Column) -> Column:
    """Upper case without leading and trailing spaces, so keys from two feeds compare equal."""
    return F.upper(F.trim(c))


def extract_zip(c: Column, pad: bool = False) -> Column:
    """First run of five digits, ``''`` when there is none.

    ``pad`` first restores leading zeros of codes that are all digits and too short.
    """
    text = c.cast("string")
    if pad:
        text = F.when(text.rlike(r"^\d{1,4}$"), F.lpad(text, 5, "0")).otherwise(text)
    return F.regexp_extract(text, r"(\d{5})", 1)


def prefix_lookup(
    code: Column, mapping: Mapping[str, str], default: str = "Other", length: int = 2
) -> Column:
    """Category of a code by its first letters."""
    if not mapping:
        return F.lit(default)
    table = F.create_map(*[F.lit(part) for pair in mapping.items() for part in pair])
    return F.coalesce(F.try_element_at(table, F.substring(code, 1, length)), F.lit(default))

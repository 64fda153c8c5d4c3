"""Column expressions shared by the operators; all of them stay in generated code."""

from areascore.functions.numeric import (
    binary_flag,
    finite,
    guarded_ratio,
    percent_of_range,
    rate_per,
    score_tier,
    to_double,
    to_integer,
)
from areascore.functions.stats import pair_correlation, plus_zero, quantile
from areascore.functions.text import extract_zip, normalize_text, prefix_lookup

__all__ = [
    "binary_flag",
    "extract_zip",
    "finite",
    "guarded_ratio",
    "normalize_text",
    "pair_correlation",
    "percent_of_range",
    "plus_zero",
    "prefix_lookup",
    "quantile",
    "rate_per",
    "score_tier",
    "to_double",
    "to_integer",
]

"""Every operator as a query over the TPC-H-like tables, with its SQL twin."""

from areascore.testbed import areas, charts, cleaning, places, profiles, storage  # noqa: F401
from areascore.testbed.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]

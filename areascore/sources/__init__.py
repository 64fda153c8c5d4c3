"""Readers."""

from areascore.sources.geojson import (
    polygon_edges,
    read_features,
    read_polygons,
)
from areascore.sources.inference import inferred_types, misfits
from areascore.sources.layout import Layout
from areascore.sources.readers import (
    read_csv,
    read_dataset,
    read_inferred_csv,
    read_lookup_csv,
    read_population,
)

__all__ = [
    "Layout",
    "inferred_types",
    "misfits",
    "polygon_edges",
    "read_csv",
    "read_dataset",
    "read_features",
    "read_inferred_csv",
    "read_lookup_csv",
    "read_polygons",
    "read_population",
]

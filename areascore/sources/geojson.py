"""GeoJSON polygons as rows.

Two layouts are read: FeatureCollection documents, or one feature per line. Large documents are
read by byte ranges (``feature_collections``), files of lines split by themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from areascore.sources.feature_collections import read_feature_texts
from areascore.sources.ranges import SPLIT_BYTES, file_sizes

# Property names under which published area files keep code and name.
CODE_FIELDS = ["ntacode", "NTACode", "ntacode2020", "NTA2020", "nta2020", "nta_code"]
NAME_FIELDS = ["ntaname", "NTAName", "nta_name", "NTA_NAME"]
# The order in which the map view tries them.
MAP_CODE_FIELDS = ["nta_code", "NTACode", "ntacode", "ntacode2020", "NTA2020", "nta2020"]
MAP_NAME_FIELDS = ["nta_name", "NTAName", "ntaname", "NTA_NAME"]

_FEATURE = (
    "struct<properties: map<string, string>, geometry: struct<type: string, coordinates: string>>"
)
_RING = "array<array<double>>"


def _first_property(props: Column, names: Sequence[str], blank_is_missing: bool) -> Column:
    values = [F.try_element_at(props, F.lit(name)) for name in names]
    if blank_is_missing:
        values = [F.nullif(value, F.lit("")) for value in values]
    return F.coalesce(*values)


def read_features(
    spark: SparkSession,
    path: str,
    code_fields: Sequence[str] = CODE_FIELDS,
    name_fields: Sequence[str] = NAME_FIELDS,
    per_line: bool = False,
    order_field: str | None = None,
    blank_is_missing: bool = False,
    split: bool | None = None,
) -> DataFrame:
    """``(ord, area_code, area_name, geometry_type, coordinates)``, one row per feature.

    The first alias with a value gives code and name. ``ord`` is the position
    in the document. Lines of a split file have no position, so with ``per_line`` the
    property ``order_field`` gives it, and without one the area code decides.

    With ``split`` a document is read by as many tasks as it has byte ranges, without it by one; left
    open, documents of more than ``SPLIT_BYTES`` are split.
    """
    if split is None:
        split = not per_line and max(file_sizes(spark, path), default=0) > SPLIT_BYTES
    if per_line:
        lines = spark.read.schema(
            "properties map<string, string>, geometry struct<type: string, coordinates: string>"
        ).json(path)
        order = F.lit(0).cast("long")
        if order_field is not None:
            order = F.try_element_at(F.col("properties"), F.lit(order_field)).try_cast("long")
        rows = lines.select(order.alias("ord"), F.col("properties"), F.col("geometry"))
    elif split:
        parsed = read_feature_texts(spark, path).withColumn("f", F.from_json("feature", _FEATURE))
        rows = parsed.select("ord", F.col("f.properties").alias("properties"), F.col("f.geometry").alias("geometry"))
    else:
        document = (
            spark.read.schema(f"features array<{_FEATURE}>").option("multiLine", True).json(path)
        )
        rows = document.select(F.posexplode("features").alias("pos", "f")).select(
            F.col("pos").cast("long").alias("ord"),
            F.col("f.properties").alias("properties"),
            F.col("f.geometry").alias("geometry"),
        )
    return rows.select(
        "ord",
        _first_property(F.col("properties"), code_fields, blank_is_missing).alias("area_code"),
        _first_property(F.col("properties"), name_fields, blank_is_missing).alias("area_name"),
        F.col("geometry.type").alias("geometry_type"),
        F.col("geometry.coordinates").alias("coordinates"),
    )


def polygon_edges(features: DataFrame) -> DataFrame:
    """``(ord, area_code, area_name, edges, min_x, min_y, max_x, max_y)`` per usable feature.

    An edge joins two neighbouring vertices of a ring. Shells and holes of all parts go in one
    list: the even-odd rule needs no more. Features without a code and other
    geometry types are left out; a missing name becomes the code.
    """
    usable = features.filter(
        F.col("area_code").isNotNull() & F.col("geometry_type").isin("Polygon", "MultiPolygon")
    )
    rings = F.when(
        F.col("geometry_type") == "Polygon",
        F.from_json("coordinates", f"array<{_RING}>"),
    ).otherwise(F.flatten(F.from_json("coordinates", f"array<array<{_RING}>>")))

    def ring_edges(ring: Column) -> Column:
        steps = F.sequence(F.lit(1), F.greatest(F.size(ring) - 1, F.lit(1)))
        return F.transform(
            steps,
            lambda i: F.struct(
                F.get(F.get(ring, i - 1), F.lit(0)).alias("x1"),
                F.get(F.get(ring, i - 1), F.lit(1)).alias("y1"),
                F.get(F.get(ring, i), F.lit(0)).alias("x2"),
                F.get(F.get(ring, i), F.lit(1)).alias("y2"),
            ),
        )

    edges = usable.select(
        "ord",
        "area_code",
        F.coalesce("area_name", "area_code").alias("area_name"),
        F.filter(
            F.flatten(F.transform(rings, ring_edges)),
            lambda e: e["x2"].isNotNull() & e["y2"].isNotNull(),
        ).alias("edges"),
    ).filter(F.size("edges") > 0)
    return edges.select(
        "*",
        F.array_min(F.transform("edges", lambda e: F.least(e["x1"], e["x2"]))).alias("min_x"),
        F.array_min(F.transform("edges", lambda e: F.least(e["y1"], e["y2"]))).alias("min_y"),
        F.array_max(F.transform("edges", lambda e: F.greatest(e["x1"], e["x2"]))).alias("max_x"),
        F.array_max(F.transform("edges", lambda e: F.greatest(e["y1"], e["y2"]))).alias("max_y"),
    )


def read_polygons(
    spark: SparkSession,
    path: str,
    code_fields: Sequence[str] = CODE_FIELDS,
    name_fields: Sequence[str] = NAME_FIELDS,
    per_line: bool = False,
    order_field: str | None = None,
    split: bool | None = None,
) -> DataFrame:
    """Polygons of a GeoJSON file, ready for ``operators.spatial``."""
    return polygon_edges(
        read_features(spark, path, code_fields, name_fields, per_line, order_field, split=split)
    )

"""Polygons from suppliers, points from line items.

Supplier number k stands at column ``k % 32`` and row ``k / 32`` of a map with spacing 2, so the
map grows with the table. Its polygon is, by turns, a square with a hole, a triangle, an L,
or two squares of which one has a hole. Neighbours overlap, which makes the order of
the features matter. A line item is a point close to its supplier.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from areascore.operators.choropleth import polygon_attributes
from areascore.operators.lookup import hit_rate
from areascore.operators.spatial import build_cells, locate_points
from areascore.partitions import spread
from areascore.scratch import scratch_path
from areascore.sources.geojson import (
    MAP_CODE_FIELDS,
    MAP_NAME_FIELDS,
    polygon_edges,
    read_features,
)
from areascore.testbed.registry import query, r, round_columns, table

# Rings as offsets from the centre, in units of the size of the polygon.
SHELL = [(-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1)]
HOLE = [(-0.5, -0.25), (-0.5, 0.25), (0.25, 0.25), (0.25, -0.25), (-0.5, -0.25)]
TRIANGLE = [(-1, -1), (1.25, -0.5), (0.25, 1), (-1, -1)]
ELL = [(-1, -1), (1, -1), (1, 0), (0, 0), (0, 1), (-1, 1), (-1, -1)]
LEFT = [(-1, -1), (-0.25, -1), (-0.25, 1), (-1, 1), (-1, -1)]
LEFT_HOLE = [(-0.75, -0.5), (-0.5, -0.5), (-0.5, 0.5), (-0.75, 0.5), (-0.75, -0.5)]
RIGHT = [(0.25, -0.5), (1, -0.5), (1, 0.75), (0.25, 0.75), (0.25, -0.5)]
# Shape number -> parts, each a shell and its holes.
SHAPES = [[[SHELL, HOLE]], [[TRIANGLE]], [[ELL]], [[LEFT, LEFT_HOLE], [RIGHT]]]

# Every 13th feature is a point, every 17th has no code, every 19th no name.
CENTRE_X = "CAST((s_suppkey % 32) * 2 AS DOUBLE)"
CENTRE_Y = "CAST(floor(s_suppkey / 32) * 2 AS DOUBLE)"
SIZE = "(0.75 + (s_suppkey % 8) * 0.125)"


def _ring(ring):
    points = ", ".join(
        f"array({CENTRE_X} + {x} * {SIZE}, {CENTRE_Y} + {y} * {SIZE})" for x, y in ring
    )
    return f"array({points})"


def _polygon(rings):
    return f"array({', '.join(_ring(ring) for ring in rings)})"


def geojson_lines(spark, sf_dir):
    """One GeoJSON feature per supplier, as text."""
    one_part = "CASE " + " ".join(
        f"WHEN s_suppkey % 4 = {i} THEN {_polygon(parts[0])}"
        for i, parts in enumerate(SHAPES)
        if len(parts) == 1
    ) + " END"
    several = f"array({', '.join(_polygon(rings) for rings in SHAPES[3])})"
    properties = """named_struct(
        'ntacode', CAST(NULL AS STRING),
        'nta_code', CASE WHEN s_suppkey % 17 <> 16 THEN concat('A', lpad(CAST(s_suppkey AS STRING), 12, '0')) END,
        'ntaname', CASE WHEN s_suppkey % 19 <> 18 THEN s_name END,
        'ord', CAST(s_suppkey AS STRING))"""

    def feature(kind, coordinates):
        return f"""to_json(named_struct('type', 'Feature', 'properties', {properties},
            'geometry', named_struct('type', '{kind}', 'coordinates', {coordinates})))"""

    return table(spark, sf_dir, "supplier").selectExpr(
        f"""CASE WHEN s_suppkey % 13 = 12 THEN {feature('Point', f'array({CENTRE_X}, {CENTRE_Y})')}
            WHEN s_suppkey % 4 = 3 THEN {feature('MultiPolygon', several)}
            ELSE {feature('Polygon', one_part)} END AS value"""
    )


def geojson_file(spark, sf_dir):
    path = scratch_path(spark, "geojson")
    geojson_lines(spark, sf_dir).write.text(path)
    return path


def features(spark, sf_dir):
    return read_features(spark, geojson_file(spark, sf_dir), per_line=True, order_field="ord")


def polygons(spark, sf_dir):
    return polygon_edges(features(spark, sf_dir))


EDGE_ROWS = [
    (shape, x1, y1, x2, y2)
    for shape, parts in enumerate(SHAPES)
    for rings in parts
    for ring in rings
    for (x1, y1), (x2, y2) in zip(ring, ring[1:])
]
EDGES_SQL = f"""shapes(shape, from_x, from_y, to_x, to_y) AS (VALUES {", ".join(
    "(" + ", ".join([str(row[0]), *[f"CAST({v} AS DOUBLE)" for v in row[1:]]]) + ")" for row in EDGE_ROWS)}),
  areas AS (SELECT s_suppkey AS ord, 'A' || lpad(CAST(s_suppkey AS VARCHAR), 12, '0') AS area_code,
      CASE WHEN s_suppkey % 19 <> 18 THEN s_name
        ELSE 'A' || lpad(CAST(s_suppkey AS VARCHAR), 12, '0') END AS area_name,
      s_suppkey % 4 AS shape, CAST((s_suppkey % 32) * 2 AS DOUBLE) AS gx,
      CAST((s_suppkey // 32) * 2 AS DOUBLE) AS gy, CAST({SIZE} AS DOUBLE) AS size
    FROM supplier WHERE s_suppkey % 17 <> 16 AND s_suppkey % 13 <> 12),
  edges AS (SELECT ord, area_code, area_name, gx + from_x * size AS x1, gy + from_y * size AS y1,
      gx + to_x * size AS x2, gy + to_y * size AS y2 FROM areas JOIN shapes USING (shape))"""


@query(
    "polygon_edges",
    f"""WITH {EDGES_SQL} SELECT ord, area_code, area_name, {r('x1')}, {r('y1')}, {r('x2')}, {r('y2')}
    FROM edges""",
)
def edges(spark, sf_dir):
    rows = polygons(spark, sf_dir).select("ord", "area_code", "area_name", F.inline("edges"))
    return round_columns(rows, "x1", "y1", "x2", "y2")


DOCUMENT_FEATURES = 100


def documents_path(spark, sf_dir):
    """FeatureCollection documents of bounded size, with other objects and awkward texts around the features."""
    path = scratch_path(spark, "geojson-documents")
    numbered = geojson_lines(spark, sf_dir).withColumn("key", F.get_json_object("value", "$.properties.ord").cast("long"))
    numbered = numbered.withColumn("document", F.floor(F.col("key") / DOCUMENT_FEATURES))
    first = numbered.groupBy("document").agg(F.min("key").alias("key"))
    head = '{"type": "FeatureCollection", "crs": {"a": {"b": "} ]"}}, "name": "x \\" {", "features": ['
    rows = [
        numbered.join(first.withColumnRenamed("key", "least"), "document").select(
            "document", "key", F.concat(F.when(F.col("key") > F.col("least"), ", ").otherwise(""), "value").alias("value")
        ),
        first.select("document", F.lit(-1).alias("key"), F.lit(head).alias("value")),
        first.select("document", F.lit(1 << 62).alias("key"), F.lit('], "bbox": [0, 1], "list": [{"a": 1}, {"b": 2}]}').alias("value")),
    ]
    lines = rows[0].unionByName(rows[1]).unionByName(rows[2]).repartition("document")
    lines.sortWithinPartitions("document", "key").select("document", "value").write.partitionBy("document").text(path)
    return path


@query(
    "polygon_edges_document",
    f"""WITH {EDGES_SQL}, places AS (SELECT s_suppkey AS ord,
        row_number() OVER (PARTITION BY s_suppkey // {DOCUMENT_FEATURES} ORDER BY s_suppkey) - 1 AS place FROM supplier)
    SELECT place AS ord, area_code, area_name, {r('x1')}, {r('y1')}, {r('x2')}, {r('y2')}
    FROM edges JOIN places USING (ord)""",
)
def edges_of_documents(spark, sf_dir):
    """The same features in FeatureCollection documents, read by byte ranges; ``ord`` is the place in the document."""
    rows = polygon_edges(read_features(spark, f"{documents_path(spark, sf_dir)}/*", split=True))
    return round_columns(
        rows.select("ord", "area_code", "area_name", F.inline("edges")), "x1", "y1", "x2", "y2"
    )


# Offsets from the supplier: multiples of 1/64, so that many points fall exactly on edges.
POINT_X = """CAST((l_suppkey % 32) * 2 AS DOUBLE)
  + CAST((l_orderkey * 7919 + l_partkey * 31 + l_linenumber) % 193 - 96 AS DOUBLE) / 64"""
POINT_Y = """CAST(floor(l_suppkey / 32) * 2 AS DOUBLE)
  + CAST((l_orderkey * 104729 + l_partkey * 17 + l_linenumber * 7) % 193 - 96 AS DOUBLE) / 64"""


def points(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        f"CASE WHEN l_orderkey % 97 <> 0 THEN {POINT_X} END AS x",
        f"CASE WHEN l_orderkey % 89 <> 0 THEN {POINT_Y} END AS y",
    )


LOCATED_SQL = f"""{EDGES_SQL},
  pts AS (SELECT row_number() OVER () AS pid, l_orderkey, l_linenumber, l_partkey, {POINT_X} AS x,
      {POINT_Y.replace("floor(l_suppkey / 32)", "(l_suppkey // 32)")} AS y
    FROM lineitem WHERE l_orderkey % 97 <> 0 AND l_orderkey % 89 <> 0),
  boxes AS (SELECT ord, min(least(x1, x2)) AS x_lo, max(greatest(x1, x2)) AS x_hi,
      min(least(y1, y2)) AS y_lo, max(greatest(y1, y2)) AS y_hi FROM edges GROUP BY ord),
  near AS (SELECT pid, x, y, ord FROM pts JOIN boxes
    ON x BETWEEN x_lo AND x_hi AND y BETWEEN y_lo AND y_hi),
  tested AS (SELECT pid, ord,
      count(*) FILTER ((y1 > y) <> (y2 > y) AND x < x1 + (y - y1) * (x2 - x1) / nullif(y2 - y1, 0))
        AS crossings,
      count(*) FILTER ((x2 - x1) * (y - y1) = (y2 - y1) * (x - x1)
        AND x BETWEEN least(x1, x2) AND greatest(x1, x2)
        AND y BETWEEN least(y1, y2) AND greatest(y1, y2)) AS touches
    FROM near JOIN edges USING (ord) GROUP BY pid, ord),
  first_hit AS (SELECT pid, min(ord) AS ord FROM tested WHERE crossings % 2 = 1 AND touches = 0
    GROUP BY pid),
  located AS (SELECT pts.*, area_code, area_name FROM pts LEFT JOIN first_hit USING (pid)
    LEFT JOIN areas USING (ord))"""


def located(spark, sf_dir, **options):
    index = build_cells(spread(polygons(spark, sf_dir)))
    return locate_points(spread(points(spark, sf_dir)), index, "x", "y", **options)


JOINED_SQL = f"""WITH {LOCATED_SQL} SELECT l_orderkey, l_linenumber, l_partkey, {r('x')}, {r('y')},
      area_code, area_name FROM located"""


@query("spatial_join", JOINED_SQL)
def spatial_join(spark, sf_dir):
    return round_columns(located(spark, sf_dir), "x", "y")


@query("spatial_join_shuffled", JOINED_SQL)
def spatial_join_shuffled(spark, sf_dir):
    """No level of the index sent whole, as for an index that is too large."""
    return round_columns(located(spark, sf_dir, broadcast_bytes=0), "x", "y")


@query("spatial_join_crowded", JOINED_SQL)
def spatial_join_crowded(spark, sf_dir):
    """Every cell of two or more polygons in parts, as where very many polygons meet."""
    index = build_cells(spread(polygons(spark, sf_dir)), cell_group=1)
    return round_columns(locate_points(spread(points(spark, sf_dir)), index, "x", "y"), "x", "y")


# Points on the edges, and next to them by about one unit in the last place.
STEP = "CAST(power(2.0, -46) AS DOUBLE)"
NEAR_X = "x1 + (x2 - x1) * (m / 8.0e0) + (d % 3 - 1) * {step}"
NEAR_Y = "y1 + (y2 - y1) * (m / 8.0e0) + (floor(d / 3) - 1) * {step}"


def points_near_edges(spark, sf_dir):
    edges = polygons(spark, sf_dir).select("ord", F.posexplode("edges").alias("edge", "e")).select("ord", "e.*")
    spread_out = edges.selectExpr("*", "explode(sequence(0, 8)) AS m").selectExpr("*", "explode(sequence(0, 8)) AS d")
    return spread_out.selectExpr(
        "ord", "m", "d", f"{NEAR_X.format(step=STEP)} AS x", f"{NEAR_Y.format(step=STEP)} AS y"
    )


@query(
    "spatial_join_near_edges",
    f"""WITH {EDGES_SQL},
      near AS (SELECT DISTINCT {NEAR_X.format(step=STEP)} AS x, {NEAR_Y.format(step=STEP)} AS y
        FROM edges, range(0, 9) AS ms(m), range(0, 9) AS ds(d)),
      pts AS (SELECT x, y, CAST(x * power(2.0, 60) AS HUGEINT) AS px, CAST(y * power(2.0, 60) AS HUGEINT) AS py FROM near),
      scaled AS (SELECT ord, CAST(x1 * 1024 AS HUGEINT) AS a1, CAST(y1 * 1024 AS HUGEINT) AS b1,
        CAST(x2 * 1024 AS HUGEINT) AS a2, CAST(y2 * 1024 AS HUGEINT) AS b2 FROM edges),
      boxes AS (SELECT ord, min(least(x1, x2)) AS x_lo, max(greatest(x1, x2)) AS x_hi,
        min(least(y1, y2)) AS y_lo, max(greatest(y1, y2)) AS y_hi FROM edges GROUP BY ord),
      sides AS (SELECT x, y, px, py, ord, a1 * CAST(1125899906842624 AS HUGEINT) AS x1, b1 * CAST(1125899906842624 AS HUGEINT) AS y1, a2 * CAST(1125899906842624 AS HUGEINT) AS x2, b2 * CAST(1125899906842624 AS HUGEINT) AS y2,
        (a2 - a1) * (py - b1 * CAST(1125899906842624 AS HUGEINT)) - (b2 - b1) * (px - a1 * CAST(1125899906842624 AS HUGEINT)) AS det
        FROM pts JOIN boxes ON x BETWEEN x_lo AND x_hi AND y BETWEEN y_lo AND y_hi JOIN scaled USING (ord)),
      tested AS (SELECT x, y, ord,
        count(*) FILTER ((y1 > py) <> (y2 > py) AND sign(det) = CASE WHEN y2 > y1 THEN 1 ELSE -1 END) AS crossings,
        count(*) FILTER (det = 0 AND px BETWEEN least(x1, x2) AND greatest(x1, x2)
          AND py BETWEEN least(y1, y2) AND greatest(y1, y2)) AS touches
        FROM sides GROUP BY x, y, ord),
      hit AS (SELECT x, y, min(ord) AS ord FROM tested WHERE crossings % 2 = 1 AND touches = 0 GROUP BY x, y)
    SELECT pts.x, pts.y, area_code FROM pts LEFT JOIN hit USING (x, y) LEFT JOIN areas USING (ord)""",
)
def spatial_join_near_edges(spark, sf_dir):
    """Next to edges and on them, where rounding decides for any test that is not exact."""
    index = build_cells(spread(polygons(spark, sf_dir)))
    near = points_near_edges(spark, sf_dir).select("x", "y").distinct()
    return locate_points(near, index, "x", "y").select("x", "y", "area_code")


@query(
    "spatial_hit_rate",
    f"""WITH {LOCATED_SQL} SELECT count(*) AS total, count(area_code) AS hits,
      {r('100.0 * count(area_code) / greatest(count(*), 1)', 'hit_pct')} FROM located""",
)
def spatial_hit_rate(spark, sf_dir):
    return round_columns(hit_rate(located(spark, sf_dir), "area_code"), "hit_pct")


@query(
    "polygon_attributes",
    """SELECT s_suppkey AS ord,
      CASE WHEN s_suppkey % 17 <> 16 THEN 'A' || lpad(CAST(s_suppkey AS VARCHAR), 12, '0') END AS area_code,
      CASE WHEN s_suppkey % 19 <> 18 THEN s_name END AS area_name, n_parts
    FROM supplier LEFT JOIN (SELECT l_suppkey AS k, count(*) AS n_parts FROM lineitem
      WHERE l_suppkey % 5 <> 0 GROUP BY l_suppkey) ON k = s_suppkey AND s_suppkey % 17 <> 16""",
)
def attributes(spark, sf_dir):
    shapes = read_features(
        spark,
        geojson_file(spark, sf_dir),
        MAP_CODE_FIELDS,
        MAP_NAME_FIELDS,
        per_line=True,
        order_field="ord",
        blank_is_missing=True,
    )
    scores = (
        table(spark, sf_dir, "lineitem")
        .filter("l_suppkey % 5 <> 0")
        .groupBy("l_suppkey")
        .agg(F.count(F.lit(1)).alias("n_parts"))
        .selectExpr(
            "concat('A', lpad(CAST(l_suppkey AS STRING), 12, '0')) AS area_code",
            "CAST(NULL AS STRING) AS area_name",
            "n_parts",
        )
    )
    merged = polygon_attributes(shapes, scores, "area_code", "area_name")
    return merged.select("ord", "area_code", "area_name", "n_parts")

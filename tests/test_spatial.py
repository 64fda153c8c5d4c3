import json
import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from areascore.operators.spatial import build_cells, locate_points
from areascore.sources import polygon_edges, read_features, read_polygons


def ring(points):
    return [list(p) for p in points] + [list(points[0])]


def square(x, y, half):
    return ring([(x - half, y - half), (x + half, y - half), (x + half, y + half), (x - half, y + half)])


def feature(code, name, coordinates, kind="Polygon", **properties):
    return {
        "type": "Feature",
        "properties": {"ntacode": code, "ntaname": name, **properties},
        "geometry": {"type": kind, "coordinates": coordinates},
    }


def write_collection(path, features):
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    return str(path)


def inside(rings, x, y):
    """Even-odd test of one point, ``None`` on an edge."""
    odd = False
    for points in rings:
        for (x1, y1), (x2, y2) in zip(points, points[1:]):
            on_line = (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1)
            if on_line and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return None
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                odd = not odd
    return odd


def brute_force(shapes, x, y):
    """Code of the first shape ``(code, rings)`` that holds the point."""
    for code, rings in shapes:
        if inside(rings, x, y):
            return code
    return None


def placed(spark, polygons, points, **options):
    df = spark.createDataFrame(points, "k int, Longitude double, Latitude double")
    located = locate_points(df, build_cells(polygons, **options))
    return {row["k"]: row["area_code"] for row in located.collect()}


DONUT = feature("DN", "Donut", [square(5, 5, 4), square(5, 5, 1)])
PAIR = feature("PR", None, [[square(20, 5, 2), square(20, 5, 1)], [square(26, 5, 2)]], "MultiPolygon")
LATE = feature("LT", "Late", [square(9, 5, 3)])


def test_hand_worked_points(spark, tmp_path):
    path = write_collection(tmp_path / "a.geojson", [DONUT, PAIR, LATE])
    points = [
        (1, 2.0, 5.0),  # in the donut
        (2, 5.0, 5.0),  # in its hole
        (3, 1.0, 5.0),  # on its shell
        (4, 4.0, 5.0),  # on the edge of its hole
        (5, 1.0, 1.0),  # on a vertex
        (6, 7.0, 5.0),  # donut and late: first wins
        (7, 9.0, 5.0),  # on the shell of the donut, inside late
        (8, 11.0, 5.0),  # late only
        (9, 20.0, 5.0),  # hole of the first part
        (10, 18.5, 5.0),  # first part
        (11, 26.0, 5.5),  # second part
        (12, 23.0, 5.0),  # between the parts
        (13, 50.0, 50.0),  # far away
        (14, -3.0, -3.0),
        (15, float("nan"), 5.0),
        (16, 5.0, float("inf")),
        (17, -1e300, 5.0),
    ]
    got = placed(spark, read_polygons(spark, path), points)
    assert got == {
        1: "DN", 2: None, 3: None, 4: None, 5: None, 6: "DN", 7: "LT", 8: "LT", 9: None,
        10: "PR", 11: "PR", 12: None, 13: None, 14: None, 15: None, 16: None, 17: None,
    }


def test_missing_coordinates_are_dropped_and_names_returned(spark, tmp_path):
    path = write_collection(tmp_path / "a.geojson", [DONUT, PAIR])
    df = spark.createDataFrame(
        [(1, 2.0, 5.0), (2, None, 5.0), (3, 2.0, None), (1, 2.0, 5.0), (4, 18.5, 5.0)],
        "k int, Longitude double, Latitude double",
    )
    index = build_cells(read_polygons(spark, path))
    located = locate_points(df, index, code="nta_code", name="nta_name")
    assert located.columns == ["k", "Longitude", "Latitude", "nta_code", "nta_name"]
    assert rows(located.select("k", "nta_code", "nta_name")) == [
        (1, "DN", "Donut"),
        (1, "DN", "Donut"),
        (4, "PR", "PR"),
    ]


def star(rng, x, y, size):
    """A star-shaped ring of random radius, on a coarse lattice so that points hit its edges."""
    count = rng.randint(3, 12)
    angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(count))
    points = [
        (
            round((x + size * rng.uniform(0.3, 1) * math.cos(a)) * 8) / 8,
            round((y + size * rng.uniform(0.3, 1) * math.sin(a)) * 8) / 8,
        )
        for a in angles
    ]
    return ring(points)


@pytest.mark.parametrize(
    "seed, options, broadcast_bytes",
    [
        (1, {}, 1 << 30),
        (2, {"cells_per_side": 1}, 1 << 30),
        (3, {}, 0),
        (4, {"cell_group": 2}, 1 << 30),
        (5, {"cell_group": 1, "cells_per_side": 2}, 0),
    ],
)
def test_random_polygons_against_brute_force(spark, tmp_path, seed, options, broadcast_bytes):
    rng = random.Random(seed)
    shapes, features = [], []
    # Small shapes first, or the large ones would take every point.
    for i, size in enumerate(sorted(rng.choice([0.3, 1, 2, 4, 12]) for _ in range(80))):
        rings = [star(rng, rng.uniform(-10, 10), rng.uniform(-10, 10), size)]
        shapes.append((f"C{i}", rings))
        features.append(feature(f"C{i}", f"N{i}", rings))
    path = write_collection(tmp_path / "a.geojson", features)
    points = [(k, rng.randint(-96, 96) / 8, rng.randint(-96, 96) / 8) for k in range(1500)]
    points += [(1500 + k, rng.uniform(-12, 12), rng.uniform(-12, 12)) for k in range(500)]
    df = spark.createDataFrame(points, "k int, Longitude double, Latitude double")
    index = build_cells(read_polygons(spark, path), **options)
    assert index.crowded == (options.get("cell_group", 64) < 10)
    located = locate_points(df, index, broadcast_bytes=broadcast_bytes)
    got = {row["k"]: row["area_code"] for row in located.collect()}
    assert len(got) == len(points)
    expected = {k: brute_force(shapes, x, y) for k, x, y in points}
    wrong = [(point, got[point[0]]) for point in points if got[point[0]] != expected[point[0]]]
    assert wrong == []
    assert len(set(got.values())) > 20


def test_hot_place_keeps_every_row(spark, tmp_path):
    """A third of all points at one spot, without and with a broadcast, and in a crowded cell."""
    shapes = [feature(f"C{i}", None, [square(0, 0, 1 + i / 10)]) for i in range(6)]
    path = write_collection(tmp_path / "a.geojson", shapes)
    polygons = read_polygons(spark, path)
    df = spark.range(9000).select(
        F.col("id").alias("k"),
        F.when(F.col("id") % 3 == 0, 0.99).otherwise(F.rand(7) * 4 - 2).alias("Longitude"),
        F.when(F.col("id") % 3 == 0, 0.25).otherwise(F.rand(8) * 4 - 2).alias("Latitude"),
    )
    # Square i reaches to 1 + i / 10.
    reach = F.greatest(F.abs("Longitude"), F.abs("Latitude"))
    expected = F.when(reach < 1.5, F.concat(F.lit("C"), F.ceil(F.greatest((reach - 1) * 10, F.lit(0.0))).cast("string")))
    for options, size in (({}, 1 << 30), ({}, 0), ({"cell_group": 1}, 0)):
        located = locate_points(df, build_cells(polygons, **options), broadcast_bytes=size)
        assert located.count() == 9000
        assert located.filter(~F.col("area_code").eqNullSafe(expected)).count() == 0


def test_points_of_a_stream(spark, tmp_path):
    path = write_collection(tmp_path / "a.geojson", [DONUT, PAIR])
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "k int, Longitude double, Latitude double"
    spark.createDataFrame([(1, 2.0, 5.0), (2, 5.0, 5.0), (3, 18.5, 5.0)], schema).write.parquet(source)
    index = build_cells(read_polygons(spark, path))
    located = locate_points(spark.readStream.schema(schema).parquet(source), index)
    query = (
        located.select("k", "area_code")
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert rows(spark.read.parquet(out)) == [(1, "DN"), (2, None), (3, "PR")]


def test_no_polygons(spark, tmp_path):
    path = write_collection(tmp_path / "a.geojson", [feature(None, "x", [square(0, 0, 1)])])
    assert placed(spark, read_polygons(spark, path), [(1, 0.0, 0.0)]) == {1: None}


def test_geojson_aliases_and_other_geometries(spark, tmp_path):
    shape = [square(0, 0, 1)]
    features = [
        feature(None, None, shape, nta2020="A2", nta_name="alias"),
        feature("A1", None, shape),
        feature(None, "nameless code", shape),
        feature("A3", "point", [0, 0], "Point"),
        feature(7, "number", [shape, [square(5, 5, 1)]], "MultiPolygon"),
    ]
    path = write_collection(tmp_path / "a.geojson", features)
    polygons = read_polygons(spark, path)
    assert rows(polygons.select("ord", "area_code", "area_name", F.size("edges"))) == [
        (0, "A2", "alias", 4),
        (1, "A1", "A1", 4),
        (4, "7", "number", 8),
    ]
    box = polygons.filter("ord = 4").select("min_x", "min_y", "max_x", "max_y")
    assert rows(box) == [(-1.0, -1.0, 6.0, 6.0)]


def test_one_feature_per_line(spark, tmp_path):
    lines = [feature("B", None, [square(0, 0, 1)], rank=2), feature("A", None, [square(0, 0, 2)], rank="1")]
    path = tmp_path / "a.geojsonl"
    path.write_text("\n".join(json.dumps(line) for line in lines))
    by_rank = read_polygons(spark, str(path), per_line=True, order_field="rank")
    assert placed(spark, by_rank, [(1, 0.0, 0.0)]) == {1: "A"}
    flipped = json.dumps(lines[0]).replace('"rank": 2', '"rank": 0')
    path.write_text("\n".join([flipped, json.dumps(lines[1])]))
    again = read_polygons(spark, str(path), per_line=True, order_field="rank")
    assert placed(spark, again, [(1, 0.0, 0.0)]) == {1: "B"}


def test_blank_alias_counts_as_missing_on_the_map_only(spark, tmp_path):
    path = write_collection(
        tmp_path / "a.geojson", [feature("", "n", [square(0, 0, 1)], nta2020="Z")]
    )
    assert read_features(spark, path).first()["area_code"] == ""
    assert read_features(spark, path, blank_is_missing=True).first()["area_code"] == "Z"
    assert polygon_edges(read_features(spark, path)).count() == 1


@pytest.mark.parametrize("cell_group", [64, 1])
def test_like_levels_move_the_points_once(spark, tmp_path, cell_group):
    """Three cell sides that share tiles, negative cells and repeated rows, against brute force."""
    rng = random.Random(8)
    shapes, features = [], []
    for i, size in enumerate(sorted(rng.choice([0.5, 1, 2]) for _ in range(90))):
        x, y = rng.uniform(-10, 10), rng.uniform(-10, 10)
        rings = [ring([(x - size, y - size), (x + size, y - size / 2), (x + size / 4, y + size)])]
        shapes.append((f"C{i}", rings))
        features.append(feature(f"C{i}", None, rings))
    index = build_cells(read_polygons(spark, write_collection(tmp_path / "a.geojson", features)), cell_group=cell_group)
    assert len(index.levels) == 3
    points = [(k // 2, rng.randint(-96, 96) / 8, rng.randint(-96, 96) / 8) for k in range(1200)] + [(-1, math.nan, 1.0)]
    points += points[::2]
    df = spark.createDataFrame(points, "k int, Longitude double, Latitude double")
    located = locate_points(df, index, broadcast_bytes=0)
    got = [tuple(row) for row in located.select("k", "Longitude", "Latitude", "area_code").collect()]
    expected = [(k, x, y, None if math.isnan(x) else brute_force(shapes, x, y)) for k, x, y in points]
    assert sorted(map(repr, got)) == sorted(map(repr, expected)) and len({row[3] for row in got}) > 10


def test_no_growing_side_is_sent_whole(spark):
    """An index beyond the wanted size, of files that Spark takes for small: neither it nor the hits are broadcast."""
    from areascore.testbed import places

    sf_dir = "/root/testdata/sf0.001"
    for cell_group, moves in ((64, 1), (1, 2)):
        index = build_cells(places.polygons(spark, sf_dir), cell_group=cell_group)
        near = places.points_near_edges(spark, sf_dir).select("x", "y").distinct()
        located = locate_points(near, index, "x", "y", broadcast_bytes=0)
        plan = located._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and plan.count("SortMergeJoin") == moves

"""The side of a line, against fractions."""

import random
from fractions import Fraction

from pyspark.sql import functions as F

from areascore.functions.orientation import exact_sign, orientation


def side(x1, y1, x2, y2, x, y):
    a, b, c, d, e, f = map(Fraction, (x1, y1, x2, y2, x, y))
    det = (c - a) * (f - b) - (d - b) * (e - a)
    return (det > 0) - (det < 0)


def cases(n):
    draw = random.Random(4)
    for _ in range(n):
        scale = draw.choice([1.0, 1e-6, 74.0, 1e9])
        x1, y1, x2, y2 = (draw.uniform(-1, 1) * scale for _ in range(4))
        t = draw.choice([0.0, 0.125, 0.5, 1 / 3, 0.999, 1.0])
        x, y = x1 + (x2 - x1) * t, y1 + (y2 - y1) * t
        for _ in range(draw.randint(0, 2)):
            x += draw.choice([-1, 0, 1]) * abs(x) * 2.0**-52
            y += draw.choice([-1, 0, 1]) * abs(y) * 2.0**-52
        yield x1, y1, x2, y2, x, y
    for k in range(60):  # three points of a grid, exactly in line
        yield 0.1 * k, 0.1 * k, 24.0, 24.0, 12.0 + k * 2.0**-40, 12.0 + k * 2.0**-40
        yield 0.5, 0.5, 12.0, 12.0, 24.0 + k * 2.0**-48, 24.0


def test_sides_are_exact(spark):
    rows = list(cases(1500))
    df = spark.createDataFrame(rows, "x1 double, y1 double, x2 double, y2 double, x double, y double")
    names = ("x1", "y1", "x2", "y2", "x", "y")
    got = df.select(*names, orientation(*[F.col(c) for c in names]).alias("side")).collect()
    rough = 0
    for r in got:
        want = side(*r[:6])
        assert r.side == want, tuple(r)
        det = (r.x2 - r.x1) * (r.y - r.y1) - (r.y2 - r.y1) * (r.x - r.x1)
        rough += ((det > 0) - (det < 0)) != want
    assert rough > 20  # plain arithmetic gets some of them wrong


def test_exact_sums(spark):
    sums = [[], [0.0], [1e16, 1.0, -1e16], [1e16, -1.0, -1e16], [0.1, 0.2, -0.3], [2.0**60, 2.0**-60, -(2.0**60), -(2.0**-60)]]
    df = spark.createDataFrame([(s,) for s in sums], "s array<double>")
    want = [(t > 0) - (t < 0) for t in (sum(map(Fraction, s)) for s in sums)]
    assert [r[0] for r in df.select(exact_sign(F.col("s"))).collect()] == want


def test_neighbours_share_no_point_and_leave_none_out(spark):
    """Two triangles on one long edge: a point beside it lies in exactly one of them, one on it in none."""
    from areascore.operators.spatial import build_cells, locate_points

    ends = (0.1, 0.3), (7.7, 5.9)
    shapes = {0: [ends[0], ends[1], (0.1, 6.1)], 1: [ends[1], ends[0], (7.7, 0.2)]}
    rows = []
    for n, ring in shapes.items():
        ring = [*ring, ring[0]]
        xs, ys = zip(*ring, strict=True)
        rows.append((n, f"A{n}", "n", [(*p, *q) for p, q in zip(ring, ring[1:], strict=False)], min(xs), min(ys), max(xs), max(ys)))
    schema = (
        "ord long, area_code string, area_name string, edges array<struct<x1: double, y1: double, x2: double, y2: double>>, "
        "min_x double, min_y double, max_x double, max_y double"
    )
    index = build_cells(spark.createDataFrame(rows, schema))
    points = []
    for i in range(1, 400):
        t = i / 400
        x, y = (a + (b - a) * t for a, b in zip(*ends, strict=True))
        points += [(x + d * x * 2.0**-52, y) for d in (-1, 0, 1)]
    got = locate_points(spark.createDataFrame(points, "x double, y double"), index, "x", "y").collect()
    for r in got:
        want = {1: "A0", -1: "A1", 0: None}[side(*ends[0], *ends[1], r.x, r.y)]
        assert r.area_code == want
    assert len(got) == len(points)

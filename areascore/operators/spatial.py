"""Points into areas: a point-in-polygon join on grid cells.

Each polygon is cut along a grid. A cell that it covers fully needs no geometry any
more; a cell that its border crosses keeps only the edges in it. A point then meets
its cell in an equi-join and tests a handful of edges, all in built-in expressions, and
the join returns one row per point.

Inside or outside is the even-odd rule along a ray from the point towards growing x. An edge counts
when the ray meets it, i.e. when ``lo <= y < hi`` for its ends; so an edge wholly to the right
of a cell toggles the answer at ``lo`` and at ``hi``, whatever x is. Vertices shared by two such
edges toggle twice and cancel, which leaves very few heights (``turns``) to keep for
all the geometry to the right of a cell.

Comparisons are exact: heights and cell numbers are compared as they are (sides are powers of two), and on which
side of an edge a point lies is decided by ``functions.orientation``. So a point next to an edge that two areas share
falls in one of them, and one on it in none.

The cell side is a power of two picked per polygon from its own extent, so a large polygon
does not break into very many cells nor a small one hide in a cell with hundreds
of others. Polygons of one cell side form a level. Levels small enough to be sent to every executor
are joined one by one, without moving a point. Others whose sides lie close together meet in tiles of the largest
side, and the points move once; very different sides, and cells in parts, are one join of distinct places.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areascore.functions.orientation import orientation
from areascore.scratch import materialize

# Cells along the longer side of a polygon, as a share of the root of its number of edges: at least so
# many, at most twice as many. Edges in a cell then grow more slowly than the edges of a polygon.
CELLS_PER_ROOT = 0.5
LEAST_CELLS = 2
# Polygons of one cell that travel together; a cell with more is split into groups.
CELL_GROUP = 64
# Index size up to which it is sent whole to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024
# Pieces that the rows of one place are dealt into before they meet its area.
PLACE_PIECES = 8
# Levels that share tiles differ by so many doublings of their side at most, so a tile has a bounded number of cells.
TILE_SPAN = 2


@dataclass(frozen=True)
class CellIndex:
    """Polygons cut along the grid, written to the shared folder.

    ``cells`` has one row per (level, cx, cy, part): a list of polygons touching the cell.
    ``levels`` maps the exponent of each cell side in use to the estimated bytes of its cells;
    ``crowded`` says whether a cell has more than one part.
    """

    cells: DataFrame
    levels: dict[int, int]
    crowded: bool


def _cell(value: Column, side: Column) -> Column:
    return F.floor(value / side)


def _point_cell(value: Column, side: Column) -> Column:
    """Cell of a coordinate; NaN has none."""
    return F.when(~F.isnan(value), _cell(value, side))


def _crossing_state(candidate: Column, x: Column, y: Column) -> Column:
    """1 when the point is strictly inside, 0 outside, 2 on an edge."""
    turned = F.size(F.filter(candidate["turns"], lambda turn: turn <= y))

    def step(state: Column, e: Column) -> Column:
        # Only an edge whose box the point can be in, or that its ray can meet, needs its side known.
        level = (y >= F.least(e["y1"], e["y2"])) & (y <= F.greatest(e["y1"], e["y2"]))
        crosses = (e["y1"] > y) != (e["y2"] > y)
        behind = x > F.greatest(e["x1"], e["x2"])
        ahead = x < F.least(e["x1"], e["x2"])
        towards = F.when(e["y2"] > e["y1"], F.lit(1.0)).otherwise(F.lit(-1.0))
        side = orientation(e["x1"], e["y1"], e["x2"], e["y2"], x, y) * towards
        crossed = F.when(crosses, F.lit(1) - state).otherwise(state)
        return (
            F.when((state == 2) | ~level | behind, state)
            .when(ahead, crossed)
            .otherwise(F.get(F.array(state, F.lit(2), crossed), (side + 1).cast("int")))
        )

    return F.aggregate(candidate["edges"], (candidate["start"] + turned) % 2, step)


def _odd_values(values: Column) -> Column:
    """The values that occur an odd number of times: equal neighbours cancel after a sort."""

    def cancel(kept: Column, value: Column) -> Column:
        return F.when(
            F.get(kept, F.size(kept) - 1) == value, F.slice(kept, F.lit(1), F.size(kept) - 1)
        ).otherwise(F.concat(kept, F.array(value)))

    return F.aggregate(F.array_sort(values), F.array().cast("array<double>"), cancel)


def build_cells(
    polygons: DataFrame, cells_per_side: int | None = None, cell_group: int = CELL_GROUP
) -> CellIndex:
    """Cut polygons (as from ``sources.read_polygons``) along the grid.

    A polygon becomes at most ``(2 * cells_per_side + 1) ** 2`` cells, whatever its size. The number
    per side follows the detail of each polygon unless it is given.
    """
    if cells_per_side is not None:
        per_side = F.lit(float(cells_per_side))
    else:
        root = F.sqrt(F.size("edges").cast("double"))
        per_side = F.greatest(F.lit(float(LEAST_CELLS)), F.floor(root * CELLS_PER_ROOT))
    extent = F.greatest(
        F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y"), F.lit(1e-9)
    )
    level = F.floor(F.log2(extent / per_side)).cast("int")
    sized = polygons.withColumn("level", level).withColumn("side", F.pow(F.lit(2.0), "level"))

    def span(lo: str, hi: str) -> Column:
        return F.explode(F.sequence(_cell(F.col(lo), F.col("side")), _cell(F.col(hi), F.col("side"))))

    # Rows of cells. Comparing cell numbers instead of coordinates keeps every edge whose
    # extent rounds into the row.
    side, cx, cy = F.col("side"), F.col("cx"), F.col("cy")
    rows = sized.withColumn("cy", span("min_y", "max_y")).withColumn(
        "edges",
        F.filter(
            "edges",
            lambda e: (_cell(F.greatest(e["y1"], e["y2"]), side) >= cy)
            & (_cell(F.least(e["y1"], e["y2"]), side) <= cy),
        ),
    )
    # Cells of a row: edges left of the cell cannot meet a ray that starts in it, edges right
    # of it only count by their ends.
    cells = (
        rows.withColumn("cx", span("min_x", "max_x"))
        .withColumn(
            "ends",
            F.flatten(
                F.transform(
                    F.filter("edges", lambda e: _cell(F.least(e["x1"], e["x2"]), side) > cx),
                    lambda e: F.array(e["y1"], e["y2"]),
                )
            ),
        )
        .select(
            "level",
            "cx",
            "cy",
            F.struct("ord", "area_code", "area_name").alias("area"),
            (F.size(F.filter("ends", lambda end: _cell(end, side) < cy)) % 2).alias("start"),
            _odd_values(F.filter("ends", lambda end: _cell(end, side) == cy)).alias("turns"),
            F.filter(
                "edges",
                lambda e: (_cell(F.greatest(e["x1"], e["x2"]), side) >= cx)
                & (_cell(F.least(e["x1"], e["x2"]), side) <= cx),
            ).alias("edges"),
        )
        # Without an edge in it a cell lies inside the polygon or outside as a whole.
        .withColumn("covered", (F.size("edges") == 0) & (F.col("start") == 1))
        .filter((F.size("edges") > 0) | F.col("covered"))
    )
    cells = materialize(cells, "cells")

    # In a cell some polygon covers, later polygons can never be the first match.
    per_cell = cells.groupBy("level", "cx", "cy").agg(
        F.min(F.when(F.col("covered"), F.col("area"))).alias("first_cover"),
        F.count(F.lit(1)).alias("n"),
    )
    # Both sides grow with the polygons, and take up much more memory than the files that Spark judges them by.
    useful = cells.join(per_cell.hint("merge"), ["level", "cx", "cy"]).filter(
        F.col("first_cover").isNull() | (F.col("area") <= F.col("first_cover"))
    )
    # By geometry too: an area may be delivered as very many features.
    parts = useful.withColumn(
        "part", F.pmod(F.xxhash64("area", "start", "turns", "edges"), F.ceil(F.col("n") / F.lit(cell_group)))
    )
    packed = parts.groupBy("level", "cx", "cy", "part", (F.col("n") > cell_group).alias("crowded")).agg(
        F.sort_array(
            F.collect_list(F.struct("area", "covered", "start", "turns", "edges"))
        ).alias("candidates")
    )
    packed = materialize(packed, "cell-index")
    per_level = packed.groupBy("level").agg(
        F.max("crowded").alias("crowded"),
        F.sum(
            F.lit(64)
            + F.aggregate(
                "candidates",
                F.lit(0),
                lambda total, c: total + 160 + F.size(c["edges"]) * 48 + F.size(c["turns"]) * 8,
            )
        ).alias("bytes"),
    )
    # One row per cell side: a handful, whatever the number of polygons.
    summary = per_level.orderBy("level").collect()
    return CellIndex(
        cells=packed,
        levels={row["level"]: row["bytes"] for row in summary},
        crowded=any(row["crowded"] for row in summary),
    )


def _first_hit(candidates: Column, x: Column, y: Column) -> Column:
    """First area of a list that holds the point; later ones are not tested any more."""
    nothing = F.lit(None).cast("struct<ord: bigint, area_code: string, area_name: string>")
    return F.aggregate(
        candidates,
        nothing,
        lambda found, c: F.coalesce(
            found,
            F.when(c["covered"] | (_crossing_state(c, x, y) == 1), c["area"]),
        ),
    )


def locate_points(
    points: DataFrame,
    index: CellIndex,
    x: str = "Longitude",
    y: str = "Latitude",
    code: str = "area_code",
    name: str = "area_name",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left-outer join of points to the first polygon strictly containing each.

    Boundary points belong to no polygon, holes are excluded, and points without a
    coordinate are dropped. All other rows come back once, with ``code`` and ``name``, null
    outside every polygon.

    The smallest levels of the index are broadcast while they fit in ``broadcast_bytes``
    together, and for them the points never move. All other levels are met without a broadcast, in one join that
    moves the points once if their cell sides are alike, else in one join of places and one of points.
    """
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    located = points.filter(px.isNotNull() & py.isNotNull())
    # One of a few numbers for each row, whatever its place; unused where the points stay.
    piece = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in points.columns]), F.lit(PLACE_PIECES)).cast("int")
    given = located = located.withColumn("_dealt", piece)
    hits, sent, shuffled = [], 0, []
    for number, level in enumerate(sorted(index.levels, key=index.levels.get)):
        sent += index.levels[level]
        if sent > broadcast_bytes:
            shuffled.append(level)
            continue
        side = F.lit(2.0**level)
        cells = index.cells.filter((F.col("level") == level) & ~F.col("crowded")).select(
            F.col("cx").alias("_cx"), F.col("cy").alias("_cy"), "candidates"
        )
        keyed = located.withColumn("_px", _point_cell(px, side)).withColumn(
            "_py", _point_cell(py, side)
        )
        joined = keyed.join(
            F.broadcast(cells), (F.col("_px") == F.col("_cx")) & (F.col("_py") == F.col("_cy")), "left"
        )
        hit = f"_hit{number}"
        located = joined.withColumn(hit, _first_hit(F.col("candidates"), px, py)).drop(
            "_px", "_py", "_cx", "_cy", "candidates"
        )
        hits.append(hit)
    if shuffled and not index.crowded and max(shuffled) - min(shuffled) <= TILE_SPAN:
        located = _tile_hits(located, index.cells.filter(F.col("level").isin(shuffled)), max(shuffled), px, py)
        hits.append("_tile_hit")
    elif shuffled or index.crowded:
        cells = index.cells.filter(F.col("crowded") | F.col("level").isin(shuffled))
        levels = list(index.levels) if index.crowded else shuffled
        located = _shuffled_hits(located, given, cells, levels, px, py)
        hits.append("_shuffled_hit")
    if not hits:
        first = F.lit(None).cast("struct<area_code: string, area_name: string>")
    elif len(hits) == 1:
        first = F.col(hits[0])
    else:
        first = F.least(*hits)
    return located.withColumn("_first", first).select(
        *[F.col(f"`{c}`") for c in points.columns],
        F.col("_first.area_code").alias(code),
        F.col("_first.area_name").alias(name),
    )


def _tile_hits(points: DataFrame, cells: DataFrame, level: int, px: Column, py: Column) -> DataFrame:
    """Adds ``_tile_hit``, the first area over the cells of a point, one a level at most.

    A tile is a cell of ``level``, the largest side, with all cells of smaller sides in it. The points are moved
    once, those of one tile in several pieces, each of which gets the tile.
    """
    tiles = cells.groupBy(
        F.expr(f"shiftright(cx, {level} - level)").alias("_cx"), F.expr(f"shiftright(cy, {level} - level)").alias("_cy")
    ).agg(F.collect_list(F.struct(F.pow(F.lit(2.0), "level").alias("side"), "cx", "cy", "candidates")).alias("_cells"))
    tiles = tiles.withColumn("_piece", F.explode(F.sequence(F.lit(0), F.lit(PLACE_PIECES - 1))))
    side = F.lit(2.0**level)
    keyed = points.withColumns({"_px": _point_cell(px, side), "_py": _point_cell(py, side)})
    same = (F.col("_px") == F.col("_cx")) & (F.col("_py") == F.col("_cy")) & (F.col("_dealt") == F.col("_piece"))
    joined = keyed.join(tiles.hint("merge"), same, "left")
    mine = F.filter("_cells", lambda c: (c["cx"] == _cell(px, c["side"])) & (c["cy"] == _cell(py, c["side"])))
    hit = F.array_min(F.transform(mine, lambda c: _first_hit(c["candidates"], px, py)))
    return joined.withColumn("_tile_hit", hit).drop("_px", "_py", "_dealt", "_cx", "_cy", "_piece", "_cells")


def _shuffled_hits(
    points: DataFrame, given: DataFrame, cells: DataFrame, levels: list[int], px: Column, py: Column
) -> DataFrame:
    """Adds ``_shuffled_hit``, the first area over all parts of all cells of a point.

    Works on distinct coordinates, so a place that repeats in very many rows is tested once for each of a few pieces
    its rows are dealt into: each place meets its cells of all levels in one equi-join, and only the last join moves
    the points. Both sides of both joins grow with the points or the polygons, so neither is ever sent whole,
    however small Spark takes it for. ``given`` is the points before any broadcast join, which the places need not repeat.
    """
    places = given.select(px.alias("_x"), py.alias("_y"), F.col("_dealt").alias("_piece")).distinct()
    keys = F.array(
        *[
            F.struct(
                F.lit(level).alias("level"),
                _point_cell(F.col("_x"), F.lit(2.0**level)).alias("cx"),
                _point_cell(F.col("_y"), F.lit(2.0**level)).alias("cy"),
            )
            for level in levels
        ]
    )
    met = places.select("_x", "_y", "_piece", F.inline(keys)).join(cells.hint("merge"), ["level", "cx", "cy"])
    best = (
        met.select("_x", "_y", "_piece", _first_hit(F.col("candidates"), F.col("_x"), F.col("_y")).alias("_hit"))
        .filter(F.col("_hit").isNotNull())
        .groupBy("_x", "_y", "_piece")
        .agg(F.min("_hit").alias("_shuffled_hit"))
    )
    same = (px == F.col("_x")) & (py == F.col("_y")) & (F.col("_dealt") == F.col("_piece"))
    return points.join(best.hint("merge"), same, "left").drop("_x", "_y", "_piece", "_dealt")

"""Joins by position: tile equi-join, then the exact predicate on the piece of the polygon in that tile."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from .skew import HOT_ROWS, salted_join
from .tiling import TILE, crowded_tiles, point_tiles, step_of, tile_pieces

CAPACITY = 4_000


def _pieces(polygons: DataFrame, key: str, size: float, crowded, margin: float) -> DataFrame:
    cut = tile_pieces(polygons.select(key, "geom"), size, crowded, margin)
    return cut.select(key, *TILE, G.edges(F.col("geom")).alias("es"), G.bbox(F.col("geom")).alias("b"))


def _near(x: Column, y: Column, reach: float = 0.0) -> Column:
    """Plain comparisons with the box of the piece, before any edge is looked at."""
    return (x >= F.col("b.xmin") - reach) & (x <= F.col("b.xmax") + reach) & (y >= F.col("b.ymin") - reach) & (y <= F.col("b.ymax") + reach)


def points_in_polygons(points: DataFrame, polygons: DataFrame, size: float, predicate: str = "within",
                       hot_rows: int = HOT_ROWS) -> DataFrame:
    """points(pid, x, y) × polygons(gid, geom) → (pid, gid). ``within`` leaves points on a boundary out,
    ``intersects`` lets them in. The pieces reach a little beyond their tile, so a tile border is no boundary."""
    crowded = crowded_tiles(polygons, size, CAPACITY)
    placed = point_tiles(points.select("pid", "x", "y"), "x", "y", size, crowded)
    pieces = _pieces(polygons, "gid", size, crowded, margin=size * 1e-3)
    joined = salted_join(placed, pieces, TILE, "pid", hot_rows=hot_rows)
    test = G.point_within if predicate == "within" else G.point_intersects
    return joined.where(_near(F.col("x"), F.col("y"))).where(test(F.col("es"), F.col("x"), F.col("y"))).select("pid", "gid")


def points_semi(points: DataFrame, polygons: DataFrame, size: float, predicate: str = "within") -> DataFrame:
    """Ids of the points that lie in some polygon."""
    return points_in_polygons(points, polygons, size, predicate).select("pid").distinct()


def first_polygon(points: DataFrame, polygons: DataFrame, size: float, predicate: str = "within") -> DataFrame:
    """Every point with its first polygon by id, or null."""
    best = points_in_polygons(points, polygons, size, predicate).groupBy("pid").agg(F.min("gid").alias("gid"))
    return points.select("pid").join(best, "pid", "left")


def _touch(a: Column, b: Column) -> Column:
    """Do two closed segments share a point?"""
    def side(e: Column, x: Column, y: Column) -> Column:
        return F.signum((e["x1"] - e["x0"]) * (y - e["y0"]) - (e["y1"] - e["y0"]) * (x - e["x0"]))

    boxes = ((F.least(a["x0"], a["x1"]) <= F.greatest(b["x0"], b["x1"])) & (F.least(b["x0"], b["x1"]) <= F.greatest(a["x0"], a["x1"]))
             & (F.least(a["y0"], a["y1"]) <= F.greatest(b["y0"], b["y1"])) & (F.least(b["y0"], b["y1"]) <= F.greatest(a["y0"], a["y1"])))
    return (boxes & (side(a, b["x0"], b["y0"]) * side(a, b["x1"], b["y1"]) <= 0)
            & (side(b, a["x0"], a["y0"]) * side(b, a["x1"], a["y1"]) <= 0))


def _ring_pieces(polygons: DataFrame, key: str, size: float, crowded, margin: float) -> DataFrame:
    """Pieces with all their edges (``es``, for parity), those that are no work of the cut (``own``) and one corner of every
    ring (``corners``). An edge along a line of the cut lies inside the next tile and is met there."""
    cut = tile_pieces(polygons.select(key, "geom"), size, crowded, margin)
    lines = {f"{axis}{end}": F.expr(f"(t{axis} + {end}) * {step_of(axis, size)} {'+' if end else '-'} {float(margin)!r}D") for axis in "xy" for end in (0, 1)}

    def along(e: Column, axis: str) -> Column:
        return (e[f"{axis}0"] == e[f"{axis}1"]) & ((e[f"{axis}0"] == F.col(f"_{axis}0")) | (e[f"{axis}0"] == F.col(f"_{axis}1")))

    edged = cut.withColumns({f"_{k}": v for k, v in lines.items()} | {"es": G.edges(F.col("geom"))})
    return edged.select(key, *TILE, "es", F.filter("es", lambda e: ~along(e, "x") & ~along(e, "y")).alias("own"),
                        F.expr("transform(flatten(geom), r -> r[0])").alias("corners"), G.bbox(F.col("geom")).alias("b"))


def polygons_intersect(left: DataFrame, right: DataFrame, size: float, hot_rows: int = HOT_ROWS) -> DataFrame:
    """left(lid, geom) × right(rid, geom) → distinct (lid, rid) that share at least a point."""
    both = left.select("geom").unionByName(right.select("geom"))
    crowded = crowded_tiles(both, size, CAPACITY)
    margin = size * 1e-3
    joined = salted_join(_ring_pieces(left, "lid", size, crowded, margin),
                         _ring_pieces(right, "rid", size, crowded, margin).withColumnsRenamed({"es": "fs", "own": "f_own", "corners": "f_corners", "b": "c"}), TILE, "lid", hot_rows=hot_rows)
    joined = joined.where((F.col("b.xmin") <= F.col("c.xmax")) & (F.col("b.xmax") >= F.col("c.xmin"))
                          & (F.col("b.ymin") <= F.col("c.ymax")) & (F.col("b.ymax") >= F.col("c.ymin")))

    es, fs = F.col("es"), F.col("fs")
    meets = (F.exists("corners", lambda p: G.covers_inside(fs, p["x"], p["y"])) | F.exists("f_corners", lambda p: G.covers_inside(es, p["x"], p["y"]))
             | F.exists("own", lambda a: F.exists("f_own", lambda b: _touch(a, b))))
    return joined.where(meets).select("lid", "rid").distinct()


def near_candidates(points: DataFrame, polygons: DataFrame, max_distance: float, size: float,
                    hot_rows: int = HOT_ROWS, own_prefix: str | None = None) -> DataFrame:
    """points(pid, x, y) × polygons(gid, geom) → (pid, gid, within, distance) up to ``max_distance``. Pieces reach
    ``max_distance`` beyond their tile, so one tile holds every candidate. With ``own_prefix`` only polygons whose id has
    the same part before that mark are candidates."""
    crowded = crowded_tiles(polygons, size, CAPACITY)
    placed = point_tiles(points.select("pid", "x", "y"), "x", "y", size, crowded)
    pieces = _pieces(polygons, "gid", size, crowded, margin=max_distance * 1.001)
    joined = salted_join(placed, pieces, TILE, "pid", hot_rows=hot_rows)
    if own_prefix is not None:
        joined = joined.where(F.substring_index("pid", own_prefix, 1) == F.substring_index("gid", own_prefix, 1))
    x, y = F.col("x"), F.col("y")
    joined = joined.where(_near(x, y, max_distance))
    distance = F.when(G.covers_inside(F.col("es"), x, y), 0.0).otherwise(G.boundary_distance(F.col("es"), x, y))
    rows = joined.select("pid", "gid", G.point_within(F.col("es"), x, y).alias("within"), distance.alias("distance"))
    return rows.where(F.col("distance") <= max_distance)


def nearest_polygon(points: DataFrame, polygons: DataFrame, max_distance: float, size: float, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(pid, gid, distance) of the nearest polygon not farther than ``max_distance``; equal distances go to the lower id."""
    near = near_candidates(points, polygons, max_distance, size, hot_rows)
    return near.groupBy("pid").agg(F.min(F.struct("distance", "gid")).alias("m")).select("pid", "m.gid", "m.distance")


def neighbours(areas: DataFrame, chosen: DataFrame, size: float) -> DataFrame:
    """Ids of ``areas(gid, geom)`` that touch one of the ``chosen(gid)`` areas, the chosen ones included."""
    right = areas.join(chosen, "gid", "left_semi").select(F.col("gid").alias("rid"), "geom")
    return polygons_intersect(areas.select(F.col("gid").alias("lid"), "geom"), right, size).select(F.col("lid").alias("gid")).distinct()


def box_filter(df: DataFrame, xmin: float, ymin: float, xmax: float, ymax: float) -> DataFrame:
    """Rows whose covering box meets a box: plain comparisons on ``bbox`` that reach the Parquet scan."""
    return df.where((F.col("bbox.xmin") <= xmax) & (F.col("bbox.xmax") >= xmin) & (F.col("bbox.ymin") <= ymax) & (F.col("bbox.ymax") >= ymin))

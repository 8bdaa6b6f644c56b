"""Geometry as nested arrays: multipolygon → polygon → ring → point(x, y), rings closed.

Every expression runs inside Catalyst (higher-order functions), so a geometry column stays readable by
Parquet, by plain SQL and by other engines.
"""
from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import half_even

POINT = "struct<x:double,y:double>"
GEOMETRY = f"array<array<array<{POINT}>>>"
EDGES = "array<struct<x0:double,y0:double,x1:double,y1:double>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside an expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Axis-parallel rectangle, counter-clockwise."""
    return F.array(F.array(F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1), point(x0, y0))))


def from_coordinates(polygons: Column) -> Column:
    """GeoJSON MultiPolygon coordinates (nested arrays of numbers) → geometry."""
    return F.transform(polygons, lambda poly: F.transform(poly, lambda ring: F.transform(ring, lambda c: point(c[0], c[1]))))


def to_coordinates(geom: Column, digits: int | None = None) -> Column:
    def number(c: Column) -> Column:
        return c if digits is None else half_even(c, digits)

    return F.transform(geom, lambda poly: F.transform(
        poly, lambda ring: F.transform(ring, lambda p: F.array(number(p["x"]), number(p["y"])))))


def map_points(geom: Column, x: Callable[[Column, Column], Column], y: Callable[[Column, Column], Column]) -> Column:
    return F.transform(geom, lambda poly: F.transform(poly, lambda ring: F.transform(
        ring, lambda p: point(x(p["x"], p["y"]), y(p["x"], p["y"])))))


def rings(geom: Column) -> Column:
    return F.flatten(geom)


def vertices(geom: Column) -> Column:
    return F.flatten(F.flatten(geom))


def _column_name(value: Column) -> str | None:
    """Name of a plain column; None for expressions and lambda arguments."""
    name = value._jc.toString()
    plain = re.fullmatch(r"[A-Za-z_]\w*(\.\w+)*", name) and not re.fullmatch(r"[xyz]_\d+", name)
    return name if plain else None


def _segments_sql(ring: str) -> str:
    n = f"greatest(size({ring}) - 1, 0)"
    return (f"zip_with(slice({ring}, 1, {n}), slice({ring}, 2, {n}), "
            "(a, b) -> named_struct('x0', a.x, 'y0', a.y, 'x1', b.x, 'y1', b.y))")


def _edges_sql(geom: str) -> str:
    return f"flatten(transform(flatten({geom}), r -> {_segments_sql('r')}))"


def _ring_area_sql(ring: str) -> str:
    return f"aggregate({_segments_sql(ring)}, 0D, (s, e) -> s + (e.x0 * e.y1 - e.x1 * e.y0)) / 2"


def _area_sql(geom: str) -> str:
    rings_ = f"transform(poly, r -> abs({_ring_area_sql('r')}))"
    one = f"get(transform(array({rings_}), v -> 2 * coalesce(get(v, 0), 0D) - aggregate(v, 0D, (s, w) -> s + w)), 0)"
    return f"aggregate(transform({geom}, poly -> {one}), 0D, (s, w) -> s + w)"


def _bbox_sql(geom: str) -> str:
    return (f"get(transform(array(flatten(flatten({geom}))), v -> named_struct('xmin', array_min(transform(v, p -> p.x)), 'ymin', array_min(transform(v, p -> p.y)), "
            "'xmax', array_max(transform(v, p -> p.x)), 'ymax', array_max(transform(v, p -> p.y)))), 0)")


def _interior_sql(geom: str) -> str:
    largest = f"array_max(transform({geom}, q -> named_struct('a', {_area_sql('array(q)')}, 'g', array(q)))).g"
    at_level = ("array_sort(transform(filter(es, e -> (e.y0 <= y) <> (e.y1 <= y)), "
                "e -> e.x0 + (y - e.y0) / (e.y1 - e.y0) * (e.x1 - e.x0)))")
    gap = ("array_max(transform(sequence(0, greatest(CAST(floor(size(xs) / 2) AS INT) - 1, 0)), k -> named_struct("
           "'w', get(xs, 2 * k + 1) - get(xs, 2 * k), 'x', (get(xs, 2 * k + 1) + get(xs, 2 * k)) / 2))).x")
    point_ = f"get(transform(array({at_level}), xs -> named_struct('x', {gap}, 'y', y)), 0)"
    per_edges = f"get(transform(array((array_min(transform(es, e -> e.y0)) + array_max(transform(es, e -> e.y0))) / 2), y -> {point_}), 0)"
    return f"get(transform(transform(array({largest}), g1 -> {_edges_sql('g1')}), es -> {per_edges}), 0)"


def segments(ring: Column) -> Column:
    n = F.greatest(F.size(ring) - 1, F.lit(0))
    return F.zip_with(F.slice(ring, F.lit(1), n), F.slice(ring, F.lit(2), n), lambda a, b: F.struct(
        a["x"].alias("x0"), a["y"].alias("y0"), b["x"].alias("x1"), b["y"].alias("y1")))


def edges(geom: Column) -> Column:
    """All directed edges. Plain columns go through SQL text: one expression instead of many calls into the JVM."""
    name = _column_name(geom)
    return F.expr(_edges_sql(name)) if name else F.flatten(F.transform(rings(geom), segments))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def wound(geom: Column) -> Column:
    """Outer rings counter-clockwise, holes clockwise."""
    def turned(ring: Column, outer: Column) -> Column:
        return F.when((ring_signed_area(ring) < 0) == outer, F.reverse(ring)).otherwise(ring)

    return F.transform(geom, lambda poly: F.transform(poly, lambda ring, i: turned(ring, i == 0)))


def ring_signed_area(ring: Column) -> Column:
    return _sum(F.transform(segments(ring), lambda e: e["x0"] * e["y1"] - e["x1"] * e["y0"])) / 2


def area(geom: Column) -> Column:
    """Outer rings minus holes, whatever the ring direction."""
    name = _column_name(geom)
    if name:
        return F.expr(_area_sql(name))

    def polygon(poly: Column) -> Column:
        sizes = F.transform(poly, lambda r: F.abs(ring_signed_area(r)))
        return let(sizes, lambda a: 2 * F.coalesce(F.get(a, F.lit(0)), F.lit(0.0)) - _sum(a))

    return _sum(F.transform(geom, polygon))


def bbox(geom: Column) -> Column:
    name = _column_name(geom)
    if name:
        return F.expr(_bbox_sql(name))
    return let(vertices(geom), lambda v: F.struct(
        F.array_min(F.transform(v, lambda p: p["x"])).alias("xmin"), F.array_min(F.transform(v, lambda p: p["y"])).alias("ymin"),
        F.array_max(F.transform(v, lambda p: p["x"])).alias("xmax"), F.array_max(F.transform(v, lambda p: p["y"])).alias("ymax")))


def centroid_x(geom: Column) -> Column:
    """x of the area centroid (outer rings counter-clockwise, holes clockwise)."""
    def cross(e: Column) -> Column:
        return e["x0"] * e["y1"] - e["x1"] * e["y0"]

    return let(edges(geom), lambda es: _sum(F.transform(es, lambda e: (e["x0"] + e["x1"]) * cross(e)))
               / (3 * _sum(F.transform(es, cross))))


def part_count(geom: Column) -> Column:
    return F.size(geom)


def is_empty(geom: Column) -> Column:
    return geom.isNull() | (F.coalesce(F.size(vertices(geom)), F.lit(0)) < 4)


def crosses_itself(geom: Column) -> Column:
    """True when two edges of the geometry cross properly (bow-tie rings)."""
    def side(ax, ay, bx, by, px, py):
        return F.signum((bx - ax) * (py - ay) - (by - ay) * (px - ax))

    def proper(a: Column, b: Column) -> Column:
        s1 = side(a["x0"], a["y0"], a["x1"], a["y1"], b["x0"], b["y0"])
        s2 = side(a["x0"], a["y0"], a["x1"], a["y1"], b["x1"], b["y1"])
        s3 = side(b["x0"], b["y0"], b["x1"], b["y1"], a["x0"], a["y0"])
        s4 = side(b["x0"], b["y0"], b["x1"], b["y1"], a["x1"], a["y1"])
        return (s1 * s2 < 0) & (s3 * s4 < 0)

    return let(edges(geom), lambda es: F.exists(es, lambda a: F.exists(es, lambda b: proper(a, b))))


def interior_point(geom: Column) -> Column:
    """A point inside: middle of the widest stretch at mid height of the largest part (of a plain column)."""
    name = _column_name(geom)
    if name is None:
        raise ValueError("interior_point needs a plain column")
    return F.expr(_interior_sql(name))


def covers_inside(es: Column, x: Column, y: Column) -> Column:
    """Even-odd test of (x, y) against an edge list; points on the boundary may fall either way."""
    hits = F.filter(es, lambda e: ((e["y0"] <= y) != (e["y1"] <= y)) & (
        x < e["x0"] + (y - e["y0"]) / (e["y1"] - e["y0"]) * (e["x1"] - e["x0"])))
    return F.size(hits) % 2 == 1


def on_boundary(es: Column, x: Column, y: Column) -> Column:
    return F.exists(es, lambda e: (
        ((e["x1"] - e["x0"]) * (y - e["y0"]) == (e["y1"] - e["y0"]) * (x - e["x0"]))
        & x.between(F.least(e["x0"], e["x1"]), F.greatest(e["x0"], e["x1"]))
        & y.between(F.least(e["y0"], e["y1"]), F.greatest(e["y0"], e["y1"]))))


def point_within(es: Column, x: Column, y: Column) -> Column:
    """Strictly inside."""
    return covers_inside(es, x, y) & ~on_boundary(es, x, y)


def point_intersects(es: Column, x: Column, y: Column) -> Column:
    """Inside or on the boundary."""
    return covers_inside(es, x, y) | on_boundary(es, x, y)


def segment_distance(e: Column, x: Column, y: Column) -> Column:
    dx, dy = e["x1"] - e["x0"], e["y1"] - e["y0"]
    length2 = dx * dx + dy * dy
    t = F.when(length2 > 0, ((x - e["x0"]) * dx + (y - e["y0"]) * dy) / length2).otherwise(0.0)
    t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
    return let(t, lambda t: F.sqrt(F.pow(e["x0"] + t * dx - x, 2) + F.pow(e["y0"] + t * dy - y, 2)))


def boundary_distance(es: Column, x: Column, y: Column) -> Column:
    return F.array_min(F.transform(es, lambda e: segment_distance(e, x, y)))


def ground_distance(lon0: Column, lat0: Column, lon1: Column, lat1: Column) -> Column:
    """Metres between two nearby lon/lat points (111 320·cos φ and 110 574 m per degree)."""
    return F.sqrt(F.pow((lon0 - lon1) * 111320.0 * F.cos(F.radians(lat1)), 2) + F.pow((lat0 - lat1) * 110574.0, 2))


def shape_id(geom: Column) -> Column:
    """12 hexadecimal digits of the exact shape: equal shapes share it."""
    return F.substring(F.sha2(F.to_json(geom), 256), 1, 12)


def _clip_ring_sql(ring: str, axis: str, low: str, high: str) -> str:
    """Part of a closed ring between two parallels to the other axis (kept closed)."""
    o = "y" if axis == "x" else "x"

    def at(t: str) -> str:
        along = f"CASE WHEN {t} >= 1 THEN e.{axis}1 WHEN {t} <= 0 THEN e.{axis}0 ELSE least(greatest(e.{axis}0 + {t} * (e.{axis}1 - e.{axis}0), {low}), {high}) END"
        across = f"CASE WHEN {t} >= 1 THEN e.{o}1 WHEN {t} <= 0 THEN e.{o}0 ELSE e.{o}0 + {t} * (e.{o}1 - e.{o}0) END"
        x, y = (along, across) if axis == "x" else (across, along)
        return f"named_struct('x', {x}, 'y', {y})"

    d = f"(e.{axis}1 - e.{axis}0)"
    inside = f"e.{axis}0 BETWEEN {low} AND {high}"
    enter = f"CASE WHEN {d} > 0 THEN ({low} - e.{axis}0) / {d} WHEN {d} < 0 THEN ({high} - e.{axis}0) / {d} WHEN {inside} THEN 0D ELSE 2D END"
    leave = f"CASE WHEN {d} > 0 THEN ({high} - e.{axis}0) / {d} WHEN {d} < 0 THEN ({low} - e.{axis}0) / {d} WHEN {inside} THEN 1D ELSE -1D END"
    span = f"named_struct('a', greatest({enter}, 0D), 'b', least({leave}, 1D))"
    points = (f"get(transform(array({span}), s -> CASE WHEN s.a > s.b THEN CAST(array() AS array<{POINT}>) "
              f"WHEN s.a > 0 THEN array({at('s.a')}, {at('s.b')}) ELSE array({at('s.b')}) END), 0)")
    kept = f"flatten(transform({_segments_sql(ring)}, e -> {points}))"
    return f"get(transform(array({kept}), c -> CASE WHEN size(c) >= 3 THEN concat(c, slice(c, 1, 1)) ELSE slice(c, 1, 0) END), 0)"


def clip_axis(geom: str, axis: str, low: str, high: str) -> Column:
    """Geometry column cut to a band given by two SQL expressions; rings left without area vanish (parity is kept)."""
    one = _clip_ring_sql("r", axis, f"CAST({low} AS DOUBLE)", f"CAST({high} AS DOUBLE)")
    rings_ = f"filter(transform(poly, r -> {one}), r -> size(r) >= 4)"
    return F.expr(f"filter(transform({geom}, poly -> {rings_}), poly -> size(poly) > 0)")

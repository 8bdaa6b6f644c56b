"""Shapes enlarged by a distance, and the mask of a territory built from them."""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..session import truncate_lineage
from .overlay import overlay
from .shapes import dissolve, simplify

#: Segments of a quarter of a circle.
QUARTER = 16


def _covered(items: DataFrame, key: str, size: float) -> DataFrame:
    """One outline per key of all that ``items(item.k, geom)`` cover."""
    cells = overlay(items, size, shapes=True)
    each = cells.withColumn(key, F.explode(F.array_distinct(F.transform("active", lambda a: a["k"]))))
    return dissolve(each, [key])


def union(df: DataFrame, key: str, part: str, size: float) -> DataFrame:
    """``df(key, part, geom)`` dissolved by ``key``: one row for each; ``part`` tells the shapes of a key apart."""
    return _covered(df.select(F.struct(F.col(key).alias("k"), F.col(part).alias("part")).alias("item"), "geom"), key, size)


def _ring(*points: Column) -> Column:
    return F.array(*points, points[0])


def outward(outlines: DataFrame, key: str, distance: float, size: float, quarter: int = QUARTER) -> DataFrame:
    """Outlines (ground on the left, as :func:`dissolve` makes them) with all ground within ``distance``.

    Each edge adds a strip on its outer side, each corner that turns outwards a fan of ``quarter`` segments to the right
    angle, and everything is dissolved once more. Strips and fans are rows of their own, so the work is spread however
    long the outline is. Holes shrink, and close where they are narrow.
    """
    c = F.col
    ring = c("ring")
    corner = F.transform(F.sequence(F.lit(0), F.size(ring) - 2), lambda i: F.struct(
        F.get(ring, F.when(i == 0, F.size(ring) - 2).otherwise(i - 1)).alias("a"), F.get(ring, i).alias("b"), F.get(ring, i + 1).alias("c")))
    corners = (outlines.select(c(key).alias("k"), F.explode(F.flatten("geom")).alias("ring")).where(F.size(ring) > 3)
               .select("k", F.explode(corner).alias("v")).select("k", "v.*"))

    def unit(p: str, q: str) -> Column:
        dx, dy = c(f"{q}.x") - c(f"{p}.x"), c(f"{q}.y") - c(f"{p}.y")
        long = F.sqrt(dx * dx + dy * dy)
        return F.struct((dx / long).alias("x"), (dy / long).alias("y"))

    turned = corners.withColumns({"u": unit("a", "b"), "w": unit("b", "c")}).where("u.x IS NOT NULL AND w.x IS NOT NULL")
    turned = turned.withColumn("turn", F.atan2(c("u.x") * c("w.y") - c("u.y") * c("w.x"), c("u.x") * c("w.x") + c("u.y") * c("w.y")))
    ox, oy = c("w.y") * distance, -c("w.x") * distance
    strip = _ring(c("b"), G.point(c("b.x") + ox, c("b.y") + oy), G.point(c("c.x") + ox, c("c.y") + oy), c("c"))
    steps = F.greatest(F.lit(1), F.floor(c("turn") / (math.pi / 2 / quarter) + 0.5).cast("int"))
    arc = F.transform(F.sequence(F.lit(0), steps), lambda i: G.let(c("turn") * i / steps, lambda t: G.point(
        c("b.x") + distance * (c("u.y") * F.cos(t) + c("u.x") * F.sin(t)), c("b.y") + distance * (c("u.y") * F.sin(t) - c("u.x") * F.cos(t)))))
    fan = F.when(c("turn") > 1e-9, F.concat(F.array(c("b")), arc, F.array(c("b"))))
    added = turned.select("k", "b", "c", F.posexplode(F.array(strip, fan)).alias("kind", "ring")).where("ring IS NOT NULL")
    item = F.struct("k", (c("kind") + 1).alias("kind"), *[c(f"{p}.{v}").alias(p + v) for p in "bc" for v in "xy"])
    own = outlines.select(F.struct(c(key).alias("k"), F.lit(0).alias("kind"), *[F.lit(0.0).alias(p + v) for p in "bc" for v in "xy"]).alias("item"), "geom")
    return _covered(own.unionByName(added.select(item.alias("item"), F.array(F.array("ring")).alias("geom"))), key, size)


def territory_mask(df: DataFrame, key: str, part: str, box: tuple[float, float, float, float] | None, tolerance: float, margin: float, size: float) -> DataFrame:
    """Mask of each territory ``key``: its shapes (told apart by ``part``) united, cut to ``box`` (xmin, ymin, xmax, ymax; not
    cut without one), thinned to ``tolerance`` and enlarged by ``margin``. ``size``: side of the tiles the work is dealt to.
    Shapes outside the box leave no row. Invalid shapes need no repair, parity decides."""
    if box is not None:
        for axis, low, high in (("x", box[0], box[2]), ("y", box[1], box[3])):
            df = df.withColumn("geom", G.clip_axis("geom", axis, f"{float(low)!r}D", f"{float(high)!r}D"))
        df = df.where(F.size("geom") > 0)
    return outward(truncate_lineage(simplify(union(df, key, part, size), tolerance)), key, margin, size)

"""Vector tiles over zooms: every zoom cut from the pieces of the zoom above it, thinned at its own tolerance."""
from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import crs as C
from ..functions.numeric import half_even
from ..session import truncate_lineage
from .shapes import simplify

#: Units of a tile's side, and units kept beyond each of its sides (fixed values of the tile format).
EXTENT, BUFFER = 4_096, 80
LAT_MAX = 85.0511


def _unit(geom: str):
    """Degrees → the unit square of all tiles, y downwards."""
    def down(_, lat):
        s = F.sin(F.radians(F.least(F.greatest(lat, F.lit(-LAT_MAX)), F.lit(LAT_MAX))))
        return 0.5 - F.ln((1 + s) / (1 - s)) / (4 * math.pi)

    return G.map_points(F.col(geom), lambda lon, _: (lon + 180) / 360, down)


def tile_pyramid(features: DataFrame, key: str, zooms: tuple[int, int], tolerance: float = 1.0, extent: int = EXTENT, buffer: int = BUFFER, whole: bool = True) -> DataFrame:
    """``features(key, geom)`` in degrees as pieces of tiles: ``z, x, y, key, geom`` in tile units (``extent`` for a side, y
    downwards), with ``buffer`` units beyond the tile.

    The pieces of a zoom are the exact cuts of those of its parent tiles, whose own buffer holds all that the children
    need; the shapes are dealt out by key and stored once, and so is each zoom. Only what is given out is thinned to ``tolerance`` units and, if ``whole``, rounded, so
    errors do not add up over zooms. Pieces that thinning leaves without area stay as the three points of a sliver. Null
    and empty shapes have no pieces.
    """
    first, last = zooms
    # dealt out and stored before anything else looks at the shape: what follows reads it a dozen times, and a filter would
    # otherwise move in front of the deal, into the few tasks of a small file
    tasks = int(features.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = features.select(F.col(key).alias("k"), "geom").repartition(tasks, "k")
    pieces = truncate_lineage(dealt.select("k", _unit("geom").alias("geom"))).where(~G.is_empty(F.col("geom"))).withColumns({"x": F.lit(0).cast("long"), "y": F.lit(0).cast("long")})
    out = None
    for z in range(first, last + 1):
        size = 2.0 ** -z
        margin = size * buffer / extent
        boxed = pieces.withColumn("_b", G.bbox(F.col("geom")))
        step = 2 ** first if z == first else 2  # children of each tile along a side
        for axis in "xy":
            low = F.floor((F.col(f"_b.{axis}min") - margin) / size)
            high = F.floor((F.col(f"_b.{axis}max") + margin) / size)
            boxed = boxed.withColumn(f"_{axis}0", F.greatest(F.col(axis) * step, low)).withColumn(f"_{axis}1", F.least(F.col(axis) * step + step - 1, high))
        boxed = boxed.where("_x0 <= _x1 AND _y0 <= _y1")
        for axis in "xy":
            boxed = boxed.withColumn(axis, F.explode(F.sequence(f"_{axis}0", f"_{axis}1")))
            low, high = f"{axis} * {size!r}D - {margin!r}D", f"({axis} + 1) * {size!r}D + {margin!r}D"
            beyond = F.expr(f"_b.{axis}min < {low} OR _b.{axis}max > {high}")
            boxed = boxed.withColumn("geom", F.when(beyond, G.clip_axis("geom", axis, low, high)).otherwise(F.col("geom")))
        pieces = truncate_lineage(boxed.where(F.size("geom") > 0).select("k", "x", "y", "geom"))
        scale = extent / size
        local = pieces.withColumn("geom", G.map_points(F.col("geom"), lambda px, _: px * scale - F.col("x") * extent, lambda _, py: py * scale - F.col("y") * extent))
        own = local.select(F.lit(z).alias("z"), "x", "y", F.col("k").alias(key), "geom")
        out = own if out is None else out.unionByName(own)
    out = simplify(out, tolerance)
    return out.withColumn("geom", G.map_points(F.col("geom"), lambda px, _: F.rint(px), lambda _, py: F.rint(py))) if whole else out


def display_outlines(comunas: DataFrame, tolerance: float = 40.0) -> DataFrame:
    """Outlines for the map: ``cut, nombre, bbox, geom`` in degrees, thinned to ``tolerance`` metres; the box (west, south,
    east, north) to four digits, coordinates to five. comunas(cut, comuna, geom in degrees)."""
    thin = simplify(comunas.select("cut", F.col("comuna").alias("nombre"), C.to_albers(F.col("geom")).alias("geom")), tolerance)
    back = thin.withColumn("geom", C.to_lonlat(F.col("geom"))).withColumn("_b", G.bbox(F.col("geom")))
    box = F.array(*[half_even(F.col(f"_b.{c}"), 4) for c in ("xmin", "ymin", "xmax", "ymax")])
    return back.select("cut", "nombre", box.alias("bbox"), G.map_points(F.col("geom"), lambda x, _: half_even(x, 5), lambda _, y: half_even(y, 5)).alias("geom"))

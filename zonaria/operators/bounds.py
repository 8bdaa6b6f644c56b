"""Covering boxes of groups of shapes, with a margin."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import crs as C
from ..functions import geometry as G
from ..functions import text as X
from ..functions.numeric import half_even

DIGITS = 6


def group_boxes(df: DataFrame, keys: list[str], margin: float = 0.0, geom: str = "geom") -> DataFrame:
    """(keys…, xmin, ymin, xmax, ymax) around all shapes of a group, ``margin`` wider on each side, in the units of the shapes.
    Groups without any vertex have no row. Partial boxes are merged before the shuffle."""
    b = df.select(*keys, G.bbox(F.col(geom)).alias("b")).where("b.xmin IS NOT NULL")
    return b.groupBy(*keys).agg(*[(f(f"b.{c}") + sign * margin).alias(c) for c, f, sign in (
        ("xmin", F.min, -1), ("ymin", F.min, -1), ("xmax", F.max, 1), ("ymax", F.max, 1))])


def lonlat_boxes(boxes: DataFrame) -> DataFrame:
    """Metric boxes → lon/lat boxes of their lower left and upper right corner, to six digits."""
    corners = boxes.withColumns({"_a": C.albers_lonlat(F.col("xmin"), F.col("ymin")), "_b": C.albers_lonlat(F.col("xmax"), F.col("ymax"))})
    sides = {f"{axis}{end}": half_even(pick(f"_a.{axis}", f"_b.{axis}"), DIGITS) for axis in "xy" for end, pick in (("min", F.least), ("max", F.greatest))}
    return corners.withColumns(sides).drop("_a", "_b")


def comuna_list(comunas: DataFrame) -> DataFrame:
    """comunas(cut, comuna, region, geom in lon/lat) → the list for a search field: cut, nombre, region, bbox to six digits,
    in the order of the folded name (ties by code)."""
    b = comunas.withColumn("_b", G.bbox(F.col("geom")))
    box = F.array(*[half_even(F.col(f"_b.{c}"), DIGITS) for c in ("xmin", "ymin", "xmax", "ymax")])
    return b.orderBy(X.norm_text(F.col("comuna")), "cut").select("cut", F.col("comuna").alias("nombre"), "region", box.alias("bbox"))

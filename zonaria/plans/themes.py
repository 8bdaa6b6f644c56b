"""Thematic rasters from source to tiles: climate, soil, cover, relief, division; each a plan over blocks.

A source is a block table (see ``operators.blocks``) with its place as a dictionary (west, north, res, height, width). Results
are coloured tiles ``z, x, y, opacos, rgba``; ``mask(mid, geom)`` in degrees is the territory to show.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scales as S
from ..operators import blocks as B
from ..operators.raster import vector_tiles
from ..session import truncate_lineage

Ramp = list[tuple[float, str]]


def climate(blocks: DataFrame, raster: dict, ramp: Ramp, zooms: tuple[int, int], mask: DataFrame | None = None, **edges) -> DataFrame:
    """A global variable as it is: smooth colours inside the territory."""
    return B.raster_tiles(blocks, raster, ramp, zooms, mask=mask, **edges)


def soil_grid(bounds: tuple[float, float, float, float], res: float) -> dict:
    """The lat/lon grid of ``res`` degrees around (west, south, east, north), aligned to multiples of ``res``."""
    west, south, east, north = bounds
    first, last, low, high = math.floor(west / res), math.ceil(east / res), math.floor(south / res), math.ceil(north / res)
    return {"west": first * res, "north": high * res, "res": res, "height": high - low, "width": last - first}


def soil_window(blocks: DataFrame, raster: dict, grid: dict, edge: int = B.EDGE) -> DataFrame:
    """The homolosine source on a lat/lon grid, in whole numbers; blocks that no target pixel needs are never read on."""
    return B.resampled(blocks, raster, B.homolosine_grid(raster, grid), whole=True, edge=edge)


def soil(blocks: DataFrame, raster: dict, grid: dict, ramp: Ramp, zooms: tuple[int, int], mask: DataFrame | None = None, edge: int = B.EDGE, tile: int = B.EDGE) -> DataFrame:
    """A source in homolosine metres: clipped and brought to ``grid``, kept, then coloured."""
    window = truncate_lineage(soil_window(blocks, raster, grid, edge))
    return B.raster_tiles(window, {**raster, **grid}, ramp, zooms, mask=mask, edge=edge, tile=tile)


def cover_mosaic(blocks: DataFrame, placement: DataFrame, factor: int, height: int, width: int, edge: int = B.EDGE) -> DataFrame:
    """Classes of source tiles (each ``height`` × ``width``), reduced by their most frequent value and put on one grid."""
    return B.moved(B.decimated(blocks, factor, height, width, edge), placement, edge, edge)


def cover(blocks: DataFrame, placement: DataFrame, factor: int, source: tuple[int, int], raster: dict, ramp: Ramp, zooms: tuple[int, int], mask: DataFrame | None = None,
          edge: int = B.EDGE, tile: int = B.EDGE) -> DataFrame:
    """Classes keep their colour: reduced by mode, sampled by the pixel below. ``raster`` is the place of the mosaic."""
    mosaic = truncate_lineage(cover_mosaic(blocks, placement, factor, *source, edge))
    return B.raster_tiles(mosaic, raster, ramp, zooms, step=True, mask=mask, edge=edge, tile=tile)


def relief(blocks: DataFrame, placement: DataFrame, raster: dict, ramp: Ramp, zooms: tuple[int, int], mask: DataFrame | None = None, intensity: float = 0.55,
           edge: int = B.EDGE, tile: int = B.EDGE, **light: float) -> DataFrame:
    """Heights of source tiles as one mosaic, coloured and darkened by their own shading."""
    heights = truncate_lineage(B.moved(blocks, placement, edge, edge))
    return B.raster_tiles(heights, raster, ramp, zooms, shade=B.shaded(heights, raster, edge=edge, **light), intensity=intensity, mask=mask, edge=edge, tile=tile)


def division(comunas: DataFrame, zooms: tuple[int, int]) -> DataFrame:
    """Comunas (cut, nombre, region, bbox in degrees) with the colour of their region, dealt to vector tiles."""
    coloured = comunas.withColumn("color", S.region_colour(F.substring("cut", 1, 2)))
    return vector_tiles(coloured, zooms)

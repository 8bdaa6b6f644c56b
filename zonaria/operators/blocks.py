"""Rasters as square blocks (raster_id, brow, bcol, values): borders exchanged, mosaics, decimation, shading, resampling.

A block holds its values row by row, NaN where there is no datum; a block without any datum need not exist. All work is
dealt out as rectangular pieces that shuffle to the block they belong to, so no row of a table is a single pixel and no
task holds more than one block with its border and what falls on it.
"""
from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import crs as C

EDGE = 256
KEYS = ["raster_id", "brow", "bcol"]
BLOCK = "raster_id long, brow long, bcol long, values array<double>"
PIECE = "raster_id long, brow long, bcol long, kind int, row0 int, col0 int, height int, width int, values array<double>"
OWN, BESIDE = 0, 1
#: Metres of a degree of longitude at the equator and of a degree of latitude (fixed values).
DEGREE_EAST, DEGREE_NORTH = 111_320.0, 110_574.0


def _arrays(column: pa.ChunkedArray | pa.Array) -> list[np.ndarray]:
    out = []
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        flat = chunk.values.cast(pa.float64()).to_numpy(zero_copy_only=False)
        cuts = chunk.offsets.to_numpy()
        out += [flat[s:e] for s, e in zip(cuts[:-1], cuts[1:])]
    return out


def _record(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    arrays = [pa.array(c, pa.list_(pa.float64()) if n == "values" else pa.binary() if n == "rgba" else pa.int32() if n in ("kind", "row0", "col0", "height", "width") else pa.int64())
              for n, c in zip(names, columns)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def pieces_of(blocks: DataFrame, cut: Callable[[int, int, int, np.ndarray], Iterator[tuple]], edge: int, extra: list[str] = []) -> DataFrame:
    """Every block cut to pieces: ``cut(raster, brow, bcol, grid, *extra)`` yields (raster, brow, bcol, kind, row0, col0, patch)."""
    names = [f.split()[0] for f in PIECE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = [batch.column(n).to_pylist() for n in [*KEYS, *extra]]
            for values, raster, brow, bcol, *more in zip(_arrays(batch.column("values")), *rest):
                rows = [(*key, p.shape[0], p.shape[1], p.ravel()) for *key, p in cut(raster, brow, bcol, values.reshape(edge, edge), *more)]
                if rows:
                    yield _record(rows, names)

    return blocks.select(*KEYS, "values", *extra).mapInArrow(run, PIECE)


def gathered(pieces: DataFrame, edge: int, rim: int, finish: Callable[[tuple, dict[int, np.ndarray]], list[tuple]], schema: str, fallback: bool = True) -> DataFrame:
    """One grid for each kind of piece of a block, pieces of the same kind laid over each other (the first datum counts),
    then ``finish(key, {kind: grid})`` as rows of ``schema``."""
    names = [f.split()[0] for f in schema.split(", ")]
    side = edge + 2 * rim

    def run(table: pa.Table) -> pa.Table:
        cols = {n: table.column(n).to_pylist() for n in ("raster_id", "brow", "bcol", "kind", "row0", "col0", "height", "width")}
        grids: dict[int, np.ndarray] = {}
        patches = _arrays(table.column("values"))
        for i in sorted(range(table.num_rows), key=lambda i: (cols["kind"][i], cols["row0"][i], cols["col0"][i])):
            kind, h, w = cols["kind"][i], cols["height"][i], cols["width"][i]
            grid = grids.setdefault(kind, np.full((side, side), np.nan))
            part = grid[cols["row0"][i]:cols["row0"][i] + h, cols["col0"][i]:cols["col0"][i] + w]
            np.copyto(part, patches[i].reshape(h, w), where=np.isnan(part))
        rows = finish((cols["raster_id"][0], cols["brow"][0], cols["bcol"][0]), grids)
        return pa.Table.from_batches([_record(rows, names)] if rows else [], schema=_record([(0, 0, 0, *(b"" if n == "rgba" else [] if n == "values" else 0 for n in names[3:]))], names).schema)

    return pieces.groupBy(*KEYS).applyInArrow(run, schema)


def to_blocks(pixels: DataFrame, nodata: float | None = None, edge: int = EDGE) -> DataFrame:
    """Pixel table (raster_id, row, col, value) as blocks. Null, NaN and ``nodata`` values are no data; of a pixel given
    twice the smaller value counts."""
    valid = F.col("value").isNotNull() & ~F.isnan("value")
    if nodata is not None:
        valid &= F.col("value") != nodata
    dealt = pixels.where(valid).select(F.col("raster_id").cast("long"), F.floor(F.col("row") / edge).alias("brow"), F.floor(F.col("col") / edge).alias("bcol"),
                                       (F.pmod("row", F.lit(edge)) * edge + F.pmod("col", F.lit(edge))).cast("int").alias("at"), F.col("value").cast("double").alias("value"))

    def run(table: pa.Table) -> pa.Table:
        grid = np.full(edge * edge, np.nan)
        np.fmin.at(grid, table.column("at").to_numpy(), table.column("value").to_numpy())
        return pa.Table.from_batches([_record([(*(table.column(k)[0].as_py() for k in KEYS), grid)], [*KEYS, "values"])])

    return dealt.groupBy(*KEYS).applyInArrow(run, BLOCK)


def to_pixels(blocks: DataFrame, edge: int = EDGE) -> DataFrame:
    """Blocks as a pixel table; pixels without data are left out."""
    at = blocks.select(*KEYS, F.posexplode("values").alias("at", "value")).where(~F.isnan("value"))
    return at.select("raster_id", (F.col("brow") * edge + F.floor(F.col("at") / edge)).alias("row"), (F.col("bcol") * edge + F.col("at") % edge).alias("col"), "value")


def with_rim(blocks: DataFrame, rim: int = 1, edge: int = EDGE, missing: bool = False) -> DataFrame:
    """Blocks with the ``rim`` pixels around them (values of (edge + 2 rim)²): each block sends its border strips to its
    eight neighbours. ``missing``: also blocks that do not exist but for the rim."""
    def cut(raster, brow, bcol, grid):
        for dr in (-1, 0, 1):
            for dc in (-1, 0, 1):
                rows = slice(0, rim) if dr < 0 else slice(edge - rim, edge) if dr > 0 else slice(0, edge)
                cols = slice(0, rim) if dc < 0 else slice(edge - rim, edge) if dc > 0 else slice(0, edge)
                patch = grid[rows, cols]
                if not dr and not dc or not np.isnan(patch).all():
                    yield (raster, brow + dr, bcol + dc, OWN if not dr and not dc else BESIDE,
                           edge + rim if dr < 0 else 0 if dr > 0 else rim, edge + rim if dc < 0 else 0 if dc > 0 else rim, patch)

    def finish(key, grids):
        if OWN not in grids and not missing:
            return []
        grid = grids.get(OWN, grids.get(BESIDE))
        if BESIDE in grids:
            np.copyto(grid, grids[BESIDE], where=np.isnan(grid))
        return [(*key, grid.ravel())]

    return gathered(pieces_of(blocks, cut, edge), edge, rim, finish, BLOCK)


def moved(blocks: DataFrame, placement: DataFrame, edge: int = EDGE, new_edge: int = EDGE) -> DataFrame:
    """Source rasters on one grid: ``placement(raster_id, target_id, row0, col0, priority)``. Where sources overlap the datum
    of the lowest priority counts; missing sources are simply absent. Blocks are cut anew to ``new_edge``."""
    def cut(raster, brow, bcol, grid, target, row0, col0, priority):
        r, c = brow * edge + row0, bcol * edge + col0
        for tr in range(r // new_edge, (r + edge - 1) // new_edge + 1):
            for tc in range(c // new_edge, (c + edge - 1) // new_edge + 1):
                top, left = max(r, tr * new_edge), max(c, tc * new_edge)
                patch = grid[top - r:min(r + edge, (tr + 1) * new_edge) - r, left - c:min(c + edge, (tc + 1) * new_edge) - c]
                if not np.isnan(patch).all():
                    yield target, tr, tc, priority, top - tr * new_edge, left - tc * new_edge, patch

    def finish(key, grids):
        out = np.full((new_edge, new_edge), np.nan)
        for kind in sorted(grids):
            np.copyto(out, grids[kind], where=np.isnan(out))
        return [(*key, out.ravel())]

    placed = blocks.join(placement, "raster_id")
    return gathered(pieces_of(placed, cut, edge, ["target_id", "row0", "col0", "priority"]), new_edge, 0, finish, BLOCK)


def modes(stack: np.ndarray) -> np.ndarray:
    """Most frequent number of each row (the lower one on a tie), NaN where a row has none."""
    held = np.sort(stack, axis=1)
    n = held.shape[1]
    new = np.concatenate((np.ones((len(held), 1), bool), held[:, 1:] != held[:, :-1]), axis=1)
    start = np.maximum.accumulate(np.where(new, np.arange(n), 0), axis=1)
    times = np.where(np.isnan(held), 0, np.arange(n) - start + 1)
    best = times.argmax(axis=1)
    return np.where(times.max(axis=1) > 0, held[np.arange(len(held)), best], np.nan)


def decimated(blocks: DataFrame, factor: int, height: int, width: int, edge: int = EDGE) -> DataFrame:
    """Most frequent value of every factor × factor cell (the lower one on a tie) as blocks of ``edge``; partial cells at
    the end of the raster are dropped. Every block is reduced where it is, then the reduced ones are put together."""
    aligned = edge - edge % factor
    if not aligned:
        raise ValueError("the factor is larger than a block")
    small = aligned // factor
    same = blocks.select("raster_id").distinct().select("raster_id", F.col("raster_id").alias("target_id"), F.lit(0).alias("row0"), F.lit(0).alias("col0"), F.lit(0).alias("priority"))
    source = blocks if aligned == edge else moved(blocks, same, edge, aligned)
    rows, cols = height // factor, width // factor

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for values, raster, brow, bcol in zip(_arrays(batch.column("values")), *[batch.column(k).to_pylist() for k in KEYS]):
                grid = modes(values.reshape(small, factor, small, factor).transpose(0, 2, 1, 3).reshape(small * small, factor * factor)).reshape(small, small)
                grid[max(0, rows - brow * small):] = np.nan
                grid[:, max(0, cols - bcol * small):] = np.nan
                yield _record([(raster, brow, bcol, grid.ravel())], [*KEYS, "values"])

    reduced = source.select(*KEYS, "values").mapInArrow(reduce, BLOCK)
    return moved(reduced, same, small, edge)


def shaded(blocks: DataFrame, raster: dict, azimuth: float = 315.0, altitude: float = 45.0, exaggeration: float = 1.0, edge: int = EDGE) -> DataFrame:
    """Light 0 … 1 of height blocks (Horn): pixel width follows the latitude of the row, the border of the raster is
    repeated outwards, a pixel beside one without data has none. ``raster``: north, res, height, width in degrees."""
    height, width, res, north = raster["height"], raster["width"], float(raster["res"]), float(raster["north"])
    zenith, angle = math.radians(90.0 - altitude), math.radians((360.0 - azimuth + 90.0) % 360.0)

    def light(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for values, rid, brow, bcol in zip(_arrays(batch.column("values")), *[batch.column(k).to_pylist() for k in KEYS]):
                z = values.reshape(edge + 2, edge + 2).copy()
                if brow == 0:
                    z[0] = z[1]
                if bcol == 0:
                    z[:, 0] = z[:, 1]
                if 0 <= (last := height - brow * edge) <= edge:
                    z[last + 1] = z[last]
                if 0 <= (last := width - bcol * edge) <= edge:
                    z[:, last + 1] = z[:, last]
                row = brow * edge + np.arange(edge)
                dx = res * DEGREE_EAST * np.cos(np.radians(north - (row + 0.5) * res))[:, None]
                west, middle, east = z[:, :-2], z[:, 1:-1], z[:, 2:]
                across, summed = east - west, west + 2 * middle + east
                gx = (across[:-2] + 2 * across[1:-1] + across[2:]) / (8 * dx)
                gy = (summed[2:] - summed[:-2]) / (8 * res * DEGREE_NORTH)
                slope, aspect = np.arctan(exaggeration * np.hypot(gx, gy)), np.arctan2(gy, -gx)
                out = np.clip(math.cos(zenith) * np.cos(slope) + math.sin(zenith) * np.sin(slope) * np.cos(angle - aspect), 0, 1)
                out[np.isnan(middle[1:-1])] = np.nan
                yield _record([(rid, brow, bcol, out.ravel())], [*KEYS, "values"])

    return with_rim(blocks, 1, edge).mapInArrow(light, BLOCK)


@dataclass(frozen=True)
class Target:
    """A grid to resample to. The source row of a target pixel depends on its row alone (and grows with it), the source column
    is linear in its column: ``frow(rows)``, and ``fcol(rows)`` as (offset, step); both fractional, centres at .5."""

    height: int
    width: int
    frow: Callable[[np.ndarray], np.ndarray]
    fcol: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]

    def first_row(self, at: float) -> int:
        """The first row whose source row is ``at`` or more."""
        low, high = 0, self.height
        while low < high:
            mid = (low + high) // 2
            if self.frow(np.array([mid]))[0] >= at:
                high = mid
            else:
                low = mid + 1
        return low


def lonlat_grid(source: dict, grid: dict) -> Target:
    """A lat/lon grid (west, north, res, height, width) over a lat/lon raster (west, north, res)."""
    step = grid["res"] / source["res"]
    offset = (grid["west"] - source["west"]) / source["res"] + 0.5 * step
    return Target(grid["height"], grid["width"], lambda r: (source["north"] - grid["north"] + (r + 0.5) * grid["res"]) / source["res"],
                  lambda r: (np.full(len(r), offset), np.full(len(r), step)))


def homolosine_grid(source: dict, grid: dict) -> Target:
    """A lat/lon grid over a raster in interrupted Goode homolosine metres (west, north, res). The grid must lie within one
    lobe of one hemisphere."""
    west, east = grid["west"], grid["west"] + grid["res"] * grid["width"]
    north, south = grid["north"], grid["north"] - grid["res"] * grid["height"]
    if north > 0 > south:
        raise ValueError("a grid on both sides of the equator has to be resampled in two parts")
    centre = C.homolosine_lobe(west, east, north <= 0)

    def latitudes(r):
        return np.radians(grid["north"] - (r + 0.5) * grid["res"])

    def columns(r):
        metres, _ = C.homolosine(latitudes(r))
        first = metres * math.radians(west + 0.5 * grid["res"] - centre) + C.GOODE_RADIUS * math.radians(centre)
        return (first - source["west"]) / source["res"], metres * math.radians(grid["res"]) / source["res"]

    return Target(grid["height"], grid["width"], lambda r: (source["north"] - C.homolosine(latitudes(r))[1]) / source["res"], columns)


def mercator_tiles(source: dict, zoom: int, edge: int = EDGE) -> Target:
    """All Web-Mercator tiles of one zoom as one grid over a lat/lon raster."""
    side = edge << zoom
    step = 360.0 / side / source["res"]
    offset = (-180.0 - source["west"]) / source["res"] + 0.5 * step

    def rows(r):
        y = math.pi * (1 - 2 * (r + 0.5) / side)
        return (source["north"] - np.degrees(2 * np.arctan(np.exp(y)) - math.pi / 2)) / source["res"]

    return Target(side, side, rows, lambda r: (np.full(len(r), offset), np.full(len(r), step)))


def sampled(blocks: DataFrame, raster: dict, targets: dict[int, Target], smooth: bool = True, kind: int = OWN, edge: int = EDGE, new_edge: int = EDGE) -> DataFrame:
    """Pieces of the ``targets`` (by the number their blocks get) with the values of one raster: bilinear over the neighbours
    with data (``smooth``), or the pixel below. Every source block, with its border, answers for the target pixels whose
    centre falls on it, so a coarse target never pulls a large window into one task."""
    height, width = raster["height"], raster["width"]
    rim = 1 if smooth else 0
    source = with_rim(blocks, 1, edge, missing=True) if smooth else blocks

    def cut(_, brow, bcol, grid):
        top, left = brow * edge, bcol * edge
        for number, target in targets.items():
            rows = np.arange(target.first_row(max(top, 0)), target.first_row(min(top + edge, height)))
            if not len(rows) or left >= width or left + edge <= 0:
                continue
            offset, step = target.fcol(rows)
            low = np.floor(((max(left, 0) - offset) / step).min()) - 1
            high = np.ceil(((min(left + edge, width) - offset) / step).max()) + 1
            cols = np.arange(max(0, int(low)), min(target.width, int(high) + 1))
            if not len(cols):
                continue
            x = offset[:, None] + step[:, None] * cols
            y = target.frow(rows)[:, None]
            inside = (x >= max(left, 0)) & (x < min(left + edge, width))
            if smooth:
                u, v = x - 0.5 - left + rim, y - 0.5 - top + rim
                c0, r0 = np.floor(u).astype(np.int64), np.floor(v).astype(np.int64)
                du, dv = u - c0, v - r0
                total, weight = np.zeros(x.shape), np.zeros(x.shape)
                for i in (0, 1):
                    for j in (0, 1):
                        held = grid[np.clip(r0 + i, 0, edge + 1), np.clip(c0 + j, 0, edge + 1)]
                        w = np.where(np.isnan(held), 0.0, (dv if i else 1 - dv) * (du if j else 1 - du))
                        total += w * np.nan_to_num(held)
                        weight += w
                value = np.where(weight > 0, total / np.where(weight > 0, weight, 1), np.nan)
            else:
                value = grid[(np.floor(y) - top).astype(np.int64), np.clip(np.floor(x) - left, 0, edge - 1).astype(np.int64)]
            value = np.where(inside, value, np.nan)
            for tr in range(int(rows[0]) // new_edge, int(rows[-1]) // new_edge + 1):
                r = (rows >= tr * new_edge) & (rows < (tr + 1) * new_edge)
                for tc in range(int(cols[0]) // new_edge, int(cols[-1]) // new_edge + 1):
                    c = (cols >= tc * new_edge) & (cols < (tc + 1) * new_edge)
                    patch = value[np.ix_(r, c)]
                    if not np.isnan(patch).all():
                        yield number, tr, tc, kind, int(rows[r][0]) - tr * new_edge, int(cols[c][0]) - tc * new_edge, patch

    return pieces_of(source, cut, edge + 2 * rim)


def resampled(blocks: DataFrame, raster: dict, target: Target, number: int = 1, smooth: bool = True, whole: bool = False, edge: int = EDGE) -> DataFrame:
    """One raster on the grid ``target`` as blocks of raster ``number``; ``whole``: rounded to whole numbers (half to even)."""
    def finish(key, grids):
        return [(*key, (np.rint(grids[OWN]) if whole else grids[OWN]).ravel())]

    return gathered(sampled(blocks, raster, {number: target}, smooth, OWN, edge, edge), edge, 0, finish, BLOCK)


def mask_spans(mask: DataFrame, zooms: tuple[int, int], edge: int = EDGE) -> DataFrame:
    """Pixels of Web-Mercator tiles whose centre lies in a shape of ``mask(mid, geom)`` in degrees, as pieces of kind 2.

    Edges meet the pixel rows they cross; the crossings of a row, in order, bound the spans inside, which are cut at the
    tiles. Pixels of several shapes are pixels of one.
    """
    z = F.explode(F.sequence(F.lit(zooms[0]), F.lit(zooms[1])))
    ring = F.col("ring")
    edges = (mask.select("mid", F.explode(F.flatten("geom")).alias("ring")).where(F.size(ring) > 1)
             .select("mid", F.posexplode(F.transform(F.sequence(F.lit(1), F.size(ring) - 1), lambda i: F.struct(F.get(ring, i - 1).alias("p"), F.get(ring, i).alias("q")))).alias("at", "e")))
    side = F.lit(float(edge)) * F.pow(F.lit(2.0), "z")

    def across(lon):
        return (lon + 180) / 360 * side

    def down(lat):
        s = F.sin(F.radians(F.least(F.greatest(lat, F.lit(-85.0511)), F.lit(85.0511))))
        return (0.5 - F.ln((1 + s) / (1 - s)) / (4 * math.pi)) * side

    ends = edges.withColumn("z", z).select("mid", "z", across(F.col("e.p.x")).alias("xa"), down(F.col("e.p.y")).alias("ya"), across(F.col("e.q.x")).alias("xb"), down(F.col("e.q.y")).alias("yb"))
    # Row r is crossed if its centre r + 0.5 lies in [low, high).
    first, last = F.ceil(F.least("ya", "yb") - 0.5), F.ceil(F.greatest("ya", "yb") - 0.5) - 1
    crossed = ends.where(first <= last).withColumn("r", F.explode(F.sequence(first, last)))
    x = F.col("xa") + (F.col("r") + 0.5 - F.col("ya")) / (F.col("yb") - F.col("ya")) * (F.col("xb") - F.col("xa"))
    rows = crossed.groupBy("mid", "z", "r").agg(F.array_sort(F.collect_list(x)).alias("xs"))
    spans = rows.select("z", "r", F.explode(F.transform(F.sequence(F.lit(0), F.floor(F.size("xs") / 2).cast("int") - 1), lambda i: F.struct(
        F.ceil(F.get("xs", 2 * i) - 0.5).alias("a"), F.ceil(F.get("xs", 2 * i + 1) - 0.5).alias("b")))).alias("s")).where("s.a < s.b")
    tile = F.explode(F.sequence(F.floor(F.col("s.a") / edge), F.floor((F.col("s.b") - 1) / edge)))
    cut = spans.withColumn("t", tile).withColumns({"a": F.greatest(F.col("s.a"), F.col("t") * edge), "b": F.least(F.col("s.b"), (F.col("t") + 1) * edge)})
    return cut.select(F.col("z").cast("long").alias("raster_id"), F.floor(F.col("r") / edge).alias("brow"), F.col("t").alias("bcol"), F.lit(2).alias("kind"),
                      F.pmod("r", F.lit(edge)).cast("int").alias("row0"), (F.col("a") - F.col("t") * edge).cast("int").alias("col0"), F.lit(1).alias("height"),
                      (F.col("b") - F.col("a")).cast("int").alias("width"), F.array_repeat(F.lit(1.0), (F.col("b") - F.col("a")).cast("int")).alias("values"))


def coloured(values: np.ndarray, ramp: list[tuple[float, str]], step: bool) -> np.ndarray:
    """RGBA of ``values``. ``step``: the last entry not above the value, transparent below the first; otherwise linear and
    clamped. NaN is transparent."""
    stops = np.array([float(v) for v, _ in ramp])
    colours = np.array([[int(c[i:i + 2], 16) for i in (1, 3, 5)] for _, c in ramp], dtype=float)
    seen = ~np.isnan(values)
    x = np.where(seen, values, stops[0])
    if step:
        at = np.searchsorted(stops, x, side="right") - 1
        seen &= at >= 0
        rgb = colours[np.maximum(at, 0)]
    else:
        rgb = np.stack([np.interp(x, stops, colours[:, k]) for k in range(3)], axis=-1)
    return np.concatenate((np.rint(rgb), np.where(seen, 255, 0)[..., None]), axis=-1)


def raster_tiles(blocks: DataFrame, theme: dict, ramp: list[tuple[float, str]], zooms: tuple[int, int], step: bool = False, shade: DataFrame | None = None,
                 intensity: float = 0.5, mask: DataFrame | None = None, edge: int = EDGE, tile: int = EDGE) -> DataFrame:
    """Coloured Web-Mercator tiles of one lat/lon raster: ``z, x, y, opacos, rgba`` (tile² × 4 bytes, row by row).

    ``theme``: west, north, res, height, width, factor. ``shade``: blocks 0 … 1 of the same grid that darken the colour
    by ``intensity``. ``mask(mid, geom)``: only pixels whose centre lies in one of the shapes. Tiles without an opaque pixel
    are left out.
    """
    targets = {z: mercator_tiles(theme, z, tile) for z in range(zooms[0], zooms[1] + 1)}
    parts = sampled(blocks, theme, targets, not step, 0, edge, tile)
    if shade is not None:
        parts = parts.unionByName(sampled(shade, theme, targets, True, 1, edge, tile))
    if mask is not None:
        parts = parts.unionByName(mask_spans(mask, zooms, tile))
    factor, masked = float(theme.get("factor", 1.0)), mask is not None

    def finish(key, grids):
        if 0 not in grids or masked and 2 not in grids:
            return []
        values = grids[0] if not masked else np.where(np.isnan(grids[2]), np.nan, grids[0])
        rgba = coloured(values * factor, ramp, step)
        if 1 in grids:
            rgba[..., :3] = np.clip(np.rint(rgba[..., :3] * np.where(np.isnan(grids[1]), 1.0, (1 - intensity) + intensity * np.clip(grids[1], 0, 1))[..., None]), 0, 255)
        seen = int((rgba[..., 3] > 0).sum())
        z, y, x = key
        return [(z, x, y, seen, rgba.astype(np.uint8).tobytes())] if seen else []

    return gathered(parts, tile, 0, finish, "z long, x long, y long, opacos long, rgba binary")

"""Geometry columns of an Arrow batch as flat coordinate buffers, and back; thinning of all their rings at once."""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


@dataclass
class Flat:
    """Points of all rings of a batch, with the number of points of each ring, rings of each polygon, polygons of each row."""

    x: np.ndarray
    y: np.ndarray
    points: np.ndarray
    rings: np.ndarray
    polygons: np.ndarray
    missing: np.ndarray

    @property
    def owner(self) -> np.ndarray:
        """The row of each ring."""
        return np.repeat(np.repeat(np.arange(len(self.polygons)), self.polygons), self.rings)


def _lengths(column: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def flat(column: pa.Array | pa.ChunkedArray) -> Flat:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    polygons = pc.list_flatten(column)
    rings = pc.list_flatten(polygons)
    points = pc.list_flatten(rings)
    x, y = (pc.struct_field(points, n).to_numpy(zero_copy_only=False) for n in "xy")
    return Flat(x, y, _lengths(rings), _lengths(polygons), _lengths(column), column.is_null().to_numpy(zero_copy_only=False))


def nested(held: Flat) -> pa.Array:
    """The geometry column of ``held``."""
    def offsets(n: np.ndarray) -> pa.Array:
        return pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32))

    out = pa.StructArray.from_arrays([pa.array(held.x), pa.array(held.y)], names=["x", "y"])
    for n in (held.points, held.rings):
        out = pa.ListArray.from_arrays(offsets(n), out)
    rows = np.concatenate(([0], np.cumsum(held.polygons)))
    return pa.ListArray.from_arrays(pa.array(rows.astype(np.int32), mask=np.append(held.missing, False)), out)


def _inside(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All numbers from each ``first`` to before ``last``, which range each is of, and where the ranges begin."""
    size = last - first
    start = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(size)), size)
    return np.arange(len(owner)) - start[owner] + first[owner], owner, start


def _farthest(value: np.ndarray, at: np.ndarray, owner: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest value of each range, and the first place that has it."""
    top = np.maximum.reduceat(value, start)
    return top, np.minimum.reduceat(np.where(value == top[owner], at, np.iinfo(np.int64).max), start)


def thinned(held: Flat, tolerance: np.ndarray) -> Flat:
    """Rings without the points nearer than ``tolerance`` (one for each row) to the line that is left: each ring is halved at
    the point farthest from its first, then every stretch at the point farthest from its chord, level by level for all
    stretches of the batch. A ring that would collapse keeps its three most telling points; one in a single spot stays."""
    x, y = held.x, held.y
    end = np.cumsum(held.points)
    begin = end - held.points
    keep = np.zeros(len(x), dtype=bool)
    some = np.flatnonzero(held.points > 0)
    if not len(some):
        return held
    first, last = begin[some], end[some] - 1
    at, owner, start = _inside(first, last + 1)
    reach, half = _farthest(np.hypot(x[at] - x[first][owner], y[at] - y[first][owner]), at, owner, start)
    spot = reach == 0
    keep[at[spot[owner]]] = True
    first, half, last, limit = first[~spot], half[~spot], last[~spot], tolerance[held.owner[some[~spot]]]
    keep[first] = keep[half] = keep[last] = True
    a, b, t = np.concatenate((first, half)), np.concatenate((half, last)), np.concatenate((limit, limit))
    while True:
        open_ = b - a > 1
        a, b, t = a[open_], b[open_], t[open_]
        if not len(a):
            break
        at, owner, start = _inside(a + 1, b)
        dx, dy = (x[b] - x[a])[owner], (y[b] - y[a])[owner]
        rx, ry = x[at] - x[a][owner], y[at] - y[a][owner]
        long = dx * dx + dy * dy
        along = np.clip(np.divide(rx * dx + ry * dy, long, out=np.zeros(len(at)), where=long > 0), 0, 1)
        far, mid = _farthest(np.hypot(rx - along * dx, ry - along * dy), at, owner, start)
        cut = far > t
        a, b, t, mid = a[cut], b[cut], t[cut], mid[cut]
        keep[mid] = True
        a, b, t = np.concatenate((a, mid)), np.concatenate((mid, b)), np.concatenate((t, t))
    ring = np.repeat(np.arange(len(held.points)), held.points)
    left = np.bincount(ring[keep], minlength=len(held.points))
    flat_ = np.flatnonzero(left[ring[first]] < 4)
    if len(flat_):
        a, h = first[flat_], half[flat_]
        at, owner, start = _inside(a, last[flat_] + 1)
        off = np.abs((x[h] - x[a])[owner] * (y[at] - y[a][owner]) - (y[h] - y[a])[owner] * (x[at] - x[a][owner]))
        keep[_farthest(off, at, owner, start)[1]] = True
        left = np.bincount(ring[keep], minlength=len(held.points))
    return Flat(x[keep], y[keep], left, held.rings, held.polygons, held.missing)


def edges_of(held: Flat) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All edges (x0, y0, x1, y1) and the row each belongs to."""
    end = np.cumsum(held.points)
    inner = np.ones(len(held.x), dtype=bool)
    inner[end[held.points > 0] - 1] = False
    at = np.flatnonzero(inner)
    row = np.repeat(held.owner, held.points)[at]
    return held.x[at], held.y[at], held.x[at + 1], held.y[at + 1], row

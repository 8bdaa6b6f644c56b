"""Square tiles: assignment of geometries and points, clipping, and halving of crowded tiles."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..session import truncate_lineage

BROADCAST_ROWS = 20_000     # small side of a join: broadcast up to this many narrow rows, shuffle beyond it
GRID = 32                   # cells per axis in which one round looks at a crowded tile: five halvings per axis
ROUNDS = 4                  # rounds at most: 2**20 steps per tile and axis (2 mm on 2 km), the resolution of the coordinates
TILE = ["lv", "tx", "ty"]
LEAF = "tx bigint, ty bigint, lvx int, lvy int, ix bigint, iy bigint, open boolean"


def estimated_bytes(df: DataFrame) -> int:
    """Size the optimizer expects, from file sizes; no job is run."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame, per_task: int = 32 << 20) -> DataFrame:
    """Small inputs that arrive in one file split are dealt out to all cores before costly row work; anything that
    already fills the cores by its size is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if estimated_bytes(df) < cores * per_task else df


def deal(df: DataFrame, per_task: int = 16 << 20) -> DataFrame:
    """Rows dealt out for costly work on each, whatever the size: a large file may be one row group, which one task reads."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-estimated_bytes(df) // per_task)))


def floor_cell(value: Column, size: Column | float) -> Column:
    return F.floor(value / size).cast("bigint")


def _edge_boxes(layers: DataFrame, size: float, geom: str) -> DataFrame:
    """Edges with their ends in order of y and the range of tiles of their box."""
    e = layers.select(F.explode(G.edges(F.col(geom))).alias("e")).select(
        *[F.when(F.expr("e.y0 <= e.y1"), F.col(f"e.{a}")).otherwise(F.col(f"e.{b}")).alias(a) for a, b in (("x0", "x1"), ("y0", "y1"), ("x1", "x0"), ("y1", "y0"))])
    return e.withColumns({"txa": floor_cell(F.least("x0", "x1"), size), "txb": floor_cell(F.greatest("x0", "x1"), size),
                          "tya": floor_cell(F.col("y0"), size), "tyb": floor_cell(F.col("y1"), size)})


def tile_load(layers: DataFrame, size: float, least: int = 0, geom: str = "geom") -> DataFrame:
    """(tx, ty, n) of the tiles that more than ``least`` boxes of edges touch, whether or not a vertex lies there.

    An edge inside one tile counts there. Any other gives four corner differences, which are summed before the shuffle;
    sums up each column of tiles and then along each row turn them into counts, so that a long edge costs four rows and
    not one per tile. The box of a slanted edge also counts in tiles that the edge misses: an upper bound.
    """
    edges = _edge_boxes(layers, size, geom)
    row = "named_struct('tx', {}, 'ty', {}, 'here', {}L, 'd', {}L)".format
    corners = ", ".join([row("txa", "tya", 0, 1), row("txb + 1", "tya", 0, -1), row("txa", "tyb + 1", 0, -1), row("txb + 1", "tyb + 1", 0, 1)])
    events = edges.select(F.expr(f"inline(CASE WHEN txa = txb AND tya = tyb THEN array({row('txa', 'tya', 1, 0)}) ELSE array({corners}) END)"))
    sums = events.groupBy("tx", "ty").agg(F.sum("here").alias("here"), F.sum("d").alias("d")).where("here <> 0 OR d <> 0")
    # edges inside a tile ride along with the differences, so that the shapes are read once
    up = sums.withColumns({"v": F.expr("sum(d) OVER (PARTITION BY tx ORDER BY ty)"), "stop": F.expr("lead(ty) OVER (PARTITION BY tx ORDER BY ty)")})
    above = "CASE WHEN v <> 0 AND stop > ty + 1 THEN transform(sequence(ty + 1, stop - 1), t -> named_struct('ty', t, 'here', 0L, 'v', v)) ELSE array() END"
    along = (up.select("tx", F.expr(f"inline(concat(array(named_struct('ty', ty, 'here', here, 'v', v)), {above}))")).where("here <> 0 OR v <> 0")
             .withColumns({"c": F.expr("sum(v) OVER (PARTITION BY ty ORDER BY tx)"), "stop": F.expr("lead(tx) OVER (PARTITION BY ty ORDER BY tx)")}))
    first = "named_struct('tx', tx, 'n', c + here)"
    rest = f"CASE WHEN c > {int(least)} AND stop > tx + 1 THEN transform(sequence(tx + 1, stop - 1), t -> named_struct('tx', t, 'n', c)) ELSE array() END"
    return along.select("ty", F.expr(f"inline(concat(array({first}), {rest}))")).where(F.col("n") > least).select("tx", "ty", "n")


def _parts_in(edges: DataFrame, size: float, full: DataFrame) -> DataFrame:
    """The boxes of the parts of edges that lie in the tiles of ``full``: (tx, ty, xlo, xhi, ylo, yhi). Edges are cut to rows
    of tiles first, so that a slanted one meets only the tiles it crosses."""
    def at(value: str, a: str, b: str) -> str:       # the other coordinate where this one has the value
        return f"{b}0 + ({b}1 - {b}0) * (({value}) - {a}0) / ({a}1 - {a}0)"

    size_ = f"{float(size)!r}D"
    rows = edges.withColumn("ty", F.explode(F.expr("sequence(tya, tyb)")))
    rows = rows.withColumns({"ylo": F.expr(f"greatest(y0, ty * {size_})"), "yhi": F.expr(f"least(y1, (ty + 1) * {size_})")})
    ends = [F.expr(f"CASE WHEN tya = tyb THEN x{k} ELSE {at(f'y{side}', 'y', 'x')} END") for k, side in ((0, "lo"), (1, "hi"))]
    rows = rows.withColumns({"xlo": F.least(*ends), "xhi": F.greatest(*ends)})
    rows = rows.withColumn("tx", F.explode(F.expr(f"sequence(CAST(floor(xlo / {size_}) AS BIGINT), CAST(floor(xhi / {size_}) AS BIGINT))")))
    held = rows.join(full, ["tx", "ty"], "left_semi")
    left, right = f"greatest(xlo, tx * {size_})", f"least(xhi, (tx + 1) * {size_})"
    slanted = f"x0 <> x1 AND (xlo < tx * {size_} OR xhi > (tx + 1) * {size_})"
    ya, yb = (f"CASE WHEN {slanted} THEN {at(v, 'x', 'y')} END" for v in (left, right))
    return held.select("tx", "ty", F.expr(left).alias("xlo"), F.expr(right).alias("xhi"),
                       F.expr(f"greatest(ylo, coalesce(least({ya}, {yb}), ylo))").alias("ylo"), F.expr(f"least(yhi, coalesce(greatest({ya}, {yb}), yhi))").alias("yhi"))


def _halvings(counts: np.ndarray, capacity: int) -> Iterator[tuple[int, int, int, int, bool]]:
    """Halves a grid until no part is met by more than ``capacity`` boxes: (level x, level y, cell x, cell y, open).

    ``counts``: covers of cells (even positions) and of the lines between them (odd ones). Cells less lines plus corners
    count every box that meets a part exactly once, so any part is four look-ups in a table of sums. The half lines go where
    the fuller side is emptiest; a cut that leaves nearly everything on both sides is not made. ``open``: still crowded, but
    the grid ends there.
    """
    sign = np.where(np.add.outer(np.arange(len(counts)), np.arange(len(counts))) % 2, -1, 1)
    table = np.zeros((len(counts) + 1,) * 2, dtype=np.int64)
    table[1:, 1:] = (counts * sign).cumsum(0).cumsum(1)

    def met(lx: int, ly: int, cx: int, cy: int) -> int:
        wx, wy = GRID >> lx, GRID >> ly
        a, b, c, d = 2 * cx * wx, 2 * (cx + 1) * wx - 1, 2 * cy * wy, 2 * (cy + 1) * wy - 1
        return int(table[b, d] - table[a, d] - table[b, c] + table[a, c])

    todo = [(0, 0, 0, 0)]
    while todo:
        lx, ly, cx, cy = part = todo.pop()
        n = met(*part)
        if n <= capacity:
            yield *part, False
            continue
        cuts = []
        if GRID >> lx > 1:
            cuts.append([(lx + 1, ly, 2 * cx + k, cy) for k in (0, 1)])
        if GRID >> ly > 1:
            cuts.append([(lx, ly + 1, cx, 2 * cy + k) for k in (0, 1)])
        loads = [sorted((met(*half) for half in halves), reverse=True) for halves in cuts]
        useful = [k for k, (most, other) in enumerate(loads) if 4 * most <= 3 * n or 4 * (most + other) <= 5 * n]
        if useful:
            todo.extend(cuts[min(useful, key=lambda k: (loads[k][0], sum(loads[k])))])
        else:
            yield *part, len(cuts) < 2


def _cut_round(parts: DataFrame, nodes: DataFrame, size: float, capacity: int) -> DataFrame:
    """One round: every node (part of a tile) as a grid of cells, their covers as corner differences, and its halvings."""
    met = parts.join(nodes, ["tx", "ty"])
    cells = {}
    for axis in "xy":
        for end in ("lo", "hi"):
            cells[axis + end] = F.expr(f"CAST(floor(({axis}{end} / {float(size)!r}D * shiftleft(1L, lv{axis}) - i{axis}) * {GRID}) AS INT)")
    inside = " AND ".join(f"g.{axis}hi >= 0 AND g.{axis}lo < {GRID}" for axis in "xy")
    met = met.withColumn("g", F.struct(*[c.alias(k) for k, c in cells.items()])).where(inside)
    low, high = ({a: f"2 * greatest(g.{a}lo, 0)" for a in "xy"}, {a: f"2 * least(g.{a}hi, {GRID - 1}) + 1" for a in "xy"})
    corners = ", ".join(f"named_struct('i', {x}, 'j', {y}, 'd', {d}L)" for x, y, d in (
        (low["x"], low["y"], 1), (high["x"], low["y"], -1), (low["x"], high["y"], -1), (high["x"], high["y"], 1)))
    node = ["tx", "ty", "lvx", "lvy", "ix", "iy"]
    sums = met.select(*node, F.expr(f"inline(array({corners}))")).groupBy(*node, "i", "j").agg(F.sum("d").alias("d"))

    def halve(rows: pd.DataFrame) -> pd.DataFrame:      # at most (2 * GRID)² rows, whatever the load
        grid = np.zeros((2 * GRID, 2 * GRID), dtype=np.int64)
        grid[rows["i"].to_numpy(), rows["j"].to_numpy()] = rows["d"].to_numpy()
        at = rows.iloc[0]
        return pd.DataFrame([(at.tx, at.ty, at.lvx + lx, at.lvy + ly, (int(at.ix) << lx) + cx, (int(at.iy) << ly) + cy, again)
                             for lx, ly, cx, cy, again in _halvings(grid.cumsum(0).cumsum(1), capacity)],
                            columns=["tx", "ty", "lvx", "lvy", "ix", "iy", "open"])

    return sums.groupBy(*node).applyInPandas(halve, LEAF)


def crowded_tiles(layers: DataFrame, size: float, capacity: int, geom: str = "geom") -> DataFrame | None:
    """Parts (tx, ty, lvx, lvy, ix, iy) into which the tiles met by more than ``capacity`` edges are halved: part (ix, iy) of
    the grid of step size / 2**lvx by size / 2**lvy. ``None`` without any crowded tile, which one pass finds out.

    Parts end at the capacity, at the resolution of the coordinates, or where halving helps no more (edges on top of each
    other). A last part may be met by more edges in these two cases only. Give it stored layers, not derived ones.
    """
    full = small_side(truncate_lineage(tile_load(layers, size, capacity, geom).select("tx", "ty")))     # a row per crowded tile, read again in every round
    if full is None:
        return None
    parts = _parts_in(_edge_boxes(layers, size, geom), size, full)
    nodes = full.select("tx", "ty", *[F.lit(0).alias(c) for c in ("lvx", "lvy")], F.col("tx").alias("ix"), F.col("ty").alias("iy"))
    done = None
    for left in range(ROUNDS, 0, -1):
        found = truncate_lineage(_cut_round(parts, nodes, size, capacity))
        final = found.where("NOT open" if left > 1 else "true").drop("open")
        done = final if done is None else done.unionByName(final)
        nodes = small_side(found.where("open").drop("open")) if left > 1 else None
        if nodes is None:
            break
    return small_side(done.where("lvx + lvy > 0"))


def small_side(df: DataFrame) -> DataFrame | None:
    """``df`` marked for broadcast when its counted rows allow it; ``None`` when it is empty."""
    rows = df.limit(BROADCAST_ROWS + 1).count()
    if rows == 0:
        return None
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def step_of(axis: str, size: float) -> str:
    """SQL text of the step of a tile of level ``lv`` (level of x times 64 plus level of y)."""
    level = {"x": "CAST(shiftright(lv, 6) AS INT)", "y": "CAST(lv & 63 AS INT)"}[axis]
    return f"({float(size)!r}D / shiftleft(1L, {level}))"


def _with_parts(df: DataFrame, crowded: DataFrame, size: float, meets: dict[str, str]) -> DataFrame:
    """Rows of crowded tiles once per part that they meet (``meets``: condition per axis over ``lo`` and ``hi``)."""
    parts = crowded.select(F.col("tx").alias("_tx"), F.col("ty").alias("_ty"), (F.col("lvx") * 64 + F.col("lvy")).alias("lv"), F.col("ix").alias("_ix"), F.col("iy").alias("_iy"))
    near = F.expr("tx = _tx AND ty = _ty")
    for axis in "xy":
        near &= F.expr(meets[axis].format(lo=f"_i{axis} * {step_of(axis, size)}", hi=f"(_i{axis} + 1) * {step_of(axis, size)}"))
    joined = df.join(parts, near, "left")
    return joined.withColumns({"tx": F.coalesce("_ix", "tx"), "ty": F.coalesce("_iy", "ty"), "lv": F.coalesce("lv", F.lit(0))}).drop("_tx", "_ty", "_ix", "_iy")


def point_tiles(points: DataFrame, x: str, y: str, size: float, crowded: DataFrame | None = None) -> DataFrame:
    """Points with their tile (lv, tx, ty)."""
    based = points.withColumns({"tx": floor_cell(F.col(x), size), "ty": floor_cell(F.col(y), size)})
    if crowded is None:
        return based.withColumn("lv", F.lit(0))
    return _with_parts(based, crowded, size, {a: f"`{c}` >= {{lo}} AND `{c}` < {{hi}}" for a, c in (("x", x), ("y", y))})


def tile_pieces(df: DataFrame, size: float, crowded: DataFrame | None = None, margin: float = 0.0,
                geom: str = "geom") -> DataFrame:
    """One row per geometry and tile it touches, the geometry cut to the tile (enlarged by ``margin``).

    Geometries lying in one tile pass through uncut. The others are cut to rows of tiles first and then to
    tiles, so that each cut works on an already reduced ring; pieces in crowded tiles are cut once more to the parts.
    """
    box = spread(df).withColumn("_b", G.bbox(F.col(geom))).where(F.col("_b.xmin").isNotNull())
    size_, margin, flush = f"{float(size)!r}D", f"{float(margin)!r}D", margin > 0

    def cut(rows: DataFrame, axis: str, step: str) -> DataFrame:
        low, high = f"t{axis} * {step} - {margin}", f"(t{axis} + 1) * {step} + {margin}"
        outside = F.expr(f"_b.{axis}min < {low} OR _b.{axis}max > {high}")
        return rows.withColumn(geom, F.when(outside, G.clip_axis(geom, axis, low, high)).otherwise(F.col(geom)))

    def cells(axis: str) -> Column:
        return F.explode(F.expr(f"sequence(CAST(floor((_b.{axis}min - {margin}) / {size_}) AS BIGINT), CAST(floor((_b.{axis}max + {margin}) / {size_}) AS BIGINT))"))

    rows = cut(box.withColumn("ty", cells("y")), "y", size_)
    rows = cut(rows.withColumn("tx", cells("x")), "x", size_).where(F.size(geom) > 0).drop("_b")
    if crowded is None:
        return rows.withColumn("lv", F.lit(0))
    # without a margin only ground counts: what merely touches a part is no piece of it
    rows, eq = rows.withColumn("_b", G.bbox(F.col(geom))), "=" if flush else ""
    meets = {a: f"_b.{a}max + {margin} >{eq} {{lo}} AND _b.{a}min - {margin} <{eq} {{hi}}" for a in "xy"}
    parts = _with_parts(rows if flush else rows.where("_b.xmin < _b.xmax AND _b.ymin < _b.ymax"), crowded, size, meets)
    for axis in "yx":
        parts = cut(parts, axis, step_of(axis, size))
    return parts.where(F.size(geom) > 0).drop("_b")

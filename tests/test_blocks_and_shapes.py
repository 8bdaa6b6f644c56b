"""Raster blocks, offsets, crossings, thinning and samples against plain versions."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonaria.functions import buffers, crs
from zonaria.functions import geometry as G
from zonaria.operators import blocks as B
from zonaria.operators import demand, offset, sampling, shapes, validity
from zonaria.plans import catalogue as CA
from zonaria.plans import themes
from tests.helpers import box, frame, ring

EDGE = 8


def raster(height, width, holes=0.1, seed=1):
    rng = np.random.default_rng(seed)
    out = rng.integers(-50, 50, (height, width)).astype(float)
    out[rng.random((height, width)) < holes] = np.nan
    return out


def blocks_of(spark, *grids):
    rows = [(k, r, c, float(g[r, c])) for k, g in enumerate(grids, 1) for r in range(g.shape[0]) for c in range(g.shape[1]) if not np.isnan(g[r, c])]
    return B.to_blocks(spark.createDataFrame(rows, "raster_id long, row long, col long, value double"), edge=EDGE)


def grid_of(df, height, width, edge=EDGE):
    out = np.full((height, width), np.nan)
    for r in B.to_pixels(df, edge).collect():
        out[r.row, r.col] = r.value
    return out


def same(a, b):
    np.testing.assert_allclose(a, b, atol=1e-9, equal_nan=True)


def test_blocks_and_rims(spark):
    g = raster(19, 21)
    df = blocks_of(spark, g)
    same(grid_of(df, 19, 21), g)
    wide = np.full((19 + 32, 21 + 32), np.nan)
    wide[8:27, 8:29] = g
    for r in B.with_rim(df, 2, EDGE).collect():
        top, left = 8 + r.brow * EDGE - 2, 8 + r.bcol * EDGE - 2
        same(np.array(r.values).reshape(12, 12), wide[top:top + 12, left:left + 12])
    assert B.with_rim(df, 1, EDGE, missing=True).count() > B.with_rim(df, 1, EDGE).count() == df.count()
    assert B.with_rim(df.limit(0), 1, EDGE).count() == 0


def test_blocks_without_data_or_with_null_values(spark):
    rows = [(1, 0, 0, None), (1, 0, 1, float("nan")), (1, 0, 2, -1.0), (1, 0, 3, 5.0), (1, 0, 3, 4.0)]
    df = B.to_blocks(spark.createDataFrame(rows, "raster_id long, row long, col long, value double"), -1.0, EDGE)
    assert [tuple(r) for r in B.to_pixels(df, EDGE).collect()] == [(1, 0, 3, 4.0)]


def test_mosaic_prefers_low_priorities(spark):
    a, b = raster(10, 10, 0.3, 1), raster(12, 9, 0.3, 2)
    place = spark.createDataFrame([(1, 7, 3, 2, 1), (2, 7, 0, 5, 0), (3, 7, 0, 0, 0)], "raster_id long, target_id long, row0 int, col0 int, priority int")
    want = np.full((20, 20), np.nan)
    want[3:13, 2:12] = a
    part = want[0:12, 5:14]
    np.copyto(part, b, where=~np.isnan(b))
    same(grid_of(B.moved(blocks_of(spark, a, b), place, EDGE, 5), 20, 20, 5), want)


@pytest.mark.parametrize("factor", [2, 3, 8])
def test_decimation(spark, factor):
    g = np.floor(raster(23, 26, 0.4) / 20)
    want = np.full((23 // factor, 26 // factor), np.nan)
    for r, c in np.ndindex(want.shape):
        cell = g[r * factor:(r + 1) * factor, c * factor:(c + 1) * factor].ravel()
        values, times = np.unique(cell[~np.isnan(cell)], return_counts=True)
        if len(values):
            want[r, c] = values[times.argmax()]
    same(grid_of(B.decimated(blocks_of(spark, g), factor, 23, 26, EDGE), *want.shape), want)


def test_light_of_planes_and_borders(spark):
    flat = np.full((20, 20), 3.0)
    flat[4, 4] = np.nan
    place = {"north": -30.0, "res": 0.01, "height": 20, "width": 20}
    lit = grid_of(B.shaded(blocks_of(spark, flat), place, edge=EDGE), 20, 20)
    assert np.isnan(lit[3:6, 3:6]).all() and np.isnan(lit).sum() == 9
    same(lit[~np.isnan(lit)], math.sin(math.radians(45)))


def bilinear(g, fr, fc):
    total = weight = 0.0
    for i in (0, 1):
        for j in (0, 1):
            r, c = math.floor(fr - 0.5) + i, math.floor(fc - 0.5) + j
            if 0 <= r < g.shape[0] and 0 <= c < g.shape[1] and not np.isnan(g[r, c]):
                dr, dc = fr - 0.5 - math.floor(fr - 0.5), fc - 0.5 - math.floor(fc - 0.5)
                w = (dr if i else 1 - dr) * (dc if j else 1 - dc)
                total, weight = total + w * g[r, c], weight + w
    return total / weight if weight > 0 else np.nan


@pytest.mark.parametrize("res", [0.0041, 0.0133, 0.0517])
def test_resampling_finer_and_coarser(spark, res):
    g = raster(20, 17, 0.3)
    source = {"west": -71.0, "north": -30.0, "res": 0.01, "height": 20, "width": 17}
    grid = {"west": -71.02, "north": -29.97, "res": res, "height": int(0.25 / res), "width": int(0.22 / res)}
    want = np.full((grid["height"], grid["width"]), np.nan)
    near = want.copy()
    for r, c in np.ndindex(want.shape):
        fr, fc = (-30.0 - (-29.97 - (r + 0.5) * res)) / 0.01, (-71.02 + (c + 0.5) * res + 71.0) / 0.01
        if 0 <= fr < 20 and 0 <= fc < 17:
            want[r, c], near[r, c] = bilinear(g, fr, fc), g[int(fr), int(fc)]
    target = B.lonlat_grid(source, grid)
    same(grid_of(B.resampled(blocks_of(spark, g), source, target, edge=EDGE), *want.shape), want)
    same(grid_of(B.resampled(blocks_of(spark, g), source, target, smooth=False, edge=EDGE), *want.shape), near)


def test_homolosine(spark):
    scale, north = crs.homolosine(np.radians(np.array([-40.7366, -40.7368, 0.0, 60.0, -60.0])))
    assert abs(north[0] - north[1]) < 30 and north[2] == 0 and north[3] == -north[4]
    with pytest.raises(ValueError):
        crs.homolosine_lobe(-101.0, -90.0, True)
    with pytest.raises(ValueError):
        B.homolosine_grid({}, {"west": -70, "north": 1.0, "res": 0.1, "height": 30, "width": 3})
    for lat in (-33.0, -52.0):  # a value that equals its own column survives the way to degrees
        x = crs.GOODE_RADIUS * math.radians(-60) + crs.homolosine(np.array([math.radians(lat)]))[0][0] * math.radians(-11)
        y = crs.homolosine(np.array([math.radians(lat)]))[1][0]
        source = {"west": x - 8_000.0, "north": y + 8_000.0, "res": 1_000.0, "height": 16, "width": 16}
        g = np.tile(np.arange(16.0), (16, 1))
        grid = {"west": -71.01, "north": lat + 0.01, "res": 0.02, "height": 1, "width": 1}
        got = grid_of(B.resampled(blocks_of(spark, g), source, B.homolosine_grid(source, grid), edge=EDGE), 1, 1)
        assert abs(got[0, 0] - 7.5) < 1e-6


def test_tiles_with_mask_and_shade(spark):
    g = np.full((40, 40), 10.0)
    place = {"west": -71.0, "north": -30.0, "res": 0.05, "height": 40, "width": 40}
    hole = [[ring((-71, -32), (-69, -32), (-69, -30), (-71, -30)), ring((-70.5, -31.5), (-70.5, -30.5), (-69.5, -30.5), (-69.5, -31.5))]]
    mask = frame(spark, [(1, hole), (2, box(-70.2, -31.2, -69.8, -30.8)), (3, None), (4, [])], "mid long, geom GEOM")
    ramp = [(0.0, "#000000"), (20.0, "#c86432")]
    tiles = themes.climate(blocks_of(spark, g), place, ramp, (6, 7), mask, edge=EDGE, tile=32).collect()
    dark = B.raster_tiles(blocks_of(spark, g), place, ramp, (6, 7), shade=blocks_of(spark, np.full((40, 40), 0.5)), intensity=0.4, edge=EDGE, tile=32).collect()

    def inside(lon, lat):
        w, s, e, n = -71, -32, -69, -30
        outer = w <= lon < e and s < lat <= n and not (-70.5 <= lon < -69.5 and -31.5 < lat <= -30.5)
        return outer or (-70.2 <= lon < -69.8 and -31.2 < lat <= -30.8)

    for z in (6, 7):
        want = {}
        side = 32 << z
        for gx in range(int((-72 + 180) / 360 * side), int((-68 + 180) / 360 * side)):
            for gy in range(side // 2, int(side * 0.62)):
                lon, lat = (gx + 0.5) / side * 360 - 180, math.degrees(2 * math.atan(math.exp(math.pi * (1 - 2 * (gy + 0.5) / side))) - math.pi / 2)
                if -71 <= lon < -69 and -32 < lat <= -30:
                    want.setdefault((gx // 32, gy // 32), []).append((gx % 32, gy % 32, inside(lon, lat)))
        got = {(t.x, t.y): np.frombuffer(t.rgba, np.uint8).reshape(32, 32, 4) for t in tiles if t.z == z}
        full = {(t.x, t.y): np.frombuffer(t.rgba, np.uint8).reshape(32, 32, 4) for t in dark if t.z == z}
        assert set(full) == set(want)
        for key, pixels in want.items():
            shown = {(c, r) for c, r, seen in pixels if seen}
            assert {(c, r) for r, c in zip(*np.nonzero(got[key][..., 3]))} == shown if shown else key not in got
            assert {tuple(got[key][r, c]) for c, r in shown} <= {(100, 50, 25, 255)}
            assert {tuple(full[key][r, c]) for c, r, _ in pixels} == {(80, 40, 20, 255)}


# --- shapes ----------------------------------------------------------------------------------------------------------

def plain_thinned(points, tolerance):
    def line(a, b):
        if b - a < 2:
            return []
        d = points[b] - points[a]
        rel = points[a + 1:b] - points[a]
        t = np.clip(rel @ d / (d @ d), 0, 1) if d @ d else np.zeros(len(rel))
        far = np.hypot(*(rel - t[:, None] * d).T)
        k = a + 1 + int(far.argmax())
        return [*line(a, k), k, *line(k, b)] if far.max() > tolerance else []

    half = int(np.hypot(*(points - points[0]).T).argmax())
    if not half:
        return list(range(len(points)))
    kept = [0, *line(0, half), half, *line(half, len(points) - 1), len(points) - 1]
    if len(kept) < 4:
        d = points[half] - points[0]
        off = np.abs(d[0] * (points[:, 1] - points[0, 1]) - d[1] * (points[:, 0] - points[0, 0]))
        kept = sorted({*kept, int(off.argmax())})
    return kept


def test_thinning_of_a_whole_batch(spark):
    rng = np.random.default_rng(7)
    rows = []
    for gid in range(40):
        n = int(rng.integers(3, 60))
        angle = np.sort(rng.random(n)) * 2 * math.pi
        far = 50 + rng.normal(0, 6, n)
        rows.append((gid, [[ring(*zip(far * np.cos(angle), far * np.sin(angle)))], [ring((0, 0), (1, 0), (1, 1e-9)), ring((5, 5), (5, 5), (5, 5))]], float(rng.integers(0, 15))))
    df = frame(spark, [*rows, (98, None, 1.0), (99, [], 1.0)], "gid long, geom GEOM, t double")
    for r in shapes.simplify(df, F.col("t")).collect():
        if r.gid >= 98:
            assert r.geom == ([] if r.gid == 99 else None)
            continue
        for got, own in zip((q for poly in r.geom for q in poly), (q for poly in rows[r.gid][1] for q in poly)):
            points = np.array([(p["x"], p["y"]) for p in own])
            assert [(p.x, p.y) for p in got] == [tuple(points[i]) for i in plain_thinned(points, r.t)]


def test_crossings(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(k, [[ring(*rng.integers(0, 12, (int(rng.integers(3, 9)), 2)).tolist())]]) for k in range(150)]
    df = frame(spark, [*rows, (None, rows[0][1]), (900, None), (901, [])], "gid long, geom GEOM")
    want = {r.gid for r in df.where(G.crosses_itself(F.col("geom"))).collect()} - {None}
    assert {r.gid for r in validity.crossing_shapes(df, "gid").collect()} == want and 20 < len(want) < 150
    monkeypatch.setattr(validity, "FEW", 0)
    assert {r.gid for r in validity.crossing_shapes(df, "gid").collect()} == want


def test_a_ring_of_200_000_vertices(spark):
    n = 200_000
    i = F.col("i")
    turn = i * (2 * math.pi / n)
    far = 1000 + 20 * F.sin(turn * 900)
    points = spark.range(n).withColumnRenamed("id", "i").select("i", G.point(far * F.cos(turn), far * F.sin(turn)).alias("p"))
    swapped = points.withColumn("i", F.when(i == 70_000, 160_000).when(i == 160_000, 70_000).otherwise(i))
    both = points.withColumn("gid", F.lit(1)).unionByName(swapped.withColumn("gid", F.lit(2)))
    rings = both.groupBy("gid").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "p"))), lambda v: v["p"]).alias("r"))
    df = rings.select("gid", F.array(F.array(F.concat("r", F.slice("r", 1, 1)))).alias("geom"))
    assert [r.gid for r in validity.crossing_shapes(df, "gid").collect()] == [2]


def test_offset_of_holes_and_reflex_corners(spark):
    d, fan = 2.0, 16 * 0.5 * 4 * math.sin(math.pi / 32)
    rows = [(1, box(0, 0, 30, 30)), (2, [[ring((40, 0), (70, 0), (70, 30), (40, 30)), ring((50, 10), (50, 20), (60, 20), (60, 10))]]),
            (3, [[ring((100, 0), (130, 0), (130, 30), (100, 30)), ring((110, 10), (110, 13), (113, 13), (113, 10))]])]
    got = {r.gid: r for r in offset.outward(frame(spark, rows, "gid long, geom GEOM"), "gid", d, 16.0).select("gid", G.area(F.col("geom")).alias("a"), F.size(F.flatten("geom")).alias("n")).collect()}
    outer = 900 + 120 * d + 4 * fan
    assert abs(got[1].a - outer) < 1e-3 and abs(got[2].a - (outer - 36)) < 1e-3 and abs(got[3].a - outer) < 1e-3
    assert [got[k].n for k in (1, 2, 3)] == [1, 2, 1]
    assert offset.territory_mask(frame(spark, [(1, 1, box(0, 0, 5, 5))], "gid long, parte long, geom GEOM"), "gid", "parte", (50, 0, 60, 9), 0.1, 1.0, 16.0).count() == 0


# --- samples, signatures, stored results -------------------------------------------------------------------------------

@pytest.mark.parametrize("size", [1, 7, 1000])
def test_every_kth_row(spark, size):
    rows = [(g, i) for g, n in (("a", 100), ("b", 7), (None, 9), ("c", 1)) for i in range(n)]
    got = sampling.every_kth(spark.createDataFrame(rows, "g string, i long").repartition(5), "g", "i", size).collect()
    for g, n in (("a", 100), ("b", 7), (None, 9), ("c", 1)):
        assert sorted(r.i for r in got if r.g == g) == list(range(0, n, -(-n // size)))
    assert sampling.every_kth(spark.createDataFrame([], "g string, i long"), "g", "i", size).count() == 0


def test_sources_by_signature(spark):
    cards = spark.createDataFrame([(1, "01101", ["a", "b", "a"]), (2, "01101", ["b", "a"]), (3, "02101", ["a"]), (4, None, ["b"]), (5, "01101", []), (6, "01101", None)], "qid long, cut string, clases array<string>")
    contracts = spark.createDataFrame([("x", "latente", ["a"], None), ("y", "propuesta", ["b"], ["01"]), ("z", "activa", ["a"], None), ("w", "latente", ["b"], [])],
                                      "id string, estado string, clases array<string>, regiones array<string>")
    got = {(r.qid, r.id) for r in demand.relevant_sources(cards, contracts).collect()}
    assert got == {(1, "x"), (1, "y"), (1, "w"), (2, "x"), (2, "y"), (2, "w"), (3, "x"), (4, "w")}
    assert demand.relevant_sources(cards, contracts.limit(0)).collect() == []


def test_results_are_written_once(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "k long, v string")
    path = f"{tmp_path}/t"
    assert CA.write_once(df, path) and not CA.write_once(df.repartition(3), path)
    assert CA.write_once(df.limit(2), path) and spark.read.parquet(path).count() == 2
    assert CA.content_digest(df.limit(0)) == (0, 0, 0)

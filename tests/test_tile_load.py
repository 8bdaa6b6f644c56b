"""Load of tiles and the halving of crowded ones, against plain counts."""
import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import box, frame, ring
from zonaria.functions import geometry as G
from zonaria.operators import overlay as O
from zonaria.operators import spatial_join as J
from zonaria.operators import tiling as TL

BOX = "array(array(array({}, {}, {}, {}, {})))"


def boxes(df, x0, y0, x1, y1):
    corner = "named_struct('x', CAST({} AS DOUBLE), 'y', CAST({} AS DOUBLE))".format
    return df.withColumn("geom", F.expr(BOX.format(*[corner(x, y) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))])))


def per_part(pieces):
    """Edges per part that are no work of the outermost cut, the most of them first."""
    return pieces.withColumn("n", F.size(G.edges(F.col("geom")))).groupBy(*TL.TILE).agg(F.count("*").alias("pieces"), F.sum("n").alias("n"))


def test_load_counts_every_tile_an_edge_meets(spark):
    rng = random.Random(3)
    shapes = []
    for i in range(60):
        x, y = rng.randrange(-50, 50), rng.randrange(-50, 50)
        shapes.append((i, box(x, y, x + rng.choice([1, 4, 60]), y + rng.choice([1, 3, 70]))))
    want = {}
    for _, geom in shapes:
        r = geom[0][0]
        for p, q in zip(r, r[1:]):
            for tx in range(int(min(p["x"], q["x"]) // 7), int(max(p["x"], q["x"]) // 7) + 1):
                for ty in range(int(min(p["y"], q["y"]) // 7), int(max(p["y"], q["y"]) // 7) + 1):
                    want[tx, ty] = want.get((tx, ty), 0) + 1
    df = frame(spark, shapes, "id int, geom GEOM")
    assert {(r.tx, r.ty): r.n for r in TL.tile_load(df, 7.0).collect()} == want
    assert {(r.tx, r.ty) for r in TL.tile_load(df, 7.0, 4).collect()} == {k for k, n in want.items() if n > 4}
    assert TL.tile_load(df.where("false"), 7.0).count() == 0


def test_fifty_thousand_spanning_boxes(spark):
    """Strips across five tiles: the middle ones hold no vertex, yet no task gets more than the capacity."""
    strips = boxes(spark.range(50_000, numPartitions=4), "-3000", "id * 0.04", "5000", "id * 0.04 + 0.02")
    parts = TL.crowded_tiles(strips, 2000.0, 2_000)
    middle = parts.where("tx = 0 AND ty = 0").collect()
    assert middle and all(r.lvx == 0 for r in middle)                   # cut across the strips only: no piece is doubled
    load = per_part(TL.tile_pieces(strips, 2000.0, parts)).agg(F.max("pieces").alias("m"), F.sum("pieces").alias("s")).first()
    assert load.m <= 1_001 and load.s <= 250_000 * 1.01
    cells = O.overlay(strips.select(F.struct("id").alias("item"), "geom"), 2000.0, capacity=2_000)
    assert cells.agg(F.sum("area")).first()[0] == pytest.approx(50_000 * 8_000 * 0.02, rel=1e-9)


def test_crowd_on_one_spot_is_halved_beyond_six_levels(spark):
    """Four thousand boxes within two metres of a tile of 4 096 m: eleven halvings an axis before the first one helps."""
    crowd = boxes(spark.range(4_000, numPartitions=4), "1000 + id % 64 * 0.03", "3000 + floor(id / 64) * 0.03",
                  "1000.02 + id % 64 * 0.03", "3000.02 + floor(id / 64) * 0.03")
    parts = TL.crowded_tiles(crowd, 4096.0, 500)
    assert parts.agg(F.max(F.least("lvx", "lvy"))).first()[0] > 6
    load = per_part(TL.tile_pieces(crowd, 4096.0, parts)).agg(F.max("pieces").alias("m"), F.count("*").alias("k")).first()
    assert load.m <= 500 and load.k < 200
    cells = O.overlay(crowd.select(F.struct("id").alias("item"), "geom"), 4096.0, capacity=500)
    assert cells.agg(F.sum("area")).first()[0] == pytest.approx(4_000 * 0.02 ** 2, rel=1e-6)


def test_edges_on_top_of_each_other_stay_together(spark):
    stack = boxes(spark.range(3_000, numPartitions=4), "100", "100", "900", "900")
    parts = TL.crowded_tiles(stack, 1000.0, 500)
    assert parts is None or parts.count() < 400
    cells = O.overlay(stack.select(F.struct("id").alias("item"), "geom"), 1000.0, capacity=500)
    assert cells.agg(F.sum(F.size("active") * F.col("area"))).first()[0] == pytest.approx(3_000 * 800.0 ** 2)


def test_joins_over_halved_tiles(spark):
    """Points and shapes meet alike whether tiles are whole or cut, points on lines of the cut included."""
    rng = random.Random(9)
    shapes = []
    for i in range(150):
        x, y = rng.randrange(0, 56), rng.randrange(0, 56)
        shapes.append((i, [[ring(*[(x + rng.randrange(0, 9), y + rng.randrange(0, 9)) for _ in range(3)])]]))
    left = frame(spark, shapes, "id int, geom GEOM")
    points = spark.createDataFrame([(i, float(i % 17 * 4), float(i // 17 * 4)) for i in range(289)], "pid int, x double, y double")
    named = left.withColumnRenamed("id", "gid")
    got = []
    for capacity in (40, 100_000):
        J.CAPACITY, kept = capacity, J.CAPACITY
        try:
            assert (TL.crowded_tiles(left, 32.0, capacity) is None) == (capacity > 40)
            inside = {(r.pid, r.gid) for r in J.points_in_polygons(points, named, 32.0, "intersects").collect()}
            touch = {(r.lid, r.rid) for r in J.polygons_intersect(left.withColumnRenamed("id", "lid"), left.withColumnRenamed("id", "rid"), 32.0).collect()}
            near = {(r.pid, r.gid, round(r.distance, 9)) for r in J.nearest_polygon(points, named, 3.0, 32.0).collect()}
            got.append((inside, touch, near))
        finally:
            J.CAPACITY = kept
    assert got[0] == got[1] and all(got[0])

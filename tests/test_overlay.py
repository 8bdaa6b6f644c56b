"""Overlay against brute force on small random shapes."""
import math
import random

import pytest
from pyspark.sql import functions as F

from zonaria.functions import geometry as G
from zonaria.operators import overlay as O


def ring(points):
    return [(float(x), float(y)) for x, y in [*points, points[0]]]


def frame(spark, rows):
    return spark.createDataFrame([(i, [[[{"x": x, "y": y} for x, y in r] for r in p] for p in g]) for i, g in rows],
                                 f"id long, geom {G.GEOMETRY}")


def star(rng, cx, cy, n=7):
    angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    return [[ring([(cx + rng.uniform(5, 30) * math.cos(a), cy + rng.uniform(5, 30) * math.sin(a)) for a in angles])]]


def inside(g, x, y):
    hit = False
    for poly in g:
        for r in poly:
            for (ax, ay), (bx, by) in zip(r, r[1:]):
                if (ay <= y) != (by <= y) and x < ax + (y - ay) / (by - ay) * (bx - ax):
                    hit = not hit
    return hit


def strip_area(a, b):
    """Exact even-odd intersection area by fine horizontal strips between all vertex and crossing levels."""
    edges = [[(p, q) for poly in g for r in poly for p, q in zip(r, r[1:]) if p[1] != q[1]] for g in (a, b)]
    flat = edges[0] + edges[1]
    ys = {p[1] for e in flat for p in e}
    for i, ((ax, ay), (bx, by)) in enumerate(flat):
        for (cx, cy), (dx, dy) in flat[i + 1:]:
            k1, k2 = (bx - ax) / (by - ay), (dx - cx) / (dy - cy)
            if k1 != k2:
                y = (cx - k2 * cy - ax + k1 * ay) / (k1 - k2)
                if max(min(ay, by), min(cy, dy)) < y < min(max(ay, by), max(cy, dy)):
                    ys.add(y)
    total, ys = 0.0, sorted(ys)
    for lo, hi in zip(ys, ys[1:]):
        m = (lo + hi) / 2
        spans = []
        for es in edges:
            xs = sorted(p[0] + (m - p[1]) / (q[1] - p[1]) * (q[0] - p[0]) for p, q in es if (p[1] <= m) != (q[1] <= m))
            spans.append(list(zip(xs[::2], xs[1::2])))
        total += (hi - lo) * sum(max(0.0, min(r1, r2) - max(l1, l2)) for l1, r1 in spans[0] for l2, r2 in spans[1])
    return total


@pytest.mark.parametrize("size,capacity", [(1000.0, 10_000), (17.0, 10_000), (40.0, 30)])
def test_pair_areas_match_brute_force(spark, size, capacity):
    rng = random.Random(5)
    left = [(i, star(rng, rng.uniform(-50, 50), rng.uniform(-50, 50))) for i in range(12)]
    right = [(i, star(rng, rng.uniform(-50, 50), rng.uniform(-50, 50))) for i in range(12)]
    got = O.pair_areas(frame(spark, left).withColumnRenamed("id", "lid"), frame(spark, right).withColumnRenamed("id", "rid"),
                       size, capacity).collect()
    got = {(r.lid, r.rid): r.area for r in got}
    for i, a in left:
        for j, b in right:
            assert got.get((i, j), 0.0) == pytest.approx(strip_area(a, b), abs=1e-4)


def test_copies_and_holes(spark):
    square = [[ring([(0, 0), (10, 0), (10, 10), (0, 10)])]]
    holed = [[ring([(0, 0), (10, 0), (10, 10), (0, 10)]), ring([(2, 2), (4, 2), (4, 4), (2, 4)])]]
    df = frame(spark, [(1, square), (2, square), (3, holed)])
    got = O.overlay(df.select(F.struct("id").alias("item"), "geom"), 7.0)
    got = {tuple(sorted(a.id for a in r.active)): r.s for r in got.groupBy("active").agg(F.sum("area").alias("s")).collect()}
    assert got == {(1, 2, 3): 96.0, (1, 2): 4.0}
    assert df.select(G.area(F.col("geom")).alias("a")).collect()[2].a == 96.0
    union = O.union_areas(df.withColumn("k", F.lit("k")), "k", "id", 3.0).collect()
    assert union[0].area == 100.0


def test_interior_point_and_predicates(spark):
    rng = random.Random(11)
    shapes = [(i, star(rng, 0, 0, 9)) for i in range(30)]
    df = frame(spark, shapes).select("id", G.interior_point(F.col("geom")).alias("p"), G.edges(F.col("geom")).alias("es"))
    rows = df.select("id", "p", G.point_within(F.col("es"), F.col("p.x"), F.col("p.y")).alias("w")).collect()
    assert all(r.w for r in rows)
    assert all(inside(dict(shapes)[r.id], r.p.x, r.p.y) for r in rows)

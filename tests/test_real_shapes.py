"""Slanted, concave, pierced and two-part shapes against plain geometry."""
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from helpers import box, frame, ring
from zonaria.functions import geometry as G
from zonaria.functions import text as X
from zonaria.operators import buildings as B
from zonaria.operators import partition as P
from zonaria.operators import spatial_join as J


def shape(rnd):
    """A triangle, L, U, box with a hole, or two parts, somewhere on a plane of 40 × 40."""
    x, y, s = rnd.uniform(0, 34), rnd.uniform(0, 34), rnd.uniform(1, 9)
    at = lambda *pts: ring(*[(x + s * a, y + s * b) for a, b in pts])
    kind = rnd.randrange(5)
    if kind == 0:
        return [[at((0, 0), (1, 0.3), (0.2, 1))]]
    if kind == 1:
        return [[at((0, 0), (1, 0), (1, 0.3), (0.3, 0.3), (0.3, 1), (0, 1))]]
    if kind == 2:
        return [[at((0, 0), (1, 0), (1, 1), (0.8, 1), (0.8, 0.2), (0.2, 0.2), (0.2, 1), (0, 1))]]
    if kind == 3:
        return [[at((0, 0), (1, 0), (1, 1), (0, 1)), at((0.1, 0.1), (0.1, 0.9), (0.9, 0.9), (0.9, 0.1))]]
    far = rnd.uniform(-20, 20)
    return [[at((0, 0), (0.4, 0), (0.2, 0.4))], [at((far / s, 0.5), (far / s + 0.5, 0.5), (far / s + 0.5, 0.9))]]


def edges(geom):
    return [(r[i]["x"], r[i]["y"], r[i + 1]["x"], r[i + 1]["y"]) for part in geom for r in part for i in range(len(r) - 1)]


def inside(es, x, y):
    return sum((y0 <= y) != (y1 <= y) and x < x0 + (y - y0) / (y1 - y0) * (x1 - x0) for x0, y0, x1, y1 in es) % 2 == 1


def meet(a, b):
    def side(e, x, y):
        d = (e[2] - e[0]) * (y - e[1]) - (e[3] - e[1]) * (x - e[0])
        return (d > 0) - (d < 0)

    ea, eb = edges(a), edges(b)
    if any(inside(eb, r[0]["x"], r[0]["y"]) for p in a for r in p) or any(inside(ea, r[0]["x"], r[0]["y"]) for p in b for r in p):
        return True
    return any(side(e, f[0], f[1]) * side(e, f[2], f[3]) <= 0 and side(f, e[0], e[1]) * side(f, e[2], e[3]) <= 0
               and max(min(e[0], e[2]), min(f[0], f[2])) <= min(max(e[0], e[2]), max(f[0], f[2]))
               and max(min(e[1], e[3]), min(f[1], f[3])) <= min(max(e[1], e[3]), max(f[1], f[3])) for e in ea for f in eb)


@pytest.mark.parametrize("size", [3.0, 10.0, 100.0])
def test_shapes_that_meet(spark, size):
    rnd = random.Random(7)
    left, right = [shape(rnd) for _ in range(25)], [shape(rnd) for _ in range(25)]
    got = J.polygons_intersect(frame(spark, list(enumerate(left)), "lid long, geom GEOM"), frame(spark, list(enumerate(right)), "rid long, geom GEOM"), size)
    want = {(i, j) for i, a in enumerate(left) for j, b in enumerate(right) if meet(a, b)}
    assert {(r.lid, r.rid) for r in got.collect()} == want and 20 < len(want) < 500


def test_second_part_and_gap_of_a_bay(spark):
    parts = [[ring((0.5, 0.5), (1, 0.5), (1, 1))], [ring((5, 5), (6, 5), (6, 6))]]
    bay = [[ring((0, 0), (30, 0), (30, 30), (25, 30), (25, 5), (5, 5), (5, 30), (0, 30))]]
    one = lambda key, g: frame(spark, [(1, g)], f"{key} long, geom GEOM")
    assert J.polygons_intersect(one("lid", parts), one("rid", box(4, 4, 8, 8)), 10.0).count() == 1
    assert J.polygons_intersect(one("lid", bay), one("rid", box(12, 12, 18, 28)), 10.0).count() == 0


def test_risk_stays_in_its_comuna(spark):
    comunas = frame(spark, [("1", box(0, 0, 10, 10)), ("2", box(10, 0, 20, 10))], "cut string, geom GEOM")
    none = frame(spark, [], "gid long, fuente string, rango int, cut_ipt string, geom GEOM")
    risks = frame(spark, [(1, "1", box(5, 0, 15, 10)), (2, None, box(0, 0, 20, 1))], "gid long, cut_ipt string, geom GEOM")
    got = {(r.cut, r.riesgo): r.area_m2 for r in P.partition(comunas, none, risks, 50.0).collect()}
    assert got == {("1", True): pytest.approx(55), ("1", False): pytest.approx(45), ("2", True): pytest.approx(10), ("2", False): pytest.approx(90)}


def test_fold_is_the_compatibility_form(spark):
    rnd = random.Random(2)
    texts = ["Plan Ⅳ", "Ａｂ", "⅓", "㎡", "ﬆ", "ñandú", "🄐", "ß", ""] + ["".join(chr(rnd.choice([rnd.randrange(32, 0xD800), rnd.randrange(0xE000, 0x30000)])) for _ in range(20)) for _ in range(200)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", X.fold(F.col("t")).alias("f")).collect()
    assert all(r.f == unicodedata.normalize("NFKD", r.t).encode("ascii", "ignore").decode() for r in rows)
    keys = spark.createDataFrame([("Plan Ⅱ",), ("Plan Ⅲ",)], "t string").select(X.norm_text(F.col("t")).alias("k")).collect()
    assert [r.k for r in keys] == ["PLAN II", "PLAN III"]


def test_view_beyond_its_limit(spark):
    rows = [(f"b{i:02d}", None, None, 1.0, "x", box(0.001 * i, 0, 0.001 * i + 0.0005, 0.001)) for i in range(20)]
    b = frame(spark, rows, "id string, height double, num_floors double, area_m2 double, fuente string, geom GEOM").withColumn("bbox", G.bbox(F.col("geom")))
    view = B.window_view(b, (0.0, 0.0, 0.1, 0.1), limit=7)
    assert [r.id for r in view.orderBy("id").collect()] == [f"b{i:02d}" for i in range(7)]
    assert B.window_notice(view, (0.0, 0.0, 0.1, 0.1)).first()[:] == (7, True, None)
    wide = B.window_view(b, (0.0, 0.0, 1.0, 0.1))
    assert wide.count() == 0 and "muy grande" in B.window_notice(wide, (0.0, 0.0, 1.0, 0.1)).first().aviso
    assert not B.window_notice(B.window_view(b, (0.0, 0.0, 0.1, 0.1)), (0.0, 0.0, 0.1, 0.1)).first().recortado

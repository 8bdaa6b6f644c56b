"""Thematic rasters over blocks: soil, cover, relief, climate and division, each from source to tiles."""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from zonaria.functions import geometry as G
from zonaria.operators import blocks as B
from zonaria.operators.offset import territory_mask
from zonaria.operators.pyramid import display_outlines, tile_pyramid
from zonaria.operators.tiling import spread
from zonaria.operators.validity import crossing_shapes
from zonaria.plans import themes
from zonaria.session import truncate_lineage

from .base import query, relation, table

# The raster of the pixel relation as a lat/lon raster of 0.001 degrees, and as a homolosine raster of 20 m.
PLACE = {"west": -71.0, "north": -30.0, "res": 0.001, "width": 64}
GOODE = {"west": -7_740_000.0, "north": -3_339_500.0, "res": 20.0, "width": 64}
RAMP = [(-500.0, "#102030"), (0.0, "#80a0c0"), (500.0, "#ffe0d0")]
CLASSES = [(-300.0, "#0a1400"), (-100.0, "#203c00"), (0.0, "#407800"), (100.0, "#80f000")]
ZOOMS = (9, 10)


def rows_of(spark, sf) -> int:
    return table(spark, sf, "embeddings").agg(F.max("vec_id")).first()[0] + 1


def source(spark, sf, nodata=None):
    return B.to_blocks(relation(spark, sf, "pixels"), nodata)


def per_tile(tiles):
    """Number of opaque pixels and sums of their channels for every tile, from its payload."""
    def run(batches):
        for batch in batches:
            images = [np.frombuffer(t, dtype=np.uint8).reshape(-1, 4) for t in batch.column("rgba").to_pylist()]
            sums = np.array([i[i[:, 3] > 0, :3].sum(axis=0, dtype=np.int64) for i in images]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *[pa.array(sums[:, k]) for k in range(3)]], names=["z", "x", "y", "n", "rojo", "verde", "azul"])

    return tiles.select("z", "x", "y", "opacos", "rgba").mapInArrow(run, "z long, x long, y long, n long, rojo long, verde long, azul long")


def tile_pixels(last: str, west: float = PLACE["west"], north: float = PLACE["north"], res: float = PLACE["res"], width: int = 64) -> str:
    """Tile pixels (z, x, y, lon, lat) whose centre lies on a raster, with fractional source places."""
    lon = f"(gx + 0.5) / (256 * pow(2, z)) * 360 - 180"
    lat = f"degrees(2 * atan(exp(pi() * (1 - 2 * (gy + 0.5) / (256 * pow(2, z))))) - pi() / 2)"
    down = "(0.5 - ln((1 + sin(radians({v}))) / (1 - sin(radians({v})))) / (4 * pi())) * 256 * pow(2, z)"
    return f"""size AS (SELECT max(row) + 1 AS h FROM {last}), zs AS (SELECT unnest([9, 10]) AS z),
    cs AS (SELECT z, unnest(range(CAST(floor(({west} + 180) / 360 * 256 * pow(2, z)) AS BIGINT) - 1, CAST(ceil(({west} + {width * res} + 180) / 360 * 256 * pow(2, z)) AS BIGINT) + 1)) AS gx FROM zs),
    rs AS (SELECT z, unnest(range(CAST(floor({down.replace('{v}', str(north))}) AS BIGINT) - 1, CAST(ceil({down.replace('{v}', f'({north} - h * {res})')}) AS BIGINT) + 1)) AS gy FROM zs, size),
    px AS (SELECT z, gx, gy, gx // 256 AS x, gy // 256 AS y, {lon} AS lon, {lat} AS lat, ({lon} - ({west})) / {res} AS fc, ({north} - ({lat})) / {res} AS fr FROM cs JOIN rs USING (z)),
    inside AS (SELECT px.* FROM px, size WHERE fc >= 0 AND fc < {width} AND fr >= 0 AND fr < h)"""


def smooth(name: str, targets: str, values: str) -> str:
    """Bilinear values over the neighbours with data."""
    return f"""{name} AS (SELECT z, gx, gy, sum(w * value) / sum(w) AS v FROM (SELECT t.*, CAST(floor(fr - 0.5) AS BIGINT) + i AS row, CAST(floor(fc - 0.5) AS BIGINT) + j AS col,
      (CASE WHEN i = 1 THEN fr - 0.5 - floor(fr - 0.5) ELSE 1 - (fr - 0.5 - floor(fr - 0.5)) END) * (CASE WHEN j = 1 THEN fc - 0.5 - floor(fc - 0.5) ELSE 1 - (fc - 0.5 - floor(fc - 0.5)) END) AS w
      FROM {targets} t, range(2) AS a(i), range(2) AS b(j)) JOIN {values} USING (row, col) WHERE w > 0 GROUP BY 1, 2, 3)"""


def channel(k: int, v: str = "v") -> str:
    stops = [(s, int(c[1 + 2 * k:3 + 2 * k], 16)) for s, c in RAMP]
    parts = " ".join(f"WHEN {v} <= {s1} THEN {c0} + ({v} - ({s0})) / ({s1} - ({s0})) * ({c1} - ({c0}))" for (s0, c0), (s1, c1) in zip(stops, stops[1:]))
    return f"round_even(CASE WHEN {v} <= {stops[0][0]} THEN {stops[0][1]} {parts} ELSE {stops[-1][1]} END, 0)"


TOTALS = "count(*) AS n, CAST(sum(r) AS BIGINT) AS rojo, CAST(sum(g) AS BIGINT) AS verde, CAST(sum(b) AS BIGINT) AS azul"
MASK_SQL = "masks AS (SELECT -70.99 AS w, -30.6 AS s, -70.96 AS e, -30.02 AS n UNION ALL SELECT -70.97, -80.0, -70.95, -30.3)"


def mask(spark):
    """Two overlapping territories."""
    frame = spark.createDataFrame([(1, -70.99, -30.6, -70.96, -30.02), (2, -70.97, -80.0, -70.95, -30.3)], "mid long, w double, s double, e double, n double")
    return frame.select("mid", G.box(F.col("w"), F.col("s"), F.col("e"), F.col("n")).alias("geom"))


@query("N9_theme_climate", "pixels", f"""WITH {tile_pixels('pixels')}, {smooth('sm', 'inside', '(SELECT * FROM pixels WHERE value <> 0)')}, {MASK_SQL},
    shown AS (SELECT DISTINCT z, x, y, gx, gy, v * 0.5 AS v FROM sm JOIN inside USING (z, gx, gy) JOIN masks ON lon >= w AND lon < e AND lat > s AND lat <= n)
    SELECT z, x, y, {TOTALS} FROM (SELECT *, {channel(0)} AS r, {channel(1)} AS g, {channel(2)} AS b FROM shown) GROUP BY 1, 2, 3""")
def climate(spark, sf):
    place = {**PLACE, "height": rows_of(spark, sf), "factor": 0.5}
    return per_tile(themes.climate(source(spark, sf, 0.0), place, RAMP, ZOOMS, mask(spark)))


SOIL_RES = 0.00018
SOIL_WEST = math.floor(-71.2 / SOIL_RES) * SOIL_RES
SOIL_WIDTH = math.ceil(-70.6 / SOIL_RES) - math.floor(-71.2 / SOIL_RES)
SOIL_NORTH = math.ceil(-30.0 / SOIL_RES) * SOIL_RES


@query("N9_theme_soil", "pixels", f"""WITH size AS (SELECT max(row) + 1 AS h FROM pixels), rs AS (SELECT unnest(range(0, CAST(h AS BIGINT) + 100)) AS gy FROM size), cs AS (SELECT unnest(range(0, {SOIL_WIDTH})) AS gx),
    t AS (SELECT 1 AS z, gx, gy, ({GOODE['north']} - 6378137.0 * phi) / 20 AS fr, (6378137.0 * cos(phi) * (radians({SOIL_WEST!r} + (gx + 0.5) * {SOIL_RES}) - radians(-60.0)) + 6378137.0 * radians(-60.0) - ({GOODE['west']})) / 20 AS fc
      FROM cs, (SELECT gy, radians({SOIL_NORTH!r} - (gy + 0.5) * {SOIL_RES}) AS phi FROM rs)),
    inside AS (SELECT t.* FROM t, size WHERE fc >= 0 AND fc < 64 AND fr >= 0 AND fr < h), {smooth('sm', 'inside', 'pixels')}
    SELECT gy AS row, gx AS col, round_even(v, 0) AS value FROM sm""")
def soil(spark, sf):
    """The homolosine source on the lat/lon grid that its theme is coloured from."""
    rows = rows_of(spark, sf)
    grid = themes.soil_grid((-71.2, -30.0 - SOIL_RES * (rows + 99.5), -70.6, -30.0), SOIL_RES) | {"height": rows + 100}
    return B.to_pixels(themes.soil_window(source(spark, sf), {**GOODE, "height": rows}, grid)).select("row", "col", "value")


@query("N9_theme_cover", "pixels", f"""WITH c AS (SELECT floor(row / 5) AS row, floor(col / 5) AS col, floor(value / 50) * 50 AS v, count(*) AS n FROM pixels WHERE value <> 0 GROUP BY ALL),
    size0 AS (SELECT max(row) + 1 AS h FROM pixels), m AS (SELECT row, col, arg_max(v, (n, -v)) AS value FROM c, size0 WHERE row < floor(h / 5) AND col < 12 GROUP BY 1, 2),
    two AS (SELECT row, col, arg_min(value, pr) AS value FROM (SELECT row, col, value, 0 AS pr FROM m UNION ALL SELECT row + 3, col + 6, value, 1 FROM m) GROUP BY 1, 2),
    {tile_pixels('two', res=0.005, width=18)}, s AS (SELECT x, y, z, value AS v FROM inside JOIN two ON row = floor(fr) AND col = floor(fc) WHERE value >= -300)
    SELECT z, x, y, {TOTALS} FROM (SELECT *, CASE WHEN v >= 100 THEN 128 WHEN v >= 0 THEN 64 WHEN v >= -100 THEN 32 ELSE 10 END AS r, CASE WHEN v >= 100 THEN 240 WHEN v >= 0 THEN 120 WHEN v >= -100 THEN 60 ELSE 20 END AS g, 0 AS b FROM s) GROUP BY 1, 2, 3""")
def cover(spark, sf):
    """Two source tiles of classes, reduced five times; the second lies beside and partly under the first."""
    rows = rows_of(spark, sf)
    p = relation(spark, sf, "pixels").where("value <> 0").withColumn("value", F.floor(F.col("value") / 50) * 50.0)
    tiles = B.to_blocks(p.unionByName(p.withColumn("raster_id", F.lit(2).cast("long"))))
    place = spark.createDataFrame([(1, 9, 0, 0, 0), (2, 9, 3, 6, 1)], "raster_id long, target_id long, row0 int, col0 int, priority int")
    return per_tile(themes.cover(tiles, place, 5, (rows, 64), {**PLACE, "res": 0.005, "width": 18, "height": rows // 5 + 3}, CLASSES, ZOOMS))


LIGHT = """n AS (SELECT row, col, value, coalesce(lag(value) OVER (PARTITION BY row ORDER BY col), value) AS l, coalesce(lead(value) OVER (PARTITION BY row ORDER BY col), value) AS r FROM pixels),
    m AS (SELECT row, col, r - l AS d, l + 2 * value + r AS s FROM n),
    g AS (SELECT row, col, (coalesce(lag(d) OVER w, d) + 2 * d + coalesce(lead(d) OVER w, d)) / (8 * 0.001 * 111320.0 * cos(radians(-30.0 - (row + 0.5) * 0.001))) AS x,
      (coalesce(lead(s) OVER w, s) - coalesce(lag(s) OVER w, s)) / (8 * 0.001 * 110574.0) AS y FROM m WINDOW w AS (PARTITION BY col ORDER BY row)),
    light AS (SELECT row, col, least(greatest(cos(radians(45)) * cos(atan(sqrt(x * x + y * y))) + sin(radians(45)) * sin(atan(sqrt(x * x + y * y))) * cos(radians(135) - atan2(y, -x)), 0), 1) AS value FROM g)"""


@query("N9_theme_relief", "pixels", f"""WITH {LIGHT}, {tile_pixels('pixels')}, {smooth('sm', 'inside', 'pixels')}, {smooth('li', 'inside', 'light')},
    k AS (SELECT z, x, y, sm.v, 0.45 + 0.55 * li.v AS k FROM sm JOIN li USING (z, gx, gy) JOIN inside USING (z, gx, gy))
    SELECT z, x, y, {TOTALS} FROM (SELECT *, round_even({channel(0)} * k, 0) AS r, round_even({channel(1)} * k, 0) AS g, round_even({channel(2)} * k, 0) AS b FROM k) GROUP BY 1, 2, 3""")
def relief(spark, sf):
    """Heights in two source tiles, one of them numbered from seven rows further up."""
    p = relation(spark, sf, "pixels")
    second = F.floor(F.col("row") / 100) % 2
    tiles = B.to_blocks(p.withColumn("raster_id", 1 + second).withColumn("row", F.col("row") + 7 * second))
    place = spark.createDataFrame([(1, 9, 0, 0, 0), (2, 9, -7, 0, 1)], "raster_id long, target_id long, row0 int, col0 int, priority int")
    return per_tile(themes.relief(tiles, place, {**PLACE, "height": rows_of(spark, sf)}, RAMP, ZOOMS))


@query("N6_light_by_latitude", "pixels", f"WITH {LIGHT} SELECT row, col, round(value, 6) AS luz FROM light")
def light(spark, sf):
    lit = B.shaded(source(spark, sf), {**PLACE, "height": rows_of(spark, sf)})
    return B.to_pixels(lit).select("row", "col", F.round("value", 6).alias("luz"))


@query("A23_raster_blocks", "pixels", """SELECT CAST(floor(row / 256) AS BIGINT) AS brow, CAST(floor(col / 256) AS BIGINT) AS bcol, 65536 AS casillas, count(*) AS datos, CAST(sum(value * (row % 256 * 256 + col)) AS DOUBLE) AS suma
    FROM pixels WHERE value <> 0 GROUP BY 1, 2""")
def raster_blocks(spark, sf):
    seen = F.filter(F.transform("values", lambda v, i: v * i), lambda v: ~F.isnan(v))
    return source(spark, sf, 0.0).select("brow", "bcol", F.size("values").alias("casillas"), F.size(seen).cast("long").alias("datos"), F.aggregate(seen, F.lit(0.0), lambda a, v: a + v).alias("suma"))


@query("N9_theme_division", "comunas", """SELECT z, x, y, count(*) AS comunas, count(DISTINCT color) AS colores FROM (SELECT z, unnest(range(CAST(floor((105 + x0 / 1e5) / 360 * pow(2.0, z)) AS BIGINT), CAST(floor((105 + x1 / 1e5) / 360 * pow(2.0, z)) AS BIGINT) + 1)) AS x,
    ya, yb, color FROM (SELECT *, unnest([9, 10, 11]) AS z, -40 + y0 / 1e5 AS ya, -40 + y1 / 1e5 AS yb, CASE substr(lpad(CAST(k % 16 + 1 AS VARCHAR), 2, '0'), 1, 2) WHEN 'none' THEN '' ELSE lpad(CAST(k % 16 + 1 AS VARCHAR), 2, '0') END AS color FROM comunas)) a,
    LATERAL (SELECT unnest(range(CAST(floor((0.5 - ln((1 + sin(radians(yb))) / (1 - sin(radians(yb)))) / (4 * pi())) * pow(2.0, z)) AS BIGINT), CAST(floor((0.5 - ln((1 + sin(radians(ya))) / (1 - sin(radians(ya)))) / (4 * pi())) * pow(2.0, z)) AS BIGINT) + 1)) AS y) GROUP BY 1, 2, 3""")
def division(spark, sf):
    c = relation(spark, sf, "comunas")
    box = F.struct((F.col("x0") / 1e5 - 75).alias("xmin"), (F.col("y0") / 1e5 - 40).alias("ymin"), (F.col("x1") / 1e5 - 75).alias("xmax"), (F.col("y1") / 1e5 - 40).alias("ymax"))
    cut = F.concat(F.lpad((F.col("k") % 16 + 1).cast("string"), 2, "0"), F.lit("101"))
    tiles = themes.division(c.select(cut.alias("cut"), F.col("comuna").alias("nombre"), "region", box.alias("bbox")), (9, 11))
    return tiles.groupBy("z", "x", "y").agg(F.count("*").alias("comunas"), F.countDistinct("color").alias("colores"))


# L shapes: two touching boxes for every comuna. The first column of comunas is cut at x = 0, a hundred metres in.
MARGIN, FAN = 50.0, 16 * 0.5 * 50.0 * 50.0 * math.sin(math.pi / 32)


@query("E20_territory_mask", "comunas", f"""SELECT cut, round(1250000 - 100000 * c + {MARGIN} * (5000 - 200 * c) + 5 * {FAN!r} - {MARGIN * MARGIN}, 1) AS area, 1 AS partes,
    greatest(x0 - 100 * c, 0) - {MARGIN} AS xmin, y0 - {MARGIN} AS ymin, x0 + 1500 - 100 * c + {MARGIN} AS xmax, y0 + 1000 + {MARGIN} AS ymax FROM (SELECT *, CASE WHEN x0 = 0 THEN 1 ELSE 0 END AS c FROM comunas)""")
def territory(spark, sf):
    c = relation(spark, sf, "comunas").withColumn("x0", F.col("x0") - F.when(F.col("x0") == 0, 100).otherwise(0))
    tall = c.select("cut", F.lit(1).alias("parte"), G.box(F.col("x0"), F.col("y0"), F.col("x0") + 1000, F.col("y0") + 1000).alias("geom"))
    low = c.select("cut", F.lit(2).alias("parte"), G.box(F.col("x0") + 1000, F.col("y0"), F.col("x0") + 1500, F.col("y0") + 500).alias("geom"))
    mask = territory_mask(tall.unionByName(low), "cut", "parte", (0.0, -1e6, 1e9, 1e9), 1.0, MARGIN, 2_000.0).withColumn("b", G.bbox(F.col("geom")))
    return mask.select("cut", F.round(G.area(F.col("geom")), 1).alias("area"), G.part_count(F.col("geom")).alias("partes"), *[F.round(f"b.{k}", 3).alias(k) for k in ("xmin", "ymin", "xmax", "ymax")])


@query("I27_crossing_far_apart", "feat_base feat", "SELECT gid FROM feat WHERE gid % 5 = 0")
def crossing(spark, sf):
    """Rings of 80 vertices along the outline of a feature; those of every fifth jump across the whole shape twice."""
    n, side = 80, F.col("x1") - F.col("x0")
    t = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: G.let(i * 2 * math.pi / n, lambda a: G.point(
        F.col("x0") + side * (0.5 + 0.5 * F.cos(a)), F.col("y0") + side * (0.5 + 0.5 * F.sin(a)))))
    f = spread(relation(spark, sf, "feat")).withColumn("r", t)
    jump = F.concat(F.slice("r", 1, 20), F.slice("r", 61, 1), F.slice("r", 22, 39), F.slice("r", 21, 1), F.slice("r", 62, 19))
    ring = F.when(F.col("gid") % 5 == 0, jump).otherwise(F.col("r"))
    rings = truncate_lineage(f.select("gid", F.array(F.array(F.concat(ring, F.slice("r", 1, 1)))).alias("geom")))
    return crossing_shapes(rings, "gid")


def with_middles(corners):
    """A closed ring of corners with a needless point in the middle of every side."""
    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.array(F.get(corners, i), G.point(
        (F.get(corners, i)["x"] + F.get(corners, (i + 1) % 4)["x"]) / 2, (F.get(corners, i)["y"] + F.get(corners, (i + 1) % 4)["y"]) / 2))))


Y_OF = "(0.5 - ln((1 + sin(radians({v}))) / (1 - sin(radians({v})))) / (4 * pi()))"


@query("B15_tile_pyramid", "feat_base feat", f"""WITH f AS (SELECT gid, (105 + x0 / 1e5) / 360 AS xa, (105 + x1 / 1e5) / 360 AS xb, {Y_OF.replace('{v}', '(-40 + y1 / 1e5)')} AS ya, {Y_OF.replace('{v}', '(-40 + y0 / 1e5)')} AS yb FROM feat),
    z AS (SELECT z, pow(2.0, -z) AS s, pow(2.0, -z) * 80 / 4096 AS m FROM (SELECT unnest([10, 11, 12, 13]) AS z)),
    t AS (SELECT *, unnest(range(CAST(floor((xa - m) / s) AS BIGINT), CAST(floor((xb + m) / s) AS BIGINT) + 1)) AS x FROM f, z), u AS (SELECT *, unnest(range(CAST(floor((ya - m) / s) AS BIGINT), CAST(floor((yb + m) / s) AS BIGINT) + 1)) AS y FROM t)
    SELECT z, x, y, count(*) AS piezas, round(sum((least(xb, (x + 1) * s + m) - greatest(xa, x * s - m)) * (least(yb, (y + 1) * s + m) - greatest(ya, y * s - m)) / (s * s) * 4096 * 4096), 1) AS area
    FROM u GROUP BY 1, 2, 3""")
def pyramid(spark, sf):
    """Features with a needless point on every side: thinned, the corners are left."""
    f = spread(relation(spark, sf, "feat"))
    corner = lambda x, y: G.point(F.col(x) / 1e5 - 75, F.col(y) / 1e5 - 40)
    ring = with_middles(F.array(corner("x0", "y0"), corner("x1", "y0"), corner("x1", "y1"), corner("x0", "y1")))
    shape = F.array(F.array(G.let(ring, lambda r: F.concat(r, F.slice(r, 1, 1)))))
    tiles = tile_pyramid(f.select("gid", shape.alias("geom")), "gid", (10, 13), tolerance=1e-4, whole=False)
    return tiles.groupBy("z", "x", "y").agg(F.count("*").alias("piezas"), F.round(F.sum(G.area(F.col("geom"))), 1).alias("area"))


@query("B17_outline_box", "comunas", """SELECT cut, comuna AS nombre, round_even(xa, 4) AS oeste, round_even(ya, 4) AS sur, round_even(xb, 4) AS este, round_even(yb, 4) AS norte, 5 AS puntos, round_even(xa, 5) AS x, round_even(ya, 5) AS y
    FROM (SELECT *, -71 + x0 / 1e6 AS xa, -71 + x1 / 1e6 AS xb, -35 + y0 / 1e6 AS ya, -35 + y1 / 1e6 AS yb FROM comunas)""")
def outline_box(spark, sf):
    corner = lambda x, y: G.point(F.col(x) / 1e6 - 71, F.col(y) / 1e6 - 35)
    ring = with_middles(F.array(corner("x0", "y0"), corner("x1", "y0"), corner("x1", "y1"), corner("x0", "y1")))
    out = display_outlines(relation(spark, sf, "comunas").select("cut", "comuna", F.array(F.array(F.concat(ring, F.slice(ring, 1, 1)))).alias("geom")))
    point = F.get(G.vertices(F.col("geom")), F.lit(0))
    return out.select("cut", "nombre", *[F.get("bbox", F.lit(i)).alias(n) for i, n in enumerate(("oeste", "sur", "este", "norte"))], F.size(G.vertices(F.col("geom"))).alias("puntos"), point["x"].alias("x"), point["y"].alias("y"))

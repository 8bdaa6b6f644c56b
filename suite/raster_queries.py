"""Rasters, tiles and the streamed demand votes."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from zonaria.functions import geometry as G
from zonaria.functions.numeric import half_even
from zonaria.operators import raster as RA
from zonaria.operators import shapes
from zonaria.operators.demand import exploded, region_votes
from zonaria.session import shared_folder
from zonaria.sources import sinks
from zonaria.streaming.demand import stream_log, vote_stream

from .base import query, relation, shaped, table

# One raster of 64 columns; every vector is a row. North-west corner at (-75, -30), 0.01 degrees per pixel.
WEST, NORTH, RES = -75.0, -30.0, 0.01
HEIGHT = 1_000_000_000


def pixels(spark, sf):
    return relation(spark, sf, "pixels")


def theme(name, **extra):
    return {"id": name, "raster_id": 1, "west": WEST, "north": NORTH, "res": RES, "width": 64, "height": HEIGHT, "nodata": 0, **extra}


SAMPLE = """p AS (SELECT event_id AS pid, event_id % 70 AS c, CAST(floor(event_id / 70) AS BIGINT) AS r FROM events), s AS (SELECT p.*, x.value FROM p LEFT JOIN pixels x ON x.row = p.r AND x.col = p.c)"""


@query("N1_N2_theme_sampling", "pixels", f"""WITH {SAMPLE} SELECT pid, 'clima' AS tema, CASE WHEN c < 64 AND value <> 0 THEN round_even(value * 0.1, 1) END AS valor, NULL AS etiqueta,
    CASE WHEN c >= 64 THEN 'fuera del área generada de este tema' WHEN value IS NULL OR value = 0 THEN 'sin dato en este punto' END AS motivo FROM s
    UNION ALL SELECT pid, 'cobertura', CASE WHEN c < 64 AND value <> 0 THEN value END, CASE WHEN c < 64 AND value <> 0 THEN CASE value WHEN 20 THEN 'Matorral' WHEN -30 THEN 'Bosque' ELSE 'clase ' || CAST(CAST(value AS INT) AS VARCHAR) END END,
    CASE WHEN c >= 64 THEN 'fuera del área generada de este tema' WHEN value IS NULL OR value = 0 THEN 'sin dato en este punto' END FROM s""")
def sampling(spark, sf):
    e = F.col("event_id")
    points = table(spark, sf, "events").select(e.alias("pid"), (F.lit(WEST) + (e % 70 + 0.5) * RES).alias("lon"), (F.lit(NORTH) - (F.floor(e / 70) + 0.5) * RES).alias("lat"))
    return RA.sample(points, pixels(spark, sf), [theme("clima", factor=0.1, decimals=1), theme("cobertura", classes={20: "Matorral", -30: "Bosque"})])


@query("N3_decimation_by_mode", "pixels", """WITH c AS (SELECT CAST(floor(row / 4) AS BIGINT) AS row, CAST(floor(col / 4) AS BIGINT) AS col, floor(value / 100) * 100 AS v, count(*) AS n FROM pixels GROUP BY 1, 2, 3),
    h AS (SELECT max(row) + 1 AS h FROM pixels) SELECT row, col, coalesce(arg_max(v, (n, -v)) FILTER (WHERE v <> 0), 0) AS value FROM c, h WHERE row < floor(h / 4) GROUP BY 1, 2""")
def decimation(spark, sf):
    p = pixels(spark, sf).withColumn("value", F.floor(F.col("value") / 100) * 100.0)
    rows = table(spark, sf, "embeddings").agg(F.max("vec_id")).first()[0] + 1
    return RA.decimate(p, 4, rows, 64).select("row", "col", "value")


@query("N4_mosaic", "pixels", """WITH t AS (SELECT row, col + 64 * (row % 2) AS col, value, 1 AS pr FROM pixels WHERE value > 0 UNION ALL SELECT row, col + 32, value, 2 FROM pixels WHERE value <> 0)
    SELECT row, col, arg_min(value, pr) AS value FROM t GROUP BY 1, 2""")
def mosaic(spark, sf):
    p = pixels(spark, sf)
    odd = F.col("row") % 2
    first = p.where("value > 0").withColumns({"raster_id": 10 + odd})
    second = p.withColumn("raster_id", F.lit(12))
    place = p.select((F.col("col") % 3).alias("k")).distinct().select((F.col("k") + 10).cast("bigint").alias("raster_id"), F.lit(0).cast("bigint").alias("row0"),
                                                                     F.when(F.col("k") == 0, 0).when(F.col("k") == 1, 64).otherwise(32).alias("col0"), F.when(F.col("k") == 2, 2).otherwise(1).alias("priority"))
    return RA.mosaic(first.unionByName(second), place, 0.0)


@query("N5_bilinear_resample", "pixels", """SELECT a.row AS trow, a.col AS tcol, round((coalesce(a.value, 0) + b.value + c.value + d.value) / 4, 6) AS value FROM pixels a JOIN pixels b ON b.row = a.row AND b.col = a.col + 1
    JOIN pixels c ON c.row = a.row + 1 AND c.col = a.col JOIN pixels d ON d.row = a.row + 1 AND d.col = a.col + 1""")
def bilinear(spark, sf):
    """Targets in the middle of four pixels: the mean of the four, where all four exist."""
    p = pixels(spark, sf)
    last = table(spark, sf, "embeddings").agg(F.max("vec_id").alias("m"))
    targets = p.select("raster_id", F.col("row").alias("trow"), F.col("col").alias("tcol"), (F.col("row") + 1.0).alias("frow"), (F.col("col") + 1.0).alias("fcol")).where("tcol < 63")
    kept = targets.join(last, F.col("trow") < F.col("m"), "left_semi")
    return RA.bilinear(kept, p).select("trow", "tcol", F.round("value", 6).alias("value"))


HORN = """n AS (SELECT row, col, value, coalesce(lag(value) OVER (PARTITION BY row ORDER BY col), value) AS l, coalesce(lead(value) OVER (PARTITION BY row ORDER BY col), value) AS r FROM pixels),
    m AS (SELECT row, col, r - l AS d, l + 2 * value + r AS s FROM n), g AS (SELECT row, col, coalesce(lag(d) OVER w, d) + 2 * d + coalesce(lead(d) OVER w, d) AS gx, coalesce(lead(s) OVER w, s) - coalesce(lag(s) OVER w, s) AS gy FROM m WINDOW w AS (PARTITION BY col ORDER BY row))"""


@query("F7_horn_gradients", "pixels", f"WITH {HORN} SELECT row, col, gx, gy FROM g")
def horn(spark, sf):
    return RA.gradients(pixels(spark, sf)).select("row", "col", "gx", "gy")


@query("N6_hillshade", "pixels", f"""WITH {HORN}, k AS (SELECT row, col, gx / 8 / 1000 AS x, gy / 8 / 1000 AS y FROM g), t AS (SELECT row, col, atan(sqrt(x * x + y * y)) AS sl, atan2(y, -x) AS asp FROM k)
    SELECT row, col, round(least(greatest(cos(radians(45)) * cos(sl) + sin(radians(45)) * sin(sl) * cos(radians(135) - asp), 0), 1), 6) AS luz FROM t""")
def shade(spark, sf):
    h = RA.hillshade(pixels(spark, sf), F.lit(1000.0), F.lit(1000.0))
    return h.select("row", "col", F.round("luz", 6).alias("luz"))


RAMP = [(-500.0, "#000000"), (0.0, "#808080"), (500.0, "#ffffff")]


def tiled(spark, sf, **kw):
    rows = table(spark, sf, "embeddings").agg(F.max("vec_id")).first()[0] + 1
    return RA.raster_tiles(pixels(spark, sf), theme("t", nodata=None, height=rows) | {"height": rows, "nodata": None}, RAMP, (6, 7), edge=64, **kw)


@query("N7_B16_raster_tiles", "pixels", """WITH z AS (SELECT 6 AS z UNION ALL SELECT 7), b AS (SELECT max(row) + 1 AS h FROM pixels),
    t AS (SELECT z, x, y FROM z, b, LATERAL (SELECT unnest(range(CAST(floor(105.0 / 360 * pow(2, z)) AS BIGINT), CAST(floor((-75 + 0.64 + 180) / 360 * pow(2, z)) AS BIGINT) + 1)) AS x),
      LATERAL (SELECT unnest(range(CAST(floor((0.5 - ln((1 + sin(radians(-30.0))) / (1 - sin(radians(-30.0)))) / (4 * pi())) * pow(2, z)) AS BIGINT), CAST(floor((0.5 - ln((1 + sin(radians(-30 - h / 100.0))) / (1 - sin(radians(-30 - h / 100.0)))) / (4 * pi())) * pow(2, z)) AS BIGINT) + 1)) AS y)),
    g AS (SELECT t.*, r.r, c.c FROM t, (SELECT unnest(range(0, 64)) AS r) r, (SELECT unnest(range(0, 64)) AS c) c),
    q AS (SELECT z, x, y, r, c, floor((((x + (c + 0.5) / 64) / pow(2, z) * 360 - 180) + 75) / 0.01) AS pc, floor((-30 - degrees(2 * atan(exp(pi() * (1 - 2 * (y + (r + 0.5) / 64) / pow(2, z)))) - pi() / 2)) / 0.01) AS pr FROM g)
    SELECT z, x, y, count(*) AS n, CAST(sum(CASE WHEN value >= 500 THEN 255 WHEN value >= 0 THEN 128 ELSE 0 END) AS BIGINT) AS rojo FROM q JOIN pixels p ON p.row = q.pr AND p.col = q.pc WHERE value >= -500 GROUP BY 1, 2, 3""")
def tiles(spark, sf):
    return tiled(spark, sf, step=True).groupBy("z", "x", "y").agg(F.count("*").alias("n"), F.sum("r").alias("rojo"))


@query("N7_shaded_tiles")
def shaded_tiles(spark, sf):
    light = RA.hillshade(pixels(spark, sf), F.lit(1000.0), F.lit(1000.0)).select("raster_id", "row", "col", F.col("luz").alias("value"))
    return tiled(spark, sf, shade=light).groupBy("z", "x", "y").agg(F.count("*").alias("n"), F.sum("r").alias("rojo"))


TX = "CAST(floor(({v} + 180) / 360 * pow(2.0, z)) AS BIGINT)"
TY = "CAST(floor((0.5 - ln((1 + sin(radians({v}))) / (1 - sin(radians({v})))) / (4 * pi())) * pow(2.0, z)) AS BIGINT)"


@query("N8_vector_tiles", "feat_base feat", f"""WITH b AS (SELECT gid, -75 + x0 / 1e5 AS xa, -75 + x1 / 1e5 AS xb, -40 + y0 / 1e5 AS ya, -40 + y1 / 1e5 AS yb FROM feat), z AS (SELECT unnest([8, 10, 12, 9, 11]) AS z)
    SELECT z, count(*) AS n, CAST(sum({TX.replace('{v}', 'xb')} - {TX.replace('{v}', 'xa')} + 1) * 0 + sum(({TX.replace('{v}', 'xb')} - {TX.replace('{v}', 'xa')} + 1) * ({TY.replace('{v}', 'ya')} - {TY.replace('{v}', 'yb')} + 1)) AS BIGINT) AS celdas FROM b, z GROUP BY z""")
def vector_tiles(spark, sf):
    b = F.struct((F.col("x0") / 1e5 - 75).alias("xmin"), (F.col("y0") / 1e5 - 40).alias("ymin"), (F.col("x1") / 1e5 - 75).alias("xmax"), (F.col("y1") / 1e5 - 40).alias("ymax"))
    t = RA.vector_tiles(relation(spark, sf, "feat").select("gid", b.alias("bbox")), (8, 12))
    return t.groupBy("z").agg(F.countDistinct("gid").alias("n"), F.count("*").alias("celdas"))


BOXES = "SELECT s_suppkey AS bid, -75 + s_suppkey % 7 * 0.4e0 AS w, -40 + s_suppkey % 5 * 0.7e0 AS s, -75 + s_suppkey % 7 * 0.4e0 + 1 + s_nationkey % 3 AS e, -40 + s_suppkey % 5 * 0.7e0 + 1.5e0 AS n FROM [supplier]"


def boxes(spark, sf):
    return spark.sql(BOXES.replace("[supplier]", "{s}"), s=table(spark, sf, "supplier"))


@query("A25_one_degree_tiles", sql=f"""WITH b AS ({BOXES.replace('[supplier]', 'supplier')}) SELECT bid, lat, lon, concat('Copernicus_DSM_COG_10_', CASE WHEN lat < 0 THEN 'S' ELSE 'N' END, lpad(CAST(abs(lat) AS VARCHAR), 2, '0'), '_00_', CASE WHEN lon < 0 THEN 'W' ELSE 'E' END,
    lpad(CAST(abs(lon) AS VARCHAR), 3, '0'), '_00_DEM') AS tesela FROM b, LATERAL (SELECT unnest(range(CAST(floor(s) AS BIGINT), CAST(ceil(n) AS BIGINT))) AS lat), LATERAL (SELECT unnest(range(CAST(floor(w) AS BIGINT), CAST(ceil(e) AS BIGINT))) AS lon)""")
def one_degree(spark, sf):
    return RA.degree_tiles(boxes(spark, sf))


@query("A25_O5_three_degree_tiles", sql=f"""WITH b AS ({BOXES.replace('[supplier]', 'supplier')}) SELECT bid, lat0, lon0 FROM b, LATERAL (SELECT unnest(range(CAST(floor(s / 3) * 3 AS BIGINT), CAST(ceil(n / 3) * 3 AS BIGINT), 3)) AS lat0), LATERAL (SELECT unnest(range(CAST(floor(w / 3) * 3 AS BIGINT), CAST(ceil(e / 3) * 3 AS BIGINT), 3)) AS lon0)""")
def three_degree(spark, sf):
    t = RA.three_degree_tiles(boxes(spark, sf))
    mask = boxes(spark, sf).select(F.col("bid").alias("mid"), G.box(F.col("w"), F.col("s"), F.col("e"), F.col("n")).alias("geom"))
    return RA.tiles_touching(t, mask).select("bid", "lat0", "lon0")


@query("I29_B17_simplified_outlines", "feat_base feat", "SELECT gid, 5 AS puntos, round_even((x1 - x0) * (y1 - y0), 1) AS area FROM feat")
def simplified(spark, sf):
    """A needless vertex on every side disappears, the corners stay."""
    df = shaped(spark, sf, "feat")
    ring = F.get(F.get(F.col("geom"), F.lit(0)), F.lit(0))
    more = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.array(
        F.get(ring, i), G.point((F.get(ring, i)["x"] + F.get(ring, i + 1)["x"]) / 2, (F.get(ring, i)["y"] + F.get(ring, i + 1)["y"]) / 2))))
    dense = df.select("gid", F.array(F.array(F.concat(more, F.slice(ring, 1, 1)))).alias("geom"))
    s = shapes.simplify(dense, 0.5)
    return s.select("gid", F.size(G.vertices(F.col("geom"))).alias("puntos"), half_even(G.area(F.col("geom")), 1).alias("area"))


@query("J1_streamed_votes", sql="SELECT event_type AS fuente, concat('R', CAST(user_id % 4 AS VARCHAR)) AS region, count(*) AS n FROM events GROUP BY 1, 2")
def streamed(spark, sf):
    """The demand log written as files, read as a stream and counted; the last table is the batch count."""
    home = f"{shared_folder(spark).rstrip('/')}/votes-{uuid.uuid4().hex}"
    e = table(spark, sf, "events")
    log = e.select(F.date_format("ts", "yyyy-MM-dd").alias("fecha"), F.concat(F.lit("R"), (F.col("user_id") % 4).cast("string")).alias("region"), F.lit("c").alias("cut"), F.lit("c").alias("comuna"), F.lit("U1").alias("clase"),
                   F.lit("completa").alias("cobertura"), F.array("event_type").alias("fuentes_relevantes_no_activas"))
    sinks.append_demand(log.repartition(4), f"{home}/log")
    run = (vote_stream(stream_log(spark, f"{home}/log", 2)).writeStream.outputMode("complete")
           .foreachBatch(lambda votes, _: votes.write.mode("overwrite").parquet(f"{home}/votes"))
           .option("checkpointLocation", f"{home}/state").trigger(availableNow=True).start())
    run.awaitTermination()
    return spark.read.parquet(f"{home}/votes")


@query("J1_batch_votes", sql="SELECT event_type AS fuente, concat('R', CAST(user_id % 4 AS VARCHAR)) AS region, count(*) AS n FROM events GROUP BY 1, 2")
def batch(spark, sf):
    e = table(spark, sf, "events")
    log = e.select(F.lit("f").alias("fecha"), F.concat(F.lit("R"), (F.col("user_id") % 4).cast("string")).alias("region"), F.lit("c").alias("cut"), F.lit("c").alias("comuna"), F.lit("U1").alias("clase"), F.array("event_type").alias("fuentes_relevantes_no_activas"))
    return region_votes(exploded(log))

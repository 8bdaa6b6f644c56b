"""Readers, writers, paging, streaming, rasters and skewed inputs."""
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from helpers import box, frame
from zonaria.functions import geometry as G
from zonaria.functions import scales as S
from zonaria.operators import overlay as O
from zonaria.operators import partition as P
from zonaria.operators import raster as RA
from zonaria.operators import shapes
from zonaria.operators.parcels import hilbert_key
from zonaria.sources import layers as L
from zonaria.sources import sinks
from zonaria.sources.paged import PagedFeatures
from zonaria.streaming.demand import daily_votes, stream_log, vote_stream


def polygon(x):
    return [[[x, 0], [x + 1, 0], [x + 1, 1], [x, 1], [x, 0]]]


def test_geojson_layers(spark, tmp_path):
    doc = {"_meta": {"source": "s", "count": 3, "fields": ["A"], "fetched_at": "2026-01-01"}, "features": [
        {"geometry": {"type": "Polygon", "coordinates": polygon(0)}, "properties": {"ZONA": "á", "N": 5}},
        {"geometry": {"type": "MultiPolygon", "coordinates": [polygon(0), polygon(5)]}, "properties": {"ZONA": None}},
        {"geometry": {"type": "Point", "coordinates": [1, 2]}, "properties": {}}]}
    (tmp_path / "a.geojson").write_text(json.dumps(doc, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "b.geojson").write_text(json.dumps({"_meta": {}, "features": []}), encoding="utf-8")
    rows = L.read_feature_layers(spark, str(tmp_path)).select("properties", "fetched_at", G.area(F.col("geom")).alias("a"), F.size("geom").alias("n")).collect()
    assert [(r.properties.get("ZONA"), r.a, r.n) for r in rows] == [("á", 1.0, 1), (None, 2.0, 2)]
    assert rows[0].properties["N"] == "5" and rows[0].fetched_at == "2026-01-01"


@pytest.mark.parametrize("info", [{"supportsPagination": True}, {"supportsPagination": True, "known": 4500}, {"supportsPagination": False}])
def test_paged_source(spark, tmp_path, info):
    features = [{"geometry": {"type": "Polygon", "coordinates": polygon(i)}, "properties": {"OBJECTID": i, "Z": f"z{i}"}} for i in range(4500)]
    meta = {"type": "Feature Layer", "maxRecordCount": 1000, "advancedQueryCapabilities": {"supportsPagination": info["supportsPagination"]}}
    if "known" in info:
        meta["count"] = info["known"]
    (tmp_path / "info.json").write_text(json.dumps(meta))
    (tmp_path / "features.json").write_text(json.dumps(features))
    spark.dataSource.register(PagedFeatures)
    df = spark.read.format("paged_features").option("location", str(tmp_path)).load()
    assert df.rdd.getNumPartitions() == (1 if info == {"supportsPagination": True} else 5)
    assert df.agg(F.count("*"), F.countDistinct(F.col("properties")["OBJECTID"])).first()[:] == (4500, 4500)
    geoms = df.withColumn("geom", L.geojson_geometry("geometry_type", "coordinates"))
    assert geoms.agg(F.sum(G.area(F.col("geom")))).first()[0] == 4500.0


def test_parcel_files(spark, tmp_path):
    lots = frame(spark, [(i, "1" if i % 3 else "2", box(i % 10 * 10, i // 10 * 10, i % 10 * 10 + 8, i // 10 * 10 + 8)) for i in range(100)], "rid long, cut string, geom GEOM")
    sinks.write_parcels(lots, str(tmp_path / "p"), (0, 0, 100, 100))
    back = spark.read.parquet(str(tmp_path / "p"))
    near = back.where("bbox.xmin <= 34 AND bbox.xmax >= 34 AND bbox.ymin <= 45 AND bbox.ymax >= 45")
    assert [r.rid for r in near.collect()] == [43]
    assert "PushedFilters: [IsNotNull(bbox.xmin)" in near._jdf.queryExecution().toString()
    one = L.read_partitioned(spark, str(tmp_path / "p"), spark.createDataFrame([("2",)], "cut string"))
    assert one.count() == 34


def test_hilbert_curve_is_continuous(spark):
    cells = spark.range(64).select((F.col("id") % 8).alias("x"), F.floor(F.col("id") / 8).alias("y"))
    order = cells.select("x", "y", hilbert_key(F.col("x"), F.col("y"), 3).alias("d")).orderBy("d").collect()
    assert [r.d for r in order] == list(range(64))
    assert all(abs(a.x - b.x) + abs(a.y - b.y) == 1 for a, b in zip(order, order[1:]))


def test_layer_and_geojson_writers(spark, tmp_path):
    df = frame(spark, [(1, "R1", "ñ", "{}", box(0.12345678, 0, 1, 1)), (2, "R2", None, "{}", box(0, 0, 2, 2)), (3, "R2", "x", "{}", [])], "id long, region string, zona string, attrs_raw string, geom GEOM")
    sinks.write_layer(df, str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m")).count() == 2
    sinks.write_geojson_lines(df.where("id < 3"), str(tmp_path / "g"))
    text = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "g")).collect()]
    first = next(t for t in text if t["properties"]["id"] == 1)
    assert first["geometry"]["coordinates"][0][0][0] == [0.123457, 0.0] and "attrs_raw" not in first["properties"]
    sinks.write_csv(df.select("id", "zona"), str(tmp_path / "c"))
    assert L.read_text_table(spark, str(tmp_path / "c")).count() == 3
    sinks.write_json(df.select("id"), str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 3


def test_saved_parcels_and_backups(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"predios": [{"rol": "1-2", "m2_terreno": 5.0, "geometry": {"type": "Polygon", "coordinates": polygon(0)}}]}))
    row = L.read_saved_parcels(spark, str(tmp_path / "p.json")).select("rol", "m2_terreno", G.area(F.col("geom")).alias("a")).first()
    assert (row.rol, row.m2_terreno, row.a) == ("1-2", 5.0, 1.0)
    one = frame(spark, [("r", box(0, 0, 1, 1))], "rol string, geom GEOM").coalesce(1)
    one.write.parquet(str(tmp_path / "b"))
    source = next((tmp_path / "b").glob("part-*.parquet"))
    folder = tmp_path / "named"
    folder.mkdir()
    (folder / "Puerto_Montt_10101.parquet").write_bytes(source.read_bytes())
    assert L.read_parcel_backups(spark, str(folder), ("rol", "periodo")).select("rol", "cod_capa").first()[:] == ("r", "10101")


def test_streamed_demand(spark, tmp_path):
    lines = spark.createDataFrame([(f"2026-01-{1 + i % 3:02d}", f"R{i % 2}", "1", "c", "U1", "completa", ["a", "b"] if i % 2 else ["a"]) for i in range(30)], L.DEMAND)
    sinks.append_demand(lines.limit(10), str(tmp_path / "log"))
    sinks.append_demand(lines.subtract(lines.limit(0)).limit(20), str(tmp_path / "log"))
    log = stream_log(spark, str(tmp_path / "log"), 1)
    run = vote_stream(log).writeStream.outputMode("complete").format("memory").queryName("votes").option("checkpointLocation", str(tmp_path / "s")).trigger(availableNow=True).start()
    run.awaitTermination()
    from zonaria.operators.demand import exploded, region_votes

    batch = region_votes(exploded(L.read_demand(spark, str(tmp_path / "log"))))
    assert sorted(map(tuple, spark.table("votes").collect())) == sorted(map(tuple, batch.collect()))
    run = daily_votes(log).writeStream.outputMode("append").format("memory").queryName("days").option("checkpointLocation", str(tmp_path / "d")).trigger(availableNow=True).start()
    run.awaitTermination()


def test_ramps(spark):
    step = spark.createDataFrame([(5.0,), (10.0,), (15.0,), (20.0,), (99.0,), (None,)], "v double").select(S.ramp_colour(F.col("v"), [(10, "#000001"), (20, "#000002"), (30, "#000003")], True).alias("k")).collect()
    assert [r.k.a for r in step] == [0, 255, 255, 255, 255, 0] and [r.k.b for r in step][1:5] == [1, 1, 2, 3]
    linear = spark.createDataFrame([(-50.0,), (200.0,), (50.0,)], "v double").select(S.ramp_colour(F.col("v"), [(0, "#000000"), (100, "#ff0000")]).alias("k")).collect()
    assert [r.k.r for r in linear] == [0, 255, 128]


def pixels(spark, height):
    return spark.createDataFrame([(1, r, c, float(height(r, c))) for r in range(6) for c in range(6)], "raster_id long, row long, col long, value double")


@pytest.mark.parametrize("azimuth,rise,expected", [(315.0, 0.0, 0.707), (270.0, 1.0, 0.966), (90.0, 1.0, 0.259)])
def test_hillshade(spark, azimuth, rise, expected):
    """A plane, and a 30° slope that rises to the east (so it faces west)."""
    grid = pixels(spark, lambda r, c: rise * c * math.tan(math.radians(30)) * 10)
    h = RA.hillshade(grid, F.lit(10.0), F.lit(10.0), azimuth=azimuth).where("row BETWEEN 1 AND 4 AND col BETWEEN 1 AND 4").collect()
    assert {round(r.luz, 3) for r in h} == {expected}


def test_sampling_and_decimation(spark):
    p = spark.createDataFrame([(1, 0, 0, 123.0), (1, 0, 1, 20.0), (1, 1, 0, 99.0), (1, 1, 1, -1.0)], "raster_id long, row long, col long, value double")
    theme = {"raster_id": 1, "west": 0, "north": 2, "res": 1, "width": 2, "height": 2, "nodata": -1}
    pts = spark.createDataFrame([(1, 0.5, 1.5), (2, 1.5, 1.5), (3, 0.5, 0.5), (4, 1.5, 0.5), (5, 9.0, 9.0)], "pid long, lon double, lat double")
    rows = RA.sample(pts, p, [{**theme, "id": "t", "factor": 0.1}, {**theme, "id": "k", "classes": {20: "Matorral"}}]).collect()
    got = {(r.pid, r.tema): (r.valor, r.etiqueta, r.motivo) for r in rows}
    assert got[(1, "t")] == (12.3, None, None) and got[(2, "k")] == (20.0, "Matorral", None) and got[(3, "k")] == (99.0, "clase 99", None)
    assert got[(4, "t")][2] == "sin dato en este punto" and got[(5, "t")][2] == "fuera del área generada de este tema"
    m = spark.createDataFrame([(1, r, c, float(v)) for r, line in enumerate([[1, 1, 2, 3], [1, 9, 2, 2], [0, 0, 0, 5], [0, 0, 5, 4]]) for c, v in enumerate(line)], "raster_id long, row long, col long, value double")
    assert {(r.row, r.col): r.value for r in RA.decimate(m, 2, 4, 4).collect()} == {(0, 0): 1.0, (0, 1): 2.0, (1, 0): 0.0, (1, 1): 5.0}


def test_source_tiles(spark):
    b = spark.createDataFrame([(1, -73.5, -39.7, -70.8, -37.5)], "bid int, w double, s double, e double, n double")
    names = [r.tesela for r in RA.degree_tiles(b).collect()]
    assert len(names) == 12 and "Copernicus_DSM_COG_10_S39_00_W073_00_DEM" in names
    assert {(r.lat0, r.lon0) for r in RA.three_degree_tiles(b).collect()} == {(-42, -75), (-42, -72), (-39, -75), (-39, -72)}


def test_simplify_keeps_corners(spark):
    g = [[[{"x": float(x), "y": float(y)} for x, y in [(0, 0), (5, 0.1), (10, 0), (10, 10), (0, 10), (0, 0)]]]]
    row = shapes.simplify(frame(spark, [(1, g)], "id long, geom GEOM"), 0.5).select(F.size(G.vertices(F.col("geom"))).alias("n")).first()
    assert row.n == 5


def test_crowded_tile_and_copies(spark):
    """A third of the features are copies in one place, another third crowd one corner: same result as one by one."""
    rng = random.Random(3)
    rows = []
    for i in range(300):
        if i % 3 == 0:
            b = (10.0, 10.0, 30.0, 30.0)
        elif i % 3 == 1:
            x, y = rng.randint(0, 12), rng.randint(0, 12)
            b = (float(x), float(y), x + rng.randint(1, 5), y + rng.randint(1, 5))
        else:
            x, y = rng.randint(0, 90), rng.randint(0, 90)
            b = (float(x), float(y), x + rng.randint(1, 20), y + rng.randint(1, 20))
        rows.append((i, rng.choice(["SECCIONAL", "PRC", "LU", "PRI_E"]), i % 2, None, b))
    comunas = frame(spark, [("1", box(0, 0, 100, 100))], "cut string, geom GEOM")
    feats = frame(spark, [(i, f, r, c, box(*b)) for i, f, r, c, b in rows], "gid long, fuente string, rango int, cut_ipt string, geom GEOM")
    level = {"SECCIONAL": 0, "PRC": 1, "LU": 2, "PRI_E": 4}
    want = {}
    for x in range(100):
        for y in range(100):
            cover = [(level[f], r, (b[2] - b[0]) * (b[3] - b[1]), i) for i, f, r, _, b in rows if b[0] <= x and b[2] >= x + 1 and b[1] <= y and b[3] >= y + 1]
            key = min(cover)[3] if cover else None
            want[key] = want.get(key, 0) + 1.0
    stored = O.CAPACITY
    try:
        O.CAPACITY = 40
        O.overlay.__defaults__ = (False, 40, None)
        got = {r.gid: r.area_m2 for r in P.partition(comunas, feats, None, 100.0).collect()}
    finally:
        O.CAPACITY = stored
        O.overlay.__defaults__ = (False, stored, None)
    assert got == want

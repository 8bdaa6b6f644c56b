"""Functions that no query runs."""
import pytest
from pyspark.sql import functions as F

from helpers import box, frame
from zonaria.operators import overlay as V
from zonaria.operators import parcels as PA
from zonaria.operators import raster as RA
from zonaria.operators import shapes
from zonaria.operators import spatial_join as J
from zonaria.sources import sinks


def test_difference_and_outline(spark):
    left, right = frame(spark, [(1, box(0, 0, 10, 10))], "lid long, geom GEOM"), frame(spark, [(7, box(2, 2, 4, 4)), (8, box(3, 3, 5, 5))], "rid long, geom GEOM")
    assert V.difference_areas(left, right, 3.0).first().area == pytest.approx(100 - 7)
    cell = V.overlay(right.select(F.struct("rid").alias("item"), "geom"), 50.0, shapes=True).withColumn("k", F.lit(1))
    line = shapes.outline_length(shapes.boundary(cell, ["k"]), ["k"]).first()
    assert line.area == pytest.approx(7) and line.perimeter == pytest.approx(12)


def test_bow_tie_is_repaired_on_writing(spark, tmp_path):
    tie = [[[{"x": x, "y": y} for x, y in ((0.0, 0.0), (2.0, 2.0), (2.0, 0.0), (0.0, 2.0), (0.0, 0.0))]]]
    df = frame(spark, [(1, "R", tie), (2, "R", box(0, 0, 1, 1)), (3, "R", [])], "gid long, region string, geom GEOM")
    fixed = {r.gid: r.a for r in shapes.repair(df, "gid", 10.0).select("gid", shapes.G.area(F.col("geom")).alias("a")).collect()}
    assert fixed == {1: pytest.approx(2.0), 2: pytest.approx(1.0)}
    sinks.write_layer(df, str(tmp_path / "layer"), key="gid", size=10.0)
    back = spark.read.parquet(str(tmp_path / "layer"))
    assert sorted(r.gid for r in back.collect()) == [1, 2] and sinks.export_checks(back).first().piezas_invalidas == 0


def test_points_that_lie_in_some_polygon(spark):
    zones = frame(spark, [(1, box(0, 0, 4, 4)), (2, box(2, 2, 6, 6))], "gid long, geom GEOM")
    points = spark.createDataFrame([(1, 3.0, 3.0), (2, 5.0, 5.0), (3, 9.0, 9.0)], "pid long, x double, y double")
    assert sorted(r.pid for r in J.points_semi(points, zones, 2.0).collect()) == [1, 2]


def test_box_reaches_the_scan(spark, tmp_path):
    parcels = frame(spark, [(i, "09101" if i < 50 else "09102", box(i, 0, i + 0.5, 1)) for i in range(100)], "rid long, cut string, geom GEOM")
    path = str(tmp_path / "parcels")
    sinks.write_parcels(parcels, path, (0.0, 0.0, 101.0, 1.0))
    one = J.box_filter(spark.read.parquet(path).where("cut = '09101'"), 10.1, 0.0, 11.2, 0.5)
    plan = one._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):].split("\n")[0]
    assert "bbox" in pushed and "PartitionFilters: [isnotnull(cut" in plan
    assert sorted(r.rid for r in one.collect()) == [10, 11]


def test_resampled_window_and_tile_images(spark):
    plane = spark.createDataFrame([(1, r, c, 10.0 * r + c) for r in range(6) for c in range(6)], "raster_id long, row long, col long, value double")
    out = {(r.trow, r.tcol): r.value for r in RA.resample_window(plane, 1, (0.25, 5.5, 3, 3, 1.0), (0.0, 6.0, 1.0)).collect()}
    assert out[(1, 1)] == pytest.approx(10 * 1.5 + 1.25)  # unequal weights: half a pixel down, a quarter across
    pixels = spark.createDataFrame([(3, 1, 2, r, c, r, c, 0, 255) for r in (1, 0) for c in (1, 0)], "z int, x int, y int, prow int, pcol int, r int, g int, b int, a int")
    image = RA.tile_images(pixels).first()
    assert [(p.prow, p.pcol) for p in image.rgba] == [(0, 0), (0, 1), (1, 0), (1, 1)]
    width = spark.range(1).select(RA.pixel_width(F.lit(0), 0.5, 1.0).alias("w")).first().w
    assert width == pytest.approx(111320.0)


def test_neighbourhood_across_blocks(spark):
    n = 2 * RA.BLOCK + 3
    grid = spark.range(n).select(F.lit(1).cast("long").alias("raster_id"), F.col("id").alias("row"), F.explode(F.sequence(F.lit(RA.BLOCK - 2).cast("long"), F.lit(RA.BLOCK + 2).cast("long"))).alias("col")).withColumn(
        "value", F.col("row") * 2.0 + F.col("col") * F.col("col"))
    got = {(r.row, r.col): (r.gx, r.gy) for r in RA.gradients(grid).collect()}
    assert len(got) == n * 5
    value = lambda r, c: 2.0 * min(max(r, 0), n - 1) + min(max(c, RA.BLOCK - 2), RA.BLOCK + 2) ** 2
    for (r, c), (gx, gy) in got.items():
        v = [[value(r + i, c + j) for j in (-1, 0, 1)] for i in (-1, 0, 1)]
        assert gx == v[0][2] + 2 * v[1][2] + v[2][2] - v[0][0] - 2 * v[1][0] - v[2][0]
        assert gy == v[2][0] + 2 * v[2][1] + v[2][2] - v[0][0] - 2 * v[0][1] - v[0][2]


def test_exactness_before_and_after(spark):
    schema = "cut string, rol string, datos_sii boolean, exacto boolean, row_id long"
    before = spark.createDataFrame([("1", "a", True, False, 1), ("1", "b", True, True, 2)], schema)
    after = spark.createDataFrame([("1", "a", True, True, 1), ("1", "b", True, True, 2)], schema)
    r = PA.exactness_figures(before, after).first()
    assert (r.exactos_antes, r.aprox_antes, r.exactos_despues, r.aprox_despues) == (1, 1, 2, 0)

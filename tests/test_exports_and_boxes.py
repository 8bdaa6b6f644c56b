"""Boxes with margin, the list of comunas, GeoJSON in lon/lat, and what the server holds without an inventory."""
import json

import pytest
from pyspark.sql import functions as F

from tests.helpers import box, frame, ring
from zonaria.functions import crs as C
from zonaria.operators import bounds as B
from zonaria.operators import registry as R
from zonaria.sources import sinks


def test_boxes(spark):
    df = frame(spark, [("a", box(0, 0, 4, 5)), ("a", box(-3, 2, 1, 9)), ("b", box(7, 7, 8, 8)), ("c", []), ("d", None), (None, box(1, 1, 2, 2))], "k string, geom GEOM")
    got = {r.k: tuple(r)[1:] for r in B.group_boxes(df, ["k"], 2.0).collect()}
    assert got == {"a": (-5, -2, 6, 11), "b": (5, 5, 10, 10), None: (-1, -1, 4, 4)}
    metric = df.limit(0).unionByName(frame(spark, [("x", box(-71, -33, -70, -32))], "k string, geom GEOM")).select("k", C.to_albers(F.col("geom"), 6).alias("geom"))
    back = B.lonlat_boxes(B.group_boxes(metric, ["k"])).first()
    assert back.xmin < back.xmax and back.ymin == pytest.approx(-33, abs=0.02) and back.ymax == pytest.approx(-32, abs=0.02)


def test_comuna_list_is_in_order_of_folded_names(spark):
    names = ["Ñuñoa", "zapallar", "Ángol", "Arica", "Nacimiento"]
    df = frame(spark, [(str(i), n, "R", box(i, 0, i + 0.1234567, 1)) for i, n in enumerate(names)], "cut string, comuna string, region string, geom GEOM")
    got = B.comuna_list(df).collect()
    assert [r.nombre for r in got] == ["Ángol", "Arica", "Nacimiento", "Ñuñoa", "zapallar"]
    assert [r for r in got if r.cut == "1"][0].bbox == [1.0, 0.0, 1.123457, 1.0]


def test_geojson_in_lonlat_turns_rings(spark, tmp_path):
    outer, hole = ring((-71, -33), (-71, -32.9), (-70.9, -32.9), (-70.9, -33)), ring((-70.97, -32.97), (-70.95, -32.97), (-70.95, -32.95), (-70.97, -32.95))
    df = frame(spark, [("09", [[outer, hole]]), ("09", [])], "region string, geom GEOM").withColumn("geom", C.to_albers(F.col("geom"), 6))
    sinks.write_geojson_lines(df, str(tmp_path / "g"), metric=True)
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "g" / "region=09")).collect()]
    rings = next(line["geometry"]["coordinates"][0] for line in lines if line["geometry"]["coordinates"])
    assert rings[0] == [[-71, -33], [-70.9, -33], [-70.9, -32.9], [-71, -32.9], [-71, -33]]
    assert rings[1] == [[-70.97, -32.97], [-70.97, -32.95], [-70.95, -32.95], [-70.95, -32.97], [-70.97, -32.97]]


def test_server_base_without_inventory(spark):
    part = spark.createDataFrame([("1", "PRC", "a"), ("1", "PRC", "a"), ("2", "PRI", "b"), ("3", None, None)], "cut string, ipt_tipo string, ipt_nombre string")
    assert sorted(tuple(r) for r in R.server_base(None, part).collect()) == [("1", "PRC", "a"), ("2", "PRI", "b")]

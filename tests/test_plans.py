"""End-to-end plans on the scenario."""
import pytest
from pyspark.sql import functions as F

from helpers import box, frame
from zonaria.functions import geometry as G
from test_scenario import COMUNAS, FEATURES, LAYERS
from zonaria.plans.build import build
from zonaria.plans.volume import parcel_table, volume_by_terrain


def test_build(spark):
    comunas = frame(spark, COMUNAS, "cut string, comuna string, region string, geom GEOM")
    catalogue = spark.createDataFrame(LAYERS, "service string, layer_id int, layer_name string").withColumns({"service_type": F.lit("MapServer"), "url": F.lit("u")})
    raw = frame(spark, [(i, LAYERS[k][0], LAYERS[k][1], p, g) for i, (k, p, g) in enumerate(FEATURES)], "fid long, service string, layer_id int, properties map<string,string>, geom GEOM")
    b = build(raw, catalogue, comunas, 20_000.0)
    q = b.quality.collect()
    assert len(q) == 3 and all(abs(r.cobertura_pct - 100) <= 0.01 for r in q)
    assert {r.zona for r in b.review.collect()} == {"ZX"}
    assert {r.cut: r.pct_riesgo > 0 for r in q} == {"09101": True, "09102": True, "09112": False}
    pieces = b.pieces.select("id", "cut", "area_m2", G.area(F.col("geom")).alias("a"), G.is_empty(F.col("geom")).alias("none")).collect()
    assert all(not r.none and r.a == pytest.approx(r.area_m2) for r in pieces) and len({r.id for r in pieces}) == len(pieces)
    land = {r.cut: r.a for r in b.comunas.select("cut", G.area(F.col("geom")).alias("a")).collect()}
    for cut, whole in land.items():
        assert sum(r.a for r in pieces if r.cut == cut) == pytest.approx(whole, rel=1e-5)
    grown = {r.cut: r.ha_extension_costera for r in b.comunas.collect()}
    assert grown["09101"] > 0 and grown["09102"] == grown["09112"] == 0
    assert {(r.zona, r.cut) for r in b.affectations.where("zona = 'AR-3'").collect()} == {("AR-3", "09101")}
    assert {(r.cut, r.n_partes, r.lado) for r in b.coast.collect()} == {("09101", 1, "este")} or {r.cut for r in b.coast.collect()} == {"09101"}
    assert all(r.traslape_ok for r in q) and {r.comunas_tocadas != "" for r in b.unplaced.collect()} <= {True}
    s = b.summary.first()
    assert s.comunas_traslape_sobre_umbral == 0 and s.traslape_max_m2 < 1.0 and s.instrumentos_sin_comuna == b.unplaced.count()
    assert s.ipt_fuera_dpa_ha == pytest.approx(sum(r.ha_fuera for r in b.coast.collect()), abs=0.1)
    assert sum(r.features for r in b.inventory.collect()) == b.features.where("ipt_tipo IN ('PRC', 'SECCIONAL', 'LU', 'PRI', 'PRM')").count()
    assert s.comunas == 3 and s.piezas == len(pieces) and s.piezas_invalidas == 0 and s.extension_costera_ha == pytest.approx(sum(grown.values()), abs=0.1)


def test_parcels_to_volume(spark):
    rows = [(str(i), "True", f"00001-{i:05d}", "1_contains", "240", "3", box(-72.5 + i * 0.0004, -38.7, -72.4998 + i * 0.0004, -38.6999)) for i in range(3)] + [("9", "True", "00001-00009", "1_contains", "1", "1", [])]
    raw = frame(spark, rows, "n string, _ok string, rol string, _match_method string, sup_construida_total string, pisos_max string, geom GEOM").withColumns(
        {"cut": F.lit("09101"), "comuna_bcn": F.lit("Temuco"), "cod_capa": F.lit("9201"), "origen": F.lit("respaldo2")})
    parcels, lost = parcel_table(raw)
    assert [r.rol for r in lost.collect()] == ["00001-00009"]
    buildings = parcels.select(F.col("rol").alias("id"), F.lit(None).cast("double").alias("num_floors"), "geom")
    got = volume_by_terrain(parcels, buildings, 5_000.0).collect()
    assert len(got) == 3 and all(r.estado == "ok" and r.n_edificios == 1 and r.pisos_est >= 1 for r in got)
    assert all(r.huella_m2 == pytest.approx(r.sup_terreno_m2, abs=0.2) for r in got)

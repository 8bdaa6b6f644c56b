"""Occupation, calculated volume and envelope on plane coordinates."""
import math

import pytest
from pyspark.sql import functions as F

from helpers import box, frame, ring
from zonaria.functions import geometry as G
from zonaria.functions import scales as S
from zonaria.functions import text as X
from zonaria.operators import buildings as B
from zonaria.operators import occupation as O
from zonaria.operators import volume as V

T = 1000.0


@pytest.fixture(scope="module")
def occupied(spark):
    pieces = frame(spark, [(1, "PRC X", "A", "PRC", True, box(0, 0, 50, 100)), (2, "PRC X", "A", "PRC", False, box(50, 0, 100, 100)), (3, "PRC X", "B", "PRC", False, box(100, 0, 200, 100)),
                           (4, "PRC X", None, "PRC", False, box(300, 0, 400, 100)), (5, "LU Y", None, "LU", False, box(0, 200, 100, 300))],
                   "pid long, ipt_nombre string, zona string, fuente string, riesgo boolean, geom GEOM").withColumns({"comuna": F.lit("C"), "region": F.lit("R")})
    buildings = frame(spark, [("a", box(10, 10, 30, 30)), ("b", box(60, 10, 90, 30)), ("c", box(95, 50, 110, 60)), ("d", box(500, 500, 510, 510))], "id string, geom GEOM")
    return O.occupation(pieces, buildings, T).cache()


def test_occupation(occupied):
    got = {r.zona: (r.ha, r.m2_huella, round(r.coef_ocupacion, 6), r.n_edificios) for r in occupied.collect()}
    assert got == {"A": (1.0, 1050.0, 0.105, 2), "B": (1.0, 100.0, 0.01, 1), "(sin zona)": (1.0, 0.0, 0.0, 0)}
    twice = {r.zona: (r.ha, r.coef_ocupacion) for r in O.combine([occupied, occupied]).collect()}
    assert twice["A"] == (2.0, pytest.approx(0.105))
    bands = {r.zona: r.tramo for r in O.coloured(occupied).collect()}
    assert bands == {"A": "10 – 20 %", "B": "< 2 %", "(sin zona)": "sin edificios"}


def parcels(spark, rows):
    return frame(spark, [(i, r[0], float(r[1]), r[2], r[3], r[4]) for i, r in enumerate(rows)], "rid long, rol string, m2_terreno double, sup_construida_total double, pisos_max double, geom GEOM")


def buildings(spark, boxes):
    return frame(spark, [(i, None, b) for i, b in enumerate(boxes)], "id long, num_floors double, geom GEOM")


def test_whole_building_rule(spark):
    p = parcels(spark, [("A", 200, 240.0, 3.0, box(0, 0, 20, 10)), ("B", 200, 60.0, 1.0, box(30, 0, 50, 10)), ("C", 200, math.nan, math.nan, box(60, 0, 80, 10)), ("D", 100, 20.0, 1.0, box(90, 0, 100, 10))])
    b = buildings(spark, [box(2, 2, 12, 10), box(14, 2, 24, 10), box(32, 2, 42, 8), box(18.5, 2, 28.5, 8), box(90.5, 2, 99.5, 8)])
    zones = frame(spark, [(1, "ZH2", box(-5, -5, 55, 15))], "zid long, zona string, geom GEOM")
    got = {r.rol: r for r in V.calculated(p, b, T, zones, "umbral50", 2.5).collect()}
    assert (got["A"].n_edificios, got["A"].huella_m2, got["A"].pisos_est, got["A"].m2_equiv, got["A"].zona, got["A"].v_calc_m3) == (2, 160.0, 2, 320.0, "ZH2", 800.0)
    assert (got["B"].huella_m2, got["B"].pisos_est, got["B"].fuente_pisos) == (60.0, 1, "sii")
    assert got["C"].estado == "sin_dato" and got["C"].zona == ""
    assert got["D"].pisos_est == 1 and "menos de la mitad" in got["D"].avisos


def test_shared_building_rule(spark):
    p = parcels(spark, [("P", 200, 192.0, 2.0, box(0, 0, 10, 20)), ("Q", 200, 64.0, 1.0, box(10, 0, 20, 20)), ("R", 200, 50.0, 1.0, box(40, 0, 50, 20))])
    b = buildings(spark, [box(4, 2, 14, 18), box(38.5, 5, 40.5, 6)])
    got = {r.rol: r for r in V.calculated(p, b, T).collect()}
    assert (got["P"].huella_m2, got["P"].pisos_est, got["Q"].huella_m2, got["Q"].pisos_est) == (96.0, 2, 64.0, 1)
    assert "compartido" in got["P"].avisos and "compartido" in got["Q"].avisos and got["R"].estado == "sin_dato"
    whole = {r.rol: r for r in V.calculated(p, b, T, rule="umbral50").collect()}
    assert whole["P"].huella_m2 == 160.0 and whole["Q"].estado == "sin_dato"
    with pytest.raises(ValueError):
        V.calculated(p, b, T, rule="otra")


NORM = "nid long, agrupamiento string, estado string, ocupacion_max string, constructibilidad_max string, altura_max_m string, altura_max_pisos string, altura_piso_ref_m string, antejardin_m string, distanciamiento_m string"


def test_envelope(spark):
    lot = frame(spark, [(1, box(0, 0, 20, 30)), (2, box(0, 0, 5, 5))], "rid long, geom GEOM")
    rows = [(1, 1, "", "BORRADOR", "0.4", "3", "14", None, None, None, None), (1, 2, "", "B", "0.6", "1", "14", None, None, None, None), (1, 3, "", "B", "0.5", "3", "7", None, None, None, None),
            (1, 4, "", "B", "0.4", "3", "14", None, None, "5.0 frente a vía; 3.0 resto", None), (1, 5, "", "B", "0.4", "3", "14", None, None, "3", "4"), (1, 6, "", "B", "0.4", "3", None, None, None, None, None),
            (2, 7, "", "B", "0.4", "3", "14", None, None, "3", None)]
    norms = spark.createDataFrame(rows, "rid long, " + NORM)
    got = {r.nid: r for r in V.possible(lot, norms).collect()}
    assert (got[1].pisos_max, got[1].m2_max, got[1].limita) == (4, 960.0, "ocupación × altura")
    assert (got[2].m2_max, got[2].limita) == (600.0, "constructibilidad")
    assert (got[3].pisos_max, got[3].m2_max, got[3].v_max_m3) == (2, 600.0, 2100.0)
    assert (got[4].retranqueo_m, got[4].area_base_m2) == (3.0, 336.0)
    assert (got[5].retranqueo_m, got[5].area_base_m2) == (4.0, 264.0)
    assert got[6].estado == "sin_dato" and "altura_max" in got[6].motivo
    assert got[7].estado == "sin_base"


def test_setback_of_an_l_shape(spark):
    """20 × 20 without its upper right quarter, moved in by 2 m: exact with a mitred reflex corner."""
    shape = [[ring((0, 0), (20, 0), (20, 10), (10, 10), (10, 20), (0, 20))]]
    df = frame(spark, [(1, 2.0, shape), (2, 2.0, [[list(reversed(shape[0][0]))]])], "rid long, setback double, geom GEOM")
    assert {r.rid: round(r.area_base, 6) for r in V.setback_area(df).collect()} == {1: 16 * 6 + 6 * 10.0, 2: 156.0}


def test_existing_and_index(spark):
    lot = frame(spark, [(1, box(0, 0, 20, 30))], "rid long, geom GEOM")
    b = frame(spark, [("A", 3.0, None, box(2, 2, 12, 12)), ("B", None, None, box(14, 20, 24, 30)), ("C", None, None, box(17, 2, 27, 12)), ("D", None, 14.0, box(2, 15, 7, 20))],
              "id string, num_floors double, height double, geom GEOM")
    r = V.existing(lot, b, T).first()
    assert (r.n_edificios, r.huella_m2, r.m2_existente, r.fuente_pisos, r.cota_inferior) == (3, 225.0, 500.0, "mixto", True)
    states = spark.createDataFrame([(0.79,), (0.8,), (1.0,), (1.01,), (None,)], "v double").select(S.volume_state(F.col("v")).alias("s")).collect()
    assert [x.s for x in states] == ["holgura", "al_limite", "al_limite", "excede", "sin_dato"]
    assert spark.range(1).select(X.numbers_in(F.lit("5,0 m; 3.5")).alias("n")).first().n == [5.0, 3.5]


def test_footprints(spark):
    comunas = frame(spark, [("01001", "A1", "Alfa", box(-72.10, -38.10, -72.00, -38.00)), ("01002", "A2", "Alfa", box(-72.00, -38.10, -71.90, -38.00)), ("02001", "B1", "Beta", box(-71.90, -38.10, -71.80, -38.00))],
                    "cut string, comuna string, region string, geom GEOM")
    raw = frame(spark, [("b1", box(-72.05, -38.05, -72.049, -38.049)), ("b2", box(-72.0003, -38.05, -71.9993, -38.049)), ("b3", box(-71.9004, -38.05, -71.8994, -38.049)), ("b4", box(-70.0, -38.0, -69.9, -37.9)), ("b5", [])], "id string, geom GEOM")
    raw = raw.withColumns({"height": F.lit(None).cast("string"), "num_floors": F.lit("2"), "class": F.lit(None).cast("string"), "subtype": F.lit(None).cast("string"),
                           "sources": F.array(F.struct(F.lit("OpenStreetMap").alias("dataset")))})
    b = B.normalise(raw)
    assert b.count() == 4 and {r.fuente for r in b.collect()} == {"OpenStreetMap"}
    t = B.footprint_table(b, comunas, 0.05)
    assert {r.id: r.cut for r in t.collect()} == {"b1": "01001", "b2": "01002", "b3": "02001"}
    m = B.region_manifest(t, b, "Alfa").first()
    assert (m.n_edificios, m.fuera_de_la_dpa, m.de_otras_regiones, m.n_en_bbox) == (2, 1, 1, 4)
    done = spark.createDataFrame([("Alfa", "r1", True)], "region string, release string, completa boolean")
    work = lambda rel: spark.createDataFrame([("Alfa", rel)], "region string, release string")
    assert B.pending_regions(work("r1"), done).count() == 0 and B.pending_regions(work("r2"), done).count() == 1


def test_measures(spark):
    bow = [[ring((0, 0), (10, 10), (10, 0), (0, 10))]]
    df = frame(spark, [(1, bow), (2, box(0, 0, 2, 3))], "id long, geom GEOM")
    assert [r.c for r in df.orderBy("id").select(G.crosses_itself(F.col("geom")).alias("c")).collect()] == [True, False]

"""Three comunas and eight layers, from raw properties to the partition, cards and review."""
import pytest
from pyspark.sql import functions as F

from helpers import box, frame
from zonaria.functions import crs as C
from zonaria.functions import geometry as G
from zonaria.functions.numeric import half_even
from zonaria.operators import cards as K
from zonaria.operators import features as FE
from zonaria.operators import partition as P
from zonaria.operators import shapes
from zonaria.operators import spatial_join as J

TILE = 20_000.0
COMUNAS = [("09101", "Temuco", "Región de La Araucanía", box(-72.7, -38.8, -72.5, -38.6)),
           ("09112", "Padre Las Casas", "Región de La Araucanía", box(-72.5, -38.8, -72.3, -38.6)),
           ("09102", "Carahue", "Región de La Araucanía", box(-72.9, -38.8, -72.7, -38.6))]
LAYERS = [("IPT/PRC_Araucania", 0, "PRC_Temuco"), ("IPT/Limites_Urbanos", 0, "Limites_Urbanos_PRC"), ("IPT/PRC_Araucania", 1, "Seccional_Temuco_Labranza"),
          ("IPT/PRC_Araucania", 2, "Limite_Urbano"), ("IPT/PRI_Araucania", 0, "PRI_Temuco_PLC"), ("IPT/PRI_Area_Rural", 0, "Límite área rural PRI"),
          ("IPT/PRC_Araucania", 3, "PRC_Temuco_Riesgo"), ("IPT/PRC_Araucania", 4, "PRC_Temuco_Areas_de_proteccion_y_riesgo")]


def zone(z, d):
    return {"ZONA": z, "DESCRIPCION": d}


FEATURES = [
    (0, zone("ZU-1", "Zona urbana central"), box(-72.65, -38.75, -72.58, -38.68)), (0, zone("ZU-2", "Zona mixta"), box(-72.60, -38.72, -72.48, -38.66)),
    (0, zone("ZU-3", "Zona contenida"), box(-72.64, -38.74, -72.62, -38.72)), (0, zone("AR-2", "Área de riesgo por remoción en masa"), box(-72.59, -38.71, -72.585, -38.705)),
    (0, zone("ZU-4", "Borde costero"), box(-72.60, -38.62, -72.55, -38.58)),
    (1, {"COM": "Padre de Las Casas", "ADMIN": "Municipalidad de Padre Las Casas", "NOM": "Límite urbano de Padre Las Casas"}, box(-72.49, -38.76, -72.42, -38.70)),
    (2, {"ZONA": "ZS-A"}, box(-72.69, -38.70, -72.63, -38.65)), (3, {"COMUNA": "Padre Las Casas"}, box(-72.49, -38.76, -72.42, -38.70)),
    (4, zone("ZEU-1", "Zona de extensión urbana"), box(-72.70, -38.80, -72.60, -38.76)), (4, zone("ZR-2", "Zona rural silvoagropecuaria"), box(-72.9, -38.8, -72.8, -38.7)),
    (4, zone("ZR-3", "Zona rural de protección"), box(-72.85, -38.75, -72.75, -38.65)), (4, zone("ZX", "Zona especial"), box(-72.45, -38.66, -72.35, -38.62)),
    (4, zone("Riesgo aluvión", None), box(-72.88, -38.79, -72.86, -38.77)), (5, {"NOMBRE": "UNIDAD TERRITORIAL C"}, box(-72.9, -38.8, -72.72, -38.62)),
    (6, zone("AR-1", "Riesgo inundación"), box(-72.62, -38.74, -72.60, -38.72)), (6, zone("AR-3", "Riesgo inundación"), box(-72.52, -38.78, -72.47, -38.765)),
    (7, {"ZONA": "APP 1"}, box(-72.57, -38.70, -72.55, -38.68)), (7, {"ZONA": "ARRI"}, box(-72.57, -38.72, -72.55, -38.705)),
]


@pytest.fixture(scope="module")
def scenario(spark):
    comunas = frame(spark, COMUNAS, "cut string, comuna string, region string, geom GEOM")
    catalogue = FE.type_layers(spark.createDataFrame(LAYERS, "service string, layer_id int, layer_name string").withColumns(
        {"service_type": F.lit("MapServer"), "url": F.lit("u")}))
    rows = [(i, LAYERS[k][0], LAYERS[k][1], props, g) for i, (k, props, g) in enumerate(FEATURES)]
    raw = frame(spark, rows, "fid long, service string, layer_id int, properties map<string,string>, geom GEOM")
    homologated = FE.homologate(raw, catalogue, comunas).withColumnRenamed("ipt_tipo", "tipo").withColumn("gid", F.col("fid"))
    part, aff = FE.split_affectations(homologated)
    metric = lambda df: df.withColumn("geom", C.to_albers(F.col("geom")))
    return {"comunas": metric(comunas), "part": metric(part).cache(), "aff": metric(aff).cache(), "catalogue": catalogue, "all": homologated}


@pytest.fixture(scope="module")
def pieces(scenario):
    clipped = P.clip_affectations(scenario["aff"].where("riesgo"), scenario["comunas"], TILE)
    risks = scenario["aff"].where("riesgo").join(clipped.select("gid").distinct(), "gid", "left_semi")
    return P.partition(scenario["comunas"], scenario["part"], risks.select("gid", "cut_ipt", "geom"), TILE).cache()


def test_typing_and_sources(scenario):
    kinds = [r.tipo for r in scenario["catalogue"].collect()]
    assert kinds == ["PRC", "LU", "SECCIONAL", "LU", "PRI", "PRI", "AFECTACION", "AFECTACION"]
    rows = scenario["all"].collect()
    assert {r.fuente for r in rows if r.fuente != "AFECTACION"} == {"PRC", "SECCIONAL", "LU", "PRI_E", "PRI_R", "PRI_ENV"}
    assert {r.zona for r in rows if r.revisar} == {"ZX"}
    assert {r.zona for r in rows if r.riesgo} == {"AR-1", "AR-2", "AR-3", "Riesgo aluvión", "ARRI"}
    assert {r.cut_ipt for r in rows if r.tipo == "LU"} == {"09112"}
    assert {r.ipt_nombre for r in rows if r.tipo == "LU"} == {"Límite Urbano Padre Las Casas"}


def test_local_affectation_only_in_its_comuna(scenario):
    ar3 = scenario["aff"].where("zona = 'AR-3'")
    assert [r.cut for r in P.clip_affectations(ar3, scenario["comunas"], TILE).collect()] == ["09101"]


def own_ground(scenario):
    """Area of AR-3 in its own comuna."""
    return P.clip_affectations(scenario["aff"].where("zona = 'AR-3'"), scenario["comunas"], TILE).first().area


def test_partition_areas(scenario, pieces):
    names = scenario["part"].select("gid", "zona")
    rows = pieces.join(names, "gid", "left").collect()
    got = {}
    for r in rows:
        key = (r.cut, r.clase if r.gid is None else (r.zona or r.fuente), r.riesgo)
        got[key] = got.get(key, 0) + r.area_m2
    expected = {
        ("09101", "R2", False): 215382761.3, ("09101", "ZEU-1", False): 38585143.5, ("09101", "ZS-A", False): 28980722.0, ("09101", "ZU-1", False): 35482149.1,
        ("09101", "ZU-1", True): 4102572.2, ("09101", "ZU-2", False): 47327132.8, ("09101", "ZU-2", True): 2896577.9, ("09101", "ZU-3", False): 3861173.4,
        ("09101", "ZU-4", False): 9658330.7, ("09112", "LU", False): 40542325.2, ("09112", "ZX", False): 38659536.8, ("09112", "R2", False): 307074701.7,
        ("09102", "UNIDAD TERRITORIAL C", False): 143903076.5, ("09102", "ZR-2", False): 92644236.1, ("09102", "ZR-2", True): 3858515.5,
        ("09102", "ZR-3", False): 72435196.1, ("09102", "R2", False): 73435539.3,
    }
    # the expected areas are without AR-3, which moves ground of its comuna from no risk to risk
    def by_zone(table):
        return {(cut, zone): sum(a for (c, z, _), a in table.items() if (c, z) == (cut, zone)) for cut, zone, _ in table}

    assert set(by_zone(got)) == set(by_zone(expected))
    for key, area in by_zone(expected).items():
        assert by_zone(got)[key] == pytest.approx(area, rel=1e-5), key
    for key, area in expected.items():
        if key[0] != "09101":
            assert got[key] == pytest.approx(area, rel=1e-5), key
    risk = sum(a for (cut, _, r), a in got.items() if r and cut == "09101")
    assert risk == pytest.approx(4102572.2 + 2896577.9 + own_ground(scenario), rel=1e-5)
    assert not any(r for cut, _, r in got if cut == "09112")
    assert got[("09102", "ZR-2", False)] + got[("09102", "ZR-2", True)] == pytest.approx(96502624.8, rel=1e-5)


def test_quality(scenario, pieces):
    q = {r.cut: r for r in P.comuna_quality(pieces, scenario["comunas"]).collect()}
    assert all(abs(r.cobertura_pct - 100) <= 0.01 for r in q.values())
    assert q["09102"].sin_urbano and not q["09101"].sin_urbano
    assert q["09112"].pct_U1 == 0 and q["09112"].pct_U2 > 0
    assert q["09112"].pct_riesgo == 0  # a local risk of the neighbour that reaches over the border
    for cut, risk in (("09101", 4102572.2 + 2896577.9 + own_ground(scenario)), ("09102", 3858515.5)):
        assert q[cut].pct_riesgo == pytest.approx(100 * risk / q[cut].area_comuna_m2, abs=2e-3)


def test_coastal_extension(scenario):
    ext = P.coastal_extension(scenario["part"], scenario["comunas"], TILE).collect()
    assert [r.cut for r in ext] == ["09101"]


def test_cards(spark, scenario):
    risks = scenario["aff"].where("riesgo").select("gid", "cut_ipt", "geom")
    cells = P.partition_shapes(scenario["comunas"], scenario["part"], risks, TILE)
    names = scenario["part"].select("gid", F.col("tipo").alias("ipt_tipo"), "ipt_nombre", "zona")
    layer = cells.withColumns({"pid": F.monotonically_increasing_id(), "geom": P.trapezoid()}).join(names, "gid", "left").withColumns(
        {"comuna": F.col("cut"), "region": F.lit("R")}).cache()
    places = spark.createDataFrame([(1, -72.52, -38.69), (2, -72.5875, -38.7075), (3, -72.8, -38.5)], "qid long, lon double, lat double")
    points = places.select("qid", C.albers_xy(F.col("lon"), F.col("lat")).alias("p")).select("qid", "p.x", "p.y")
    polygon = frame(spark, [(4, box(-72.53, -38.75, -72.51, -38.70))], "qid long, geom GEOM").withColumn("geom", C.to_albers(F.col("geom")))
    share = K.shares(points, polygon, layer, TILE)
    rows = K.card_rows(share, layer).collect()
    by = lambda q: [r for r in rows if r.qid == q]
    assert [(r.clase, r.zona, r.pct) for r in by(1)] == [("U1", "ZU-2", 100.0)]
    assert by(2)[0].riesgo_pct == 100.0
    assert {r.clase for r in by(4)} == {"U1", "R2"} and sum(r.pct for r in by(4)) == pytest.approx(100, abs=0.01)
    heads = {r.qid: r for r in K.card_heads(spark.createDataFrame([(1, True), (2, True), (3, True), (4, False)], "qid long, es_punto boolean"), share, layer).collect()}
    assert heads[3].cobertura == "fuera_dpa" and heads[4].cobertura == "completa" and heads[1].cut == "09101"


def test_dissolved_comunas(scenario):
    risks = scenario["aff"].where("riesgo").select("gid", "geom")
    cells = P.partition_shapes(scenario["comunas"], scenario["part"], risks, TILE)
    whole = {r.cut: r.a for r in scenario["comunas"].select("cut", G.area(F.col("geom")).alias("a")).collect()}
    for r in shapes.dissolve(cells, ["cut"]).select("cut", half_even(G.area(F.col("geom")), 0).alias("a"), F.size("geom").alias("n")).collect():
        assert r.a == pytest.approx(whole[r.cut], rel=1e-6)
    classes = shapes.dissolve(cells, ["cut", "clase"]).select("cut", "clase", G.area(F.col("geom")).alias("a")).collect()
    sums = {(r.cut, r.clase): r.s for r in cells.groupBy("cut", "clase").agg(F.sum("area").alias("s")).collect()}
    assert all(r.a == pytest.approx(sums[(r.cut, r.clase)], rel=1e-6) for r in classes)


def test_tiny_pieces_leave_their_ground(spark):
    """A first-level piece below the minimum area is dropped and the next level takes its ground."""
    comunas = frame(spark, [("1", box(0, 0, 10, 10))], "cut string, geom GEOM")
    rows = [(1, "SECCIONAL", 0, None, box(0, 0, 0.5, 0.5)), (2, "PRC", 0, None, box(0, 0, 1.1, 0.95)), (3, "LU", 0, None, box(0, 0, 5, 5)), (4, "PRC", 1, None, box(0.5, 0, 1.0, 0.9))]
    features = frame(spark, rows, "gid long, fuente string, rango int, cut_ipt string, geom GEOM")
    got = {r.gid: round(r.area_m2, 6) for r in P.partition(comunas, features, None, 100.0).collect()}
    assert got == {2: 1.045, 3: 25 - 1.045, None: 75.0}


def test_boundary_points(spark):
    zones = frame(spark, [(1, box(0, 0, 10, 10))], "gid long, geom GEOM")
    points = spark.createDataFrame([(1, 10.0, 5.0), (2, 5.0, 5.0), (3, 0.0, 0.0), (4, 11.0, 5.0)], "pid long, x double, y double")
    assert {r.pid for r in J.points_in_polygons(points, zones, 4.0).collect()} == {2}
    assert {r.pid for r in J.points_in_polygons(points, zones, 4.0, "intersects").collect()} == {1, 2, 3}
    assert {r.pid for r in J.points_in_polygons(points, zones, 4.0, hot_rows=1).collect()} == {2}


def test_projection_round_trip_and_reference_area(spark):
    df = frame(spark, [(1, box(-72.9, -38.8, -72.8, -38.7))], "id long, geom GEOM")
    row = df.select(G.area(C.to_albers(F.col("geom"))).alias("a"), C.to_lonlat(C.to_albers(F.col("geom"))).alias("b")).first()
    assert row.a == pytest.approx(96502749.3, rel=1e-6)
    assert row.b[0][0][0].x == pytest.approx(-72.9, abs=1e-7)

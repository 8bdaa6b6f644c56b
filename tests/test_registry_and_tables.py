"""Registry families, presence and match; demand, contracts, review, parcels."""
import datetime

import pytest
from pyspark.sql import functions as F

from helpers import box, frame
from zonaria.functions import scales as S
from zonaria.functions import text as X
from zonaria.operators import contracts as CT
from zonaria.operators import demand as D
from zonaria.operators import parcels as P
from zonaria.operators import registry as R
from zonaria.operators import review as RV
from zonaria.sources.layers import INSTRUMENT

ORIGIN = "Instrumento de origen"


def doc(name, kind="Decreto", url=None):
    return [(kind, name, url)]


@pytest.fixture(scope="module")
def families(spark):
    rows = [(1, "PRC", "Comunal", "Plan Regulador Temuco-Labranza", ["09101"], ORIGIN, "149", "2010-02-02", doc("Resolución N° 149"), "3, 4"),
            (2, "PRC", "Comunal", "Plan Regulador Cajón", ["09101"], ORIGIN, "540", "1966-10-18", doc("Decreto N° 540"), None),
            (3, "PRC", "Comunal", "Modificación Temuco", ["09101"], "Modificación", "1", "2011-06-26", doc("Ordenanza", "Ordenanza", "http://o"), "1"),
            (5, "LU", "Comunal", "Límite Urbano Lumaco", ["09207"], ORIGIN, None, "1980-01-01", [], None), (6, "PRDU", "Regional", "PRDU", ["09101"], ORIGIN, None, None, [], None)]
    return R.families(spark.createDataFrame(rows, INSTRUMENT)).cache()


def test_families(families):
    got = {r.id: r for r in families.collect()}
    assert set(got) == {1, 2, 5}
    assert (got[1].norma, got[1].ultima_modificacion, got[1].n_modificaciones, got[1].ordenanza_url) == ("Resolución N° 149", "2011-06-26", 1, "http://o")
    assert got[2].norma == "Decreto N° 540" and got[2].n_modificaciones == 0


@pytest.fixture(scope="module")
def server(spark):
    return spark.createDataFrame([("09101", "PRC", "Temuco"), ("09101", "PRC", "Temuco Cajon"), ("09101", "LU", "Límite Urbano Temuco"), ("09112", "LU", "Límite Urbano Padre Las Casas")], "cut string, ipt_tipo string, ipt_nombre string")


def test_match_and_presence(spark, families, server):
    got = {(r.ipt_tipo, r.ipt_nombre): r.portal_id for r in R.match(server, families).collect()}
    assert got[("PRC", "Temuco")] == 1 and got[("PRC", "Temuco Cajon")] == 2 and ("LU", "Límite Urbano Padre Las Casas") not in got
    comunas = spark.createDataFrame([("09101", "Temuco", "R"), ("09112", "Padre Las Casas", "R"), ("09207", "Lumaco", "R")], "cut string, comuna string, region string")
    t = R.presence(families, server, comunas)
    state = {(r.comuna, r.tipo): (r.estado, r.nota) for r in t.collect()}
    assert state == {("Temuco", "PRC"): ("ambos", ""), ("Temuco", "LU"): ("ambos", "LU definido por el PRC vigente"), ("Lumaco", "LU"): ("solo_portal", ""), ("Padre Las Casas", "LU"): ("solo_servidor", "")}
    assert {(r.lista, r.comuna_tipo) for r in R.gap_lists(t).collect()} == {("sin_geometria", "Lumaco (LU)"), ("solo_servidor", "Padre Las Casas (LU)")}


def test_scalar_texts(spark):
    rows = spark.createDataFrame([("1733-22",), (" 1733 / 22 ",), ("1733 22",), ("abc",), ("1733",), ("123456-1",)], "t string").select(X.role_key(F.col("t")).alias("r")).collect()
    assert [r.r for r in rows] == ["01733-00022"] * 3 + [None] * 3
    rows = spark.createDataFrame([("SEGUNDO SEMESTRE DE 2025",), ("327",), ("PRIMER SEMESTRE DE 1999",)], "t string").select(X.semester(F.col("t")).alias("r")).collect()
    assert [r.r for r in rows] == ["2025-2", None, None]
    rows = spark.createDataFrame([("Ñuñoa_Área-1  º½ﬁ",), (None,)], "t string").select(X.norm_text(F.col("t")).alias("r")).collect()
    assert [r.r for r in rows] == ["NUNOA AREA 1 O12FI", ""]


def test_data_dates(spark):
    day = lambda d: F.lit(datetime.date.fromisoformat(d))
    cases = [("2026-1", "2026-1", "2026-10-07", True), ("2026-1", "2026-1", "2026-03-01", True), ("2024-2", "2026-1", "2026-10-07", True), (None, "2026-1", "2026-10-07", False), (None, "2026-1", "2026-10-07", True)]
    got = [spark.range(1).select(S.data_date(F.lit(p).cast("string"), F.lit(c), day(t), F.lit(h)).alias("s")).first().s for p, c, t, h in cases]
    assert [(g.estado, g.atraso_semestres, g.periodo_inferido) for g in got] == [("atrasado", 1, False), ("al_dia", 0, False), ("atrasado", 4, False), ("sin_dato", 1, False), ("atrasado", 1, True)]


CONTRACT = ("id string, nombre string, institucion string, estado string, acceso struct<tipo:string,url:string>, licencia string, diccionario array<string>, mapeo array<struct<origen:string,destino:string>>, "
            "excluir_siempre array<string>, condicionante struct<nivel:string,efecto:string>, umbral int, clases array<string>")


def contract(**change):
    base = {"id": "clima", "nombre": "n", "institucion": "i", "estado": "latente", "acceso": ("api", "u"), "licencia": "CC", "diccionario": ["d"], "mapeo": [("alt", "altura")], "excluir_siempre": ["RUT", "NOMBRE"],
            "condicionante": ("a", "BORRADOR: x"), "umbral": 3, "clases": ["R1"]}
    return tuple({**base, **change}.values())


def test_contract_rules(spark):
    rows = [contract(), contract(mapeo=[("rut", "r")]), contract(acceso=(None, None)), contract(condicionante=("a", "x")), contract(estado="aprobada"), contract(excluir_siempre=["RUT"])]
    got = [r.errores for r in CT.source_errors(spark.createDataFrame(rows, CONTRACT)).collect()]
    assert got[0] == [] and all(len(e) == 1 for e in got[1:])
    assert "personales" in got[1][0] and "latente" in got[2][0]
    with pytest.raises(ValueError):
        CT.guard_columns(spark.range(1), ["rut"], ["RUT", "NOMBRE"])


def test_demand_has_no_coordinates(spark):
    cards = spark.createDataFrame([(1, "2026-10-07", "R", "09101", "Temuco", "R1", "completa", -72.5)], "qid long, fecha string, region string, cut string, comuna string, clase string, cobertura string, lon double")
    lines = D.log_lines(cards, spark.createDataFrame([(1, "clima")], "qid long, id string"))
    assert tuple(lines.columns) == D.LOG_COLUMNS and lines.first().fuentes_relevantes_no_activas == ["clima"]


def test_review_round_trip(spark):
    pieces = spark.createDataFrame([("Plan", "Zx", "d", "R", "C", 20000.0, "PRI_R", True), ("Plan", "ZX", "d", "R", "D", 10000.0, "PRI_E", True), ("Plan", "ZY", None, "R", "C", 5.0, "PRI_R", False)],
                                   "ipt_nombre string, zona string, zona_desc string, region string, comuna string, area_m2 double, fuente string, revisar boolean")
    previous = spark.createDataFrame([("plan", "zx", "u")], "ipt_nombre string, zona string, decision string")
    rows = RV.review_table(pieces, previous).collect()
    assert [(r.zona, r.ha, r.decision) for r in rows] == [("Zx", 2.0, "u"), ("ZX", 1.0, "u")]
    good, bad = RV.read_decisions(spark.createDataFrame([("Plan", "Zx", " u"), ("Plan", "Q", "mal")], "ipt_nombre string, zona string, decision string"))
    assert bad.count() == 1
    current, _ = RV.read_decisions(spark.createDataFrame([("PLAN", "ZX", "E"), ("Otro", "A", "R")], "ipt_nombre string, zona string, decision string"))
    assert {(r.clave, r.decision) for r in RV.merge_overrides(current, good).collect()} == {("Otro|A", "R"), ("Plan|Zx", "U")}


def test_units_and_archive(spark):
    cols = "row_id long, cut string, rol string, id_poligono string, datos_sii boolean, exacto boolean, metodo string, origen string"
    rows = [(1, "1", "a", "p", True, True, "contiene", "n"), (2, "1", "b", "p", True, True, "contiene", "n"), (3, "1", "b", "p", True, True, "contiene", "n"), (4, "1", "c", "p", True, False, "cercano", "n"), (5, "1", None, "q", False, False, "huerfano", "n")]
    g = {r.row_id: (r.n_unidades, r.n_asignados) for r in P.group_units(spark.createDataFrame(rows, cols)).collect()}
    assert g == {1: (2, 3), 2: (2, 3), 4: (2, 3), 5: (0, 0)}
    new, old = spark.createDataFrame(rows[:1], cols), spark.createDataFrame([(9, "1", "a", "z", True, True, "contiene", None), (10, "1", "k", "z", True, True, "contiene", None), (11, "1", "m", "z", True, True, "contiene", None), (12, "2", "a", "z", True, True, "contiene", None)], cols)
    known = spark.createDataFrame([("1", "k")], "cut string, rol string")
    got = {r.row_id: (r.exacto, r.metodo, r.procedencia) for r in P.complete_with_archive(new, old, known).collect()}
    assert got == {1: (True, "contiene", "nuevo"), 10: (False, P.FILLED, "archivo"), 11: (True, "contiene", "archivo"), 12: (True, "contiene", "solo_archivo")}
    again = P.complete_with_archive(P.complete_with_archive(new, old, known).drop("procedencia"), old, known)
    assert again.where("procedencia = 'archivo'").count() == 0


def test_reassign_is_stable(spark):
    cols = "row_id long, cut string, rol string, id_poligono string, datos_sii boolean, exacto boolean, metodo string, origen string, area_poligono_m2 double, x double, y double, geom GEOM"
    a, b = box(0, 0, 20, 20), box(100, 0, 120, 20)
    rows = [(1, "1", "in", "B", True, False, "cercano", "n", 400.0, 5.0, 5.0, b), (2, "1", "near", "A", True, True, "contiene", "n", 400.0, 150.0, 10.0, a), (3, "1", "far", "A", True, True, "contiene", "n", 400.0, 400.0, 10.0, a),
            (4, "1", "blank", "A", True, True, "contiene", "n", 400.0, None, None, a), (5, "1", None, "B", False, False, "huerfano", "n", 400.0, None, None, b)]
    df = frame(spark, rows, cols)
    d = P.reassign(df, 64.0)
    assert {r.rol: (r.tipo, r.id_nuevo) for r in d.collect()} == {"in": ("dentro", "A"), "near": ("cercano", "B"), "far": ("ninguno", None), "blank": ("sin_punto", "A")}
    table, lost = P.apply_reassignment(df, d)
    assert [r.rol for r in lost.collect()] == ["far"]
    again = {r.rol: r.tipo for r in P.reassign(table, 64.0).collect()}
    assert again == {"in": "dentro", "near": "cercano", "blank": "sin_punto"}

"""Contract documents against the schema rules: one fault at a time."""
import copy
import json


from zonaria.operators import schema_rules as S
from zonaria.sources.layers import read_contracts

GOOD = {
    "id": "humedales", "nombre": "Humedales", "institucion": "MMA", "estado": "activa", "acceso": {"tipo": "arcgis", "url": "u", "frecuencia_refresco": None},
    "licencia": "CC", "diccionario": [{"campo": "NOM", "dominio": [1, 2]}], "mapeo": [{"origen": "NOM", "destino": "escala"}], "excluir_siempre": ["RUT", "nombre"],
    "condicionante": {"nivel": "alerta", "efecto": "BORRADOR: x"},
    "demanda": {"preguntas_que_responde": ["q"], "umbral_activacion": 2, "relevante_si": {"clases": ["R1"], "regiones_cut": ["09"]}},
}
THEME = {"id": "relieve", "nombre": "Relieve", "categoria": "relieve", "estado": "activa", "tipo": "raster", "zoom": [3, 9],
         "fuente": {"nombre": "DEM", "licencia": "CC", "licencia_verificada": True, "atribucion": "abc", "acceso": {"tamano_mb": 2.5}},
         "estilo": {"rampa": [[0, "#000000"], [1, "#ffffff"]], "paint": {"a": {"b": {"c": {"d": {"e": {"f": 1}}}}}}}}


def broken(base, path, value=None, drop=False):
    doc = copy.deepcopy(base)
    at = doc
    for k in path[:-1]:
        at = at[k]
    if drop:
        del at[path[-1]]
    else:
        at[path[-1]] = value
    return doc


SOURCE_CASES = {
    "id": (broken(GOOD, ["id"], "1x"), ["/id: no calza con el patrón"]),
    "kind": (broken(GOOD, ["nombre"], 5), ["/nombre: tipo integer, se esperaba string"]),
    "state": (broken(GOOD, ["estado"], "aprobada"), ["/estado: no está en la lista"]),
    "absent": (broken(GOOD, ["acceso", "url"], drop=True), ["/acceso/url: falta"]),
    "null": (broken(GOOD, ["acceso", "tipo"], None), ["estado >= latente exige acceso.tipo y acceso.url (o tipo manual)"]),
    "item": (broken(GOOD, ["mapeo"], [GOOD["mapeo"][0], {"origen": "A", "destino": "b"}, {"origen": "A"}]), ["/mapeo[1]/destino: no está en la lista", "/mapeo[2]/destino: falta"]),
    "least": (broken(GOOD, ["demanda", "umbral_activacion"], 0), ["/demanda/umbral_activacion: < 1"]),
    "whole": (broken(GOOD, ["demanda", "umbral_activacion"], 1.5), ["/demanda/umbral_activacion: tipo number, se esperaba integer"]),
    "few": (broken(GOOD, ["excluir_siempre"], []), ["/excluir_siempre: se esperaban al menos 1 elementos"]),
    "region": (broken(GOOD, ["demanda", "relevante_si", "regiones_cut"], ["9", None]),
               ["/demanda/relevante_si/regiones_cut[0]: no calza con el patrón", "/demanda/relevante_si/regiones_cut[1]: tipo null, se esperaba string"]),
    "list": (broken(GOOD, ["acceso"], []), ["/acceso: tipo array, se esperaba object"]),
    "personal": (broken(GOOD, ["mapeo"], [{"origen": "rut", "destino": "escala"}]), ["mapeo toma datos personales: RUT"]),
}
THEME_CASES = {
    "good": (THEME, []),
    "closed": ({**THEME, "otro": 1}, ["/otro: no se esperaba"]),
    "inner": (broken(THEME, ["fuente", "acceso"], {"quien": 1}), ["/fuente/acceso/quien: no se esperaba"]),
    "zoom": (broken(THEME, ["zoom"], [3, 25, 4]), ["/zoom: se esperaban a lo más 2 elementos", "/zoom[1]: > 22"]),
    "short": (broken(THEME, ["nombre"], "ab"), ["/nombre: se esperaban al menos 3 caracteres"]),
    "ramp": (broken(THEME, ["estilo", "rampa"], [[0, "#000000"], [1]]), ["/estilo/rampa[1]: se esperaban al menos 2 elementos"]),
}


def test_source_documents(spark):
    rows = [(f"x/humedales.{k}" if k != "id" else "1x.json", json.dumps(d, ensure_ascii=False)) for k, (d, _) in SOURCE_CASES.items()]
    rows += [("humedales.json", json.dumps(GOOD)), ("otro.json", json.dumps(GOOD)), ("a.txt", "{no"), ("b.txt", None), ("c.txt", "[1]"), ("d.txt", "")]
    got = {r.archivo: r.errores for r in S.load_sources(spark.createDataFrame(rows, "archivo string, doc string")).collect()}
    for k, (_, want) in SOURCE_CASES.items():
        assert got[f"x/humedales.{k}" if k != "id" else "1x.json"] == want, k
    assert got["humedales.json"] == [] and got["otro.json"] == ["id distinto del nombre de archivo"]
    assert got["a.txt"] == got["b.txt"] == got["d.txt"] == ["/: tipo ilegible, se esperaba object"] and got["c.txt"] == ["/: tipo array, se esperaba object"]


def test_theme_documents(spark):
    rows = [(k, json.dumps(d)) for k, (d, _) in THEME_CASES.items()]
    got = {}
    for r in S.schema_errors(spark.createDataFrame(rows, "archivo string, doc string"), S.THEME_RULES, S.THEME_KEYS).collect():
        got.setdefault(r.archivo, []).append(r.error)
    assert {k: sorted(got.get(k, [])) for k in THEME_CASES} == {k: w for k, (_, w) in THEME_CASES.items()}


def test_contract_files(spark, tmp_path):
    (tmp_path / "humedales.json").write_text(json.dumps(GOOD, indent=1), encoding="utf-8")
    (tmp_path / "malo.json").write_text("{}", encoding="utf-8")
    loaded = S.load_sources(read_contracts(spark, str(tmp_path / "*.json")))
    assert [r.id for r in S.contracts_in_force(loaded).collect()] == ["humedales"]
    assert len(loaded.where("archivo like '%malo.json'").first().errores) == 11

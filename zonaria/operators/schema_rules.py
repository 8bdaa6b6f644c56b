"""Contract documents held against a table of schema rules.

A document is taken apart into its nodes (path, kind, value), level by level in one pass, and the nodes are stored once; rules are rows that meet the nodes by path.
Lists write ``[]`` in the path of a rule and their position in the path of an error. The tables of rules are literals, so
they are broadcast; documents only shuffle to gather their own errors.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import truncate_lineage
from .contracts import STATES, THEME_STATES, source_errors

DEPTH = 6       # deepest path of a rule
RULE = ("patron string, tipos array<string>, lista array<string>, forma string, minimo double, maximo double, "
        "largo_min int, elementos_min int, elementos_max int, cerrado boolean")
ID_PATTERN, CLASSES = "^[a-z][a-z0-9_]+$", ("U1", "U2", "U3", "E", "R1", "R2")


def rule(path: str, types: str = "", values: tuple | None = None, pattern: str | None = None, least: float | None = None, most: float | None = None,
         letters: int | None = None, items: int | None = None, items_most: int | None = None, closed: bool = False) -> tuple:
    """One rule: permitted kinds (none: any), listed values, pattern, bounds, least letters, number of elements, no other keys."""
    return (path, types.split(), None if values is None else list(values), pattern, None if least is None else float(least),
            None if most is None else float(most), letters, items, items_most, closed)


# Fields of the contract of a source.
SOURCE_RULES = (
    rule("", "object"), rule("/id", "string", pattern=ID_PATTERN), rule("/nombre", "string"), rule("/institucion", "string"), rule("/estado", values=STATES),
    rule("/responsable_contacto", "string null"), rule("/obtenido_via", values=("funcionario", "usuario", "transparencia", "publicación", None)),
    rule("/solicitud_transparencia", "string null"), rule("/acceso", "object"), rule("/acceso/tipo", values=("arcgis", "wfs", "archivo", "api", "manual", None)),
    rule("/acceso/url", "string null"), rule("/acceso/url_referencia", "string null"), rule("/acceso/capa", "string null"),
    rule("/acceso/frecuencia_refresco", "string null"), rule("/licencia", "string null"), rule("/escala", "string null"), rule("/fecha_datos", "string null"),
    rule("/diccionario", "array"), rule("/diccionario[]", "object"), rule("/diccionario[]/campo", "string"), rule("/diccionario[]/tipo", "string null"),
    rule("/diccionario[]/descripcion", "string null"), rule("/mapeo", "array"), rule("/mapeo[]", "object"), rule("/mapeo[]/origen", "string"),
    rule("/mapeo[]/destino", values=("condicionante_nombre", "condicionante_detalle", "condicionante_estado", "fecha_fuente", "escala", "id_fuente")),
    rule("/mapeo[]/transformacion", "string null"), rule("/excluir_siempre", "array", items=1), rule("/excluir_siempre[]", "string"),
    rule("/condicionante", "object"), rule("/condicionante/nivel", values=("restriccion", "alerta", "informativo")),
    rule("/condicionante/nivel_por_clase", "object"), rule("/condicionante/efecto", "string", pattern="^BORRADOR"), rule("/demanda", "object"),
    rule("/demanda/preguntas_que_responde", "array", items=1), rule("/demanda/preguntas_que_responde[]", "string"),
    rule("/demanda/umbral_activacion", "integer", least=1), rule("/demanda/relevante_si", "object"), rule("/demanda/relevante_si/clases", "array", items=1),
    rule("/demanda/relevante_si/clases[]", values=CLASSES), rule("/demanda/relevante_si/regiones_cut", "array null"),
    rule("/demanda/relevante_si/regiones_cut[]", "string", pattern="^[0-9]{2}$"), rule("/notas", "string null"), rule("/notas_eticas", "string null"),
)
SOURCE_KEYS = {
    "": "id nombre institucion estado acceso licencia diccionario mapeo excluir_siempre condicionante demanda", "/acceso": "tipo url frecuencia_refresco",
    "/diccionario[]": "campo", "/mapeo[]": "origen destino", "/condicionante": "nivel efecto",
    "/demanda": "preguntas_que_responde umbral_activacion relevante_si", "/demanda/relevante_si": "clases",
}
# Fields of the contract of a theme.
THEME_RULES = (
    rule("", "object", closed=True), rule("/id", "string", pattern="^[a-z][a-z0-9_]{2,60}$"), rule("/nombre", "string", letters=3),
    rule("/categoria", values=("ubicacion", "relieve", "suelo", "clima", "cobertura", "agua", "riesgo", "infraestructura", "socioeconomico")),
    rule("/estado", values=THEME_STATES), rule("/tipo", values=("raster", "vector")), rule("/fuente", "object", closed=True),
    rule("/fuente/nombre", "string", letters=3), rule("/fuente/url", "string", pattern="^https?://"), rule("/fuente/version", "string"),
    rule("/fuente/fecha_dato", "string"), rule("/fuente/resolucion", "string"), rule("/fuente/licencia", "string", letters=2),
    rule("/fuente/licencia_verificada", "boolean"), rule("/fuente/uso_comercial", values=("si", "no", "por_verificar")), rule("/fuente/atribucion", "string", letters=3),
    rule("/fuente/acceso", "object", closed=True), rule("/fuente/acceso/verificado", "boolean"), rule("/fuente/acceso/fecha_verificacion", "string"),
    rule("/fuente/acceso/como", "string"), rule("/fuente/acceso/tamano_mb", "number", least=0), rule("/generacion", "object", closed=True),
    rule("/generacion/generador", "string", pattern="^[a-z][a-z0-9_]*$"), rule("/generacion/parametros", "object"), rule("/muestreo", "object", closed=True),
    rule("/muestreo/archivo", "string", letters=3), rule("/muestreo/decimales", "integer", least=0, most=4), rule("/estilo", "object", closed=True),
    rule("/estilo/unidad", "string"), rule("/estilo/factor", "number"), rule("/estilo/interpolacion", values=("lineal", "escalon")),
    rule("/estilo/rampa", "array", items=2), rule("/estilo/rampa[]", "array", items=2, items_most=2), rule("/estilo/leyenda", "array"),
    rule("/estilo/leyenda[]", "object"), rule("/estilo/leyenda[]/etiqueta", "string"), rule("/estilo/leyenda[]/color", "string", pattern="^#[0-9a-fA-F]{6}$"),
    rule("/estilo/capa_origen", "string"), rule("/estilo/paint", "object"), rule("/estilo/tipo_capa", values=("fill", "line", "circle")),
    rule("/zoom", "array", items=2, items_most=2), rule("/zoom[]", "integer", least=0, most=22), rule("/nota", "string"),
)
THEME_KEYS = {
    "": "id nombre categoria estado tipo fuente estilo zoom", "/fuente": "nombre licencia licencia_verificada atribucion", "/generacion": "generador",
    "/muestreo": "archivo", "/estilo/leyenda[]": "etiqueta color",
}


def document_nodes(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """docs(archivo, doc JSON text) → (archivo, ruta, patron, tipo, v variant, texto, n) of every node down to ``depth``.
    Text that is no JSON gives a single node of kind ``ilegible``."""
    found = docs.select("archivo", F.lit("").alias("ruta"), F.lit("").alias("patron"), F.try_parse_json("doc").alias("v"), F.lit(True).alias("_last"))
    same = "named_struct('s', '', 'p', '', 'v', v, 'last', false)"
    keyed = "transform(map_entries(try_variant_get(v, '$', 'map<string,variant>')), e -> named_struct('s', concat('/', e.key), 'p', concat('/', e.key), 'v', e.value, 'last', true))"
    listed = "transform(try_variant_get(v, '$', 'array<variant>'), (e, i) -> named_struct('s', concat('[', i, ']'), 'p', '[]', 'v', e, 'last', true))"
    below = f"coalesce({keyed}, {listed}, array())"
    for _ in range(depth):      # one pass: each node of the last level gives itself and its children
        nodes = F.expr(f"CASE WHEN _last AND v IS NOT NULL THEN concat(array({same}), {below}) ELSE array({same}) END")
        found = found.select("archivo", "ruta", "patron", F.explode(nodes).alias("_n")).select(
            "archivo", F.concat("ruta", "_n.s").alias("ruta"), F.concat("patron", "_n.p").alias("patron"), F.col("_n.v").alias("v"), F.col("_n.last").alias("_last"))
    named = F.lower(F.regexp_extract(F.schema_of_variant("v"), "^[A-Za-z]+", 0))
    kind = (F.when(F.col("v").isNull(), "ilegible").when(named == "void", "null").when(named == "bigint", "integer")
            .when(named.isin("double", "decimal", "float"), "number").otherwise(named))
    text = F.try_variant_get("v", "$", "string")
    size = F.when(kind == "array", F.size(F.try_variant_get("v", "$", "array<variant>")))
    return found.select("archivo", "ruta", "patron", kind.alias("tipo"), "v", F.when(~kind.isin("object", "array"), text).alias("texto"), size.alias("n"))


def schema_errors(docs: DataFrame, rules: tuple, keys: dict[str, str]) -> DataFrame:
    """(archivo, error) of docs(archivo, doc) under ``rules`` and compulsory ``keys`` per object; a node of the wrong kind gives
    only that error. A null or unreadable text, or a document that is no object, gives one error."""
    spark = docs.sparkSession
    nodes = truncate_lineage(document_nodes(docs))      # read three times
    table = F.broadcast(spark.createDataFrame(list(rules), RULE))
    needed = F.broadcast(spark.createDataFrame([(p, ks.split()) for p, ks in keys.items()], "patron string, llaves array<string>"))
    root = F.when(F.col("ruta") == "", "/").otherwise(F.col("ruta"))

    def message(bad: Column, *parts: Column | str) -> Column:
        texts = [p if isinstance(p, Column) else F.lit(p) for p in parts]
        return F.when(F.coalesce(bad, F.lit(False)), F.concat(root, F.lit(": "), *texts))

    kind, number = F.col("tipo"), F.expr("CASE WHEN tipo IN ('integer', 'number') THEN try_cast(texto AS DOUBLE) END")
    fits = (F.size("tipos") == 0) | F.array_contains("tipos", kind) | ((kind == "integer") & F.array_contains("tipos", "number"))
    listed = F.when(kind == "null", F.exists("lista", lambda x: x.isNull())).when(kind == "string", F.coalesce(F.array_contains("lista", F.col("texto")), F.lit(False))).otherwise(F.lit(False))
    checks = F.array_compact(F.array(
        message(F.col("lista").isNotNull() & ~listed, "no está en la lista"),
        message((kind == "string") & ~F.regexp("texto", F.col("forma")), "no calza con el patrón"),
        message((kind == "string") & (F.char_length("texto") < F.col("largo_min")), "se esperaban al menos ", F.col("largo_min").cast("string"), " caracteres"),
        message(number < F.col("minimo"), "< ", F.col("minimo").cast("int").cast("string")),
        message(number > F.col("maximo"), "> ", F.col("maximo").cast("int").cast("string")),
        message(F.col("n") < F.col("elementos_min"), "se esperaban al menos ", F.col("elementos_min").cast("string"), " elementos"),
        message(F.col("n") > F.col("elementos_max"), "se esperaban a lo más ", F.col("elementos_max").cast("string"), " elementos")))
    wrong = F.array(F.concat(root, F.lit(": tipo "), kind, F.lit(", se esperaba "), F.array_join("tipos", " o ")))
    per_node = nodes.join(table, "patron").select("archivo", F.explode(F.when(fits, checks).otherwise(wrong)).alias("error"))

    have = F.expr("map_keys(try_variant_get(v, '$', 'map<string,variant>'))")
    objects = nodes.where("tipo = 'object'").withColumn("tiene", have)
    lacking = (objects.join(needed, "patron").select("archivo", "ruta", F.explode(F.array_except("llaves", "tiene")).alias("k"))
               .select("archivo", F.concat("ruta", F.lit("/"), "k", F.lit(": falta")).alias("error")))
    known = F.broadcast(spark.createDataFrame([(p[0], [q[0][len(p[0]) + 1:] for q in rules if q[0].startswith(p[0] + "/") and "/" not in q[0][len(p[0]) + 1:] and not q[0].endswith("[]")])
                                               for p in rules if p[9]] or [("?", [])], "patron string, permitidas array<string>"))
    extra = (objects.join(known, "patron").select("archivo", "ruta", F.explode(F.array_except("tiene", "permitidas")).alias("k"))
             .select("archivo", F.concat("ruta", F.lit("/"), "k", F.lit(": no se esperaba")).alias("error")))
    return per_node.unionByName(lacking).unionByName(extra)


SOURCE = ("struct<id:string,nombre:string,institucion:string,estado:string,acceso:struct<tipo:string,url:string>,licencia:string,"
          "diccionario:array<struct<campo:string>>,mapeo:array<struct<origen:string,destino:string>>,excluir_siempre:array<string>,"
          "condicionante:struct<nivel:string,efecto:string>,demanda:struct<umbral_activacion:int,relevante_si:struct<clases:array<string>,regiones_cut:array<string>>>>")


def load_sources(docs: DataFrame) -> DataFrame:
    """docs(archivo, doc) → one row per document with the fields of ``source_errors`` and ``errores``: those of the schema, or
    where it has none those of the document (personal data, state, a name of the file other than the id)."""
    shape = schema_errors(docs, SOURCE_RULES, SOURCE_KEYS).groupBy("archivo").agg(F.array_sort(F.collect_list("error")).alias("_esquema"))
    typed = docs.select("archivo", F.from_json("doc", SOURCE).alias("d")).select(
        "archivo", "d.*").withColumns({"umbral": F.col("demanda.umbral_activacion"), "clases": F.col("demanda.relevante_si.clases")})
    stem = F.regexp_replace(F.regexp_extract("archivo", r"([^/]+)$", 1), r"\.[^.]*$", "")
    named = F.when(stem != F.col("id"), F.array(F.lit("id distinto del nombre de archivo"))).otherwise(F.array().cast("array<string>"))
    checked = source_errors(typed).join(shape, "archivo", "left")
    return checked.withColumn("errores", F.coalesce("_esquema", F.concat(named, F.col("errores")))).drop("_esquema")


def contracts_in_force(loaded: DataFrame) -> DataFrame:
    """The loaded documents without errors."""
    return loaded.where(F.size("errores") == 0)

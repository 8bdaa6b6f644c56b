"""Rules for source and theme contracts, as error lists."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import half_even
STATES = ("propuesta", "contrato", "mapeada", "latente", "activa", "mantenida")
THEME_STATES = ("propuesta", "mapeada", "activa")
PERSONAL = ("NOMBRE", "RUT")


def _errors(*checks: tuple[Column, str | Column]) -> Column:
    return F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), m if isinstance(m, Column) else F.lit(m)) for bad, m in checks]))


def source_errors(contracts: DataFrame) -> DataFrame:
    """Adds ``errores`` to contracts(id, nombre, institucion, estado, acceso struct(tipo, url), licencia, diccionario,
    mapeo array<struct(origen, destino)>, excluir_siempre, condicionante struct(nivel, efecto), umbral, clases)."""
    place = F.array_position(F.array(*[F.lit(s) for s in STATES]), F.col("estado"))
    excluded = F.transform("excluir_siempre", lambda x: F.upper(x))

    def blank(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit("")) == ""

    shape = _errors(
        (F.col("id").isNull(), "/id: falta"), (~F.col("id").rlike("^[a-z0-9_]+$"), "/id: no calza con el patrón"),
        (F.col("nombre").isNull(), "/nombre: falta"), (F.col("institucion").isNull(), "/institucion: falta"),
        (F.col("estado").isNull() | (place == 0), "/estado: no está en la lista"),
        (F.col("umbral").isNull() | (F.col("umbral") < 1), "/demanda/umbral_activacion: < 1"),
        (F.coalesce(F.size("clases"), F.lit(0)) < 1, "/demanda/relevante_si/clases: se esperaba al menos 1"),
        (~F.col("condicionante.efecto").contains("BORRADOR"), "/condicionante/efecto: debe decir BORRADOR"))
    personal = F.array_intersect(F.transform("mapeo", lambda m: F.upper(m["origen"])), excluded)
    document = _errors(
        (F.size(F.array_except(F.array(*[F.lit(p) for p in PERSONAL]), excluded)) > 0, "excluir_siempre debe incluir al menos ['NOMBRE', 'RUT']"),
        ((place >= 2) & ((F.coalesce(F.size("diccionario"), F.lit(0)) < 1) | blank("licencia")), "estado >= contrato exige diccionario y licencia"),
        ((place >= 3) & (F.coalesce(F.size("mapeo"), F.lit(0)) < 1), "estado >= mapeada exige mapeo"),
        ((place >= 4) & (blank("acceso.tipo") | ((F.col("acceso.tipo") != "manual") & blank("acceso.url"))),
         "estado >= latente exige acceso.tipo y acceso.url (o tipo manual)"))
    each = F.transform(F.array_sort(personal), lambda p: F.concat(F.lit("mapeo toma datos personales: "), p))    # one error per field
    return contracts.withColumn("_s", shape).withColumn("errores", F.when(F.size("_s") > 0, F.col("_s")).otherwise(F.concat(document, F.coalesce(each, F.array().cast("array<string>"))))).drop("_s")


def theme_errors(themes: DataFrame) -> DataFrame:
    """Adds ``errores`` to themes(id, tipo, estado, zmin, zmax, rampa array<struct(v, c)>, capa_origen, tipo_capa, paint, url,
    fecha_dato, acceso_verificado, generador, licencia_verificada, uso_comercial)."""
    ready = F.col("estado") != "propuesta"
    raster = F.col("tipo") == "raster"
    none = F.coalesce(F.size("rampa"), F.lit(0)) < 1
    values = F.transform("rampa", lambda r: r["v"])
    rising = F.forall(F.zip_with(F.slice(values, F.lit(1), F.greatest(F.size(values) - 1, F.lit(0))),
                                 F.slice(values, F.lit(2), F.greatest(F.size(values) - 1, F.lit(0))), lambda a, b: a < b), lambda ok: ok)

    def blank(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit("")) == ""

    state = F.concat(F.lit("estado "), F.col("estado"))
    return themes.withColumn("errores", _errors(
        (F.col("zmin") > F.col("zmax"), "zoom: el mínimo supera al máximo"),
        (raster & none, "un tema ráster necesita estilo.rampa (pares [valor, color])"),
        (raster & ~none & ~rising, "estilo.rampa: los valores deben ser números crecientes y distintos"),
        (raster & ~none & F.exists("rampa", lambda r: ~r["c"].rlike("^#.{6}$")), "estilo.rampa: los colores deben ser #rrggbb"),
        (~raster & ready & (blank("capa_origen") | blank("paint") | blank("tipo_capa")),
         "un tema vectorial necesita estilo.capa_origen, estilo.tipo_capa y estilo.paint"),
        (ready & (blank("url") | blank("fecha_dato")), F.concat(state, F.lit(": la fuente necesita url y fecha_dato"))),
        (ready & ~F.coalesce(F.col("acceso_verificado"), F.lit(False)), F.concat(state, F.lit(": falta fuente.acceso.verificado: true (Paso 0)"))),
        (ready & blank("generador"), F.concat(state, F.lit(": falta generacion.generador"))),
        (F.coalesce(F.col("licencia_verificada"), F.lit(False)) & (F.coalesce("uso_comercial", F.lit("por_verificar")) == "por_verificar"),
         "licencia_verificada: true exige indicar uso_comercial (si | no)")))


def publishable() -> Column:
    return F.coalesce(F.col("licencia_verificada") & (F.col("uso_comercial") == "si"), F.lit(False))


def generated(themes: DataFrame) -> DataFrame:
    """Themes that may be generated and served."""
    return themes.where(F.col("estado") != "propuesta")


def theme_state(themes: DataFrame, outputs: DataFrame) -> DataFrame:
    """themes left join outputs(id, bytes, fecha)."""
    return themes.join(outputs, "id", "left").select(
        "id", "categoria", "tipo", "estado", F.col("bytes").isNotNull().alias("generado"), half_even(F.col("bytes") / 1e6, 1).alias("mb"),
        "fecha", "licencia_verificada", publishable().alias("publicable"))


def public_view(themes: DataFrame, outputs: DataFrame) -> DataFrame:
    """Only the columns an application may show; never paths."""
    return themes.join(outputs.select("id", F.lit(True).alias("_o")), "id", "left").select(
        "id", "nombre", "categoria", "tipo", "estado", "zmin", "zmax", F.coalesce("nota", F.lit("")).alias("nota"), "licencia_verificada",
        "uso_comercial", F.coalesce("_o", F.lit(False)).alias("disponible"), publishable().alias("publicable"))


def guard_columns(df: DataFrame, wanted: list[str], excluded: list[str]) -> DataFrame:
    """Projection that refuses personal columns and an exclusion list without the compulsory ones."""
    upper = {c.upper() for c in excluded}
    if not set(PERSONAL) <= upper:
        raise ValueError("excluir_siempre debe incluir al menos NOMBRE y RUT")
    taken = sorted(c for c in wanted if c.upper() in upper)
    if taken:
        raise ValueError(f"dato personal: {taken}")
    return df.select(*wanted)

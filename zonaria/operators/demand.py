"""Sources on demand: relevance, demand log, votes."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tiling import small_side

ACTIVE = ("activa", "mantenida")
LOG_COLUMNS = ("fecha", "region", "cut", "comuna", "clase", "cobertura", "fuentes_relevantes_no_activas")
# What a source of each state still lacks.
MISSING = {
    "propuesta": "conseguir estructura y diccionario", "contrato": "decidir columnas y mapeo",
    "mapeada": "acceso automatizable o procedimiento manual", "latente": "demanda >= umbral o decisión manual",
    "activa": "—", "mantenida": "—",
}


def relevant_sources(cards: DataFrame, contracts: DataFrame) -> DataFrame:
    """(qid, id): inactive sources whose classes occur in the card and whose regions include it (no regions = all).
    cards(qid, cut, clases array), contracts(id, estado, clases array, regiones array).

    Cards collapse to their signature (region and set of classes), of which there are few however many cards; signatures
    meet the contracts on class, and on the region where a contract names regions, and every card takes the sources of its
    signature. No card row joins on a class. Null and empty class lists have no sources."""
    signature = ["reg", "firma"]
    signed = cards.select("qid", F.coalesce(F.substring("cut", 1, 2), F.lit("")).alias("reg"), F.array_sort(F.array_distinct("clases")).alias("firma"))
    lines = signed.select(*signature).distinct().select(*signature, F.explode("firma").alias("clase"))
    rules = contracts.where(~F.col("estado").isin(*ACTIVE)).select("id", F.explode("clases").alias("clase"), "regiones")
    anywhere = rules.where(F.coalesce(F.size("regiones"), F.lit(0)) <= 0).select("id", "clase")
    regional = rules.where(F.size("regiones") > 0).select("id", "clase", F.explode("regiones").alias("reg"))
    hits = lines.join(anywhere, "clase").select(*signature, "id").unionByName(lines.join(regional, ["clase", "reg"]).select(*signature, "id"))
    sources = small_side(hits.groupBy(*signature).agg(F.collect_set("id").alias("ids")))
    if sources is None:
        return signed.select("qid").join(contracts.select("id").limit(0), F.lit(False))
    return signed.join(sources, signature).select("qid", F.explode("ids").alias("id")).distinct()


def log_lines(cards: DataFrame, relevant: DataFrame) -> DataFrame:
    """Lines for the demand log: exactly the agreed columns, never a coordinate.
    cards(qid, fecha, region, cut, comuna, clase, cobertura)."""
    lists = relevant.groupBy("qid").agg(F.array_sort(F.collect_set("id")).alias("fuentes_relevantes_no_activas"))
    empty = F.array().cast("array<string>")
    return cards.join(lists, "qid", "left").withColumn(
        "fuentes_relevantes_no_activas", F.coalesce("fuentes_relevantes_no_activas", empty)).select(*LOG_COLUMNS)


def exploded(log: DataFrame) -> DataFrame:
    """One row per line and source; lines without source vanish."""
    return log.select("fecha", "region", "cut", "comuna", "clase", F.explode("fuentes_relevantes_no_activas").alias("fuente")).where(F.col("fuente").isNotNull())


def region_votes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("fuente", "region").agg(F.count("*").alias("n"))


def state(contracts: DataFrame, rows: DataFrame) -> DataFrame:
    """Votes per source against its threshold. contracts(id, estado, institucion, umbral)."""
    votes = region_votes(rows.where(F.col("region").isNotNull()))
    order = lambda a, b: (F.when(a["n"] > b["n"], -1).when(a["n"] < b["n"], 1).when(a["region"] < b["region"], -1)
                          .when(a["region"] > b["region"], 1).otherwise(0))
    per = votes.groupBy("fuente").agg(F.sum("n").alias("votos_total"), F.max("n").alias("region_max"),
                                      F.array_sort(F.collect_list(F.struct("n", "region")), order).alias("l"))
    text = F.array_join(F.transform("l", lambda v: F.concat(v["region"], F.lit(": "), v["n"].cast("string"))), "; ")
    pairs = [F.lit(v) for item in MISSING.items() for v in item]
    joined = contracts.join(per, contracts["id"] == F.col("fuente"), "left")
    top = F.coalesce("region_max", F.lit(0))
    return joined.select(
        F.col("id").alias("fuente"), "estado", "institucion", F.coalesce("votos_total", F.lit(0)).alias("votos_total"),
        F.coalesce(F.nullif(text, F.lit("")), F.lit("—")).alias("votos_por_region"), "umbral", top.alias("region_max"),
        ((F.col("estado") == "latente") & (top > 0) & (top >= F.col("umbral"))).alias("lista_para_activar"),
        F.try_element_at(F.create_map(*pairs), F.col("estado")).alias("falta"))

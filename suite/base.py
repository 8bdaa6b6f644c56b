"""Registry of queries and the relations they share.

A relation is one SQL text that both engines run over the driver tables: Spark gets the tables as DataFrames,
DuckDB by name. Geometry is derived from keys as boxes with whole-number corners on a plane that grows with the
tables (ten comunas of 2 000 m per row), so the density of features stays the same at every scale.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonaria.functions import geometry as G

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")
TILE = 2_000.0
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_CORNER = "CAST(2000 * ({m} % 10) AS DOUBLE)", "CAST(2000 * floor({m} / 10) AS DOUBLE)"


def _x(m: str) -> str:
    return _CORNER[0].replace("{m}", m)


def _y(m: str) -> str:
    return _CORNER[1].replace("{m}", m)


RELATIONS = {
    # comunas: squares of 2 000 m
    "comunas": f"""
        SELECT s_suppkey AS k, lpad(CAST(s_suppkey AS STRING), 10, '0') AS cut, concat('Comuna ', CAST(s_suppkey AS STRING)) AS comuna,
               concat('Región ', CAST(s_nationkey % 5 AS STRING)) AS region,
               {_x('s_suppkey')} AS x0, {_y('s_suppkey')} AS y0, {_x('s_suppkey')} + 2000 AS x1, {_y('s_suppkey')} + 2000 AS y1
        FROM [supplier]""",
    # planning features: 20 per comuna, reaching into the neighbours
    "feat_base": """
        SELECT p_partkey AS gid, CAST(floor(p_partkey / 20) AS BIGINT) AS m, p_size, p_brand, p_type, p_name,
               p_partkey * 7919 % 2000 AS ox, p_partkey * 6007 % 2000 AS oy, p_size * 8 AS w, (p_size * 37 % 50 + 1) * 8 AS h
        FROM [part]""",
    "feat": f"""
        SELECT gid, m,
               CASE p_type WHEN 'PROMO' THEN 'SECCIONAL' WHEN 'ECONOMY' THEN 'PRC' WHEN 'SMALL' THEN 'LU' ELSE 'PRI' END AS ipt_tipo,
               CASE p_type WHEN 'PROMO' THEN 'SECCIONAL' WHEN 'ECONOMY' THEN 'PRC' WHEN 'SMALL' THEN 'LU' WHEN 'MEDIUM' THEN 'PRI_U'
                           WHEN 'STANDARD' THEN 'PRI_E' ELSE CASE WHEN gid % 2 = 0 THEN 'PRI_R' ELSE 'PRI_ENV' END END AS fuente,
               CAST(gid % 4 AS INT) AS rango, gid % 7 = 0 AS riesgo,
               CASE WHEN p_type IN ('PROMO', 'ECONOMY', 'SMALL') AND gid % 5 <> 0 THEN lpad(CAST(m AS STRING), 10, '0') END AS cut_ipt,
               concat('Plan ', CAST(CAST(floor(m / 7) AS BIGINT) AS STRING)) AS ipt_nombre,
               CASE WHEN gid % 11 <> 0 THEN concat('ZH', CAST(p_size % 4 AS STRING)) END AS zona,
               CASE WHEN gid % 3 <> 0 THEN p_name END AS zona_desc,
               lpad(CAST(m AS STRING), 10, '0') AS cut, concat('Comuna ', CAST(m AS STRING)) AS comuna,
               concat('Región ', CAST(m % 5 AS STRING)) AS region, gid % 4 = 1 AS revisar,
               {_x('m')} + ox AS x0, {_y('m')} + oy AS y0, {_x('m')} + ox + w AS x1, {_y('m')} + oy + h AS y1
        FROM {{feat_base}}""",
    # parcels: 15 lots per comuna
    "lots": f"""
        SELECT rid, m, j, c_acctbal, c_mktsegment, cut,
               {_x('m')} + 100 + 360 * (j % 5) AS x0, {_y('m')} + 100 + 600 * floor(j / 5) AS y0,
               {_x('m')} + 100 + 360 * (j % 5) + 200 + rid * 31 % 100 AS x1, {_y('m')} + 100 + 600 * floor(j / 5) + 300 + rid * 17 % 100 AS y1
        FROM (SELECT c_custkey AS rid, CAST(floor(c_custkey / 15) AS BIGINT) AS m, c_custkey % 15 AS j, c_acctbal, c_mktsegment,
                     lpad(CAST(CAST(floor(c_custkey / 15) AS BIGINT) AS STRING), 10, '0') AS cut FROM [customer]) c""",
    # buildings: 10 per lot, some across its border
    "buildings": f"""
        SELECT bid, m, x AS x0, y AS y0, x + 20 + bid % 40 AS x1, y + 20 + bid * 7 % 40 AS y1,
               CASE WHEN bid % 3 = 0 THEN CAST(1 + bid % 6 AS DOUBLE) END AS num_floors,
               CASE WHEN bid % 4 = 1 THEN CAST(3 + bid % 20 AS DOUBLE) END AS height, o_orderpriority AS class
        FROM (SELECT o_orderkey AS bid, o_orderpriority, CAST(floor(o_orderkey / 150) AS BIGINT) AS m,
                     {_x('CAST(floor(o_orderkey / 150) AS BIGINT)')} + 90 + 360 * (CAST(floor(o_orderkey % 150 / 10) AS BIGINT) % 5) + 60 * (o_orderkey % 5) AS x,
                     {_y('CAST(floor(o_orderkey / 150) AS BIGINT)')} + 90 + 600 * floor(floor(o_orderkey % 150 / 10) / 5) + 150 * floor(o_orderkey % 10 / 5) AS y
              FROM [orders]) b""",
    # points: 100 per comuna
    "points": f"""
        SELECT event_id AS pid, m, user_id, event_type, value, ts, {_x('m')} + event_id * 7919 % 2000 + 0.5 AS x, {_y('m')} + event_id * 6007 % 2000 + 0.5 AS y
        FROM (SELECT *, CAST(floor(event_id / 100) AS BIGINT) AS m FROM [events]) e""",
    # register roles: one per customer, its own point sometimes beside the lot
    "roles": """
        SELECT rid AS row_id, cut, CASE WHEN rid % 9 <> 0 THEN concat(lpad(CAST(m % 99999 AS STRING), 5, '0'), '-', lpad(CAST(j - j % 3 * (rid % 2) AS STRING), 5, '0')) END AS rol,
               concat('t', CAST(rid - rid % 3 AS STRING)) AS id_poligono, rid % 9 <> 0 AND rid % 10 <> 3 AS datos_sii, rid % 4 <> 0 AS exacto,
               CASE WHEN rid % 8 <> 5 THEN x0 + rid * 13 % 420 END AS x, CASE WHEN rid % 8 <> 5 THEN y0 + rid * 29 % 520 END AS y,
               (x1 - x0) * (y1 - y0) AS area_poligono_m2, CASE WHEN rid % 6 = 0 THEN 'respaldo1' ELSE 'respaldo2' END AS origen,
               CASE WHEN rid % 4 <> 0 THEN 'contiene' WHEN rid % 9 = 0 THEN 'huerfano' ELSE 'cercano' END AS metodo,
               CASE WHEN rid % 5 <> 0 THEN concat('202', CAST(4 + rid % 3 AS STRING), '-', CAST(1 + rid % 2 AS STRING)) END AS periodo_sii,
               c_mktsegment AS ubicacion, lpad(CAST(m % 99999 AS STRING), 5, '0') AS manzana, abs(c_acctbal) AS sup_construida_m2,
               CAST(rid % 7 AS DOUBLE) AS pisos_max, (x1 - x0) * 2.0 AS sup_terreno_m2, concat('Calle ', CAST(rid % 50 AS STRING)) AS direccion, x0, y0, x1, y1
        FROM {lots}""",
    # registry: one instrument per order, descendants named by the parent
    "instruments": """
        SELECT o_orderkey AS id, CASE o_orderkey % 6 WHEN 0 THEN 'PRC' WHEN 1 THEN 'PS' WHEN 2 THEN 'LU' WHEN 3 THEN 'PRI' WHEN 4 THEN 'PRM' ELSE 'PRDU' END AS tipo,
               concat('Plan Regulador ', CASE o_orderkey % 4 WHEN 0 THEN 'Valle ' WHEN 1 THEN 'Costa ' WHEN 2 THEN 'Cerro ' ELSE '' END, CAST(o_orderkey % 13 AS STRING) , ' Norte') AS denominacion,
               CAST(floor(o_orderkey / 150) AS BIGINT) AS m, CASE WHEN o_orderkey % 10 = 0 THEN 'Instrumento de origen' ELSE 'Modificación' END AS clasificacion,
               CASE WHEN o_orderkey % 8 <> 0 THEN CAST(o_custkey AS STRING) END AS numero,
               CASE WHEN o_orderkey % 7 <> 0 THEN substr(CAST(o_orderdate AS STRING), 1, 10) END AS fecha,
               CASE o_orderkey % 5 WHEN 0 THEN concat('Decreto N° ', CAST(o_custkey AS STRING)) WHEN 1 THEN concat('resolucion Exento N ', CAST(o_custkey AS STRING), '/B')
                    WHEN 2 THEN concat('D.S. Nº ', CAST(o_custkey AS STRING)) WHEN 3 THEN 'Plano general' END AS doc_nombre,
               CASE WHEN o_orderkey % 3 = 0 THEN 'Ordenanza' WHEN o_orderkey % 3 = 1 THEN 'Publicación D. O. con Ordenanza' ELSE 'Plano' END AS doc_tipo,
               CASE WHEN o_orderkey % 4 <> 2 THEN concat('https://example.org/', CAST(o_orderkey AS STRING)) END AS doc_url
        FROM [orders]""",
    # raster: one row of 64 heights per vector
    "pixels": """
        SELECT CAST(1 AS BIGINT) AS raster_id, vec_id AS row, CAST(pos AS BIGINT) AS col, CAST(floor(v * 1000) AS DOUBLE) AS value FROM [pixel_source]""",
}


def text_of(name: str) -> str:
    """SQL of a relation with nested relations in place ([table] marks the driver tables)."""
    sql = RELATIONS[name]
    for other in RELATIONS:
        mark = "{" + other + "}"
        if mark in sql:
            sql = sql.replace(mark, f"({text_of(other)}) AS r_{other}")
    return sql


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def relation(spark: SparkSession, sf: str, name: str) -> DataFrame:
    sql = text_of(name)
    used = {}
    if "[pixel_source]" in sql:
        # DuckDB multiplies a FLOAT by a whole number as FLOAT, Spark as DOUBLE: now and then the floor differs
        sql = sql.replace("v * 1000", "v * CAST(1000 AS FLOAT)")
        used["pixel_source"] = table(spark, sf, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "v"))
    for t in TABLES:
        if f"[{t}]" in sql:
            used[t] = table(spark, sf, t)
    for t in used:
        sql = sql.replace(f"[{t}]", "{" + t + "}")
    return spark.sql(sql, **used)


def boxed(df: DataFrame) -> DataFrame:
    """Relation with corners → relation with a geometry column."""
    return df.withColumn("geom", G.box(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))).drop("x0", "y0", "x1", "y1")


def shaped(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return boxed(relation(spark, sf, name))


PIXEL_SOURCE = "(SELECT vec_id, unnest(range(0, 64)) AS pos, unnest(embedding) AS v FROM embeddings) AS ps"


def oracle(relations: str, body: str) -> str:
    """DuckDB text: the named relations as common table expressions, then ``body``."""
    parts = []
    for name in relations.split():
        sql = text_of(name).replace("[pixel_source]", PIXEL_SOURCE)
        for t in TABLES:
            sql = sql.replace(f"[{t}]", t)
        parts.append(f"{name} AS ({sql})")
    head = body.lstrip()
    if not parts:
        return body
    if head.upper().startswith("WITH RECURSIVE"):
        return "WITH RECURSIVE " + ", ".join(parts) + ", " + head[len("WITH RECURSIVE"):]
    if head.upper().startswith("WITH"):
        return "WITH " + ", ".join(parts) + ", " + head[len("WITH"):]
    return "WITH " + ", ".join(parts) + " " + body


def query(name: str, relations: str = "", sql: str | None = None):
    """Register a query and its DuckDB text."""
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = oracle(relations, sql)
        return fn

    return add

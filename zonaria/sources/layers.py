"""Readers of layers, catalogues, registries, parcels, norms and logs."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import text as X

FEATURE_LAYER = ("_meta struct<source:string,count:bigint,fields:array<string>,fetched_at:string>, "
                 "features array<struct<geometry:struct<type:string,coordinates:string>,properties:string>>")
DOCUMENT = "struct<tipo:string,nombre:string,url:string>"
INSTRUMENT = ("id bigint, tipo string, planificacion string, denominacion string, comunas array<string>, clasificacion string, "
              f"numeroDocumento string, fechaInicioVigencia string, documentos array<{DOCUMENT}>, instrumentosDescendientesIds string")
SERVICE = ("folder string, name string, type string, spatialReference struct<wkid:int,latestWkid:int>, "
           "fullExtent struct<xmin:double,ymin:double,xmax:double,ymax:double>, initialExtent struct<xmin:double,ymin:double,xmax:double,ymax:double>, "
           "layers array<struct<id:int,name:string,subLayerIds:array<int>>>")
DEMAND = "fecha string, region string, cut string, comuna string, clase string, cobertura string, fuentes_relevantes_no_activas array<string>"


def geojson_geometry(kind: str, coordinates: str):
    """Polygon and MultiPolygon coordinates (JSON text) → geometry; other kinds give null."""
    t, c = F.col(kind), F.col(coordinates)
    polygon = F.array(F.from_json(c, "array<array<array<double>>>"))
    multi = F.from_json(c, "array<array<array<array<double>>>>")
    return F.when(t.isin("Polygon", "MultiPolygon"), G.from_coordinates(F.when(t == "Polygon", polygon).otherwise(multi)))


def read_feature_layers(spark: SparkSession, path: str) -> DataFrame:
    """Cached GeoJSON layers → (archivo, fetched_at, properties map, geom); empty layers give no rows."""
    raw = spark.read.schema(FEATURE_LAYER).option("multiLine", True).json(path)
    rows = raw.select(F.input_file_name().alias("archivo"), "_meta.fetched_at", F.explode("features").alias("f"))
    rows = rows.select("archivo", "fetched_at", F.from_json("f.properties", "map<string,string>").alias("properties"),
                       F.col("f.geometry.type").alias("_t"), F.col("f.geometry.coordinates").alias("_c"))
    return rows.withColumn("geom", geojson_geometry("_t", "_c")).drop("_t", "_c").where(F.col("geom").isNotNull())


def read_comunas(df: DataFrame, code: str, name: str, region: str, geom: str = "geom", pattern: str | None = None) -> DataFrame:
    """Comuna layer with the configured field names → (cut, comuna, region, geom), optionally one region by pattern."""
    lacking = [c for c in (code, name, region, geom) if c not in df.columns]
    if lacking:
        raise ValueError(f"faltan campos: {lacking}")
    out = df.select(F.when(F.length(F.col(code).cast("string")) < 5, F.lpad(F.col(code).cast("string"), 5, "0")).otherwise(F.col(code).cast("string")).alias("cut"), F.col(name).alias("comuna"), F.col(region).alias("region"), F.col(geom).alias("geom"))
    return out if pattern is None else out.where(X.region_matches(F.col("region"), pattern))


def discover(services: DataFrame) -> DataFrame:
    """Service descriptions → one row per leaf layer."""
    rows = services.where(F.col("type").isin("MapServer", "FeatureServer")).select("name", "type", "spatialReference", "fullExtent", "initialExtent", F.explode("layers").alias("l"))
    leaf = F.coalesce(F.size("l.subLayerIds"), F.lit(0)) <= 0
    return rows.where(leaf).select(
        F.col("name").alias("service"), F.col("type").alias("service_type"), F.col("l.id").alias("layer_id"), F.col("l.name").alias("layer_name"),
        F.concat_ws("/", "name", "type", F.col("l.id").cast("string")).alias("url"),
        F.coalesce("spatialReference.latestWkid", "spatialReference.wkid").alias("service_wkid"), F.coalesce("fullExtent", "initialExtent").alias("service_extent"))


def read_instruments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INSTRUMENT).json(path)


def read_demand(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DEMAND).json(path)


def read_parcel_backups(spark: SparkSession, path: str, wanted: tuple[str, ...]) -> DataFrame:
    """Parquet backups: only the wanted columns that exist, with the tax code taken from the file name."""
    raw = spark.read.option("mergeSchema", True).parquet(path)
    have = [c for c in wanted if c in raw.columns]
    name = F.regexp_replace(F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1), r"\.[^.]*$", "")
    return raw.select(*have, "geom", name.alias("archivo"), F.nullif(F.regexp_extract(name, r"_(\d{4,5})$", 1), F.lit("")).alias("cod_capa"))


def read_saved_parcels(spark: SparkSession, path: str) -> DataFrame:
    """JSON documents with ``predios[]`` and GeoJSON geometry → one row per parcel."""
    schema = ("predios array<struct<rol:string,direccion:string,m2_terreno:double,sup_construida_total:double,pisos_max:double,"
              "geometry:struct<type:string,coordinates:string>>>")
    rows = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("predios").alias("p")).select("p.*")
    rows = rows.withColumns({"_t": F.col("geometry.type"), "_c": F.col("geometry.coordinates")})
    return rows.withColumn("geom", geojson_geometry("_t", "_c")).drop("_t", "_c", "geometry")


def read_text_table(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, every column text, blanks as null (norms, matches, manifests, code dimension)."""
    df = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    clean = [c.lstrip("﻿") for c in df.columns]
    return df.toDF(*clean)


def read_matches(spark: SparkSession, path: str) -> DataFrame:
    df = read_text_table(spark, path)
    return df.select(*[F.nullif(F.trim(c), F.lit("")).alias(c) for c in df.columns])


def read_partitioned(spark: SparkSession, path: str, cuts: DataFrame) -> DataFrame:
    """Rows of the partitions ``cut`` listed in ``cuts`` (a join on the partition column, pruned while running)."""
    return spark.read.parquet(path).join(cuts.select("cut").distinct(), "cut", "left_semi")


def read_contracts(spark: SparkSession, path: str) -> DataFrame:
    """JSON documents, one per file → (archivo, doc) for ``schema_rules``."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("archivo"), F.col("value").alias("doc"))

"""From raw layers to the finished partition and its reports."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import crs as C
from ..operators import features as FE
from ..operators import partition as P
from ..operators import review as RV
from ..operators.spatial_join import polygons_intersect
from ..rules import LOCAL, LandRules
from ..session import truncate_lineage


@dataclass
class Build:
    features: DataFrame
    affectations: DataFrame
    pieces: DataFrame
    comunas: DataFrame
    quality: DataFrame
    review: DataFrame
    summary: DataFrame
    unplaced: DataFrame
    coast: DataFrame
    inventory: DataFrame


def build(raw: DataFrame, catalogue: DataFrame, comunas: DataFrame, size: float, rules: LandRules = LandRules(),
          legal: dict | None = None) -> Build:
    """raw(fid, service, layer_id, properties, geom), catalogue(service, service_type, layer_id, layer_name, url),
    comunas(cut, comuna, region, geom), all in lon/lat; ``size``: tile in metres; ``legal``: texts per class.

    Comunas are enlarged by the ground of their own instruments outside all of them; partition, affectations and coverage
    refer to the enlarged shapes. Pieces and affectations come with their ground (``geom``, metric). The summary holds the
    overlaps, the instruments without a comuna and the ground outside every comuna, each with its own table."""
    def metric(df: DataFrame) -> DataFrame:
        return df.withColumn("geom", C.to_albers(F.col("geom")))

    typed = FE.type_layers(FE.dedupe_catalogue(catalogue), rules)
    # Read by every later step, so made once.
    features = truncate_lineage(FE.homologate(raw, typed, comunas, rules).withColumnRenamed("fid", "gid"))
    kept, outside = FE.split_affectations(features)
    kept, outside = truncate_lineage(metric(kept)), truncate_lineage(metric(outside))
    land = truncate_lineage(P.enlarge_comunas(kept.where(F.col("fuente").isin(*LOCAL)), metric(comunas), size))
    clipped = truncate_lineage(P.clip_shapes(outside, land, size, rules.min_area))
    risks = clipped.join(outside.where("riesgo").select("gid"), "gid", "left_semi").select("gid", F.col("cut").alias("cut_ipt"), "geom")
    pieces = truncate_lineage(P.partition_layer(land, kept, risks, size, rules))
    names = kept.select("gid", "ipt_tipo", "ipt_nombre", "servicio", "capa", "zona", "zona_desc", "revisar")
    places = comunas.select("cut", "comuna", "region")
    full = pieces.join(names, "gid", "left").join(places, "cut", "left").withColumn("revisar", F.coalesce("revisar", F.lit(False)))
    full = P.piece_ids(full if legal is None else P.annotate(full, legal))
    affected = clipped.join(outside.drop("geom"), "gid").join(comunas.select("cut", "comuna"), "cut")
    full = truncate_lineage(full)
    overlaps = P.overlap_quality(full.select("cut", F.col("id").alias("pid"), "geom"), land, size)
    quality = truncate_lineage(P.comuna_quality(pieces, land).join(land.select("cut", "ha_extension_costera"), "cut").join(overlaps, "cut", "left"))
    unplaced = truncate_lineage(P.unplaced_instruments(local_features(features), touched(features, land, size)))
    own, ground = kept.where(F.col("fuente").isin(*LOCAL)), truncate_lineage(metric(comunas))
    coast = truncate_lineage(P.coastal_quality(P.coastal_extension(own, ground, size), ground, P.coastal_parts(own, ground, size)))
    loaded = ["servicio", "capa", "ipt_tipo", "ipt_nombre", "cut_ipt"]
    inventory = features.where(F.col("ipt_tipo").isin("PRC", "SECCIONAL", "LU", "PRI", "PRM")).groupBy(*loaded).agg(F.count("*").alias("features"))
    return Build(kept, affected, full, land, quality, RV.review_table(full), P.build_summary(full, quality, unplaced, coast), unplaced, coast, inventory)


def local_features(features: DataFrame) -> DataFrame:
    """Features of comunal scope under the names of the report on those without a comuna."""
    return features.where("comunal").withColumnRenamed("gid", "fid").select("fid", "servicio", "capa", "ipt_tipo", "ipt_nombre", "attrs_raw", "comunal", "cut_ipt")


def touched(features: DataFrame, land: DataFrame, size: float) -> DataFrame:
    """(fid, comuna) of the comunas that a local feature without a comuna touches."""
    lost = features.where("comunal AND cut_ipt IS NULL").select(F.col("gid").alias("lid"), C.to_albers(F.col("geom")).alias("geom"))
    hits = polygons_intersect(lost, land.select(F.col("cut").alias("rid"), "geom"), size)
    return hits.join(land.select(F.col("cut").alias("rid"), "comuna"), "rid").select(F.col("lid").alias("fid"), "comuna")

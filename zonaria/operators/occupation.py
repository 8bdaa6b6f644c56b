"""Built occupation per zone."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import half_even
from ..functions import geometry as G
from ..functions import scales as S
from ..functions import text as X
from .overlay import overlay, pair_areas
from .shapes import dissolve
from .spatial_join import points_in_polygons

NO_ZONE = "(sin zona)"


def zone_name(zone: Column) -> Column:
    return F.coalesce(X.clean(zone), F.lit(NO_ZONE))


def joined_names(values: Column) -> Column:
    """Sorted distinct values as 'a; b'."""
    return F.array_join(F.array_sort(F.collect_set(values)), "; ")


def _coefficient(df: DataFrame) -> DataFrame:
    return df.withColumns({"ha": F.col("m2") / 1e4, "coef_ocupacion": F.when(F.col("m2") > 0, F.col("m2_huella") / F.col("m2"))})


def occupation(pieces: DataFrame, buildings: DataFrame, size: float) -> DataFrame:
    """pieces(pid, ipt_nombre, zona, fuente, comuna, region, geom), buildings(id, geom) → occupation per (ipt, zona).

    Footprint by clipping; each building counted once, where its interior point lies.
    """
    z = pieces.where(F.col("fuente") == "PRC").withColumns({"zona": zone_name(F.col("zona")), "ipt": F.col("ipt_nombre")})
    print_area = (pair_areas(buildings.select(F.col("id").alias("lid"), "geom"), z.select(F.col("pid").alias("rid"), "geom"), size)
                  .groupBy(F.col("rid").alias("pid")).agg(F.sum("area").alias("m2_huella")))
    points = buildings.select(F.col("id").alias("pid"), G.interior_point(F.col("geom")).alias("p")).select("pid", "p.x", "p.y")
    counted = (points_in_polygons(points, z.select(F.col("pid").alias("gid"), "geom"), size)
               .groupBy(F.col("gid").alias("pid")).agg(F.count("*").alias("n_edificios")))
    per_piece = (z.select("pid", "ipt", "zona", "comuna", "region", G.area(F.col("geom")).alias("m2"))
                 .join(print_area, "pid", "left").join(counted, "pid", "left"))
    keys = ["ipt", "zona"]
    sums = per_piece.groupBy(*keys).agg(
        F.sum("m2").alias("m2"), F.sum(F.coalesce("m2_huella", F.lit(0.0))).alias("m2_huella"),
        F.sum(F.coalesce("n_edificios", F.lit(0))).alias("n_edificios"),
        joined_names(F.col("region")).alias("region"), joined_names(F.col("comuna")).alias("comunas"))
    return _coefficient(sums).select(
        "ipt", "zona", "ha", "m2_huella", "coef_ocupacion", "n_edificios", "region", "comunas")


def combine(parts: list[DataFrame]) -> DataFrame:
    """Regional tables as one; a zone in several regions is summed and its lists merged."""
    df = parts[0]
    for other in parts[1:]:
        df = df.unionByName(other, allowMissingColumns=True)
    keys = ["ipt", "zona"]
    def merged(column: str) -> Column:
        words = F.flatten(F.collect_set(F.split(column, "; ")))
        return F.array_join(F.array_sort(F.array_distinct(F.filter(words, lambda w: w != ""))), "; ").alias(column)

    sums = df.groupBy(*keys).agg(
        F.sum(F.col("ha") * 1e4).alias("m2"), F.sum("m2_huella").alias("m2_huella"), F.sum("n_edificios").alias("n_edificios"),
        merged("region"), merged("comunas"))
    return _coefficient(sums).select("ipt", "zona", "ha", "m2_huella", "coef_ocupacion", "n_edificios", "region", "comunas")


def rounded(table: DataFrame) -> DataFrame:
    return table.withColumns({"ha": half_even("ha", 2), "m2_huella": half_even("m2_huella", 0).cast("bigint"),
                              "coef_ocupacion": half_even("coef_ocupacion", 4)})


def coloured(table: DataFrame) -> DataFrame:
    c, n = F.col("coef_ocupacion"), F.col("n_edificios")
    return rounded(table.withColumns({"tramo": S.occupation_label(c, n), "color": S.occupation_colour(c, n)}))


def coloured_zones(pieces: DataFrame, table: DataFrame, size: float) -> DataFrame:
    """The coloured table with the dissolved ground of every (ipt, zona); ``pieces`` as in ``occupation``."""
    z = pieces.where(F.col("fuente") == "PRC")
    layers = z.select(F.struct(F.col("ipt_nombre").alias("ipt"), zone_name(F.col("zona")).alias("zona"), "pid").alias("item"), "geom")
    zones = F.array_distinct(F.transform("active", lambda a: F.struct(a["ipt"].alias("ipt"), a["zona"].alias("zona"))))
    cells = overlay(layers, size, shapes=True, stored=pieces).withColumn("_z", F.explode(zones)).select("*", "_z.ipt", "_z.zona")
    return coloured(table).join(dissolve(cells, ["ipt", "zona"]), ["ipt", "zona"], "left")


def quality(table: DataFrame) -> DataFrame:
    return table.agg(
        F.count("*").alias("zonas"), half_even(F.sum("ha"), 1).alias("ha"), F.floor(F.sum("m2_huella")).alias("m2_huella"),
        F.sum("n_edificios").alias("n_edificios"), half_even(F.sum("m2_huella") / (F.sum("ha") * 1e4), 4).alias("coef_global"),
        half_even(F.max("coef_ocupacion"), 4).alias("coef_max"), F.count(F.when(F.col("coef_ocupacion") > 1, 1)).alias("zonas_coef_mayor_100"),
        F.count(F.when(F.col("n_edificios") == 0, 1)).alias("zonas_sin_edificios"))

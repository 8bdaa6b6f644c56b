"""Lookup cards: what applies at a batch of points and polygons."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import half_even
from ..functions import geometry as G
from ..functions import text as X
from .overlay import pair_areas
from .spatial_join import points_in_polygons

KEYS = ["clase", "ipt_tipo", "ipt_nombre", "zona", "cut"]
MAX_PARCEL_M2 = 500_000.0
DRAFT = "BORRADOR"


def admit(requests: DataFrame) -> DataFrame:
    """Adds ``error`` to requests(qid, tipo, geom): points and polygons only, not empty, parcels up to 50 ha."""
    kind = F.col("tipo")
    size = F.when(kind != "Point", G.area(F.col("geom")))
    nothing = F.coalesce(F.size(G.vertices(F.col("geom"))), F.lit(0)) == 0
    error = (F.when(~kind.isin("Point", "Polygon", "MultiPolygon"), F.concat(F.lit("Se espera un punto o un polígono, no "), kind))
             .when(nothing, "Geometría vacía")
             .when(size > MAX_PARCEL_M2, F.concat(F.lit("El polígono mide "), F.format_number(size / 1e4, 1), F.lit(" ha: se espera un predio (máximo 50 ha)"))))
    return requests.withColumn("error", error)


def shares(points: DataFrame, polygons: DataFrame, layer: DataFrame, size: float, single: bool = True) -> DataFrame:
    """(qid, pid, a, total): area of each layer piece inside the request; for a point 1 of 1 (the first piece by id when
    ``single``, as a partition has one piece per place)."""
    hits = points_in_polygons(points.select(F.col("qid").alias("pid"), "x", "y"), layer.select(F.col("pid").alias("gid"), "geom"), size, "intersects")
    if single:
        hits = hits.groupBy("pid").agg(F.min("gid").alias("gid"))
    one = hits.select(F.col("pid").alias("qid"), F.col("gid").alias("pid"), F.lit(1.0).alias("a"), F.lit(1.0).alias("total"))
    whole = polygons.select(F.col("qid"), G.area(F.col("geom")).alias("total"))
    many = (pair_areas(polygons.select(F.col("qid").alias("lid"), "geom"), layer.select(F.col("pid").alias("rid"), "geom"), size)
            .select(F.col("lid").alias("qid"), F.col("rid").alias("pid"), F.col("area").alias("a")).where("a > 0").join(whole, "qid"))
    return one.unionByName(many.select("qid", "pid", "a", "total"))


def card_rows(share: DataFrame, pieces: DataFrame) -> DataFrame:
    """Partition lines of every card: one per (class, instrument, zone, comuna), null-safe, with % and % at risk.
    pieces(pid, clase, ipt_tipo, ipt_nombre, zona, cut, riesgo)."""
    rows = share.join(pieces.select("pid", *KEYS, "riesgo"), "pid")
    sums = rows.groupBy("qid", *KEYS).agg(
        F.sum("a").alias("a"), F.sum(F.when(F.coalesce("riesgo", F.lit(False)), F.col("a")).otherwise(0.0)).alias("r"), F.max("total").alias("total"))
    return sums.select("qid", *KEYS, "a", half_even(100 * F.col("a") / F.col("total"), 2).alias("pct"),
                       half_even(100 * F.col("r") / F.col("total"), 2).alias("riesgo_pct"))


def card_heads(requests: DataFrame, share: DataFrame, pieces: DataFrame) -> DataFrame:
    """Head of every card: dominant comuna, % at risk and coverage. requests(qid, es_punto)."""
    rows = share.join(pieces.select("pid", "comuna", "cut", "region", "riesgo"), "pid")
    sums = rows.groupBy("qid").agg(
        F.max_by(F.struct("comuna", "cut", "region"), F.struct(F.col("a"), (-F.xxhash64("pid")).alias("t"))).alias("m"), F.sum("a").alias("covered"),
        F.sum(F.when(F.coalesce("riesgo", F.lit(False)), F.col("a")).otherwise(0.0)).alias("r"), F.max("total").alias("total"))
    joined = requests.join(sums, "qid", "left")
    part = (~F.col("es_punto")) & (F.col("covered") < F.col("total") * 0.9999)
    coverage = F.when(F.col("covered").isNull(), "fuera_dpa").when(part, "parcial").otherwise("completa")
    missing = half_even(100 * (1 - F.col("covered") / F.col("total")), 2)
    reason = (F.when(coverage == "fuera_dpa", "Fuera de cobertura DPA")
              .when(coverage == "parcial", F.concat(missing.cast("string"), F.lit("% del polígono queda fuera de cobertura DPA (no cae en ninguna comuna)."))))
    return joined.select("qid", "m.comuna", "m.cut", "m.region", half_even(100 * F.coalesce(F.col("r") / F.col("total"), F.lit(0.0)), 2).alias("riesgo_pct"),
                         coverage.alias("cobertura"), reason.alias("motivo"))


def affectation_rows(share: DataFrame, affectations: DataFrame) -> DataFrame:
    """Affectation lines: detail cut to 200 characters. affectations(pid, ipt_tipo, capa, zona, zona_desc, riesgo)."""
    return share.join(affectations.drop("geom"), "pid").select(
        "qid", "pid", F.col("ipt_tipo").alias("tipo"), "capa", "zona", F.left("zona_desc", F.lit(200)).alias("detalle"),
        F.coalesce("riesgo", F.lit(False)).alias("riesgo"), half_even(100 * F.col("a") / F.col("total"), 2).alias("pct"))


def norm_lists(norms: DataFrame) -> DataFrame:
    """Norm table → one row per (normalised plan, normalised zone): its norm rows, only filled columns, with a draft mark."""
    cols = [c for c in norms.columns if c not in ("ipt_nombre", "zona")]
    pairs = [v for c in cols for v in (F.lit(c), F.col(c))]
    filled = F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull() & (v != ""))
    mark = F.when(F.coalesce(F.col("estado"), F.lit("")) != "VALIDADO", DRAFT)
    rows = norms.select(X.norm_text(F.col("ipt_nombre")).alias("k_ipt"), X.norm_text(F.col("zona")).alias("k_zona"),
                        F.struct(filled.alias("valores"), mark.alias("marca")).alias("n"))
    return rows.groupBy("k_ipt", "k_zona").agg(F.collect_list("n").alias("normas"))


def enrich(rows: DataFrame, occupation: DataFrame, norms: DataFrame) -> DataFrame:
    """Card lines with the occupation and the norms of their zone; ``borrador`` tells that some norm is not validated."""
    keyed = rows.withColumns({"k_ipt": X.norm_text(F.coalesce("ipt_nombre", F.lit(""))), "k_zona": X.norm_text(F.coalesce("zona", F.lit("")))})
    occ = occupation.select(X.norm_text(F.col("ipt")).alias("k_ipt"), X.norm_text(F.col("zona")).alias("k_zona"), "ha", "m2_huella", "coef_ocupacion", "n_edificios")
    joined = keyed.join(occ, ["k_ipt", "k_zona"], "left").join(norm_lists(norms), ["k_ipt", "k_zona"], "left")
    drafts = F.coalesce(F.exists("normas", lambda n: n["marca"].isNotNull()), F.lit(False))
    return joined.withColumns({"n_normas": F.coalesce(F.size("normas"), F.lit(0)), "borrador": drafts}).drop("k_ipt", "k_zona")


def dominant_zone(rows: DataFrame) -> DataFrame:
    """Zone with the largest share of each request, and how many zones it has."""
    return rows.groupBy("qid").agg(
        F.min_by(F.struct("clase", "ipt_nombre", "zona", "pct"), F.struct(-F.col("a"), F.coalesce("clase", F.lit("")), F.coalesce("zona", F.lit("")))).alias("z"),
        F.count("*").alias("n_zonas")).select("qid", "z.clase", "z.ipt_nombre", "z.zona", "z.pct", "n_zonas")


def parcel_volume(requests: DataFrame, pieces: DataFrame, norms: DataFrame, buildings: DataFrame, size: float, floor_height: float = 3.5) -> DataFrame:
    """Volume of drawn parcels(qid, geom): dominant zone, existing volume and one scenario per norm row of that zone."""
    from . import volume as V

    empty_points = requests.select("qid", F.lit(0.0).alias("x"), F.lit(0.0).alias("y")).where(F.lit(False))
    share = shares(empty_points, requests.select("qid", "geom"), pieces, size)
    zone = dominant_zone(card_rows(share, pieces))
    parcels = requests.select(F.col("qid").alias("rid"), "geom")
    have = V.existing(parcels, buildings, size, floor_height)
    keyed = norms.withColumns({"k_ipt": X.norm_text(F.col("ipt_nombre")), "k_zona": X.norm_text(F.col("zona"))}).drop("ipt_nombre", "zona")
    mine = zone.select(F.col("qid").alias("rid"), X.norm_text(F.col("ipt_nombre")).alias("k_ipt"), X.norm_text(F.col("zona")).alias("k_zona"))
    scenarios = V.compare(have, V.possible(parcels, mine.join(keyed, ["k_ipt", "k_zona"]), floor_height))
    head = zone.withColumnRenamed("qid", "rid").join(have.select("rid", "n_edificios", "m2_existente", "cota_inferior"), "rid")
    cols = ["rid", "nid", "agrupamiento", "normas_estado", F.col("estado").alias("estado_norma"), "m2_max", "iov", "remanente_m2", "estado_iov"]
    return head.join(scenarios.select(*cols), "rid", "left").withColumn(
        "marca", F.when(F.col("nid").isNotNull() & (F.coalesce("normas_estado", F.lit("")) != "VALIDADO"), DRAFT))

"""Partition, overlay and position joins on boxes."""
from __future__ import annotations

from pyspark.sql import functions as F

from zonaria.functions.numeric import half_even
from zonaria.functions import geometry as G
from zonaria.operators import buildings as B
from zonaria.operators import cards as K
from zonaria.operators import occupation as O
from zonaria.operators import overlay as V
from zonaria.operators import partition as P
from zonaria.operators import shapes
from zonaria.operators import spatial_join as J
from zonaria.operators.tiling import deal, tile_load
from zonaria.plans import lookup
from zonaria.rules import CLASS_ORDER

from .base import TILE, boxed, query, relation, shaped

LEVEL = "CASE fuente " + " ".join(f"WHEN '{s}' THEN {i}" for i, (_, s) in enumerate(CLASS_ORDER)) + " END"
CLASS_OF = "coalesce(CASE nivel " + " ".join(f"WHEN {i} THEN '{c}'" for i, (c, _) in enumerate(CLASS_ORDER)) + " END, 'R2')"

# Reference partition: inside every comuna the plane is compressed to the cells between all box borders.
CELLS = f"""
    lv AS (SELECT gid, {LEVEL} AS nivel, fuente, rango, riesgo, cut_ipt, (x1 - x0) * (y1 - y0) AS area, x0, y0, x1, y1 FROM feat),
    fc AS (SELECT c.cut, f.*, c.x0 AS cx0, c.y0 AS cy0, c.x1 AS cx1, c.y1 AS cy1 FROM comunas c JOIN lv f
           ON f.x0 < c.x1 AND f.x1 > c.x0 AND f.y0 < c.y1 AND f.y1 > c.y0),
    xs AS (SELECT cut, x, lead(x) OVER (PARTITION BY cut ORDER BY x) AS xn FROM
           (SELECT cut, greatest(x0, cx0) AS x FROM fc UNION SELECT cut, least(x1, cx1) FROM fc UNION SELECT cut, x0 FROM comunas UNION SELECT cut, x1 FROM comunas)),
    ys AS (SELECT cut, y, lead(y) OVER (PARTITION BY cut ORDER BY y) AS yn FROM
           (SELECT cut, greatest(y0, cy0) AS y FROM fc UNION SELECT cut, least(y1, cy1) FROM fc UNION SELECT cut, y0 FROM comunas UNION SELECT cut, y1 FROM comunas)),
    cells AS (SELECT xs.cut, x, xn, y, yn, (xn - x) * (yn - y) AS a FROM xs JOIN ys USING (cut) WHERE xn IS NOT NULL AND yn IS NOT NULL),
    cover AS (SELECT c.cut, c.x, c.y, c.a, arg_min(f.gid, (f.nivel, f.rango, f.area, f.gid))
                     FILTER (WHERE f.gid IS NOT NULL AND (f.fuente NOT IN ('PRC', 'SECCIONAL', 'LU') OR f.cut_ipt IS NULL OR f.cut_ipt = c.cut)) AS gid,
                     coalesce(bool_or(f.riesgo), false) AS en_riesgo
              FROM cells c LEFT JOIN fc f ON f.cut = c.cut AND f.x0 <= c.x AND f.x1 >= c.xn AND f.y0 <= c.y AND f.y1 >= c.yn GROUP BY 1, 2, 3, 4),
    pieces AS (SELECT v.cut, l.nivel, v.gid, en_riesgo AS riesgo, sum(a) AS area_m2 FROM cover v LEFT JOIN lv l ON l.gid = v.gid GROUP BY 1, 2, 3, 4)"""
FULL = f"WITH {CELLS}"


def layers(spark, sf, dealt=False):
    """(comunas, features, risks) with geometry; every flagged feature is also a risk area. ``dealt``: rows of a small file,
    which one task reads, are dealt out before their shapes are made."""
    comunas, feat = (boxed(deal(relation(spark, sf, t))) if dealt else shaped(spark, sf, t) for t in ("comunas", "feat"))
    return comunas, feat, feat.where("riesgo").select("gid", "geom")


def pieces(spark, sf):
    comunas, feat, risks = layers(spark, sf)
    return P.partition(comunas, feat, risks, TILE)


@query("D5_D7_partition_with_risk", "feat_base feat comunas", f"{FULL} SELECT cut, {CLASS_OF} AS clase, gid, riesgo, area_m2 FROM pieces")
def partition(spark, sf):
    return pieces(spark, sf).select("cut", "clase", "gid", "riesgo", "area_m2")


@query("D7_local_risk", "feat_base feat comunas", f"""{FULL.replace("bool_or(f.riesgo)", "bool_or(f.riesgo AND (f.cut_ipt IS NULL OR f.cut_ipt = c.cut))")}
    SELECT cut, {CLASS_OF} AS clase, gid, riesgo, area_m2 FROM pieces""")
def local_risk(spark, sf):
    """Risks of one comuna's instruments reach over its border: the neighbour's ground is not at risk."""
    comunas, feat, _ = layers(spark, sf)
    return P.partition(comunas, feat, feat.where("riesgo").select("gid", "cut_ipt", "geom"), TILE).select("cut", "clase", "gid", "riesgo", "area_m2")


@query("D5_piece_shapes", "feat_base feat comunas", f"""{FULL}, lim AS (SELECT v.cut, v.gid, v.en_riesgo AS riesgo, min(c.x) AS xmin, max(c.xn) AS xmax, min(c.y) AS ymin, max(c.yn) AS ymax
    FROM cover v JOIN cells c ON c.cut = v.cut AND c.x = v.x AND c.y = v.y GROUP BY 1, 2, 3)
    SELECT p.cut, {CLASS_OF} AS clase, p.gid, p.riesgo, round_even(area_m2, 2) AS area_m2, xmin, ymin, xmax, ymax FROM pieces p JOIN lim l ON l.cut = p.cut AND l.gid IS NOT DISTINCT FROM p.gid AND l.riesgo = p.riesgo""")
def piece_shapes(spark, sf):
    """The partition as a layer: area and covering box of the outline of every piece."""
    comunas, feat, risks = layers(spark, sf)
    b = P.partition_layer(comunas, feat, risks, TILE).withColumn("b", G.bbox(F.col("geom")))
    return b.select("cut", "clase", "gid", "riesgo", half_even("area_m2", 2).alias("area_m2"), *[half_even(F.col(f"b.{c}"), 6).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")])


@query("D3_clipped_shapes", "feat_base feat comunas", """SELECT f.gid, c.cut, greatest(f.x0, c.x0) AS xmin, least(f.y1, c.y1) AS ymax, round_even((least(f.x1, c.x1) - greatest(f.x0, c.x0)) * (least(f.y1, c.y1) - greatest(f.y0, c.y0)), 2) AS area_m2
    FROM feat f JOIN comunas c ON f.x0 < c.x1 AND f.x1 > c.x0 AND f.y0 < c.y1 AND f.y1 > c.y0 WHERE f.cut_ipt IS NULL OR f.cut_ipt = c.cut""")
def clipped_shapes(spark, sf):
    comunas, feat, _ = layers(spark, sf)
    c = P.clip_shapes(feat, comunas, TILE).withColumn("b", G.bbox(F.col("geom")))
    return c.select("gid", "cut", half_even(F.col("b.xmin"), 6).alias("xmin"), half_even(F.col("b.ymax"), 6).alias("ymax"), half_even(G.area(F.col("geom")), 2).alias("area_m2"))


@query("D6_remainder_rural", "feat_base feat comunas", f"{FULL} SELECT cut, sum(area_m2) AS area_m2 FROM pieces WHERE gid IS NULL GROUP BY cut")
def remainder(spark, sf):
    return pieces(spark, sf).where("clase = 'R2'").groupBy("cut").agg(F.sum("area_m2").alias("area_m2"))


def pct(cls: str) -> str:
    return f"round_even(100 * coalesce(sum(area_m2) FILTER (WHERE {CLASS_OF} = '{cls}'), 0) / 4000000.0, 3) AS pct_{cls}"


QA = ", ".join(pct(c) for c in ("U1", "U2", "U3", "E", "R1", "R2"))


@query("E1_comuna_quality", "feat_base feat comunas", f"""{FULL} SELECT c.cut, c.comuna, c.region, {QA}, round_even(100 * sum(area_m2) / 4000000.0, 3) AS cobertura_pct,
    round_even(100 * coalesce(sum(area_m2) FILTER (WHERE riesgo), 0) / 4000000.0, 3) AS pct_riesgo, 4e6 AS area_comuna_m2,
    round_even(100 * coalesce(sum(area_m2) FILTER (WHERE {CLASS_OF} = 'U1'), 0) / 4000000.0, 3) + round_even(100 * coalesce(sum(area_m2) FILTER (WHERE {CLASS_OF} = 'U2'), 0) / 4000000.0, 3)
    + round_even(100 * coalesce(sum(area_m2) FILTER (WHERE {CLASS_OF} = 'U3'), 0) / 4000000.0, 3) = 0 AS sin_urbano
    FROM pieces p JOIN comunas c ON c.cut = p.cut GROUP BY 1, 2, 3""")
def quality(spark, sf):
    return P.comuna_quality(pieces(spark, sf), shaped(spark, sf, "comunas"))


@query("E2_overlap_metric", "feat_base feat comunas", """SELECT cut, 0e0 AS traslape_m2, true AS traslape_ok FROM comunas""")
def overlap(spark, sf):
    """The finished pieces do not overlap: their areas add up to the area of their union."""
    comunas, feat, risks = layers(spark, sf, dealt=True)
    cell = P.partition_shapes(comunas, feat, risks, TILE, tall=True)
    parts = cell.select("cut", F.xxhash64("cut", "lo", "hi", "xl0", "xr0", "xl1", "xr1").alias("pid"), P.trapezoid().alias("geom"))
    return P.overlap_quality(parts, comunas, TILE)


@query("E2_overlap_of_sources", "feat_base feat comunas", """WITH f AS (SELECT lpad(CAST(m AS VARCHAR), 10, '0') AS cut, gid, x0, y0, x1, y1 FROM feat),
    xs AS (SELECT cut, x, lead(x) OVER (PARTITION BY cut ORDER BY x) AS xn FROM (SELECT cut, x0 AS x FROM f UNION SELECT cut, x1 FROM f)),
    ys AS (SELECT cut, y, lead(y) OVER (PARTITION BY cut ORDER BY y) AS yn FROM (SELECT cut, y0 AS y FROM f UNION SELECT cut, y1 FROM f)),
    u AS (SELECT xs.cut, sum((xn - x) * (yn - y)) AS u FROM xs JOIN ys USING (cut) WHERE xn IS NOT NULL AND yn IS NOT NULL AND EXISTS (SELECT 1 FROM f WHERE f.cut = xs.cut AND f.x0 <= x AND f.x1 >= xn AND f.y0 <= y AND f.y1 >= yn) GROUP BY 1),
    s AS (SELECT cut, sum((x1 - x0) * (y1 - y0)) AS s FROM f GROUP BY 1)
    SELECT c.cut, round_even(greatest(coalesce(s - u, 0), 0), 1) AS traslape_m2, round_even(greatest(coalesce(s - u, 0), 0), 1) < greatest(1, (c.x1 - c.x0) * (c.y1 - c.y0) * 1e-6) AS traslape_ok FROM comunas c LEFT JOIN s USING (cut) LEFT JOIN u USING (cut)""")
def overlap_of_sources(spark, sf):
    """The metric on layers that do overlap: the planning features of each comuna before they are resolved."""
    comunas, feat, _ = layers(spark, sf)
    return P.overlap_quality(feat.select("cut", F.col("gid").alias("pid"), "geom"), comunas, TILE)


@query("D3_affectations_by_comuna", "feat_base feat comunas", """SELECT f.gid, c.cut, (least(f.x1, c.x1) - greatest(f.x0, c.x0)) * (least(f.y1, c.y1) - greatest(f.y0, c.y0)) AS area
    FROM feat f JOIN comunas c ON f.x0 < c.x1 AND f.x1 > c.x0 AND f.y0 < c.y1 AND f.y1 > c.y0 WHERE f.cut_ipt IS NULL OR f.cut_ipt = c.cut""")
def affectations(spark, sf):
    comunas, feat, _ = layers(spark, sf)
    return P.clip_affectations(feat, comunas, TILE)


@query("D4_overlaps_inside_source", "feat_base feat", """WITH f AS (SELECT *, (x1 - x0) * (y1 - y0) AS area FROM feat),
    pr AS (SELECT b.gid, a.x0, a.y0, a.x1, a.y1, b.x0 AS bx0, b.y0 AS by0, b.x1 AS bx1, b.y1 AS by1 FROM f b JOIN f a ON a.fuente = b.fuente AND (a.rango, a.area, a.gid) < (b.rango, b.area, b.gid)
           AND a.x0 < b.x1 AND a.x1 > b.x0 AND a.y0 < b.y1 AND a.y1 > b.y0),
    xs AS (SELECT gid, x, lead(x) OVER (PARTITION BY gid ORDER BY x) AS xn FROM (SELECT gid, greatest(x0, bx0) AS x FROM pr UNION SELECT gid, least(x1, bx1) FROM pr)),
    ys AS (SELECT gid, y, lead(y) OVER (PARTITION BY gid ORDER BY y) AS yn FROM (SELECT gid, greatest(y0, by0) AS y FROM pr UNION SELECT gid, least(y1, by1) FROM pr)),
    lost AS (SELECT gid, sum((xn - x) * (yn - y)) AS lost FROM xs JOIN ys USING (gid) WHERE xn IS NOT NULL AND yn IS NOT NULL AND EXISTS
             (SELECT 1 FROM pr WHERE pr.gid = xs.gid AND pr.x0 <= x AND pr.x1 >= xn AND pr.y0 <= y AND pr.y1 >= yn) GROUP BY gid)
    SELECT f.gid, area - coalesce(lost, 0) AS kept, coalesce(lost, 0) AS lost FROM f LEFT JOIN lost USING (gid)""")
def overlaps(spark, sf):
    return P.resolve_overlaps(shaped(spark, sf, "feat"), TILE)


OUT = """f AS (SELECT * FROM feat WHERE cut_ipt IS NOT NULL),
    pts AS (SELECT cut_ipt AS cut, x0 AS x, y0 AS y, x1, y1 FROM f),
    near AS (SELECT DISTINCT f.cut_ipt AS g, o.cut_ipt AS cut, o.x0, o.y0, o.x1, o.y1 FROM f JOIN f o ON o.x0 < f.x1 AND o.x1 > f.x0 AND o.y0 < f.y1 AND o.y1 > f.y0),
    land AS (SELECT DISTINCT f.cut_ipt AS g, c.x0, c.y0, c.x1, c.y1 FROM f JOIN comunas c ON c.x0 < f.x1 AND c.x1 > f.x0 AND c.y0 < f.y1 AND c.y1 > f.y0),
    allb AS (SELECT g, x0, y0, x1, y1 FROM near UNION ALL SELECT * FROM land),
    xs AS (SELECT g, x, lead(x) OVER (PARTITION BY g ORDER BY x) AS xn FROM (SELECT g, x0 AS x FROM allb UNION SELECT g, x1 FROM allb)),
    ys AS (SELECT g, y, lead(y) OVER (PARTITION BY g ORDER BY y) AS yn FROM (SELECT g, y0 AS y FROM allb UNION SELECT g, y1 FROM allb)),
    cells AS (SELECT g, x, xn, y, yn, (xn - x) * (yn - y) AS a FROM xs JOIN ys USING (g) WHERE xn IS NOT NULL AND yn IS NOT NULL),
    mine AS (SELECT c.*, (SELECT min(n.cut) FROM near n WHERE n.g = c.g AND n.x0 <= x AND n.x1 >= xn AND n.y0 <= y AND n.y1 >= yn) AS first,
             EXISTS (SELECT 1 FROM land l WHERE l.g = c.g AND l.x0 <= x AND l.x1 >= xn AND l.y0 <= y AND l.y1 >= yn) AS dry
             FROM cells c WHERE EXISTS (SELECT 1 FROM near n WHERE n.g = c.g AND n.cut = c.g AND n.x0 <= x AND n.x1 >= xn AND n.y0 <= y AND n.y1 >= yn))"""


@query("D20_coastal_extension", "feat_base feat comunas", f"""WITH {OUT} SELECT g AS cut, sum(a) AS area_ipt, sum(a) FILTER (WHERE NOT dry) AS area_fuera,
    coalesce(sum(a) FILTER (WHERE NOT dry AND first = g), 0) AS area_extension FROM mine GROUP BY g HAVING sum(a) FILTER (WHERE NOT dry) >= 1""")
def coast(spark, sf):
    comunas, feat, _ = layers(spark, sf)
    return P.coastal_extension(feat, comunas, TILE).drop("x_fuera")


@query("D20_enlarged_comunas", "feat_base feat comunas", f"""WITH {OUT}, s AS (SELECT g AS cut, sum(a) FILTER (WHERE NOT dry AND first = g) AS e FROM mine GROUP BY g)
    SELECT c.cut, round_even((c.x1 - c.x0) * (c.y1 - c.y0) + CASE WHEN e >= 1 THEN e ELSE 0 END, 1) AS area_m2, round_even(CASE WHEN e >= 1 THEN e ELSE 0 END / 1e4, 2) AS ha_extension_costera FROM comunas c LEFT JOIN s USING (cut)""")
def enlarged(spark, sf):
    comunas, feat, _ = layers(spark, sf)
    return P.enlarge_comunas(feat, comunas, TILE).select("cut", half_even(G.area(F.col("geom")), 1).alias("area_m2"), "ha_extension_costera")


@query("D20_coastal_quality", "feat_base feat comunas", f"""WITH {OUT}, s AS (SELECT g AS cut, sum(a) AS t, sum(a) FILTER (WHERE NOT dry) AS o, coalesce(sum(a) FILTER (WHERE NOT dry AND first = g), 0) AS e,
    sum(a * (x + xn) / 2) FILTER (WHERE NOT dry) / sum(a) FILTER (WHERE NOT dry) AS mx FROM mine GROUP BY g HAVING sum(a) FILTER (WHERE NOT dry) >= 1)
    SELECT s.cut, c.comuna, c.region, round_even(t / 1e4, 2) AS ha_ipt, round_even(o / 1e4, 2) AS ha_fuera, round_even(100 * o / t, 2) AS pct_fuera,
    round_even(CASE WHEN e >= 1 THEN e ELSE 0 END / 1e4, 2) AS ha_extension, CASE WHEN mx < (c.x0 + c.x1) / 2 THEN 'oeste (costa probable)' ELSE 'este' END AS lado FROM s LEFT JOIN comunas c USING (cut)""")
def coast_quality(spark, sf):
    comunas, feat, _ = layers(spark, sf)
    return P.coastal_quality(P.coastal_extension(feat, comunas, TILE), comunas)


@query("E4_instruments_without_comuna", "feat_base feat comunas", """SELECT f.ipt_tipo, f.ipt_nombre, count(DISTINCT f.gid) AS features, string_agg(DISTINCT c.comuna, '; ' ORDER BY c.comuna) AS comunas_tocadas
    FROM feat f JOIN comunas c ON f.x0 <= c.x1 AND f.x1 >= c.x0 AND f.y0 <= c.y1 AND f.y1 >= c.y0
    WHERE f.ipt_tipo IN ('PRC', 'SECCIONAL', 'LU') AND f.cut_ipt IS NULL GROUP BY 1, 2""")
def without_comuna(spark, sf):
    comunas, feat, _ = layers(spark, sf)
    rows = feat.drop("comuna").withColumns({"servicio": F.lit("IPT"), "capa": F.col("ipt_tipo"), "attrs_raw": F.lit("{}"), "comunal": F.col("ipt_tipo").isin("PRC", "SECCIONAL", "LU")}).withColumnRenamed("gid", "fid")
    touch = J.polygons_intersect(rows.where("comunal AND cut_ipt IS NULL").select(F.col("fid").alias("lid"), "geom"), comunas.select(F.col("cut").alias("rid"), "geom"), TILE)
    touch = touch.join(comunas.select(F.col("cut").alias("rid"), "comuna"), "rid").select(F.col("lid").alias("fid"), "comuna")
    return P.unplaced_instruments(rows, touch).select("ipt_tipo", "ipt_nombre", "features", "comunas_tocadas")


@query("E15_build_summary", "feat_base feat comunas", f"""{FULL}, q AS (SELECT cut, round_even(100 * sum(area_m2) / 4000000.0, 3) AS cob,
    round_even(100 * coalesce(sum(area_m2) FILTER (WHERE {CLASS_OF} = 'U1'), 0) / 4000000.0, 3) + round_even(100 * coalesce(sum(area_m2) FILTER (WHERE {CLASS_OF} = 'U2'), 0) / 4000000.0, 3)
    + round_even(100 * coalesce(sum(area_m2) FILTER (WHERE {CLASS_OF} = 'U3'), 0) / 4000000.0, 3) = 0 AS su FROM pieces GROUP BY cut)
    SELECT (SELECT count(*) FROM q) AS comunas, (SELECT count(*) FROM q WHERE su) AS comunas_sin_urbano, (SELECT min(cob) FROM q) AS cobertura_min_pct, (SELECT max(cob) FROM q) AS cobertura_max_pct,
    count(*) AS piezas, count(*) FILTER (WHERE gid % 4 = 1) AS zonas_pri_a_revisar, {', '.join(f"count(*) FILTER (WHERE {CLASS_OF} = '{c}') AS piezas_{c}" for c in ('U1', 'U2', 'U3', 'E', 'R1', 'R2'))} FROM pieces""")
def summary(spark, sf):
    part = pieces(spark, sf).withColumn("revisar", F.coalesce(F.col("gid") % 4 == 1, F.lit(False)))
    return P.build_summary(part, P.comuna_quality(part, shaped(spark, sf, "comunas")))


@query("F4_piece_ids", "feat_base feat comunas", f"""{FULL} SELECT gid, riesgo, concat(cut, '-', lpad(CAST(row_number() OVER (ORDER BY cut, nivel NULLS LAST, gid NULLS FIRST, riesgo) - 1 AS VARCHAR), 5, '0')) AS id, cut FROM pieces""")
def ids(spark, sf):
    return P.piece_ids(pieces(spark, sf)).select("gid", "riesgo", "id", "cut")


@query("E5_E18_class_statistics", "feat_base feat comunas", f"""{FULL} SELECT p.cut, {CLASS_OF} AS clase, count(DISTINCT f.ipt_nombre) AS instrumentos, round_even(sum(area_m2) / 1e6, 6) AS km2 FROM pieces p LEFT JOIN feat f ON f.gid = p.gid GROUP BY 1, 2""")
def class_statistics(spark, sf):
    names = relation(spark, sf, "feat").select("gid", "ipt_nombre")
    return pieces(spark, sf).join(names, "gid", "left").groupBy("cut", "clase").agg(
        F.countDistinct("ipt_nombre").alias("instrumentos"), half_even(F.sum("area_m2") / 1e6, 6).alias("km2"))


@query("K2_pair_areas", "lots buildings", """SELECT b.bid AS lid, l.rid, (least(l.x1, b.x1) - greatest(l.x0, b.x0)) * (least(l.y1, b.y1) - greatest(l.y0, b.y0)) AS area
    FROM lots l JOIN buildings b ON b.x0 < l.x1 AND b.x1 > l.x0 AND b.y0 < l.y1 AND b.y1 > l.y0 AND b.m BETWEEN l.m - 1 AND l.m + 1""")
def pair_areas(spark, sf):
    return V.pair_areas(shaped(spark, sf, "buildings").select(F.col("bid").alias("lid"), "geom"), shaped(spark, sf, "lots").select("rid", "geom"), TILE)


@query("K1_tile_load", "feat_base feat", """WITH e AS (SELECT x0 AS xa, x1 AS xb, y0 AS ya, y0 AS yb FROM feat UNION ALL SELECT x0, x1, y1, y1 FROM feat UNION ALL SELECT x0, x0, y0, y1 FROM feat UNION ALL SELECT x1, x1, y0, y1 FROM feat),
    t AS (SELECT unnest(range(CAST(floor(xa / 500) AS BIGINT), CAST(floor(xb / 500) AS BIGINT) + 1)) AS tx, ya, yb FROM e),
    u AS (SELECT tx, unnest(range(CAST(floor(ya / 500) AS BIGINT), CAST(floor(yb / 500) AS BIGINT) + 1)) AS ty FROM t)
    SELECT tx, ty, count(*) AS n FROM u GROUP BY 1, 2""")
def tile_loads(spark, sf):
    return tile_load(shaped(spark, sf, "feat"), 500.0)


@query("K1_union_area_by_plan", "feat_base feat", """WITH f AS (SELECT DISTINCT cut AS g, x0, y0, x1, y1 FROM feat),
    xs AS (SELECT g, x, lead(x) OVER (PARTITION BY g ORDER BY x) AS xn FROM (SELECT g, x0 AS x FROM f UNION SELECT g, x1 FROM f)),
    ys AS (SELECT g, y, lead(y) OVER (PARTITION BY g ORDER BY y) AS yn FROM (SELECT g, y0 AS y FROM f UNION SELECT g, y1 FROM f))
    SELECT g AS cut, sum((xn - x) * (yn - y)) AS area FROM xs JOIN ys USING (g) WHERE xn IS NOT NULL AND yn IS NOT NULL AND EXISTS
      (SELECT 1 FROM f WHERE f.g = xs.g AND f.x0 <= x AND f.x1 >= xn AND f.y0 <= y AND f.y1 >= yn) GROUP BY g""")
def union_area(spark, sf):
    return V.union_areas(shaped(spark, sf, "feat"), "cut", "gid", TILE)


@query("K3_result_checks", "feat_base feat comunas", f"{FULL} SELECT cut, 0 AS area_mayor_que_entrada, round(sum(area_m2) / 4000000.0, 9) AS cubierto FROM pieces GROUP BY cut")
def checks(spark, sf):
    """Every piece is no larger than its feature and the pieces of a comuna fill it."""
    comunas, feat, risks = layers(spark, sf)
    sizes = feat.select("gid", G.area(F.col("geom")).alias("whole"))
    per = P.partition(comunas, feat, risks, TILE).groupBy("cut", "gid").agg(F.sum("area_m2").alias("a"))
    whole = comunas.select("cut", G.area(F.col("geom")).alias("land"))
    return (per.join(sizes, "gid", "left").join(whole, "cut").groupBy("cut", "land").agg(
        F.count(F.when(F.col("a") > F.col("whole") + 1, 1)).alias("area_mayor_que_entrada"), F.sum("a").alias("s"))
        .select("cut", "area_mayor_que_entrada", F.round(F.col("s") / F.col("land"), 9).alias("cubierto")))


@query("E20_dissolved_outline", "feat_base feat comunas", "SELECT cut, 8e3 AS perimetro, 4e6 AS area, 1 AS partes FROM comunas")
def outline(spark, sf):
    """All pieces of a comuna dissolve to the comuna itself."""
    comunas, feat, risks = layers(spark, sf)
    cell = P.partition_shapes(comunas, feat, risks, TILE)
    shape = shapes.dissolve(cell, ["cut"])
    es = G.edges(F.col("geom"))
    length = F.aggregate(es, F.lit(0.0), lambda a, e: a + F.abs(e["x1"] - e["x0"]) + F.abs(e["y1"] - e["y0"]))
    return shape.select("cut", F.round(length, 3).alias("perimetro"), F.round(G.area(F.col("geom")), 3).alias("area"), G.part_count(F.col("geom")).alias("partes"))


@query("D1_points_in_zones", "feat_base feat points", "SELECT p.pid, f.gid FROM points p JOIN feat f ON p.x > f.x0 AND p.x < f.x1 AND p.y > f.y0 AND p.y < f.y1 AND f.m BETWEEN p.m - 12 AND p.m + 1")
def points_in_zones(spark, sf):
    return J.points_in_polygons(relation(spark, sf, "points"), shaped(spark, sf, "feat"), TILE)


@query("D1_first_zone_left_join", "feat_base feat points", """SELECT p.pid, min(f.gid) AS gid FROM points p LEFT JOIN feat f ON p.x > f.x0 AND p.x < f.x1 AND p.y > f.y0 AND p.y < f.y1 AND f.m BETWEEN p.m - 12 AND p.m + 1 GROUP BY p.pid""")
def first_zone(spark, sf):
    return J.first_polygon(relation(spark, sf, "points"), shaped(spark, sf, "feat"), TILE)


@query("D2_polygons_intersect", "feat_base feat lots", "SELECT l.rid AS lid, f.gid AS rid FROM lots l JOIN feat f ON l.x0 <= f.x1 AND l.x1 >= f.x0 AND l.y0 <= f.y1 AND l.y1 >= f.y0 AND f.m BETWEEN l.m - 12 AND l.m + 1")
def intersects(spark, sf):
    return J.polygons_intersect(shaped(spark, sf, "lots").select(F.col("rid").alias("lid"), "geom"), shaped(spark, sf, "feat").select(F.col("gid").alias("rid"), "geom"), TILE)


NEAR = """d AS (SELECT p.pid, l.rid, sqrt(pow(greatest(l.x0 - p.x, 0, p.x - l.x1), 2) + pow(greatest(l.y0 - p.y, 0, p.y - l.y1), 2)) AS d FROM points p JOIN lots l
    ON p.x BETWEEN l.x0 - 50 AND l.x1 + 50 AND p.y BETWEEN l.y0 - 50 AND l.y1 + 50 AND l.m BETWEEN p.m - 11 AND p.m + 11)"""


@query("D8_nearest_within_50m", "lots points", f"WITH {NEAR} SELECT pid, arg_min(rid, (d, rid)) AS gid, round(min(d), 6) AS metros FROM d WHERE d <= 50 GROUP BY pid")
def nearest(spark, sf):
    lots = shaped(spark, sf, "lots").select(F.col("rid").alias("gid"), "geom")
    return J.nearest_polygon(relation(spark, sf, "points"), lots, 50.0, TILE).select("pid", "gid", F.round("distance", 6).alias("metros"))


@query("D18_touching_neighbours", "comunas", """SELECT a.cut, count(*) AS vecinas FROM comunas a JOIN comunas b ON a.x0 <= b.x1 AND a.x1 >= b.x0 AND a.y0 <= b.y1 AND a.y1 >= b.y0 AND a.cut <> b.cut GROUP BY a.cut""")
def neighbours(spark, sf):
    c = shaped(spark, sf, "comunas")
    pairs = J.polygons_intersect(c.select(F.col("cut").alias("lid"), "geom"), c.select(F.col("cut").alias("rid"), "geom"), TILE).where("lid <> rid")
    return pairs.groupBy(F.col("lid").alias("cut")).agg(F.count("*").alias("vecinas"))


@query("B11_sample_with_neighbours", "comunas", """SELECT DISTINCT a.cut FROM comunas a JOIN comunas b ON a.x0 <= b.x1 AND a.x1 >= b.x0 AND a.y0 <= b.y1 AND a.y1 >= b.y0 WHERE b.region = 'Región 2'""")
def sample(spark, sf):
    c = shaped(spark, sf, "comunas").withColumn("gid", F.col("cut"))
    return J.neighbours(c.select("gid", "geom"), c.where("region = 'Región 2'").select("gid"), TILE).withColumnRenamed("gid", "cut")


@query("D10_building_comuna", "buildings comunas", """SELECT id, arg_min(cut, (-a, cut)) AS cut FROM (SELECT b.bid AS id, c.cut, (least(c.x1, b.x1) - greatest(c.x0, b.x0)) * (least(c.y1, b.y1) - greatest(c.y0, b.y0)) AS a
    FROM buildings b JOIN comunas c ON b.x0 < c.x1 AND b.x1 > c.x0 AND b.y0 < c.y1 AND b.y1 > c.y0) GROUP BY id""")
def building_comuna(spark, sf):
    return B.assign_comunas(shaped(spark, sf, "buildings").withColumnRenamed("bid", "id"), shaped(spark, sf, "comunas"), TILE)


def zone_pieces(spark, sf):
    return shaped(spark, sf, "feat").withColumnRenamed("gid", "pid")


OCC = """z AS (SELECT gid, ipt_nombre AS ipt, coalesce(nullif(trim(zona), ''), '(sin zona)') AS zona, comuna, region, m, x0, y0, x1, y1 FROM feat WHERE fuente = 'PRC'),
    e AS (SELECT z.gid, sum((least(z.x1, b.x1) - greatest(z.x0, b.x0)) * (least(z.y1, b.y1) - greatest(z.y0, b.y0))) AS h,
          count(*) FILTER (WHERE (b.x0 + b.x1) / 2 > z.x0 AND (b.x0 + b.x1) / 2 < z.x1 AND (b.y0 + b.y1) / 2 > z.y0 AND (b.y0 + b.y1) / 2 < z.y1) AS n
          FROM z JOIN buildings b ON b.x0 < z.x1 AND b.x1 > z.x0 AND b.y0 < z.y1 AND b.y1 > z.y0 GROUP BY z.gid),
    o AS (SELECT ipt, zona, sum((x1 - x0) * (y1 - y0)) AS m2, coalesce(sum(h), 0) AS m2_huella, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_edificios,
          string_agg(DISTINCT region, '; ' ORDER BY region) AS region, string_agg(DISTINCT comuna, '; ' ORDER BY comuna) AS comunas FROM z LEFT JOIN e USING (gid) GROUP BY 1, 2)"""


def occupation_table(spark, sf):
    return O.occupation(zone_pieces(spark, sf), shaped(spark, sf, "buildings").withColumnRenamed("bid", "id"), TILE)


@query("E6_occupation_by_zone", "feat_base feat buildings", f"WITH {OCC} SELECT ipt, zona, m2 / 1e4 AS ha, m2_huella, round(m2_huella / m2, 12) AS coef_ocupacion, n_edificios, region, comunas FROM o")
def occupation(spark, sf):
    return occupation_table(spark, sf).withColumn("coef_ocupacion", F.round("coef_ocupacion", 12))


@query("H2_combined_occupation", "feat_base feat buildings", f"WITH {OCC} SELECT ipt, zona, round(2 * m2 / 1e4, 6) AS ha, 2 * m2_huella AS m2_huella, round(m2_huella / m2, 9) AS coef_ocupacion, CAST(2 * n_edificios AS BIGINT) AS n_edificios, region, comunas FROM o")
def combined(spark, sf):
    t = occupation_table(spark, sf)
    return O.combine([t, t]).withColumns({"ha": F.round("ha", 6), "coef_ocupacion": F.round("coef_ocupacion", 9)})


@query("D26_B10_coloured_zones", "feat_base feat buildings", f"""WITH {OCC}, r AS (SELECT *, m2_huella / m2 AS c FROM o) SELECT ipt, zona, round_even(m2 / 1e4, 2) AS ha, CAST(round_even(m2_huella, 0) AS BIGINT) AS m2_huella, round_even(c, 4) AS coef_ocupacion, n_edificios,
    CASE WHEN n_edificios = 0 THEN 'sin edificios' WHEN c < 0.02 THEN '< 2 %' WHEN c < 0.05 THEN '2 – 5 %' WHEN c < 0.1 THEN '5 – 10 %' WHEN c < 0.2 THEN '10 – 20 %' WHEN c < 0.3 THEN '20 – 30 %' ELSE '≥ 30 %' END AS tramo FROM r""")
def coloured(spark, sf):
    return O.coloured(occupation_table(spark, sf)).select("ipt", "zona", "ha", "m2_huella", "coef_ocupacion", "n_edificios", "tramo")


@query("D26_zone_outlines", "feat_base feat", """WITH f AS (SELECT DISTINCT ipt_nombre AS ipt, coalesce(nullif(trim(zona), ''), '(sin zona)') AS zona, x0, y0, x1, y1 FROM feat WHERE fuente = 'PRC'),
    b AS (SELECT ipt, zona, min(x0) AS xmin, min(y0) AS ymin, max(x1) AS xmax, max(y1) AS ymax FROM f GROUP BY 1, 2),
    xs AS (SELECT ipt, zona, x, lead(x) OVER (PARTITION BY ipt, zona ORDER BY x) AS xn FROM (SELECT ipt, zona, x0 AS x FROM f UNION SELECT ipt, zona, x1 FROM f)),
    ys AS (SELECT ipt, zona, y, lead(y) OVER (PARTITION BY ipt, zona ORDER BY y) AS yn FROM (SELECT ipt, zona, y0 AS y FROM f UNION SELECT ipt, zona, y1 FROM f)),
    a AS (SELECT ipt, zona, sum((xn - x) * (yn - y)) AS area FROM xs JOIN ys USING (ipt, zona) WHERE xn IS NOT NULL AND yn IS NOT NULL AND EXISTS
          (SELECT 1 FROM f WHERE f.ipt = xs.ipt AND f.zona = xs.zona AND f.x0 <= x AND f.x1 >= xn AND f.y0 <= y AND f.y1 >= yn) GROUP BY 1, 2)
    SELECT ipt, zona, round(area, 3) AS area, xmin, ymin, xmax, ymax FROM a JOIN b USING (ipt, zona)""")
def zone_outlines(spark, sf):
    z = O.coloured_zones(zone_pieces(spark, sf), occupation_table(spark, sf), TILE).withColumn("b", G.bbox(F.col("geom")))
    return z.select("ipt", "zona", F.round(G.area(F.col("geom")), 3).alias("area"), "b.*")


@query("E6_occupation_quality", "feat_base feat buildings", f"""WITH {OCC} SELECT count(*) AS zonas, round_even(sum(m2) / 1e4, 1) AS ha, floor(sum(m2_huella)) AS m2_huella, CAST(sum(n_edificios) AS BIGINT) AS n_edificios,
    round_even(sum(m2_huella) / sum(m2), 4) AS coef_global, round_even(max(m2_huella / m2), 4) AS coef_max, count(*) FILTER (WHERE m2_huella > m2) AS zonas_coef_mayor_100, count(*) FILTER (WHERE n_edificios = 0) AS zonas_sin_edificios FROM o""")
def occupation_quality(spark, sf):
    return O.quality(occupation_table(spark, sf))


def card_requests(spark, sf):
    return relation(spark, sf, "points").withColumnRenamed("pid", "qid"), shaped(spark, sf, "lots").withColumnRenamed("rid", "qid")


@query("D24_E12_point_cards", "feat_base feat points", """SELECT p.qid, f.fuente AS clase, f.ipt_tipo, f.ipt_nombre, f.zona, f.cut, 1e2 AS pct, CASE WHEN f.riesgo THEN 1e2 ELSE 0e0 END AS riesgo_pct
    FROM (SELECT p.pid AS qid, min(f.gid) AS gid FROM points p JOIN feat f ON p.x BETWEEN f.x0 AND f.x1 AND p.y BETWEEN f.y0 AND f.y1 AND f.m BETWEEN p.m - 12 AND p.m + 1 GROUP BY p.pid) p JOIN feat f USING (gid)""")
def point_cards(spark, sf):
    points, lots = card_requests(spark, sf)
    layer = zone_pieces(spark, sf).withColumn("clase", F.col("fuente"))
    return K.card_rows(K.shares(points, lots.where(F.lit(False)), layer, TILE), layer).drop("a")


CARD = """s AS (SELECT l.rid AS qid, f.*, (least(f.x1, l.x1) - greatest(f.x0, l.x0)) * (least(f.y1, l.y1) - greatest(f.y0, l.y0)) AS a, (l.x1 - l.x0) * (l.y1 - l.y0) AS total
    FROM lots l JOIN feat f ON f.x0 < l.x1 AND f.x1 > l.x0 AND f.y0 < l.y1 AND f.y1 > l.y0 AND f.m BETWEEN l.m - 12 AND l.m + 1)"""


@query("D24_E12_polygon_cards", "feat_base feat lots", f"""WITH {CARD} SELECT qid, fuente AS clase, ipt_tipo, ipt_nombre, zona, cut, round_even(100 * sum(a) / max(total), 2) AS pct,
    round_even(100 * sum(CASE WHEN riesgo THEN a ELSE 0 END) / max(total), 2) AS riesgo_pct FROM s GROUP BY 1, 2, 3, 4, 5, 6""")
def polygon_cards(spark, sf):
    points, lots = card_requests(spark, sf)
    layer = zone_pieces(spark, sf).withColumn("clase", F.col("fuente"))
    return K.card_rows(K.shares(points.where(F.lit(False)), lots, layer, TILE), layer).drop("a")


@query("D24_lookup_plan", "feat_base feat points", """WITH n AS (SELECT DISTINCT ipt_tipo, ipt_nombre, cut FROM feat WHERE length(ipt_nombre) % 2 = 0),
    h AS (SELECT p.pid AS qid, f.* FROM points p JOIN feat f ON p.x BETWEEN f.x0 AND f.x1 AND p.y BETWEEN f.y0 AND f.y1 AND f.m BETWEEN p.m - 12 AND p.m + 1), k AS (SELECT qid, min(gid) AS gid FROM h GROUP BY qid)
    SELECT 'cabecera' AS parte, p.pid AS qid, f.comuna AS a, CASE WHEN f.gid IS NULL THEN 'fuera_dpa' ELSE 'completa' END AS b, CASE WHEN f.riesgo THEN 1e2 ELSE 0e0 END AS pct FROM points p LEFT JOIN k ON k.qid = p.pid LEFT JOIN feat f ON f.gid = k.gid
    UNION ALL SELECT 'linea', k.qid, f.ipt_nombre, CASE WHEN n.cut IS NOT NULL THEN 'D ' || n.ipt_nombre END, 1e2 FROM k JOIN feat f USING (gid) LEFT JOIN n ON n.ipt_tipo = f.ipt_tipo AND n.ipt_nombre = f.ipt_nombre AND n.cut = f.cut
    UNION ALL SELECT 'afectacion', qid, ipt_tipo, zona, 1e2 FROM h WHERE riesgo""")
def lookup_plan(spark, sf):
    points, lots = card_requests(spark, sf)
    layer = zone_pieces(spark, sf).withColumns({"clase": F.col("fuente"), "capa": F.col("ipt_tipo")})
    matches = layer.where(F.length("ipt_nombre") % 2 == 0).select("ipt_tipo", "ipt_nombre", "cut").distinct().withColumns(
        {c: F.concat(F.lit("D "), "ipt_nombre") for c in ("norma", "denominacion", "fecha_vigencia", "ultima_modificacion", "ordenanza_url")})
    heads, lines, other = lookup.cards(points, lots.where(F.lit(False)), layer, layer.where("riesgo"), matches, TILE)

    def part(df, name, a, b, pct):
        return df.select(F.lit(name).alias("parte"), "qid", F.col(a).alias("a"), F.col(b).alias("b"), F.col(pct).alias("pct"))

    return part(heads, "cabecera", "comuna", "cobertura", "riesgo_pct").unionByName(part(lines, "linea", "ipt_nombre", "ipt_norma", "pct")).unionByName(part(other, "afectacion", "tipo", "zona", "pct"))


@query("D24_card_heads", "lots comunas", """SELECT l.rid AS qid, c.comuna, c.cut, c.region, 0e0 AS riesgo_pct, CASE WHEN c.cut IS NULL THEN 'fuera_dpa' ELSE 'completa' END AS cobertura FROM lots l LEFT JOIN comunas c ON l.cut = c.cut""")
def card_heads(spark, sf):
    points, lots = card_requests(spark, sf)
    land = shaped(spark, sf, "comunas").withColumns({"pid": F.col("cut"), "riesgo": F.lit(False)})
    share = K.shares(points.where(F.lit(False)), lots, land, TILE)
    return K.card_heads(lots.select("qid", F.lit(False).alias("es_punto")), share, land).drop("motivo")


@query("D24_affectation_lines", "feat_base feat points", """SELECT p.pid AS qid, f.gid AS pid, f.ipt_tipo AS tipo, f.zona, left(f.zona_desc, 200) AS detalle, f.riesgo, 1e2 AS pct FROM points p JOIN feat f
    ON p.x BETWEEN f.x0 AND f.x1 AND p.y BETWEEN f.y0 AND f.y1 AND f.m BETWEEN p.m - 12 AND p.m + 1""")
def affectation_lines(spark, sf):
    points, lots = card_requests(spark, sf)
    layer = zone_pieces(spark, sf).withColumn("capa", F.col("ipt_tipo"))
    return K.affectation_rows(K.shares(points, lots.where(F.lit(False)), layer, TILE, single=False), layer).drop("capa")


@query("A16_A17_box_lookup", "feat_base feat", "SELECT gid, (x1 - x0) * (y1 - y0) AS area FROM feat WHERE x0 <= 5000 AND x1 >= 3000 AND y0 <= 1500 AND y1 >= 200")
def box_lookup(spark, sf):
    df = shaped(spark, sf, "feat").withColumn("bbox", G.bbox(F.col("geom")))
    return J.box_filter(df, 3000, 200, 5000, 1500).select("gid", G.area(F.col("geom")).alias("area"))


@query("D25_buildings_in_parcels", "lots buildings", """SELECT l.rid AS wid, b.bid AS id FROM lots l JOIN buildings b ON b.x0 <= l.x1 AND b.x1 >= l.x0 AND b.y0 <= l.y1 AND b.y1 >= l.y0 AND b.m BETWEEN l.m - 1 AND l.m + 1""")
def buildings_in(spark, sf):
    lots = shaped(spark, sf, "lots").withColumn("b", G.bbox(F.col("geom"))).select(F.col("rid").alias("wid"), "b.*")
    return B.in_windows(shaped(spark, sf, "buildings").withColumnRenamed("bid", "id"), lots, TILE)


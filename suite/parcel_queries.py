"""Parcels, buildings and volume."""
from __future__ import annotations

import re
import uuid

from pyspark.sql import functions as F

from zonaria.functions import crs as CR
from zonaria.functions import geometry as G
from zonaria.functions import text as X
from zonaria.functions.numeric import half_even
from zonaria.operators import bounds as BO
from zonaria.operators import buildings as B
from zonaria.operators import parcels as P
from zonaria.operators import spatial_join as J
from zonaria.operators import volume as V
from zonaria.session import shared_folder
from zonaria.sources import layers as L
from zonaria.sources import sinks

from .base import TILE, query, relation, shaped, table

CUT_OF = "lpad(CAST(floor(c_custkey / 15) AS BIGINT)::VARCHAR, 10, '0')"


def raw_parcels(spark, sf):
    """Backup rows, everything text, as a conversion receives them."""
    r = relation(spark, sf, "lots")
    k = F.col("rid")
    text = {
        "_ok": F.when(k % 10 == 3, "False").otherwise("True"), "comuna": F.lit("9201"), "rol": F.expr("CASE WHEN rid % 9 <> 0 THEN concat(lpad(CAST(m % 99999 AS STRING), 5, '0'), '-', lpad(CAST(j AS STRING), 5, '0')) ELSE 'S/N' END"),
        "direccion_sii": F.expr("CASE rid % 4 WHEN 0 THEN ' Calle Uno 12 ' WHEN 1 THEN '123' WHEN 2 THEN 'Connection Error' ELSE 'Camino' END"),
        "dc_cod_destino": F.expr("CASE rid % 3 WHEN 0 THEN ' h' WHEN 1 THEN 'X' ELSE 'C' END"), "dc_cod_ubicacion": F.expr("CASE rid % 3 WHEN 0 THEN 'u' WHEN 1 THEN 'R' ELSE '9' END"),
        "dc_sup_terreno": F.expr("CASE rid % 3 WHEN 0 THEN '0' WHEN 1 THEN 'abc' ELSE CAST(rid AS STRING) END"), "supTerreno": F.expr("CAST(rid % 500 AS STRING)"),
        "sup_construida_total": F.expr("CAST(c_acctbal AS STRING)"), "pisos_max": F.expr("CAST(rid % 4 AS STRING)"), "anio_construccion_min": F.expr("CAST(1400 + rid % 800 AS STRING)"),
        "_match_method": F.expr("CASE rid % 4 WHEN 0 THEN '1_contains' WHEN 1 THEN 'orphan_polygon' WHEN 2 THEN '2_nearest_x' END"),
        "periodo": F.expr("CASE WHEN rid % 2 = 0 THEN 'SEGUNDO SEMESTRE DE 2025' ELSE '327' END"), "lat": F.expr("CAST(-38.5 + rid % 40 AS STRING)"), "lon": F.lit("-72.5"),
    }
    return r.select("rid", "cut", F.concat(F.lit("Comuna "), F.col("m").cast("string")).alias("comuna_bcn"), F.lit("9201").alias("cod_capa"), F.lit("respaldo2").alias("origen"),
                    *[v.cast("string").alias(n) for n, v in text.items()], G.box(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")).alias("geom"))


@query("C16_clean_parcels", "lots", """WITH d AS (SELECT *, rid % 9 <> 0 AS ok, rid % 9 <> 0 AND rid % 10 <> 3 AS d, concat(lpad(CAST(m % 99999 AS VARCHAR), 5, '0'), '-', lpad(CAST(j AS VARCHAR), 5, '0')) AS r FROM lots)
    SELECT CASE WHEN ok THEN concat(cut, '-', r) END AS id, cut, CASE WHEN ok THEN left(r, 5) END AS manzana, CASE WHEN ok THEN right(r, 5) END AS predio, CASE WHEN ok THEN r END AS rol,
    CASE WHEN d THEN CASE rid % 4 WHEN 0 THEN 'Calle Uno 12' WHEN 3 THEN 'Camino' END END AS direccion, CASE WHEN d THEN CASE rid % 3 WHEN 0 THEN 'H' WHEN 2 THEN 'C' END END AS destino_cod,
    CASE WHEN d THEN CASE rid % 3 WHEN 0 THEN 'HABITACIONAL' WHEN 2 THEN 'COMERCIO' END END AS destino, CASE WHEN d THEN CASE rid % 3 WHEN 0 THEN 'URBANA' WHEN 1 THEN 'RURAL' END END AS ubicacion,
    CASE WHEN d THEN CASE WHEN rid % 3 = 2 AND rid > 0 THEN rid ELSE nullif(rid % 500, 0) END END::DOUBLE AS sup_terreno_m2, CASE WHEN d THEN c_acctbal END AS sup_construida_m2,
    CASE WHEN d THEN rid % 4 END::DOUBLE AS pisos_max, CASE WHEN d AND 1400 + rid % 800 > 1500 AND 1400 + rid % 800 < 2101 THEN 1400 + rid % 800 END::DOUBLE AS anio_construccion,
    CASE WHEN d AND rid % 2 = 0 THEN '2025-2' END AS periodo_sii, round_even((x1 - x0) * (y1 - y0), 1) AS area_poligono_m2,
    CASE rid % 4 WHEN 0 THEN 'contiene' WHEN 1 THEN 'huerfano' WHEN 2 THEN 'cercano' ELSE 'desconocido' END AS metodo, rid % 4 = 0 AS exacto, d AS datos_sii,
    CASE WHEN d AND -38.5 + rid % 40 <= -17 THEN -38.5 + rid % 40 END::DOUBLE AS lat_sii, CASE WHEN d THEN -72.5 END::DOUBLE AS lon_sii FROM d""")
def clean(spark, sf):
    return P.clean(raw_parcels(spark, sf)).drop("cod_sii", "comuna", "id_poligono", "origen", "geom")


@query("C17_geometry_gate", "lots", "SELECT cut, count(*) AS roles FROM (SELECT DISTINCT cut, m, j FROM lots WHERE rid % 5 = 2 AND rid % 9 <> 0) GROUP BY cut")
def geometry_gate(spark, sf):
    raw = raw_parcels(spark, sf).withColumn("geom", F.when(F.col("rid") % 5 != 2, F.col("geom")))
    return P.usable_geometry(raw)[1].groupBy("cut").agg(F.count("*").alias("roles"))


def roles(spark, sf):
    return shaped(spark, sf, "roles").withColumn("id", F.when(F.col("rol").isNotNull(), F.concat_ws("-", "cut", "rol"))).withColumnRenamed("geom", "geom")


UNITS = """u0 AS (SELECT *, row_number() OVER (PARTITION BY cut, rol, id_poligono ORDER BY row_id) AS rn FROM roles),
    u1 AS (SELECT * FROM u0 WHERE rol IS NULL OR rn = 1),
    u2 AS (SELECT cut, id_poligono, count(DISTINCT rol) FILTER (WHERE exacto) AS n_unidades, count(DISTINCT rol) AS n_asignados FROM u1 WHERE datos_sii AND rol IS NOT NULL GROUP BY 1, 2),
    t AS (SELECT u1.*, CAST(coalesce(u2.n_unidades, 0) AS INT) AS n_unidades, CAST(coalesce(u2.n_asignados, 0) AS INT) AS n_asignados FROM u1 LEFT JOIN u2 ON u2.cut = u1.cut AND u2.id_poligono = u1.id_poligono)"""


def grouped(spark, sf):
    return P.group_units(roles(spark, sf).drop("geom"))


@query("E8_F1_units_per_polygon", "lots roles", f"WITH {UNITS} SELECT row_id, cut, rol, id_poligono, n_unidades, n_asignados FROM t")
def units(spark, sf):
    return grouped(spark, sf).select("row_id", "cut", "rol", "id_poligono", "n_unidades", "n_asignados")


@query("E10_parcel_statistics", "lots roles", f"""WITH {UNITS}, p AS (SELECT cut, arg_min(periodo_sii, (-n, periodo_sii)) AS periodo FROM (SELECT cut, periodo_sii, count(*) AS n FROM t WHERE periodo_sii IS NOT NULL GROUP BY 1, 2) GROUP BY 1)
    SELECT t.cut, count(*) AS n, coalesce(max(p.periodo), '') AS periodo, round_even(count(periodo_sii) / greatest(1, count(*) FILTER (WHERE datos_sii)), 3) AS pct_periodo, count(*) FILTER (WHERE datos_sii) AS n_datos_sii,
    count(DISTINCT rol) FILTER (WHERE datos_sii) AS n_roles, count(*) FILTER (WHERE exacto) AS n_exactos, count(*) FILTER (WHERE metodo = 'huerfano') AS n_huerfanos,
    count(rol) - count(DISTINCT rol) AS n_ids_repetidos, count(DISTINCT id_poligono) FILTER (WHERE n_unidades > 1) AS n_terrenos_copropiedad, count(DISTINCT rol) FILTER (WHERE n_unidades > 1) AS n_roles_copropiedad
    FROM t LEFT JOIN p ON p.cut = t.cut GROUP BY t.cut""")
def statistics(spark, sf):
    return P.statistics(grouped(spark, sf))


@query("E16_modal_vote", "points comunas", """WITH v AS (SELECT p.user_id, c.cut FROM points p LEFT JOIN comunas c ON p.x > c.x0 AND p.x < c.x1 AND p.y > c.y0 AND p.y < c.y1),
    n AS (SELECT user_id, cut, count(*) AS n FROM v WHERE cut IS NOT NULL GROUP BY 1, 2), b AS (SELECT user_id, arg_min(cut, (-n, cut)) AS cut, max(n) AS n FROM n GROUP BY 1), t AS (SELECT user_id, count(*) AS t FROM v GROUP BY 1)
    SELECT t.user_id, b.cut, round_even(coalesce(n, 0) / t, 3) AS participacion, b.cut IS NOT NULL AND round_even(coalesce(n, 0) / t, 3) >= 0.9 AS ok FROM t LEFT JOIN b ON t.user_id = b.user_id""")
def vote(spark, sf):
    from zonaria.operators.spatial_join import first_polygon

    points = relation(spark, sf, "points")
    land = shaped(spark, sf, "comunas").select(F.col("cut").alias("gid"), "geom")
    hits = first_polygon(points, land, TILE).withColumnRenamed("gid", "cut")
    return P.vote(points.select("pid", "user_id").join(hits, "pid"), "user_id", "cut")


ARCHIVE = """n AS (SELECT row_id, cut, rol, exacto, metodo, datos_sii FROM roles WHERE origen = 'respaldo2'), o AS (SELECT row_id, cut, rol, exacto, metodo, datos_sii FROM roles),
    kn AS (SELECT DISTINCT cut, rol FROM roles WHERE rol IS NOT NULL AND row_id % 12 = 0)"""


@query("D17_H1_archive_union", "lots roles", f"""WITH {ARCHIVE} SELECT row_id, cut, rol, exacto, metodo, 'nuevo' AS procedencia FROM n
    UNION ALL SELECT o.row_id, o.cut, o.rol, CASE WHEN kn.rol IS NULL THEN exacto ELSE false END, CASE WHEN kn.rol IS NULL THEN metodo ELSE 'relleno_respaldo1' END, 'archivo'
    FROM o LEFT JOIN kn ON kn.cut = o.cut AND kn.rol = o.rol WHERE datos_sii AND o.rol IS NOT NULL AND o.cut IN (SELECT cut FROM n) AND NOT EXISTS (SELECT 1 FROM n WHERE n.cut = o.cut AND n.rol = o.rol)""")
def archive(spark, sf):
    r = relation(spark, sf, "roles").select("row_id", "cut", "rol", "exacto", "metodo", "datos_sii", "origen")
    known = r.where("rol IS NOT NULL AND row_id % 12 = 0").select("cut", "rol")
    return P.complete_with_archive(r.where("origen = 'respaldo2'"), r, known).select("row_id", "cut", "rol", "exacto", "metodo", "procedencia")


REASSIGN = """rl AS (SELECT cut, rol, arg_min(id_poligono, (NOT exacto, row_id)) AS id_poligono, arg_min(struct_pack(x := x, y := y), (NOT exacto, row_id)) AS q FROM roles WHERE datos_sii AND rol IS NOT NULL GROUP BY 1, 2),
    rp AS (SELECT cut, rol, id_poligono, q.x AS x, q.y AS y FROM rl),
    pl AS (SELECT cut, id_poligono, origen = 'respaldo1' AS old, area_poligono_m2 AS area, x0, y0, x1, y1 FROM (SELECT *, row_number() OVER (PARTITION BY cut, id_poligono ORDER BY row_id) AS rn FROM roles) WHERE rn = 1),
    i AS (SELECT r.cut, r.rol, arg_min(p.id_poligono, (p.old, p.area, p.id_poligono)) AS g FROM rp r JOIN pl p ON p.cut = r.cut AND r.x > p.x0 AND r.x < p.x1 AND r.y > p.y0 AND r.y < p.y1 GROUP BY 1, 2),
    dd AS (SELECT r.cut, r.rol, p.id_poligono AS g, sqrt(pow(greatest(p.x0 - r.x, 0, r.x - p.x1), 2) + pow(greatest(p.y0 - r.y, 0, r.y - p.y1), 2)) AS d FROM rp r JOIN pl p ON p.cut = r.cut WHERE r.x IS NOT NULL AND NOT EXISTS (SELECT 1 FROM i WHERE i.cut = r.cut AND i.rol = r.rol)),
    nn AS (SELECT cut, rol, arg_min(g, (d, g)) AS g FROM dd WHERE d <= 50 GROUP BY 1, 2),
    de AS (SELECT r.cut, r.rol, r.id_poligono, CASE WHEN r.x IS NULL OR r.y IS NULL THEN r.id_poligono ELSE coalesce(i.g, nn.g) END AS id_nuevo,
           CASE WHEN r.x IS NULL OR r.y IS NULL THEN 'sin_punto' WHEN i.g IS NOT NULL THEN 'dentro' WHEN nn.g IS NOT NULL THEN 'cercano' ELSE 'ninguno' END AS tipo
           FROM rp r LEFT JOIN i ON i.cut = r.cut AND i.rol = r.rol LEFT JOIN nn ON nn.cut = r.cut AND nn.rol = r.rol)"""


@query("D8_D9_reassign_by_point", "lots roles", f"WITH {REASSIGN} SELECT * FROM de")
def reassign(spark, sf):
    return P.reassign(roles(spark, sf), TILE)


@query("E23_reassign_figures", "lots roles", f"""WITH {REASSIGN} SELECT cut, count(*) AS roles, count(*) FILTER (WHERE tipo = 'dentro') AS dentro, count(*) FILTER (WHERE tipo = 'cercano') AS cercano_50m, count(*) FILTER (WHERE tipo = 'sin_punto') AS sin_punto_conservados,
    count(*) FILTER (WHERE tipo = 'ninguno') AS sin_poligono, count(*) FILTER (WHERE tipo <> 'ninguno' AND id_poligono <> id_nuevo) AS cambiaron_de_poligono FROM de GROUP BY cut""")
def figures(spark, sf):
    return P.reassign_figures(P.reassign(roles(spark, sf), TILE))


@query("D9_table_after_reassign", "lots roles", f"""WITH {REASSIGN}, m AS (SELECT cut, id_nuevo AS id_poligono, rol, CASE tipo WHEN 'dentro' THEN 'punto_en_poligono' WHEN 'cercano' THEN 'cercano_50m' END AS met FROM de WHERE tipo <> 'ninguno'),
    h AS (SELECT DISTINCT cut, id_poligono FROM roles r WHERE origen <> 'respaldo1' AND NOT EXISTS (SELECT 1 FROM m WHERE m.cut = r.cut AND m.id_poligono = r.id_poligono))
    SELECT cut, count(*) AS filas, count(rol) AS con_rol, count(*) FILTER (WHERE met = 'punto_en_poligono') AS dentro FROM (SELECT cut, rol, met FROM m UNION ALL SELECT cut, NULL, NULL FROM h) GROUP BY cut""")
def after(spark, sf):
    r = roles(spark, sf)
    table_, _ = P.apply_reassignment(r, P.reassign(r, TILE))
    return table_.groupBy("cut").agg(F.count("*").alias("filas"), F.count("rol").alias("con_rol"), F.count(F.when(F.col("metodo") == "punto_en_poligono", 1)).alias("dentro"))


@query("B14_roles_without_polygon", "lots roles", """SELECT DISTINCT cut, rol FROM roles r WHERE rol IS NOT NULL AND (row_id % 2 = 0 AND NOT EXISTS (SELECT 1 FROM roles s WHERE s.cut = r.cut AND s.rol = r.rol AND s.row_id % 3 = 0) OR row_id % 7 = 0)""")
def without_polygon(spark, sf):
    r = relation(spark, sf, "roles").select("cut", "rol", "row_id").where("rol IS NOT NULL")
    return P.accumulate_lost(r.where("row_id % 2 = 0").select("cut", "rol"), r.where("row_id % 3 = 0"), r.where("row_id % 7 = 0").select("cut", "rol"))


@query("D22_parcel_by_role", "lots roles", f"""WITH {UNITS}, q AS (SELECT row_id AS qid, cut, rol FROM roles WHERE rol IS NOT NULL), lo AS (SELECT DISTINCT cut, rol FROM roles WHERE row_id % 7 = 0 AND rol IS NOT NULL),
    a AS (SELECT q.qid, arg_min(t.id_poligono, (NOT t.datos_sii, NOT t.exacto, t.area_poligono_m2, t.id_poligono)) AS id_poligono, count(DISTINCT t.id_poligono) AS n_poligonos, max(t.n_unidades) FILTER (WHERE t.datos_sii AND t.exacto AND t.n_unidades > 1) AS u
          FROM q JOIN t ON t.cut = q.cut AND t.rol = q.rol AND t.row_id % 3 <> 0 GROUP BY 1)
    SELECT q.qid, q.cut, q.rol, CASE WHEN u IS NOT NULL THEN 'copropiedad' WHEN a.qid IS NOT NULL THEN 'predio' WHEN lo.rol IS NOT NULL THEN 'solo_punto' ELSE 'sin_resultado' END AS tipo, a.id_poligono,
    coalesce(n_poligonos, 0) AS n_poligonos, coalesce(u, 0) AS n_unidades FROM q LEFT JOIN a USING (qid) LEFT JOIN lo ON lo.cut = q.cut AND lo.rol = q.rol""")
def by_role(spark, sf):
    r = relation(spark, sf, "roles").where("rol IS NOT NULL")
    asked = r.select(F.col("row_id").alias("qid"), "cut", F.replace("rol", F.lit("-"), F.lit(" / ")).alias("rol"))
    return P.lookup_by_role(asked, grouped(spark, sf).where("row_id % 3 <> 0"), r.where("row_id % 7 = 0").select("cut", "rol"))


@query("D22_resolve_comuna_requests", "comunas", """SELECT k AS qid, CASE k % 3 WHEN 0 THEN cut WHEN 1 THEN cut WHEN 2 THEN cut END AS cut FROM comunas""")
def requests(spark, sf):
    c = relation(spark, sf, "comunas")
    k = F.col("k")
    asked = c.select(k.alias("qid"), F.when(k % 3 == 0, F.col("cut")).alias("cut"), F.when(k % 3 == 1, F.concat(F.lit("0"), k.cast("string"))).alias("cod_sii"),
                     F.when(k % 3 == 2, F.upper("comuna")).alias("comuna"))
    return P.resolve_requests(asked, c.select("cut", "comuna"), c.select(k.cast("string").alias("cod_sii"), "cut"))


@query("D23_parcel_at_point", "lots roles points", f"""WITH {UNITS}, hit AS (SELECT p.pid, t.row_id, t.datos_sii AND t.rol IS NOT NULL AS d, t.exacto, t.n_unidades, t.area_poligono_m2 AS area, t.x AS sx, t.y AS sy, p.x AS px, p.y AS py
    FROM points p JOIN t ON p.x BETWEEN t.x0 AND t.x1 AND p.y BETWEEN t.y0 AND t.y1 AND CAST(floor(t.row_id / 15) AS BIGINT) = p.m),
    k AS (SELECT *, CASE WHEN d AND exacto AND n_unidades > 1 THEN 0 WHEN d AND exacto THEN 1 WHEN d THEN 2 ELSE 3 END AS a FROM hit),
    o AS (SELECT *, CASE WHEN a IN (0, 3) THEN 0.0 ELSE coalesce(sqrt(pow((sx / 1e5 - px / 1e5) * 111320.0 * cos(radians(py / 1e5)), 2) + pow((sy / 1e5 - py / 1e5) * 110574.0, 2)), CAST('Infinity' AS DOUBLE)) END AS b FROM k)
    SELECT pid, arg_min(row_id, (a, b, CASE WHEN a = 0 THEN 0 ELSE area END, row_id)) AS row_id, CASE min(a) WHEN 0 THEN 'copropiedad' WHEN 1 THEN 'exacto' WHEN 2 THEN 'aproximado' ELSE 'sin_datos' END AS regla FROM o GROUP BY pid""")
def at_point(spark, sf):
    points = relation(spark, sf, "points").select("pid", "x", "y", (F.col("x") / 1e5).alias("lon"), (F.col("y") / 1e5).alias("lat"))
    r = roles(spark, sf)
    own = r.select("row_id", "geom", (F.col("x") / 1e5).alias("lon_sii"), (F.col("y") / 1e5).alias("lat_sii"))
    return P.parcel_at_point(points, grouped(spark, sf).join(own, "row_id"), TILE)


@query("M4_parcel_answers", "lots roles", f"""WITH {UNITS}, i AS (SELECT *, concat(cut, '-', rol) AS id FROM t WHERE rol IS NOT NULL),
    f AS (SELECT id, arg_min(struct_pack(cut := cut, rol := rol, d := datos_sii, e := exacto, m := metodo, a := n_asignados, p := periodo_sii), (NOT datos_sii, NOT exacto, area_poligono_m2, id_poligono)) AS f, count(*) AS n FROM i GROUP BY 1),
    g AS (SELECT id, f.cut AS cut, f.rol AS rol, f.m AS metodo, n AS n_poligonos, f.d AS d, f.e AS e, f.a AS a, CASE WHEN f.d THEN coalesce(f.p, '2025-2') END AS u, coalesce(CASE WHEN f.d THEN f.p END, '2025-2') AS b FROM f),
    h AS (SELECT *, 4053 - (CAST(substr(b, 1, 4) AS INT) * 2 + CAST(substr(b, 6, 1) AS INT) - 1) AS lag FROM g)
    SELECT id, cut, rol, metodo, n_poligonos, CASE WHEN NOT d THEN 'sin_datos' WHEN e THEN 'exacta' ELSE 'aproximada' END AS geometria, CASE WHEN u IS NULL THEN 'sin_dato' WHEN lag > 0 THEN 'atrasado' ELSE 'al_dia' END AS estado_fecha,
    lag AS atraso_semestres, CAST(1 + CASE WHEN NOT d OR NOT e THEN 1 ELSE 0 END + CASE WHEN d AND a > 1 THEN 1 ELSE 0 END + CASE WHEN n_poligonos > 1 THEN 1 ELSE 0 END + CASE WHEN u IS NOT NULL THEN 1 ELSE 0 END AS INT) AS n_avisos FROM h""")
def answers(spark, sf):
    periods = relation(spark, sf, "comunas").select("cut", F.lit("2025-2").alias("periodo"))
    t = grouped(spark, sf).withColumn("id", F.when(F.col("rol").isNotNull(), F.concat_ws("-", "cut", "rol")))
    a = P.answers(t, periods, F.lit("2026-10-07").cast("date"))
    return a.withColumn("n_avisos", F.size("avisos")).drop("avisos")


@query("M4_terrain_answers", "lots roles", f"""WITH {UNITS}, x AS (SELECT DISTINCT ON (cut, id_poligono, rol) * FROM t WHERE datos_sii AND exacto AND rol IS NOT NULL AND n_unidades > 1)
    SELECT concat(cut, '-T-', id_poligono) AS id, cut, CASE WHEN count(DISTINCT manzana) = 1 THEN max(manzana) END AS manzana, CASE WHEN count(DISTINCT ubicacion) = 1 THEN max(ubicacion) END AS ubicacion,
    arg_min(area_poligono_m2, rol) AS area_poligono_m2, count(*) AS n_unidades, greatest(0, max(n_asignados) - count(*)) AS asignaciones_aproximadas_omitidas, string_agg(rol, ',' ORDER BY rol) AS roles FROM x GROUP BY cut, id_poligono HAVING count(*) > 1""")
def terrains_answer(spark, sf):
    return P.terrain_answers(grouped(spark, sf)).drop("roles_detallados").withColumn("roles", F.array_join("roles", ","))


@query("E9_A12_terrains", "lots roles", """WITH x AS (SELECT * FROM roles WHERE datos_sii AND rol IS NOT NULL AND exacto)
    SELECT id_poligono, CASE WHEN count(DISTINCT rol) = 1 THEN min(rol) ELSE concat(min(rol), ' (+', CAST(count(DISTINCT rol) - 1 AS VARCHAR), ' unidades)') END AS rol, round(sum(sup_construida_m2), 4) AS sup_construida_total, max(pisos_max) AS pisos_max,
    count(DISTINCT rol) AS n_unidades, CASE WHEN bool_and(exacto) THEN 'exacta' ELSE 'aproximada' END AS calidad_geometria,
    CASE WHEN count(DISTINCT rol) = 1 THEN arg_min(sup_terreno_m2, (rol, row_id)) ELSE arg_min(area_poligono_m2, (rol, row_id)) END AS m2_terreno FROM x GROUP BY 1""")
def terrains(spark, sf):
    t = V.terrains(relation(spark, sf, "roles").where("NOT (datos_sii AND exacto AND rol IS NULL)"))
    return t.select("id_poligono", "rol", F.round("sup_construida_total", 4).alias("sup_construida_total"), "pisos_max", "n_unidades", "calidad_geometria", "m2_terreno")


@query("G5_reproducible_sample", sql="SELECT o_orderkey FROM orders ORDER BY md5('1|' || o_orderkey), o_orderkey LIMIT 500")
def sample(spark, sf):
    return V.reproducible_sample(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 500, 1)


@query("B7_manifest_upsert", "lots roles", f"""WITH {UNITS}, s AS (SELECT cut, count(*) AS n FROM t GROUP BY 1), m AS (SELECT DISTINCT cut, concat('archivo_', cut) AS archivo, CASE WHEN right(cut, 1) IN ('1', '3') THEN 'error' ELSE 'ok' END AS estado, 0 AS n FROM roles)
    SELECT m.cut, archivo, estado, CASE WHEN estado = 'ok' THEN s.n ELSE m.n END AS n FROM m LEFT JOIN s USING (cut)""")
def manifest(spark, sf):
    t = grouped(spark, sf)
    m = relation(spark, sf, "roles").select("cut").distinct().select("cut", F.concat(F.lit("archivo_"), "cut").alias("archivo"),
                                                                     F.when(F.right("cut", F.lit(1)).isin("1", "3"), "error").otherwise("ok").alias("estado"), F.lit(0).cast("bigint").alias("n"))
    m = P.upsert_manifest(m, m.where("estado = 'error'"))
    return P.refresh_manifest(m, P.statistics(t).select("cut", "n"))


@query("B6_spatial_order", "lots", "SELECT rid, x0 AS xmin, y1 AS ymax FROM lots")
def spatial_order(spark, sf):
    """Every lot keeps its box, with a position on the curve inside the range of the grid."""
    placed = sinks.spatially_sorted(shaped(spark, sf, "lots").select("rid", "geom"), (0.0, 0.0, 20000.0, 20000.0))
    return placed.where(F.col("hilbert").between(0, 4 ** 10 - 1)).select("rid", F.col("bbox.xmin").alias("xmin"), F.col("bbox.ymax").alias("ymax"))


def volume_parcels(spark, sf):
    return shaped(spark, sf, "lots").select("rid", "cut", F.col("rid").cast("string").alias("rol"), F.expr("CASE WHEN rid % 5 <> 0 THEN 100000.0D END").alias("m2_terreno"),
                                            F.expr("CASE WHEN rid % 4 <> 0 THEN abs(c_acctbal) * 3 END").alias("sup_construida_total"), F.expr("CAST(rid % 3 AS DOUBLE)").alias("pisos_max"), "geom")


def volume_buildings(spark, sf):
    return shaped(spark, sf, "buildings").withColumnRenamed("bid", "id")


VPAIR = """pr AS (SELECT l.rid, b.bid, (least(l.x1, b.x1) - greatest(l.x0, b.x0)) * (least(l.y1, b.y1) - greatest(l.y0, b.y0)) AS part, (b.x1 - b.x0) * (b.y1 - b.y0) AS whole, (l.x1 - l.x0) * (l.y1 - l.y0) AS lot, b.num_floors, b.height
    FROM lots l JOIN buildings b ON b.x0 < l.x1 AND b.x1 > l.x0 AND b.y0 < l.y1 AND b.y1 > l.y0 AND b.m BETWEEN l.m - 1 AND l.m + 1)"""
VCALC = """kp2 AS (SELECT *, count(*) OVER (PARTITION BY bid) > 1 AS sh FROM kp),
    s AS (SELECT rid, count(*) AS n, sum(part) AS h, count(*) FILTER (WHERE sh) AS nc, max(num_floors) AS fl FROM kp2 GROUP BY rid),
    r AS (SELECT l.rid, coalesce(n, 0) AS n_edificios, coalesce(h, 0) AS h, coalesce(nc, 0) AS nc, fl, CASE WHEN l.rid % 4 <> 0 THEN nullif(abs(c_acctbal) * 3, 0) END AS c, CASE WHEN l.rid % 5 <> 0 THEN 100000.0 ELSE (x1 - x0) * (y1 - y0) END AS t FROM lots l LEFT JOIN s USING (rid)),
    v AS (SELECT *, CASE WHEN h <= 0 THEN '' WHEN c IS NOT NULL THEN 'sii' WHEN fl IS NOT NULL THEN 'overture_num_floors' ELSE '' END AS fuente_pisos,
          CASE WHEN h <= 0 THEN NULL WHEN c IS NOT NULL THEN greatest(1, round_even(c / h, 0)) ELSE fl END AS pisos FROM r)
    SELECT rid, n_edificios, round_even(h, 1) AS huella_m2, CAST(pisos AS INT) AS pisos_est, round_even(h * pisos, 1) AS m2_equiv, round_even(h * pisos * 2.5, 1) AS v_calc_m3, CASE WHEN pisos IS NULL THEN 'sin_dato' ELSE 'ok' END AS estado, fuente_pisos,
    CASE WHEN pisos >= 5 THEN 'baja' WHEN pisos IS NOT NULL THEN 'media' ELSE '' END AS confianza_pisos, round_even(h / t, 3) AS ocupacion_predio FROM v"""
VCOLS = ["rid", "n_edificios", "huella_m2", "pisos_est", "m2_equiv", "v_calc_m3", "estado", "fuente_pisos", "confianza_pisos", "ocupacion_predio"]


@query("E7_calculated_volume_shared", "lots buildings", f"WITH {VPAIR}, kp AS (SELECT * FROM pr WHERE part / whole > 0.5 OR (part / whole >= 0.1 AND part / lot >= 0.1)), {VCALC}")
def calculated(spark, sf):
    return V.calculated(volume_parcels(spark, sf), volume_buildings(spark, sf), TILE, floor_height=2.5).select(*VCOLS)


@query("E7_calculated_volume_whole", "lots buildings", f"WITH {VPAIR}, kp AS (SELECT rid, bid, whole AS part, num_floors FROM pr WHERE part / whole > 0.5), {VCALC}")
def calculated_whole(spark, sf):
    return V.calculated(volume_parcels(spark, sf), volume_buildings(spark, sf), TILE, rule="umbral50", floor_height=2.5).select(*VCOLS)


EXIST = f"""{VPAIR}, ex AS (SELECT *, greatest(1, coalesce(round_even(num_floors, 0), round_even(height / 3.5, 0), 1)) AS f, CASE WHEN num_floors IS NOT NULL THEN 'overture_num_floors' WHEN height IS NOT NULL THEN 'overture_height' ELSE 'estimado' END AS src FROM pr WHERE part / whole > 0.5),
    e AS (SELECT rid, count(*) AS n, sum(whole) AS h, sum(whole * f) AS m2, min(src) AS s0, max(src) AS s1, bool_or(src = 'estimado') AS low FROM ex GROUP BY rid)"""


@query("E17_existing_volume", "lots buildings", f"""WITH {EXIST} SELECT l.rid, coalesce(n, 0) AS n_edificios, round_even(coalesce(h, 0), 1) AS huella_m2, round_even(coalesce(m2, 0), 1) AS m2_existente, round_even(m2 / h, 2) AS pisos_est,
    CASE WHEN s0 = s1 THEN s0 WHEN n > 0 THEN 'mixto' END AS fuente_pisos, CASE WHEN low THEN 'baja' WHEN n > 0 THEN 'media' END AS confianza_pisos, coalesce(low, false) AS cota_inferior, round_even((x1 - x0) * (y1 - y0), 1) AS sup_terreno_m2 FROM lots l LEFT JOIN e USING (rid)""")
def existing(spark, sf):
    return V.existing(volume_parcels(spark, sf), volume_buildings(spark, sf), TILE)


NORM = """CASE WHEN rid % 7 <> 0 THEN '0,6' END AS ocupacion_max, CASE WHEN rid % 3 = 0 THEN '1' ELSE '3.5' END AS constructibilidad_max, CASE WHEN rid % 4 <> 0 THEN '14 m' END AS altura_max_m,
    CASE WHEN rid % 8 = 0 THEN '2 pisos' END AS altura_max_pisos, CASE WHEN rid % 5 = 1 THEN '4' END AS altura_piso_ref_m, CASE rid % 6 WHEN 0 THEN '5.0 frente a via; 3.0 resto' WHEN 1 THEN '400' END AS antejardin_m,
    CASE WHEN rid % 4 = 3 THEN '4,5' END AS distanciamiento_m"""


def norms(spark, sf):
    return relation(spark, sf, "lots").selectExpr("rid", "0 AS nid", *re.split(r",\s*(?=CASE)", NORM), "'aislado' AS agrupamiento", "CASE WHEN rid % 2 = 0 THEN 'VALIDADO' ELSE 'BORRADOR' END AS estado", "concat('Plan ', CAST(floor(m / 7) AS BIGINT)) AS ipt_nombre", "'ZH1' AS zona")


POSSIBLE = f"""nm AS (SELECT rid, x1 - x0 AS bw, y1 - y0 AS bh, CASE WHEN rid % 7 <> 0 THEN 0.6 END::DOUBLE AS occ, (CASE WHEN rid % 3 = 0 THEN 1 ELSE 3.5 END)::DOUBLE AS cons, (CASE WHEN rid % 4 <> 0 THEN 14 END)::DOUBLE AS am, CASE WHEN rid % 8 = 0 THEN 2 END AS ap,
    (CASE WHEN rid % 5 = 1 THEN 4 ELSE 3.5 END)::DOUBLE AS href, greatest(CASE rid % 6 WHEN 0 THEN 3 WHEN 1 THEN 400 ELSE 0 END, CASE WHEN rid % 4 = 3 THEN 4.5 ELSE 0 END)::DOUBLE AS rt FROM lots),
    ps AS (SELECT *, bw * bh AS t, greatest(bw - 2 * rt, 0) * greatest(bh - 2 * rt, 0) AS base, coalesce(ap, floor(am / href + 1e-9)) AS fl, occ IS NULL OR (am IS NULL AND ap IS NULL) AS lack FROM nm),
    pq AS (SELECT *, least(base, occ * t) * fl AS bh2, cons * t AS bi, occ * t * coalesce(am, fl * href) AS vm FROM ps),
    po AS (SELECT rid, CASE WHEN lack THEN 'sin_dato' WHEN base <= 0 THEN 'sin_base' WHEN vm + 1e-6 < least(bh2, bi) * href THEN 'error_datos' ELSE 'ok' END AS estado, CASE WHEN NOT lack THEN rt END AS retranqueo_m2, CASE WHEN NOT lack THEN round_even(base, 1) END AS area_base_m2, CASE WHEN NOT lack THEN CAST(fl AS INT) END AS pisos_max,
      CASE WHEN NOT lack THEN round_even(least(bh2, bi), 1) END AS m2_max, CASE WHEN NOT lack THEN CASE WHEN bh2 <= bi THEN 'ocupación × altura' ELSE 'constructibilidad' END END AS limita, CASE WHEN NOT lack THEN round_even(vm, 1) END AS v_max_m3, CASE WHEN NOT lack THEN round_even(least(bh2, bi) * href, 1) END AS v_opt_m3 FROM pq)"""


@query("M1_I30_possible_envelope", "lots", f"WITH {POSSIBLE} SELECT * FROM po")
def possible(spark, sf):
    p = V.possible(volume_parcels(spark, sf).select("rid", "geom"), norms(spark, sf))
    return p.select("rid", "estado", F.col("retranqueo_m").alias("retranqueo_m2"), "area_base_m2", "pisos_max", "m2_max", "limita", "v_max_m3", "v_opt_m3")


@query("M2_compare_volumes", "lots buildings", f"""WITH {EXIST}, {POSSIBLE}, c AS (SELECT po.rid, po.m2_max, po.estado, round_even(coalesce(e.m2, 0), 1) AS have FROM po LEFT JOIN e USING (rid))
    SELECT rid, CASE WHEN estado = 'ok' AND m2_max <> 0 THEN round_even(have / m2_max, 3) END AS iov, CASE WHEN estado = 'ok' AND m2_max <> 0 THEN round_even(m2_max - have, 1) END AS remanente_m2,
    CASE WHEN estado <> 'ok' OR m2_max = 0 THEN 'sin_dato' WHEN have / m2_max < 0.8 THEN 'holgura' WHEN have / m2_max <= 1 THEN 'al_limite' ELSE 'excede' END AS estado_iov FROM c""")
def compared(spark, sf):
    lots = volume_parcels(spark, sf)
    return V.compare(V.existing(lots, volume_buildings(spark, sf), TILE), V.possible(lots.select("rid", "geom"), norms(spark, sf))).select("rid", "iov", "remanente_m2", "estado_iov")


ZONE_POSSIBLE = POSSIBLE.replace("FROM lots)", "FROM zl)").replace("rid % ", "r0 % ")


@query("M3_parcel_volume", "feat_base feat lots buildings", f"""WITH {EXIST}, sh AS (SELECT l.rid, f.fuente, f.ipt_tipo, f.ipt_nombre, f.zona, f.cut, sum((least(f.x1, l.x1) - greatest(f.x0, l.x0)) * (least(f.y1, l.y1) - greatest(f.y0, l.y0))) AS a
    FROM lots l JOIN feat f ON f.x0 < l.x1 AND f.x1 > l.x0 AND f.y0 < l.y1 AND f.y1 > l.y0 AND f.m BETWEEN l.m - 12 AND l.m + 1 GROUP BY 1, 2, 3, 4, 5, 6),
    z AS (SELECT rid, arg_min(struct_pack(c := fuente, i := ipt_nombre, z := zona), (-a, coalesce(fuente, ''), coalesce(zona, ''))) AS z, count(*) AS n_zonas FROM sh GROUP BY rid),
    zn AS (SELECT concat('Plan ', CAST(CAST(floor(m / 7) AS BIGINT) AS VARCHAR)) AS ipt, min(rid) AS r0 FROM lots GROUP BY 1),
    zl AS (SELECT l.rid, zn.r0, l.x0, l.y0, l.x1, l.y1 FROM lots l JOIN z ON z.rid = l.rid AND z.z.z = 'ZH1' JOIN zn ON zn.ipt = z.z.i),
    {ZONE_POSSIBLE}
    SELECT z.rid, z.z.c AS clase, z.z.i AS ipt_nombre, z.z.z AS zona, z.n_zonas, coalesce(e.n, 0) AS n_edificios, round_even(coalesce(e.m2, 0), 1) AS m2_existente,
    po.estado AS estado_norma, po.m2_max, CASE WHEN po.estado = 'ok' AND m2_max <> 0 THEN round_even(round_even(coalesce(e.m2, 0), 1) / m2_max, 3) END AS iov,
    CASE WHEN po.rid IS NULL THEN NULL WHEN po.estado <> 'ok' OR m2_max = 0 THEN 'sin_dato' WHEN round_even(coalesce(e.m2, 0), 1) / m2_max < 0.8 THEN 'holgura' WHEN round_even(coalesce(e.m2, 0), 1) / m2_max <= 1 THEN 'al_limite' ELSE 'excede' END AS estado_iov,
    coalesce(zl.r0 % 2 <> 0, false) AS borrador FROM z LEFT JOIN e USING (rid) LEFT JOIN po ON po.rid = z.rid LEFT JOIN zl ON zl.rid = z.rid""")
def parcel_volume(spark, sf):
    from zonaria.operators import cards as K

    layer = shaped(spark, sf, "feat").withColumnRenamed("gid", "pid").withColumn("clase", F.col("fuente"))
    lots = shaped(spark, sf, "lots").select(F.col("rid").alias("qid"), "geom")
    rows = norms(spark, sf)
    rest = [c for c in rows.columns if c not in ("rid", "ipt_nombre", "zona")]
    rules = rows.groupBy("ipt_nombre", "zona").agg(F.min_by(F.struct(*rest), "rid").alias("n")).select("ipt_nombre", "zona", "n.*")    # the norms of every zone
    v = K.parcel_volume(lots, layer, rules, volume_buildings(spark, sf), TILE)
    return v.select("rid", "clase", "ipt_nombre", "zona", "n_zonas", "n_edificios", "m2_existente", "estado_norma", "m2_max", "iov", "estado_iov", F.col("marca").isNotNull().alias("borrador"))


@query("E22_C15_zone_candidates", "feat_base feat lots buildings", """WITH z AS (SELECT * FROM feat WHERE ipt_tipo = 'PRC' AND ipt_nombre = 'Plan 1'),
    b AS (SELECT z.zona, count(*) AS nb, round_even(100 * count(b.height) / count(*), 1) AS ph FROM z JOIN buildings b ON (b.x0 + b.x1) / 2 > z.x0 AND (b.x0 + b.x1) / 2 < z.x1 AND (b.y0 + b.y1) / 2 > z.y0 AND (b.y0 + b.y1) / 2 < z.y1 GROUP BY 1),
    p AS (SELECT z.zona, count(*) AS np FROM z JOIN lots b ON (b.x0 + b.x1) / 2 > z.x0 AND (b.x0 + b.x1) / 2 < z.x1 AND (b.y0 + b.y1) / 2 > z.y0 AND (b.y0 + b.y1) / 2 < z.y1 GROUP BY 1),
    s AS (SELECT zona, arg_min(zona_desc, gid) FILTER (WHERE zona_desc IS NOT NULL) AS descripcion, sum((x1 - x0) * (y1 - y0)) AS m2, sum(CASE WHEN riesgo THEN (x1 - x0) * (y1 - y0) ELSE 0 END) AS r, count(*) AS piezas FROM z GROUP BY 1)
    SELECT s.zona, descripcion, round_even(m2 / 1e4, 2) AS ha, coalesce(np, 0) AS n_predios, coalesce(nb, 0) AS n_footprints, ph AS pct_con_altura, round_even(100 * r / m2, 1) AS pct_riesgo, piezas, 'no' AS ordenanza_portal
    FROM s LEFT JOIN b ON b.zona = s.zona LEFT JOIN p ON p.zona = s.zona""")
def candidates(spark, sf):
    pieces = shaped(spark, sf, "feat").withColumnRenamed("gid", "pid")
    links = pieces.select("ipt_tipo", "ipt_nombre", F.lit(None).cast("string").alias("ordenanza_url"))
    c = V.zone_candidates(pieces, "plan_1", volume_buildings(spark, sf), shaped(spark, sf, "lots"), links, TILE)
    return c.drop("residencial", "ordenanza_url", "cut")


@query("B20_norm_template", "feat_base feat", "SELECT ipt_nombre, zona, count(*) AS filas FROM (SELECT DISTINCT ipt_nombre, zona FROM feat WHERE zona IS NOT NULL) GROUP BY ALL")
def template(spark, sf):
    keys = relation(spark, sf, "feat").where("zona IS NOT NULL").select("ipt_nombre", "zona").distinct()
    have = keys.where("zona = 'ZH1'").select("*", *[F.lit("").alias(c) for c in V.NORM_COLUMNS[2:]])
    return V.add_norm_template(have, keys.withColumn("zona", F.concat(F.lit(" "), F.lower("zona")))).groupBy("ipt_nombre", F.upper(F.trim("zona")).alias("zona")).agg(F.count("*").alias("filas"))


def raw_buildings(spark, sf):
    b = shaped(spark, sf, "buildings")
    src = F.array(F.struct(F.lit("").alias("property"), F.expr("CASE WHEN bid % 5 <> 0 THEN class END").alias("dataset")))
    copies = b.withColumn("geom", F.when(F.col("bid") % 50 == 7, F.slice(F.col("geom"), 1, 0)).otherwise(F.col("geom")))
    both = copies.unionByName(copies.where("bid % 3 = 0"))
    return both.select(F.col("bid").alias("id"), F.col("height").cast("string").alias("height"), F.expr("coalesce(CAST(num_floors AS STRING), 'n/a')").alias("num_floors"), "class", F.lit("x").alias("subtype"), src.alias("sources"), F.lit("techo").alias("roof_color"), "geom")


@query("C14_normalised_buildings", "buildings", "SELECT CAST(bid AS VARCHAR) AS id, height, num_floors, class, CASE WHEN bid % 5 <> 0 THEN class END AS fuente FROM buildings WHERE bid % 50 <> 7")
def normalised(spark, sf):
    return B.normalise(raw_buildings(spark, sf)).select("id", "height", "num_floors", "class", "fuente")


@query("B8_E11_region_manifest", "buildings comunas", """WITH a AS (SELECT id, arg_min(region, (-a, cut)) AS region FROM (SELECT b.bid AS id, c.cut, c.region, (least(c.x1, b.x1) - greatest(c.x0, b.x0)) * (least(c.y1, b.y1) - greatest(c.y0, b.y0)) AS a
    FROM buildings b JOIN comunas c ON b.x0 < c.x1 AND b.x1 > c.x0 AND b.y0 < c.y1 AND b.y1 > c.y0) GROUP BY id)
    SELECT count(*) AS n_en_bbox, count(*) FILTER (WHERE region = 'Región 1') AS n_edificios, count(*) FILTER (WHERE region IS NULL) AS fuera_de_la_dpa, count(*) FILTER (WHERE region <> 'Región 1') AS de_otras_regiones FROM buildings b LEFT JOIN a ON a.id = b.bid""")
def region_manifest(spark, sf):
    b = volume_buildings(spark, sf)
    return B.region_manifest(B.footprint_table(b, shaped(spark, sf, "comunas"), TILE), b, "Región 1")


@query("E11_footprint_counts", "buildings comunas", "SELECT region, cut, comuna, count(*) AS n FROM buildings b JOIN comunas c ON c.k = b.m GROUP BY ALL")
def footprint_counts(spark, sf):
    return B.comuna_counts(B.footprint_table(volume_buildings(spark, sf), shaped(spark, sf, "comunas"), TILE))


@query("A10_complete_regions", sql="SELECT DISTINCT concat('r', CAST(s_nationkey AS VARCHAR)) AS region FROM supplier WHERE s_acctbal > 1000 AND s_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9000)")
def complete(spark, sf):
    m = table(spark, sf, "supplier").select(F.concat(F.lit("r"), F.col("s_nationkey").cast("string")).alias("region"), (F.col("s_acctbal") > 1000).alias("completa"))
    return B.complete_regions(m, table(spark, sf, "customer").where("c_acctbal > 9000").select(F.concat(F.lit("r"), F.col("c_nationkey").cast("string")).alias("region")))


@query("B18_pending_work", sql="SELECT DISTINCT c_nationkey AS region, 'v2' AS release FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)")
def pending(spark, sf):
    work = table(spark, sf, "customer").select(F.col("c_nationkey").alias("region"), F.lit("v2").alias("release")).distinct()
    return B.pending_regions(work, table(spark, sf, "supplier").select(F.col("s_nationkey").alias("region"), F.lit("v2").alias("release"), (F.col("s_acctbal") > 5000).alias("completa")))


@query("A1_comuna_scan", "comunas", "SELECT lpad(CAST(k % 99999 AS VARCHAR), 5, '0') AS cut, comuna, region FROM comunas WHERE region IN ('Región 1', 'Región 3')")
def comuna_scan(spark, sf):
    c = shaped(spark, sf, "comunas").select((F.col("k") % 99999).alias("cod_comuna"), F.col("comuna").alias("Comuna"), F.col("region").alias("Region"), "geom")
    return L.read_comunas(c, "cod_comuna", "Comuna", "Region", pattern="REGION (1|3)").drop("geom")


@query("E21_G6_comuna_boxes", "comunas", "SELECT region, min(x0) AS xmin, min(y0) AS ymin, max(x1) AS xmax, max(y1) AS ymax FROM comunas GROUP BY region")
def boxes(spark, sf):
    b = shaped(spark, sf, "comunas").select("region", "comuna", G.bbox(F.col("geom")).alias("b")).orderBy(X.norm_text(F.col("comuna")))
    return b.groupBy("region").agg(F.min("b.xmin").alias("xmin"), F.min("b.ymin").alias("ymin"), F.max("b.xmax").alias("xmax"), F.max("b.ymax").alias("ymax"))


@query("E21_boxes_with_margin", "comunas", "SELECT region, min(x0) - 200 AS xmin, min(y0) - 200 AS ymin, max(x1) + 200 AS xmax, max(y1) + 200 AS ymax FROM comunas GROUP BY region")
def boxes_with_margin(spark, sf):
    return BO.group_boxes(shaped(spark, sf, "comunas"), ["region"], 200.0)


@query("G6_comuna_list", "comunas", "SELECT cut, comuna AS nombre, region, x0 AS xmin, y0 AS ymin, x1 AS xmax, y1 AS ymax FROM comunas")
def comuna_list(spark, sf):
    return BO.comuna_list(shaped(spark, sf, "comunas")).select("cut", "nombre", "region", *[F.get("bbox", F.lit(i)).alias(c) for i, c in enumerate(("xmin", "ymin", "xmax", "ymax"))])


@query("B2_geojson_wgs84", "comunas", f"SELECT cut, [[lon, lat], [lon + 0.01, lat], [lon + 0.01, lat + 0.01], [lon, lat + 0.01], [lon, lat]] AS anillo FROM (SELECT cut, CAST(-71 - (k % 200) / 100.0 AS DOUBLE) AS lon, CAST(-30 - (k % 1000) / 100.0 AS DOUBLE) AS lat FROM comunas)".replace("lon + 0.01", "round(lon + 0.01, 6)").replace("lat + 0.01", "round(lat + 0.01, 6)"))
def geojson_wgs84(spark, sf):
    """Metric shapes wound the wrong way round, written in lon/lat."""
    c = relation(spark, sf, "comunas").select("cut", F.expr("CAST(-71 - (k % 200) / 100.0D AS DOUBLE)").alias("lon"), F.expr("CAST(-30 - (k % 1000) / 100.0D AS DOUBLE)").alias("lat"))
    box = G.box(F.col("lon"), F.col("lat"), F.col("lon") + 0.01, F.col("lat") + 0.01)
    metric = c.select("cut", CR.to_albers(F.transform(box, lambda poly: F.transform(poly, F.reverse)), 6).alias("geom"))
    j = sinks.in_lonlat(metric)
    text = j.select("cut", sinks.feature_json(j).alias("j"))
    return text.select("cut", F.from_json(F.get_json_object("j", "$.geometry.coordinates[0][0]"), "array<array<double>>").alias("anillo"))


@query("B2_geojson_features", "feat_base feat", "SELECT gid, 'MultiPolygon' AS tipo, CAST(x0 AS DOUBLE) AS x, zona FROM feat")
def geojson(spark, sf):
    df = shaped(spark, sf, "feat").withColumn("attrs_raw", F.lit("{}"))
    j = df.select(sinks.feature_json(df.select("gid", "zona", "attrs_raw", "geom")).alias("j"))
    return j.select(F.get_json_object("j", "$.properties.gid").cast("bigint").alias("gid"), F.get_json_object("j", "$.geometry.type").alias("tipo"),
                    F.get_json_object("j", "$.geometry.coordinates[0][0][0][0]").cast("double").alias("x"), F.get_json_object("j", "$.properties.zona").alias("zona"))


@query("B1_export_checks", "feat_base feat", "SELECT count(*) AS piezas, count(*) FILTER (WHERE gid % 13 = 0) AS piezas_invalidas, count(*) FILTER (WHERE gid % 17 = 5) AS piezas_degeneradas FROM feat WHERE gid % 13 <> 0 OR gid % 17 <> 5")
def export_checks(spark, sf):
    df = shaped(spark, sf, "feat").where("gid % 13 <> 0 OR gid % 17 <> 5")
    ring = F.get(F.get(F.col("geom"), F.lit(0)), F.lit(0))
    bow = F.array(F.array(F.array(ring[0], ring[2], ring[1], ring[3], ring[0])))
    return sinks.export_checks(df.withColumn("geom", F.when(F.col("gid") % 13 == 0, bow).when(F.col("gid") % 17 == 5, F.slice("geom", 1, 0)).otherwise(F.col("geom"))))


@query("B15_tile_fields", "feat_base feat", "SELECT gid, left(zona, 90) AS zona, CAST(riesgo AS INT) AS riesgo FROM feat")
def tile_fields(spark, sf):
    return sinks.tile_fields(relation(spark, sf, "feat")).select("gid", "zona", "riesgo")


@query("A17_pushed_lookup", "lots", """WITH w AS (SELECT arg_min(x0, (hash_order, rid)) AS wx, arg_min(y0, (hash_order, rid)) AS wy FROM (SELECT *, rid * 7919 % 10007 AS hash_order FROM lots))
    SELECT rid FROM lots, w WHERE x0 <= wx + 900 AND x1 >= wx - 900 AND y0 <= wy + 900 AND y1 >= wy - 900""")
def pushed_lookup(spark, sf):
    """Parcels written in order of comuna and place with covering boxes, read back for one window whose box reaches the scan."""
    lots = relation(spark, sf, "lots")
    corner = lots.agg(F.min_by(F.struct("x0", "y0"), F.struct(F.col("rid") * 7919 % 10007, F.col("rid"))).alias("c"), F.max("x1").alias("x"), F.max("y1").alias("y")).first()
    home = f"{shared_folder(spark).rstrip('/')}/parcels-{uuid.uuid4().hex}"
    sinks.write_parcels(shaped(spark, sf, "lots").select("rid", "cut", "geom"), home, (0.0, 0.0, float(corner.x), float(corner.y)), by_comuna=False)
    x, y = corner.c.x0, corner.c.y0
    return J.box_filter(spark.read.parquet(home), x - 900, y - 900, x + 900, y + 900).select("rid")


@query("G3_truncated_view", "buildings", """SELECT bid AS id, true AS recortado FROM (SELECT bid, row_number() OVER (ORDER BY bid) AS n FROM buildings WHERE x0 / 1e5 <= 0.05 AND x1 / 1e5 >= 0.01 AND y0 / 1e5 <= 0.012 AND y1 / 1e5 >= 0.001) WHERE n <= 25""")
def truncated(spark, sf):
    """A view that holds more buildings than it may show: the first by id, and the mark."""
    b = shaped(spark, sf, "buildings").withColumn("area_m2", half_even(G.area(F.col("geom")), 1)).withColumnRenamed("bid", "id").withColumn("fuente", F.lit("x"))
    b = b.withColumn("geom", G.map_points(F.col("geom"), lambda x, y: x / 1e5, lambda x, y: y / 1e5)).withColumn("bbox", G.bbox(F.col("geom")))
    return B.window_view(b, (0.01, 0.001, 0.05, 0.012), limit=25).select("id", "recortado")


@query("G3_visible_buildings", "buildings", """SELECT bid AS id, round_even(coalesce(height, num_floors * 3.5, 3.5), 1) AS altura_est, round_even((x1 - x0) * (y1 - y0), 1) AS area_m2 FROM buildings WHERE x0 / 1e5 <= 0.05 AND x1 / 1e5 >= 0.01 AND y0 / 1e5 <= 0.012 AND y1 / 1e5 >= 0.001""")
def visible(spark, sf):
    b = shaped(spark, sf, "buildings").withColumn("area_m2", half_even(G.area(F.col("geom")), 1)).withColumnRenamed("bid", "id").withColumn("fuente", F.lit("x"))
    b = b.withColumn("geom", G.map_points(F.col("geom"), lambda x, y: x / 1e5, lambda x, y: y / 1e5)).withColumn("bbox", G.bbox(F.col("geom")))
    return B.window_view(b, (0.01, 0.001, 0.05, 0.012)).select("id", "altura_est", "area_m2")


@query("E16_sampled_vote", "lots comunas", """WITH x AS (SELECT floor(rid / 40) AS archivo, *, row_number() OVER (PARTITION BY floor(rid / 40) ORDER BY rid) - 1 AS i, count(*) OVER (PARTITION BY floor(rid / 40)) AS n FROM lots),
    s AS (SELECT * FROM x WHERE i % CAST(ceil(n / 9) AS BIGINT) = 0), v AS (SELECT s.archivo, c.cut FROM s LEFT JOIN comunas c ON (s.x0 + s.x1) / 2 > c.x0 AND (s.x0 + s.x1) / 2 < c.x1 AND (s.y0 + s.y1) / 2 > c.y0 AND (s.y0 + s.y1) / 2 < c.y1),
    n AS (SELECT archivo, cut, count(*) AS n FROM v WHERE cut IS NOT NULL GROUP BY 1, 2), b AS (SELECT archivo, arg_min(cut, (-n, cut)) AS cut, max(n) AS n FROM n GROUP BY 1), t AS (SELECT archivo, count(*) AS t FROM v GROUP BY 1)
    SELECT CAST(t.archivo AS BIGINT) AS archivo, b.cut, round_even(coalesce(n, 0) / t, 3) AS participacion, b.cut IS NOT NULL AND round_even(coalesce(n, 0) / t, 3) >= 0.9 AS ok FROM t LEFT JOIN b ON t.archivo = b.archivo""")
def sampled_vote(spark, sf):
    """Backups of forty lots, which straddle comunas; nine points or fewer decide."""
    raw = shaped(spark, sf, "lots").select(F.floor(F.col("rid") / 40).alias("archivo"), "rid", "geom")
    return P.assign_cut(raw, shaped(spark, sf, "comunas"), "rid", TILE, sample=9)


@query("A12_local_parcels", "lots roles feat_base feat", """WITH z AS (SELECT * FROM feat WHERE zona = 'ZH1'), x AS (SELECT r.* FROM roles r SEMI JOIN z ON (r.x0 + r.x1) / 2 > z.x0 AND (r.x0 + r.x1) / 2 < z.x1 AND (r.y0 + r.y1) / 2 > z.y0 AND (r.y0 + r.y1) / 2 < z.y1
      WHERE datos_sii AND rol IS NOT NULL AND exacto)
    SELECT id_poligono, CASE WHEN count(DISTINCT rol) = 1 THEN min(rol) ELSE concat(min(rol), ' (+', CAST(count(DISTINCT rol) - 1 AS VARCHAR), ' unidades)') END AS rol, round(sum(sup_construida_m2), 4) AS sup_construida_total,
    count(DISTINCT rol) AS n_unidades, CASE WHEN count(DISTINCT rol) = 1 THEN arg_min(sup_terreno_m2, (rol, row_id)) ELSE arg_min(area_poligono_m2, (rol, row_id)) END AS m2_terreno FROM x GROUP BY 1""")
def local_parcels(spark, sf):
    """Terrains of one zone from the stored parcels."""
    lots = relation(spark, sf, "roles").withColumn("geom", G.box(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))).drop("x", "y", "x0", "y0", "x1", "y1")
    zones = shaped(spark, sf, "feat").select(F.col("gid").alias("pid"), "zona", "geom")
    t = V.local_parcels(lots, TILE, zones, "ZH1")
    return t.select("id_poligono", "rol", F.round("sup_construida_total", 4).alias("sup_construida_total"), "n_unidades", "m2_terreno")

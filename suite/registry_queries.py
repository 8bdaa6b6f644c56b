"""Layer typing, resolution, registry, demand, contracts and review."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from zonaria.functions import geometry as G
from zonaria.operators import cards as K
from zonaria.operators import contracts as CT
from zonaria.operators import demand as D
from zonaria.operators import features as FE
from zonaria.operators import registry as R
from zonaria.operators import schema_rules as SR
from zonaria.operators import review as RV
from zonaria.operators.tiling import deal, spread
from zonaria.plans import catalogue as CA
from zonaria.rules import LandRules
from zonaria.session import shared_folder
from zonaria.sources import layers as L
from zonaria.sources import sinks

from .base import query, relation, shaped, table
from .text_queries import DECREE_CASE, URL_CASE, instruments, norm, tokens_sql

RULES = LandRules()
LAYER = """SELECT l_orderkey, l_linenumber, l_partkey, concat('IPT/', CASE l_suppkey % 9 WHEN 0 THEN 'PRC_Maule' WHEN 1 THEN 'PRI_Area_Rural' WHEN 2 THEN 'Limites_Urbanos' WHEN 3 THEN 'PRDU_Norte' WHEN 4 THEN 'PRMS'
    WHEN 5 THEN 'PRI_Valparaiso' WHEN 6 THEN 'PRC_Nuble' WHEN 7 THEN 'Patrimonio' ELSE 'Otros' END) AS service, CAST(l_partkey % 12 AS INT) AS layer_id,
    concat(CASE l_partkey % 11 WHEN 0 THEN 'PRC_Talca' WHEN 1 THEN 'Límite Urbano' WHEN 2 THEN 'Zona_Típica' WHEN 3 THEN 'Plano_Seccional_Centro' WHEN 4 THEN 'PRMS_Resguardo' WHEN 5 THEN 'Area_AR_1' WHEN 6 THEN 'lu_norte'
      WHEN 7 THEN 'Vialidad' WHEN 8 THEN 'Intercomunal Sur' WHEN 9 THEN 'Plan_Regulador' ELSE 'Hoja' END, CASE WHEN l_linenumber = 7 THEN '_Riesgo' ELSE '' END) AS layer_name,
    CASE WHEN l_linenumber % 2 = 0 THEN 'FeatureServer' ELSE 'MapServer' END AS service_type FROM [lineitem]"""


def catalogue(spark, sf):
    return spark.sql(LAYER.replace("[lineitem]", "{l}"), l=table(spark, sf, "lineitem"))


def cases(rules, column, pick="kind"):
    return " ".join(f"WHEN regexp_matches({column}, '{r.pattern}', 'i') THEN " + (f"'{getattr(r, pick)}'" if getattr(r, pick) else "NULL") for r in rules)


LAYER_SQL = LAYER.replace("[lineitem]", "lineitem")
TYPED = f"""t0 AS ({LAYER_SQL}), t1 AS (SELECT *, CASE {cases(RULES.services, 'service')} END AS sk, CASE {cases(RULES.services, 'service', 'default')} END AS sd, CASE {cases(RULES.priority_layers, 'layer_name')} END AS pk,
    CASE {cases(RULES.layers, 'layer_name')} ELSE 'IGNORAR' END AS lk, service = 'IPT/PRI_Valparaiso' AND layer_id = 6 AS ov FROM t0),
    ty AS (SELECT l_orderkey, l_linenumber, l_partkey, service, layer_id, layer_name, service_type, CASE WHEN ov THEN 'PRI' WHEN sk = 'IGNORAR' THEN 'IGNORAR' WHEN pk IS NOT NULL THEN pk WHEN sk IS NOT NULL THEN sk ELSE lk END AS tipo,
    CASE WHEN ov THEN 'E' WHEN sk = 'IGNORAR' OR pk IS NOT NULL THEN NULL WHEN sk IS NOT NULL THEN sd END AS pri_default FROM t1)"""


@query("C1_layer_typing", sql=f"WITH {TYPED} SELECT * FROM ty")
def typing(spark, sf):
    return FE.type_layers(catalogue(spark, sf), RULES)


@query("E19_type_counts", sql=f"WITH {TYPED} SELECT tipo, count(*) AS capas FROM ty GROUP BY 1")
def type_counts(spark, sf):
    return FE.type_counts(FE.typed_layers(catalogue(spark, sf), RULES))


@query("C2_catalogue_dedupe", sql=f"WITH {TYPED} SELECT service, layer_name, arg_min(service_type, (service_type <> 'MapServer', layer_id)) AS service_type, arg_min(layer_id, (service_type <> 'MapServer', layer_id)) AS layer_id FROM ty GROUP BY 1, 2")
def dedupe(spark, sf):
    return FE.dedupe_catalogue(catalogue(spark, sf).select("service", "layer_name", "service_type", "layer_id"))


@query("A5_kept_catalogue", sql=f"WITH {TYPED} SELECT service, count(*) AS capas FROM ty WHERE tipo <> 'IGNORAR' GROUP BY 1")
def kept(spark, sf):
    # a plain condition on the type would be pushed below the count and be tried on every row
    kept_rows = F.sum(F.when(F.col("tipo") != "IGNORAR", F.col("n")))
    return FE.typed_layers(catalogue(spark, sf), RULES).groupBy("service").agg(kept_rows.alias("capas")).where("capas IS NOT NULL")


@query("A4_service_discovery", sql="SELECT concat('IPT/', p_name, CAST(p_partkey AS VARCHAR)) AS service, CAST(k AS INT) AS layer_id, concat('capa ', CAST(k AS VARCHAR)) AS layer_name, CASE WHEN p_size % 2 = 0 THEN 4326 ELSE 3857 END AS service_wkid FROM part, (SELECT unnest([0, 2]) AS k) WHERE p_brand <> 'Brand#9'")
def discovery(spark, sf):
    box = F.struct(*[F.lit(float(v)).alias(n) for n, v in (("xmin", 0), ("ymin", 0), ("xmax", 1), ("ymax", 1))])
    layer = lambda k, sub: F.struct(F.lit(k).alias("id"), F.lit(f"capa {k}").alias("name"), sub.cast("array<int>").alias("subLayerIds"))
    services = table(spark, sf, "part").select(
        F.concat(F.lit("IPT/"), "p_name", F.col("p_partkey").cast("string")).alias("name"), F.when(F.col("p_brand") == "Brand#9", "ImageServer").otherwise("MapServer").alias("type"),
        F.struct(F.when(F.col("p_size") % 2 == 0, 4326).otherwise(102100).alias("wkid"), F.when(F.col("p_size") % 2 == 1, 3857).alias("latestWkid")).alias("spatialReference"),
        box.alias("fullExtent"), box.alias("initialExtent"), F.array(layer(0, F.lit(None)), layer(1, F.array(F.lit(2))), layer(2, F.array())).alias("layers"))
    return L.discover(services).select("service", "layer_id", "layer_name", "service_wkid")


@query("A6_cached_counts", sql="SELECT p_partkey AS layer_id, n AS features FROM part LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_partkey = p_partkey")
def cached(spark, sf):
    cat = table(spark, sf, "part").select(F.lit("s").alias("service"), F.col("p_partkey").alias("layer_id"))
    return FE.cached_counts(cat, table(spark, sf, "lineitem").select(F.lit("s").alias("service"), F.col("l_partkey").alias("layer_id"))).select("layer_id", "features")


@query("C11_service_extent_filter", "feat_base feat", "SELECT gid FROM feat WHERE gid % 10 = 0 OR gid % 3 = 2 OR (x0 <= 9000 AND x1 >= 4000 AND y0 <= 2500 AND y1 >= 0)")
def extent(spark, sf):
    e = F.struct(F.col("x0").alias("xmin"), F.col("y0").alias("ymin"), F.col("x1").alias("xmax"), F.col("y1").alias("ymax"))
    cat = relation(spark, sf, "feat").select("gid", F.when(F.col("gid") % 3 == 2, 9999).otherwise(4326).alias("service_wkid"), F.when(F.col("gid") % 10 != 0, e).alias("service_extent"))
    box = relation(spark, sf, "comunas").where("k = 0").select(F.lit(4326).alias("wkid"), F.lit(4000.0).alias("xmin"), F.lit(0.0).alias("ymin"), F.lit(9000.0).alias("xmax"), F.lit(2500.0).alias("ymax"))
    return FE.extent_overlaps(cat, box).select("gid")


@query("C12_selected_layers", sql="SELECT CAST(s_suppkey AS VARCHAR) AS key, s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_linenumber = 7) AS existe FROM supplier")
def selected(spark, sf):
    cat = table(spark, sf, "lineitem").where("l_linenumber = 7").select(F.lit("s").alias("service"), F.col("l_suppkey").alias("layer_id"))
    wanted = table(spark, sf, "supplier").select(F.concat(F.lit("s/"), F.col("s_suppkey").cast("string")).alias("key"))
    found, lacking = FE.select_layers(cat, wanted)
    both = found.select("key").distinct().withColumn("existe", F.lit(True)).unionByName(lacking.withColumn("existe", F.lit(False)))
    return both.select(F.substring_index("key", "/", -1).alias("key"), "existe")


FEATURE = """SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'PRC' WHEN 1 THEN 'PRI' WHEN 2 THEN 'PRM' WHEN 3 THEN 'AFECTACION' ELSE 'SECCIONAL' END AS tipo, CASE WHEN doc_id % 4 = 1 THEN 'E' END AS pri_default,
    CASE WHEN doc_id % 6 = 1 THEN 'IPT/PRI_Area_Rural' ELSE 'IPT/PRC_x' END AS servicio, concat('Capa ', CASE WHEN doc_id % 17 = 3 THEN 'de riesgó' ELSE source END) AS capa, CASE WHEN doc_id % 9 = 1 THEN 'límite-urbano' ELSE lang END AS ipt_nombre,
    CASE doc_id % 8 WHEN 0 THEN 'ZEU-1' WHEN 1 THEN 'ZR 2' WHEN 2 THEN 'APP 1' WHEN 3 THEN 'ZU_3' WHEN 4 THEN 'Límite de Extensión Urbana' WHEN 5 THEN NULL ELSE substr(text, 1, 12) END AS zona,
    CASE WHEN doc_id % 3 = 0 THEN concat(text, ' riesgo ') WHEN doc_id % 3 = 1 THEN text END AS zona_desc FROM [documents]"""


def feature_rows(spark, sf):
    return spark.sql(FEATURE.replace("[documents]", "{d}"), d=deal(table(spark, sf, "documents")))


SUBTEXT = f"concat({norm('coalesce(zona, $$$$)')}, ' ', {norm('coalesce(zona_desc, $$$$)')})"
SUB = f"CASE " + " ".join(f"WHEN regexp_matches(txt, '{p}') THEN '{n}'" for n, p in RULES.subclasses) + " END"
FEATURES_SQL = f"""f0 AS ({FEATURE.replace('[documents]', 'documents')}), f1 AS (SELECT *, {SUBTEXT} AS txt, {norm('coalesce(zona, $$$$)')} AS nz FROM f0), f2 AS (SELECT *, {SUB} AS sub, tipo IN ('PRI', 'PRM') AS inter,
    tipo IN ('PRI', 'PRM') AND regexp_matches(concat(servicio, '/', capa), '/PRI_Area_Rural/', 'i') AS env, (regexp_matches({norm('capa')}, 'RIESGO') OR regexp_matches(txt, 'RIESGO')) AND NOT regexp_matches(nz, '^APP\\b') AS riesgo,
    CASE WHEN {norm('ipt_nombre')} = 'LIMITE URBANO' AND nz = 'LIMITE DE EXTENSION URBANA' THEN 'E' END AS man FROM f1),
    fs AS (SELECT doc_id, riesgo, CASE WHEN man IS NOT NULL AND inter THEN 'PRI_' || man WHEN env THEN 'PRI_ENV' WHEN inter THEN 'PRI_' || coalesce(sub, pri_default, 'R') ELSE tipo END AS fuente,
    CASE WHEN man IS NOT NULL AND inter THEN 0 WHEN env THEN 4 WHEN riesgo AND tipo <> 'AFECTACION' THEN 3 WHEN NOT inter OR sub IS NOT NULL THEN 0 WHEN pri_default IS NOT NULL THEN 2 ELSE 1 END AS rango,
    inter AND NOT env AND NOT (riesgo AND tipo <> 'AFECTACION') AND sub IS NULL AND pri_default IS NULL AND man IS NULL AS revisar FROM f2)"""


@query("C6_C7_C8_C9_source_fields", sql=f"WITH {FEATURES_SQL} SELECT * FROM fs")
def source_fields(spark, sf):
    return FE.source_fields(feature_rows(spark, sf), RULES).select("doc_id", "riesgo", "fuente", "rango", "revisar")


@query("C10_split_affectations", sql=f"WITH {FEATURES_SQL} SELECT 'particion' AS lado, doc_id FROM fs WHERE fuente <> 'AFECTACION' UNION ALL SELECT 'afectaciones', doc_id FROM fs WHERE fuente = 'AFECTACION' OR riesgo")
def split(spark, sf):
    part, aff = FE.split_affectations(FE.source_fields(feature_rows(spark, sf), RULES))
    return part.select(F.lit("particion").alias("lado"), "doc_id").unionByName(aff.select(F.lit("afectaciones").alias("lado"), "doc_id"))


@query("C4_layer_fields", sql="""WITH k AS (SELECT source, lang FROM documents GROUP BY 1, 2) SELECT source, CASE WHEN bool_or(lang = 'es') THEN 'zona' WHEN bool_or(lang = 'fr') THEN 'Nombre' END AS zone_field,
    CASE WHEN bool_or(lang = 'de') THEN 'uso' END AS description_field, CASE WHEN bool_or(lang = 'en') THEN 'Comuna' END AS comuna_field FROM k GROUP BY 1""")
def layer_fields(spark, sf):
    props = F.create_map(F.expr("CASE lang WHEN 'es' THEN 'zona' WHEN 'fr' THEN 'Nombre' WHEN 'de' THEN 'uso' ELSE 'Comuna' END"), F.col("text"))
    raw = table(spark, sf, "documents").select(F.col("source").alias("service"), F.lit(0).alias("layer_id"), props.alias("properties"))
    return FE.layer_fields(raw, RULES).select(F.col("service").alias("source"), "zone_field", "description_field", "comuna_field")


@query("D14_comuna_from_text", "comunas", """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN lpad(CAST(o_custkey % 100 AS VARCHAR), 5, '0') WHEN 1 THEN lpad(CAST(o_custkey % 100 AS VARCHAR), 5, '0') WHEN 2 THEN lpad(CAST(o_custkey % 10 AS VARCHAR), 5, '0') END AS cut
    FROM orders WHERE o_orderkey % 4 <> 3""")
def resolve(spark, sf):
    comunas = spark.range(0, 100).select(F.lpad(F.col("id").cast("string"), 5, "0").alias("cut"), F.concat(F.lit("Pueblo "), F.col("id").cast("string")).alias("comuna"))
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    text = (F.when(k % 4 == 0, (c % 100).cast("string")).when(k % 4 == 1, F.concat(F.lit("PUEBLO_"), (c % 100).cast("string"), F.lit(" alto sur")))
            .when(k % 4 == 2, F.concat(F.lit(" Puéblo "), (c % 10).cast("string"), F.lit("-flamenco"))).otherwise("Otro lugar"))
    rows = table(spark, sf, "orders").select("o_orderkey", text.alias("value"))
    return rows.join(FE.comuna_lookup(rows, comunas, "value"), "value").select("o_orderkey", "cut")


@query("D15_resolution_cascade", sql="""SELECT c_custkey AS fid, CASE c_custkey % 6 WHEN 0 THEN lpad(CAST(c_nationkey AS VARCHAR), 5, '0') WHEN 1 THEN lpad(CAST(c_nationkey AS VARCHAR), 5, '0') WHEN 2 THEN lpad(CAST(c_nationkey AS VARCHAR), 5, '0') WHEN 3 THEN '00003'
    WHEN 4 THEN lpad(CAST(c_nationkey AS VARCHAR), 5, '0') END AS cut_ipt FROM customer""")
def cascade(spark, sf):
    comunas = table(spark, sf, "nation").select(F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("cut"), F.when(F.col("n_nationkey") == 3, "Treguaco").otherwise(F.replace("n_name", F.lit("_"), F.lit(" "))).alias("comuna"))
    k = F.col("c_custkey") % 6
    name = F.when(F.col("c_nationkey") == 3, "Treguaco").otherwise(F.concat(F.lit("Nation "), F.col("c_nationkey").cast("string")))
    com = F.when(k == 0, F.upper(name)).when(k == 3, "Trehuaco").otherwise("Nada")
    props = F.create_map(F.lit("COM"), com, F.lit("admin"), F.when(k == 1, F.concat(F.lit("Municipalidad de "), name)).otherwise(name),
                         F.lit("NOM"), F.when(k == 2, F.concat(F.lit("Límite urbano de "), name)).otherwise(name))
    rows = table(spark, sf, "customer").select(F.col("c_custkey").alias("fid"), props.alias("properties"), F.lit("COM").alias("comuna_field"), F.when(k == 4, name).otherwise("Capa").alias("ipt_nombre"))
    return FE.resolve_comuna(rows, comunas, RULES).select("fid", "cut_ipt")


@query("A2_homologated_features", sql=f"""WITH b AS (SELECT p_partkey AS fid, CASE p_size % 3 WHEN 0 THEN 'PRC_Maule' WHEN 1 THEN 'PRI_Sur' ELSE 'Limites_Urbanos' END AS sv, p_size % 25 AS n, p_name, p_type, p_size FROM part)
    SELECT fid, CASE p_size % 3 WHEN 0 THEN 'PRC' WHEN 1 THEN 'PRI' ELSE 'LU' END AS ipt_tipo, CASE p_size % 3 WHEN 0 THEN 'Talca' WHEN 1 THEN 'Costa' ELSE 'Límite Urbano NATION ' || n END AS ipt_nombre, p_name AS zona,
    CASE p_size % 3 WHEN 0 THEN 'PRC' WHEN 1 THEN CASE WHEN p_type = 'PROMO' THEN 'PRI_U' ELSE 'PRI_R' END ELSE 'LU' END AS fuente, CASE WHEN p_size % 3 <> 1 THEN lpad(CAST(n AS VARCHAR), 5, '0') END AS cut_ipt FROM b""")
def homologated(spark, sf):
    part = table(spark, sf, "part")
    kind = F.expr("CASE p_size % 3 WHEN 0 THEN 'IPT/PRC_Maule' WHEN 1 THEN 'IPT/PRI_Sur' ELSE 'IPT/Limites_Urbanos' END")
    use = F.when(F.col("p_type") == "PROMO", "zona urbana").otherwise(F.lit(""))
    props = F.create_map(F.lit("Zona"), F.concat(F.lit(" "), "p_name", F.lit(" ")), F.lit("DESCRIP"), use, F.lit("Com"), F.concat(F.lit("nation "), (F.col("p_size") % 25).cast("string")))
    raw = part.select(F.col("p_partkey").alias("fid"), kind.alias("service"), F.lit(0).alias("layer_id"), props.alias("properties"), G.box(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(1.0)).alias("geom"))
    cat = part.select(kind.alias("service")).distinct().select("service", F.lit(0).alias("layer_id"), F.expr("CASE service WHEN 'IPT/PRC_Maule' THEN 'PRC_Talca' WHEN 'IPT/PRI_Sur' THEN 'PRI_Costa' ELSE 'Lim' END").alias("layer_name"), F.lit("u").alias("url"))
    comunas = table(spark, sf, "nation").select(F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("cut"), F.replace("n_name", F.lit("_"), F.lit(" ")).alias("comuna"))
    return FE.homologate(raw, FE.type_layers(cat, RULES), comunas, RULES).select("fid", "ipt_tipo", "ipt_nombre", "zona", "fuente", "cut_ipt")


FAMILIES = f"""ins AS (SELECT id, tipo, denominacion, lpad(CAST(m AS VARCHAR), 10, '0') AS cut, clasificacion, fecha, {DECREE_CASE} AS norma, {URL_CASE} AS url FROM instruments),
    eg AS (SELECT CAST(floor(id / 10) AS BIGINT) AS parent, id AS child FROM ins WHERE id >= 10),
    roots AS (SELECT * FROM ins WHERE (clasificacion = 'Instrumento de origen' OR id NOT IN (SELECT child FROM eg)) AND tipo <> 'PRDU'),
    reach AS (SELECT id AS root, id AS member FROM roots UNION SELECT r.root, e.child FROM reach r JOIN eg e ON e.parent = r.member),
    mem AS (SELECT r.root, i.* FROM reach r JOIN ins i ON i.id = r.member),
    fam AS (SELECT root AS id, count(*) - 1 AS n_modificaciones, max(fecha) FILTER (WHERE id <> root) AS ultima_modificacion, arg_max(norma, (fecha, -id)) FILTER (WHERE id <> root AND fecha IS NOT NULL) AS norma_ultima_modificacion,
            arg_max(url, id) FILTER (WHERE id <> root AND url IS NOT NULL) AS other FROM mem GROUP BY root),
    families AS (SELECT r.id, r.tipo, r.denominacion, r.cut, r.norma, r.fecha, f.ultima_modificacion, f.norma_ultima_modificacion, f.n_modificaciones, coalesce(r.url, f.other) AS ordenanza_url FROM roots r JOIN fam f USING (id))"""


def families(spark, sf):
    return R.families(instruments(spark, sf))


@query("D19_registry_families", "instruments", f"WITH RECURSIVE {FAMILIES} SELECT id, tipo, denominacion, norma, fecha, ultima_modificacion, norma_ultima_modificacion, n_modificaciones, ordenanza_url FROM families")
def family_table(spark, sf):
    return families(spark, sf).drop("planificacion", "comunas")


def server(spark, sf):
    """Instruments found on the server, from the partition features."""
    f = relation(spark, sf, "feat")
    return f.select("cut", "ipt_tipo", F.concat_ws(" ", F.lit("Plan"), F.expr("CASE gid % 3 WHEN 0 THEN 'Valle' WHEN 1 THEN 'Costa' ELSE 'Oriente' END"), (F.col("gid") % 13).cast("string")).alias("ipt_nombre"))


SERVER = "sv AS (SELECT DISTINCT cut, ipt_tipo, concat('Plan ', CASE gid % 3 WHEN 0 THEN 'Valle' WHEN 1 THEN 'Costa' ELSE 'Oriente' END, ' ', CAST(gid % 13 AS VARCHAR)) AS ipt_nombre FROM feat)"
SCORE = f"len(list_intersect({tokens_sql('s.ipt_nombre')}, {tokens_sql('f.denominacion')})) / greatest(1, len(list_distinct(list_concat({tokens_sql('s.ipt_nombre')}, {tokens_sql('f.denominacion')}))))"
MATCH = f"""pt(ipt_tipo, pref, tipo) AS (VALUES ('PRC', 0, 'PRC'), ('SECCIONAL', 0, 'PS'), ('SECCIONAL', 1, 'PRC'), ('LU', 0, 'LU'), ('LU', 1, 'PRC'), ('PRI', 0, 'PRI'), ('PRI', 1, 'PRM'), ('PRM', 0, 'PRM'), ('PRM', 1, 'PRI')),
    cd AS (SELECT s.ipt_tipo, s.ipt_nombre, s.cut, p.pref, f.*, {SCORE} AS score FROM sv s JOIN pt p USING (ipt_tipo) JOIN families f ON f.tipo = p.tipo AND f.cut = s.cut),
    bt AS (SELECT ipt_tipo, ipt_nombre, cut, pref, arg_max(struct_pack(id := id, score := score), (score, coalesce(fecha, ''), -id)) AS b, count(*) AS n FROM cd GROUP BY 1, 2, 3, 4),
    mt AS (SELECT ipt_tipo, ipt_nombre, cut, arg_min(b, pref) AS b, arg_min(n, pref) AS n FROM bt GROUP BY 1, 2, 3)"""


@query("D13_best_match", "feat_base feat instruments", f"WITH RECURSIVE {FAMILIES}, {SERVER}, {MATCH} SELECT ipt_tipo, ipt_nombre, cut, b.id AS portal_id, round_even(b.score, 3) AS score, CASE WHEN b.score > 0 THEN 'alta' ELSE 'unica' END AS confianza FROM mt WHERE b.score > 0 OR n = 1")
def best_match(spark, sf):
    return R.match(server(spark, sf), families(spark, sf)).select("ipt_tipo", "ipt_nombre", "cut", "portal_id", "score", "confianza")


@query("D11_attached_validity", "feat_base feat instruments", f"""WITH RECURSIVE {FAMILIES}, {SERVER}, {MATCH}, ok AS (SELECT ipt_tipo, ipt_nombre, cut, b.id AS id FROM mt WHERE b.score > 0 OR n = 1)
    SELECT f.cut, f.ipt_tipo, count(*) AS piezas, count(ok.id) AS con_vigencia FROM feat f LEFT JOIN ok ON ok.cut = f.cut AND ok.ipt_tipo = f.ipt_tipo AND ok.ipt_nombre = concat('Plan ', CASE f.gid % 3 WHEN 0 THEN 'Valle' WHEN 1 THEN 'Costa' ELSE 'Oriente' END, ' ', CAST(f.gid % 13 AS VARCHAR)) GROUP BY 1, 2""")
def attached(spark, sf):
    pieces = server(spark, sf)
    a = R.attach_validity(pieces, R.match(pieces, families(spark, sf)))
    return a.groupBy("cut", "ipt_tipo").agg(F.count("*").alias("piezas"), F.count("ipt_denominacion").alias("con_vigencia"))


PRESENCE = f"""gp(tipo, g) AS (VALUES ('PRC', 'PRC'), ('PS', 'Seccional'), ('LU', 'LU'), ('PRI', 'PRI/PRM'), ('PRM', 'PRI/PRM')), gl(ipt_tipo, g) AS (VALUES ('PRC', 'PRC'), ('SECCIONAL', 'Seccional'), ('LU', 'LU'), ('PRI', 'PRI/PRM'), ('PRM', 'PRI/PRM')),
    po AS (SELECT cut, g, string_agg(denominacion, ' | ' ORDER BY coalesce(fecha, '') DESC, denominacion) AS names, max(coalesce(ultima_modificacion, '')) AS um FROM families JOIN gp USING (tipo) GROUP BY 1, 2),
    se AS (SELECT cut, g, string_agg(DISTINCT ipt_nombre, '; ' ORDER BY ipt_nombre) AS names FROM sv JOIN gl USING (ipt_tipo) GROUP BY 1, 2),
    pr AS (SELECT c.region, c.cut, c.comuna, t.g AS tipo, po.names AS pn, se.names AS sn, coalesce(po.um, '') AS ultima_modificacion, t.g = 'LU' AND po.names IS NULL AND EXISTS (SELECT 1 FROM families f WHERE f.cut = c.cut AND f.tipo = 'PRC') AS imp
           FROM comunas c CROSS JOIN (SELECT unnest(['PRC', 'Seccional', 'LU', 'PRI/PRM']) AS g) t LEFT JOIN po ON po.cut = c.cut AND po.g = t.g LEFT JOIN se ON se.cut = c.cut AND se.g = t.g),
    tv AS (SELECT region, cut, comuna, tipo, coalesce(pn, sn, '') AS instrumento, ultima_modificacion, pn IS NOT NULL OR imp AS en_portal, sn IS NOT NULL AS en_servidor, coalesce(sn, '') AS nombre_servidor, CASE WHEN imp THEN 'LU definido por el PRC vigente' ELSE '' END AS nota,
           CASE WHEN (pn IS NOT NULL OR imp) AND sn IS NOT NULL THEN 'ambos' WHEN pn IS NOT NULL OR imp THEN 'solo_portal' ELSE 'solo_servidor' END AS estado FROM pr WHERE pn IS NOT NULL OR sn IS NOT NULL OR imp)"""


def presence_table(spark, sf):
    return R.presence(families(spark, sf), server(spark, sf), relation(spark, sf, "comunas"))


@query("D12_registry_presence", "feat_base feat instruments comunas", f"WITH RECURSIVE {FAMILIES}, {SERVER}, {PRESENCE} SELECT * FROM tv")
def presence(spark, sf):
    return presence_table(spark, sf).drop("norma_fecha", "ordenanza_url")


@query("E14_gap_counts", "feat_base feat instruments comunas", f"WITH RECURSIVE {FAMILIES}, {SERVER}, {PRESENCE} SELECT tipo, estado, count(*) AS n FROM tv GROUP BY 1, 2")
def gap_counts(spark, sf):
    return R.gap_counts(presence_table(spark, sf))


@query("E14_gap_lists", "feat_base feat instruments comunas", f"""WITH RECURSIVE {FAMILIES}, {SERVER}, {PRESENCE} SELECT CASE WHEN estado = 'solo_servidor' THEN 'solo_servidor' WHEN tipo = 'Seccional' THEN 'seccional_sin_geometria' ELSE 'sin_geometria' END AS lista, concat(comuna, ' (', tipo, ')') AS comuna_tipo, count(*) AS n
    FROM tv WHERE estado = 'solo_servidor' OR (estado = 'solo_portal' AND tipo <> 'PRI/PRM') GROUP BY 1, 2""")
def gap_lists(spark, sf):
    return R.gap_lists(presence_table(spark, sf))


@query("D27_server_base", "feat_base feat", f"WITH {SERVER} SELECT DISTINCT cut, ipt_tipo, ipt_nombre FROM sv WHERE ipt_tipo IN ('PRC', 'SECCIONAL', 'LU', 'PRI')")
def server_base(spark, sf):
    s = server(spark, sf)
    return R.server_base(s, s)


@query("D27_server_base_fallback", "feat_base feat", f"WITH {SERVER} SELECT DISTINCT cut, ipt_tipo, ipt_nombre FROM sv WHERE ipt_tipo IS NOT NULL")
def server_base_fallback(spark, sf):
    return R.server_base(None, server(spark, sf))


@query("E3_B5_inventory", "feat_base feat", "SELECT ipt_tipo, ipt_nombre, cut_ipt, count(*) AS features FROM feat GROUP BY ALL")
def inventory(spark, sf):
    return relation(spark, sf, "feat").groupBy("ipt_tipo", "ipt_nombre", "cut_ipt").agg(F.count("*").alias("features"))


@query("H3_key_sets", "feat_base feat", "SELECT 'solo_prc' AS conjunto, cut FROM (SELECT cut FROM feat WHERE ipt_tipo = 'PRC' EXCEPT SELECT cut FROM feat WHERE ipt_tipo = 'LU') UNION ALL SELECT 'ambos', cut FROM (SELECT cut FROM feat WHERE ipt_tipo = 'PRC' INTERSECT SELECT cut FROM feat WHERE ipt_tipo = 'LU')")
def key_sets(spark, sf):
    f = relation(spark, sf, "feat")
    a, b = f.where("ipt_tipo = 'PRC'").select("cut"), f.where("ipt_tipo = 'LU'").select("cut")
    return a.subtract(b).select(F.lit("solo_prc").alias("conjunto"), "cut").unionByName(a.intersect(b).select(F.lit("ambos").alias("conjunto"), "cut"))


REVIEW = """rv AS (SELECT ipt_nombre, zona, string_agg(DISTINCT region, '; ' ORDER BY region) AS region, min(zona_desc) AS zona_desc, string_agg(DISTINCT comuna, '; ' ORDER BY comuna) AS comunas, round_even(sum((x1 - x0) * (y1 - y0)) / 1e4, 2) AS ha,
    string_agg(DISTINCT replace(fuente, 'PRI_', ''), '; ' ORDER BY replace(fuente, 'PRI_', '')) AS subclase_actual FROM feat WHERE revisar GROUP BY 1, 2)"""


@query("E5_B9_review_table", "feat_base feat", f"WITH {REVIEW} SELECT *, CASE zona WHEN 'ZH1' THEN 'e' WHEN 'ZH2' THEN 'R' ELSE '' END AS decision FROM rv")
def review(spark, sf):
    df = relation(spark, sf, "feat").withColumn("area_m2", F.expr("(x1 - x0) * (y1 - y0)"))
    previous = df.where("zona IN ('ZH1', 'ZH2')").select(F.upper("ipt_nombre").alias("ipt_nombre"), "zona", F.expr("CASE zona WHEN 'ZH1' THEN 'e' ELSE 'R' END").alias("decision")).distinct()
    return RV.review_table(df, previous)


@query("H4_merged_decisions", "feat_base feat", "SELECT ipt_nombre || '|' || zona AS clave, CASE zona WHEN 'ZH1' THEN 'U' WHEN 'ZH2' THEN 'R' ELSE 'E' END AS decision FROM (SELECT DISTINCT ipt_nombre, zona FROM feat WHERE zona IN ('ZH0', 'ZH1', 'ZH2'))")
def merged(spark, sf):
    keys = relation(spark, sf, "feat").select("ipt_nombre", "zona").distinct()
    decisions = keys.withColumn("decision", F.expr("CASE zona WHEN 'ZH1' THEN ' u' WHEN 'ZH2' THEN 'r ' WHEN 'ZH3' THEN 'mala' ELSE '' END"))
    good, _ = RV.read_decisions(decisions)
    current, _ = RV.read_decisions(keys.where("zona IN ('ZH0', 'ZH1')").withColumn("decision", F.lit("E")))
    return RV.merge_overrides(current, good)


CONTRACTS = """SELECT p_partkey AS id, CASE p_size % 6 WHEN 0 THEN 'propuesta' WHEN 1 THEN 'contrato' WHEN 2 THEN 'mapeada' WHEN 3 THEN 'latente' WHEN 4 THEN 'activa' ELSE 'mantenida' END AS estado, p_brand AS institucion, p_size % 9 + 1 AS umbral FROM [part]"""


def contract_table(spark, sf):
    return spark.sql(CONTRACTS.replace("[part]", "{p}"), p=table(spark, sf, "part"))


@query("D21_relevant_sources", "feat_base feat", """SELECT gid AS qid, n_nationkey AS id FROM feat JOIN nation ON n_nationkey % 6 NOT IN (4, 5) AND (CASE n_nationkey % 3 WHEN 0 THEN fuente IN ('PRC', 'LU') WHEN 1 THEN fuente = 'PRI_E' ELSE fuente = 'SECCIONAL' END)
    AND (n_nationkey % 4 <> 1 OR lpad(CAST(m % 50 AS VARCHAR), 2, '0') = lpad(CAST(n_nationkey AS VARCHAR), 2, '0'))""")
def relevant(spark, sf):
    """Cards against a fixed list of contracts, one per nation."""
    cards = relation(spark, sf, "feat").select(F.col("gid").alias("qid"), F.lpad((F.col("m") % 50).cast("string"), 2, "0").alias("cut"), F.array("fuente").alias("clases"))
    k = F.col("n_nationkey")
    states = F.array(*[F.lit(s) for s in CT.STATES])
    contracts = table(spark, sf, "nation").select(
        k.alias("id"), F.get(states, (k % 6).cast("int")).alias("estado"), F.when(k % 3 == 0, F.array(F.lit("PRC"), F.lit("LU"))).when(k % 3 == 1, F.array(F.lit("PRI_E"))).otherwise(F.array(F.lit("SECCIONAL"))).alias("clases"),
        F.when(k % 4 == 1, F.array(F.lpad(k.cast("string"), 2, "0"))).alias("regiones"))
    return D.relevant_sources(cards, contracts)


def demand_log(spark, sf):
    e = table(spark, sf, "events")
    names = F.when(F.col("event_id") % 5 == 0, F.array().cast("array<string>")).when(F.col("event_id") % 2 == 0, F.array("event_type")).otherwise(F.array(F.col("event_type"), F.lit("clima")))
    return e.select(F.date_format("ts", "yyyy-MM-dd").alias("fecha"), F.concat(F.lit("R"), (F.col("user_id") % 4).cast("string")).alias("region"), F.col("user_id").cast("string").alias("cut"), F.lit("c").alias("comuna"),
                    F.lit("U1").alias("clase"), F.lit("completa").alias("cobertura"), names.alias("fuentes_relevantes_no_activas"))


VOTES = """vt AS (SELECT fuente, region, count(*) AS n FROM (SELECT concat('R', CAST(user_id % 4 AS VARCHAR)) AS region, unnest(CASE WHEN event_id % 5 = 0 THEN CAST([] AS VARCHAR[]) WHEN event_id % 2 = 0 THEN [event_type] ELSE [event_type, 'clima'] END) AS fuente FROM events) GROUP BY 1, 2)"""


@query("A22_E13_region_votes", sql=f"WITH {VOTES} SELECT * FROM vt")
def region_votes(spark, sf):
    return D.region_votes(D.exploded(demand_log(spark, sf)))


@query("E13_demand_state", sql=f"""WITH {VOTES}, ct AS (SELECT event_type AS id, CASE WHEN event_type IN ('click', 'view') THEN 'latente' ELSE 'mapeada' END AS estado, 1000 AS umbral FROM events GROUP BY 1),
    a AS (SELECT fuente, sum(n) AS t, max(n) AS m, string_agg(region || ': ' || CAST(n AS VARCHAR), '; ' ORDER BY n DESC, region) AS l FROM vt GROUP BY 1)
    SELECT id AS fuente, estado, CAST(coalesce(t, 0) AS BIGINT) AS votos_total, coalesce(l, '—') AS votos_por_region, umbral, coalesce(m, 0) AS region_max, estado = 'latente' AND coalesce(m, 0) >= umbral AS lista_para_activar,
    CASE estado WHEN 'latente' THEN 'demanda >= umbral o decisión manual' ELSE 'acceso automatizable o procedimiento manual' END AS falta FROM ct LEFT JOIN a ON fuente = id""")
def demand_state(spark, sf):
    contracts = table(spark, sf, "events").select("event_type").distinct().select(F.col("event_type").alias("id"), F.when(F.col("event_type").isin("click", "view"), "latente").otherwise("mapeada").alias("estado"),
                                                                                 F.lit("x").alias("institucion"), F.lit(1000).alias("umbral"))
    return D.state(contracts, D.exploded(demand_log(spark, sf))).drop("institucion")


@query("B13_demand_lines", sql="SELECT event_id % 7 AS cut, count(*) AS lineas, CAST(sum(CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fuentes FROM events GROUP BY 1")
def demand_lines(spark, sf):
    e = table(spark, sf, "events")
    cards = e.select(F.col("event_id").alias("qid"), F.lit("2026-10-07").alias("fecha"), F.lit("R").alias("region"), (F.col("event_id") % 7).alias("cut"), F.lit("c").alias("comuna"), F.lit("U1").alias("clase"), F.lit("completa").alias("cobertura"))
    lines = D.log_lines(cards, e.where("event_id % 3 = 0").select(F.col("event_id").alias("qid"), F.lit("f").alias("id")))
    return lines.groupBy("cut").agg(F.count("*").alias("lineas"), F.sum(F.size("fuentes_relevantes_no_activas")).alias("fuentes"))


@query("L1_source_contract_rules", sql="""SELECT c_custkey AS id, CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE CAST(c_custkey % 5 = 0 AS INT) + CAST(c_custkey % 3 = 0 AND c_custkey % 11 <> 0 AS INT) + CAST(c_custkey % 6 >= 1 AND c_mktsegment = 'MACHINERY' AS INT)
    + CAST(c_custkey % 6 >= 2 AND c_custkey % 11 = 0 AS INT) + CAST(c_custkey % 6 >= 3 AND c_acctbal < 0 AS INT) END AS n_errores FROM customer""")
def contract_rules(spark, sf):
    k = F.col("c_custkey")
    states = F.array(*[F.lit(s) for s in CT.STATES])
    mapping = F.when(k % 11 == 0, F.array().cast("array<struct<origen:string,destino:string>>")).otherwise(
        F.array(F.struct(F.when((k % 3 == 0), "correo").otherwise("altura").alias("origen"), F.lit("d").alias("destino"))))
    excluded = F.when(k % 5 == 0, F.array(F.lit("rut"), F.lit("CORREO"))).otherwise(F.array(F.lit("Rut"), F.lit("nombre"), F.lit("correo")))
    rows = table(spark, sf, "customer").select(
        F.concat(F.lit("f"), k.cast("string")).alias("id"), k.alias("k"), F.lit("n").alias("nombre"), F.lit("i").alias("institucion"), F.when(k % 7 == 0, "aprobada").otherwise(F.get(states, (k % 6).cast("int"))).alias("estado"),
        F.struct(F.lit("api").alias("tipo"), F.when(F.col("c_acctbal") >= 0, "u").alias("url")).alias("acceso"), F.when(F.col("c_mktsegment") == "MACHINERY", "").otherwise("CC").alias("licencia"), F.array(F.lit("x")).alias("diccionario"),
        mapping.alias("mapeo"), excluded.alias("excluir_siempre"), F.struct(F.lit("a").alias("nivel"), F.lit("BORRADOR: x").alias("efecto")).alias("condicionante"), F.lit(3).alias("umbral"), F.array(F.lit("U1")).alias("clases"))
    return CT.source_errors(rows).select(F.col("k").alias("id"), F.size("errores").alias("n_errores"))


CONTRACT_FAULTS = (     # condition on the key, error of the schema
    ("k % 4 = 3", "/id: no calza con el patrón"), ("k % 9 = 5", "/nombre: tipo integer, se esperaba string"), ("k % 7 = 1", "/estado: no está en la lista"),
    ("k % 5 = 2", "/acceso/url: falta"), ("k % 11 = 3", "/demanda/umbral_activacion: < 1"), ("k % 13 = 4", "/mapeo[1]/destino: no está en la lista"))


@query("A20_L1_contract_documents", sql="WITH c AS (SELECT c_custkey AS k FROM customer), e AS (" + " UNION ALL ".join(f"SELECT k, '{text}' AS error FROM c WHERE {bad}" for bad, text in CONTRACT_FAULTS)
       + """), fine AS (SELECT k FROM c WHERE k NOT IN (SELECT k FROM e)) SELECT * FROM e UNION ALL SELECT k, 'id distinto del nombre de archivo' FROM fine WHERE k % 17 = 6
    UNION ALL SELECT k, 'excluir_siempre debe incluir al menos [''NOMBRE'', ''RUT'']' FROM fine WHERE k % 3 = 0""")
def contract_documents(spark, sf):
    """Contract documents as JSON texts, one row per error."""
    bad = {text.split(":")[0]: F.expr(test) for test, text in CONTRACT_FAULTS}
    k = F.col("k")
    field = F.struct(F.lit("ALTURA").alias("origen"), F.when(bad["/mapeo[1]/destino"], "altura").otherwise("escala").alias("destino"))
    rows = spread(table(spark, sf, "customer").select(F.col("c_custkey").alias("k")))
    head = {"id": F.concat(F.when(bad["/id"], "F").otherwise("f"), k.cast("string")), "institucion": F.lit("i"), "licencia": F.lit("CC"),
            "estado": F.when(bad["/estado"], "aprobada").otherwise("activa"), "diccionario": F.array(F.struct(F.lit("ALTURA").alias("campo"))),
            "mapeo": F.array(F.struct(F.lit("ALTURA").alias("origen"), F.lit("escala").alias("destino")), field),
            "excluir_siempre": F.when(k % 3 == 0, F.array(F.lit("RUT"))).otherwise(F.array(F.lit("Rut"), F.lit("NOMBRE"))),
            "condicionante": F.struct(F.lit("alerta").alias("nivel"), F.lit("BORRADOR").alias("efecto")),
            "demanda": F.struct(F.array(F.lit("q")).alias("preguntas_que_responde"), F.when(bad["/demanda/umbral_activacion"], 0).otherwise(2).alias("umbral_activacion"),
                                F.struct(F.array(F.lit("R1")).alias("clases")).alias("relevante_si")),
            "acceso": F.struct(F.lit("api").alias("tipo"), F.when(~bad["/acceso/url"], "u").alias("url"), F.lit("anual").alias("frecuencia_refresco"))}
    text = F.to_json(F.struct(*[c.alias(n) for n, c in head.items()]))          # a field that is null is left out
    name = F.when(bad["/nombre"], '{"nombre":5,').otherwise('{"nombre":"n",')
    docs = rows.select(k, F.concat(F.lit("f/f"), (k + F.when(k % 17 == 6, 1).otherwise(0)).cast("string"), F.lit(".json")).alias("file"), F.concat(name, F.substring(text, 2, 1_000_000)).alias("doc"))
    loaded = SR.load_sources(docs.select(F.concat(k.cast("string"), F.lit("/"), "file").alias("archivo"), "doc"))
    return loaded.select(F.substring_index("archivo", "/", 1).cast("bigint").alias("k"), F.explode("errores").alias("error"))


@query("L2_theme_contract_rules", sql="""SELECT p_partkey AS id, CAST(p_size % 5 = 0 AS INT) + CASE WHEN p_size % 2 = 0 THEN CAST(p_size % 3 = 0 AS INT) + CAST(p_size % 7 = 0 AS INT) ELSE CAST(p_type <> 'PROMO' AND p_size % 4 = 1 AS INT) END
    + CASE WHEN p_type <> 'PROMO' THEN CAST(p_size % 11 = 0 AS INT) + CAST(p_size % 13 = 0 AS INT) ELSE 0 END + CAST(p_size % 9 = 0 AS INT) AS n_errores FROM part""")
def theme_rules(spark, sf):
    s = F.col("p_size")
    ramp = F.array(F.struct(F.lit(1.0).alias("v"), F.when(s % 7 == 0, "rojo").otherwise("#ff0000").alias("c")), F.struct(F.when(s % 3 == 0, 1.0).otherwise(5.0).alias("v"), F.lit("#00ff00").alias("c")))
    rows = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.when(s % 2 == 0, "raster").otherwise("vector").alias("tipo"), F.when(F.col("p_type") == "PROMO", "propuesta").otherwise("activa").alias("estado"),
        F.when(s % 5 == 0, 9).otherwise(3).alias("zmin"), F.lit(8).alias("zmax"), ramp.alias("rampa"), F.when(s % 4 != 1, "c").alias("capa_origen"), F.lit("fill").alias("tipo_capa"), F.lit("p").alias("paint"), F.when(s % 11 != 0, "u").alias("url"),
        F.lit("2026").alias("fecha_dato"), (s % 13 != 0).alias("acceso_verificado"), F.lit("g").alias("generador"), (s % 9 == 0).alias("licencia_verificada"), F.lit("por_verificar").alias("uso_comercial"))
    return CT.theme_errors(rows).select("id", F.size("errores").alias("n_errores"))


@query("C22_geometry_admission", "lots", """SELECT rid AS qid, CASE WHEN rid % 7 = 3 THEN 'Se espera un punto o un polígono, no LineString' WHEN rid % 7 = 4 THEN 'Geometría vacía' WHEN (x1 - x0) * (y1 - y0) * CASE WHEN rid % 5 = 0 THEN 100 ELSE 1 END > 500000 THEN 'grande' END AS error FROM lots""")
def admission(spark, sf):
    k = F.col("rid")
    df = relation(spark, sf, "lots").withColumns({"w": F.expr("(x1 - x0) * CASE WHEN rid % 5 = 0 THEN 10 ELSE 1 END"), "h": F.expr("(y1 - y0) * CASE WHEN rid % 5 = 0 THEN 10 ELSE 1 END")})
    g = G.box(F.lit(0.0), F.lit(0.0), F.col("w"), F.col("h"))
    rows = df.select(k.alias("qid"), F.when(k % 7 == 3, "LineString").otherwise("Polygon").alias("tipo"), F.when(k % 7 == 4, F.slice(g, 1, 0)).otherwise(g).alias("geom"))
    return K.admit(rows).select("qid", F.when(F.col("error").startswith("El pol"), "grande").otherwise(F.col("error")).alias("error"))


THEME = """SELECT p_partkey AS id, p_name AS nombre, p_brand AS categoria, CASE WHEN p_size % 2 = 0 THEN 'raster' ELSE 'vector' END AS tipo, CASE WHEN p_size % 4 = 0 THEN 'propuesta' ELSE 'activa' END AS estado, p_size % 3 = 0 AS licencia_verificada,
    CASE WHEN p_size % 6 = 0 THEN 'si' ELSE 'no' END AS uso_comercial, p_retailprice AS precio FROM [part]"""


def themes(spark, sf):
    return spark.sql(THEME.replace("[part]", "{p}"), p=table(spark, sf, "part"))


@query("B21_C23_theme_state", sql=f"WITH t AS ({THEME.replace('[part]', 'part')}), o AS (SELECT l_partkey AS id, sum(l_quantity) * 1e5 AS bytes FROM lineitem GROUP BY 1) SELECT t.id, categoria, tipo, estado, bytes IS NOT NULL AS generado, round_even(bytes / 1e6, 1) AS mb, licencia_verificada, licencia_verificada AND uso_comercial = 'si' AS publicable FROM t LEFT JOIN o USING (id) WHERE estado <> 'propuesta'")
def theme_state(spark, sf):
    out = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("id")).agg((F.sum("l_quantity") * 1e5).alias("bytes"), F.lit("2026-10-07").alias("fecha"))
    return CT.theme_state(CT.generated(themes(spark, sf)), out).drop("fecha")


@query("B21_public_view", sql=f"WITH t AS ({THEME.replace('[part]', 'part')}) SELECT id, nombre, categoria, tipo, estado, licencia_verificada, uso_comercial, id IN (SELECT l_partkey FROM lineitem WHERE l_linenumber = 7) AS disponible, licencia_verificada AND uso_comercial = 'si' AS publicable FROM t")
def public_view(spark, sf):
    out = table(spark, sf, "lineitem").where("l_linenumber = 7").select(F.col("l_partkey").alias("id")).distinct()
    t = themes(spark, sf).withColumns({"zmin": F.lit(3), "zmax": F.lit(9), "nota": F.lit(None).cast("string")})
    return CT.public_view(t, out).drop("zmin", "zmax", "nota")


@query("C21_personal_data_guard", sql="SELECT c_custkey, c_mktsegment FROM customer")
def guard(spark, sf):
    return CT.guard_columns(table(spark, sf, "customer"), ["c_custkey", "c_mktsegment"], ["RUT", "NOMBRE", "c_name", "c_acctbal"])


@query("A13_D16_card_enrichment", "feat_base feat", """WITH nm AS (SELECT ipt_nombre, zona, count(*) AS n, bool_or(gid % 2 = 1) AS b FROM feat WHERE zona IN ('ZH1', 'ZH2') GROUP BY 1, 2)
    SELECT f.gid, coalesce(nm.n, 0) AS n_normas, coalesce(nm.b, false) AS borrador, CASE WHEN f.zona = 'ZH3' THEN 7 END AS n_edificios FROM feat f LEFT JOIN nm ON nm.ipt_nombre = f.ipt_nombre AND nm.zona = f.zona""")
def enriched(spark, sf):
    f = relation(spark, sf, "feat")
    norms = f.where("zona IN ('ZH1', 'ZH2')").select(F.upper("ipt_nombre").alias("ipt_nombre"), F.lower("zona").alias("zona"), F.lit("0.5").alias("ocupacion_max"), F.lit("").alias("notas"), F.when(F.col("gid") % 2 == 1, "BORRADOR").otherwise("VALIDADO").alias("estado"))
    occ = f.where("zona = 'ZH3'").select(F.col("ipt_nombre").alias("ipt"), "zona").distinct().select("ipt", "zona", F.lit(1.0).alias("ha"), F.lit(1).alias("m2_huella"), F.lit(0.1).alias("coef_ocupacion"), F.lit(7).alias("n_edificios"))
    return K.enrich(f.select("gid", "ipt_nombre", "zona"), occ, norms).select("gid", "n_normas", "borrador", "n_edificios")


@query("C18_legal_annotation", "feat_base feat", "SELECT gid, CASE ipt_tipo WHEN 'PRC' THEN 'Urbano' WHEN 'LU' THEN 'Límite' END AS norma_titulo, CASE ipt_tipo WHEN 'PRC' THEN 'LGUC; OGUC' WHEN 'LU' THEN 'LGUC' ELSE '' END AS norma_refs, 'Referencial' AS aviso FROM feat")
def legal(spark, sf):
    from zonaria.operators.partition import annotate

    text = {"_aviso": "Referencial", "clases": {"PRC": {"titulo": "Urbano", "resumen": "r", "normas": ["LGUC", "OGUC"]}, "LU": {"titulo": "Límite", "resumen": "s", "normas": ["LGUC"]}}}
    return annotate(relation(spark, sf, "feat").withColumn("clase", F.col("ipt_tipo")), text).select("gid", "norma_titulo", "norma_refs", "aviso")


def stored_at(spark, name):
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("A5_catalogue_reread", sql=f"""WITH {TYPED} SELECT * FROM (SELECT service, layer_name, arg_min(layer_id, (service_type <> 'MapServer', layer_id)) AS layer_id, arg_min(tipo, (service_type <> 'MapServer', layer_id)) AS tipo,
    arg_min(coalesce(pri_default, '-'), (service_type <> 'MapServer', layer_id)) AS pri_default, false AS otra_vez FROM ty GROUP BY 1, 2) WHERE tipo <> 'IGNORAR'""")
def reread(spark, sf):
    """The catalogue written once, found unchanged by a second run, and read with the rules applied again."""
    found = catalogue(spark, sf).select("service", "layer_name", "service_type", "layer_id")
    path = stored_at(spark, "catalogue")
    CA.persist_catalogue(found, path, RULES)
    again = CA.persist_catalogue(found, path, RULES)
    return CA.read_catalogue(spark, path, RULES).select("service", "layer_name", "layer_id", "tipo", F.coalesce("pri_default", F.lit("-")).alias("pri_default"), F.lit(again).alias("otra_vez"))


@query("A7_registry_reread", "instruments", """SELECT id, tipo, denominacion, clasificacion, numero, fecha, 2 AS comunas, lpad(CAST(m AS VARCHAR), 5, '0') AS primera, doc_nombre, doc_url FROM instruments""")
def registry_reread(spark, sf):
    """The registry as its service delivers it (JSON documents), read back."""
    cut = F.lpad(F.col("m").cast("string"), 5, "0")
    docs = relation(spark, sf, "instruments").select(
        "id", "tipo", "denominacion", F.array(cut, F.lit("99999")).alias("comunas"), "clasificacion", F.col("numero").alias("numeroDocumento"), F.col("fecha").alias("fechaInicioVigencia"),
        F.array(F.struct(F.col("doc_tipo").alias("tipo"), F.col("doc_nombre").alias("nombre"), F.col("doc_url").alias("url"))).alias("documentos"))
    path = stored_at(spark, "registry")
    docs.write.json(path)
    return L.read_instruments(spark, path).select(
        "id", "tipo", "denominacion", "clasificacion", F.col("numeroDocumento").alias("numero"), F.col("fechaInicioVigencia").alias("fecha"), F.size("comunas").alias("comunas"),
        F.get("comunas", F.lit(0)).alias("primera"), F.get("documentos", F.lit(0))["nombre"].alias("doc_nombre"), F.get("documentos", F.lit(0))["url"].alias("doc_url"))


@query("A24_match_reread", "instruments", "SELECT CAST(id AS VARCHAR) AS id, tipo, numero, fecha, CASE WHEN id % 5 = 0 THEN NULL ELSE denominacion END AS ipt_nombre FROM instruments")
def match_reread(spark, sf):
    """A match table with blanks, written as CSV and read back with blanks as null."""
    rows = relation(spark, sf, "instruments").select(F.col("id").cast("string").alias("id"), "tipo", "numero", "fecha", F.when(F.col("id") % 5 == 0, "  ").otherwise(F.col("denominacion")).alias("ipt_nombre"))
    path = stored_at(spark, "matches")
    sinks.write_csv(rows, path)
    return L.read_matches(spark, path)

"""Text and scalar functions over whole texts and tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from zonaria.functions.numeric import half_even
from zonaria.functions import crs as C
from zonaria.functions import geometry as G
from zonaria.functions import scales as S
from zonaria.functions import text as X
from zonaria.operators.tiling import deal

from .base import query, relation, shaped, table

NORM = r"upper(trim(regexp_replace(regexp_replace(regexp_replace(strip_accents({c}), '[^\x00-\x7F]', '', 'g'), '[_\-]+', ' ', 'g'), '\s+', ' ', 'g')))"


def norm(c: str) -> str:
    return NORM.replace("{c}", c)


@query("I1_norm_text", sql=f"SELECT doc_id, md5({norm('text')}) AS clave, length({norm('text')}) AS largo FROM documents")
def norm_text(spark, sf):
    n = X.norm_text(F.col("text"))
    return deal(table(spark, sf, "documents")).select("doc_id", F.md5(n).alias("clave"), F.length(n).alias("largo"))


@query("I1_fold_compatibility", sql=f"SELECT doc_id, md5({norm('text')} || ' IV 13 M2 A ST') AS clave FROM documents WHERE length({norm('text')}) > 0")
def fold_compatibility(spark, sf):
    """Characters that stand for several, wide letters and ligatures keep their plain form in the key."""
    # a plain condition would be pushed below the dealing out and be tried by the task that reads
    n = X.norm_text(F.concat(F.col("text"), F.lit(" Ⅳ ⅓ ㎡ Ａ ﬆ")))
    return deal(table(spark, sf, "documents")).select("doc_id", "text", F.explode(F.array(X.has_key(F.col("text")))).alias("_has")).where("_has").select("doc_id", F.md5(n).alias("clave"))


@query("I2_slugs", sql=fr"""SELECT page_id, regexp_replace(regexp_replace(url, '[^A-Za-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS servicio,
       md5(regexp_replace(regexp_replace(lower({norm('html')}), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')) AS region FROM pages""")
def slugs(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.service_slug(F.col("url")).alias("servicio"), F.md5(X.region_slug(F.col("html"))).alias("region"))


@query("I3_region_choice", sql=f"SELECT conv_id, turn, regexp_matches({norm('text')}, '(?i)REAU|TION') AS calza FROM conversations")
def region_choice(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", X.region_matches(F.col("text"), "réau|tion").alias("calza"))


DECREE_SQL = r"(?i)(Decreto|Resoluci[oó]n|D\.?\s*S\.?)\s*(?:Exento\s*)?N[°º]?\s*([\w\-/]+)"
DECREE_CASE = f"""CASE WHEN regexp_matches(doc_nombre, '{DECREE_SQL}') THEN
    concat(CASE WHEN lower(regexp_extract(doc_nombre, '{DECREE_SQL}', 1)) = 'decreto' THEN 'Decreto'
                WHEN lower(regexp_extract(doc_nombre, '{DECREE_SQL}', 1)) IN ('resolucion', 'resolución') THEN 'Resolución' ELSE 'D.S.' END,
           ' N° ', regexp_extract(doc_nombre, '{DECREE_SQL}', 2))
    WHEN numero IS NOT NULL AND numero <> '' THEN 'N° ' || numero ELSE '' END"""
URL_CASE = "CASE WHEN doc_tipo IN ('Ordenanza', 'Publicación D. O. con Ordenanza') THEN doc_url END"


def instruments(spark, sf):
    """Registry rows with nested documents and the descendants as text."""
    base = relation(spark, sf, "instruments")
    child = F.when((F.col("id") > 0), F.concat_ws(", ", *[(F.col("id") * 10 + k).cast("string") for k in range(10)]))
    doc = F.array(F.struct(F.lit("Acta").alias("tipo"), F.lit("Acta de sesión").alias("nombre"), F.lit(None).cast("string").alias("url")),
                  F.struct(F.col("doc_tipo").alias("tipo"), F.col("doc_nombre").alias("nombre"), F.col("doc_url").alias("url")))
    return base.select("id", "tipo", F.lit("Comunal").alias("planificacion"), "denominacion", F.array(F.lpad(F.col("m").cast("string"), 10, "0")).alias("comunas"), "clasificacion",
                       F.col("numero").alias("numeroDocumento"), F.col("fecha").alias("fechaInicioVigencia"), doc.alias("documentos"), child.alias("instrumentosDescendientesIds"))


@query("I4_decree_text", "instruments", f"SELECT id, {DECREE_CASE} AS norma FROM instruments")
def decree(spark, sf):
    return instruments(spark, sf).select("id", X.decree_text(F.col("documentos"), F.col("numeroDocumento")).alias("norma"))


@query("I5_ordinance_url", "instruments", f"SELECT id, {URL_CASE} AS ordenanza_url FROM instruments")
def ordinance(spark, sf):
    return instruments(spark, sf).select("id", X.ordinance_url(F.col("documentos")).alias("ordenanza_url"))


STOP_SQL = ", ".join(f"'{w}'" for w in X.STOP_WORDS)
def tokens_sql(c: str) -> str:
    return f"list_filter(list_distinct(string_split({norm(f'''replace(replace({c}, '.', ' '), ',', ' ')''')}, ' ')), lambda t: length(t) > 1 AND NOT list_contains([{STOP_SQL}], t))"


@query("I6_significant_tokens", sql=f"SELECT doc_id, len({tokens_sql('text')}) AS n, md5(array_to_string(list_sort({tokens_sql('text')}), ' ')) AS palabras FROM documents")
def tokens(spark, sf):
    t = X.significant_tokens(F.col("text"))
    return deal(table(spark, sf, "documents")).select("doc_id", F.size(t).alias("n"), F.md5(F.array_join(F.array_sort(t), " ")).alias("palabras"))


@query("I7_id_list", sql="""SELECT l_orderkey, l_linenumber, 3 AS n, CAST(l_partkey + l_suppkey + l_orderkey AS BIGINT) AS suma FROM lineitem""")
def id_list(spark, sf):
    text = F.concat_ws(", ", F.col("l_partkey").cast("string"), F.lit("x7"), F.col("l_suppkey").cast("string"), F.lit(""), F.col("l_orderkey").cast("string"))
    ids = X.id_list(text)
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.size(ids).alias("n"), F.aggregate(ids, F.lit(0).cast("bigint"), lambda a, v: a + v).alias("suma"))


PERIOD = """concat(CASE o_orderkey % 4 WHEN 0 THEN 'PRIMER' WHEN 1 THEN 'segundo' WHEN 2 THEN ' Primer ' ELSE '327 ' END,
    ' SEMESTRE DE ', CAST(2000 + o_orderkey % 30 - 5 AS STRING))"""


@query("I8_semester", sql=f"""SELECT o_orderkey, CASE WHEN regexp_matches({PERIOD}, '(?i)^\\s*(PRIMER|SEGUNDO)\\s+SEMESTRE\\s+DE\\s+(20\\d\\d)\\s*$') THEN
    concat(regexp_extract({PERIOD}, '(20\\d\\d)\\s*$', 1), CASE WHEN o_orderkey % 4 = 1 THEN '-2' ELSE '-1' END) END AS periodo FROM orders""")
def semester(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", X.semester(F.expr(PERIOD)).alias("periodo"))


ROLE = "concat(CASE WHEN l_linenumber = 7 THEN 'S/N ' ELSE ' 0' END, CAST(l_suppkey AS STRING), CASE WHEN l_linenumber % 3 = 0 THEN ' / ' WHEN l_linenumber % 3 = 1 THEN '-' ELSE ' ' END, CAST(l_linenumber AS STRING))"


@query("I9_role_key", sql="""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber <> 7 AND l_suppkey < 100000 THEN
    concat(lpad(CAST(l_suppkey AS VARCHAR), 5, '0'), '-', lpad(CAST(l_linenumber AS VARCHAR), 5, '0')) END AS rol FROM lineitem""")
def role(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", X.role_key(F.expr(ROLE)).alias("rol"))


METHOD = "CASE c_custkey % 8 WHEN 0 THEN '1_contains_x' WHEN 1 THEN '2_nearest' WHEN 2 THEN '4_manzana' WHEN 3 THEN '6_manzana_any' WHEN 4 THEN 'ah_utm_9' WHEN 5 THEN 'nearest_neighbour' WHEN 6 THEN 'otro' END"


@query("I10_match_method", sql="""SELECT c_custkey, CASE c_custkey % 8 WHEN 0 THEN 'contiene' WHEN 1 THEN 'cercano' WHEN 2 THEN 'manzana' WHEN 3 THEN 'manzana_cualquiera'
    WHEN 4 THEN 'utm' WHEN 5 THEN 'cercano' ELSE 'desconocido' END AS metodo FROM customer""")
def method(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", X.match_method(F.coalesce(F.expr(METHOD), F.lit(""))).alias("metodo"))


@query("I11_coordinate", sql="SELECT event_id, CASE WHEN 10 - value BETWEEN -56 AND -17 THEN round_even(10 - value, 6) END AS lat FROM events")
def coordinate(spark, sf):
    return table(spark, sf, "events").select("event_id", X.coordinate((10 - F.col("value")).cast("string"), -56, -17).alias("lat"))


ADDRESS = "CASE conv_id % 5 WHEN 0 THEN text WHEN 1 THEN concat('  ', substr(text, 1, 60), ' ') WHEN 2 THEN '12-3, 45' WHEN 3 THEN concat('Error ', substr(text, 1, 20)) ELSE '   ' END"


@query("I12_address", sql=f"""SELECT conv_id, turn, CASE WHEN trim(a) <> '' AND NOT regexp_full_match(trim(a), '[0-9.,\\- ]+') AND NOT regexp_matches(a, '(?i)Error|Exception|Retry')
    AND length(trim(a)) <= 90 THEN trim(a) END AS direccion FROM (SELECT conv_id, turn, {ADDRESS} AS a FROM conversations)""")
def address(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", X.address(F.expr(ADDRESS)).alias("direccion"))


@query("I13_code_maps", sql="SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'HABITACIONAL' WHEN 1 THEN 'COMERCIO' WHEN 2 THEN 'SITIO ERIAZO' END AS destino, CASE p_size % 3 WHEN 0 THEN 'URBANA' WHEN 1 THEN 'RURAL' END AS ubicacion FROM part")
def code_maps(spark, sf):
    use = F.expr("CASE p_size % 4 WHEN 0 THEN 'H' WHEN 1 THEN 'C' WHEN 2 THEN 'W' ELSE '?' END")
    place = F.expr("CASE p_size % 3 WHEN 0 THEN 'U' WHEN 1 THEN 'R' ELSE 'X' END")
    return table(spark, sf, "part").select("p_partkey", X.code_label(use, X.USES).alias("destino"), X.code_label(place, X.LOCATIONS).alias("ubicacion"))


@query("I14_numbers_in_text", sql="""WITH n AS (SELECT page_id, list_transform(regexp_extract_all(html, '\\d+(?:[.,]\\d+)?'), lambda s: CAST(replace(s, ',', '.') AS DOUBLE)) AS v FROM pages)
    SELECT page_id, len(v) AS n, v[1] AS primero, list_min(v) AS menor FROM n""")
def numbers(spark, sf):
    v = X.numbers_in(F.col("html"))
    return table(spark, sf, "pages").select("page_id", F.size(v).alias("n"), X.first_number(F.col("html")).alias("primero"), F.array_min(v).alias("menor"))


@query("I15_volume_state", sql="SELECT c_custkey, CASE WHEN c_acctbal / 5000 < 0.8 THEN 'holgura' WHEN c_acctbal / 5000 <= 1.0 THEN 'al_limite' ELSE 'excede' END AS estado FROM customer")
def volume_state(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", S.volume_state(F.col("c_acctbal") / 5000).alias("estado"))


@query("I16_occupation_band", sql="""WITH b AS (SELECT l_orderkey, l_linenumber, l_partkey, l_discount * 4 AS c, CAST(l_quantity AS BIGINT) % 5 AS n FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN n = 0 THEN 'sin edificios' WHEN c < 0.02 THEN '< 2 %' WHEN c < 0.05 THEN '2 – 5 %' WHEN c < 0.1 THEN '5 – 10 %' WHEN c < 0.2 THEN '10 – 20 %'
        WHEN c < 0.3 THEN '20 – 30 %' ELSE '≥ 30 %' END AS tramo,
      CASE WHEN n = 0 THEN '#d9d9d9' WHEN c < 0.02 THEN '#ffffcc' WHEN c < 0.05 THEN '#c7e9b4' WHEN c < 0.1 THEN '#7fcdbb' WHEN c < 0.2 THEN '#41b6c4' WHEN c < 0.3 THEN '#2c7fb8' ELSE '#253494' END AS color FROM b""")
def band(spark, sf):
    c, n = F.col("l_discount") * 4, F.col("l_quantity").cast("bigint") % 5
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", S.occupation_label(c, n).alias("tramo"), S.occupation_colour(c, n).alias("color"))


@query("I17_data_date", "roles", """WITH d AS (SELECT row_id, datos_sii, CASE WHEN datos_sii THEN periodo_sii END AS p, '2025-2' AS c FROM roles),
    e AS (SELECT row_id, datos_sii AND p IS NULL AS inferido, CASE WHEN datos_sii AND p IS NULL THEN c ELSE p END AS u, c FROM d),
    f AS (SELECT *, 2026 * 2 + 1 - (CAST(substr(coalesce(u, c), 1, 4) AS INT) * 2 + CAST(substr(coalesce(u, c), 6, 1) AS INT) - 1) AS atraso FROM e)
    SELECT row_id, inferido, u AS periodo, atraso, CASE WHEN u IS NULL THEN 'sin_dato' WHEN atraso > 0 THEN 'atrasado' ELSE 'al_dia' END AS estado FROM f""")
def data_date(spark, sf):
    d = F.col("datos_sii")
    s = S.data_date(F.when(d, F.col("periodo_sii")), F.lit("2025-2"), F.lit("2026-10-07").cast("date"), d)
    return relation(spark, sf, "roles").select("row_id", s.alias("s")).select(
        "row_id", F.col("s.periodo_inferido").alias("inferido"), F.col("s.periodo_sii").alias("periodo"), F.col("s.atraso_semestres").alias("atraso"), F.col("s.estado").alias("estado"))


@query("I18_ground_distance", "points", "SELECT pid, round(sqrt(pow((x - y) / 1e5 * 111320.0 * cos(radians(-38.7)), 2) + pow((y / 1e5) * 110574.0, 2)), 4) AS metros FROM points")
def distance(spark, sf):
    d = G.ground_distance(F.col("x") / 1e5, F.lit(-38.7) + F.col("y") / 1e5, F.col("y") / 1e5, F.lit(-38.7))
    return relation(spark, sf, "points").select("pid", F.round(d, 4).alias("metros"))


@query("I19_estimated_height", "buildings", """SELECT bid, coalesce(height, num_floors * 3.5, 3.5) AS altura,
    CASE WHEN height IS NOT NULL THEN 'overture_height' WHEN num_floors IS NOT NULL THEN 'overture_num_floors' ELSE 'estimado' END AS origen FROM buildings""")
def height(spark, sf):
    h, n = F.col("height"), F.col("num_floors")
    return relation(spark, sf, "buildings").select("bid", S.estimated_height(h, n, 3.5).alias("altura"), S.height_source(h, n).alias("origen"))


@query("I20_zoom_tolerance", sql="SELECT p_partkey, round(CASE WHEN p_size % 20 >= 16 THEN 0.0 ELSE 1.2e-5 * pow(2.0, 15 - p_size % 20) END, 9) AS tolerancia FROM part")
def tolerance(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.round(S.zoom_tolerance(F.col("p_size") % 20), 9).alias("tolerancia"))


@query("I21_region_colour", sql="""SELECT c_custkey, CASE lpad(CAST(c_nationkey AS VARCHAR), 2, '0') WHEN '15' THEN '#8dd3c7' WHEN '01' THEN '#ffffb3' WHEN '02' THEN '#bebada' WHEN '03' THEN '#fb8072'
    WHEN '04' THEN '#80b1d3' WHEN '05' THEN '#fdb462' WHEN '13' THEN '#b3de69' WHEN '06' THEN '#fccde5' WHEN '07' THEN '#d9d9d9' WHEN '16' THEN '#bc80bd' WHEN '08' THEN '#ccebc5' WHEN '09' THEN '#ffed6f'
    WHEN '14' THEN '#a6cee3' WHEN '10' THEN '#fdbf6f' WHEN '11' THEN '#cab2d6' WHEN '12' THEN '#b2df8a' ELSE '#e0e0e0' END AS color FROM customer""")
def region_colour(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", S.region_colour(F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).alias("color"))


RAMP = [(-200.0, "#000000"), (0.0, "#204080"), (200.0, "#ff8000")]


@query("I22_ramp_linear", "pixels", """SELECT row, col, CAST(round_even(CASE WHEN value <= -200 THEN 0 WHEN value <= 0 THEN (value + 200) / 200 * 32 WHEN value <= 200 THEN 32 + value / 200 * 223 ELSE 255 END, 0) AS INT) AS r,
    CAST(round_even(CASE WHEN value <= -200 THEN 0 WHEN value <= 0 THEN (value + 200) / 200 * 64 WHEN value <= 200 THEN 64 + value / 200 * 64 ELSE 128 END, 0) AS INT) AS g,
    CAST(round_even(CASE WHEN value <= -200 THEN 0 WHEN value <= 0 THEN (value + 200) / 200 * 128 WHEN value <= 200 THEN 128 - value / 200 * 128 ELSE 0 END, 0) AS INT) AS b, 255 AS a FROM pixels""")
def ramp_linear(spark, sf):
    return relation(spark, sf, "pixels").select("row", "col", S.ramp_colour(F.col("value"), RAMP).alias("k")).select("row", "col", "k.*")


@query("I22_ramp_step", "pixels", """SELECT row, col, CASE WHEN value >= 200 THEN 255 WHEN value >= 0 THEN 32 ELSE 0 END AS r, CASE WHEN value >= 200 THEN 128 WHEN value >= 0 THEN 64 ELSE 0 END AS g,
    CASE WHEN value >= 200 THEN 0 WHEN value >= 0 THEN 128 ELSE 0 END AS b, CASE WHEN value >= -200 THEN 255 ELSE 0 END AS a FROM pixels""")
def ramp_step(spark, sf):
    return relation(spark, sf, "pixels").select("row", "col", S.ramp_colour(F.col("value"), RAMP, step=True).alias("k")).select("row", "col", "k.*")


@query("I23_residential", "feat", r"SELECT gid, regexp_matches(concat(coalesce(zona, 'None'), ' ', coalesce(zona_desc, '')), '(?i)RESIDENC|HABITAC|VIVIEND|\bH\s?\d|\bZH|\bZR\d') AS residencial FROM feat")
def residential(spark, sf):
    return relation(spark, sf, "feat").select("gid", X.residential(F.col("zona"), F.col("zona_desc")).alias("residencial"))


@query("I24_shape_id", "feat", "SELECT x1 - x0 AS ancho, y1 - y0 AS alto, count(DISTINCT concat(x0, ',', y0)) AS formas FROM feat GROUP BY ALL")
def shape_id(spark, sf):
    df = relation(spark, sf, "feat").withColumns({"ancho": F.expr("x1 - x0"), "alto": F.expr("y1 - y0")})
    return df.groupBy("ancho", "alto").agg(F.countDistinct(G.shape_id(G.box(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")))).alias("formas"))


@query("I25_half_even_rounding", sql="SELECT l_orderkey, l_linenumber, l_partkey, round_even(l_quantity / 2, 0) AS mitad, left(concat(l_returnflag, l_linestatus), 1) AS corto FROM lineitem")
def rounding(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", half_even(F.col("l_quantity") / 2, 0).alias("mitad"), F.left(F.concat("l_returnflag", "l_linestatus"), F.lit(1)).alias("corto"))


LON, LAT = "(-75 + pid % 1000 / 200e0)", "(-50 + pid % 977 / 30e0)"


@query("I26_web_mercator", "points", f"""SELECT pid, round(radians({LON}) * 6378137.0, 3) AS x, round(ln(tan(pi() / 4 + radians({LAT}) / 2)) * 6378137.0, 3) AS y FROM points""")
def web_mercator(spark, sf):
    p = relation(spark, sf, "points")
    return p.select("pid", F.round(C.web_mercator_x(F.expr(LON)), 3).alias("x"), F.round(C.web_mercator_y(F.expr(LAT)), 3).alias("y"))


@query("I26_equal_area", "points", f"""SELECT pid, round({LON}, 7) AS lon, round({LAT}, 7) AS lat FROM points""")
def equal_area(spark, sf):
    """Forward and inverse conic projection return to the same place."""
    p = relation(spark, sf, "points").select("pid", C.albers_xy(F.expr(LON), F.expr(LAT)).alias("p"))
    p = p.select("pid", C.albers_lonlat(F.col("p.x"), F.col("p.y")).alias("q"))
    return p.select("pid", F.round("q.x", 7).alias("lon"), F.round("q.y", 7).alias("lat"))


@query("I27_area_bbox_validity", "feat", """SELECT gid, (x1 - x0) * (y1 - y0) AS area, x0 AS xmin, y0 AS ymin, x1 AS xmax, y1 AS ymax, round((x0 + x1) / 2, 6) AS cx, 1 AS partes, gid % 13 = 0 AND x1 > x0 AS cruzada FROM feat""")
def measures(spark, sf):
    df = shaped(spark, sf, "feat")
    g = F.col("geom")
    ring = F.get(F.get(g, F.lit(0)), F.lit(0))
    bow = F.array(F.array(F.array(ring[0], ring[2], ring[1], ring[3], ring[0])))
    b = G.bbox(g)
    return df.select("gid", G.area(g).alias("area"), b["xmin"].alias("xmin"), b["ymin"].alias("ymin"), b["xmax"].alias("xmax"), b["ymax"].alias("ymax"),
                     F.round(G.centroid_x(g), 6).alias("cx"), G.part_count(g).alias("partes"), G.crosses_itself(F.when(F.col("gid") % 13 == 0, bow).otherwise(g)).alias("cruzada"))


@query("I28_interior_point", "feat", "SELECT gid, (x0 + x1) / 2 AS x, (y0 + y1) / 2 AS y FROM feat")
def interior(spark, sf):
    return shaped(spark, sf, "feat").select("gid", G.interior_point(F.col("geom")).alias("p")).select("gid", "p.x", "p.y")


@query("I31_point_segment_distance", "lots", "SELECT rid, round(sqrt(pow(greatest(x0 - 10 - x0, 0, x0 - 10 - x1), 2) + 0), 6) + round(10.0, 6) AS d FROM lots")
def segment_distance(spark, sf):
    """Distance from a point 10 m west of every lot to its boundary."""
    df = relation(spark, sf, "lots").withColumns({"px": F.expr("x0 - 10"), "py": F.expr("(y0 + y1) / 2")})
    es = G.edges(G.box(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")))
    return df.select("rid", F.round(G.boundary_distance(es, F.col("px"), F.col("py")), 6).alias("d"))


@query("C3_instrument_name", sql=r"SELECT doc_id, coalesce(nullif(trim(replace(regexp_replace(concat('PRC_', source, '_', lang), '(?i)^(prc|prms|prm|pri|seccional|ps|lu|plan[_ ]regulador|limite[_ ]urbano)[_ ]*', ''), '_', ' ')), ''), 'x') AS nombre FROM documents")
def names(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.instrument_name(F.concat(F.lit("PRC_"), "source", F.lit("_"), "lang")).alias("nombre"))


@query("C5_clean_text", sql=r"SELECT conv_id, turn, nullif(regexp_replace(CASE WHEN turn % 3 = 0 THEN '   ' ELSE concat('  ', text, ' ') END, '^\s+|\s+$', '', 'g'), '') AS limpio FROM conversations")
def cleaned(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", X.clean(F.expr("CASE WHEN turn % 3 = 0 THEN '   ' ELSE concat('  ', text, ' ') END")).alias("limpio"))


@query("C20_finite_values", sql="SELECT event_id, CASE WHEN event_id % 3 = 2 THEN value END AS v FROM events")
def finite(spark, sf):
    v = F.expr("CASE event_id % 3 WHEN 0 THEN double('NaN') WHEN 1 THEN double('Infinity') ELSE value END")
    return table(spark, sf, "events").select("event_id", S.finite(v).alias("v"))

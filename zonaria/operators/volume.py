"""Existing, calculated and possible volume of parcels."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numeric import half_even
from ..functions import geometry as G
from ..functions import scales as S
from ..functions import text as X
from .overlay import pair_areas, sweep_groups
from .spatial_join import points_in_polygons

# Fixed values of the model.
INSIDE, PART, PART_OF_PARCEL = 0.5, 0.10, 0.10
FLOOR_HEIGHT = 3.5
NORM_COLUMNS = ("ipt_nombre", "zona", "ocupacion_max", "constructibilidad_max", "altura_max_pisos", "altura_max_m",
                "altura_piso_ref_m", "antejardin_m", "distanciamiento_m", "agrupamiento", "rasante_grados", "densidad_max",
                "articulo_fuente", "fuente_por_valor", "notas", "validado_por", "fecha_validacion", "estado")


def _pairs(parcels: DataFrame, buildings: DataFrame, size: float) -> DataFrame:
    """(rid parcel, lid building, part, whole building area, floors, height)."""
    whole = buildings.select(F.col("id").alias("lid"), G.area(F.col("geom")).alias("whole"), "num_floors",
                             *[c for c in ("height",) if c in buildings.columns])
    parts = pair_areas(buildings.select(F.col("id").alias("lid"), "geom"), parcels.select(F.col("rid"), "geom"), size)
    return parts.withColumnRenamed("area", "part").join(whole, "lid")


def calculated(parcels: DataFrame, buildings: DataFrame, size: float, zones: DataFrame | None = None,
               rule: str = "proporcional", floor_height: float | None = None) -> DataFrame:
    """Calculated volume per parcel(rid, rol, m2_terreno, sup_construida_total, pisos_max, geom).

    ``proporcional``: the part of each building inside the parcel, slivers ignored. ``umbral50``: the whole
    building goes to the parcel holding more than half of it.
    """
    if rule not in ("proporcional", "umbral50"):
        raise ValueError(f"regla desconocida: {rule}")
    size_of = parcels.select("rid", G.area(F.col("geom")).alias("area_parcel"))
    pair = _pairs(parcels, buildings, size).join(size_of, "rid")
    share, of_parcel = F.col("part") / F.col("whole"), F.col("part") / F.col("area_parcel")
    if rule == "umbral50":
        kept = pair.where(share > INSIDE).withColumn("part", F.col("whole"))
    else:
        kept = pair.where((share > INSIDE) | ((share >= PART) & (of_parcel >= PART_OF_PARCEL)))
    owned = kept.withColumn("shared", F.count("*").over(W.partitionBy("lid")) > 1)
    sums = owned.groupBy("rid").agg(
        F.count("*").alias("n_edificios"), F.sum("part").alias("huella"), F.count(F.when(F.col("shared"), 1)).alias("n_comp"),
        F.max(S.finite(F.col("num_floors"))).alias("floors"))
    base = parcels.join(size_of, "rid").join(sums, "rid", "left")
    if zones is not None:
        points = parcels.select(F.col("rid").alias("pid"), G.interior_point(F.col("geom")).alias("p")).select("pid", "p.x", "p.y")
        hits = (points_in_polygons(points, zones.select(F.col("zid").alias("gid"), "geom"), size).withColumnRenamed("gid", "zid")
                .join(zones.select("zid", F.col("zona").alias("_z")), "zid"))
        base = base.join(hits.groupBy(F.col("pid").alias("rid")).agg(F.min_by("_z", F.when(F.col("_z").isNotNull(), F.col("zid"))).alias("zona")), "rid", "left")
    else:
        base = base.withColumn("zona", F.lit(None).cast("string"))
    return _volume_columns(base, floor_height)


def _volume_columns(base: DataFrame, floor_height: float | None) -> DataFrame:
    built = F.nullif(S.finite(F.col("sup_construida_total")), F.lit(0.0))
    land = F.coalesce(F.nullif(S.finite(F.col("m2_terreno")), F.lit(0.0)), F.col("area_parcel"))
    print_area = F.coalesce("huella", F.lit(0.0))
    base = base.withColumns({"_c": built, "_t": land, "_h": print_area, "n_edificios": F.coalesce("n_edificios", F.lit(0)),
                             "n_comp": F.coalesce("n_comp", F.lit(0)), "zona": F.coalesce("zona", F.lit(""))})
    c, t, h = F.col("_c"), F.col("_t"), F.col("_h")
    source = F.when(h <= 0, "").when(c.isNotNull(), "sii").when(F.col("floors").isNotNull(), "overture_num_floors").otherwise("")
    floors = (F.when(source == "sii", F.greatest(F.lit(1), half_even(c / h, 0).cast("int")))
              .when(source == "overture_num_floors", F.col("floors").cast("int")))
    base = base.withColumns({"fuente_pisos": source, "pisos_est": floors})
    ok = F.col("pisos_est").isNotNull()
    many = ok & (F.col("pisos_est") >= 5)
    shared = F.col("n_comp")
    plural = F.when(shared > 1, "s").otherwise("")
    notices = F.array(
        F.when(h <= 0, "sin huella de Overture dentro del predio"),
        F.when((h > 0) & ~ok, "sin superficie construida SII ni num_floors de Overture"),
        F.when(many, F.concat(F.col("pisos_est").cast("string"), F.lit(
            " pisos estimados: la huella de Overture puede estar incompleta (la construida SII es mucho mayor que la huella)"))),
        F.when(shared > 0, F.concat(shared.cast("string"), F.lit(" edificio"), plural, F.lit(" compartido"), plural, F.lit(
            " con otros terrenos (pareado o continuo): se cuenta solo la parte que cae dentro de este terreno"))),
        F.when((h > 0) & (c / h < 0.5), "la construida SII es menos de la mitad de la huella: puede haber construcción sin registrar"),
        F.when((t > 0) & (h > t * 1.05), "la huella supera la superficie del predio"))
    m2 = h * F.col("pisos_est")
    confidence = F.when(many, "baja").when(ok, "media").otherwise("")
    volume = half_even(m2 * floor_height, 1) if floor_height else F.lit(None).cast("double")
    extra = [F.col(k) for k in ("direccion", "n_unidades", "calidad_geometria", "origen") if k in base.columns]
    return base.select(
        "rid", "rol", *extra, "zona", half_even(t, 1).alias("sup_terreno_m2"), c.alias("sup_construida_sii_m2"), "n_edificios",
        half_even(h, 1).alias("huella_m2"), "pisos_est", S.finite(F.col("pisos_max")).alias("pisos_max_sii"),
        half_even(m2, 1).alias("m2_equiv"), volume.alias("v_calc_m3"), half_even(F.when(t > 0, h / t), 3).alias("ocupacion_predio"),
        F.when(ok, "ok").otherwise("sin_dato").alias("estado"), F.when(F.col("n_edificios") > 0, "overture").otherwise("").alias("fuente_huella"),
        "fuente_pisos", confidence.alias("confianza_pisos"), F.concat_ws("; ", F.array_compact(notices)).alias("avisos"))


def existing(parcels: DataFrame, buildings: DataFrame, size: float, floor_height: float = FLOOR_HEIGHT) -> DataFrame:
    """Existing volume of parcels(rid, geom): buildings with more than half of their area inside."""
    inside = _pairs(parcels, buildings, size).where(F.col("part") / F.greatest("whole", F.lit(1e-9)) > INSIDE)
    nf, hh = S.finite(F.col("num_floors")), S.finite(F.col("height"))
    floors = F.greatest(F.lit(1), F.coalesce(half_even(nf, 0).cast("int"), half_even(hh / floor_height, 0).cast("int"), F.lit(1)))
    source = F.when(nf.isNotNull(), "overture_num_floors").when(hh.isNotNull(), "overture_height").otherwise("estimado")
    rows = inside.withColumns({"floors": floors, "src": source})
    sums = rows.groupBy("rid").agg(
        F.count("*").alias("n_edificios"), F.sum("whole").alias("h"), F.sum(F.col("whole") * F.col("floors")).alias("m2"),
        F.min("src").alias("s0"), F.max("src").alias("s1"), F.max(F.col("src") == "estimado").alias("cota_inferior"))
    base = parcels.select("rid", G.area(F.col("geom")).alias("t")).join(sums, "rid", "left")
    some = F.col("n_edificios") > 0
    return base.select(
        "rid", F.coalesce("n_edificios", F.lit(0)).alias("n_edificios"), half_even(F.coalesce("h", F.lit(0.0)), 1).alias("huella_m2"),
        half_even(F.coalesce("m2", F.lit(0.0)), 1).alias("m2_existente"), half_even(F.col("m2") / F.nullif("h", F.lit(0.0)), 2).alias("pisos_est"),
        F.when(F.col("s0") == F.col("s1"), F.col("s0")).when(some, "mixto").alias("fuente_pisos"),
        F.when(some & F.col("cota_inferior"), "baja").when(some, "media").alias("confianza_pisos"),
        F.coalesce("cota_inferior", F.lit(False)).alias("cota_inferior"), half_even("t", 1).alias("sup_terreno_m2"))


def _setback_strips(geom: Column, distance: Column) -> Column:
    """Ground within ``distance`` of the boundary, as polygons: a strip along every edge, inwards, and a mitred
    corner at every reflex vertex."""
    def directed(ring: Column, outer: Column) -> Column:
        wrong = (G.ring_signed_area(ring) < 0) == outer
        return F.when(wrong, F.reverse(ring)).otherwise(ring)

    def normal(e: Column) -> Column:
        length = F.sqrt(F.pow(e["x1"] - e["x0"], 2) + F.pow(e["y1"] - e["y0"], 2))
        return F.struct((-(e["y1"] - e["y0"]) / length).alias("x"), ((e["x1"] - e["x0"]) / length).alias("y"))

    def ring_strips(ring: Column) -> Column:
        es = F.filter(G.segments(ring), lambda e: (e["x0"] != e["x1"]) | (e["y0"] != e["y1"]))

        def strip(e: Column) -> Column:
            n = normal(e)
            dx, dy = n["x"] * distance, n["y"] * distance
            p = G.point
            return F.array(F.array(p(e["x0"], e["y0"]), p(e["x1"], e["y1"]), p(e["x1"] + dx, e["y1"] + dy),
                                   p(e["x0"] + dx, e["y0"] + dy), p(e["x0"], e["y0"])))

        def corner(e: Column, f: Column) -> Column:
            a, b = normal(e), normal(f)
            dot = a["x"] * b["x"] + a["y"] * b["y"]
            reflex = (e["x1"] - e["x0"]) * (f["y1"] - f["y0"]) - (e["y1"] - e["y0"]) * (f["x1"] - f["x0"]) < 0
            k = distance / (1 + dot)
            p = G.point
            vx, vy = e["x1"], e["y1"]
            kite = F.array(p(vx, vy), p(vx + a["x"] * distance, vy + a["y"] * distance),
                           p(vx + (a["x"] + b["x"]) * k, vy + (a["y"] + b["y"]) * k),
                           p(vx + b["x"] * distance, vy + b["y"] * distance), p(vx, vy))
            bevel = F.array(p(vx, vy), p(vx + a["x"] * distance, vy + a["y"] * distance), p(vx + b["x"] * distance, vy + b["y"] * distance), p(vx, vy))
            return F.when(reflex, F.array(F.when(dot > -0.92, kite).otherwise(bevel)))     # sharper corners exceed the mitre limit of 5

        def both(es: Column) -> Column:
            following = F.concat(F.slice(es, F.lit(2), F.greatest(F.size(es) - 1, F.lit(0))), F.slice(es, 1, 1))
            return F.concat(F.transform(es, strip), F.array_compact(F.zip_with(es, following, corner)))

        return G.let(es, both)

    rings = F.flatten(F.transform(geom, lambda poly: F.transform(poly, lambda r, i: directed(r, i == 0))))
    return F.flatten(F.transform(rings, ring_strips))


def setback_area(parcels: DataFrame) -> DataFrame:
    """Area left of parcels(rid, geom, setback) after moving every side inwards: (rid, area_base)."""
    whole = parcels.select("rid", F.lit(0).alias("n"), "geom")
    strips = (parcels.where("setback > 0").select("rid", F.posexplode(_setback_strips(F.col("geom"), F.col("setback"))).alias("n", "g"))
              .select("rid", (F.col("n") + 1).alias("n"), F.array("g").alias("geom")))
    edges = (whole.unionByName(strips)
             .select("rid", F.struct("n").alias("item"), F.explode(G.edges(F.col("geom"))).alias("e")).where("e.y0 <> e.y1")
             .select("rid", "item", F.when(F.expr("e.y0 < e.y1"), F.col("e.x0")).otherwise(F.col("e.x1")).alias("x0"),
                     F.least("e.y0", "e.y1").alias("y0"),
                     F.when(F.expr("e.y0 < e.y1"), F.col("e.x1")).otherwise(F.col("e.x0")).alias("x1"),
                     F.greatest("e.y0", "e.y1").alias("y1")))
    cells = sweep_groups(edges, ["rid"])
    free = (F.size("active") == 1) & (F.get("active", F.lit(0))["n"] == 0)
    return cells.where(free).groupBy("rid").agg(F.sum("area").alias("area_base"))


def possible(parcels: DataFrame, norms: DataFrame, default_height: float = FLOOR_HEIGHT) -> DataFrame:
    """Envelope of phase 1, one row per parcel(rid, geom) and norm row(rid, nid, the norm texts)."""
    n = X.first_number
    own_ref = n(F.col("altura_piso_ref_m"))
    own_ref = F.nullif(own_ref, F.lit(0.0))
    front = X.numbers_in(F.col("antejardin_m"))
    rows = norms.withColumns({
        "occ": n(F.col("ocupacion_max")), "cons": n(F.col("constructibilidad_max")), "alt_m": n(F.col("altura_max_m")),
        "alt_p": n(F.col("altura_max_pisos")), "h_own": own_ref, "front": front, "dist": n(F.col("distanciamiento_m"))})
    rows = rows.withColumns({
        "h_ref": F.coalesce("h_own", F.lit(default_height)),
        "retr": F.greatest(F.coalesce(F.array_min("front"), F.lit(0.0)), F.coalesce("dist", F.lit(0.0)))})
    missing = F.array_compact(F.array(
        F.when(F.col("occ").isNull(), "ocupacion_max"), F.when(F.col("cons").isNull(), "constructibilidad_max"),
        F.when(F.col("alt_m").isNull() & F.col("alt_p").isNull(), "altura_max_m o altura_max_pisos")))
    rows = rows.withColumn("missing", missing)
    whole = parcels.select("rid", "geom", G.area(F.col("geom")).alias("t"))
    full = rows.join(whole, "rid")
    bases = setback_area(full.where((F.size("missing") == 0) & (F.col("retr") > 0)).select(
        F.concat_ws("|", F.col("rid").cast("string"), F.col("nid").cast("string")).alias("rid"), "geom", F.col("retr").alias("setback")))
    keyed = full.withColumn("_k", F.concat_ws("|", F.col("rid").cast("string"), F.col("nid").cast("string"))).join(
        bases.withColumnRenamed("rid", "_k"), "_k", "left")
    t, occ, cons = F.col("t"), F.col("occ"), F.col("cons")
    base = F.when(F.col("retr") > 0, F.coalesce("area_base", F.lit(0.0))).otherwise(t)
    floors = F.coalesce(F.floor("alt_p"), F.floor(F.col("alt_m") / F.col("h_ref") + 1e-9)).cast("int")
    keyed = keyed.withColumns({"base": base, "pisos": floors})
    keyed = keyed.withColumns({"first": F.least(F.col("base"), occ * t)})
    keyed = keyed.withColumns({"by_height": F.col("first") * F.col("pisos"), "by_index": cons * t})
    keyed = keyed.withColumn("m2", F.least("by_height", "by_index"))
    keyed = keyed.withColumns({"v_max": occ * t * F.coalesce("alt_m", F.col("pisos") * F.col("h_ref")), "v_opt": F.col("m2") * F.col("h_ref")})
    lacking = F.size("missing") > 0
    bad = F.col("v_max") + 1e-6 < F.col("v_opt")
    state = F.when(lacking, "sin_dato").when(F.col("base") <= 0, "sin_base").when(bad, "error_datos").otherwise("ok")
    reason = (F.when(lacking, F.concat(F.lit("La norma no trae: "), F.array_join("missing", ", "), F.lit(" (no se completan).")))
              .when(F.col("base") <= 0, "Con retranqueo uniforme no queda base edificable; la fase 1 no es aplicable a un predio tan angosto."))

    def shown(value: Column, digits: int = 1) -> Column:
        return F.when(~lacking, half_even(value, digits))

    steps = F.concat(F.col("retr").cast("string"), F.lit(" m"))
    assumptions = F.array_compact(F.array(
        F.lit("Fase 1: sin rasantes (fase 2, con geometría 3D)."),
        F.when(F.col("h_own").isNull(), F.concat(F.lit("Altura de piso de referencia "), F.col("h_ref").cast("string"),
                                                 F.lit(" m: parámetro del modelo, no es norma; confirmar con el arquitecto."))),
        F.when(~lacking & (F.size("front") > 1), F.concat(
            F.lit("Antejardín según clase de vía ("), F.array_join(F.transform("front", lambda v: v.cast("string")), ", "),
            F.lit(" m): se usa el menor ("), F.array_min("front").cast("string"), F.lit(" m), porque el frente no se identifica."))),
        F.when(~lacking & (F.col("retr") > 0), F.concat(
            F.lit("Retranqueo uniforme de "), steps, F.lit(" en todos los deslindes (el antejardín rige solo al frente y el "
                                                           "distanciamiento solo con ciertos vecinos)."))),
        F.when(~lacking & bad, "ERROR DE DATOS: V_max < V_opt."),
        F.when(~lacking & (F.col("base") <= 0), "El predio es demasiado angosto para el retranqueo uniforme de la fase 1: no queda base "
               "edificable. La simplificación no aplica a este predio (la fase 2 distingue frente y deslindes).")))
    return keyed.select(
        "rid", "nid", F.nullif("agrupamiento", F.lit("")).alias("agrupamiento"), F.col("estado").alias("normas_estado"),
        F.col("h_ref").alias("altura_piso_ref_m"), state.alias("estado"), reason.alias("motivo"), shown(t).alias("sup_terreno_m2"),
        F.when(~lacking, F.col("retr")).alias("retranqueo_m"), shown(F.col("base")).alias("area_base_m2"),
        shown(F.col("first")).alias("area_primer_piso_m2"), F.when(~lacking, F.col("pisos")).alias("pisos_max"),
        shown(F.col("pisos") * F.col("h_ref")).alias("altura_envolvente_m"), shown(F.col("m2")).alias("m2_max"),
        F.when(~lacking, F.when(F.col("by_height") <= F.col("by_index"), "ocupación × altura").otherwise("constructibilidad")).alias("limita"),
        shown(F.col("v_max")).alias("v_max_m3"), shown(F.col("v_opt")).alias("v_opt_m3"),
        shown(F.col("v_opt") / F.nullif("v_max", F.lit(0.0)), 3).alias("eficiencia"), assumptions.alias("simplificaciones"))


def compare(existing_: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Adds iov, remanente_m2 and estado_iov to the scenarios of each parcel."""
    have = existing_.select("rid", F.col("m2_existente").alias("_e"))
    usable = (F.col("estado") == "ok") & F.col("_e").isNotNull() & (F.col("m2_max") != 0)
    index = F.when(usable, F.col("_e") / F.col("m2_max"))
    return scenarios.join(have, "rid", "left").withColumns({
        "iov": half_even(index, 3), "remanente_m2": half_even(F.when(usable, F.col("m2_max") - F.col("_e")), 1),
        "estado_iov": S.volume_state(index)}).drop("_e")


def terrains(parcels: DataFrame, only_exact: bool = True, limit: int | None = None, seed: int = 1) -> DataFrame:
    """One row per terrain: roles on the same polygon summed, land taken from the polygon when they are several."""
    rows = parcels.where(F.col("datos_sii") & F.col("rol").isNotNull())
    if only_exact:
        rows = rows.where("exacto")
    tie = F.struct("rol", *[c for c in ("row_id",) if c in parcels.columns])

    def first(name: str) -> Column:
        return F.min_by(name, F.when(F.col(name).isNotNull(), tie))

    grouped = rows.groupBy("id_poligono").agg(
        F.min("rol").alias("r0"), F.countDistinct("rol").alias("n_unidades"), first("direccion").alias("direccion"),
        first("sup_terreno_m2").alias("land"), first("area_poligono_m2").alias("area"), F.sum("sup_construida_m2").alias("sup_construida_total"),
        F.max("pisos_max").alias("pisos_max"), F.bool_and("exacto").alias("all_exact"), first("origen").alias("origen"),
        *([F.first("geom").alias("geom")] if "geom" in parcels.columns else []))
    one = F.col("n_unidades") == 1
    more = F.concat(F.col("r0"), F.lit(" (+"), (F.col("n_unidades") - 1).cast("string"), F.lit(" unidades)"))
    out = grouped.select(
        "id_poligono", F.when(one, F.col("r0")).otherwise(more).alias("rol"), "direccion",
        F.when(one & (F.col("land") > 0), F.col("land")).otherwise(F.col("area")).alias("m2_terreno"), "sup_construida_total", "pisos_max",
        "n_unidades", F.when(F.col("all_exact"), "exacta").otherwise("aproximada").alias("calidad_geometria"), "origen",
        *(["geom"] if "geom" in parcels.columns else []))
    return out if limit is None else reproducible_sample(out, "id_poligono", limit, seed)


def local_parcels(parcels: DataFrame, size: float, zones: DataFrame | None = None, zone: str | None = None, only_exact: bool = True,
                  limit: int | None = None, seed: int = 1) -> DataFrame:
    """One row per terrain of a stored backup (see :func:`terrains`). With ``zone`` only roles whose interior point lies in a
    piece of that zone: ``zones(pid, zona, geom)``; a zone that none of the pieces has is an error. At most ``limit`` terrains."""
    if zone is not None and zones is not None:
        chosen = zones.where(F.col("zona") == zone)
        if chosen.isEmpty():
            raise ValueError(f"La zona «{zone}» no existe en las piezas dadas")
        points = parcels.select(F.col("row_id").alias("pid"), G.interior_point(F.col("geom")).alias("p")).select("pid", "p.x", "p.y")
        inside = points_in_polygons(points, chosen.select(F.col("pid").alias("gid"), "geom"), size).select(F.col("pid").alias("row_id")).distinct()
        parcels = parcels.join(inside, "row_id", "left_semi")
    return terrains(parcels, only_exact, limit, seed)


def reproducible_sample(df: DataFrame, key: str, limit: int, seed: int) -> DataFrame:
    """At most ``limit`` rows, always the same for a seed and on any engine (top-k by digest, no full sort)."""
    return df.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string"))), key).limit(limit)


def zone_candidates(pieces: DataFrame, instrument: str, footprints: DataFrame, parcels: DataFrame, ordinances: DataFrame,
                    size: float) -> DataFrame:
    """Zones of one plan: hectares, % risk, pieces, residential, counts of buildings and parcels, % with height.
    pieces(pid, ipt_tipo, ipt_nombre, zona, zona_desc, riesgo, cut, geom), footprints(id, height, geom), parcels(rid, geom),
    ordinances(ipt_tipo, ipt_nombre, ordenanza_url)."""
    z = plan_zones(pieces, instrument)

    def located(df: DataFrame, key: str) -> DataFrame:
        points = df.select(F.col(key).alias("pid"), G.interior_point(F.col("geom")).alias("p")).select("pid", "p.x", "p.y")
        return (points_in_polygons(points, z.select(F.col("pid").alias("gid"), "geom"), size)
                .join(z.select(F.col("pid").alias("gid"), "zona"), "gid"))

    built = (located(footprints, "id").join(footprints.select(F.col("id").alias("pid"), "height"), "pid").groupBy("zona")
             .agg(F.count("*").alias("n_footprints"), half_even(100 * F.count(S.finite(F.col("height"))) / F.count("*"), 1).alias("pct_con_altura")))
    lots = located(parcels, "rid").groupBy("zona").agg(F.count("*").alias("n_predios"))
    sums = z.withColumn("a", G.area(F.col("geom"))).groupBy("zona").agg(
        F.min_by("zona_desc", F.when(F.col("zona_desc").isNotNull(), F.col("pid"))).alias("descripcion"), F.sum("a").alias("m2"),
        F.sum(F.when(F.col("riesgo"), F.col("a")).otherwise(0.0)).alias("m2r"), F.count("*").alias("piezas"), F.min("cut").alias("cut"))
    link = (ordinances.where((F.col("ipt_tipo") == "PRC") & (X.norm_text(F.col("ipt_nombre")) == X.norm_text(F.lit(instrument))))
            .agg(F.max("ordenanza_url").alias("u")).select(F.lit("PRC").alias("_t"), F.coalesce("u", F.lit("")).alias("ordenanza_url")))
    out = sums.join(built, "zona", "left").join(lots, "zona", "left").withColumn("_t", F.lit("PRC")).join(F.broadcast(link), "_t", "left")
    return out.select(
        "zona", "descripcion", half_even(F.col("m2") / 1e4, 2).alias("ha"), F.coalesce("n_predios", F.lit(0)).alias("n_predios"),
        F.coalesce("n_footprints", F.lit(0)).alias("n_footprints"), "pct_con_altura", half_even(100 * F.col("m2r") / F.col("m2"), 1).alias("pct_riesgo"),
        X.residential(F.col("zona"), F.col("descripcion")).alias("residencial"), "piezas",
        F.when(F.col("ordenanza_url") != "", "sí").otherwise("no").alias("ordenanza_portal"), "ordenanza_url", "cut",
    ).orderBy(F.desc("residencial"), F.desc("ha"))


def plan_zones(pieces: DataFrame, instrument: str) -> DataFrame:
    return pieces.where((F.col("ipt_tipo") == "PRC") & (X.norm_text(F.col("ipt_nombre")) == X.norm_text(F.lit(instrument))))


def add_norm_template(norms: DataFrame, keys: DataFrame) -> DataFrame:
    """Norm table plus an empty row for every key(ipt_nombre, zona) it does not have yet."""
    lacking = [c for c in NORM_COLUMNS if c not in norms.columns]
    if lacking:
        raise ValueError(f"faltan columnas: {lacking}")
    mark = [X.norm_text(F.col("ipt_nombre")).alias("_i"), X.norm_text(F.col("zona")).alias("_z")]
    fresh = keys.select("ipt_nombre", "zona", *mark).join(norms.select(*mark), ["_i", "_z"], "left_anti")
    blank = fresh.select("ipt_nombre", "zona", *[F.lit("").alias(c) for c in NORM_COLUMNS[2:]])
    return norms.select(*NORM_COLUMNS).unionByName(blank)

"""Cadastral parcels: cleaning, units per terrain, archive union, reassignment, lookups and answers."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import half_even
from ..functions import geometry as G
from ..functions import scales as S
from ..functions import text as X
from ..session import truncate_lineage
from .sampling import every_kth
from .spatial_join import first_polygon, near_candidates, points_in_polygons

# Fixed values of the product.
FILLED, BY_POINT, NEAR = "relleno_respaldo1", "punto_en_poligono", "cercano_50m"
ARCHIVE = "respaldo1"
MAX_UNITS = 2_000
ROLE_FIELDS = ("id", "manzana", "predio", "rol", "direccion", "destino_cod", "destino", "ubicacion", "sup_terreno_m2",
               "sup_construida_m2", "pisos_max", "anio_construccion", "periodo_sii", "lat_sii", "lon_sii")
READ_FIELDS = ("_ok", "comuna", "manzana", "predio", "rol", "nombreComuna", "direccion_sii", "dc_cod_destino", "dc_cod_ubicacion",
               "dc_sup_terreno", "supTerreno", "sup_construida_total", "pisos_max", "anio_construccion_min", "anio_construccion_max",
               "_match_method", "periodo", "lat", "lon")


def clean(raw: DataFrame, geom: str = "geom") -> DataFrame:
    """Raw backup rows (all text, plus cut, comuna_bcn, cod_capa, origen, geom) → typed parcel table."""
    for name in READ_FIELDS:
        if name not in raw.columns:
            raw = raw.withColumn(name, F.lit(None).cast("string"))
    rol = F.trim("rol")
    is_role = F.coalesce(rol.rlike(r"^\d{5}-\d{5}$"), F.lit(False))
    data = F.coalesce((F.trim("_ok") == "True") & is_role, F.lit(False))

    def number(name: str) -> Column:
        return F.expr(f"try_cast({name} AS double)")

    def positive(name: str) -> Column:
        return F.when(number(name) > 0, number(name))

    use = F.upper(F.trim("dc_cod_destino"))
    use = F.when(use.isin(*X.USES), use)
    year = number("anio_construccion_min")
    method = X.match_method(F.coalesce("_match_method", F.lit("")))
    raw = raw.withColumns({"_rol": F.when(is_role, rol), "_data": data, "_met": method, "_use": F.when(data, use)})
    d = F.col("_data")
    return raw.select(
        F.when(F.col("_rol").isNotNull(), F.concat_ws("-", "cut", "_rol")).alias("id"), "cut",
        F.coalesce(F.col("cod_capa"), F.trim("comuna")).alias("cod_sii"), F.substring("_rol", 1, 5).alias("manzana"),
        F.substring("_rol", 7, 5).alias("predio"), F.col("_rol").alias("rol"), F.col("comuna_bcn").alias("comuna"),
        F.when(d, X.address(F.col("direccion_sii"))).alias("direccion"), F.col("_use").alias("destino_cod"),
        X.code_label(F.col("_use"), X.USES).alias("destino"),
        F.when(d, X.code_label(F.upper(F.trim("dc_cod_ubicacion")), X.LOCATIONS)).alias("ubicacion"),
        half_even(F.when(d, F.coalesce(positive("dc_sup_terreno"), positive("supTerreno"))), 1).alias("sup_terreno_m2"),
        F.when(d, number("sup_construida_total")).alias("sup_construida_m2"), F.when(d, number("pisos_max")).alias("pisos_max"),
        F.when(d & (year > 1500) & (year < 2101), year).alias("anio_construccion"), F.when(d, X.semester(F.col("periodo"))).alias("periodo_sii"),
        half_even(G.area(F.col(geom)), 1).alias("area_poligono_m2"), F.col("_met").alias("metodo"), (F.col("_met") == "contiene").alias("exacto"),
        d.alias("datos_sii"), F.when(d, X.coordinate(F.col("lat"), -56, -17)).alias("lat_sii"),
        F.when(d, X.coordinate(F.col("lon"), -110, -66)).alias("lon_sii"), G.shape_id(F.col(geom)).alias("id_poligono"), "origen",
        F.col(geom).alias("geom"))


def usable_geometry(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a polygon, roles of the rows without one)."""
    empty = G.is_empty(F.col("geom"))
    rol = F.trim("rol")
    lost = raw.where(empty & rol.rlike(r"^\d{5}-\d{5}$")).select("cut", rol.alias("rol")).distinct()
    return raw.where(~empty), lost


def group_units(parcels: DataFrame, order: str = "row_id") -> DataFrame:
    """Exact copies (same comuna, role and polygon) dropped, first kept; roles counted per polygon: ``n_unidades``
    for the certain ones, ``n_asignados`` for all that have data."""
    rest = [c for c in parcels.columns if c not in ("cut", "rol", "id_poligono", "n_unidades", "n_asignados")]
    with_role = parcels.where(F.col("rol").isNotNull())
    kept = (with_role.groupBy("cut", "rol", "id_poligono").agg(F.min_by(F.struct(*rest), order).alias("b"))
            .select("cut", "rol", "id_poligono", *[F.col(f"b.{c}").alias(c) for c in rest]))
    rows = kept.unionByName(parcels.where(F.col("rol").isNull()).select(*kept.columns))
    units = (kept.where("datos_sii").groupBy("cut", "id_poligono")
             .agg(F.countDistinct(F.when(F.col("exacto"), F.col("rol"))).cast("int").alias("n_unidades"),
                  F.countDistinct("rol").cast("int").alias("n_asignados")))
    return rows.join(units, ["cut", "id_poligono"], "left").fillna(0, ["n_unidades", "n_asignados"])


def statistics(parcels: DataFrame) -> DataFrame:
    """Quality figures of each comuna."""
    data = F.col("datos_sii") & F.col("rol").isNotNull()
    shared = F.col("n_unidades") > 1
    return parcels.groupBy("cut").agg(
        F.count("*").alias("n"), F.coalesce(F.mode("periodo_sii", deterministic=True), F.lit("")).alias("periodo"),
        half_even(F.count("periodo_sii") / F.greatest(F.lit(1), F.count(F.when(F.col("datos_sii"), 1))), 3).alias("pct_periodo"),
        F.count(F.when(F.col("datos_sii"), 1)).alias("n_datos_sii"), F.countDistinct(F.when(data, F.col("rol"))).alias("n_roles"),
        F.count(F.when(F.col("exacto"), 1)).alias("n_exactos"), F.count(F.when(F.col("metodo") == "huerfano", 1)).alias("n_huerfanos"),
        (F.count("id") - F.countDistinct("id")).alias("n_ids_repetidos"),
        F.countDistinct(F.when(shared, F.col("id_poligono"))).alias("n_terrenos_copropiedad"),
        F.countDistinct(F.when(shared, F.col("rol"))).alias("n_roles_copropiedad"))


def vote(samples: DataFrame, group: str, choice: str, minimum: float = 0.9) -> DataFrame:
    """Most frequent ``choice`` per group with its share of all rows (rows without choice count too)."""
    total = samples.groupBy(group).agg(F.count("*").alias("total"))
    votes = samples.where(F.col(choice).isNotNull()).groupBy(group, choice).agg(F.count("*").alias("n"))
    best = votes.groupBy(group).agg(F.min(F.struct((-F.col("n")).alias("m"), F.col(choice).alias("c"))).alias("b"))
    share = half_even(F.coalesce(-F.col("b.m"), F.lit(0)) / F.col("total"), 3)
    return total.join(best, group, "left").select(
        group, F.col("b.c").alias(choice), share.alias("participacion"), (F.col("b.c").isNotNull() & (share >= minimum)).alias("ok"))


def sample_points(raw: DataFrame, size: int, order: str) -> DataFrame:
    """Interior points of a reproducible sample of each backup: raw(archivo, row_id, geom), at most ``size`` for each, evenly
    spread over its rows by ``order``."""
    taken = every_kth(raw.select("archivo", F.col(order).alias("pid"), "geom"), "archivo", "pid", size)
    return taken.select("archivo", "pid", G.interior_point(F.col("geom")).alias("p")).select("archivo", "pid", "p.x", "p.y")


def assign_cut(raw: DataFrame, comunas: DataFrame, order: str, tile: float, sample: int = 3_000, minimum: float = 0.9) -> DataFrame:
    """The comuna of every backup by the vote of its sampled points: (archivo, cut, participacion, ok). A backup whose points
    all lie outside has a null ``cut`` and share 0. raw(archivo, ``order``, geom), comunas(cut, geom)."""
    points = truncate_lineage(sample_points(raw, sample, order))
    asked = points.select(F.concat_ws("|", "archivo", F.col("pid").cast("string")).alias("pid"), "archivo", "x", "y")
    hits = first_polygon(asked, comunas.select(F.col("cut").alias("gid"), "geom"), tile)
    return vote(asked.select("pid", "archivo").join(hits.select("pid", F.col("gid").alias("cut")), "pid", "left"), "archivo", "cut", minimum)


def complete_with_archive(new: DataFrame, old: DataFrame, known: DataFrame) -> DataFrame:
    """New parcels plus the archived roles they lack. A role the new backup knows without polygon (``known(cut, rol)``)
    gets the archived polygon, marked approximate; a comuna only in the archive is taken whole."""
    comunas = new.select("cut").distinct()
    fresh = old.withColumn("origen", F.coalesce("origen", F.lit(ARCHIVE)))
    whole = fresh.join(comunas, "cut", "left_anti")
    lacking = (fresh.where(F.col("datos_sii") & F.col("rol").isNotNull()).join(comunas, "cut", "left_semi")
               .join(new.where(F.col("rol").isNotNull()).select("cut", "rol"), ["cut", "rol"], "left_anti"))
    marks = known.select("cut", "rol").distinct().withColumn("_f", F.lit(True))
    filled = lacking.join(marks, ["cut", "rol"], "left").withColumns({
        "exacto": F.col("exacto") & F.col("_f").isNull(),
        "metodo": F.when(F.col("_f").isNotNull(), FILLED).otherwise(F.col("metodo"))}).drop("_f")
    return (new.withColumn("procedencia", F.lit("nuevo")).unionByName(filled.withColumn("procedencia", F.lit("archivo")), allowMissingColumns=True)
            .unionByName(whole.withColumn("procedencia", F.lit("solo_archivo")), allowMissingColumns=True))


def reassign(parcels: DataFrame, size: float, max_distance: float = 50.0) -> DataFrame:
    """Role → polygon decision: parcels(cut, rol, id_poligono, geom, x, y, datos_sii, exacto, origen, area_poligono_m2, row_id)
    → (cut, rol, id_poligono anterior, id_nuevo, tipo). ``x, y`` is the role's own point in the plane of ``geom``.

    Inside a polygon: the one not archived, then the smaller. Outside: the nearest up to ``max_distance``. Without a
    point the assignment stays.
    """
    best_role = F.struct((~F.col("exacto")).alias("a"), F.col("row_id"))
    roles = (parcels.where(F.col("datos_sii") & F.col("rol").isNotNull()).groupBy("cut", "rol")
             .agg(F.min_by(F.struct("id_poligono", "x", "y"), best_role).alias("r"))
             .select("cut", "rol", "r.id_poligono", "r.x", "r.y", F.concat_ws("|", "cut", "rol").alias("pid")))
    pool = (parcels.groupBy("cut", "id_poligono").agg(
        F.min_by(F.struct("origen", "area_poligono_m2", "geom"), "row_id").alias("p"))
        .select("cut", "id_poligono", F.concat_ws("|", "cut", "id_poligono").alias("gid"), F.coalesce(F.col("p.origen") == ARCHIVE, F.lit(False)).alias("old"),
                F.coalesce(F.col("p.area_poligono_m2"), F.lit(1e11)).alias("area"), F.col("p.geom").alias("geom")))
    points = roles.where(F.col("x").isNotNull() & F.col("y").isNotNull()).select("pid", "x", "y")
    near = near_candidates(points, pool.select("gid", "geom"), max_distance, size, own_prefix="|")
    inside = F.col("within")
    order = F.struct((~inside).alias("a"), F.when(inside, F.col("old")).alias("b"), F.when(inside, F.col("area")).otherwise(F.col("distance")).alias("c"), F.col("gid"))
    best = (near.join(pool.select("gid", "old", "area"), "gid").groupBy("pid")
            .agg(F.min_by(F.struct("gid", "within"), order).alias("m")).select("pid", "m.gid", "m.within"))
    joined = roles.join(best, "pid", "left")
    no_point = F.col("x").isNull() | F.col("y").isNull()
    kind = (F.when(no_point, "sin_punto").when(F.col("within"), "dentro").when(F.col("gid").isNotNull(), "cercano").otherwise("ninguno"))
    target = F.when(no_point, F.col("id_poligono")).otherwise(F.substring_index("gid", "|", -1))
    return joined.select("cut", "rol", "id_poligono", target.alias("id_nuevo"), kind.alias("tipo"))


def apply_reassignment(parcels: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(parcel table after the decisions, roles left without polygon). A polygon that loses its roles stays as an orphan
    unless it comes from the archive."""
    best_role = F.struct((~F.col("exacto")).alias("a"), F.col("row_id"))
    others = [c for c in parcels.columns if c not in ("cut", "rol")]
    roles = (parcels.where(F.col("datos_sii") & F.col("rol").isNotNull()).groupBy("cut", "rol")
             .agg(F.min_by(F.struct(*others), best_role).alias("b")).select("cut", "rol", *[F.col(f"b.{c}").alias(c) for c in others]))
    shape_cols = ["area_poligono_m2"] + (["geom"] if "geom" in parcels.columns else [])
    pool = (parcels.groupBy("cut", "id_poligono").agg(F.min_by(F.struct(*shape_cols), "row_id").alias("p"))
            .select("cut", F.col("id_poligono").alias("id_nuevo"), *[F.col(f"p.{c}").alias(c) for c in shape_cols]))
    moved = (roles.drop("id_poligono", *shape_cols).join(decisions.select("cut", "rol", "id_nuevo", "tipo"), ["cut", "rol"])
             .where("tipo <> 'ninguno'").join(pool, ["cut", "id_nuevo"]).withColumnRenamed("id_nuevo", "id_poligono"))
    moved = moved.withColumns({
        "exacto": F.when(F.col("tipo") == "dentro", True).when(F.col("tipo") == "cercano", False).otherwise(F.col("exacto")),
        "metodo": F.when(F.col("tipo") == "dentro", BY_POINT).when(F.col("tipo") == "cercano", NEAR).otherwise(F.col("metodo"))}).drop("tipo")
    left = (parcels.where(~F.coalesce(F.col("origen") == ARCHIVE, F.lit(False)))
            .join(moved.select("cut", "id_poligono").distinct(), ["cut", "id_poligono"], "left_anti"))
    rest = [c for c in left.columns if c not in ("cut", "id_poligono")]
    orphans = (left.groupBy("cut", "id_poligono").agg(F.min_by(F.struct(*rest), "row_id").alias("b"))
               .select("cut", "id_poligono", *[F.col(f"b.{c}").alias(c) for c in rest]))
    types = dict(parcels.dtypes)
    for name in ROLE_FIELDS:
        if name in orphans.columns:
            orphans = orphans.withColumn(name, F.lit(None).cast(types[name]))
    orphans = orphans.withColumns({"datos_sii": F.lit(False), "exacto": F.lit(False), "metodo": F.lit("huerfano")})
    lost = roles.join(decisions.where("tipo = 'ninguno'").select("cut", "rol"), ["cut", "rol"], "left_semi")
    return moved.select(*parcels.columns).unionByName(orphans.select(*parcels.columns)), lost


def reassign_figures(decisions: DataFrame) -> DataFrame:
    def kind(name: str) -> Column:
        return F.count(F.when(F.col("tipo") == name, 1))

    return decisions.groupBy("cut").agg(
        F.count("*").alias("roles"), kind("dentro").alias("dentro"), kind("cercano").alias("cercano_50m"),
        kind("sin_punto").alias("sin_punto_conservados"), kind("ninguno").alias("sin_poligono"),
        F.count(F.when((F.col("tipo") != "ninguno") & (F.col("id_poligono") != F.col("id_nuevo")), 1)).alias("cambiaron_de_poligono"))


def exactness_figures(before: DataFrame, after: DataFrame) -> DataFrame:
    """Exact and approximate roles per comuna before and after a reassignment."""
    def tally(df: DataFrame, moment: str) -> DataFrame:
        roles = (df.where(F.col("datos_sii") & F.col("rol").isNotNull()).groupBy("cut", "rol").agg(F.min_by("exacto", "row_id").alias("e")))
        return roles.groupBy("cut").agg(F.count(F.when(F.col("e"), 1)).alias(f"exactos_{moment}"), F.count(F.when(~F.col("e"), 1)).alias(f"aprox_{moment}"))

    return tally(before, "antes").join(tally(after, "despues"), "cut", "full")


def accumulate_lost(previous: DataFrame, resolved: DataFrame, lost: DataFrame) -> DataFrame:
    """Side table of roles without polygon: earlier ones not resolved since, plus the new ones; the last entry wins."""
    kept = previous.join(resolved.where(F.col("rol").isNotNull()).select("cut", "rol"), ["cut", "rol"], "left_anti")
    both = kept.withColumn("_o", F.lit(0)).unionByName(lost.withColumn("_o", F.lit(1)), allowMissingColumns=True)
    rest = [c for c in both.columns if c not in ("cut", "rol", "_o")]
    if not rest:
        return both.select("cut", "rol").distinct()
    return both.groupBy("cut", "rol").agg(F.max_by(F.struct(*rest), "_o").alias("b")).select("cut", "rol", *[F.col(f"b.{c}").alias(c) for c in rest])


def upsert_manifest(previous: DataFrame, fresh: DataFrame) -> DataFrame:
    """Rows of other files stay, rows of the files just converted are replaced."""
    return previous.join(fresh.select("archivo"), "archivo", "left_anti").unionByName(fresh, allowMissingColumns=True)


def refresh_manifest(manifest: DataFrame, stats: DataFrame) -> DataFrame:
    """Statistics columns overwritten where the comuna matches and the entry is ok."""
    shared = [c for c in stats.columns if c != "cut"]
    fresh = stats.select("cut", *[F.col(c).alias(f"_{c}") for c in shared])
    joined = manifest.join(fresh, "cut", "left")
    updated = {}
    for c in shared:
        old = F.col(c) if c in manifest.columns else F.lit(None)
        updated[c] = F.when((F.col("estado") == "ok") & F.col(f"_{c}").isNotNull(), F.col(f"_{c}")).otherwise(old)
    return joined.withColumns(updated).drop(*[f"_{c}" for c in shared])


def hilbert_key(x: Column, y: Column, order: int = 10) -> Column:
    """Position along the Hilbert curve of integer cells 0 … 2**order − 1."""
    n = 2 ** order
    start = F.struct(x.cast("bigint").alias("x"), y.cast("bigint").alias("y"), F.lit(0).cast("bigint").alias("d"))

    def step(acc: Column, k: Column) -> Column:
        s = F.call_function("shiftright", F.lit(n).cast("bigint"), k)
        rx = F.when(acc["x"].bitwiseAND(s) > 0, 1).otherwise(0)
        ry = F.when(acc["y"].bitwiseAND(s) > 0, 1).otherwise(0)
        d = acc["d"] + s * s * ((3 * rx).bitwiseXOR(ry))
        fx = F.when((ry == 0) & (rx == 1), n - 1 - acc["x"]).otherwise(acc["x"])
        fy = F.when((ry == 0) & (rx == 1), n - 1 - acc["y"]).otherwise(acc["y"])
        return F.struct(F.when(ry == 0, fy).otherwise(fx).alias("x"), F.when(ry == 0, fx).otherwise(fy).alias("y"), d.alias("d"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(order)), start, step, lambda acc: acc["d"])


def resolve_requests(requests: DataFrame, available: DataFrame, codes: DataFrame) -> DataFrame:
    """Requests(qid, cut, cod_sii, comuna) → (qid, cut). A comuna code must exist; a tax code is looked up; a name must
    name exactly one comuna. The three are separate columns because the numbers look alike.
    available(cut, comuna), codes(cod_sii, cut)."""
    own = available.select(F.col("cut").alias("_a")).distinct()
    tax = codes.groupBy(F.col("cod_sii").cast("bigint").alias("_code")).agg(F.min("cut").alias("_b"))
    named = available.groupBy(X.norm_text(F.col("comuna")).alias("_n")).agg(F.countDistinct("cut").alias("_k"), F.min("cut").alias("_c")).where("_k = 1")
    joined = (requests.join(own, requests["cut"] == F.col("_a"), "left")
              .join(tax, F.expr("try_cast(cod_sii AS bigint)") == F.col("_code"), "left")
              .join(named, X.norm_text(F.col("comuna")) == F.col("_n"), "left"))
    answer = (F.when(F.col("cut").isNotNull(), F.col("_a")).when(F.col("cod_sii").isNotNull(), F.col("_b"))
              .when(F.col("comuna").isNotNull(), F.col("_c")))
    return joined.select("qid", answer.alias("cut"))


def lookup_by_role(requests: DataFrame, parcels: DataFrame, lost: DataFrame) -> DataFrame:
    """Requests(qid, cut, rol) → one row per request: how it was answered, on which polygon, with how many units."""
    wanted = requests.select("qid", "cut", X.role_key(F.col("rol")).alias("rol"))
    rows = wanted.join(parcels, ["cut", "rol"])
    best = rows.groupBy("qid", "cut", "rol").agg(
        F.min_by(F.struct("id_poligono", "datos_sii", "exacto", "metodo", "n_unidades", "n_asignados", "periodo_sii"),
                 F.struct((~F.col("datos_sii")).alias("a"), (~F.col("exacto")).alias("b"), F.coalesce("area_poligono_m2", F.lit(0.0)).alias("c"), "id_poligono")).alias("f"),
        F.countDistinct("id_poligono").alias("n_poligonos"),
        F.max(F.when(F.col("datos_sii") & F.col("exacto") & (F.col("n_unidades") > 1), F.col("n_unidades"))).alias("unidades"))
    points = lost.select("cut", "rol", F.lit(True).alias("_p")).distinct()
    joined = wanted.join(best.select("qid", "f", "n_poligonos", "unidades"), "qid", "left").join(points, ["cut", "rol"], "left")
    kind = (F.when(F.col("rol").isNull(), "rol_invalido").when(F.col("unidades").isNotNull(), "copropiedad")
            .when(F.col("f").isNotNull(), "predio").when(F.col("_p"), "solo_punto").otherwise("sin_resultado"))
    return joined.select("qid", "cut", "rol", kind.alias("tipo"), F.col("f.id_poligono").alias("id_poligono"),
                         F.coalesce("n_poligonos", F.lit(0)).alias("n_poligonos"), F.coalesce("unidades", F.lit(0)).alias("n_unidades"))


def parcel_at_point(points: DataFrame, parcels: DataFrame, size: float) -> DataFrame:
    """points(pid, x, y, lon, lat) × parcels(row_id, …, geom) → the parcel each point stands for: (pid, row_id, regla).

    A certain terrain of several units first; else the role whose own point is nearest, exact ones before the others;
    else the smallest polygon without data.
    """
    hits = points_in_polygons(points, parcels.select(F.col("row_id").alias("gid"), "geom"), size, "intersects").withColumnRenamed("gid", "row_id")
    cols = ["row_id", "datos_sii", "rol", "exacto", "n_unidades", "area_poligono_m2", "lon_sii", "lat_sii"]
    rows = hits.join(parcels.select(*cols), "row_id").join(points.select("pid", "lon", "lat"), "pid")
    data = F.col("datos_sii") & F.col("rol").isNotNull()
    rank = (F.when(data & F.col("exacto") & (F.col("n_unidades") > 1), 0).when(data & F.col("exacto"), 1).when(data, 2).otherwise(3))
    far = F.coalesce(G.ground_distance(F.col("lon_sii"), F.col("lat_sii"), F.col("lon"), F.col("lat")), F.lit(float("inf")))
    far = F.when(rank.isin(0, 3), 0.0).otherwise(far)
    order = F.struct(rank.alias("a"), far.alias("b"), F.when(rank == 0, 0.0).otherwise(F.coalesce("area_poligono_m2", F.lit(0.0))).alias("c"), F.col("row_id"))
    best = rows.groupBy("pid").agg(F.min(order).alias("m"))
    names = F.array(*[F.lit(v) for v in ("copropiedad", "exacto", "aproximado", "sin_datos")])
    return best.select("pid", "m.row_id", F.get(names, F.col("m.a")).alias("regla"))


def answers(parcels: DataFrame, comuna_periods: DataFrame, today: Column) -> DataFrame:
    """One answer per parcel id: best row, polygons, quality and notices. comuna_periods(cut, periodo)."""
    rows = parcels.where(F.col("id").isNotNull()).join(comuna_periods, "cut", "left")
    order = F.struct((~F.col("datos_sii")).alias("a"), (~F.col("exacto")).alias("b"), F.coalesce("area_poligono_m2", F.lit(0.0)).alias("c"), "id_poligono")
    best = rows.groupBy("id").agg(
        F.min_by(F.struct("cut", "rol", "datos_sii", "exacto", "metodo", "n_asignados", "n_unidades", "periodo_sii", "periodo"), order).alias("f"),
        F.count("*").alias("n_poligonos")).select("id", "f.*", "n_poligonos")
    date = S.data_date(F.when(F.col("datos_sii"), F.col("periodo_sii")), F.col("periodo"), today, F.col("datos_sii"))
    best = best.withColumn("fecha", date)
    others = F.col("n_asignados") - 1
    unsure = ~F.col("exacto") | (F.col("n_unidades") <= 1)
    notices = F.array(
        F.when(~F.col("datos_sii"), "El respaldo no trae datos del SII para este polígono: solo se conoce su forma.")
        .when(F.col("metodo") == FILLED, "Asignación aproximada: el rol no tiene polígono en el respaldo principal; el polígono es el aproximado del Respaldo 1.")
        .when(~F.col("exacto"), "Asignación aproximada: el respaldo asignó los datos de este rol al polígono por cercanía o por coordenadas (no porque el "
              "polígono contenga su punto del SII): el polígono puede no ser el del predio."),
        F.when(F.col("datos_sii") & (F.col("n_asignados") > 1), F.concat(
            F.lit("Otros "), others.cast("string"), F.lit(" roles quedaron asignados a este mismo polígono"),
            F.when(unsure, " por cercanía o coordenadas; no se agrupan como copropiedad (no hay certeza de que compartan el terreno).").otherwise("."))),
        F.when(F.col("n_poligonos") > 1, F.concat(F.lit("El rol tiene "), F.col("n_poligonos").cast("string"), F.lit(" polígonos en el respaldo; se unieron."))),
        F.when(F.col("fecha.estado") != "sin_dato", F.col("fecha.aviso")),
        F.lit("Respaldo de catastral.cl anterior a su API: puede estar desactualizado frente al SII."))
    quality = F.when(~F.col("datos_sii"), "sin_datos").when(F.col("exacto"), "exacta").otherwise("aproximada")
    return best.select("id", "cut", "rol", "metodo", "n_poligonos", quality.alias("geometria"), F.col("fecha.estado").alias("estado_fecha"),
                       F.col("fecha.atraso_semestres").alias("atraso_semestres"), F.array_compact(notices).alias("avisos"))


def terrain_answers(parcels: DataFrame) -> DataFrame:
    """Answer for terrains whose certain roles are several: common values, units, omitted approximations. The role list is
    complete; details are shown for the first units only."""
    rows = parcels.where(F.col("datos_sii") & F.col("exacto") & F.col("rol").isNotNull() & (F.col("n_unidades") > 1))
    roles = rows.groupBy("cut", "id_poligono", "rol").agg(
        F.min(F.struct("manzana", "ubicacion", "n_asignados", "area_poligono_m2")).alias("u"))

    def common(name: str) -> Column:
        value = F.col(f"u.{name}")
        distinct = F.countDistinct(value) + F.max(value.isNull().cast("int"))
        return F.when(distinct == 1, F.max(value)).alias(name)

    out = roles.groupBy("cut", "id_poligono").agg(
        common("manzana"), common("ubicacion"), F.min_by("u.area_poligono_m2", "rol").alias("area_poligono_m2"), F.count("*").alias("n_unidades"),
        F.min_by("u.n_asignados", "rol").alias("_asig"), F.array_sort(F.collect_list("rol")).alias("roles")).where("n_unidades > 1")
    return out.select(
        F.concat("cut", F.lit("-T-"), "id_poligono").alias("id"), "cut", "manzana", "ubicacion", "area_poligono_m2", "n_unidades",
        F.greatest(F.lit(0), F.col("_asig") - F.col("n_unidades")).alias("asignaciones_aproximadas_omitidas"), "roles",
        F.slice("roles", 1, MAX_UNITS).alias("roles_detallados"))

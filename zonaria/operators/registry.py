"""Instrument registry: families, presence in registry and server, best match by name."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import half_even
from ..functions import text as X
from ..session import truncate_lineage

# Group of each layer type, registry types to look for in order, and group of each registry type.
LAYER_GROUP = {"PRC": "PRC", "SECCIONAL": "Seccional", "LU": "LU", "PRI": "PRI/PRM", "PRM": "PRI/PRM"}
LAYER_TYPES = {"PRC": ("PRC",), "SECCIONAL": ("PS", "PRC"), "LU": ("LU", "PRC"), "PRI": ("PRI", "PRM"), "PRM": ("PRM", "PRI")}
REGISTRY_GROUP = {"PRC": "PRC", "PS": "Seccional", "LU": "LU", "PRI": "PRI/PRM", "PRM": "PRI/PRM"}
GROUPS = ("PRC", "Seccional", "LU", "PRI/PRM")


def _map(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(v) for pair in table.items() for v in pair])


def descendant_edges(instruments: DataFrame) -> DataFrame:
    """(parent, child) of instruments(id, instrumentosDescendientesIds as text); unknown children are left out, those beyond
    the smallest and largest id before they are shuffled."""
    known = instruments.select(F.col("id").alias("child"))
    span = known.agg(F.min("child").alias("_lo"), F.max("child").alias("_hi"))
    listed = instruments.select(F.col("id").alias("parent"), F.array_distinct(X.id_list(F.col("instrumentosDescendientesIds"))).alias("_ids"))
    within = F.filter("_ids", lambda c: c.between(F.col("_lo"), F.col("_hi")))
    pairs = listed.crossJoin(F.broadcast(span)).select("parent", F.explode(within).alias("child"))
    return pairs.join(known, "child", "left_semi").select("parent", "child").distinct()      # both by child: one shuffle


def closure(children: DataFrame, roots: DataFrame) -> DataFrame:
    """(root, member) for every instrument reachable from a root, the root included; cycles end by themselves.

    ``children`` is (parent, children array), stored. One join per generation, only from the members found last; the lineage is
    cut each round in the shared checkpoint folder and the loop ends when a round finds nothing new. Where no child has two
    parents, the only pair that can come again is a root reached from itself, so nothing is held against earlier rounds.
    """
    latest = truncate_lineage(roots.select(F.col("id").alias("root"), F.col("id").alias("member")).distinct())
    shared = children.select(F.explode("children").alias("child")).groupBy("child").count().where("count > 1")
    forest = shared.isEmpty()
    found = latest
    while True:
        step = (latest.join(children.withColumnRenamed("parent", "member"), "member").select("root", F.explode("children").alias("member"))
                .where("member != root"))
        latest = truncate_lineage(step if forest else step.distinct().join(found, ["root", "member"], "left_anti"))
        if latest.isEmpty():
            return found
        found = found.unionByName(latest)    # generations stay as they were written


def families(instruments: DataFrame) -> DataFrame:
    """One row per instrument of origin with its changes: decree, dates, number of changes, ordinance link.

    instruments(id, tipo, planificacion, denominacion, comunas array, clasificacion, numeroDocumento,
    fechaInicioVigencia, documentos, instrumentosDescendientesIds).
    """
    children = truncate_lineage(descendant_edges(instruments).groupBy("parent").agg(F.collect_set("child").alias("children")))   # read again in every round
    reached = children.select(F.explode("children").alias("id")).distinct().withColumn("_r", F.lit(True))
    named = instruments.select("id", "tipo", "planificacion", "denominacion", "comunas", "clasificacion", F.col("fechaInicioVigencia").alias("fecha"),
                               X.decree_text(F.col("documentos"), F.col("numeroDocumento")).alias("norma"), X.ordinance_url(F.col("documentos")).alias("url"))
    roots = (named.join(reached, "id", "left")
             .where((F.coalesce(F.col("clasificacion") == "Instrumento de origen", F.lit(False))) | F.col("_r").isNull())
             .where(F.coalesce(F.col("tipo") != "PRDU", F.lit(True))))
    text = named.select(F.col("id").alias("member"), F.col("fecha").alias("f"), "norma", "url")
    members = closure(children, roots).join(text, "member")
    change = F.col("member") != F.col("root")
    dated = F.when(change & (F.length("f") > 0), F.struct(F.col("f"), (-F.col("member")).alias("o")))
    figures = members.groupBy("root").agg(
        F.count(F.when(change, 1)).alias("n_modificaciones"), F.max_by("f", dated).alias("ultima_modificacion"),
        F.max_by("norma", dated).alias("norma_ultima_modificacion"),
        F.max(F.when(change & F.col("url").isNotNull(), F.struct("member", "url"))).alias("_other"))
    return roots.join(figures, roots["id"] == F.col("root")).select(
        "id", "tipo", "planificacion", F.trim(F.coalesce("denominacion", F.lit(""))).alias("denominacion"), "comunas", "norma",
        "fecha", "ultima_modificacion", "norma_ultima_modificacion", "n_modificaciones", F.coalesce("url", F.col("_other.url")).alias("ordenanza_url"))


def presence(families_: DataFrame, server: DataFrame, comunas: DataFrame) -> DataFrame:
    """Comuna × type: is there an instrument in the registry and on the server? A plan implies its urban limit."""
    fam = families_.select(F.explode("comunas").alias("cut"), F.try_element_at(_map(REGISTRY_GROUP), F.col("tipo")).alias("tipo_g"),
                           "tipo", "denominacion", "norma", "fecha", "ultima_modificacion", "ordenanza_url")
    order = F.struct((F.col("fecha").isNull()).alias("n"), F.col("fecha").alias("d"), "denominacion")
    line = F.struct(F.coalesce("fecha", F.lit("")).alias("d"), F.col("denominacion"),
                    F.concat_ws(" · ", F.nullif("norma", F.lit("")), F.nullif("fecha", F.lit(""))).alias("t"), F.col("ordenanza_url").alias("u"))
    portal = fam.where(F.col("tipo_g").isNotNull()).groupBy("cut", F.col("tipo_g").alias("tipo")).agg(
        F.array_sort(F.collect_list(line), lambda a, b: F.when(a["d"] > b["d"], -1).when(a["d"] < b["d"], 1)
                     .when(a["denominacion"] < b["denominacion"], -1).when(a["denominacion"] > b["denominacion"], 1).otherwise(0)).alias("ls"),
        F.max(F.coalesce("ultima_modificacion", F.lit(""))).alias("ultima_modificacion"))
    del order
    served = (server.where(F.col("ipt_nombre").isNotNull()).select("cut", F.try_element_at(_map(LAYER_GROUP), F.col("ipt_tipo")).alias("tipo"), "ipt_nombre")
              .where(F.col("tipo").isNotNull()).groupBy("cut", "tipo").agg(F.array_sort(F.collect_set("ipt_nombre")).alias("ss")))
    grid = comunas.select("region", "cut", "comuna", F.explode(F.array(*[F.lit(g) for g in GROUPS])).alias("tipo"))
    plan = F.max((F.col("tipo") == "PRC") & F.col("ls").isNotNull()).over(Window.partitionBy("cut"))      # four rows a comuna; the families are read once
    rows = grid.join(portal, ["cut", "tipo"], "left").withColumn("_implied", (F.col("tipo") == "LU") & plan).join(served, ["cut", "tipo"], "left")
    has_portal, has_server = F.col("ls").isNotNull(), F.col("ss").isNotNull()
    implied = ~has_portal & F.coalesce("_implied", F.lit(False))
    names = F.array_join("ss", "; ")
    first_url = F.get(F.filter(F.transform("ls", lambda x: x["u"]), lambda u: F.length(u) > 0), F.lit(0))
    in_portal = has_portal | implied
    state = F.when(in_portal & has_server, "ambos").when(in_portal, "solo_portal").otherwise("solo_servidor")
    return rows.where(has_portal | has_server | implied).select(
        "region", "cut", "comuna", "tipo",
        F.coalesce(F.nullif(F.array_join(F.transform("ls", lambda x: x["denominacion"]), " | "), F.lit("")), names, F.lit("")).alias("instrumento"),
        F.coalesce(F.array_join(F.transform("ls", lambda x: x["t"]), " | "), F.lit("")).alias("norma_fecha"),
        F.coalesce("ultima_modificacion", F.lit("")).alias("ultima_modificacion"), in_portal.alias("en_portal"), has_server.alias("en_servidor"),
        F.coalesce(names, F.lit("")).alias("nombre_servidor"), F.coalesce(first_url, F.lit("")).alias("ordenanza_url"),
        F.when(implied, "LU definido por el PRC vigente").otherwise("").alias("nota"), state.alias("estado"))


def gap_counts(table: DataFrame) -> DataFrame:
    return table.groupBy("tipo", "estado").agg(F.count("*").alias("n"))


def gap_lists(table: DataFrame) -> DataFrame:
    """The comunas without geometry and those only on the server, one row each, and the number of sectional plans missing."""
    label = F.concat("comuna", F.lit(" ("), "tipo", F.lit(")"))
    only = F.col("estado") == "solo_portal"
    kind = (F.when(only & F.col("tipo").isin("PRC", "LU"), "sin_geometria").when(only & (F.col("tipo") == "Seccional"), "seccional_sin_geometria")
            .when(F.col("estado") == "solo_servidor", "solo_servidor"))
    rows = table.select(kind.alias("lista"), label.alias("comuna_tipo")).where(F.col("lista").isNotNull())
    return rows.groupBy("lista", "comuna_tipo").agg(F.count("*").alias("n"))


def server_base(inventory: DataFrame | None, partition: DataFrame) -> DataFrame:
    """Instruments on the server: local ones from the inventory, intercomunal ones from the partition. Without an inventory
    (``None``, an earlier build) all come from the partition."""
    cols = ["cut", "ipt_tipo", "ipt_nombre"]
    if inventory is None:
        return partition.where(F.col("ipt_tipo").isNotNull()).select(*cols).distinct()
    local = inventory.where(F.col("ipt_tipo").isin("PRC", "SECCIONAL", "LU") & F.col("cut").isNotNull()).select(*cols)
    wide = partition.where(F.col("ipt_tipo").isin("PRI", "PRM")).select(*cols)
    return local.unionByName(wide).distinct()


def match(server: DataFrame, families_: DataFrame) -> DataFrame:
    """Best registry family for every (ipt_tipo, ipt_nombre, cut): candidates of the first registry type present in the
    comuna, scored by shared significant words; a single candidate is accepted without shared words.

    Names with the same words are compared once, families with the same words are represented by the latest, and only
    names that share a word meet, so a comuna with many instruments does not pair all with all.
    """
    wanted = (server.where(F.col("ipt_nombre").isNotNull() & F.col("cut").isNotNull()).select("ipt_tipo", "ipt_nombre", "cut").distinct()
              .where(F.col("ipt_tipo").isin(*LAYER_TYPES)))
    keys = ["ipt_tipo", "ipt_nombre", "cut"]
    types = F.create_map(*[v for k, ts in LAYER_TYPES.items() for v in (F.lit(k), F.array(*[F.lit(t) for t in ts]))])
    asked = wanted.select("*", F.posexplode(F.element_at(types, F.col("ipt_tipo"))).alias("pref", "tipo"))
    fields = F.struct("id", "tipo", "denominacion", "norma", "fecha", "ultima_modificacion", "n_modificaciones", "ordenanza_url")
    latest = F.struct(F.coalesce("fecha", F.lit("")).alias("d"), (-F.col("id")).alias("i"))
    local = families_.withColumn("cut", F.explode("comunas")).select(
        "cut", "tipo", F.array_sort(X.significant_tokens(F.col("denominacion"))).alias("tb"), fields.alias("f"), latest.alias("o"))
    present = local.groupBy("cut", "tipo").agg(F.count("*").alias("n"), F.max_by("f", "o").alias("only"))
    chosen = (asked.join(present, ["cut", "tipo"]).groupBy(*keys).agg(F.min_by(F.struct("tipo", "n", "only"), "pref").alias("c"))
              .select(*keys, "c.*", F.array_sort(X.significant_tokens(F.col("ipt_nombre"))).alias("ta")))
    known = local.groupBy("cut", "tipo", "tb").agg(F.max_by("f", "o").alias("f"), F.max("o").alias("o"))
    probes = chosen.select("cut", "tipo", "ta").distinct().select("*", F.explode("ta").alias("word"))
    shared = (probes.join(known.select("*", F.explode("tb").alias("word")), ["cut", "tipo", "word"])
              .groupBy("cut", "tipo", "ta", "tb").agg(F.count("*").alias("k"), F.first("f").alias("f"), F.first("o").alias("o")))
    score = F.col("k") / (F.size("ta") + F.size("tb") - F.col("k"))
    best = (shared.withColumn("score", score).groupBy("cut", "tipo", "ta")
            .agg(F.max_by("f", F.struct("score", "o")).alias("f"), F.max("score").alias("score")))
    joined = chosen.join(best, ["cut", "tipo", "ta"], "left").where(F.col("f").isNotNull() | (F.col("n") == 1))
    joined = joined.withColumns({"confianza": F.when(F.col("f").isNotNull(), "alta").otherwise("unica"), "score": F.coalesce("score", F.lit(0.0)), "b": F.coalesce("f", "only")})
    return joined.select(
        *keys, F.col("b.id").alias("portal_id"), F.col("b.tipo").alias("portal_tipo"), F.col("b.denominacion").alias("denominacion"),
        F.col("b.norma").alias("norma"), F.col("b.fecha").alias("fecha_vigencia"), F.col("b.ultima_modificacion").alias("ultima_modificacion"),
        F.col("b.n_modificaciones").alias("n_modificaciones"), F.col("b.ordenanza_url").alias("ordenanza_url"), half_even("score", 3).alias("score"), "confianza")


def attach_validity(pieces: DataFrame, matches: DataFrame) -> DataFrame:
    """Decree, date and ordinance of the matched instrument on every piece."""
    cols = matches.select("ipt_tipo", "ipt_nombre", "cut", F.col("denominacion").alias("ipt_denominacion"), F.col("norma").alias("ipt_norma"),
                          F.col("fecha_vigencia").alias("ipt_fecha"), F.col("ultima_modificacion").alias("ipt_ultmod"), F.col("ordenanza_url").alias("ord_url"))
    return pieces.join(cols, ["ipt_tipo", "ipt_nombre", "cut"], "left")

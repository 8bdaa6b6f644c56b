"""Exact partition of every comuna by legal class, risk superposition and its quality figures."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numeric import half_even
from ..functions import geometry as G
from ..session import truncate_lineage
from ..rules import CLASS_ORDER, CLASSES, LOCAL, REMAINDER, LandRules
from .overlay import CAPACITY, overlay, sweep_groups, upward_edges
from .shapes import dissolve
from .tiling import TILE, crowded_tiles, tile_pieces

ITEM = "struct<kind:int,level:int,rango:int,size:double,gid:bigint,cut:string>"
COMUNA, FEATURE, RISK = 0, 1, 2


def _item(kind: int, level: Column, rango: Column, size: Column, gid: Column, cut: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), level.cast("int").alias("level"), rango.cast("int").alias("rango"),
                    size.cast("double").alias("size"), gid.cast("bigint").alias("gid"), cut.cast("string").alias("cut"))


def source_level(fuente: Column) -> Column:
    expr = None
    for level, (_, source) in enumerate(CLASS_ORDER):
        expr = F.when(fuente == source, level) if expr is None else expr.when(fuente == source, level)
    return expr


def level_class(level: Column) -> Column:
    return F.coalesce(F.get(F.array(*[F.lit(c) for c, _ in CLASS_ORDER]), level), F.lit(REMAINDER[0]))


def level_source(level: Column) -> Column:
    return F.coalesce(F.get(F.array(*[F.lit(s) for _, s in CLASS_ORDER]), level), F.lit(REMAINDER[1]))


def collapse_copies(features: DataFrame) -> DataFrame:
    """Features with the same shape, source and comuna: only the first in order can win ground, so the copies go
    (partial minima before the shuffle keep a large group of copies small)."""
    order = F.struct("rango", "gid")
    return (features.groupBy("fuente", "cut_ipt", F.sha2(F.to_json("geom"), 256).alias("shape"))
            .agg(F.min(F.struct(F.col("rango"), F.col("gid"))).alias("f"), F.first("geom").alias("geom"))
            .select(F.col("f.gid").alias("gid"), "fuente", "cut_ipt", F.col("f.rango").alias("rango"), "geom"))


def layers(comunas: DataFrame, features: DataFrame, risks: DataFrame | None) -> DataFrame:
    null = F.lit(None)
    out = comunas.select(_item(COMUNA, null, null, null, F.xxhash64("cut"), F.col("cut")).alias("item"), "geom")
    level = source_level(F.col("fuente"))
    local = F.col("fuente").isin(*LOCAL)
    out = out.unionByName(features.where(level.isNotNull()).select(
        _item(FEATURE, level, F.coalesce(F.col("rango"), F.lit(0)), G.area(F.col("geom")), F.col("gid"),
              F.when(local, F.col("cut_ipt"))).alias("item"), "geom"))
    if risks is not None:
        own = F.col("cut_ipt") if "cut_ipt" in risks.columns else null
        out = out.unionByName(risks.select(_item(RISK, null, null, null, F.col("gid"), own).alias("item"), "geom"))
    return out


def cells(comunas: DataFrame, features: DataFrame, risks: DataFrame | None, size: float, parts: str | None = None) -> DataFrame:
    """Elementary cells inside comunas, summed by tile and covering set: (cut, best feature of every level, risk flag, area[, parts]);
    ``parts`` as in :func:`overlay`, so that candidates are looked up once for all trapezoids of a covering set."""
    stored = comunas.select("geom").unionByName(features.select("geom"))
    if risks is not None:
        stored = stored.unionByName(risks.select("geom"))
    raw = overlay(layers(comunas, collapse_copies(features), risks), size, stored=stored, parts=parts)
    inside = raw.withColumn("cut", F.explode(F.transform(
        F.filter("active", lambda a: a["kind"] == COMUNA), lambda a: a["cut"])))

    def best(level: int) -> Column:
        fit = F.filter("active", lambda a: (a["kind"] == FEATURE) & (a["level"] == level)
                       & (a["cut"].isNull() | (a["cut"] == F.col("cut"))))
        ranked = F.transform(fit, lambda a: F.struct(a["rango"], a["size"], a["gid"]))
        return F.array_min(ranked)["gid"]

    return inside.select("cut", *[best(k).alias(f"w{k}") for k in range(len(CLASS_ORDER))],
                         F.exists("active", lambda a: (a["kind"] == RISK) & (a["cut"].isNull() | (a["cut"] == F.col("cut")))).alias("en_riesgo"), "area", *(["parts"] if parts else []))


def signatures(cell: DataFrame) -> DataFrame:
    """Cells summed by comuna, candidate per level and risk."""
    levels = [f"w{k}" for k in range(len(CLASS_ORDER))]
    return cell.groupBy("cut", *levels, "en_riesgo").agg(F.sum("area").alias("area"))


def award_by_level(rows: DataFrame, min_area: float = 1.0) -> DataFrame:
    """Adds (level, gid) of the winner, level by level: a piece below ``min_area`` is not kept and leaves its ground to
    the next level."""
    won = rows.withColumns({"level": F.lit(None).cast("int"), "gid": F.lit(None).cast("bigint")})
    for k in range(len(CLASS_ORDER)):
        candidate = F.col(f"w{k}")
        free = F.col("level").isNull() & candidate.isNotNull()
        piece = F.sum(F.when(free, F.col("area"))).over(W.partitionBy("cut", f"w{k}"))
        won = won.withColumn("_t", free & (piece >= min_area)).withColumns({
            "level": F.when(F.col("_t"), k).otherwise(F.col("level")),
            "gid": F.when(F.col("_t"), candidate).otherwise(F.col("gid"))}).drop("_t")
    return won


def award(signature: DataFrame, min_area: float = 1.0) -> DataFrame:
    """The same as :func:`award_by_level` for summed signatures, with far fewer shuffles.

    A piece that reaches ``min_area`` on the ground where it is the first candidate is kept in any case, and that
    ground is settled. Only the ground of smaller pieces goes through the level-by-level pass. The signatures are
    written once to the shared checkpoint folder, because both parts need them.
    """
    ranks = range(len(CLASS_ORDER))
    first = F.coalesce(*[F.when(F.col(f"w{k}").isNotNull(), k) for k in ranks])
    named = signature.withColumns({"level": first, "gid": F.coalesce(*[F.col(f"w{k}") for k in ranks])})
    own = F.sum("area").over(W.partitionBy("cut", "level", "gid"))
    marked = truncate_lineage(named.withColumn("sure", F.col("level").isNull() | (own >= min_area)))
    settled = marked.where("sure")
    open_ = marked.where("NOT sure")
    if open_.isEmpty():
        return settled.drop("sure")
    rivals = open_.select("cut", F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.col(f"w{k}").alias("gid")) for k in ranks])).alias("c"))
    rivals = rivals.select("cut", "c.level", "c.gid").where("gid IS NOT NULL").distinct()
    known = settled.groupBy("cut", "level", "gid").agg(F.sum("area").alias("area")).join(rivals, ["cut", "level", "gid"], "left_semi")
    known = known.select("cut", *[F.when(F.col("level") == k, F.col("gid")).alias(f"w{k}") for k in ranks], F.lit(False).alias("en_riesgo"), "area",
                         F.lit(True).alias("known"))
    decided = award_by_level(open_.drop("level", "gid", "sure").withColumn("known", F.lit(False)).unionByName(known), min_area)
    return settled.drop("sure").unionByName(decided.where("NOT known").drop("known"))


def split_by_risk(awarded: DataFrame, min_area: float = 1.0) -> DataFrame:
    """Pieces (cut, level, gid, riesgo, area): a piece is split by risk only if both sides reach ``min_area``."""
    sides = awarded.groupBy("cut", "level", "gid").agg(
        F.sum(F.when(F.col("en_riesgo"), F.col("area")).otherwise(0.0)).alias("a_in"),
        F.sum(F.when(F.col("en_riesgo"), 0.0).otherwise(F.col("area"))).alias("a_out"))
    sides = sides.where(F.col("a_in") + F.col("a_out") >= min_area)
    whole = F.col("a_in") + F.col("a_out")
    parts = (F.when(F.col("a_in") < min_area, F.array(F.struct(F.lit(False).alias("riesgo"), whole.alias("area"))))
             .when(F.col("a_out") < min_area, F.array(F.struct(F.lit(True).alias("riesgo"), whole.alias("area"))))
             .otherwise(F.array(F.struct(F.lit(False).alias("riesgo"), F.col("a_out").alias("area")),
                                F.struct(F.lit(True).alias("riesgo"), F.col("a_in").alias("area")))))
    return sides.select("cut", "level", "gid", F.explode(parts).alias("p")).select(
        "cut", level_class(F.col("level")).alias("clase"), level_source(F.col("level")).alias("fuente"),
        "gid", "p.riesgo", F.col("p.area").alias("area_m2"))


def partition(comunas: DataFrame, features: DataFrame, risks: DataFrame | None = None, size: float = 2_000.0,
              rules: LandRules = LandRules()) -> DataFrame:
    """comunas(cut, geom), features(gid, fuente, rango, cut_ipt, geom), risks(gid[, cut_ipt], geom) → pieces
    (cut, clase, fuente, gid, riesgo, area_m2); the part of no instrument has a null gid. A risk with a ``cut_ipt`` is a
    risk in that comuna alone."""
    return split_by_risk(award(signatures(cells(comunas, features, risks, size)), rules.min_area), rules.min_area)


def partition_shapes(comunas: DataFrame, features: DataFrame, risks: DataFrame | None = None, size: float = 2_000.0,
                     rules: LandRules = LandRules(), tall: bool = False) -> DataFrame:
    """The partition with its ground: one row per trapezoid (cut, clase, fuente, gid, riesgo, area, lo, hi, xl0…xr1), written
    once, because outlines and unions read it several times. With ``tall`` the same ground in as few trapezoids as their sides
    allow; sides of neighbours may then meet in the middle of each other, which :func:`dissolve` does not take."""
    cell = truncate_lineage(cells(comunas, features, risks, size, "tall" if tall else "flat"))
    names = [f"w{k}" for k in range(len(CLASS_ORDER))]
    mark = F.concat_ws("|", "cut", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in names], F.col("en_riesgo").cast("string"))
    by_piece = W.partitionBy("cut", "level", "gid")
    won = award(signatures(cell), rules.min_area).withColumns({
        "a_in": F.sum(F.when(F.col("en_riesgo"), F.col("area")).otherwise(0.0)).over(by_piece),
        "a_out": F.sum(F.when(F.col("en_riesgo"), 0.0).otherwise(F.col("area"))).over(by_piece)})
    risk = (F.when(F.col("a_in") < rules.min_area, False).when(F.col("a_out") < rules.min_area, True).otherwise(F.col("en_riesgo")))
    decided = won.where(F.col("a_in") + F.col("a_out") >= rules.min_area).select(mark.alias("_m"), "level", "gid", risk.alias("riesgo"))
    # there are as many decisions as kinds of ground: by size they look fit for a broadcast long before the driver can hold them
    placed = cell.select("cut", "parts", mark.alias("_m")).join(decided.hint("merge"), "_m")
    return truncate_lineage(placed.select("cut", level_class(F.col("level")).alias("clase"), level_source(F.col("level")).alias("fuente"), "gid", "riesgo", F.inline("parts"))
                            .select("cut", "clase", "fuente", "gid", "riesgo", "area", *CORNERS))


CORNERS = ["lo", "hi", "xl0", "xl1", "xr0", "xr1"]


def partition_layer(comunas: DataFrame, features: DataFrame, risks: DataFrame | None = None, size: float = 2_000.0,
                    rules: LandRules = LandRules()) -> DataFrame:
    """The partition as a layer: pieces (cut, clase, fuente, gid, riesgo, geom, area_m2)."""
    cell = partition_shapes(comunas, features, risks, size, rules)
    return dissolve(cell, ["cut", "clase", "fuente", "gid", "riesgo"]).withColumn("area_m2", G.area(F.col("geom")))


def clip_shapes(features: DataFrame, comunas: DataFrame, size: float, min_area: float = 1.0) -> DataFrame:
    """Affectations(gid, cut_ipt, geom) cut by comuna, with their ground: (gid, cut, geom, area_m2); a local one only in its
    own comuna. Every affectation is swept by itself against the edges of comunas at its height: affectations do not cut
    each other, so a piece is as many trapezoids as its own outline and the border ask for."""
    crowded = crowded_tiles(features.select("geom").unionByName(comunas.select("geom")), size, CAPACITY)
    left = features.select(F.struct(F.lit(0).alias("side"), F.col("gid").cast("string").alias("id"), F.col("cut_ipt").alias("own")).alias("item"), "geom")
    right = comunas.select(F.struct(F.lit(1).alias("side"), F.col("cut").alias("id"), F.lit(None).cast("string").alias("own")).alias("item"), "geom")
    keys = [*TILE, "one"]
    mine = upward_edges(tile_pieces(left, size, crowded).withColumn("one", F.col("item.id")), [*keys, "item"])
    spans = mine.groupBy(*keys).agg(F.min("y0").alias("_lo"), F.max("y1").alias("_hi"))
    land = (upward_edges(tile_pieces(right, size, crowded), [*TILE, "item"]).join(spans, TILE).where("y0 < _hi AND y1 > _lo")
            .select(*keys, "item", "x0", "y0", "x1", "y1"))
    cell = sweep_groups(mine.unionByName(land), keys, shapes=True)
    of = lambda side: F.filter("active", lambda a: a["side"] == side)
    rows = cell.withColumn("a", F.explode(of(0))).withColumn("cut", F.explode(F.transform(of(1), lambda a: a["id"])))
    rows = truncate_lineage(rows.where("a.own IS NULL OR a.own = cut").select(F.col("a.id").cast(features.schema["gid"].dataType).alias("gid"), "cut", "area", *CORNERS))
    kept = rows.groupBy("gid", "cut").agg(F.sum("area").alias("area_m2")).where(F.col("area_m2") >= min_area)
    return dissolve(rows.join(kept.select("gid", "cut"), ["gid", "cut"], "left_semi"), ["gid", "cut"]).join(kept, ["gid", "cut"])


def enlarge_comunas(features: DataFrame, comunas: DataFrame, size: float) -> DataFrame:
    """Comunas with the ground of their own instruments outside every comuna; the lower code takes disputed ground.

    features(gid, cut_ipt, geom), comunas(cut, geom, …) → the comunas with the new ``geom`` and ``ha_extension_costera``.
    Comunas without an extension keep their shape as it is.
    """
    null = F.lit(None).cast("bigint")
    own = features.where(F.col("cut_ipt").isNotNull()).select(F.struct(F.lit(1).alias("kind"), F.col("cut_ipt").alias("cut"), F.col("gid").cast("bigint").alias("gid")).alias("item"), "geom")
    land = comunas.select(F.struct(F.lit(0).alias("kind"), F.col("cut").alias("cut"), null.alias("gid")).alias("item"), "geom")
    cuts = lambda kind: F.array_sort(F.array_distinct(F.transform(F.filter("active", lambda a: a["kind"] == kind), lambda a: a["cut"])))
    cell = truncate_lineage(overlay(own.unionByName(land), size, shapes=True).select(cuts(0).alias("land"), F.get(cuts(1), F.lit(0)).alias("claim"), "area", *CORNERS))
    outside = cell.where((F.size("land") == 0) & F.col("claim").isNotNull()).select(F.col("claim").alias("cut"), "area", *CORNERS)
    grown = outside.groupBy("cut").agg(F.sum("area").alias("_more")).where("_more >= 1.0").join(comunas.select("cut"), "cut", "left_semi")
    ground = cell.withColumn("cut", F.explode("land")).select("cut", "area", *CORNERS).unionByName(outside).join(grown.select("cut"), "cut", "left_semi")
    shapes_ = dissolve(ground, ["cut"]).withColumnRenamed("geom", "_grown")
    joined = comunas.join(grown, "cut", "left").join(shapes_, "cut", "left")
    return joined.withColumns({"geom": F.coalesce("_grown", "geom"), "ha_extension_costera": half_even(F.coalesce("_more", F.lit(0.0)) / 1e4, 2)}).drop("_grown", "_more")


def trapezoid() -> Column:
    """Geometry of one elementary trapezoid."""
    corner = G.point
    return F.array(F.array(F.array(
        corner(F.col("xl0"), F.col("lo")), corner(F.col("xr0"), F.col("lo")), corner(F.col("xr1"), F.col("hi")),
        corner(F.col("xl1"), F.col("hi")), corner(F.col("xl0"), F.col("lo")))))


def piece_ids(pieces: DataFrame) -> DataFrame:
    """``id`` = cut-00000, a running number over all pieces in comuna order.

    Rows are range-partitioned in that order and written once to the shared checkpoint folder; the number is the rank
    inside the range plus the rows of the earlier ranges, so neither a large comuna nor the whole table meets in a task.
    """
    ordered = pieces.withColumns({"_l": F.coalesce(source_level(F.col("fuente")), F.lit(99)), "_g": F.coalesce(F.col("gid"), F.lit(-1))})
    keys = ["cut", "_l", "_g", "riesgo"]
    ranged = truncate_lineage(ordered.repartitionByRange(*keys).withColumn("_p", F.spark_partition_id()))
    sizes = ranged.groupBy("_p").agg(F.count("*").alias("_n"))
    starts = sizes.select("_p", (F.sum("_n").over(W.orderBy("_p")) - F.col("_n")).alias("_s"))     # one row per range
    rank = F.row_number().over(W.partitionBy("_p").orderBy(*keys)) - 1
    return (ranged.withColumn("_r", rank).join(F.broadcast(starts), "_p")
            .withColumn("id", F.concat_ws("-", "cut", F.format_string("%05d", F.col("_s") + F.col("_r")))).drop("_l", "_g", "_p", "_r", "_s"))


def comuna_quality(pieces: DataFrame, comunas: DataFrame) -> DataFrame:
    """One row per comuna: % per class, coverage, % risk, no-urban flag. comunas(cut, comuna, region, geom)."""
    sums = pieces.groupBy("cut").agg(*[F.sum(F.when(F.col("clase") == c, F.col("area_m2"))).alias(c) for c in CLASSES],
                                     F.sum(F.when(F.col("riesgo"), F.col("area_m2")).otherwise(0.0)).alias("_risk"))
    base = comunas.select("cut", "comuna", "region", G.area(F.col("geom")).alias("area_comuna_m2"))
    joined = base.join(sums, "cut", "left")

    def pct(value: Column) -> Column:
        return half_even(100 * F.coalesce(value, F.lit(0.0)) / F.col("area_comuna_m2"), 3)

    total = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in CLASSES), F.lit(0.0))
    out = joined.select("cut", "comuna", "region", *[pct(F.col(c)).alias(f"pct_{c}") for c in CLASSES],
                        pct(total).alias("cobertura_pct"), pct(F.col("_risk")).alias("pct_riesgo"), "area_comuna_m2")
    return out.withColumn("sin_urbano", F.col("pct_U1") + F.col("pct_U2") + F.col("pct_U3") == 0)


def overlap_threshold(area: Column) -> Column:
    return F.greatest(F.lit(1.0), area * 1e-6)


def overlap_quality(pieces: DataFrame, comunas: DataFrame, size: float) -> DataFrame:
    """Σ piece areas − area of their union per comuna, and whether it is within tolerance.
    pieces(cut, pid, geom), comunas(cut, geom)."""
    from .overlay import union_areas

    sums = pieces.groupBy("cut").agg(F.sum(G.area(F.col("geom"))).alias("s"))
    joined = (comunas.select("cut", G.area(F.col("geom")).alias("a")).join(sums, "cut", "left")
              .join(union_areas(pieces, "cut", "pid", size), "cut", "left"))
    over = F.greatest(F.coalesce(F.col("s") - F.col("area"), F.lit(0.0)), F.lit(0.0))
    return joined.select("cut", half_even(over, 1).alias("traslape_m2"), (half_even(over, 1) < overlap_threshold(F.col("a"))).alias("traslape_ok"))


def clip_affectations(features: DataFrame, comunas: DataFrame, size: float, min_area: float = 1.0) -> DataFrame:
    """Affectations(gid, cut_ipt, geom) cut by comuna: (gid, cut, area); a local one only in its own comuna."""
    from .overlay import pair_areas

    pairs = pair_areas(features.select(F.col("gid").alias("lid"), "geom"), comunas.select(F.col("cut").alias("rid"), "geom"), size)
    own = features.select(F.col("gid").alias("lid"), "cut_ipt")
    return (pairs.where(F.col("area") >= min_area).join(own, "lid")
            .where(F.col("cut_ipt").isNull() | (F.col("cut_ipt") == F.col("rid")))
            .select(F.col("lid").alias("gid"), F.col("rid").alias("cut"), "area"))


def resolve_overlaps(features: DataFrame, size: float) -> DataFrame:
    """Ground each feature keeps against the earlier features of its source: features(gid, fuente, rango, geom) →
    (gid, kept, lost)."""
    item = F.struct(F.col("fuente"), F.col("rango").cast("int").alias("rango"), G.area(F.col("geom")).alias("size"), F.col("gid"))
    cell = overlay(features.select(item.alias("item"), "geom"), size)
    per_source = cell.select("area", "active", F.explode(F.array_distinct(F.transform("active", lambda a: a["fuente"]))).alias("f"))
    ranked = F.array_sort(F.transform(F.filter("active", lambda a: a["fuente"] == F.col("f")),
                                      lambda a: F.struct(a["rango"], a["size"], a["gid"])))
    members = per_source.select("area", F.posexplode(ranked).alias("place", "m"))
    return members.groupBy(F.col("m.gid").alias("gid")).agg(
        F.sum(F.when(F.col("place") == 0, F.col("area")).otherwise(0.0)).alias("kept"),
        F.sum(F.when(F.col("place") > 0, F.col("area")).otherwise(0.0)).alias("lost"))


def coastal_extension(features: DataFrame, comunas: DataFrame, size: float) -> DataFrame:
    """Ground of a comuna's own instruments that lies outside every comuna; the lower code takes disputed ground.
    features(gid, cut_ipt, geom), comunas(cut, geom) → (cut, area_ipt, area_fuera, area_extension, x_fuera)."""
    item = F.struct(F.lit(1).alias("kind"), F.col("cut_ipt").alias("cut"), F.col("gid").cast("bigint").alias("gid"))
    own = features.where(F.col("cut_ipt").isNotNull()).select(item.alias("item"), "geom")
    land = comunas.select(F.struct(F.lit(0).alias("kind"), F.col("cut").alias("cut"), F.xxhash64("cut").alias("gid")).alias("item"), "geom")
    cell = overlay(own.unionByName(land), size, shapes=True)
    claims = F.array_sort(F.array_distinct(F.transform(F.filter("active", lambda a: a["kind"] == 1), lambda a: a["cut"])))
    centre = (F.col("xl0") + F.col("xl1") + F.col("xr0") + F.col("xr1")) / 4
    rows = cell.select("area", centre.alias("x"), F.exists("active", lambda a: a["kind"] == 0).alias("land"),
                       F.posexplode(claims).alias("place", "cut"))
    out = ~F.col("land")

    def total(condition: Column, value: Column = F.col("area")) -> Column:
        return F.sum(F.when(condition, value).otherwise(0.0))

    sums = rows.groupBy("cut").agg(
        F.sum("area").alias("area_ipt"), total(out).alias("area_fuera"),
        total(out & (F.col("place") == 0)).alias("area_extension"), total(out, F.col("area") * F.col("x")).alias("mx"))
    return sums.where(F.col("area_fuera") >= 1.0).withColumn("x_fuera", F.col("mx") / F.col("area_fuera")).drop("mx")


def coastal_parts(features: DataFrame, comunas: DataFrame, size: float) -> DataFrame:
    """Of how many separate parts the ground outside every comuna consists: features(gid, cut_ipt, geom), comunas(cut, geom) →
    (cut, n_partes)."""
    own = features.where(F.col("cut_ipt").isNotNull()).select(F.struct(F.lit(1).alias("kind"), F.col("cut_ipt").alias("cut"), F.col("gid").cast("bigint").alias("gid")).alias("item"), "geom")
    land = comunas.select(F.struct(F.lit(0).alias("kind"), F.col("cut").alias("cut"), F.lit(None).cast("bigint").alias("gid")).alias("item"), "geom")
    outside = overlay(own.unionByName(land), size, shapes=True).where(~F.exists("active", lambda a: a["kind"] == 0))
    ground = outside.select(F.explode(F.array_distinct(F.transform("active", lambda a: a["cut"]))).alias("cut"), "area", *CORNERS)
    return dissolve(ground, ["cut"]).select("cut", G.part_count(F.col("geom")).alias("n_partes"))


def coastal_quality(extension: DataFrame, comunas: DataFrame, parts: DataFrame | None = None) -> DataFrame:
    """Report of the extension: hectares, share and side; comunas(cut, comuna, region, geom). With ``parts`` (see
    :func:`coastal_parts`) also the number of separate parts."""
    base = comunas.select("cut", "comuna", "region", G.centroid_x(F.col("geom")).alias("cx"))
    side = F.when(F.col("x_fuera") < F.col("cx"), "oeste (costa probable)").otherwise("este")
    kept = F.when(F.col("area_extension") >= 1.0, F.col("area_extension")).otherwise(0.0)
    joined = extension.join(base, "cut", "left")
    if parts is not None:
        joined = joined.join(parts, "cut", "left")
    return joined.select(
        "cut", "comuna", "region", half_even(F.col("area_ipt") / 1e4, 2).alias("ha_ipt"),
        half_even(F.col("area_fuera") / 1e4, 2).alias("ha_fuera"),
        half_even(100 * F.col("area_fuera") / F.col("area_ipt"), 2).alias("pct_fuera"),
        half_even(kept / 1e4, 2).alias("ha_extension"), side.alias("lado"), *(["n_partes"] if parts is not None else []))


def unplaced_instruments(features: DataFrame, touches: DataFrame) -> DataFrame:
    """Local features without a comuna that touch comunas: features(fid, servicio, capa, ipt_tipo, ipt_nombre, attrs_raw,
    comunal, cut_ipt), touches(fid, comuna)."""
    keys = ["servicio", "capa", "ipt_tipo", "ipt_nombre"]
    rows = features.where(F.col("comunal") & F.col("cut_ipt").isNull()).join(touches, "fid")
    return rows.groupBy(*keys).agg(
        F.countDistinct("fid").alias("features"), F.array_join(F.array_sort(F.collect_set("comuna")), "; ").alias("comunas_tocadas"),
        F.min_by("attrs_raw", "fid").alias("ejemplo_attrs_raw"))


def build_summary(pieces: DataFrame, quality: DataFrame, unplaced: DataFrame | None = None, coast: DataFrame | None = None) -> DataFrame:
    """One row: number of comunas and pieces, coverage range, pieces per class, and as far as given: the largest overlap and
    the comunas over its tolerance (``traslape_m2, traslape_ok`` of the quality), instruments without comuna, hectares outside
    every comuna and of the coastal extension, self-crossing shapes. All inputs in one aggregation."""
    extra = [c for c in ("traslape_m2", "traslape_ok", "ha_extension_costera") if c in quality.columns]
    shaped = [G.crosses_itself(F.col("geom")).alias("_crossed")] if "geom" in pieces.columns else []
    both = pieces.select("clase", "revisar", *shaped, F.lit(1).alias("pieza")).unionByName(
        quality.select("sin_urbano", "cobertura_pct", *extra, F.lit(1).alias("comuna")), allowMissingColumns=True)
    for other, name, column in ((unplaced, "_unplaced", F.lit(1)), (coast, "_outside", F.col("ha_fuera") if coast is not None else None)):
        if other is not None:
            both = both.unionByName(other.select(column.alias(name)), allowMissingColumns=True)
    more = [F.max("traslape_m2").alias("traslape_max_m2")] if "traslape_m2" in extra else []
    more += [F.count(F.when(~F.col("traslape_ok"), 1)).alias("comunas_traslape_sobre_umbral")] if "traslape_ok" in extra else []
    more += [half_even(F.coalesce(F.sum("ha_extension_costera"), F.lit(0.0)), 1).alias("extension_costera_ha")] if "ha_extension_costera" in extra else []
    more += [F.count("_unplaced").alias("instrumentos_sin_comuna")] if unplaced is not None else []
    more += [half_even(F.coalesce(F.sum("_outside"), F.lit(0.0)), 1).alias("ipt_fuera_dpa_ha")] if coast is not None else []
    more += [F.count(F.when(F.col("_crossed"), 1)).alias("piezas_invalidas")] if shaped else []
    return both.agg(
        *more,
        F.count("comuna").alias("comunas"), F.count("pieza").alias("piezas"),
        F.count(F.when(F.col("sin_urbano"), 1)).alias("comunas_sin_urbano"),
        F.min("cobertura_pct").alias("cobertura_min_pct"), F.max("cobertura_pct").alias("cobertura_max_pct"),
        F.count(F.when(F.col("revisar"), 1)).alias("zonas_pri_a_revisar"),
        *[F.count(F.when(F.col("clase") == c, 1)).alias(f"piezas_{c}") for c in CLASSES])


def annotate(pieces: DataFrame, legal: dict) -> DataFrame:
    """Title, summary, references and notice of the legal class of each piece."""
    classes = {c: {**e, "normas": "; ".join(e.get("normas", []))} for c, e in legal["clases"].items()}

    def field(name: str, absent: str | None = None) -> Column:
        pairs = [F.lit(v) for c, entry in classes.items() for v in (c, entry[name])]
        found = F.try_element_at(F.create_map(*pairs), F.col("clase"))
        return found if absent is None else F.coalesce(found, F.lit(absent))

    return pieces.withColumns({"norma_titulo": field("titulo"), "norma_resumen": field("resumen"),
                               "norma_refs": field("normas", ""), "aviso": F.lit(legal.get("_aviso"))})

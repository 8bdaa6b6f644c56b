"""Building footprints: normalisation, comuna of every building, manifests and box queries."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numeric import half_even
from ..functions import geometry as G
from ..functions import scales as S
from ..session import truncate_lineage
from .overlay import pair_areas
from .spatial_join import polygons_intersect

# Limits of the visible-area query.
LIMIT_DEFAULT, LIMIT_MAX, SPAN_MAX = 5_000, 20_000, 0.15
# Fixed value: the notice for a wider area.
TOO_WIDE = "El área visible es muy grande: acércate para ver los edificios."


def normalise(raw: DataFrame) -> DataFrame:
    """raw(id, height, num_floors, class, subtype, sources, geom, …) → product columns, polygons only, one row per id."""
    rows = raw.where(~G.is_empty(F.col("geom"))).select(
        F.col("id").cast("string").alias("id"), F.expr("try_cast(height AS double)").alias("height"),
        F.expr("try_cast(num_floors AS double)").alias("num_floors"), "class", "subtype",
        F.get("sources", F.lit(0))["dataset"].alias("fuente"), "geom")
    rest = [c for c in rows.columns if c != "id"]
    return rows.groupBy("id").agg(F.first(F.struct(*rest)).alias("b")).select("id", *[F.col(f"b.{c}").alias(c) for c in rest])


def assign_comunas(buildings: DataFrame, comunas: DataFrame, size: float) -> DataFrame:
    """Whole building → comuna with most of its area: (id, cut). Areas are computed only for buildings that touch
    several comunas; buildings without comuna are left out."""
    left = buildings.select(F.col("id").alias("lid"), "geom")
    right = comunas.select(F.col("cut").alias("rid"), "geom")
    pairs = polygons_intersect(left, right, size)
    counts = truncate_lineage(pairs.groupBy("lid").agg(F.count("*").alias("n"), F.min("rid").alias("only")))    # both branches read it
    single = counts.where("n = 1").select(F.col("lid").alias("id"), F.col("only").alias("cut"))
    several = left.join(counts.where("n > 1").select("lid"), "lid", "left_semi")
    areas = pair_areas(several, right, size, stored=left.select("geom").unionByName(right.select("geom"))).where("area > 0")
    best = areas.groupBy("lid").agg(F.min_by("rid", F.struct(-F.col("area"), F.col("rid"))).alias("cut"))
    return single.unionByName(best.select(F.col("lid").alias("id"), "cut"))


def footprint_table(buildings: DataFrame, comunas: DataFrame, size: float) -> DataFrame:
    """The product: building columns with cut, comuna, region and area."""
    names = comunas.select("cut", "comuna", "region")
    return (buildings.join(assign_comunas(buildings, comunas, size), "id").join(names, "cut")
            .withColumn("area_m2", half_even(G.area(F.col("geom")), 1)))


def region_manifest(table: DataFrame, read: DataFrame, region: str) -> DataFrame:
    """Counts of one region: read, kept, outside every comuna, of other regions. read(id), table(id, region)."""
    flags = read.select("id").join(table.select("id", "region"), "id", "left")
    return flags.agg(F.count("*").alias("n_en_bbox"), F.count(F.when(F.col("region") == region, 1)).alias("n_edificios"),
                     F.count(F.when(F.col("region").isNull(), 1)).alias("fuera_de_la_dpa"),
                     F.count(F.when(F.col("region") != region, 1)).alias("de_otras_regiones"))


def comuna_counts(table: DataFrame) -> DataFrame:
    return table.groupBy("region", "cut", "comuna").agg(F.count("*").alias("n"))


def complete_regions(manifests: DataFrame, stored: DataFrame) -> DataFrame:
    """Regions whose manifest is complete and whose data exists: manifests(region, completa), stored(region)."""
    return manifests.where(F.col("completa")).join(stored.select("region"), "region", "left_semi").select("region").distinct()


def state(manifests: DataFrame) -> DataFrame:
    return manifests.select("region", F.col("n_edificios").alias("edificios"), F.col("mb").alias("MB"), "release",
                            F.coalesce("fecha_descarga", "inicio").alias("fecha"), F.coalesce("completa", F.lit(False)).alias("completa"))


def pending_regions(work: DataFrame, manifests: DataFrame) -> DataFrame:
    """Work(region, release) not yet complete for its release."""
    return work.join(manifests.where("completa").select("region", "release"), ["region", "release"], "left_anti")


def in_windows(buildings: DataFrame, windows: DataFrame, size: float) -> DataFrame:
    """Batch of windows(wid, xmin, ymin, xmax, ymax) × buildings(id, geom, …) → (wid, id)."""
    boxes = windows.select(F.col("wid").alias("rid"), G.box(F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax")).alias("geom"))
    pairs = polygons_intersect(buildings.select(F.col("id").alias("lid"), "geom"), boxes, size)
    return pairs.select(F.col("rid").alias("wid"), F.col("lid").alias("id"))


def window_view(buildings: DataFrame, box: tuple[float, float, float, float], limit: int = LIMIT_DEFAULT,
                reference: float = 3.5) -> DataFrame:
    """Buildings of one visible box with estimated height: the first ``limit`` by id, and in ``recortado`` whether there are
    more. A wider span than allowed gives no rows; :func:`window_notice` says so."""
    from .spatial_join import box_filter

    xmin, ymin, xmax, ymax = box
    limit = max(1, min(limit, LIMIT_MAX))
    near = box_filter(buildings, xmin, ymin, xmax, ymax)
    if xmax - xmin > SPAN_MAX or ymax - ymin > SPAN_MAX:
        near = near.where(F.lit(False))
    frame = G.edges(G.box(*[F.lit(float(v)) for v in box]))
    es = G.edges(F.col("geom"))
    from .spatial_join import _touch

    meets = (F.exists(es, lambda a: F.exists(frame, lambda b: _touch(a, b)))
             | G.covers_inside(es, F.lit(xmin), F.lit(ymin))
             | (F.col("bbox.xmin").between(xmin, xmax) & F.col("bbox.ymin").between(ymin, ymax)
                & F.col("bbox.xmax").between(xmin, xmax) & F.col("bbox.ymax").between(ymin, ymax)))
    height = S.estimated_height(F.col("height"), F.col("num_floors"), reference)
    return near.where(meets).select(
        "id", half_even(height, 1).alias("altura_est"), S.height_source(F.col("height"), F.col("num_floors")).alias("altura_fuente"),
        half_even("area_m2", 1).alias("area_m2"), "fuente", "geom").orderBy("id").limit(limit + 1).withColumns({
            "recortado": F.count("*").over(W.partitionBy()) > limit, "_n": F.row_number().over(W.orderBy("id"))}).where(F.col("_n") <= limit).drop("_n")


def window_notice(view: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """One row for a visible box: how many buildings it shows, whether some were left out, and why none may show."""
    xmin, ymin, xmax, ymax = box
    wide = xmax - xmin > SPAN_MAX or ymax - ymin > SPAN_MAX
    return view.agg(F.count("*").alias("edificios"), F.coalesce(F.max("recortado"), F.lit(False)).alias("recortado"),
                    F.lit(TOO_WIDE if wide else None).cast("string").alias("aviso"))

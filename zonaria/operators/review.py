"""Round trip with the reviewer: zones to review, decisions, merged overrides."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import half_even
from ..functions import text as X
from .features import zone_key

DECISIONS = ("AFECTACION", "E", "R", "U")


def review_table(pieces: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """One row per (plan, zone) to review, sorted; earlier decisions are kept.
    pieces(ipt_nombre, zona, zona_desc, region, comuna, area_m2, fuente, revisar), previous(ipt_nombre, zona, decision)."""
    names = lambda c: F.array_join(F.array_sort(F.collect_set(c)), "; ")
    rows = pieces.where(F.coalesce("revisar", F.lit(False))).groupBy("ipt_nombre", "zona").agg(
        names(F.col("region")).alias("region"), F.min("zona_desc").alias("zona_desc"), names(F.col("comuna")).alias("comunas"),
        half_even(F.sum("area_m2") / 1e4, 2).alias("ha"), names(F.regexp_replace("fuente", "^PRI_", "")).alias("subclase_actual"))
    rows = rows.withColumn("_k", zone_key(F.col("ipt_nombre"), F.col("zona")))
    if previous is None:
        rows = rows.withColumn("decision", F.lit(""))
    else:
        kept = (previous.where(F.trim("decision") != "").groupBy(zone_key(F.col("ipt_nombre"), F.col("zona")).alias("_k"))
                .agg(F.max("decision").alias("decision")))
        rows = rows.join(kept, "_k", "left").withColumn("decision", F.coalesce("decision", F.lit("")))
    return rows.select("region", "ipt_nombre", "zona", "zona_desc", "comunas", "ha", "subclase_actual", "decision").orderBy(
        "region", F.desc("ha"), "ipt_nombre", F.asc_nulls_last("zona"))


def read_decisions(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid decisions, invalid ones): table(ipt_nombre, zona, decision)."""
    filled = table.withColumn("decision", F.upper(F.trim("decision"))).where("decision <> ''")
    good = F.col("decision").isin(*DECISIONS)
    key = F.concat_ws("|", F.coalesce("ipt_nombre", F.lit("")), F.coalesce("zona", F.lit("")))
    cols = [key.alias("clave"), zone_key(F.col("ipt_nombre"), F.col("zona")).alias("k"), "decision"]
    return filled.where(good).select(*cols), filled.where(~good).select(*cols)


def merge_overrides(current: DataFrame, decisions: DataFrame) -> DataFrame:
    """Current overrides(clave, k, decision) with the decisions on top; the same zone counts as one whatever its accents."""
    newer = decisions.groupBy("k").agg(F.max(F.struct("clave", "decision")).alias("n"))
    older = current.groupBy("k").agg(F.max(F.struct("clave", "decision")).alias("o"))
    return older.join(newer, "k", "full").select(
        F.coalesce("n.clave", "o.clave").alias("clave"), F.coalesce("n.decision", "o.decision").alias("decision")).orderBy("clave")

"""Results that are written once and read again with their rules applied anew."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features as FE
from ..rules import LandRules


def content_digest(df: DataFrame) -> tuple[int, int, int]:
    """Rows, and sum and exclusive or of the row hashes: the same for the same rows in any order and any partitioning."""
    row = F.xxhash64(*[F.to_json(F.struct(c)) for c in sorted(df.columns)])
    n, total, mixed = df.agg(F.count("*"), F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")), F.coalesce(F.bit_xor(row), F.lit(0))).first()
    return n, int(total), mixed


def write_once(df: DataFrame, path: str) -> bool:
    """Writes ``df`` as Parquet unless ``path`` holds the same rows already; whether it was written. A result that is not
    there, or that another schema or a half-finished run left, counts as none."""
    spark = df.sparkSession
    try:
        held = spark.read.parquet(path)
        same = sorted(held.columns) == sorted(df.columns) and content_digest(held.select(*df.columns)) == content_digest(df)
    except Exception as missing:
        if "PATH_NOT_FOUND" not in str(missing) and "UNABLE_TO_INFER_SCHEMA" not in str(missing):
            raise
        same = False
    if not same:
        df.write.mode("overwrite").parquet(path)
    return not same


def persist_catalogue(catalogue: DataFrame, path: str, rules: LandRules = LandRules()) -> bool:
    """The discovered layers with their type, ignored ones too: what was seen stays on record."""
    return write_once(FE.type_layers(FE.dedupe_catalogue(catalogue), rules), path)


def read_catalogue(spark: SparkSession, path: str, rules: LandRules = LandRules()) -> DataFrame:
    """The stored catalogue typed by today's ``rules``, without ignored layers: a changed rule needs no new discovery."""
    held = spark.read.parquet(path).drop("tipo", "pri_default")
    return FE.type_layers(held, rules).where(F.col("tipo") != "IGNORAR")

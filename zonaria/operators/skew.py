"""Equi-joins that stay balanced when a few keys hold a large share of the rows."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tiling import small_side

HOT_ROWS = None             # no salts: the runtime skew-join splits large partitions of a key


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], row_id: str, how: str = "inner",
                hot_rows: int | None = HOT_ROWS, hot: DataFrame | None = None) -> DataFrame:
    """``left`` ⋈ ``right`` on ``keys``. Skewed keys are left to the runtime skew-join unless ``hot_rows`` is given: then
    left rows of a key with more rows are spread over several salts (by a hash of ``row_id``, so that a repeated task
    spreads them alike) and the matching right rows repeated once per salt, whatever the size of the tables.
    Exact for inner, left, left_semi and left_anti joins. ``right`` must be the side with few rows per key."""
    if hot is None and hot_rows is not None:
        hot = hot_keys(left, keys, hot_rows)
    if hot is None:
        return left.join(right, keys, how)
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    spread = left.join(hot, keys, "left").withColumn("_salt", F.pmod(F.xxhash64(row_id), salts).cast("int")).drop("_salts")
    repeated = (right.join(hot, keys, "left")
                .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts"))
    return spread.join(repeated, [*keys, "_salt"], how).drop("_salt")


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows and the number of salts each needs (partial counts before the shuffle)."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > hot_rows)
    return small_side(counts.select(*keys, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_salts")))

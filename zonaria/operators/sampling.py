"""Evenly spread samples without a sort of a whole group in one task."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import truncate_lineage


def every_kth(df: DataFrame, group: str, order: str, size: int) -> DataFrame:
    """At most ``size`` rows of each ``group``: the first in the order of ``order`` (unique within a group) and every k-th
    after it, k the smallest that keeps to ``size``. Groups of up to ``size`` rows are taken whole.

    Rows are dealt to ranges by group and order and kept; a row's number is its rank inside range and group plus the rows
    that the group has in earlier ranges, so a group of any size is ranked by many tasks.
    """
    ranged = truncate_lineage(df.repartitionByRange(group, order).withColumn("_range", F.spark_partition_id()))
    parts = ranged.groupBy(group, "_range").agg(F.count("*").alias("_here"))  # one row for each range and group in it
    before = W.partitionBy(group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    placed = parts.select(group, "_range", F.coalesce(F.sum("_here").over(before), F.lit(0)).alias("_before"), F.sum("_here").over(W.partitionBy(group)).alias("_all"))
    rank = F.row_number().over(W.partitionBy("_range", group).orderBy(order)) - 1
    joined = ranged.withColumn("_rank", rank).join(placed.withColumnRenamed(group, "_group"), (F.col(group).eqNullSafe(F.col("_group"))) & (ranged["_range"] == placed["_range"]))
    step = F.ceil(F.col("_all") / size)
    return joined.where((F.col("_before") + F.col("_rank")) % step == 0).select(*df.columns)

"""The demand log as a stream: the same votes as the batch report."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.demand import exploded, region_votes
from ..sources.layers import DEMAND


def stream_log(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(DEMAND).option("maxFilesPerTrigger", files_per_trigger).json(path)


def vote_stream(log: DataFrame) -> DataFrame:
    """Running votes per source and region (update or complete mode)."""
    return region_votes(exploded(log))


def daily_votes(log: DataFrame, delay: str = "7 days") -> DataFrame:
    """Votes per source, region and day; late lines count until ``delay`` has passed."""
    rows = exploded(log).withColumn("dia", F.to_timestamp("fecha"))
    return (rows.withWatermark("dia", delay).groupBy(F.window("dia", "1 day"), "fuente", "region").agg(F.count("*").alias("n"))
            .select(F.col("window.start").alias("dia"), "fuente", "region", "n"))

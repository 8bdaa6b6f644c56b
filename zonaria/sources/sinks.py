"""Writers: Parquet layers, GeoJSON lines, CSV and JSON reports, parcel files, tiles, append-only log."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import crs as C
from ..functions import geometry as G
from ..operators.demand import LOG_COLUMNS
from ..operators.parcels import hilbert_key
from ..operators.shapes import repair


def write_layer(df: DataFrame, path: str, partition: str = "region", key: str | None = None, size: float = 2_000.0) -> None:
    """Master layer as Parquet by region; empty shapes are left out. With the ``key`` of its rows, self-crossing shapes are
    replaced by the ground they cover."""
    kept = df.where(~G.is_empty(F.col("geom"))) if key is None else repair(df, key, size)
    kept.write.mode("overwrite").partitionBy(partition).parquet(path)


def export_checks(df: DataFrame) -> DataFrame:
    """Counts of the export: invalid shapes and empty ones."""
    return df.agg(F.count("*").alias("piezas"), F.count(F.when(G.crosses_itself(F.col("geom")), 1)).alias("piezas_invalidas"),
                  F.count(F.when(G.is_empty(F.col("geom")), 1)).alias("piezas_degeneradas"))


def in_lonlat(df: DataFrame, geom: str = "geom") -> DataFrame:
    """Metric shapes for GeoJSON: lon/lat, outer rings counter-clockwise and holes clockwise."""
    return df.withColumn(geom, G.wound(C.to_lonlat(F.col(geom))))


def feature_json(df: DataFrame, digits: int = 6, raw_attributes: bool = False, geom: str = "geom") -> Column:
    """GeoJSON Feature text of a row; the coordinates are written as they are."""
    columns = [c for c in df.columns if c != geom and (raw_attributes or c != "attrs_raw")]
    return F.to_json(F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("MultiPolygon").alias("type"), G.to_coordinates(F.col(geom), digits).alias("coordinates")).alias("geometry"),
        F.struct(*columns).alias("properties")))


def write_geojson_lines(df: DataFrame, path: str, partition: str | None = "region", digits: int = 6, raw_attributes: bool = False,
                        metric: bool = False) -> None:
    """One Feature per line; with ``partition`` one folder per region. ``metric`` shapes are brought to lon/lat first."""
    df = in_lonlat(df) if metric else df
    keep = [partition] if partition else []
    lines = df.select(feature_json(df, digits, raw_attributes).alias("value"), *keep)
    writer = lines.write.mode("overwrite")
    (writer.partitionBy(partition) if partition else writer).text(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def append_demand(lines: DataFrame, path: str) -> None:
    """Append to the demand log; only the agreed columns are ever written."""
    lines.select(*LOG_COLUMNS).write.mode("append").json(path)


def spatially_sorted(df: DataFrame, extent: tuple[float, float, float, float], order: int = 10) -> DataFrame:
    """Adds ``bbox`` and the Hilbert position of the box centre within the extent."""
    xmin, ymin, xmax, ymax = extent
    top = 2 ** order - 1
    df = df.withColumn("bbox", G.bbox(F.col("geom")))

    def cell(low: str, high: str, start: float, end: float) -> Column:
        middle = (F.col(f"bbox.{low}") + F.col(f"bbox.{high}")) / 2
        return F.least(F.greatest(F.floor((middle - start) / (end - start) * top), F.lit(0)), F.lit(top))

    return df.withColumn("hilbert", hilbert_key(cell("xmin", "xmax", xmin, xmax), cell("ymin", "ymax", ymin, ymax), order))


def write_parcels(df: DataFrame, path: str, extent: tuple[float, float, float, float], row_group_bytes: int = 2_000_000, by_comuna: bool = True) -> None:
    """Parcels in order of comuna and Hilbert position with a covering box, small row groups, so a point lookup skips most groups.
    Rows are range-partitioned by (cut, position): a large comuna becomes several files, not one task. ``by_comuna``: a folder
    for each comuna; without it ``cut`` is a column, and the number of files follows the tasks, not the comunas (for tables of
    so many comunas that opening a file for each would outweigh the rows)."""
    placed = spatially_sorted(df, extent)
    writer = (placed.repartitionByRange("cut", "hilbert").sortWithinPartitions("cut", "hilbert").write.mode("overwrite").option("compression", "zstd")
              .option("parquet.block.size", row_group_bytes))
    (writer.partitionBy("cut") if by_comuna else writer).parquet(path)


def write_tiles(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").partitionBy("z").parquet(path)


def tile_fields(pieces: DataFrame) -> DataFrame:
    """Attributes carried by vector tiles: zone cut to 90 characters, risk as 0/1."""
    return pieces.withColumns({"zona": F.left("zona", F.lit(90)), "riesgo": F.coalesce(F.col("riesgo").cast("int"), F.lit(0))})

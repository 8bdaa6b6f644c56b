"""From raw parcel backups to calculated volume."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import crs as C
from ..operators import parcels as P
from ..operators import volume as V


def parcel_table(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Backup rows (text, lon/lat geometry, cut, comuna_bcn, cod_capa, origen, row_id) → (parcels with units, roles without polygon)."""
    usable, lost = P.usable_geometry(raw)
    clean = P.clean(usable.withColumn("geom", C.to_albers(F.col("geom"))))
    same = F.xxhash64("cut", "rol", "id_poligono", "metodo", "origen")    # rows that agree in all of these are numbered
    rest = F.xxhash64(*[F.to_json("geom") if c == "geom" else F.col(c) for c in clean.columns])
    keyed = clean.withColumn("_s", same).withColumn("row_id", F.xxhash64("_s", F.row_number().over(W.partitionBy("_s").orderBy(rest)))).drop("_s")
    return P.group_units(keyed), lost


def volume_by_terrain(parcels: DataFrame, buildings: DataFrame, size: float, zones: DataFrame | None = None,
                      floor_height: float | None = None) -> DataFrame:
    """One line per terrain with certain roles: footprint, floors and volume."""
    terrains = V.terrains(parcels).withColumn("rid", F.col("id_poligono"))
    return V.calculated(terrains, buildings, size, zones, floor_height=floor_height)

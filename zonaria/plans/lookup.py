"""Cards for a batch of places."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cards as K
from ..operators import registry as R


def cards(points: DataFrame, polygons: DataFrame, pieces: DataFrame, affectations: DataFrame, matches: DataFrame,
          size: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(heads, partition lines with validity, affectation lines) of points(qid, x, y) and polygons(qid, geom)."""
    share = K.shares(points, polygons, pieces, size)
    asked = points.select("qid", F.lit(True).alias("es_punto")).unionByName(polygons.select("qid", F.lit(False).alias("es_punto")))
    lines = R.attach_validity(K.card_rows(share, pieces), matches)
    other = K.affectation_rows(K.shares(points, polygons, affectations, size, single=False), affectations)
    return K.card_heads(asked, share, pieces), lines, other

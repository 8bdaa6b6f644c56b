"""Small shapes and frames for the tests."""
from zonaria.functions import geometry as G


def ring(*points):
    return [{"x": float(x), "y": float(y)} for x, y in [*points, points[0]]]


def box(x0, y0, x1, y1):
    return [[ring((x0, y0), (x1, y0), (x1, y1), (x0, y1))]]


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema.replace("GEOM", G.GEOMETRY))

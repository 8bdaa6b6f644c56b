"""Closed-form projections as column expressions."""
from __future__ import annotations

import math

import numpy as np

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import half_even
from . import geometry as G

# South America equal-area conic (ESRI:102033), ellipsoid a = 6378160, 1/f = 298.25.
A, INV_F = 6378160.0, 298.25
PHI1, PHI2, PHI0, LAM0 = (math.radians(v) for v in (-5.0, -42.0, -32.0, -60.0))
E2 = (2 - 1 / INV_F) / INV_F
E1 = math.sqrt(E2)
WEB_RADIUS = 6378137.0


def _q(phi: float) -> float:
    s = math.sin(phi)
    return (1 - E2) * (s / (1 - E2 * s * s) - math.log((1 - E1 * s) / (1 + E1 * s)) / (2 * E1))


def _m2(phi: float) -> float:
    return math.cos(phi) ** 2 / (1 - E2 * math.sin(phi) ** 2)


_N = (_m2(PHI1) - _m2(PHI2)) / (_q(PHI2) - _q(PHI1))
_C = _m2(PHI1) + _N * _q(PHI1)
_RHO0 = A * math.sqrt(_C - _N * _q(PHI0)) / _N


def albers_xy(lon: Column, lat: Column) -> Column:
    """struct(x, y) in metres, equal area."""
    s = F.sin(F.radians(lat))
    q = (1 - E2) * (s / (1 - E2 * s * s) - F.ln((1 - E1 * s) / (1 + E1 * s)) / (2 * E1))
    rho = F.lit(A) * F.sqrt(F.lit(_C) - _N * q) / _N
    theta = _N * (F.radians(lon) - LAM0)
    return G.let(F.struct(rho.alias("r"), theta.alias("t")), lambda v: G.point(
        v["r"] * F.sin(v["t"]), F.lit(_RHO0) - v["r"] * F.cos(v["t"])))


def albers_lonlat(x: Column, y: Column) -> Column:
    """Inverse of :func:`albers_xy`, by a fixed number of Newton steps."""
    dy = F.lit(_RHO0) - y
    sign = -1.0 if _N < 0 else 1.0
    rho = sign * F.sqrt(x * x + dy * dy)
    q = (_C - F.pow(rho * _N / A, 2)) / _N
    lon = F.degrees(F.lit(LAM0) + F.atan2(sign * x, sign * dy) / _N)

    def step(phi: Column, q: Column) -> Column:
        s = F.sin(phi)
        w = 1 - E2 * s * s
        return phi + w * w / (2 * F.cos(phi)) * (q / (1 - E2) - s / w + F.ln((1 - E1 * s) / (1 + E1 * s)) / (2 * E1))

    lat = F.aggregate(F.sequence(F.lit(1), F.lit(6)), G.let(q, lambda v: F.asin(v / 2)),
                      lambda phi, _: step(phi, q), lambda phi: F.degrees(phi))
    return G.point(lon, lat)


def to_albers(geom: Column, digits: int = 3) -> Column:
    """Lon/lat geometry → equal-area metres on the 1 mm grid."""
    def project(p: Column) -> Column:
        return G.let(albers_xy(p["x"], p["y"]), lambda v: G.point(half_even(v["x"], digits), half_even(v["y"], digits)))

    return F.transform(geom, lambda poly: F.transform(poly, lambda ring: F.transform(ring, project)))


def to_lonlat(geom: Column) -> Column:
    return F.transform(geom, lambda poly: F.transform(poly, lambda ring: F.transform(
        ring, lambda p: albers_lonlat(p["x"], p["y"]))))


def web_mercator_x(lon: Column) -> Column:
    return F.radians(lon) * WEB_RADIUS


def web_mercator_y(lat: Column) -> Column:
    return F.ln(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * WEB_RADIUS


def web_lon(x: Column) -> Column:
    return F.degrees(x / WEB_RADIUS)


def web_lat(y: Column) -> Column:
    return F.degrees(2 * F.atan(F.exp(y / WEB_RADIUS)) - math.pi / 2)


# Interrupted Goode homolosine on the sphere: radius, latitude of the change of projection (degrees), offset of
# the outer part in radii, and the lobes (west, east, central meridian) of each hemisphere.
GOODE_RADIUS = 6378137.0
GOODE_LATITUDE = 40 + 44 / 60 + 11.8 / 3600
GOODE_OFFSET = 0.0528035274542
GOODE_NORTH = ((-180, -40, -100), (-40, 180, 30))
GOODE_SOUTH = ((-180, -100, -160), (-100, -20, -60), (-20, 80, 20), (80, 180, 140))


def homolosine_lobe(west: float, east: float, south: bool) -> float:
    """Central meridian of the lobe that holds all longitudes from ``west`` to ``east``."""
    for first, last, centre in GOODE_SOUTH if south else GOODE_NORTH:
        if first <= west and east <= last:
            return centre
    raise ValueError("the longitudes reach over more than one lobe")


def homolosine(phi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Metres of a radian of longitude, and northing, at latitudes in radians: sinusoidal inside, Mollweide outside."""
    outer = np.abs(phi) > math.radians(GOODE_LATITUDE)
    theta = phi.copy()
    for _ in range(40):  # Newton on 2 t + sin 2 t = pi sin phi
        slope = 2 + 2 * np.cos(2 * theta)
        theta = theta - np.where(slope > 1e-9, (2 * theta + np.sin(2 * theta) - math.pi * np.sin(phi)) / np.where(slope > 1e-9, slope, 1), 0)
    scale = np.where(outer, 2 * math.sqrt(2) / math.pi * np.cos(theta), np.cos(phi))
    north = np.where(outer, math.sqrt(2) * np.sin(theta) - np.sign(phi) * GOODE_OFFSET, phi)
    return GOODE_RADIUS * scale, GOODE_RADIUS * north

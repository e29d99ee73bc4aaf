"""Map projections in closed form, as column expressions (spheres and ellipsoids of Snyder's manual)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# GRS80, and the European equal-area grid's centre and false origin.
SEMI_MAJOR, FLATTENING = 6378137.0, 1 / 298.257222101
CENTRE_LAT, CENTRE_LON, FALSE_EAST, FALSE_NORTH = 52.0, 10.0, 4321000.0, 3210000.0
E2 = FLATTENING * (2 - FLATTENING)
E = math.sqrt(E2)


def _authalic(s: float) -> float:
    return (1 - E2) * (s / (1 - E2 * s * s) - math.log((1 - E * s) / (1 + E * s)) / (2 * E))


_POLE = _authalic(1.0)
_RADIUS = SEMI_MAJOR * math.sqrt(_POLE / 2)
_BETA0 = math.asin(_authalic(math.sin(math.radians(CENTRE_LAT))) / _POLE)
_D = SEMI_MAJOR * math.cos(math.radians(CENTRE_LAT)) / math.sqrt(1 - E2 * math.sin(math.radians(CENTRE_LAT)) ** 2) / (_RADIUS * math.cos(_BETA0))


def equal_area(lon: Column, lat: Column) -> tuple[Column, Column]:
    """(easting, northing) in the European Lambert azimuthal equal-area grid."""
    s = F.sin(F.radians(lat))
    q = (1 - E2) * (s / (1 - E2 * s * s) - F.ln((1 - E * s) / (1 + E * s)) / (2 * E))
    sin_b = q / _POLE
    cos_b = F.sqrt(F.greatest(1 - sin_b * sin_b, F.lit(0.0)))
    away = F.radians(lon - CENTRE_LON)
    b = _RADIUS * F.sqrt(2 / (1 + math.sin(_BETA0) * sin_b + math.cos(_BETA0) * cos_b * F.cos(away)))
    return FALSE_EAST + b * _D * cos_b * F.sin(away), FALSE_NORTH + b / _D * (math.cos(_BETA0) * sin_b - math.sin(_BETA0) * cos_b * F.cos(away))


def equal_area_inverse(x: Column, y: Column) -> tuple[Column, Column]:
    """(lon, lat) of a place in the European grid."""
    u, v = (x - FALSE_EAST) / _D, (y - FALSE_NORTH) * _D
    rho = F.sqrt(u * u + v * v)
    c = 2 * F.asin(F.least(rho / (2 * _RADIUS), F.lit(1.0)))
    beta = F.when(rho < 1e-9, F.lit(_BETA0)).otherwise(F.asin(F.cos(c) * math.sin(_BETA0) + v * F.sin(c) * math.cos(_BETA0) / rho))
    lon = CENTRE_LON + F.degrees(F.atan2(u * F.sin(c), rho * math.cos(_BETA0) * F.cos(c) - v * math.sin(_BETA0) * F.sin(c)))
    e4, e6 = E2**2, E2**3
    lat = beta + (E2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) * F.sin(2 * beta) + (23 * e4 / 360 + 251 * e6 / 3780) * F.sin(4 * beta) + 761 * e6 / 45360 * F.sin(6 * beta)
    return F.when(rho < 1e-9, F.lit(CENTRE_LON)).otherwise(lon), F.degrees(lat)


def mollweide(lon: Column, lat: Column, radius: float = SEMI_MAJOR, steps: int = 8) -> tuple[Column, Column]:
    """(x, y) in Mollweide's projection of the sphere, by Newton steps on the auxiliary angle."""
    phi = F.radians(lat)

    def newton(t: Column, _: Column) -> Column:
        slope = 2 + 2 * F.cos(2 * t)
        return F.when(slope < 1e-12, t).otherwise(t - (2 * t + F.sin(2 * t) - math.pi * F.sin(phi)) / slope)

    # A fold, so that the expression does not double with every step.
    t = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), phi, newton)
    return radius * 2 * math.sqrt(2) / math.pi * F.radians(lon) * F.cos(t), radius * math.sqrt(2) * F.sin(t)


def mercator_y(lat: Column) -> Column:
    return F.ln(F.tan(math.pi / 4 + F.radians(lat) / 2))


def geostationary_inverse(x: Column, y: Column, height: float = 35786400.0, a: float = 6378137.0, b: float = 6356752.3) -> tuple[Column, Column]:
    """(lon, lat) seen at scan angles (radians) from a satellite over longitude 0; missing off the disk."""
    far = height + a
    k = (a / b) ** 2
    cx, cy, sx, sy = F.cos(x), F.cos(y), F.sin(x), F.sin(y)
    flat = cy * cy + k * sy * sy
    inside = (far * cx * cy) * (far * cx * cy) - flat * (far * far - a * a)
    n = (far * cx * cy - F.sqrt(F.greatest(inside, F.lit(0.0)))) / flat
    s1, s2, s3 = far - n * cx * cy, n * sx * cy, n * sy
    on = inside >= 0
    return F.when(on, F.degrees(F.atan2(s2, s1))), F.when(on, F.degrees(F.atan(k * s3 / F.sqrt(s1 * s1 + s2 * s2))))

"""Map projections as Column arithmetic (no UDF, stays in generated code)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS-84 ellipsoid and UTM constants.
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
UTM_SCALE = 0.9996
UTM_FALSE_EASTING = 500000.0
UTM_FALSE_NORTHING_SOUTH = 10000000.0
DEG_PER_RAD = 180.0 / math.pi

_N = WGS84_F / (2 - WGS84_F)
_E = math.sqrt(WGS84_F * (2 - WGS84_F))
_RECTIFYING = WGS84_A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)

# Krüger series in the third flattening, fourth order (published).
_ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
)
_BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840,
    4397 * _N**4 / 161280,
)
_DELTA = (
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45,
    7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45,
    56 * _N**3 / 15 - 136 * _N**4 / 35,
    4279 * _N**4 / 630,
)


def utm_zone(srid: int) -> tuple[float, bool]:
    """Central meridian in degrees and whether the zone is southern, from an EPSG code.

    Accepts WGS-84 UTM (326zz, 327zz) and NAD83 UTM (269zz; same ellipsoid to a fraction of a mm).
    """
    family, zone = divmod(srid, 100)
    if family not in (326, 327, 269) or not 1 <= zone <= 60:
        raise ValueError(f"not a UTM code: {srid}")
    return zone * 6.0 - 183.0, family == 327


def project_utm(lon: Column, lat: Column, srid: int) -> Column:
    """Degrees → ``STRUCT<x,y>`` metres."""
    meridian, south = utm_zone(srid)
    phi, dlam = F.radians(lat), F.radians(lon - meridian)
    t = F.sinh(F.atanh(F.sin(phi)) - _E * F.atanh(_E * F.sin(phi)))
    xi = F.atan2(t, F.cos(dlam))
    eta = F.atanh(F.sin(dlam) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, a in enumerate(_ALPHA, start=1):
        x = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    scale = UTM_SCALE * _RECTIFYING
    north = UTM_FALSE_NORTHING_SOUTH if south else 0.0
    return F.struct((UTM_FALSE_EASTING + scale * x).alias("x"), (north + scale * y).alias("y"))


def unproject_utm(x: Column, y: Column, srid: int) -> Column:
    """Metres → ``STRUCT<lon,lat>`` degrees."""
    meridian, south = utm_zone(srid)
    north = UTM_FALSE_NORTHING_SOUTH if south else 0.0
    scale = UTM_SCALE * _RECTIFYING
    xi, eta = (y - north) / scale, (x - UTM_FALSE_EASTING) / scale
    xi0, eta0 = xi, eta
    for j, b in enumerate(_BETA, start=1):
        xi0 = xi0 - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta0 = eta0 - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi0) / F.cosh(eta0))
    phi = chi
    for j, d in enumerate(_DELTA, start=1):
        phi = phi + d * F.sin(2 * j * chi)
    lam = F.atan2(F.sinh(eta0), F.cos(xi0))
    return F.struct((meridian + F.degrees(lam)).alias("lon"), F.degrees(phi).alias("lat"))


def project_web_mercator(lon: Column, lat: Column) -> Column:
    return F.struct((WGS84_A * F.radians(lon)).alias("x"),
                    (WGS84_A * F.log(F.tan(math.pi / 4 + F.radians(lat) / 2))).alias("y"))


def approx_metres(lon: Column, lat: Column) -> Column:
    """Flat-earth metres at mid latitudes: 85 km per degree east, 111 km per degree north."""
    return F.struct((lon * 85000.0).alias("x"), (lat * 111000.0).alias("y"))


def project_path(path: Column, srid: int) -> Column:
    """Project an array of ``STRUCT<lon,lat>`` (or x=lon, y=lat)."""
    return F.transform(path, lambda p: project_utm(p["x"], p["y"], srid))

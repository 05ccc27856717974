"""Transverse Mercator between longitude/latitude and UTM metres, as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from hexloom.functions import geometry as G

# WGS 84 ellipsoid and UTM constants.
SEMI_MAJOR_M = 6378137.0
FLATTENING = 1 / 298.257223563
SCALE = 0.9996
FALSE_EASTING = 500000.0
FALSE_NORTHING_SOUTH = 10000000.0

_N = FLATTENING / (2 - FLATTENING)
RECTIFYING = SEMI_MAJOR_M / (1 + _N) * (1 + _N ** 2 / 4 + _N ** 4 / 64)
# Krueger series to the third order.
ALPHA = (_N / 2 - 2 * _N ** 2 / 3 + 5 * _N ** 3 / 16,
          13 * _N ** 2 / 48 - 3 * _N ** 3 / 5,
          61 * _N ** 3 / 240)
BETA = (_N / 2 - 2 * _N ** 2 / 3 + 37 * _N ** 3 / 96,
         _N ** 2 / 48 + _N ** 3 / 15,
         17 * _N ** 3 / 480)
DELTA = (2 * _N - 2 * _N ** 2 / 3 - 2 * _N ** 3,
          7 * _N ** 2 / 3 - 8 * _N ** 3 / 5,
          56 * _N ** 3 / 15)
ECC = 2 * math.sqrt(_N) / (1 + _N)


def utm_zone(lon: Column) -> Column:
    zone = F.floor((lon + 180) / 6).cast("int") + 1
    return F.least(F.greatest(zone, F.lit(1)), F.lit(60))


def utm_code(lon: Column, lat: Column) -> Column:
    """EPSG text of the UTM zone of a coordinate."""
    base = F.when(lat >= 0, F.lit("EPSG:326")).otherwise(F.lit("EPSG:327"))
    return F.concat(base, F.lpad(utm_zone(lon).cast("string"), 2, "0"))


def zone_of_code(code: str) -> tuple[int, bool]:
    """(zone, south) of an ``EPSG:326zz`` / ``EPSG:327zz`` text."""
    digits = code.split(":")[-1]
    return int(digits[-2:]), digits.startswith("327")


def to_utm(lon: Column, lat: Column, zone: int | Column, south: bool | Column) -> Column:
    """STRUCT<x,y> easting and northing in metres."""
    centre = (zone if isinstance(zone, Column) else F.lit(zone)) * 6.0 - 183.0
    is_south = south if isinstance(south, Column) else F.lit(south)
    phi, lam = F.radians(lat), F.radians(lon - centre)
    sin_phi = F.sin(phi)
    tau = F.sinh(F.atanh(sin_phi) - ECC * F.atanh(ECC * sin_phi))
    base = F.struct(F.atan2(tau, F.cos(lam)).alias("xi"),
                    F.atanh(F.sin(lam) / F.sqrt(1.0 + tau * tau)).alias("eta"))

    def spread(v):
        xi, eta = v.xi, v.eta
        north, east = xi, eta
        for j, a in enumerate(ALPHA, start=1):
            north = north + a * F.sin(2.0 * j * xi) * F.cosh(2.0 * j * eta)
            east = east + a * F.cos(2.0 * j * xi) * F.sinh(2.0 * j * eta)
        shift = F.when(is_south, F.lit(FALSE_NORTHING_SOUTH)).otherwise(F.lit(0.0))
        return G.point(FALSE_EASTING + SCALE * RECTIFYING * east,
                       shift + SCALE * RECTIFYING * north)

    return G.bind(base, spread)


def from_utm(x: Column, y: Column, zone: int, south: bool) -> Column:
    """STRUCT<x,y> longitude and latitude in degrees."""
    shift = FALSE_NORTHING_SOUTH if south else 0.0
    xi = (y - shift) / (SCALE * RECTIFYING)
    eta = (x - FALSE_EASTING) / (SCALE * RECTIFYING)

    def unspread(v):
        xi1, eta1 = v.xi, v.eta
        for j, b in enumerate(BETA, start=1):
            xi1 = xi1 - b * F.sin(2.0 * j * v.xi) * F.cosh(2.0 * j * v.eta)
            eta1 = eta1 - b * F.cos(2.0 * j * v.xi) * F.sinh(2.0 * j * v.eta)
        return G.bind(F.struct(xi1.alias("xi"), eta1.alias("eta")), finish)

    def finish(v):
        chi = F.asin(F.sin(v.xi) / F.cosh(v.eta))
        phi = chi
        for j, d in enumerate(DELTA, start=1):
            phi = phi + d * F.sin(2.0 * j * chi)
        lon = zone * 6.0 - 183.0 + F.degrees(F.atan2(F.sinh(v.eta), F.cos(v.xi)))
        return G.point(lon, F.degrees(phi))

    return G.bind(F.struct(xi.alias("xi"), eta.alias("eta")), unspread)

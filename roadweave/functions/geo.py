"""Geodetic frame changes as column expressions."""

from __future__ import annotations

import math

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The WGS 84 ellipsoid and the UTM projection.
A = 6378137.0
INV_F = 298.257223563
B = A * (1 - 1 / INV_F)
E2 = 1 - (B / A) ** 2
EP2 = (A / B) ** 2 - 1
UTM_SCALE = 0.9996
UTM_EASTING = 500_000.0


def _prime_vertical(sin_lat: Column) -> Column:
    return F.lit(A) / F.sqrt(1 - F.lit(E2) * sin_lat * sin_lat)


def latlon_to_ecef(lat: Column, lon: Column, h: Column) -> tuple[Column, Column, Column]:
    """Degrees and metres to earth-centred metres."""
    la, lo = F.radians(lat), F.radians(lon)
    n = _prime_vertical(F.sin(la))
    return (h + n) * F.cos(la) * F.cos(lo), (h + n) * F.cos(la) * F.sin(lo), (h + (1 - E2) * n) * F.sin(la)


def ecef_to_enu(x: Column, y: Column, z: Column, lat0: float, lon0: float, h0: float) -> tuple[Column, Column, Column]:
    """Earth-centred metres to east, north, up of a reference point."""
    la, lo = math.radians(lat0), math.radians(lon0)
    n = A / math.sqrt(1 - E2 * math.sin(la) ** 2)
    x0, y0, z0 = (h0 + n) * math.cos(la) * math.cos(lo), (h0 + n) * math.cos(la) * math.sin(lo), (h0 + (1 - E2) * n) * math.sin(la)
    dx, dy, dz = x - x0, y - y0, z - z0
    east = dx * -math.sin(lo) + dy * math.cos(lo)
    north = dx * (-math.cos(lo) * math.sin(la)) + dy * (-math.sin(la) * math.sin(lo)) + dz * math.cos(la)
    up = dx * (math.cos(la) * math.cos(lo)) + dy * (math.cos(la) * math.sin(lo)) + dz * math.sin(la)
    return east, north, up


def latlon_to_enu(lat: Column, lon: Column, h: Column, lat0: float, lon0: float, h0: float) -> tuple[Column, Column, Column]:
    return ecef_to_enu(*latlon_to_ecef(lat, lon, h), lat0, lon0, h0)


def enu_to_ecef(e: Column, n: Column, u: Column, lat0: float, lon0: float, h0: float) -> tuple[Column, Column, Column]:
    la, lo = math.radians(lat0), math.radians(lon0)
    m = A / math.sqrt(1 - E2 * math.sin(la) ** 2)
    x0, y0, z0 = (h0 + m) * math.cos(la) * math.cos(lo), (h0 + m) * math.cos(la) * math.sin(lo), (h0 + (1 - E2) * m) * math.sin(la)
    x = e * -math.sin(lo) + n * (-math.sin(la) * math.cos(lo)) + u * (math.cos(la) * math.cos(lo)) + x0
    y = e * math.cos(lo) + n * (-math.sin(la) * math.sin(lo)) + u * (math.cos(la) * math.sin(lo)) + y0
    z = n * math.cos(la) + u * math.sin(la) + z0
    return x, y, z


def ecef_to_latlon(x: Column, y: Column, z: Column) -> tuple[Column, Column]:
    """Earth-centred metres to degrees, by the closed form with a parametric latitude."""
    p = F.sqrt(x * x + y * y)
    t = F.atan2(z * A, p * B)
    lat = F.atan2(z + EP2 * B * F.pow(F.sin(t), 3), p - E2 * A * F.pow(F.cos(t), 3))
    return F.degrees(lat), F.degrees(F.atan2(y, x))


def enu_to_latlon(e: Column, n: Column, u: Column, lat0: float, lon0: float, h0: float) -> tuple[Column, Column, Column]:
    """Back to degrees; the height is always 0."""
    return *ecef_to_latlon(*enu_to_ecef(e, n, u, lat0, lon0, h0)), F.lit(0.0)


def utm_zone(lon: Column) -> Column:
    return (F.floor((lon + 180) / 6) % 60 + 1).cast("int")


def latlon_to_utm(lat: Column, lon: Column, zone: int | None = None) -> tuple[Column, Column]:
    """Easting and northing in metres, by the transverse Mercator series; the zone is the point's own unless given."""
    z = F.lit(zone) if zone else utm_zone(lon)
    la = F.radians(lat)
    d = F.radians(lon - (z * 6 - 183))
    s, c = F.sin(la), F.cos(la)
    n = _prime_vertical(s)
    t, k, a = F.pow(F.tan(la), 2), EP2 * c * c, c * d
    e4, e6 = E2 * E2, E2 * E2 * E2
    m = A * ((1 - E2 / 4 - 3 * e4 / 64 - 5 * e6 / 256) * la - (3 * E2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024) * F.sin(2 * la) + (15 * e4 / 256 + 45 * e6 / 1024) * F.sin(4 * la) - (35 * e6 / 3072) * F.sin(6 * la))
    east = UTM_SCALE * n * (a + (1 - t + k) * F.pow(a, 3) / 6 + (5 - 18 * t + t * t + 72 * k - 58 * EP2) * F.pow(a, 5) / 120) + UTM_EASTING
    north = UTM_SCALE * (m + n * F.tan(la) * (a * a / 2 + (5 - t + 9 * k + 4 * k * k) * F.pow(a, 4) / 24 + (61 - 58 * t + t * t + 600 * k - 330 * EP2) * F.pow(a, 6) / 720))
    return east, F.when(lat < 0, north + 10_000_000.0).otherwise(north)


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once, however often ``f`` names it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def utm_to_latlon(east: Column, north: Column, zone: Column | int, northern: Column | bool = True) -> tuple[Column, Column]:
    """Degrees of UTM metres, by the inverse transverse Mercator series from the footpoint latitude; back within a millimetre."""
    e4, e6 = E2 * E2, E2 * E2 * E2
    e1 = (1 - (1 - E2) ** 0.5) / (1 + (1 - E2) ** 0.5)
    of = lambda v: v if isinstance(v, Column) else F.lit(v)
    mu = (north - F.when(of(northern), 0.0).otherwise(10_000_000.0)) / UTM_SCALE / (A * (1 - E2 / 4 - 3 * e4 / 64 - 5 * e6 / 256))

    def foot(m: Column) -> Column:
        p = m + (3 * e1 / 2 - 27 * e1**3 / 32) * F.sin(2 * m) + (21 * e1**2 / 16 - 55 * e1**4 / 32) * F.sin(4 * m) + (151 * e1**3 / 96) * F.sin(6 * m) + (1097 * e1**4 / 512) * F.sin(8 * m)
        return F.struct(p.alias("p"), m.alias("m"))

    def parts(v: Column) -> Column:
        p = v["p"]
        n = _prime_vertical(F.sin(p))
        r = A * (1 - E2) / F.pow(1 - E2 * F.sin(p) * F.sin(p), 1.5)
        return F.struct(p.alias("p"), n.alias("n"), r.alias("r"), F.tan(p).alias("tan"), F.cos(p).alias("cos"), F.pow(F.tan(p), 2).alias("t"), (EP2 * F.cos(p) * F.cos(p)).alias("k"), ((east - UTM_EASTING) / (n * UTM_SCALE)).alias("d"))

    def degrees(v: Column) -> Column:
        t, k, d = v["t"], v["k"], v["d"]
        lat = v["p"] - v["n"] * v["tan"] / v["r"] * (d * d / 2 - (5 + 3 * t + 10 * k - 4 * k * k - 9 * EP2) * F.pow(d, 4) / 24 + (61 + 90 * t + 298 * k + 45 * t * t - 252 * EP2 - 3 * k * k) * F.pow(d, 6) / 720)
        lon = (d - (1 + 2 * t + k) * F.pow(d, 3) / 6 + (5 - 2 * k + 28 * t - 3 * k * k + 8 * EP2 + 24 * t * t) * F.pow(d, 5) / 120) / v["cos"]
        return F.struct(F.degrees(lat).alias("lat"), F.degrees(lon).alias("lon"))

    found = _let(mu, lambda m: _let(foot(m), lambda v: _let(parts(v), degrees)))
    return found["lat"], found["lon"] + (of(zone) * 6 - 183)

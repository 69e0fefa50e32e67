"""Spherical geometry and space-filling-curve codes as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in km.
EARTH_KM = 6371.0088


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    h = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(2 * EARTH_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def located(lat: Column, lon: Column) -> Column:
    """Both coordinates present, in range, and not the 0/0 filler. Never null."""
    ok = ~F.isnan(lat) & ~F.isnan(lon) & (F.abs(lat) <= 90) & (F.abs(lon) <= 180) & ~((lat == 0) & (lon == 0))
    return F.coalesce(ok, F.lit(False))


def unit_vector(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    la, lo = F.radians(lat), F.radians(lon)
    return F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la)


def chord(km: float) -> float:
    """Straight-line length, on the unit sphere, of an arc of ``km``."""
    return 2 * math.sin(min(km / EARTH_KM, math.pi) / 2)


# The usual shifts and masks for spreading 21 bits three positions apart.
SPREAD3 = ((32, 0x1F00000000FFFF), (16, 0x1F0000FF0000FF), (8, 0x100F00F00F00F00F), (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249))


def with_morton3(df: DataFrame, name: str, x: str, y: str, z: str) -> DataFrame:
    """Adds the Z-order code of three integer cell coordinates below 2**21; 0 where one is null.

    Each spreading step is a projection of its own: as one expression the steps would double the tree five times. For the
    same reason the code is never null, so that no test for nulls is inferred and pushed through the steps.
    """
    tmp = {f"_m{i}": F.col(c) for i, c in enumerate((x, y, z))}
    df = df.withColumns(tmp)
    for shift, mask in SPREAD3:
        df = df.withColumns({c: F.col(c).bitwiseOR(F.shiftleft(F.col(c), shift)).bitwiseAND(F.lit(mask)) for c in tmp})
    code = F.col("_m0").bitwiseOR(F.shiftleft(F.col("_m1"), 1)).bitwiseOR(F.shiftleft(F.col("_m2"), 2))
    return df.withColumn(name, F.coalesce(code, F.lit(0).cast("bigint"))).drop(*tmp)


def equal_earth_mm(lat: Column, lon: Column, width_mm: float = 3000.0) -> tuple[Column, Column]:
    """Equal Earth projection, centred on (0, 0) with y up, scaled so that the equator spans ``width_mm``."""
    # The projection's published polynomial coefficients.
    a1, a2, a3, a4 = 1.340264, -0.081106, 0.000893, 0.003796
    m = math.sqrt(3) / 2
    scale = width_mm * m * a1 / (2 * math.pi)
    t = F.asin(F.lit(m) * F.sin(F.radians(lat)))
    t2 = t * t
    t6 = t2 * t2 * t2
    slope = F.lit(a1) + F.lit(3 * a2) * t2 + t6 * (F.lit(7 * a3) + F.lit(9 * a4) * t2)
    x = F.radians(lon) * F.cos(t) / (F.lit(m) * slope)
    y = t * (F.lit(a1) + F.lit(a2) * t2 + t6 * (F.lit(a3) + F.lit(a4) * t2))
    return x * F.lit(scale), y * F.lit(scale)


def tile_fraction(lat: Column, lon: Column, zoom: int) -> tuple[Column, Column]:
    """Fractional Web-Mercator tile position."""
    n = float(2**zoom)
    return (lon + 180.0) / 360.0 * n, (F.lit(1.0) - F.asinh(F.tan(F.radians(lat))) / math.pi) / 2.0 * n


def metres_per_pixel(lat: Column, zoom: int) -> Column:
    # Fixed value: equatorial metres per pixel of a 256-pixel tile at zoom 0.
    return F.lit(156543.03392) * F.cos(F.radians(lat)) / float(2**zoom)

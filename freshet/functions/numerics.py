"""Rounding, classes and coordinates as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
KEEP_BITS = 13
THICKNESS_EDGES = (1, 10, 100, 1000, 10000)
STYLE_PERIODS = (2.0, 5.0, 10.0, 25.0, 50.0, 100.0)
NO_DATA = 255
MERCATOR_RADIUS = 6378137.0
AUTHALIC_E2 = 0.00669437999014


def null_nan(q: Column) -> Column:
    """Scans turn NaN into NULL: Spark orders NaN above every number."""
    return F.when(~F.isnan(q), q)


def keepbits(q: Column) -> Column:
    """Float32 rounded to 13 mantissa bits, ties to even; NULL, NaN, 0 and infinities pass."""
    single = q.cast("float")
    x = single.cast("double")
    exponent = F.greatest(F.floor(F.log2(F.abs(x))).cast("double"), F.lit(-126.0))
    rounded = F.rint(x * F.pow(F.lit(2.0), KEEP_BITS - exponent)) * F.pow(F.lit(2.0), exponent - KEEP_BITS)
    odd = x.isNull() | F.isnan(x) | (x == 0) | (F.abs(x) == float("inf"))
    return F.when(odd, single).otherwise(rounded.cast("float"))


def thickness_class(q: Column) -> Column:
    """1 plus the number of edges that the flow meets; NULL is 1."""
    met = sum((F.coalesce((q >= F.lit(float(e)).cast("float")).cast("int"), F.lit(0)) for e in THICKNESS_EDGES), F.lit(1))
    return met.cast("int")


def period_class(q: Column, thresholds: Column) -> Column:
    """How many of the thresholds (array<float>) the flow meets; NULL counts as not met."""
    return F.aggregate(thresholds, F.lit(0), lambda n, t: n + F.coalesce((q >= t).cast("int"), F.lit(0)))


def style_byte(level: Column, thickness: Column) -> Column:
    """Period class in the high bits, thickness class less 1 in the low three."""
    return F.shiftleft(level.cast("int"), 3).bitwiseOR((thickness - 1).cast("int")).cast("int")


def wrap_longitude(lon: Column) -> Column:
    return F.pmod(lon + 180.0, F.lit(360.0)) - 180.0


def mercator_y(lat: Column) -> Column:
    return MERCATOR_RADIUS * F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2))


def mercator_x(lon: Column) -> Column:
    return MERCATOR_RADIUS * F.radians(lon)


def box_area(west: Column, south: Column, east: Column, north: Column) -> Column:
    """Area (m2) of a box of longitudes and latitudes on the ellipsoid (authalic form)."""
    e = math.sqrt(AUTHALIC_E2)

    def q(lat: Column) -> Column:
        s = F.sin(F.radians(lat))
        return (1 - AUTHALIC_E2) * (s / (1 - AUTHALIC_E2 * s * s) - F.log((1 - e * s) / (1 + e * s)) / (2 * e))

    return (MERCATOR_RADIUS**2 / 2) * F.radians(east - west) * (q(north) - q(south))

"""Column functions of sky-survey tables."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

RAD = math.pi / 180


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with the value computed once, however often f reads it, also from inside other lambdas."""
    return F.transform(F.array(value), f)[0]


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970 with microseconds, from a TIMESTAMP or TIMESTAMP_NTZ read as UTC."""
    return F.unix_micros(ts.cast("timestamp")) / 1e6


def truthy(value: Column, words: tuple[str, ...] = ("true", "1")) -> Column:
    """Is the text one of `words`, whatever its case and outer spaces?  Null counts as false."""
    return F.coalesce(F.lower(F.trim(value.cast("string"))).isin(*words), F.lit(False))


def haversine(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Angle in degrees."""
    h = F.pow(F.sin((dec2 - dec1) * RAD / 2), 2) + F.cos(dec1 * RAD) * F.cos(dec2 * RAD) * F.pow(F.sin((ra2 - ra1) * RAD / 2), 2)
    return 2 * F.asin(F.sqrt(F.least(F.lit(1.0), h))) / RAD


def wrap_degrees(a: Column) -> Column:
    """Into [0, 360)."""
    return F.pmod(a, F.lit(360.0))


def magnitude(flux: Column, zero_point: Column) -> Column:
    """Null for a flux that isn't positive."""
    return F.when(flux > 0, -2.5 * F.log10(flux) + zero_point)


def magnitude_error(flux: Column, error: Column) -> Column:
    return F.when(flux > 0, 2.5 / math.log(10) * error / flux)


#: The flux of magnitude 0 in Jansky, the zero point of templates, the pass band's polynomial in BP - RP and its fallback.
JANSKY = 2416.0
TEMPLATE_ZERO_POINT = 25.0
COLOUR_TERMS = (0.0324473, -0.633923, 0.0891337, -0.00522555)
WITHOUT_COLOUR = -0.430


def flux_jansky(mag: Column) -> Column:
    return JANSKY * F.pow(F.lit(10.0), -0.4 * mag)


def flux_jansky_error(jansky: Column, mag_error: Column) -> Column:
    return jansky * (math.log(10) / 2.5) * mag_error


def known(value: Column) -> Column:
    """Neither null, NaN nor infinite."""
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))


def zero_point(kernel_sum: Column) -> Column:
    """Null for a sum that isn't positive."""
    return F.when(known(kernel_sum) & (kernel_sum > 0), TEMPLATE_ZERO_POINT + 2.5 * F.log10(kernel_sum))


def band_magnitude(g: Column, bp: Column, rp: Column) -> Column:
    """From three magnitudes by a cubic in their colour, or from the first alone where the colour isn't known; null without it."""
    colour = bp - rp
    full = g
    for i, c in enumerate(COLOUR_TERMS):
        full = full + c * F.pow(colour, F.lit(i))
    return F.when(known(g), F.when(known(colour), full).otherwise(g + WITHOUT_COLOUR))


def band_flux(mag: Column, zero_point: float = 20.44) -> Column:
    return F.pow(F.lit(10.0), -0.4 * (mag - zero_point))


def sinh_flux(value: Column, offset: Column, softening: Column) -> Column:
    """Inverse of an asinh stretch."""
    return offset + 2 * softening * F.sinh(value)


def stretched_flux(value: Column, offset: Column, softening: Column, seconds: Column, deviation: bool = False) -> Column:
    """Rate from a value stretched in magnitudes; for a variance's plane the root of the flux."""
    flux = sinh_flux(value * (math.log(10) / 2.5), offset, softening)
    return (F.sqrt(flux) if deviation else flux) / seconds


def inverse_tangent_plane(x: Column, y: Column, ra0: float, dec0: float) -> tuple[Column, Column]:
    """Sky position in degrees of plane offsets in degrees about (ra0, dec0)."""
    return inverse_tangent_plane_at(x, y, F.lit(ra0), F.lit(dec0))


def inverse_tangent_plane_at(x: Column, y: Column, ra0: Column, dec0: Column) -> tuple[Column, Column]:
    x, y, a0, d0 = x * RAD, y * RAD, ra0 * RAD, dec0 * RAD
    below = F.cos(d0) - y * F.sin(d0)
    ra = F.atan2(x, below) + a0
    dec = F.atan2(F.sin(d0) + y * F.cos(d0), F.sqrt(x * x + below * below))
    return wrap_degrees(ra / RAD), dec / RAD


def in_polygon(x: Column, y: Column, corners: list[tuple[float, float]]) -> Column:
    """Does a ray from the point cross an odd number of edges?  An edge counts its upper end and the points on it."""
    crossings = F.lit(0)
    for (x1, y1), (x2, y2) in zip(corners, corners[1:] + corners[:1]):
        if y1 != y2:
            crossing = (y > min(y1, y2)) & (y <= max(y1, y2)) & (x <= max(x1, x2))
            if x1 != x2:
                crossing = crossing & (x <= (y - y1) * (x2 - x1) / (y2 - y1) + x1)
            crossings = crossings + F.when(crossing, 1).otherwise(0)
    return crossings % 2 == 1


TERM = r"\s*[A-Za-z_][A-Za-z0-9_]*\s*"


def signed_terms(expression: Column) -> Column:
    """Array of (sign, label) of a sum such as a + b - c, labels being identifiers; null if it is empty or has another form."""
    parts = F.regexp_extract_all(expression, F.lit(r"[+-]?[^+-]+"), F.lit(0))
    label = lambda p: F.regexp_replace(p, r"^\s*[+-]?\s*|\s+$", "")
    terms = F.transform(parts, lambda p: F.struct(F.when(F.trim(p).startswith("-"), -1).otherwise(1).alias("sign"), label(p).alias("label")))
    return F.when(expression.rlike(rf"^\s*[+-]?{TERM}([+-]{TERM})*$"), F.filter(terms, lambda t: t["label"] != ""))

"""WKT points and the inverse Lambert conformal conic projection as columns."""

from __future__ import annotations

from math import cos, log, pi, radians, sin, sqrt, tan

from pyspark.sql import Column
from pyspark.sql import functions as F

# The projection of the stored coordinates (millimetres).
LAT_ORIGIN = -37.0
LON_ORIGIN = 145.0
LAT_PARALLEL_1 = -36.0
LAT_PARALLEL_2 = -38.0
FALSE_EASTING_M = 1_000_000.0
FALSE_NORTHING_M = 1_000_000.0
GRS80_RADIUS_M = 6_378_137.0
GRS80_INVERSE_FLATTENING = 298.257222101
MM_PER_M = 1000.0


def wkt_xy(col: Column | str, strict: bool = False) -> tuple[Column, Column]:
    """First and last coordinate token of ``POINT(x y)`` as text.

    The default strips the characters of the word and the brackets wherever they
    stand, so ``POINT (x y)`` gives an empty first token. ``strict`` accepts the
    blank and gives null for anything that is not a point.
    """
    value = F.col(col) if isinstance(col, str) else col
    if strict:
        shape = r"^\s*POINT\s*\(\s*(\S+)\s+(\S+)\s*\)\s*$"
        return tuple(F.nullif(F.regexp_extract(value, shape, i), F.lit("")) for i in (1, 2))
    bare = F.regexp_replace(value, "[POINT()]", "")
    return F.substring_index(bare, " ", 1), F.substring_index(bare, " ", -1)


def _cone() -> tuple[float, float, float, float]:
    """Eccentricity, cone constant, radius scale and radius at the origin."""
    flattening = 1 / GRS80_INVERSE_FLATTENING
    ecc = sqrt(2 * flattening - flattening**2)

    def scale(lat: float) -> float:
        return cos(lat) / sqrt(1 - (ecc * sin(lat)) ** 2)

    def conformal(lat: float) -> float:
        part = ecc * sin(lat)
        return tan(pi / 4 - lat / 2) / ((1 - part) / (1 + part)) ** (ecc / 2)

    first, second, origin = (radians(v) for v in (LAT_PARALLEL_1, LAT_PARALLEL_2, LAT_ORIGIN))
    n = log(scale(first) / scale(second)) / log(conformal(first) / conformal(second))
    big_f = GRS80_RADIUS_M * scale(first) / (n * conformal(first) ** n)
    return ecc, n, big_f, big_f * conformal(origin) ** n


def lcc_inverse(x_mm: Column | str, y_mm: Column | str, rounds: int = 5) -> tuple[Column, Column]:
    """Longitude and latitude in degrees of projected millimetres.

    The latitude series is unrolled ``rounds`` times into one column expression,
    so the projection stays inside generated code.
    """
    ecc, n, big_f, r_origin = _cone()
    sign = -1.0 if n < 0 else 1.0
    x = (F.col(x_mm) if isinstance(x_mm, str) else x_mm).cast("double") / MM_PER_M - FALSE_EASTING_M
    y = (F.col(y_mm) if isinstance(y_mm, str) else y_mm).cast("double") / MM_PER_M - FALSE_NORTHING_M
    down = F.lit(r_origin) - y
    radius = sign * F.sqrt(x * x + down * down)
    theta = F.atan2(sign * x, sign * down)
    t = F.pow(radius / big_f, F.lit(1 / n))
    lat = F.lit(pi / 2) - 2 * F.atan(t)
    for _ in range(rounds):
        ratio = 2 / (1 + ecc * F.sin(lat)) - 1
        lat = F.lit(pi / 2) - 2 * F.atan(t * F.pow(ratio, F.lit(ecc / 2)))
    return F.degrees(theta / n) + LON_ORIGIN, F.degrees(lat)

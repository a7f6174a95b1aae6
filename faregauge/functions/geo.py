"""Inverse Lambert conformal conic projection as column arithmetic.

Formulas 15-5 to 15-11 and 7-9 of Snyder, *Map Projections - A Working Manual*,
USGS Professional Paper 1395 (1987). Only plain arithmetic, so it stays inside
whole-stage code generation.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

US_SURVEY_FOOT = 1200 / 3937


@dataclass(frozen=True)
class Conic:
    """A two-parallel Lambert conformal conic; the defaults are EPSG:2263 on GRS 80."""

    first_parallel: float = 41 + 2 / 60
    second_parallel: float = 40 + 40 / 60
    origin_latitude: float = 40 + 10 / 60
    origin_longitude: float = -74.0
    false_easting_m: float = 300_000.0
    false_northing_m: float = 0.0
    semi_major_m: float = 6_378_137.0
    inverse_flattening: float = 298.257222101
    unit_m: float = US_SURVEY_FOOT

    @property
    def eccentricity(self) -> float:
        f = 1 / self.inverse_flattening
        return math.sqrt(2 * f - f * f)

    def parameters(self) -> tuple[float, float, float]:
        """Cone constant, scaled radius factor and radius of the origin, in metres."""
        e = self.eccentricity

        def m(degrees: float) -> float:
            phi = math.radians(degrees)
            return math.cos(phi) / math.sqrt(1 - (e * math.sin(phi)) ** 2)

        def t(degrees: float) -> float:
            phi = math.radians(degrees)
            swing = (1 - e * math.sin(phi)) / (1 + e * math.sin(phi))
            return math.tan(math.pi / 4 - phi / 2) / swing ** (e / 2)

        m1, m2 = m(self.first_parallel), m(self.second_parallel)
        t1, t2, t0 = t(self.first_parallel), t(self.second_parallel), t(self.origin_latitude)
        n = (math.log(m1) - math.log(m2)) / (math.log(t1) - math.log(t2))
        radius_factor = self.semi_major_m * m1 / (n * t1**n)
        return n, radius_factor, radius_factor * t0**n


def to_latitude_longitude(
    x: Column, y: Column, conic: Conic = Conic(), rounds: int = 5
) -> tuple[Column, Column]:
    """Latitude and longitude in degrees of a point in the conic's own unit."""
    n, factor, origin_radius = conic.parameters()
    e = conic.eccentricity
    east = x * conic.unit_m - conic.false_easting_m
    north = origin_radius - (y * conic.unit_m - conic.false_northing_m)
    t = F.pow(F.sqrt(east * east + north * north) / factor, F.lit(1 / n))
    latitude = math.pi / 2 - 2 * F.atan(t)
    for _ in range(rounds):
        swing = (1 - e * F.sin(latitude)) / (1 + e * F.sin(latitude))
        latitude = math.pi / 2 - 2 * F.atan(t * F.pow(swing, F.lit(e / 2)))
    longitude = F.degrees(F.atan2(east, north) / n) + conic.origin_longitude
    return F.degrees(latitude), longitude

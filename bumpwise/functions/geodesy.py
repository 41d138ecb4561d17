"""Transverse Mercator both ways as column arithmetic (Krueger's series, order 4)."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TransverseMercator:
    """A transverse Mercator grid; the defaults are the Korean central belt on GRS80."""

    # fixed values
    semi_major: float = 6378137.0
    inverse_flattening: float = 298.257222101
    lat_origin: float = 38.0
    lon_origin: float = 127.0
    scale: float = 1.0
    false_easting: float = 200000.0
    false_northing: float = 600000.0
    # order of the last step to latitudes: a round trip from metres is right to 2e-6 m with 4 and
    # to 1e-6 m with 5
    latitude_order: int = 4

    @property
    def n(self) -> float:
        """Third flattening."""
        f = 1 / self.inverse_flattening
        return f / (2 - f)

    @property
    def eccentricity(self) -> float:
        f = 1 / self.inverse_flattening
        return math.sqrt(f * (2 - f))

    @property
    def radius(self) -> float:
        """Scaled radius of the rectifying sphere."""
        n = self.n
        return self.scale * self.semi_major / (1 + n) * (1 + n**2 / 4 + n**4 / 64)

    @property
    def alpha(self) -> tuple[float, ...]:
        """Conformal to rectifying latitude."""
        n = self.n
        # fixed values: series coefficients
        return (
            n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180,
            13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
            61 * n**3 / 240 - 103 * n**4 / 140,
            49561 * n**4 / 161280,
        )

    @property
    def beta(self) -> tuple[float, ...]:
        """Rectifying to conformal, on the complex plane."""
        n = self.n
        # fixed values: series coefficients
        return (
            n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360,
            n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440,
            17 * n**3 / 480 - 37 * n**4 / 840,
            4397 * n**4 / 161280,
        )

    @property
    def delta(self) -> tuple[float, ...]:
        """Conformal to geodetic latitude."""
        n = self.n
        # fixed values: series coefficients
        order_4 = (
            2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45,
            7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45,
            56 * n**3 / 15 - 136 * n**4 / 35,
            4279 * n**4 / 630,
        )
        if self.latitude_order < 5:
            return order_4
        fifth = (26 / 45, 2704 / 315, -1262 / 105, -332 / 35, 4174 / 315)
        return tuple(low + c * n**5 for low, c in zip((*order_4, 0.0), fifth, strict=True))

    @property
    def origin_arc(self) -> float:
        """Rectifying latitude of the origin parallel, in radians."""
        e = self.eccentricity
        phi = math.radians(self.lat_origin)
        conformal = math.atan(
            math.sinh(math.asinh(math.tan(phi)) - e * math.atanh(e * math.sin(phi)))
        )
        series = sum(a * math.sin(2 * j * conformal) for j, a in enumerate(self.alpha, 1))
        return conformal + series

    def to_lon_lat(self, x: Column, y: Column) -> tuple[Column, Column]:
        """Grid metres to degrees."""
        xi = (y - self.false_northing) / self.radius + self.origin_arc
        eta = (x - self.false_easting) / self.radius
        xi_sphere, eta_sphere = xi, eta
        for j, b in enumerate(self.beta, 1):
            angle, stretch = xi * float(2 * j), eta * float(2 * j)
            xi_sphere = xi_sphere - F.lit(b) * F.sin(angle) * F.cosh(stretch)
            eta_sphere = eta_sphere - F.lit(b) * F.cos(angle) * F.sinh(stretch)
        conformal = F.asin(F.sin(xi_sphere) / F.cosh(eta_sphere))
        lat = conformal
        for j, d in enumerate(self.delta, 1):
            lat = lat + F.lit(d) * F.sin(conformal * float(2 * j))
        lon = F.atan2(F.sinh(eta_sphere), F.cos(xi_sphere))
        return F.degrees(lon) + self.lon_origin, F.degrees(lat)

    def to_grid(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        """Degrees to grid metres; NULL for what is no place on the globe or too far from the grid.

        The series holds within some 30 degrees of the central meridian; beyond a right angle from
        it a place has no image at all.
        """
        return self.from_sphere(*self.to_sphere(lon, lat))

    def to_sphere(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        """The first step of `to_grid`: where a place lies on the conformal sphere.

        `from_sphere` reads both numbers many times. Where Spark does not share equal parts of an
        expression, as within the function of a `transform`, they should be made first.
        """
        e = self.eccentricity
        phi, away = F.radians(lat), F.radians(lon - self.lon_origin)
        on_globe = (F.abs(lat) < 90) & (F.abs(lon) <= 360) & (F.cos(away) > 0)
        tangent = F.sinh(F.asinh(F.tan(phi)) - F.lit(e) * F.atanh(F.lit(e) * F.sin(phi)))
        xi_sphere = F.atan2(tangent, F.cos(away))
        eta_sphere = F.asinh(F.sin(away) / F.hypot(tangent, F.cos(away)))
        return F.when(on_globe, xi_sphere), F.when(on_globe, eta_sphere)

    def from_sphere(self, xi_sphere: Column, eta_sphere: Column) -> tuple[Column, Column]:
        """The second step of `to_grid`: to metres; NULL stays NULL."""
        xi, eta = xi_sphere, eta_sphere
        for j, a in enumerate(self.alpha, 1):
            angle, stretch = xi_sphere * float(2 * j), eta_sphere * float(2 * j)
            xi = xi + F.lit(a) * F.sin(angle) * F.cosh(stretch)
            eta = eta + F.lit(a) * F.cos(angle) * F.sinh(stretch)
        x = eta * self.radius + self.false_easting
        y = (xi - self.origin_arc) * self.radius + self.false_northing
        return x, y

"""Tile lattices, zones and projections as column expressions."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Sphere of the sinusoidal lattice, and the edges of its scenes (published constants).
SPHERE = 6371007.181
SCENE_WEST, SCENE_NORTH = -20015109.354, 10007554.677
SCENE_SIZE = -SCENE_WEST / 18


@dataclass(frozen=True)
class Grid:
    """A lattice of square tiles: pixel size, pixels per edge, anchor. Rows count north."""

    res: float
    tile_px: int
    ox: float = 0.0
    oy: float = 0.0

    @property
    def size(self) -> float:
        return self.res * self.tile_px

    def tile_of_point(self, x: Column, y: Column) -> tuple[Column, Column]:
        return F.floor((x - self.ox) / self.size).cast("long"), F.floor((y - self.oy) / self.size).cast("long")

    def bounds(self, tx: Column, ty: Column) -> list[Column]:
        """west, south, east, north."""
        return [tx * self.size + self.ox, ty * self.size + self.oy, (tx + 1) * self.size + self.ox, (ty + 1) * self.size + self.oy]

    def span(self, low: Column, high: Column, anchor: float) -> tuple[Column, Column]:
        """First and last index that half-open bounds touch."""
        return F.floor((low - anchor) / self.size).cast("long"), (F.ceil((high - anchor) / self.size) - 1).cast("long")

    def tiles(self, df, w: Column, s: Column, e: Column, n: Column):
        """A row for each tile that bounds touch; none where they are empty."""
        (x0, x1), (y0, y1) = self.span(w, e, self.ox), self.span(s, n, self.oy)
        df = df.withColumns({"_x0": x0, "_x1": x1, "_y0": y0, "_y1": y1}).where("_x1 >= _x0 and _y1 >= _y0")
        return df.withColumn("ty", F.explode(F.sequence("_y0", "_y1"))).withColumn("tx", F.explode(F.sequence("_x0", "_x1"))).drop("_x0", "_x1", "_y0", "_y1")

    def aligned_with(self, anchor: Column) -> Column:
        """Whether an origin lies on a corner, within a millionth of a tile."""
        k = anchor / self.size
        return F.abs(k - F.round(k)) <= 1e-6


def utm_zone(lon: Column) -> Column:
    return F.floor((lon + 180) / 6).cast("long") + 1


def mgrs_epsg(lon: Column, lat: Column) -> Column:
    """EPSG code of the MGRS zone, with the widened zones of south-west Norway and Svalbard."""
    wrapped = F.pmod(lon + 180, F.lit(360.0)) - 180
    zone = F.when((lat >= 56) & (lat < 64) & (wrapped >= 3) & (wrapped < 12), 32)
    for low, high, z in ((0, 9, 31), (9, 21, 33), (21, 33, 35), (33, 42, 37)):
        zone = zone.when((lat >= 72) & (lat < 84) & (wrapped >= low) & (wrapped < high), z)
    return (zone.otherwise(utm_zone(wrapped)) + F.when(lat < 0, 32700).otherwise(32600)).cast("long")


def lon_overlap(w: Column, e: Column, aw, ae) -> Column:
    """Whether two longitude spans overlap, strictly; either may cross the antimeridian (west > east)."""
    return F.when(w <= e, (w < ae) & (e > aw)).otherwise((w < ae) | (e > aw))


def sinusoidal(lon: Column, lat: Column) -> tuple[Column, Column]:
    phi = lat * (math.pi / 180)
    return lon * (math.pi / 180) * SPHERE * F.cos(phi), phi * SPHERE


def sinusoidal_inverse(x: Column, y: Column) -> tuple[Column, Column]:
    lat = y / SPHERE
    return x / (F.cos(lat) * SPHERE) * (180 / math.pi), lat * (180 / math.pi)


# Krueger's series on the WGS84 ellipsoid.
_A, _F = 6378137.0, 1 / 298.257223563
_N = _F / (2 - _F)
_RECT = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_E = 2 * math.sqrt(_N) / (1 + _N)


def utm(lon: Column, lat: Column, zone: Column) -> tuple[Column, Column]:
    """Easting and northing in a zone; southern latitudes have the false northing."""
    phi, dl = lat * (math.pi / 180), (lon - (zone * 6 - 183)) * (math.pi / 180)
    atanh = lambda c: F.log((1 + c) / (1 - c)) / 2
    t = F.sinh(atanh(F.sin(phi)) - _E * atanh(_E * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(dl)), atanh(F.sin(dl) / F.sqrt(1 + t * t))
    e, n = eta, xi
    for j, a in enumerate(_ALPHA, 1):
        e = e + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        n = n + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    k = 0.9996 * _RECT
    return 500000 + k * e, k * n + F.when(lat < 0, 10000000.0).otherwise(0.0)


def with_utm(df, lon: str, lat: str, zone: Column, x: str, y: str, south: Column):
    """df with easting x and northing y in each row's zone and hemisphere, in steps that each have a column: one expression of them all is too long to compile."""
    phi, dl = F.col(lat) * (math.pi / 180), (F.col(lon) - (zone * 6 - 183)) * (math.pi / 180)
    atanh = lambda c: F.log((1 + c) / (1 - c)) / 2
    df = df.withColumns({"_phi": phi, "_dl": dl, "_off": F.when(south, 10000000.0).otherwise(0.0)})
    df = df.withColumn("_t", F.sinh(atanh(F.sin("_phi")) - _E * atanh(_E * F.sin("_phi"))))
    df = df.withColumns({"_xi": F.atan2(F.col("_t"), F.cos("_dl")), "_eta": atanh(F.sin("_dl") / F.sqrt(1 + F.col("_t") * F.col("_t")))})
    e, n = F.col("_eta"), F.col("_xi")
    for j, a in enumerate(_ALPHA, 1):
        e = e + a * F.cos(2 * j * F.col("_xi")) * F.sinh(2 * j * F.col("_eta"))
        n = n + a * F.sin(2 * j * F.col("_xi")) * F.cosh(2 * j * F.col("_eta"))
    k = 0.9996 * _RECT
    return df.withColumns({x: 500000 + k * e, y: k * n + F.col("_off")}).drop("_phi", "_dl", "_off", "_t", "_xi", "_eta")

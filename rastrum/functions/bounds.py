"""WGS84 bounds of projected tiles: the outline followed in steps, across the antimeridian too."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import grid as G

STEPS = 8
_BETA = (G._N / 2 - 2 * G._N**2 / 3 + 37 * G._N**3 / 96, G._N**2 / 48 + G._N**3 / 15, 17 * G._N**3 / 480)
_DELTA = (2 * G._N - 2 * G._N**2 / 3 - 2 * G._N**3, 7 * G._N**2 / 3 - 8 * G._N**3 / 5, 56 * G._N**3 / 15)


def utm_inverse(x, y, zone, south):
    """Longitude and latitude of UTM points (Krueger's series)."""
    k = 0.9996 * G._RECT
    eta, xi = (x - 500000) / k, (y - 10000000 * south) / k
    e, n = eta, xi
    for j, b in enumerate(_BETA, 1):
        n = n - b * np.sin(2 * j * xi) * np.cosh(2 * j * eta)
        e = e - b * np.cos(2 * j * xi) * np.sinh(2 * j * eta)
    chi = np.arcsin(np.sin(n) / np.cosh(e))
    lat = chi + sum(d * np.sin(2 * j * chi) for j, d in enumerate(_DELTA, 1))
    return zone * 6 - 183 + np.degrees(np.arctan2(np.sinh(e), np.cos(n))), np.degrees(lat)


def sinusoidal_inverse(x, y):
    """Points beyond the sphere's outline have no place: NaN."""
    lat = y / G.SPHERE
    lon = np.where(np.abs(lat) <= math.pi / 2, x / np.maximum(np.cos(lat), 1e-12) / G.SPHERE, np.nan)
    ok = np.abs(lon) <= math.pi + 1e-9
    return np.where(ok, np.degrees(lon), np.nan), np.where(ok, np.degrees(lat), np.nan)


def outline(w, s, e, n):
    """Points along the edges of rectangles, STEPS to an edge: arrays of one row per rectangle."""
    x, y = (np.stack(np.broadcast_arrays(*(np.asarray(v, float) for v in side)), -1) for side in ((w, e, e, w), (s, s, n, n)))
    share = np.arange(STEPS) / STEPS
    between = lambda v: (v[..., None] * (1 - share) + np.roll(v, -1, -1)[..., None] * share).reshape(*v.shape[:-1], -1)
    return between(x), between(y)


def bounds_of(lon: np.ndarray, lat: np.ndarray) -> np.ndarray:
    """west, south, east, north of outlines; west > east where one crosses the antimeridian, NaN where a point has no place. An outline is walked point by point the short way round; one that comes back a turn further on goes round a pole, which it then holds."""
    turns = -np.round((np.roll(lon, -1, 1) - lon) / 360)
    before = np.concatenate([np.zeros((len(lon), 1)), np.cumsum(turns, 1)], 1)
    path = lon + 360 * before[:, :-1]
    low, high = path.min(1), path.max(1)
    round_pole = (before[:, -1] != 0) | (high - low >= 360)
    north = lat.mean(1) > 0
    home = lambda v: np.where(np.abs(v) <= 180, v, (v + 180) % 360 - 180)
    west, east = np.where(round_pole, -180.0, home(low)), np.where(round_pole, 180.0, home(high))
    south = np.where((before[:, -1] != 0) & ~north, -90.0, lat.min(1))
    top = np.where((before[:, -1] != 0) & north, 90.0, lat.max(1))
    out = np.stack([west, south, east, top], 1)
    out[np.isnan(lon).any(1) | np.isnan(lat).any(1)] = np.nan
    return out


def wgs84_bounds(tiles: DataFrame) -> DataFrame:
    """tiles (crs, west, south, east, north in its units) with lon_w, lat_s, lon_e, lat_n. crs: EPSG:326zz, 327zz, 4326 or `sinusoidal`; another has null bounds."""
    schema = f"{', '.join(f'{n} {k}' for n, k in tiles.dtypes)}, lon_w double, lat_s double, lon_e double, lat_n double"

    def run(batches):
        for batch in batches:
            crs = np.array(batch.column(batch.schema.get_field_index("crs")).to_pylist(), object)
            w, s, e, n = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("west", "south", "east", "north"))
            out = np.full((len(crs), 4), np.nan)
            known = np.zeros(len(crs), bool)
            for c in set(crs) - {None}:
                at = np.flatnonzero(crs == c)
                x, y = outline(w[at], s[at], e[at], n[at])
                if c == "EPSG:4326":
                    out[at] = np.stack([w[at], s[at], e[at], n[at]], 1)
                elif c == "sinusoidal":
                    out[at] = bounds_of(*sinusoidal_inverse(x, y))
                elif len(c) == 10 and c[:8] in ("EPSG:326", "EPSG:327") and c[8:].isdigit() and 1 <= int(c[8:]) <= 60:
                    out[at] = bounds_of(*utm_inverse(x, y, int(c[8:]), c[7] == "7"))
                else:
                    continue
                known[at] = True
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(out[:, k], mask=~known) for k in range(4))], names=[*batch.schema.names, "lon_w", "lat_s", "lon_e", "lat_n"])

    return tiles.mapInArrow(run, schema)

"""Tiles composed of sources that each own part of the ground: every pixel comes from the cell of whole degrees that its centre lies in."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastrum.functions.bounds import utm_inverse
from rastrum.functions.grid import Grid

COMPOSED = "x long, y long, px array<double>, cells array<string>"


def owners(grid: Grid, zone: int, south: bool, x: int, y: int) -> tuple[np.ndarray, np.ndarray]:
    """(longitude, latitude) of the cell that owns each pixel of a tile, row by row from the north."""
    px = grid.tile_px
    centre = (np.arange(px) + 0.5) * grid.res
    west, north = x * grid.size + grid.ox, (y + 1) * grid.size + grid.oy
    lon, lat = utm_inverse(np.broadcast_to(west + centre, (px, px)), np.broadcast_to((north - centre)[:, None], (px, px)), zone, south)
    return np.floor(lon).astype(np.int64), np.floor(lat).astype(np.int64)


def cell_name(lon: int, lat: int) -> str:
    return f"{'N' if lat >= 0 else 'S'}{abs(lat):02}{'E' if lon >= 0 else 'W'}{abs(lon):03}"


def owning_cells(tiles: DataFrame, grid: Grid, zone: int, south: bool = False) -> DataFrame:
    """Tiles (x, y) with each cell (cell_lon, cell_lat) that owns a pixel of theirs."""

    def run(batches):
        for b in batches:
            out = [[], [], [], []]
            for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                lon, lat = owners(grid, zone, south, x, y)
                for cell in np.unique(np.stack([lon.ravel(), lat.ravel()], 1), axis=0).tolist():
                    for c, v in zip(out, (x, y, *cell)):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["x", "y", "cell_lon", "cell_lat"])

    return tiles.select("x", "y").distinct().mapInArrow(run, "x long, y long, cell_lon long, cell_lat long")


def composed(tiles: DataFrame, sources: DataFrame, grid: Grid, zone: int, south: bool = False) -> DataFrame:
    """COMPOSED: for each tile its pixels (NaN where the owning cell has no value, or there is no such cell) and the names of the cells that gave one. sources (cell_lon, cell_lat, x, y, px array<double>): what each cell's file holds of a tile, on the tiles' own lattice. A cell is read for a tile once, and no pixel is a row."""
    wanted = owning_cells(tiles, grid, zone, south)
    met = wanted.join(sources, ["cell_lon", "cell_lat", "x", "y"], "left").select("x", "y", "cell_lon", "cell_lat", "px")
    edge = grid.tile_px

    def run(key, t):
        x, y = (k.as_py() for k in key)
        lon, lat = owners(grid, zone, south, x, y)
        out, used = np.full((edge, edge), np.nan), []
        for cell_lon, cell_lat, px in zip(*(t.column(c).to_pylist() for c in ("cell_lon", "cell_lat", "px"))):
            if px is None:
                continue
            if len(px) != edge * edge:
                raise ValueError(f"{cell_name(cell_lon, cell_lat)}: {len(px)} pixels for a tile of {edge} x {edge}")
            own = (lon == cell_lon) & (lat == cell_lat)
            out[own] = np.array(px, float).reshape(edge, edge)[own]
            if np.isfinite(out[own]).any():
                used.append(cell_name(cell_lon, cell_lat))
        return pa.table({"x": [x], "y": [y], "px": pa.array([out.ravel()], pa.list_(pa.float64())), "cells": pa.array([sorted(set(used))], pa.list_(pa.string()))})

    return met.groupBy("x", "y").applyInArrow(run, COMPOSED)

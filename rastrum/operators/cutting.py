"""Scenes cut into the tiles of a lattice, block by block: a scene is never one row."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastrum.functions.grid import Grid

_PIECES = "scene string, x long, y long, row int, col int, high int, wide int, px array<int>"


def pieces(blocks: DataFrame, grid: Grid) -> DataFrame:
    """What each block (scene, west, north in the lattice's unit, high, wide, px array<int> row by row from the north) holds of each tile: its place in the tile, and its pixels. A block off the lattice's pixels, by more than a hundredth of one, is an error."""
    n = grid.tile_px

    def run(batches):
        for b in batches:
            out = [[] for _ in range(8)]
            for r in b.to_pylist():
                c0, r0 = (r["west"] - grid.ox) / grid.res, (grid.oy - r["north"]) / grid.res
                if abs(c0 - round(c0)) > 0.01 or abs(r0 - round(r0)) > 0.01:
                    raise ValueError(f"{r['scene']}: a block off the lattice's pixels")
                # Pixels counted east of the anchor and down from it; tiles above it have negative ones.
                c0, r0, high, wide = round(c0), round(r0), r["high"], r["wide"]
                a = np.array(r["px"], np.int32).reshape(high, wide)
                for ty in range(r0 // n, (r0 + high - 1) // n + 1):
                    for tx in range(c0 // n, (c0 + wide - 1) // n + 1):
                        top, left = max(r0, ty * n), max(c0, tx * n)
                        part = a[top - r0 : (ty + 1) * n - r0, left - c0 : (tx + 1) * n - c0]
                        for c, v in zip(out, (r["scene"], tx, -ty - 1, top - ty * n, left - tx * n, *part.shape, part.ravel())):
                            c.append(v)
            kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=[f.split()[0] for f in _PIECES.split(", ")])

    return blocks.select("scene", "west", "north", "high", "wide", "px").mapInArrow(run, _PIECES)


def cut(blocks: DataFrame, grid: Grid, nodata: int) -> DataFrame:
    """(scene, x, y, px array<int>, valid_px): tiles of scenes, nodata beyond them; tiles that hold no observation are left out. Where blocks lap over each other, an observed pixel counts before nodata, then that of the northern, western block."""
    n = grid.tile_px

    def run(key, t):
        out = np.full((n, n), nodata, np.int32)
        parts = sorted(t.select(["row", "col", "high", "wide", "px"]).to_pylist(), key=lambda p: (p["row"], p["col"]))
        for p in parts:
            own = out[p["row"] : p["row"] + p["high"], p["col"] : p["col"] + p["wide"]]
            px = np.array(p["px"], np.int32).reshape(p["high"], p["wide"])
            own[own == nodata] = px[own == nodata]
        seen = int((out != nodata).sum())
        rows = [0] * (seen > 0)
        return pa.table({"scene": pa.array([key[0].as_py() for _ in rows], pa.string()), "x": pa.array([key[1].as_py() for _ in rows], pa.int64()), "y": pa.array([key[2].as_py() for _ in rows], pa.int64()), "px": pa.array([out.ravel() for _ in rows], pa.list_(pa.int32())), "valid_px": pa.array([seen for _ in rows], pa.int32())})

    return pieces(blocks, grid).groupBy("scene", "x", "y").applyInArrow(run, "scene string, x long, y long, px array<int>, valid_px int")


def plan(scenes: DataFrame, grid: Grid, held: DataFrame, area: DataFrame | None = None, zone: bool = True) -> DataFrame:
    """(scene, crs, band, date, x, y) to fetch: tiles that a scene's extent (west, south, east, north in the lattice's unit) reaches by more than a hundredth of a pixel, of the ground that is its zone's (zone: see zones.canonical), inside the area (tx, ty) if there is one, and not held already: complete, or with this scene in it (held: as held_scenes() gives it)."""
    from rastrum.functions.bounds import wgs84_bounds
    from rastrum.functions.zones import canonical
    from rastrum.operators.tiles import to_fetch

    eps = grid.res * 0.01
    reached = grid.tiles(scenes, F.col("west") + eps, F.col("south") + eps, F.col("east") - eps, F.col("north") - eps).select("scene", "crs", "band", "date", F.col("tx").alias("x"), F.col("ty").alias("y"))
    if area is not None:
        reached = reached.join(area.select(F.col("tx").alias("x"), F.col("ty").alias("y")).distinct(), ["x", "y"], "left_semi")
    if zone:
        w, s, e, n = grid.bounds(F.col("x"), F.col("y"))
        grounds = reached.select("crs", "x", "y").distinct().select("crs", "x", "y", w.alias("west"), s.alias("south"), e.alias("east"), n.alias("north"))
        reached = reached.join(canonical(wgs84_bounds(grounds)).select("crs", "x", "y"), ["crs", "x", "y"], "left_semi")
    return to_fetch(reached.select("scene", "crs", "band", "date", "x", "y"), held)

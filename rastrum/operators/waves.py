"""Two waves of an ingest: masks come first, then the bands of tiles that the masks let through. A mask has its own lattice, coarser than its bands'."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rastrum.functions.grid import Grid
from rastrum.operators.blobs import observed

#: Classes of a scene map that count as cloud, and the one without data (fixed values of the product).
CLOUDY, NO_DATA = (1, 3, 8, 9, 10), 0


def rebuilt(stored: DataFrame, scenes: str | tuple[str, ...], nodata: int = NO_DATA) -> DataFrame:
    """(x, y, px) of the stored masks (x, y, scene_id, px array<int>) that hold a scene, or one of several; one that several rows still share comes back merged, the fullest part first (ties: by scenes)."""
    asked = {scenes} if isinstance(scenes, str) else set(scenes)

    def run(key, t):
        rows = t.select(["scene_id", "px"]).to_pylist()
        if not any(asked.intersection((r["scene_id"] or "").split("|")) for r in rows):
            return pa.table({"x": pa.array([], pa.int64()), "y": pa.array([], pa.int64()), "px": pa.array([], pa.list_(pa.int32()))})
        parts = sorted(((np.array(r["px"], np.int32), r["scene_id"] or "") for r in rows), key=lambda p: (-int(observed(p[0], nodata).sum()), p[1]))
        out = parts[0][0].copy()
        for px, _ in parts[1:]:
            take = ~observed(out, nodata) & observed(px, nodata)
            out[take] = px[take]
        return pa.table({"x": [key[0].as_py()], "y": [key[1].as_py()], "px": pa.array([out], pa.list_(pa.int32()))})

    return stored.groupBy("x", "y").applyInArrow(run, "x long, y long, px array<int>")


def fresh_first(fresh: DataFrame, stored: DataFrame) -> DataFrame:
    """Masks (x, y, px): those just read, and stored ones where none was."""
    return fresh.select("x", "y", "px").unionByName(stored.select("x", "y", "px").join(fresh.select("x", "y"), ["x", "y"], "left_anti"))


def mask_tiles(tiles: DataFrame, band: Grid, mask: Grid) -> DataFrame:
    """Tiles (x, y) of a band with each tile (mx, my) of the mask's lattice that their ground touches."""
    w, s, e, n = band.bounds(F.col("x"), F.col("y"))
    (x0, x1), (y0, y1) = mask.span(w, e, mask.ox), mask.span(s, n, mask.oy)
    return tiles.withColumn("mx", F.explode(F.sequence(x0, x1))).withColumn("my", F.explode(F.sequence(y0, y1)))


def judged(tiles: DataFrame, masks: DataFrame, band: Grid, mask: Grid) -> DataFrame:
    """(x, y, n_valid, cloud_pct) of each band tile: its pixels' classes are those of the mask pixels that hold their centres, stitched over mask tiles; cloud_pct to two places, null where no class is known, as on ground without a mask."""
    met = mask_tiles(tiles.select("x", "y").distinct(), band, mask).join(masks.select(F.col("x").alias("mx"), F.col("y").alias("my"), "px"), ["mx", "my"], "left").select("x", "y", "mx", "my", "px")
    edge, coarse = band.tile_px, mask.tile_px

    def run(key, t):
        x, y = (k.as_py() for k in key)
        # Global pixel of the mask under each band pixel's centre, counted east and north.
        along = lambda at, o, mo: np.floor((at * band.size + o + (np.arange(edge) + 0.5) * band.res - mo) / mask.res).astype(np.int64)
        gx, gy = along(x, band.ox, mask.ox), along(y, band.oy, mask.oy)[::-1]
        cls = np.full((edge, edge), NO_DATA, np.int32)
        for mx, my, px in zip(*(t.column(c).to_pylist() for c in ("mx", "my", "px"))):
            if px is None:
                continue
            a = np.array(px, np.int32).reshape(coarse, coarse)
            r, c = np.flatnonzero(gy // coarse == my), np.flatnonzero(gx // coarse == mx)
            cls[np.ix_(r, c)] = a[np.ix_(coarse - 1 - gy[r] % coarse, gx[c] % coarse)]
        valid = cls != NO_DATA
        n = int(valid.sum())
        bad = int((np.isin(cls, CLOUDY) & valid).sum())
        return pa.table({"x": [x], "y": [y], "n_valid": pa.array([n], pa.int64()), "cloud_pct": pa.array([round(bad / n * 100.0, 2) if n else None], pa.float64())})

    return met.groupBy("x", "y").applyInArrow(run, "x long, y long, n_valid long, cloud_pct double")


def second_wave(planned: DataFrame, judged_tiles: DataFrame, most: float) -> DataFrame:
    """Planned band tiles (x, y, ...) to fetch after the masks: those seen at all and cloudy to `most` percent at the most."""
    return planned.join(judged_tiles.where(F.col("cloud_pct") <= most).select("x", "y"), ["x", "y"], "left_semi")


def wave_of(band: Column, masks: tuple[str, ...]) -> Column:
    """1 for mask bands, which the others wait for, else 2."""
    return F.when(band.isin(*masks), 1).otherwise(2)

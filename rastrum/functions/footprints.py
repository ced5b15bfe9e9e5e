"""Extents of rasters, scenes and requests on a lattice, as column expressions and small frames."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bounds import utm_inverse
from .grid import Grid, utm_zone, with_utm

#: Degrees between the points at which an edge of a box is projected.
EDGE_STEP = 0.02


def tile_transform(grid: Grid, tx: Column, ty: Column) -> Column:
    """Affine coefficients of a tile: pixel width, 0, west, 0, minus pixel height, north."""
    west, _, _, north = grid.bounds(tx, ty)
    values = dict(a=F.lit(grid.res), b=F.lit(0.0), c=west.cast("double"), d=F.lit(0.0), e=F.lit(-grid.res), f=north.cast("double"))
    return F.struct(*(v.alias(k) for k, v in values.items()))


def anchor(origin: Column, size: float) -> Column:
    """What is left of a raster's origin beside the nearest multiple of the tile size."""
    return origin - size * F.floor(origin / size + 0.5)


def owned_window(west: Column, north: Column, res: float, box: tuple[Column, Column, Column, Column]) -> list[Column]:
    """(west, north, columns, rows) of the part of a raster that its nominal cell owns, on the raster's own pixels."""
    w, s, e, n = box
    return [west + F.rint((w - west) / res) * res, north - F.rint((north - n) / res) * res, F.rint((e - w) / res).cast("long"), F.rint((n - s) / res).cast("long")]


def inside_owned(tile: list[Column], w: Column, s: Column, e: Column, n: Column, res: float) -> Column:
    """Whether a tile shares more than a hundredth of a pixel with an extent."""
    tw, ts, te, tn = tile
    eps = res * 0.01
    return (te > w + eps) & (tw < e - eps) & (tn > s + eps) & (ts < n - eps)


def scene_extent(transform: Column, rows: Column, columns: Column) -> list[Column]:
    """west, south, east, north from the coefficients (an array of six) and shape; null if rotated or unknown."""
    t = lambda i: F.get(transform, i)
    straight = (t(1) == 0) & (t(3) == 0)
    x, y = (t(2), t(2) + t(0) * columns), (t(5), t(5) + t(4) * rows)
    return [F.when(straight, v) for v in (F.least(*x), F.least(*y), F.greatest(*x), F.greatest(*y))]


def scene_offset(grid: Grid, h: Column, v: Column, tx: Column, ty: Column, west: float, north: float, size: float) -> tuple[Column, Column]:
    """(row, column) of a tile's first pixel in the scene hXXvYY of a lattice of scenes."""
    tile_west, _, _, tile_north = grid.bounds(tx, ty)
    row, col = (north - v * size - tile_north) / grid.res, (tile_west - west - h * size) / grid.res
    return F.rint(row).cast("long"), F.rint(col).cast("long")


def centres(low: Column, res: float, n: int, down: bool = False, places: int = 4) -> Column:
    """Centres of n cells from an edge on, rounded."""
    step = -res if down else res
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.round(low + step / 2 + i * step, places))


def request_area(tiles: DataFrame, grid: Grid, pad_north: int = 0, pad_west: int = 0, by: tuple[str, ...] = ()) -> DataFrame:
    """(n, w, s, e) that whole tiles (tx, ty) cover, on the centres of their cells, some cells wider to the north and west."""
    w, s, e, n = grid.bounds(F.col("tx"), F.col("ty"))
    half = grid.res / 2
    side = dict(n=F.max(n) - half + pad_north * grid.res, w=F.min(w) + half - pad_west * grid.res, s=F.min(s) + half, e=F.max(e) - half)
    return tiles.groupBy(*by).agg(*(F.round(v, 3).alias(k) for k, v in side.items()))


def edge_points(boxes: DataFrame, key: str = "part") -> DataFrame:
    """Points (lon, lat) along the edges of boxes (west, south, east, north in degrees), EDGE_STEP apart; of small boxes the corners."""
    span = F.greatest(F.abs(F.col("east") - F.col("west")), F.abs(F.col("north") - F.col("south")))
    steps = F.greatest(F.lit(1), F.ceil(span / EDGE_STEP).cast("int"))
    at = boxes.withColumn("_n", steps).withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_n")))).withColumn("_t", F.col("_i") / F.col("_n"))
    lon, lat = F.col("west") + (F.col("east") - F.col("west")) * F.col("_t"), F.col("south") + (F.col("north") - F.col("south")) * F.col("_t")
    sides = F.array(*(F.struct(x.alias("lon"), y.alias("lat")) for x, y in ((lon, F.col("south")), (lon, F.col("north")), (F.col("west"), lat), (F.col("east"), lat))))
    return at.select(key, F.explode(sides).alias("p")).select(key, "p.lon", "p.lat").distinct()


def projected_boxes(boxes: DataFrame, project, key: str = "part") -> DataFrame:
    """The rectangle (west, south, east, north) around each box's edges in another projection; places it can't hold are left out, and boxes without any place. project: (lon, lat) columns to (x, y)."""
    x, y = project(F.col("lon"), F.col("lat"))
    points = edge_points(boxes, key).select(key, x.alias("x"), y.alias("y"))
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < float("inf"))
    return points.where(finite("x") & finite("y")).groupBy(key).agg(F.min("x").alias("west"), F.min("y").alias("south"), F.max("x").alias("east"), F.max("y").alias("north"))


def candidate_tiles(grid: Grid, boxes: DataFrame, project, key: str = "part") -> DataFrame:
    """Tiles (tx, ty) that the projected box of any part touches, each once."""
    found = projected_boxes(boxes, project, key)
    return grid.tiles(found, *(F.col(c) for c in ("west", "south", "east", "north"))).select("tx", "ty").distinct()


def point_buffers(points: DataFrame, metres: float) -> DataFrame:
    """points (lon, lat, and other columns) with `parts`: the square that reaches so many metres from each to every side, made in the point's UTM zone and moved back to degrees, as one ring of its four corners. A point without a place, or beyond the zones' 84 degrees, has no square (null)."""
    names = points.columns
    zone = F.when((F.abs("lat") <= 84) & F.col("lon").isNotNull(), utm_zone(F.pmod(F.col("lon") + 180, F.lit(360.0)) - 180))
    at = with_utm(points.withColumn("_zone", zone), "lon", "lat", F.col("_zone"), "_x", "_y", F.col("lat") < 0).withColumn("_south", F.col("lat") < 0)

    def run(batches):
        for batch in batches:
            x, y, z = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(float) for c in ("_x", "_y", "_zone"))
            south = np.array([bool(v) for v in batch.column(batch.schema.get_field_index("_south")).to_pylist()])
            corners = np.stack([np.stack(utm_inverse(x + dx * metres, y + dy * metres, z, south), 1) for dx, dy in ((-1, -1), (1, -1), (1, 1), (-1, 1))], 1)
            parts = [None if np.isnan(c).any() else [[c.tolist()]] for c in corners]
            kind = pa.list_(pa.list_(pa.list_(pa.list_(pa.float64()))))
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in names), pa.array(parts, kind)], names=[*names, "parts"])

    kinds = dict(points.dtypes)
    return at.mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in names) + ", parts array<array<array<array<double>>>>")


def request_lattice(boxes: DataFrame, step_x: float, step_y: float, least: int = 32, most: int = 512, key: str = "part") -> DataFrame:
    """Points (key, lon, lat) that sample boxes: cells of about a step, least to most of them on each axis."""
    count = lambda low, high, step: F.least(F.greatest(F.ceil((F.col(high) - F.col(low)) / step), F.lit(least)), F.lit(most)).cast("int")
    sized = boxes.withColumns({"_nx": count("west", "east", step_x), "_ny": count("south", "north", step_y)})
    grid = sized.withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_nx") - 1))).withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_ny") - 1)))
    place = lambda low, high, i, n: F.col(low) + (F.col(i) + 0.5) / F.col(n) * (F.col(high) - F.col(low))
    return grid.select(key, place("west", "east", "_i", "_nx").alias("lon"), place("south", "north", "_j", "_ny").alias("lat"))


def ring_touches(ring: list[tuple[float, float]], w: Column, s: Column, e: Column, n: Column) -> Column:
    """Whether a polygon (one ring) and a box share a point: an edge of the ring crosses the box, or one holds the other. Boxes across the antimeridian (w > e) count as two; boxes that are not finite touch nothing."""

    def box(w: Column, e: Column) -> Column:
        hit = F.lit(False)
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            # The edge clipped to the box: the share of it within each pair of sides.
            low, high = F.lit(0.0), F.lit(1.0)
            for d, a, lo, hi in ((x2 - x1, x1, w, e), (y2 - y1, y1, s, n)):
                if d:
                    p, q = (lo - a) / d, (hi - a) / d
                    low, high = F.greatest(low, F.least(p, q)), F.least(high, F.greatest(p, q))
                else:
                    low = F.when((lo <= a) & (hi >= a), low).otherwise(2.0)
            hit = hit | (low <= high)
        return hit | in_ring(ring, w, s)

    finite = F.lit(True)
    for c in (w, s, e, n):
        finite = finite & c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return finite & F.when(w <= e, box(w, e)).otherwise(box(w, F.lit(180.0)) | box(F.lit(-180.0), e))


def in_ring(ring: list[tuple[float, float]], x: Column, y: Column) -> Column:
    """Whether a point lies in a ring: an odd number of edges to its east."""
    odd = F.lit(0)
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if y1 != y2:
            odd = odd + ((F.lit(min(y1, y2)) <= y) & (y < max(y1, y2)) & (x < (y - y1) * ((x2 - x1) / (y2 - y1)) + x1)).cast("int")
    return odd % 2 == 1

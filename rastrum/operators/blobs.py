"""Reads and merges of stored tiles: arrays per tile in Arrow groups, a pixel is never a row."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastrum.operators.tiles import checked_matches
from rastrum.sources import codec

#: Columns of a stored tile that name it, and those that merging makes anew.
KEY = ["band", "date", "x", "y", "crs", "acq"]
#: Split keys that are sent to all executors at most (some 10 MB).
FEW = 100_000
MADE = ["scene_id", "valid_px", "cloud_pct", "fetched_at", "size_bytes", "data"]


def observed(a: np.ndarray, nodata: float | None) -> np.ndarray:
    """Places with a look: all without nodata, those that are numbers where nodata is NaN, else those that aren't nodata (a NaN is a look then)."""
    if nodata is None:
        return np.ones(a.shape, bool)
    return ~np.isnan(a) if np.isnan(nodata) else a != a.dtype.type(nodata)


def filled(arrays: list[np.ndarray], nodata: float | None) -> np.ndarray:
    """The first array, with what it lacks from the next ones in turn."""
    out = arrays[0].copy()
    open_ = ~observed(out, nodata)
    for a in arrays[1:]:
        take = open_ & observed(a, nodata)
        out[take] = a[take]
        open_ &= ~take
    return out


def read_tiles(catalog: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Catalog rows with the blob of their one stored tile (an error where there is none, or several)."""
    return checked_matches(catalog, stored.select(*keys, "data"), keys)


def merged_parts(rows: list[dict]) -> dict | None:
    """One row of the parts of a tile: pixels of the fullest part first (ties: the smaller scene), the others fill what is empty. Scenes are joined, the cloud is weighted by the pixels each part gives, the time is the newest. A blob to which nothing was added stays as it is; reference system, scale and offset stay anyway. None for parts of different size or type, or that can't be read."""
    try:
        tiles = [codec.read(r["data"]) for r in rows]
    except codec.TileError:
        return None
    if len({t.kind for t in tiles}) > 1:
        return None
    seen = [observed(t.px, t.nodata) for t in tiles]
    order = sorted(range(len(rows)), key=lambda i: (-int(seen[i].sum()), rows[i]["scene_id"] or ""))
    first = order[0]
    px, known, given = tiles[first].px.copy(), seen[first].copy(), [int(seen[first].sum())]
    for i in order[1:]:
        take = seen[i] & ~known
        px[take] = tiles[i].px[take]
        known |= take
        given.append(int(take.sum()))
    clouds = [(rows[i]["cloud_pct"], n) for i, n in zip(order, given) if rows[i]["cloud_pct"] is not None and n]
    scenes = sorted({s for r in rows for s in (r["scene_id"] or "").split("|") if s})
    data = codec.write(replace(tiles[first], px=px)) if any(given[1:]) else rows[first]["data"]
    return rows[first] | {
        "scene_id": "|".join(scenes) or None, "valid_px": sum(given), "cloud_pct": round(sum(c * n for c, n in clouds) / sum(n for _, n in clouds), 2) if clouds else None,
        "fetched_at": max(r["fetched_at"] for r in rows), "size_bytes": len(data), "data": data,
    }


def merged(rows: DataFrame) -> DataFrame:
    """Stored rows (KEY, MADE and any other columns, which come from the fullest part) with one for each key whose parts come from several scenes of an acquisition, by merged_parts(); parts that don't fit stay as they are. Split keys are found without reading blobs, and only their rows are shuffled; where they are few, which is checked, the others are not even joined by a shuffle."""
    split = rows.where("acq is not null").groupBy(*KEY).agg(F.count("*").alias("_n")).where("_n > 1").select(*(F.col(c).alias(f"_{c}") for c in KEY))
    few = split.limit(FEW + 1).count() <= FEW
    split = F.broadcast(split) if few else split
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in KEY))

    def run(t: pa.Table) -> pa.Table:
        one = merged_parts(t.to_pylist())
        return t if one is None else pa.Table.from_pylist([one], schema=t.schema)

    alone, parts = rows.join(split, same, "left_anti"), rows.join(split, same, "left_semi")
    return alone.unionByName(parts.groupBy(*KEY).applyInArrow(run, rows.schema))


def mosaic(tiles: DataFrame, edge: int, ring: list[tuple[float, float]] | None = None) -> DataFrame:
    """For each place (x, y) the pixels (array of rows, column by column) of its tiles, the cleanest first; in one projection, the first that most tiles have. ring: corners in pixels of the whole raster (column, row), beyond which all is nodata."""
    most = tiles.groupBy("crs").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "crs").limit(1).select("crs")
    one = tiles.join(F.broadcast(most), "crs", "left_semi")

    def run(key, t):
        x, y = (k.as_py() for k in key)
        r = sorted(t.select(["cloud_pct", "date", "acq", "scene_id", "data"]).to_pylist(), key=lambda v: (1e9 if v["cloud_pct"] is None else v["cloud_pct"], v["date"], v["acq"] or "", v["scene_id"] or ""))
        parts = [codec.decode(v["data"]) for v in r]
        nodata = parts[0][1]
        a = filled([p[0] for p in parts], nodata)
        if ring:
            a = np.where(inside(x * edge + np.arange(edge)[None, :] + 0.5, y * edge + np.arange(edge)[:, None] + 0.5, ring), a, a.dtype.type(nodata))
        return pa.table({"x": [x], "y": [y], "px": pa.array([a.astype(np.float64).ravel()])})

    return one.groupBy("x", "y").applyInArrow(run, "x long, y long, px array<double>")


def inside(x: np.ndarray, y: np.ndarray, ring: list[tuple[float, float]]) -> np.ndarray:
    """Even-odd rule for points against a ring."""
    odd = np.zeros(np.broadcast(x, y).shape, bool)
    for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1]):
        if y0 != y1:
            odd ^= ((y0 > y) != (y1 > y)) & (x < (x1 - x0) * (y - y0) / (y1 - y0) + x0)
    return odd


def series(tiles: DataFrame, row: int, col: int) -> DataFrame:
    """Value of one pixel of each tile (null where nothing was observed), to be ordered by date, acquisition and projection."""
    names = [c for c in tiles.columns if c != "data"]

    def run(batches):
        for batch in batches:
            value = []
            for b in batch.column(batch.schema.get_field_index("data")):
                a, nodata, _ = codec.decode(b.as_py())
                value.append(float(a[row, col]) if observed(a[row : row + 1, col : col + 1], nodata).all() else None)
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in names), pa.array(value, pa.float64())], names=[*names, "value"])

    kinds = dict(tiles.dtypes)
    return tiles.mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in names) + ", value double")


def reencoded(rows: DataFrame) -> DataFrame:
    """Rows whose blob is written anew where that makes it smaller; pixels and all that the tile says of itself stay. A blob that can't be read stays as it is."""

    def smaller(blob: bytes) -> bytes:
        try:
            return min(blob, codec.write(codec.read(blob)), key=len)
        except codec.TileError:
            return blob

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("data")
            data = [None if (blob := b.as_py()) is None else smaller(blob) for b in batch.column(at)]
            columns = list(batch.columns)
            columns[at] = pa.array(data, pa.binary())
            if "size_bytes" in batch.schema.names:
                size = batch.schema.get_field_index("size_bytes")
                columns[size] = pa.array([None if b is None else len(b) for b in data], batch.schema.field(size).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return rows.mapInArrow(run, rows.schema)

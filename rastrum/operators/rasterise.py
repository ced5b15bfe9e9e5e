"""Polygons with parts and holes on a lattice of tiles: which pixels they hold, and which they touch.

A polygon is a row with `parts`, an array of parts, each an array of rings, each an
array of points [x, y] in pixels of the lattice (x to the east, y down the rows). A
point is inside where any part holds it, a part by the even-odd rule over its rings,
so rings after the first are holes. The polygon's edges, not the polygon, are dealt
to the rows of tiles that they cross, and a task draws the edges of many
polygons in their rows of tiles at once: a country's outline costs each row of tiles
the edges in it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS = "array<array<array<array<double>>>>"
MASKS = "poly long, x long, y long, centre binary, touched binary"


def geojson_parts(text: Column) -> Column:
    """Parts of a GeoJSON text: a geometry, a Feature, or a FeatureCollection, whose parts together are the polygon. Other geometries than Polygon and MultiPolygon are an error; null stays null."""
    of = lambda t, path: F.get_json_object(t, path)
    kind = of(text, "$.type")
    shapes = F.when(kind == "FeatureCollection", F.transform(F.from_json(of(text, "$.features"), "array<string>"), lambda f: of(f, "$.geometry"))).when(kind == "Feature", F.array(of(text, "$.geometry"))).otherwise(F.array(text))

    def parts(g: Column) -> Column:
        name, at = of(g, "$.type"), of(g, "$.coordinates")
        return F.when(name == "Polygon", F.array(F.from_json(at, "array<array<array<double>>>"))).when(name == "MultiPolygon", F.from_json(at, PARTS)).otherwise(F.raise_error(F.concat(F.lit("not a polygon: "), F.coalesce(name, F.lit("?")))).cast(PARTS))

    return F.when(text.isNotNull(), F.flatten(F.transform(shapes, parts)))


def edges(polygons: DataFrame) -> DataFrame:
    """(poly, part, x0, y0, x1, y1) of each ring's edges, the last point joined to the first."""
    rings = polygons.select("poly", F.posexplode("parts").alias("part", "rings")).select("poly", "part", F.explode("rings").alias("ring"))
    joined = F.arrays_zip(F.col("ring").alias("a"), F.concat(F.slice("ring", 2, F.greatest(F.size("ring") - 1, F.lit(0))), F.slice("ring", 1, 1)).alias("b"))
    p = lambda c, i: F.get(F.col(f"e.{c}"), i)
    out = rings.where(F.size("ring") > 2).select("poly", "part", F.explode(joined).alias("e"))
    return out.select("poly", "part", p("a", 0).alias("x0"), p("a", 1).alias("y0"), p("b", 0).alias("x1"), p("b", 1).alias("y1")).where("x0 <> x1 or y0 <> y1")


def bands(part: np.ndarray, e: np.ndarray, group: np.ndarray, ty: np.ndarray, edge: int):
    """Of the edges (rows x0, y0, x1, y1) of polygons in rows of tiles, dealt to groups 0, 1, ... (sorted) in the rows of tiles ty: for each tile its group and x, and whether its pixels are inside by their centres, and touched (both: tiles x pixels, row by row). All groups at once."""
    x0, y0, x1, y1 = e
    n = len(ty)
    begin = np.searchsorted(group, np.arange(n))
    first = np.floor(np.minimum.reduceat(np.minimum(x0, x1), begin) / edge).astype(np.int64)
    last = np.floor(np.maximum.reduceat(np.maximum(x0, x1), begin) / edge).astype(np.int64)
    tiles = last - first + 1
    wide, at_tile = tiles * edge, np.cumsum(tiles) - tiles
    inside, touched = (np.zeros(int(tiles.sum()) * edge * edge, bool) for _ in range(2))
    # Where a pixel of a group is among the tiles' pixels.
    place = lambda g, row, col: (at_tile[g] + col // edge) * edge * edge + row * edge + col % edge
    x0, x1 = x0 - (first * edge)[group], x1 - (first * edge)[group]
    y0, y1 = y0 - (ty * edge)[group], y1 - (ty * edge)[group]
    low, high = np.minimum(y0, y1), np.maximum(y0, y1)
    steep = np.where(y1 != y0, y1 - y0, 1.0)

    def rows_of(start, stop):
        start, stop = np.clip(start, 0, edge).astype(np.int64), np.clip(stop, 0, edge).astype(np.int64)
        m = np.maximum(stop - start, 0)
        own = np.repeat(np.arange(len(m)), m)
        return own, start[own] + np.arange(len(own)) - np.repeat(np.cumsum(m) - m, m)

    def spread(owner, left, m):
        """Each owner's number m times, and the columns from left on."""
        own = np.repeat(owner, m)
        return own, np.repeat(left, m) + np.arange(len(own)) - np.repeat(np.cumsum(m) - m, m)

    # Centres: where a row's middle crosses an edge, all pixels from there on change sides; so between two crossings of a part in a row.
    own, row = rows_of(np.ceil(low - 0.5), np.ceil(high - 0.5))
    cross = x0[own] + (row + 0.5 - y0[own]) * ((x1 - x0)[own] / steep[own])
    col = np.clip(np.ceil(cross - 0.5), 0, wide[group[own]]).astype(np.int64)
    order = np.lexsort((col, row, part[own], group[own]))
    own, row, col = own[order], row[order], col[order]
    g, p = group[own], part[own]
    new = np.r_[True, (g[1:] != g[:-1]) | (p[1:] != p[:-1]) | (row[1:] != row[:-1])] if len(g) else np.zeros(0, bool)
    turn = np.arange(len(g)) - np.flatnonzero(new)[np.cumsum(new) - 1]
    opens = np.flatnonzero(turn % 2 == 0)
    more = (opens + 1 < len(g)) & ~np.r_[new, True][opens + 1]
    end = np.where(more, col[np.minimum(opens + 1, len(g) - 1)], wide[g[opens]]) if len(opens) else opens
    who, c = spread(opens, col[opens], np.maximum(end - col[opens], 0))
    inside[place(g[who], row[who], c)] = True
    # Edges: in each row of pixels the columns from where an edge comes in to where it goes out.
    own, row = rows_of(np.floor(low), np.floor(high) + 1)
    at = lambda y: x0[own] + (y - y0[own]) * ((x1 - x0)[own] / steep[own])
    flat = (y0 == y1)[own]
    a, b = at(np.maximum(low[own], row)), at(np.minimum(high[own], row + 1.0))
    a, b = np.where(flat, x0[own], a), np.where(flat, x1[own], b)
    g = group[own]
    left, right = (np.clip(np.floor(v), 0, wide[g] - 1).astype(np.int64) for v in (np.minimum(a, b), np.maximum(a, b)))
    who, c = spread(np.arange(len(own)), left, right - left + 1)
    touched[place(g[who], row[who], c)] = True
    owner = np.repeat(np.arange(n), tiles)
    return owner, first[owner] + np.arange(len(owner)) - at_tile[owner], inside.reshape(-1, edge * edge), (inside | touched).reshape(-1, edge * edge)


#: Pixels of the groups that are drawn at once, and edges that a task gathers for that.
PIXELS, EDGES = 1 << 22, 1 << 16


def masks(polygons: DataFrame, edge: int) -> DataFrame:
    """MASKS: for each polygon and tile that it touches, packed bits of the pixels, row by row: those whose centre is inside, and those that it touches at all."""
    found = edges(polygons)
    row = lambda v: F.floor(v / edge).cast("long")
    dealt = found.withColumn("y", F.explode(F.sequence(row(F.least("y0", "y1")), row(F.greatest("y0", "y1")))))

    def drawn(t):
        """Rows of MASKS of whole groups, in slices of PIXELS."""
        poly, y, part = t.column("poly"), t.column("y").to_numpy(), t.column("part").to_numpy()
        name = np.stack([poly.fill_null(0).to_numpy(), poly.is_null().to_numpy(zero_copy_only=False).astype(np.int64), y])
        e = np.stack([t.column(c).to_numpy() for c in ("x0", "y0", "x1", "y1")])
        begin = np.flatnonzero(np.r_[True, (name[:, 1:] != name[:, :-1]).any(0)])
        span = (np.maximum.reduceat(np.maximum(e[0], e[2]), begin) - np.minimum.reduceat(np.minimum(e[0], e[2]), begin) + 2 * edge) * edge
        cuts = np.flatnonzero(np.diff(np.cumsum(span) // PIXELS, prepend=-1))
        for i, j in zip(cuts, np.r_[cuts[1:], len(begin)]):
            lo, hi = begin[i], begin[j] if j < len(begin) else len(y)
            group = np.repeat(np.arange(j - i), np.diff(np.r_[begin[i:j], hi]))
            owner, x, inside, touched = bands(part[lo:hi], e[:, lo:hi], group, y[begin[i:j]], edge)
            some = np.flatnonzero(touched.any(1))
            own = poly.take(pa.array(begin[i:j][owner[some]])).cast(pa.int64())
            packed = [pa.array([m.tobytes() for m in np.packbits(v[some], axis=1)], pa.binary()) for v in (inside, touched)]
            yield pa.RecordBatch.from_arrays([own, pa.array(x[some]), pa.array(y[begin[i:j]][owner[some]]), *packed], names=["poly", "x", "y", "centre", "touched"])

    def run(batches):
        # Rows are sorted by group; the last group of what is there may go on.
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n < EDGES:
                continue
            t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            poly, y = t.column("poly"), t.column("y").to_numpy()
            other = np.flatnonzero((y != y[-1]) | (poly.fill_null(0).to_numpy() != (poly[-1].as_py() or 0)) | (poly.is_null().to_numpy(zero_copy_only=False) == poly[-1].is_valid))
            end = int(other[-1]) + 1 if len(other) else 0
            if end:
                yield from drawn(t.slice(0, end))
            held, n = [t.slice(end)], 0
        if held and sum(b.num_rows for b in held):
            yield from drawn(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    return dealt.repartition("poly", "y").sortWithinPartitions("poly", "y").mapInArrow(run, MASKS)


def clipped(tiles: DataFrame, found: DataFrame, nodata: int, all_touched: bool = True) -> DataFrame:
    """Tiles (x, y, px array<int>, and other columns) with each polygon (`poly`) that touches them; pixels outside it are nodata."""
    return clipped_by(tiles, found, nodata, {"px": "touched" if all_touched else "centre"})


def clipped_by(tiles: DataFrame, found: DataFrame, nodata: int, rules: dict[str, str]) -> DataFrame:
    """Tiles as in clipped(), cut by several rules at once: for each rule a column with its pixels. rules: column, and which mask it is cut by."""
    rest = [c for c in tiles.columns if c != "px"]
    columns = ["poly", *(tiles.columns if "px" in rules else rest), *(c for c in rules if c != "px")]
    joined = found.select("poly", "x", "y", *(F.col(by).alias(f"_{name}") for name, by in rules.items())).join(tiles, ["x", "y"]).select("poly", *tiles.columns, *(f"_{name}" for name in rules))
    kinds = dict(tiles.dtypes) | {"poly": "long"} | {name: dict(tiles.dtypes)["px"] for name in rules}

    def run(batches):
        for b in batches:
            px = b.column(b.schema.get_field_index("px"))
            offsets = np.asarray(px.offsets)
            made = {c: b.column(b.schema.get_field_index(c)) for c in ["poly", *rest]}
            for name in rules:
                flat = px.flatten().to_numpy(zero_copy_only=False).copy()
                bits = [np.unpackbits(np.frombuffer(m.as_buffer(), np.uint8)) for m in b.column(b.schema.get_field_index(f"_{name}"))]
                keep = np.concatenate([v[:n] for v, n in zip(bits, np.diff(offsets))] or [np.zeros(0, np.uint8)]).astype(bool)
                flat[~keep] = nodata
                made[name] = pa.ListArray.from_arrays(pa.array(offsets - offsets[0]), pa.array(flat))
            yield pa.RecordBatch.from_arrays([made[c] for c in columns], names=columns)

    return joined.mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in columns))


def tiles_touched(polygons: DataFrame, west: float, north: float, size: float) -> DataFrame:
    """(poly, tx, ty) of the tiles of a lattice (its corner, and the size of a tile in the polygons' unit; ty counts north) that a polygon touches, its holes left out: the tiles are the pixels of a coarser raster."""
    block = 64
    point = lambda p: F.array((p[0] - west) / size, (north - p[1]) / size)
    moved = polygons.select("poly", F.transform("parts", lambda rings: F.transform(rings, lambda ring: F.transform(ring, point))).alias("parts"))
    found = masks(moved, block)

    def run(batches):
        for b in batches:
            poly, x, y = (b.column(i).to_numpy() for i in range(3))
            bits = np.stack([np.unpackbits(np.frombuffer(m.as_buffer(), np.uint8)) for m in b.column(4)]) if b.num_rows else np.zeros((0, block * block), np.uint8)
            own, at = np.nonzero(bits)
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (poly[own], x[own] * block + at % block, -(y[own] * block + at // block) - 1)], names=["poly", "tx", "ty"])

    return found.mapInArrow(run, "poly long, tx long, ty long")

"""Arrays in chunks (time x rows x columns), such as Zarr stores hold, read by tile and step: chunk numbers, a join, and assembly."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCKS = "x long, y long, step long, px array<float>, n_valid int"


@dataclass(frozen=True)
class Layout:
    """Size of the whole array, and of a chunk (edge chunks are whole too). Columns go round the globe; rows end at the poles."""

    steps: int
    rows: int
    cols: int
    ct: int
    cr: int
    cc: int


def chunk_numbers(tiles: DataFrame, lay: Layout, edge: int) -> DataFrame:
    """Tiles (x, y, row0, col0: their first row and column in the array, which may lie beyond its ends; t0, t1: first step, and the one after the last) with each chunk (tc, rc, cc) that holds part of them."""
    long = lambda v: v.cast("long")
    t0, t1 = F.greatest("t0", F.lit(0)), F.least("t1", F.lit(lay.steps))
    r0, r1 = F.greatest("row0", F.lit(0)), F.least(F.col("row0") + edge, F.lit(lay.rows))
    inside = tiles.where((t1 > t0) & (r1 > r0))
    columns = F.array_distinct(F.transform(F.sequence("col0", F.col("col0") + edge - 1), lambda c: long(F.floor(F.pmod(c, F.lit(lay.cols)) / lay.cc))))
    for name, values in (("tc", F.sequence(long(F.floor(t0 / lay.ct)), long(F.floor((t1 - 1) / lay.ct)))), ("rc", F.sequence(long(F.floor(r0 / lay.cr)), long(F.floor((r1 - 1) / lay.cr)))), ("cc", columns)):
        inside = inside.withColumn(name, F.explode(values))
    return inside


def assembled(tiles: DataFrame, chunks: DataFrame, lay: Layout, edge: int) -> DataFrame:
    """BLOCKS: each step of each tile that has a value, NaN where the array ends, where a chunk is absent, or where it has none. chunks (tc, rc, cc, data array<float>): one row a chunk. A task assembles one tile's steps of one time chunk, so it holds as many of them as a chunk does, however long the series is."""
    met = chunk_numbers(tiles, lay, edge).join(chunks.select("tc", "rc", "cc", "data"), ["tc", "rc", "cc"]).select("x", "y", "row0", "col0", "t0", "t1", "tc", "rc", "cc", "data")

    def run(key, t):
        x, y, tc = (k.as_py() for k in key)
        row0, col0, t0, t1 = (t.column(c)[0].as_py() for c in ("row0", "col0", "t0", "t1"))
        lo, hi = max(t0, tc * lay.ct), min(t1, (tc + 1) * lay.ct, lay.steps)
        out = np.full((hi - lo, edge, edge), np.nan, np.float32)
        rows = row0 + np.arange(edge)
        cols = (col0 + np.arange(edge)) % lay.cols
        for rc, cc, data in zip(t.column("rc").to_pylist(), t.column("cc").to_pylist(), t.column("data")):
            if data.values is None or len(data.values) != lay.ct * lay.cr * lay.cc:
                raise ValueError(f"chunk {tc}/{rc}/{cc} isn't {lay.ct} x {lay.cr} x {lay.cc}")
            a = data.values.to_numpy(zero_copy_only=False).astype(np.float32).reshape(lay.ct, lay.cr, lay.cc)
            r = np.flatnonzero((rows >= rc * lay.cr) & (rows < min((rc + 1) * lay.cr, lay.rows)))
            c = np.flatnonzero((cols >= cc * lay.cc) & (cols < (cc + 1) * lay.cc))
            out[np.ix_(np.arange(hi - lo), r, c)] = a[np.ix_(np.arange(lo, hi) - tc * lay.ct, rows[r] - rc * lay.cr, cols[c] - cc * lay.cc)]
        valid = np.isfinite(out).sum((1, 2))
        some = np.flatnonzero(valid)
        return pa.table({"x": pa.array([x] * len(some), pa.int64()), "y": pa.array([y] * len(some), pa.int64()), "step": pa.array(lo + some, pa.int64()), "px": pa.array(list(out[some].reshape(len(some), -1)), pa.list_(pa.float32())), "n_valid": pa.array(valid[some], pa.int32())})

    return met.groupBy("x", "y", "tc").applyInArrow(run, BLOCKS)

"""Coarser levels of a raster beside it, each a quarter of the edge of the one before, and the rule which level a request needs."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STEP = 4
LEVELS = "x long, y long, px array<int>"


def reduced(px: np.ndarray, nodata: int) -> np.ndarray:
    """Means of STEP x STEP pixels over those observed, halves upwards; nodata where none is."""
    h, w = px.shape
    blocks = px.reshape(h // STEP, STEP, w // STEP, STEP).swapaxes(1, 2).reshape(h // STEP, w // STEP, -1)
    seen = blocks != nodata
    n = seen.sum(2)
    total = np.where(seen, blocks, 0).astype(np.int64).sum(2)
    return np.where(n > 0, (2 * total + n) // np.maximum(2 * n, 1), nodata).astype(np.int32)


def coarser(tiles: DataFrame, edge: int, nodata: int) -> DataFrame:
    """Tiles (x, y, px array<int>; rows count down from the north, y down with them) of the next level: STEP x STEP tiles make one of the same edge, nodata where one is absent. A tile is reduced where it lies, so only its reduced pixels are shuffled."""
    small = edge // STEP

    def shrink(batches):
        for b in batches:
            px = [reduced(np.array(p, np.int32).reshape(edge, edge), nodata).ravel() for p in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(px, pa.list_(pa.int32()))], names=["x", "y", "px"])

    def place(key, t):
        out = np.full((edge, edge), nodata, np.int32)
        for x, y, px in zip(*(t.column(c).to_pylist() for c in ("x", "y", "px"))):
            r, c = y % STEP * small, x % STEP * small
            out[r : r + small, c : c + small] = np.array(px, np.int32).reshape(small, small)
        return pa.table({"x": [key[0].as_py()], "y": [key[1].as_py()], "px": pa.array([out.ravel()], pa.list_(pa.int32()))})

    at = lambda c: F.floor(F.col(c) / STEP).cast("long").alias(f"up_{c}")
    return tiles.select("x", "y", "px").mapInArrow(shrink, LEVELS).groupBy(at("x"), at("y")).applyInArrow(place, LEVELS)


def publish(tiles: DataFrame, path: str, edge: int, nodata: int, levels: int) -> None:
    """Levels 0 to `levels` as folders of one table; each is made of the one before, read back."""
    spark = tiles.sparkSession
    rows = tiles.select("x", "y", "px")
    for level in range(levels + 1):
        rows.repartitionByRange("y", "x").sortWithinPartitions("y", "x").write.option("compression", "zstd").parquet(f"{path}/level={level}")
        if level < levels:
            rows = coarser(spark.read.schema(LEVELS).parquet(f"{path}/level={level}"), edge, nodata)


def level_for(res: float, wanted: float, levels: int) -> int:
    """The coarsest level whose pixels aren't larger than wanted; 0 where even the raster's own are."""
    return max(0, min(levels, math.floor(math.log(wanted / res, STEP) + 1e-9))) if wanted > res else 0


def read(spark: SparkSession, path: str, res: float, wanted: float, levels: int) -> DataFrame:
    """Tiles of the level that a request for pixels of a size needs (`level` names it); the others' files aren't opened."""
    return spark.read.schema(f"{LEVELS}, level int").parquet(path).where(F.col("level") == level_for(res, wanted, levels))

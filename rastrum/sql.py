"""The engine in plain SQL: functions for spark.sql over a store's catalog and tiles."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from rastrum.operators.blobs import observed
from rastrum.sources import codec, store

VIEWS = ("catalog", "tiles")
_KEPT = "north > box_s AND south < box_n AND CASE WHEN west <= east THEN east > box_w AND west < box_e ELSE east > box_w OR west < box_e END"


@F.pandas_udf(ArrayType(DoubleType()))
def tile_decode(data: pd.Series) -> pd.Series:
    """Pixels of a blob, row by row; null where it can't be read."""

    def one(blob):
        try:
            return None if blob is None else codec.read(blob).px.astype(float).ravel()
        except codec.TileError:
            return None

    return data.map(one)


@F.pandas_udf(DoubleType())
def tile_value(data: pd.Series, row: pd.Series, col: pd.Series) -> pd.Series:
    """One pixel of a blob; null where nothing was observed, outside the tile, or where the blob can't be read."""

    def one(blob, r, c):
        try:
            t = codec.read(blob)
        except (codec.TileError, TypeError):
            return None
        inside = 0 <= r < t.px.shape[0] and 0 <= c < t.px.shape[1]
        return float(t.px[r, c]) if inside and observed(t.px[r : r + 1, c : c + 1], t.nodata).all() else None

    return pd.Series([one(*v) for v in zip(data, row, col)], dtype="float64")


@F.pandas_udf(ArrayType(DoubleType()))
def tile_scaling(data: pd.Series) -> pd.Series:
    """(scale, offset) that a blob names; (1, 0) where it names none."""
    return data.map(lambda b: None if b is None else list(codec.read(b).scaling))


def register(spark: SparkSession, catalog: DataFrame, tiles: DataFrame) -> None:
    """Makes the views `catalog` and `tiles`, the functions tile_decode, tile_value and tile_scaling, and the table function tiles_for_bbox(band, date, w, s, e, n): catalog rows of a band over a box (the antimeridian included), of a date or its beginning. The table function is SQL itself, so its filters reach the scan."""
    catalog.createOrReplaceTempView(VIEWS[0])
    tiles.createOrReplaceTempView(VIEWS[1])
    for name, f in (("tile_decode", tile_decode), ("tile_value", tile_value), ("tile_scaling", tile_scaling)):
        spark.udf.register(name, f)
    kinds = dict(catalog.dtypes)
    columns = ", ".join(f"{c} {kinds[c]}" for c in store.CATALOG)
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION tiles_for_bbox(of_band STRING, of_date STRING, box_w DOUBLE, box_s DOUBLE, box_e DOUBLE, box_n DOUBLE)
      RETURNS TABLE({columns}) RETURN SELECT {', '.join(store.CATALOG)} FROM {VIEWS[0]} WHERE band = of_band AND startswith(date, of_date) AND {_KEPT}""")

"""Pixel operators on rows (tile_id, scene_id, pos, dn): masks, merges, mosaics, shares, clips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rastrum.functions import scalars as S


def observed(value: Column, nodata) -> Column:
    """True for a measurement: no nodata means all are; NaN nodata means not NaN (in Spark NaN equals NaN)."""
    nodata = F.lit(nodata)
    return nodata.isNull() | ~(value == nodata)


def observed_counts(px: DataFrame, nodata: float) -> DataFrame:
    return px.groupBy("tile_id", "scene_id").agg(F.sum(observed(F.col("dn"), nodata).cast("long")).alias("n_observed"))


def merge(px: DataFrame, nodata: int) -> DataFrame:
    """First observed pixel by scene, fullest scene first; what is taken doesn't depend on the order of arrival."""
    ranked = px.join(observed_counts(px, nodata), ["tile_id", "scene_id"])
    seen = observed(F.col("dn"), nodata)
    first = F.min(F.when(seen, F.struct(-F.col("n_observed"), F.col("scene_id"), F.col("dn"))))
    return ranked.groupBy("tile_id", "pos").agg(first.alias("b")).select("tile_id", "pos", F.coalesce("b.dn", F.lit(nodata)).alias("dn"), F.col("b.scene_id").alias("scene_id"))


def contributions(merged: DataFrame) -> DataFrame:
    """Pixels that each scene gave a merged tile."""
    return merged.where("scene_id is not null").groupBy("tile_id", "scene_id").agg(F.count("*").alias("n_px"))


def mosaic(merged: DataFrame, across: int, edge: int) -> DataFrame:
    """Merged tiles, `across` in a row, placed on one raster."""
    return merged.select(((F.col("tile_id") / across).cast("long") * edge + F.floor(F.col("pos") / edge)).cast("long").alias("row"), (F.col("tile_id") % across * edge + F.col("pos") % edge).cast("long").alias("col"), "dn")


def share(px: DataFrame, good: Column, valid: Column, name: str) -> DataFrame:
    """Per tile and scene the percentage of good pixels among valid ones, to two places; null without a valid pixel."""
    return px.groupBy("tile_id", "scene_id").agg(S.share(F.count_if(good & valid), F.count_if(valid)).alias(name))


def block_share(px: DataFrame, edge: int, block: int, fill: int) -> DataFrame:
    """Blocks of pixels: rounded (half to even) share of good ones (0 or 1) among valid ones; 255 where all are fill."""
    where = ["tile_id", "scene_id", F.floor(F.floor(F.col("pos") / edge) / block).cast("long").alias("brow"), F.floor(F.col("pos") % edge / block).cast("long").alias("bcol")]
    valid = F.col("cls") != fill
    return px.groupBy(*where).agg(F.sum(valid.cast("long")).alias("v"), F.sum((valid & (F.col("cls") <= 1)).cast("long")).alias("g")).select("tile_id", "scene_id", "brow", "bcol", F.expr("if(v = 0, 255, cast(rint(100.0D * g / v) as bigint))").cast("long").alias("good"))


def inside(x: Column, y: Column, ring: list[tuple[float, float]]) -> Column:
    """Even-odd rule: how many edges of a closed ring a ray to the east crosses."""
    n = F.lit(0)
    for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1]):
        if y0 != y1:
            n = n + F.when(((F.lit(y0) > y) != (F.lit(y1) > y)) & (x < F.lit(float(x1 - x0)) * (y - y0) / F.lit(float(y1 - y0)) + x0), 1).otherwise(0)
    return n % 2 == 1


def newest(df: DataFrame, by: list, order: list, name: str = "_r") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(name) == 1).drop(name)
